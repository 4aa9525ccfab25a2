"""Text functions as column expressions; Python only where a rule has state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that a whole description must have. Each field needs all terms of one of its alternatives.
REQUIRED_FIELDS = {
    "Age": (("Age",),),
    "Sex": (("Sex",),),
    "Cancer primary site": (("Cancer primary site allowed:",), ("Cancer type allowed:",)),
    "Histology": (("Histology",),),
    "Disease state": (("Disease state allowed:",), ("Cancer burden allowed:",)),
    "Prior treatment requirements": (("Prior treatment requirements:",), ("Prior treatment required:", "Prior treatment excluded:")),
    "Biomarker requirements": (("Biomarker requirements:",), ("Biomarkers required:", "Biomarkers excluded:")),
}


def clean_registry_id(value: Column, prefix: str = "NCT", digits: int = 8) -> Column:
    """Trimmed upper-case id of a prefix and so many digits; anything else is null."""
    tidy = F.upper(F.trim(value))
    return F.when(tidy.rlike(f"^{prefix}[0-9]{{{digits}}}$"), tidy)


def protocol_key(value: Column) -> Column:
    """'17-123' to 17123; null unless the form is two digits, a dash, three digits."""
    tidy = F.trim(value)
    return F.when(tidy.rlike("^[0-9]{2}-[0-9]{3}$"), F.replace(tidy, F.lit("-"), F.lit("")).try_cast("bigint"))


def has_required_fields(text: Column, fields: dict = REQUIRED_FIELDS) -> Column:
    """Whether the text has, for every field, all terms of one alternative; a null text has none."""
    every = lambda terms: reduce(lambda a, b: a & b, (F.contains(text, F.lit(t)) for t in terms))
    one = lambda ways: reduce(lambda a, b: a | b, map(every, ways))
    return F.coalesce(reduce(lambda a, b: a & b, map(one, fields.values())), F.lit(False))


def strip_numbering(text: Column) -> Column:
    """Without a leading 'N.' and outer blanks."""
    return F.trim(F.regexp_replace(text, r"^\s*[0-9]+\.", ""))


def complete_criteria(multiple: Column, specific: Column, common: Column, combined: Column, original: Column, source: Column, extracted: Sequence[str], headings: tuple[str, str] = ("Cohort-specific eligibility criteria:", "Common eligibility criteria:")) -> Column:
    """The whole criteria of one cohort.

    Several cohorts: the specific text, under a heading and followed by the common one if there is any.
    A sole cohort: its own text if it was extracted, else the original text. A text that is due but
    blank is an error.
    """
    both = F.concat(F.lit(headings[0] + "\n"), specific, F.lit("\n\n" + headings[1] + "\n"), common)
    need = lambda c, what: F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.raise_error(F.lit(f"missing {what}")).cast("string")).otherwise(c)
    many = F.when(F.coalesce(common, F.lit("")) == "", need(specific, "cohort-specific criteria")).otherwise(F.when(F.coalesce(F.trim(specific), F.lit("")) == "", need(specific, "cohort-specific criteria")).otherwise(both))
    sole = F.when(source.isin(*extracted), need(combined, "criteria of a sole cohort")).otherwise(need(original, "original criteria of a sole cohort"))
    return F.when(multiple == "yes", many).when(multiple == "no", sole).otherwise(combined)


def version_of(source: Column) -> Column:
    """protocol, else ctgov."""
    return F.when(source == "protocol", "protocol").otherwise("ctgov")


def split_at_marker(text: Column, marker: str) -> Column:
    """Struct (main, rest): the text before the first marker and after it; all of it if there is none."""
    at = F.locate(marker, text)
    return F.struct(F.when(at > 0, F.trim(F.substring(text, F.lit(1), at - 1))).otherwise(text).alias("main"), F.when(at > 0, F.trim(F.substring(text, at + len(marker), F.length(text)))).otherwise(F.lit("")).alias("rest"))


def final_score(response: Column, tail: int = 60, highest: int = 5) -> Column:
    """The score at the end of a response: 'Final score: n', else 'score: n', else 0 for 'not reasonable', else -1."""
    end = F.replace(F.replace(F.right(response, F.lit(tail)), F.lit("*"), F.lit("")), F.lit("\u202f"), F.lit(" "))
    first = F.regexp_extract(end, r"[Ff]inal\s+[Ss]core\s*:\s*([0-9])", 1).try_cast("int")
    loose = F.regexp_extract(F.upper(end), r"SCORE\s*[:=-]\s*([0-9])", 1).try_cast("int")
    refused = F.upper(end).rlike("NOT (A )?REASONABLE")
    found = F.coalesce(first, loose, F.when(refused, 0))
    return F.when(found.isNull(), -1).otherwise(F.least(found, F.lit(highest)))


def yes_no_tail(response: Column, tail: int = 10) -> Column:
    """1.0 or 0.0 for a response that ends with yes or no, -1.0 for neither; with an exclamation mark before without, yes before no."""
    end = F.upper(F.right(F.rtrim(F.coalesce(response, F.lit(""))), F.lit(tail)))
    has = lambda word: F.contains(end, F.lit(word))
    return F.when(has("YES!"), 1.0).when(has("NO!"), 0.0).when(has("YES"), 1.0).when(has("NO"), 0.0).otherwise(-1.0)


def tidy(value: Column) -> Column:
    """Lower case, runs of white space as one blank, none at the ends; a null is empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", " ")))


def quote_pieces(quote: Column) -> Column:
    """The tidy pieces of a quote around '...', empty ones left out."""
    return F.filter(F.transform(F.split(F.coalesce(quote, F.lit("")), r"\.\.\.|…"), tidy), lambda p: p != "")


def pieces_found(pieces: Column, text: Column) -> Column:
    """Whether all pieces (at least one) stand in a tidy text, in order and without overlap."""

    def after(at: Column, piece: Column) -> Column:  # where to go on; 0 once a piece is missing
        found = F.position(piece, text, at)
        return F.when((at > 0) & (found > 0), found + F.length(piece)).otherwise(0)

    return (F.size(pieces) > 0) & (F.aggregate(pieces, F.lit(1), after) > 0)


def quote_found(quote: Column, source: Column) -> Column:
    """Whether a quote stands in the source, ignoring case and runs of blanks; pieces around '...' must follow in order."""
    return pieces_found(quote_pieces(quote), tidy(source))


def quote_seed(pieces: Column, most: int = 3) -> Column:
    """Up to ``most`` whole words from inside a quote's first piece, joined by blanks: a text that holds the quote has them in a row.

    The first and last word of a piece may be parts of longer words, so they aren't used; empty if there are none between.
    """
    inside = F.split(pieces[0], " ")
    return F.when(F.size(pieces) > 0, F.array_join(F.slice(inside, F.lit(2), F.least(F.lit(most), F.greatest(F.size(inside) - 2, F.lit(0)))), " ")).otherwise("")


def word_runs(text: Column, n: int) -> Column:
    """The distinct runs of ``n`` words of a tidy text."""
    parts = F.split(text, " ")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(parts) - n, F.lit(0))), lambda i: F.array_join(F.slice(parts, i + 1, n), " ")))


def words(text: Column) -> Column:
    """Runs of letters, digits and underscores, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def token_f1(a: Column, b: Column) -> Column:
    """The harmonic mean of the shares of common words, counted with repeats; 0 without any."""
    wa, wb = words(a), words(b)
    common = F.aggregate(F.array_distinct(wa), F.lit(0), lambda n, w: n + F.least(F.size(F.filter(wa, lambda x: x == w)), F.size(F.filter(wb, lambda x: x == w))))
    return F.coalesce(F.try_divide(2.0 * common, F.size(wa) + F.size(wb)), F.lit(0.0))


def head_and_tail(text: Column, most: int) -> Column:
    """Words of a text cut to its first and last ones around ' ... ' if there are more than ``most``."""
    parts = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    head, tail = most - most // 2, most // 2
    return F.when(F.size(parts) <= most, text).otherwise(F.concat(F.array_join(F.slice(parts, 1, head), " "), F.lit(" ... "), F.array_join(F.slice(parts, F.size(parts) - tail + 1, tail), " ") if tail else F.lit("")))


def chunks(tokens: Column, size: int, overlap: int) -> Column:
    """Array of structs (number from 0, start, tokens): windows of ``size`` that share ``overlap`` tokens with the next; the last ends at the end."""
    if overlap >= size:
        raise ValueError("the overlap must be shorter than a chunk")
    step = size - overlap
    n = F.greatest(F.lit(1), F.ceil((F.size(tokens) - overlap) / F.lit(step)).cast("int"))
    return F.when(F.size(tokens) == 0, F.array().cast("array<struct<number:int,start:int,tokens:array<string>>>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("number"), (i * step).cast("int").alias("start"), F.slice(tokens, i * step + 1, size).alias("tokens"))))


def tagged_events(text: Column, kinds: Sequence[str]) -> Column:
    """Array of structs (number from 1, kind, text): '<kind>text' up to the next tag of a known kind."""
    names = "|".join(kinds)
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s)<({names})>((?:(?!<(?:{names})>).)*)"), F.lit(0))
    return F.transform(pieces, lambda p, i: F.struct((i + 1).alias("number"), F.regexp_extract(p, rf"^<({names})>", 1).alias("kind"), F.trim(F.regexp_replace(p, rf"^<({names})>", "")).alias("text")))


def strip_fence(text: Column) -> Column:
    """A JSON answer without a surrounding code fence."""
    return F.trim(F.regexp_replace(F.trim(text), r"^```(?:json)?\s*|\s*```$", ""))


def mask_digits(text: Column) -> Column:
    """Runs of digits as #."""
    return F.regexp_replace(text, "[0-9]+", "#")


def title_codes(title: Column, stop: Sequence[str] = ("NCT", "COVID", "SARS", "HIV", "CD")) -> Column:
    """Distinct codes of 2 to 6 capitals and 3 to 7 digits (and a capital), without dash or blank, sorted."""
    found = F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(r"\b([A-Z]{2,6}[- ]?[0-9]{3,7}[A-Z]?)\b"), F.lit(1))
    kept = F.filter(found, lambda c: ~F.regexp_extract(c, "^([A-Z]+)", 1).isin(*stop))
    return F.array_sort(F.array_distinct(F.transform(kept, lambda c: F.regexp_replace(c, "[- ]", ""))))


def category(value: Column, allowed: Sequence[str], prefixes: dict[str, str], fallback: Column | None = None) -> Column:
    """A tidy category: trimmed title case, values with a known prefix folded, nulls from the fallback, others 'Other', none 'Unknown'."""
    raw = F.coalesce(F.nullif(F.trim(value), F.lit("")), F.nullif(F.trim(fallback), F.lit("")) if fallback is not None else F.lit(None).cast("string"))
    title = F.initcap(raw)
    folded = reduce(lambda out, p: F.when(title.startswith(p[0]), F.lit(p[1])).otherwise(out), reversed(list(prefixes.items())), title)
    return F.when(raw.isNull(), "Unknown").when(folded.isin(*allowed), folded).otherwise("Other")
