"""Dated histories of persons: concatenation, chunks in rounds, marked events, numbered statements, serial folds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import chunks

# The section headings of a summary.
HEADINGS = ("Age", "Sex", "Cancer type", "Histology", "Current extent", "Biomarkers", "Treatment history", "Other relevant history")
HISTORY_HEADINGS = ("Treatment history", "Other relevant history")


def concatenated(notes: DataFrame, person: str, date: str, order: Sequence[str], text: str, title: str = "Clinical Note") -> DataFrame:
    """One text a person: all notes in order, each under a line with its date; with the first and last date."""
    header = F.concat(F.lit(f"=== {title} dated "), F.col(date), F.lit(" ===\n"), F.col(text), F.lit("\n"))
    facts = notes.groupBy(person).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(date).alias("__date"), header.alias("__block")))).alias("__n"))
    return facts.select(person, F.array_join(F.col("__n.__block"), "\n").alias("history"), F.element_at("__n.__date", 1).alias("first_date"), F.element_at("__n.__date", -1).alias("last_date"))


def chunked(histories: DataFrame, person: str, size: int, overlap: int, title: str = "Clinical Note") -> DataFrame:
    """Chunks of ``size`` blank-separated tokens that share ``overlap``: ``round`` from 0, text, and the dates seen in each.

    A chunk without a date takes the last date seen before it, or the history's first.
    """
    tokens = F.filter(F.split("history", " "), lambda t: t != "")
    rows = histories.select(person, "first_date", "last_date", F.explode(chunks(tokens, size, overlap)).alias("c"), (F.size(tokens) <= size).alias("__whole"), "history")
    text = F.when(F.col("__whole"), F.col("history")).otherwise(F.array_join("c.tokens", " "))
    rows = rows.select(person, F.col("c.number").alias("round"), text.alias("chunk"), "first_date", "last_date", "__whole")
    dates = F.regexp_extract_all("chunk", F.lit(rf"=== {title} dated (.+?) ==="), F.lit(1))
    rows = rows.withColumn("__d", dates).withColumn("__last", F.try_element_at("__d", F.lit(-1)))
    before = F.last("__last", True).over(Window.partitionBy(person).orderBy("round").rowsBetween(Window.unboundedPreceding, -1))
    carried = F.coalesce(before, F.col("first_date"))
    return rows.select(
        person,
        "round",
        "chunk",
        F.when(F.col("__whole"), F.col("first_date")).otherwise(F.coalesce(F.try_element_at("__d", F.lit(1)), carried)).alias("first_date"),
        F.when(F.col("__whole"), F.col("last_date")).otherwise(F.coalesce("__last", carried)).alias("last_date"),
    )


def marked_events(events: DataFrame, person: str, order: Sequence[str], kind: str, text: str, kinds: Sequence[str], begin: str = "<BEGIN EVENT CORRESPONDING TO SYNTHETIC NOTE> ", end: str = " <END EVENT CORRESPONDING TO SYNTHETIC NOTE>") -> DataFrame:
    """Events of some kinds with their person's whole history, in which the first event of equal text is marked."""
    lines = events.groupBy(person).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__t")))).alias("__n")).select(person, F.col("__n.__t").alias("__texts"))
    rows = events.where(F.col(kind).isin(*kinds)).join(lines, person)
    place = F.array_position("__texts", F.col(text))
    mark = F.concat(F.lit(begin), F.lit("<"), F.col(kind), F.lit(">"), F.col(text), F.lit(end))
    spliced = F.transform("__texts", lambda t, i: F.when(i + 1 == F.col("__place"), F.col("__mark")).otherwise(t))
    return rows.withColumn("__place", place).withColumn("__mark", mark).withColumn("masked_text", F.array_join(spliced, "\n")).drop("__texts", "__place", "__mark")


def statements(summaries: DataFrame, id_col: str, text: str, headings: Sequence[str] = HEADINGS, keep_rest: Sequence[str] = HISTORY_HEADINGS) -> DataFrame:
    """``id_col``, ``n`` from 1, ``section``, ``text``: the sentences of each line under the heading above it.

    A heading alone on its line opens a section; text after a history heading stands without it.
    """
    lines = summaries.select(id_col, F.posexplode(F.split(text, "\r\n|\r|\n")).alias("__line", "__raw")).withColumn("__raw", F.trim("__raw")).where("__raw <> ''")
    head = F.lower(F.trim(F.substring_index("__raw", ":", 1)))
    names = F.create_map(*(F.lit(x) for h in headings for x in (h.lower(), h)))
    lines = lines.withColumn("__head", F.try_element_at(names, head))
    rest = F.trim(F.regexp_replace("__raw", "^[^:]*:?", ""))
    section = F.last("__head", True).over(Window.partitionBy(id_col).orderBy("__line").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    body = F.when(F.col("__head").isNull(), F.col("__raw")).when(rest == "", F.lit(None)).when(F.col("__head").isin(*keep_rest), rest).otherwise(F.col("__raw"))
    lines = lines.withColumn("section", F.coalesce(section, F.lit("Summary"))).withColumn("__body", body)
    parts = lines.select(id_col, "__line", "section", F.posexplode(F.split("__body", r"(?<=[.;!?])\s+(?=[A-Z#(])")).alias("__place", "text"))
    order = Window.partitionBy(id_col).orderBy("__line", "__place")
    return parts.withColumn("text", F.trim("text")).where("text <> ''").select(id_col, F.row_number().over(order).alias("n"), "section", "text")


def fold_rounds(frame: DataFrame, person: str, order: str, step: Callable[[str | None, str], str], text: str, out: str = "summary") -> DataFrame:
    """The fold of each person's chunks in order, ``summary = step(summary, chunk)``; every person's last state."""
    kind = dict(frame.dtypes)[person]

    def fold(rows):
        state = None
        for chunk in rows.sort_values(order)[text]:
            state = step(state, chunk)
        return rows[[person]].head(1).assign(**{out: state, "n_rounds": len(rows)})

    return frame.groupBy(person).applyInPandas(fold, f"{person} {kind}, {out} string, n_rounds long")
