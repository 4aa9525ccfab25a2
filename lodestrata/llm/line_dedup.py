"""Line deduplication by winnowing over line hashes, in DataFrame operations only.

A run is any number of neighbouring lines with at least ``min_chars`` characters in all. A line is deleted
if it lies in a run that also starts earlier: in a document with a smaller id, or further up in its own.

1. Winnowing: from each line on, the shortest run is a window, and the least line hash in it is selected
   as the window's fingerprint, with its position. Equal runs begin with equal windows, wherever they
   stand, so they are guaranteed to share a fingerprint. A line of ``min_chars`` characters is a window.
2. Selected positions are counted by fingerprint. Only fingerprints at two positions go on, and with them
   only the windows that they were selected from; of a corpus without repeats nothing is left here.
3. Joined positions extend both ways: ahead over the shortest run from each line, back over the shortest
   run that ends at each line. Together these cover every line of a repeated run, short ones at either
   end included: from a line of it on, the run has ``min_chars`` characters, or the shortest run that ends
   where it ends holds the line. What agrees with an extension is found by its content, among all
   earlier documents rather than one, and its first occurrence by a minimum, so copies never meet as pairs.
4. Extensions that aren't first are the later repeated runs; their lines go, joined back by document.

Hot lines: counts and minima are summed up before the shuffle. The joins have one row for a key on one
side; that side is written first, so both sides are plain exchanges and Spark can split the other one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

MIN_CHARS = 20


def _shortest(text: Column, min_chars: int) -> Column:
    """The shortest run of ``min_chars`` characters from each line on; the last lines may have none."""
    return F.regexp_extract_all(text, F.lit(f"(?dm)^(?=((?:\\n*+[^\\n]){{{min_chars}}}[^\\n]*+))"), F.lit(1))


def _n_lines(run: Column) -> Column:
    return F.char_length(run) - F.char_length(F.replace(run, F.lit("\n"), F.lit(""))) + 1


def _run(line: Column, lines: Column, run: Column) -> Column:
    """A run as (first line, lines, least line hash, its position, hash of the content)."""
    hashes = F.transform(F.split(run, "\n"), lambda x: F.xxhash64(x))
    several = F.transform(F.array(hashes), lambda h: F.struct(F.array_min(h).alias("fp"), F.array_position(h, F.array_min(h)).alias("place")))[0]
    least = F.when(lines == 1, F.struct(F.xxhash64(run).alias("fp"), F.lit(1).cast("long").alias("place"))).otherwise(several)
    return F.struct(line.cast("int").alias("line"), lines.cast("int").alias("lines"), least.alias("least"), F.xxhash64(run).alias("content"))


def _ahead(text: Column, min_chars: int) -> Column:
    """The winnowing windows: the shortest run from each line on."""
    return F.transform(_shortest(text, min_chars), lambda w, i: _run(i, _n_lines(w), w))


def _back(text: Column, min_chars: int, ahead: Column) -> Column:
    """The shortest run of several lines that ends at each line; a single line is a window already. Its fingerprint is that of the window it begins with."""
    last = _n_lines(text) - 1  # a variable below, else it is counted again for each line
    found = F.transform(_shortest(F.reverse(text), min_chars), lambda w, i: F.struct(w.alias("w"), i.alias("i"), _n_lines(w).alias("n")))
    several = F.filter(found, lambda x: x["n"] > 1)

    def run(x: Column, end: Column) -> Column:
        line = (end - x["i"] - x["n"] + 1).cast("int")
        return F.struct(line.alias("line"), x["n"].cast("int").alias("lines"), F.get(ahead, line)["least"].alias("least"), F.xxhash64(F.reverse(x["w"])).alias("content"))

    return F.flatten(F.transform(F.array(last), lambda end: F.transform(several, lambda x: run(x, end))))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``id``, ``tie`` (hash of the text) and ``gone``: positions from 0 of the lines to delete, of documents that have some."""
    text, most = F.col("text"), max(1, min_chars)
    picked = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    unpacked = lambda runs: picked.select("id", "tie", F.explode(runs).alias("w")).select("id", "tie", "w.line", "w.lines", "w.least.fp", (F.col("w.line") + F.col("w.least.place") - 1).cast("int").alias("at"), "w.content")
    selected = F.struct("id", "tie", "at")  # a line can be the fingerprint of several windows
    repeated = unpacked(_ahead(text, most)).groupBy("fp").agg(F.min(selected).alias("low"), F.max(selected).alias("high")).where("NOT low <=> high").select("fp")
    runs = unpacked(F.flatten(F.transform(F.array(_ahead(text, most)), lambda ahead: F.array_distinct(F.concat(ahead, _back(text, most, ahead))))))
    extended = written(runs.join(written(repeated, "line-fingerprints"), "fp", "left_semi").drop("fp", "at"), "line-runs")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "tie", "line")
    first = extended.groupBy("content", "lines").agg(F.min(place).alias("first"), F.max(place).alias("final")).where("NOT first <=> final").drop("final")
    later = extended.join(written(first, "line-firsts"), ["content", "lines"]).where(~place.eqNullSafe(F.col("first")))
    spans = later.select("id", "tie", F.struct("line", "lines").alias("span"))
    gone = F.array_sort(F.array_distinct(F.flatten(F.transform(F.collect_set("span"), lambda s: F.sequence(s["line"], s["line"] + s["lines"] - 1)))))
    return spans.groupBy("id", "tie").agg(gone.alias("gone"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with all its columns, repeated lines deleted from the text, and ``n_lines`` and ``n_removed`` in ``line_dedup``.

    Rows are never dropped; a text may become empty. A null text has no lines and stays null. A null id
    comes after every other id. Rows that share an id are ordered by a hash of their texts; rows that
    share both are one document and get the same result. A run that repeats so closely that its copies
    overlap leaves what stands before the second copy. Line identity is a 64-bit hash. An empty table
    gives an empty one. ``line_dedup`` is the only name added; a column of that name is replaced.
    """
    text, kept = F.col("record")[text_col].cast("string"), F.col("lines")
    record = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record"))
    keyed = record.select("record", F.col("record")[id_col].alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tie"))
    gone = repeated_lines(docs, id_col, text_col, min_chars).select(F.col("id").alias("gone_id"), F.col("tie").alias("gone_tie"), "gone")
    joined = keyed.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("tie") == F.col("gone_tie")), "left")
    joined = joined.select("record", "gone", F.split(text, "\n").alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    new_text = F.when(F.col("gone").isNull() | text.isNull(), text).otherwise(F.array_join(F.transform(left, lambda i: kept[i]), "\n"))
    counts = F.struct(F.when(text.isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
    others = [F.col("record")[c].alias(c) if c != text_col else new_text.alias(c) for c in docs.columns if c != "line_dedup"]
    return joined.select(*others, counts.alias("line_dedup"))


ORACLE = f"""
WITH docs AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
sums AS (SELECT doc_id, pos, line, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM each),
pairs AS (SELECT a.doc_id, a.pos AS low, b.pos AS high FROM sums a JOIN sums b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + length(a.line) >= {MIN_CHARS}),
runs AS (SELECT doc_id, low, min(high) AS high FROM pairs GROUP BY doc_id, low UNION SELECT doc_id, max(low) AS low, high FROM pairs GROUP BY doc_id, high),
ranked AS (SELECT doc_id, low, high, row_number() OVER (PARTITION BY array_to_string(lines[low:high], chr(10)) ORDER BY doc_id, low) AS k FROM runs JOIN docs USING (doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(low, high + 1)) AS pos FROM ranked WHERE k > 1)
SELECT d.doc_id, CASE WHEN any_value(t.text) IS NULL THEN 0 ELSE count(*) END AS n_lines, count(g.pos) AS n_removed,
  sha256(coalesce(string_agg(d.line, chr(10) ORDER BY d.pos) FILTER (WHERE g.pos IS NULL), '')) AS kept_sha256
FROM each d JOIN docs t ON t.doc_id = d.doc_id LEFT JOIN gone g ON d.doc_id = g.doc_id AND d.pos = g.pos GROUP BY d.doc_id
"""
