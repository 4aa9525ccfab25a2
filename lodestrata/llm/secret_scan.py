"""Secret scan: an Aho-Corasick prefilter, anchored patterns near its hits, checksums inside tokens.

One pass over the texts, no shuffle. An automaton of the keywords runs once over each text; a pattern
is tried only at the offset of a hit, so a text without keywords costs that one pass. Runs of hex
digits have no keyword: every eighth character is probed, and only where four probes in a row are hex
digits (as they must be in a run of 32) is the run itself read. Tokens with an embedded CRC-32 are kept
only if it is right.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import bounded_batches

# The kinds and patterns of the query's contract, in the order in which ties are listed.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 8, "access": 16, "hex": 32}
KEYWORDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"), "access": ("akia",)}
# Public token formats that end in a base-62 CRC-32 of the part before it.
CHECKED = {"github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), "npm": (("npm_",), r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

KINDS = BASE_KINDS + tuple(CHECKED)
SPANS = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"
_STRIDE = 8


def base62_crc(body: str) -> str:
    """The CRC-32 of ``body`` in six base-62 digits."""
    rest, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        rest, d = divmod(rest, 62)
        digits = BASE62[d] + digits
    return digits


@lru_cache(1)
def _machine():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, words in [*KEYWORDS.items(), *((k, v[0]) for k, v in CHECKED.items())]:
        for word in words:
            automaton.add_word(word, (len(word) - 1, kind))
    automaton.make_automaton()
    patterns = {"assign": re.compile(ASSIGN, re.I | re.A), "access": re.compile(ACCESS), **{k: re.compile(v[1]) for k, v in CHECKED.items()}}
    return automaton, patterns, re.compile(HEX), re.compile("[0-9a-f]{%d,}" % (LEAST["hex"] // _STRIDE))


_CAPITALS = {c: c + 32 for c in range(65, 91)}


def _lowered(text: str) -> str:
    """Lower case with every character at its old offset."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_CAPITALS)


def _hex_runs(text: str) -> Iterator[tuple[int, int]]:
    _, _, run, probe = _machine()
    least = LEAST["hex"] // _STRIDE
    for found in probe.finditer(text[::_STRIDE]):
        at, last = found.span()
        while last - at >= least:
            start = at * _STRIDE
            while start and text[start - 1] in "0123456789abcdef":
                start -= 1
            end = run.match(text, start).end()
            if end - start >= LEAST["hex"]:
                yield start, end
            at = -(-end // _STRIDE)


def find_spans(text: str | None) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) in one text, by start, then kind; code points, end exclusive."""
    if not text:
        return []
    automaton, patterns, _, _ = _machine()
    spans, ends = [("hex", s, e, text[s:e]) for s, e in _hex_runs(text)], {}
    for start, kind in sorted((end - back, kind) for end, (back, kind) in automaton.iter(_lowered(text))):
        if start < ends.get(kind, 0) or not (m := patterns[kind].match(text, start)):
            continue
        ends[kind] = m.end()
        if kind == "assign":
            if len(m[2]) >= LEAST[kind]:
                spans.append((kind, start, m.end(), m[2]))
        elif kind == "access":
            if m.end() - start >= LEAST[kind]:
                spans.append((kind, start, m.end(), m[0]))
        elif base62_crc(m[0][4:-6]) == m[0][-6:]:
            spans.append((kind, start, m.end(), m[0]))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans``: the secrets of each whole text.

    Nulls: a null text has no spans; a null id is kept. Repeated rows are scanned each for itself; an
    empty table gives an empty one. Other columns of ``docs`` are not read, so their names can't clash.
    """
    bounded_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(picked.dtypes)["id"]

    def run(batches):
        out = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
        for batch in batches:
            rows = ([dict(zip(("kind", "start", "end", "value"), s, strict=True)) for s in find_spans(t.as_py())] for t in batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, out)], ["id", "spans"])

    return picked.mapInArrow(run, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)


def span_digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
