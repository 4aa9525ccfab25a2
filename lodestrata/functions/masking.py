"""Masking a row's own study identifiers in its text, and what is left of them afterwards.

One scan lists everything that looks like an identifier, whosever it is: its key, the checks that it
counts for, and the stretch of text that a token would replace, if its spelling is one that is replaced.
Whether it is the row's own is then a lookup of the key. The scan depends on a text alone, the lookup on
the row's keys; both run in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Dashes, tokens and the names of the checks.
DASHES = "-‐‑‒–—"
TOKENS = {"protocol": "[TRIAL PROTOCOL]", "nct": "[NCT ID]", "code": "[STUDY DRUG CODE]"}
RESIDUAL = ("own_protocol", "own_nct", "own_code", "own_code_any_case", "protocol_dashless_after_prefix", "protocol_followed_by_dash_or_slash", "protocol_after_dot_dash_or_slash", "protocol_other_separator", "nct_digits_without_prefix", "code_other_separator")

_TWO_THREE = re.compile(rf"(?<!\d)(\d\d)([{DASHES}\s_~]*)(\d{{3}})(?!\d)")
_LETTERS_DIGITS = re.compile(rf"\b([A-Z]{{2,6}})([{DASHES}\s_./]*)(\d{{3,7}}[A-Z]?)\b", re.I)
_LONG_NUMBER = re.compile(r"(NCT\s?(?=0?\d{7}))?(?<!\d)(\d{6,})", re.I)
_TAIL = re.compile(r"(?:[\-/][A-Za-z0-9]{1,6})+(?![\dA-Za-z])")
_CLOSE = re.compile(rf"\s?[{DASHES}]\s?")
_FAR = re.compile(rf"\s{{2,}}[{DASHES}]\s*|\s*[{DASHES}]\s{{2,}}|\s*[_~]\s*| +")
_CODE_CLOSE = re.compile(rf"[{DASHES} ]?")
_CODE_FAR = re.compile(rf"\s{{2,}}|\s*[_./]\s*|\s*[{DASHES}]\s+|\s+[{DASHES}]\s*")


class Sighting(NamedTuple):
    key: int | str
    checks: tuple[str, ...]
    span: tuple[int, int] | None


@lru_cache(64)
def _leads(sites: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern]:
    """Up to three words or signs that announce a number with a dash; and the one that must announce a number without."""
    word = rf"\b(?:{'|'.join([*map(re.escape, sites), 'protocol'])})"
    return re.compile(rf"(?:{word}\s?[/:]?\s?|#:?\s?){{1,3}}\Z", re.I), re.compile(rf"(?:{word}\s?[#:]?|#)\s?\Z", re.I)


def _protocols(text: str, sites: tuple[str, ...]) -> Iterator[Sighting]:
    several, one = _leads(sites)
    reach = 3 * (max(map(len, (*sites, "protocol"))) + 4)
    for m in _TWO_THREE.finditer(text):
        start, end = m.span()
        key, gap, before, after = int(m[1] + m[3]), m[2], text[max(0, start - 1) : start], text[end : end + 1]
        cut, ended = before in tuple(".-/") and bool(before), after not in tuple("-/") or not after
        lead = lambda pattern: pattern.search(text, max(0, start - reach), start)  # noqa: B023, E731
        checks, span = [], None
        if not gap:
            if found := lead(one):
                checks, span = ["protocol_dashless_after_prefix"], (found.start(), end)
        elif _CLOSE.fullmatch(gap):
            first = found.start() if not cut and (found := lead(several)) else start
            tail = _TAIL.match(text, end)
            if ended:
                checks = ["protocol_after_dot_dash_or_slash" if cut else "own_protocol"]
                span = (first, end) if not cut or text[max(0, start - 2) : start - 1].isalpha() and text[start - 2].isascii() else None
            elif not cut:
                checks, span = ["protocol_followed_by_dash_or_slash"], (first, tail.end()) if tail else None
        elif _FAR.fullmatch(gap) and ended and not cut:
            checks = ["protocol_other_separator"]
        if checks:
            yield Sighting(key, tuple(checks), span)


def _registry_ids(text: str) -> Iterator[Sighting]:
    for m in _LONG_NUMBER.finditer(text):
        if m[1]:
            number = re.match(r"0?\d{7,8}", m[2])[0]
            apart = m[1][-1].isspace() and number == m[2]
            yield Sighting(number.lstrip("0"), ("own_nct",) + ("nct_digits_without_prefix",) * apart, (m.start(), m.start(2) + len(number)))
        elif not text[max(0, m.start() - 1) : m.start()].isalpha() or not text[m.start() - 1].isascii():
            yield Sighting(m[2].lstrip("0"), ("nct_digits_without_prefix",) if len(m[2].lstrip("0")) >= 6 else (), None)


def _codes(text: str) -> Iterator[Sighting]:
    for m in _LETTERS_DIGITS.finditer(text):
        key, gap = (m[1] + m[3]).upper(), m[2]
        if _CODE_CLOSE.fullmatch(gap):
            spelled = gap in ("", "-", " ")
            yield Sighting(key, ("own_code",) * (spelled and m[1].isupper() and m[3].upper() == m[3]) + ("own_code_any_case",) * spelled, m.span())
        elif _CODE_FAR.fullmatch(gap):
            yield Sighting(key, ("code_other_separator",), None)


def sightings(text: str, sites: tuple[str, ...] = ()) -> dict[str, Iterator[Sighting]]:
    """All that looks like an identifier, by kind."""
    return {"protocol": _protocols(text, sites), "nct": _registry_ids(text), "code": _codes(text)}


def _own(protocols: Sequence[int], ncts: Sequence[str], codes: Sequence[str]) -> dict[str, set]:
    return {"protocol": set(protocols or ()), "nct": set(ncts or ()), "code": set(codes or ())}


def mask_text(text: str | None, protocols: Sequence[int], ncts: Sequence[str], codes: Sequence[str], sites: tuple[str, ...] = ()) -> tuple[str | None, int, int, int]:
    """The text with its own identifiers replaced, and how many of each kind. A token bounds words, so kinds follow one another."""
    counts = dict.fromkeys(TOKENS, 0)
    for kind, keys in _own(protocols, ncts, codes).items() if text else ():
        found = True
        while found:  # once more after tokens were put in, as they may bound what stood glued to an identifier
            pieces, at = [], 0
            found = [s.span for s in sightings(text, sites)[kind] if s.span and s.key in keys]
            for start, end in found:
                if start >= at:
                    pieces += [text[at:start], TOKENS[kind]]
                    counts[kind], at = counts[kind] + 1, end
            text = "".join([*pieces, text[at:]])
    return text, *counts.values()


def residuals(text: str | None, protocols: Sequence[int], ncts: Sequence[str], codes: Sequence[str], sites: tuple[str, ...] = ()) -> list[str]:
    """The names of the checks that still find an own identifier."""
    own = _own(protocols, ncts, codes)
    found = {check for kind, seen in sightings(text or "", sites).items() for s in seen if s.key in own[kind] for check in s.checks}
    return [name for name in RESIDUAL if name in found]


def masked(text: Column, protocols: Column, ncts: Column, codes: Column, sites: Sequence[str] = ()) -> Column:
    """Struct (text, n_protocol, n_nct, n_code, residual): arrays of own keys in, masked text and counts out. ``sites``: institution names that may stand before a number."""
    sites = tuple(sites)

    @F.pandas_udf("text string, n_protocol int, n_nct int, n_code int, residual array<string>")
    def run(text: pd.Series, protocols: pd.Series, ncts: pd.Series, codes: pd.Series) -> pd.DataFrame:
        rows = []
        for t, p, n, c in zip(text, protocols, ncts, codes, strict=True):
            own = [[] if x is None else list(x) for x in (p, n, c)]
            out = mask_text(t, *own, sites)
            rows.append((*out, residuals(out[0], *own, sites)))
        return pd.DataFrame(rows, columns=["text", "n_protocol", "n_nct", "n_code", "residual"])

    return run(text, protocols, ncts, codes)
