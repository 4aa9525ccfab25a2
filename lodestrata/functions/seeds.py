"""Ages that a prose seed ties to a diagnosis or to another dated fact.

A seed becomes a list of mentions: an age, the text between it and whatever bounds it before (an age or
the end of a sentence), and the text up to the next bound. Cues are looked up in those two stretches, and
a short list of rules says what each mention is.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# How an age is introduced, and the words that say what happened at it.
AGE = r"\b(at\s+(?:(?:the\s+)?age\s+(?:of\s+)?)?|aged\s+|ages?\s+(?:of\s+)?)(-?\d+(?:\.\d+)?) years?(?: and (-?\d+(?:\.\d+)?) weeks?)?"
DIAGNOSIS = r"diagnosed|diagnosis|diagnoses"
RETURN = r"progress\w*|recurr\w*|relaps\w*"
OTHER = (
    r"completed|finished|began|started|received|underwent|stopped|discontinued|administered|initiated|treated|resected|implanted|"
    r"performed|transplant(?:ation)?|\w*ectomy|current(?:ly)?|status|remission|response|menopause|scan|imaging|CT|MRI"
)
_BOUND = re.compile(rf"(?:{AGE})|[;.!?](?=\s|$)", re.I)
_CUE = re.compile(rf"\b(?:({DIAGNOSIS})|({RETURN})|(?:{OTHER}))\b", re.I)


class Mention(NamedTuple):
    years: str
    weeks: str | None
    says_age: bool
    before: str
    after: str

    def cue(self) -> str | None:
        """diagnosis, return or other: what the last cue before the age says, or, if nothing at all stands there, the first one after it."""
        found = list(_CUE.finditer(self.before))[-1:] or ([] if self.before.strip(" ,:") else list(_CUE.finditer(self.after))[:1])
        return next(("diagnosis" if m[1] else "return" if m[2] else "other" for m in found), None)


def mentions(seed: str) -> list[Mention]:
    """All ages of a seed in their order."""
    bounds = list(_BOUND.finditer(seed))
    edges = [0, *(m.end() for m in bounds)]
    limits = [*(m.start() for m in bounds[1:]), len(seed)]
    return [Mention(m[2], m[3], "age" in m[1].lower(), seed[edge : m.start()], seed[m.end() : limit]) for m, edge, limit in zip(bounds, edges, limits) if m[2]]


def age_anchors(seed: str) -> tuple[set, set, int]:
    """(ages of diagnoses, other ages) as (years, weeks), and how many were ambiguous intervals; an error if an age isn't whole.

    A return at less than an age of diagnosis named before it, without the word age, may be an interval
    since the diagnosis and is only counted.
    """
    found = mentions(seed)
    whole = [m for m in found if m.years.isdigit() and (m.weeks or "").isdigit() and int(m.weeks) <= 51]
    if not found or len(whole) < len(found):
        raise ValueError("give each age in whole years and weeks from 0 to 51")
    kinds: dict[str, list] = {"diagnosis": [], "interval": [], "other": []}
    for m in whole:
        age, cue = (int(m.years), int(m.weeks)), m.cue()
        shorter = any(age < d for d in kinds["diagnosis"])
        kind = "interval" if cue == "return" and shorter and not m.says_age else "diagnosis" if cue == "diagnosis" else "other"
        kinds[kind].append(age)
    return set(kinds["diagnosis"]), set(kinds["other"]), len(kinds["interval"])


def anchors(seed: Column) -> Column:
    """Struct (diagnoses, others, intervals, error) of each seed, ages as 'years+weeks' in order."""

    @F.pandas_udf("diagnoses array<string>, others array<string>, intervals int, error string")
    def run(seeds: pd.Series) -> pd.DataFrame:
        rows = []
        for s in seeds:
            try:
                d, o, n = age_anchors(s or "")
                rows.append((*([f"{y}+{w}" for y, w in sorted(x)] for x in (d, o)), n, None))
            except ValueError as e:
                rows.append((None, None, None, str(e)))
        return pd.DataFrame(rows, columns=["diagnoses", "others", "intervals", "error"])

    return run(seed)
