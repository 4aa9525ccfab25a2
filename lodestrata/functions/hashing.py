"""Reproducible hash draws: the same in Spark and in any engine that has SHA-256."""

from __future__ import annotations

import hashlib
import uuid

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(parts: tuple, sep: str = ":") -> Column:
    return F.concat_ws(sep, *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts))


def digest(*parts) -> Column:
    """SHA-256 in hex of the parts, joined by colons; a null part is left out."""
    return F.sha2(_joined(parts), 256)


def hash_fraction(*parts) -> Column:
    """A draw in [0, 1): the first 15 hex digits of the digest over 16**15."""
    return F.conv(F.substring(digest(*parts), 1, 15), 16, 10).cast("double") / F.lit(float(16**15))


def hash_partition(n: int, *parts) -> Column:
    """A partition 0..n-1: the first 8 hex digits of the digest modulo n."""
    return (F.conv(F.substring(digest(*parts), 1, 8), 16, 10).cast("long") % n).cast("int")


def pair_hash(*parts) -> Column:
    """An unsigned 64-bit key: the first 16 hex digits of the digest."""
    return F.conv(F.substring(digest(*parts), 1, 16), 16, 10).cast("decimal(20,0)")


def split_of(fraction: Column, train: float = 0.8, validation: float = 0.1) -> Column:
    """train, val or test by a draw in [0, 1)."""
    return F.when(fraction < train, "train").when(fraction < train + validation, "val").otherwise("test")


def blake_fraction(*parts: Column) -> Column:
    """A draw in [0, 1) from the 64-bit BLAKE2b of the parts, joined by NUL (for tables drawn that way elsewhere)."""
    @F.pandas_udf("double")
    def run(joined: pd.Series) -> pd.Series:
        return joined.map(lambda x: None if x is None else int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") / 2**64).astype("float64")

    return run(F.concat_ws("\x00", *(p.cast("string") for p in parts)))


def name_uuid(namespace: str, *parts: Column) -> Column:
    """Version 5 UUIDs of the parts, joined by colons, under a namespace UUID."""
    space = uuid.UUID(namespace)

    @F.pandas_udf("string")
    def run(joined: pd.Series) -> pd.Series:
        return joined.map(lambda x: str(uuid.uuid5(space, x)))

    return run(F.concat_ws(":", *(p.cast("string") for p in parts)))


def stepped_dates(start: Column, low: int, high: int, partition: list[str], order: list, *seed) -> Column:
    """Dates that begin at ``start`` and go on by hash-drawn gaps of low..high days."""
    from pyspark.sql import Window

    w = Window.partitionBy(*partition).orderBy(*order)
    gap = (F.floor(hash_fraction(*seed) * (high - low + 1)) + low).cast("int")
    counted = F.when(F.row_number().over(w) == 1, 0).otherwise(gap)
    return F.date_add(start, F.sum(counted).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("int"))
