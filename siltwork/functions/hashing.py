"""Row hashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what stands for NULL in a hashed row, so that NULL and the empty text differ.
NULL_MARK = "\x1fNULL"


def log_id(*columns: str) -> Column:
    """The id of a log's row, from the columns that tell it apart."""
    return F.xxhash64(F.concat_ws("|", *(F.col(c).cast("string") for c in columns)))


def row_hash(columns: Iterable[str], exclude: Iterable[str] = (), sep: str = "|") -> Column:
    """MD5 of the columns as text, in the order of their names, NULL as NULL_MARK."""
    out = set(exclude)
    names = sorted(c for c in columns if c not in out)
    if not names:
        raise ValueError("no column is left to hash")
    return F.md5(F.concat_ws(sep, *(F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in names)).cast("binary"))
