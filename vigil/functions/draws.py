"""Deterministic uniform draws from md5.

u(parts) = int(first 8 hex digits of md5("p1:p2:...")) / 2**32, in [0, 1).
The same value comes out of a Spark column, plain Python and a SQL engine with
md5, so sampled rows and random splits can be rebuilt and checked anywhere, and
do not depend on partitioning.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def md5_hex(*parts) -> Column:
    return F.md5(_key(parts))


def uniform(*parts) -> Column:
    """Column in [0, 1) drawn from md5 of the ':'-joined parts."""
    return F.conv(F.substring(md5_hex(*parts), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def py_uniform(*parts) -> float:
    h = hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()
    return int(h[:8], 16) / TWO_32


def sql_uniform(*parts: str) -> str:
    """The same draw as a DuckDB SQL expression; parts are SQL expressions."""
    key = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0)"


def integer(lo: int, hi: int, *parts) -> Column:
    """Column of whole numbers lo..hi, both included."""
    return (F.lit(lo) + F.floor(uniform(*parts) * (hi - lo + 1))).cast("long")


def choice(values: list, *parts) -> Column:
    """Column of one of `values`, each as likely."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(uniform(*parts) * len(values)) + 1).cast("int"))


def sql_integer(lo: int, hi: int, *parts: str) -> str:
    return f"CAST({lo} + floor({sql_uniform(*parts)} * {hi - lo + 1}) AS BIGINT)"


def sql_choice(values: list[str], *parts: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST(floor({sql_uniform(*parts)} * {len(values)}) AS INTEGER) + 1]"
