"""Joins of many rows with one row per key, for keys of any frequency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 4
BROADCAST_ROWS = 100_000


def join_per_key(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str, null_safe: Sequence[str] = ()
) -> DataFrame:
    """``left``, ``left_semi`` or ``left_anti`` join of rows with an aggregate that has one row per key.

    Rows of a key are dealt out to a few salts, and the small aggregate rows are repeated for each. Apart
    from spreading a frequent key, this puts the aggregate behind an exchange of its own. AQE splits skewed
    partitions only where both sides of a join are plain exchanges; an aggregate that is already
    partitioned by the join key would keep it from doing so.
    """
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*_spread_columns(rows, keys)), F.lit(SALTS)).cast("int"))
    salts = F.array(*[F.lit(n) for n in range(SALTS)])
    repeated = per_key.withColumn("_salt", F.explode(salts))
    if null_safe:  # nulls in these columns meet, as they do in groups; the others let filters reach both sides
        other = repeated.withColumnsRenamed({name: f"_k{i}" for i, name in enumerate(keys)} | {"_salt": "_salt2"})
        same = F.col("_salt") == F.col("_salt2")
        for i, name in enumerate(keys):
            other_key = F.col(f"_k{i}")
            same = same & (F.col(name).eqNullSafe(other_key) if name in null_safe else F.col(name) == other_key)
        return dealt.join(other, same, how).drop("_salt", "_salt2", *[f"_k{i}" for i in range(len(keys))])
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def _spread_columns(rows: DataFrame, keys: Sequence[str]) -> list[str]:
    """Row columns whose hash differs within a key: the offset where there is one, else all plain columns."""
    if "offset" in rows.columns:
        return ["offset"]
    plain = [name for name, kind in rows.dtypes if name not in keys and not kind.startswith(("map", "variant"))]
    return plain or list(keys)


def bounded_broadcast(small: DataFrame) -> DataFrame:
    """Marks a side for broadcast after counting it; a bigger one is left to the optimizer."""
    return F.broadcast(small) if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else small
