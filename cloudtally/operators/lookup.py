"""Keyed dimensions and lookups against them.

No join here carries a broadcast hint: a dimension is as large as its account. Spark broadcasts one only below its
own size limit (``spark.sql.autoBroadcastJoinThreshold``); above it both sides shuffle, and AQE's skew join splits the
rows of a hot key. Where that is not enough, a run may ask for copies of the dimensions, over which hot keys spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts that a run asks for a hot key to be split into, and so the copies made of a dimension row; none if unset.
SPREAD_SETTING = "spark.cloudtally.lookup.spread"


def _pick_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    present = df.filter(_all_present(keys))
    picked = present.groupBy(*keys).agg(
        pick(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_record")
    )
    return picked.select(*keys, *[F.col("_record")[c].alias(c) for c in rest])


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one loaded last. ``order`` must rank the rows of a key without ties.

    An aggregate rather than a window, so that many copies of one key are reduced before the shuffle. If one number
    gives the order (never null), a hash aggregate finds each key's last number from the keys alone, and only the rows
    that have it are fetched; ``df`` is read twice and must read alike, as a written table does. The keys are shuffled and
    hashed at any size: there are as many as records, and a written table looks much smaller than they are in the
    driver's memory. Any other order is found in one read, by an aggregate that sorts.
    """
    if len(order) == 1 and isinstance(df.schema[order[0]].dataType, T.NumericType):
        present = df.filter(_all_present(keys))
        last = present.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(order[0]).alias("_last"))
        same = F.col(order[0]) == F.col("_last")
        for key in keys:
            same = same & (F.col(key) == F.col(f"_{key}"))
        return present.join(last.hint("shuffle_hash"), same, "left_semi")
    return _pick_by_key(df, keys, order, F.max_by)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick_by_key(df, keys, order, F.min_by)


def _all_present(columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str | Column,
    right_key: str,
    take: dict[str, str] | Sequence[str],
    spread: Sequence[str | Column] | None = None,
    how: str = "left",
    hashed: bool = False,
) -> DataFrame:
    """Add columns of a dimension that is unique by ``right_key``; NULL on a miss (or no row with ``how='inner'``).

    ``take`` maps dimension columns to output names. ``spread`` names left columns that differ between the rows
    of one key: if the session asks for it (``SPREAD_SETTING``), their hash picks one of several copies of the
    dimension, so that the rows of a hot key (or of the NULL key) go to that many tasks. The hash depends on the row
    alone, so a task that is run again gives the same rows.

    ``hashed`` is for dimensions that grow with the rows: both sides are shuffled at any size, and the dimension's part
    of each task is hashed, so that the rows are neither sorted nor spilled. If the dimension's key is taken, Spark knows
    that the rows lie by it: groups that have it among their keys need no further shuffle.
    """
    if not isinstance(take, dict):
        take = {name: name for name in take}
    key = F.col(left_key) if isinstance(left_key, str) else left_key
    rows = left.withColumn("_left_key", key)
    named = [n for c, n in take.items() if c == right_key]
    dimension = right.select(F.col(right_key).alias("_key"), *[F.col(c).alias(n) for c, n in take.items() if n not in named])
    if hashed:
        dimension = dimension.hint("shuffle_hash")
    copies = int(left.sparkSession.conf.get(SPREAD_SETTING, "1"))
    if not spread or copies < 2:
        joined = rows.join(dimension, F.col("_left_key") == F.col("_key"), how)
        return joined.withColumns({n: F.col("_key") for n in named}).drop("_left_key", "_key")
    dimension = dimension.withColumn("_copy", F.explode(F.array(*[F.lit(i) for i in range(copies)])))
    rows = rows.withColumn("_left_copy", F.pmod(F.xxhash64(*spread), F.lit(copies)).cast("int"))
    joined = rows.join(
        dimension, (F.col("_left_key") == F.col("_key")) & (F.col("_left_copy") == F.col("_copy")), how
    )
    return joined.withColumns({n: F.col("_key") for n in named}).drop("_left_key", "_left_copy", "_key", "_copy")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column (the months a report covers)."""
    return df.select(column).distinct()
