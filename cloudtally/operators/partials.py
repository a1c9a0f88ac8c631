"""Month partials: what a month adds to a pivot, kept, so that a report reads the lines of new months alone.

A partial is the pivot's rows reduced to one per key and month. Partials of any months make a report together, the same
as that of all their lines: sums are decimals, and distinct values are kept as bitmaps of their codes, merged by OR.
``<folder>/<pivot>`` holds them in partitions by month; a month that is built again replaces its partition. Months are
listed beside it, and a month that is being built is not, so that no report is made of half of one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cloudtally.operators.pivot import Measure, pivot_report, reduced_rows, report_of_reduced, totals_within, with_bitmaps
from cloudtally.sources import folders

_SCHEMA = "schema.json"
_MONTHS = "months"


@dataclass(frozen=True)
class Pivot:
    """A report by month: ``rows`` picks and prepares its lines; the rest as in ``pivot_report``.

    With ``within`` the month is not spread over columns but the first key, with a total row of its own
    (``totals_within``); measures are then sums.
    """

    name: str
    rows: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    measures: Sequence[Measure]
    month: str
    total: str | None = "Total"
    fill: bool = True
    within: bool = False
    empty_months: bool = False

    @property
    def counted(self) -> str | None:
        return next((m.source for m in self.measures if m.kind == "distinct"), None)

    def reduced(self, lines: DataFrame, months: Sequence[str]) -> DataFrame:
        """The lines of ``months``, reduced to one row per key and month; of a pivot that counts no distinct values."""
        if self.counted:
            raise ValueError(f"{self.name} counts distinct values, which get their codes round by round")
        return reduced_rows(self.rows(lines), self.keys, self.measures, self.month, months)

    def report(self, lines: DataFrame, months: Sequence[str]) -> DataFrame:
        """The report of all lines."""
        if self.within:
            return self._sheets(self.rows(lines).filter(F.col(self.month).isin(list(months))), months)
        return pivot_report(self.rows(lines), self.keys, self.measures, self.month, months, self.total, self.fill)

    def _sheets(self, rows: DataFrame, months: Sequence[str], unique: bool = False) -> DataFrame:
        names = [m.name for m in self.measures]
        always = None
        if self.empty_months:
            months_of = F.explode(F.array(*[F.lit(m) for m in months])).alias(self.month)
            blanks = [F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in names]
            always = rows.sparkSession.range(1).select(months_of).select(self.month, *blanks)
        return totals_within(rows, self.month, self.keys, names, self.total, always, unique)


def dictionary(df: DataFrame, column: str, folder: str) -> DataFrame:
    """``value`` and ``code`` of all values of a column seen so far: new ones get the next whole numbers.

    Codes are dense, so few buckets hold many values. They are kept in ``folder`` and never change.
    """
    spark, schema = df.sparkSession, f"value {df.schema[column].dataType.simpleString()}, code long"
    known = spark.read.schema(schema).parquet(folder) if folders.exists(spark, folder) else spark.createDataFrame([], schema)
    new = df.select(F.col(column).alias("value")).filter("value is not null").distinct()
    new = new.join(known, "value", "left_anti").withColumn("place", F.monotonically_increasing_id())
    batch = f"{folder}.new"
    new.write.mode("overwrite").parquet(batch)
    new = spark.read.schema(f"{schema.partition(',')[0]}, place long").parquet(batch)
    # One row per task of the write.
    part = F.shiftright("place", 33).alias("part")
    counts = sorted(tuple(r) for r in new.groupBy(part).agg(F.count("*")).collect())
    begin, offsets = (known.agg(F.max("code")).first()[0] or 0) + 1, []
    for number, count in counts:
        offsets.append((number, begin))
        begin += count
    if offsets:
        starts = spark.createDataFrame(offsets, "part long, begin long")
        within = F.col("place") - F.shiftleft(F.col("part"), 33)
        coded = new.withColumn("part", part).join(F.broadcast(starts), "part")
        coded.select("value", (F.col("begin") + within).cast("long").alias("code")).write.mode("append").parquet(folder)
    folders.delete(spark, batch)
    return spark.read.schema(schema).parquet(folder) if folders.exists(spark, folder) else known


def add_months(pivot: Pivot, lines: DataFrame, months: Sequence[str], folder: str, reduced: bool = False) -> None:
    """Keep the partials of ``months``, built from ``lines``, which hold all lines of these months.

    With ``reduced``, ``lines`` are what ``Pivot.reduced`` made of them, for several rounds at once.
    """
    spark, path = lines.sparkSession, f"{folder}/{pivot.name}"
    if reduced:
        reduced = lines.filter(F.col("_month").isin(list(months)))
    else:
        rows = pivot.rows(lines)
        if pivot.counted:
            codes = dictionary(rows, pivot.counted, f"{path}.codes")
            rows = rows.join(codes, F.col(pivot.counted) == F.col("value"), "left").drop(pivot.counted, "value")
            rows = rows.withColumnRenamed("code", pivot.counted)
        reduced = reduced_rows(rows, pivot.keys, pivot.measures, pivot.month, months)
        if pivot.counted:
            reduced = with_bitmaps(reduced, pivot.keys, pivot.measures)
    known = {*kept_months(spark, pivot, folder), *months}
    # Months count as kept when all of them are written; one without lines has no partition.
    folders.write_text(spark, f"{path}.{_MONTHS}", "\n".join(sorted(known - set(months))))
    for month in months:
        folders.delete(spark, f"{path}/_month={month}")
    reduced.write.mode("append").partitionBy("_month").parquet(path)
    folders.write_text(spark, f"{path}.{_SCHEMA}", reduced.schema.json())
    folders.write_text(spark, f"{path}.{_MONTHS}", "\n".join(sorted(known)))


def kept_months(spark: SparkSession, pivot: Pivot, folder: str) -> list[str]:
    """Months whose partials are kept."""
    text = folders.read_text(spark, f"{folder}/{pivot.name}.{_MONTHS}")
    return text.split("\n") if text else []


def merged_report(spark: SparkSession, pivot: Pivot, months: Sequence[str], folder: str) -> DataFrame:
    """The report of kept months, from their partials alone."""
    missing = sorted(set(months) - set(kept_months(spark, pivot, folder)))
    if missing:
        raise ValueError(f"no partials of {pivot.name} for {', '.join(missing)}")
    schema = StructType.fromJson(json.loads(folders.read_text(spark, f"{folder}/{pivot.name}.{_SCHEMA}")))
    rows = spark.read.schema(schema).parquet(f"{folder}/{pivot.name}").filter(F.col("_month").isin(list(months)))
    if pivot.within:
        # A month's partials are reduced together, so a key has one row in it.
        return pivot._sheets(rows.withColumnRenamed("_month", pivot.month), months, unique=True)
    return report_of_reduced(rows, pivot.keys, pivot.measures, True, months, pivot.total, pivot.fill)
