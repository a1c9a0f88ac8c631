"""Pivot reports: grouped measures, one column per month, with a grand-total row and column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOTAL_FLAG = "is_total"
TOTAL_COLUMN = "Total"
# Decimals of a finer sum that a report shows: landed doubles carry noise beyond them.
SHOWN_DECIMALS = 11


@dataclass(frozen=True)
class Measure:
    """``kind`` is ``sum``, ``rows`` (row count) or ``distinct`` (distinct values of ``column``)."""

    name: str
    kind: str = "sum"
    column: str | None = None

    @property
    def source(self) -> str:
        return self.column or self.name

    def reduced(self) -> Column:
        """The measure over raw rows. A group of NULLs sums to 0; only a group without rows stays empty."""
        if self.kind == "rows":
            return F.count(F.lit(1)).alias(self.name)
        return F.sum(F.coalesce(F.col(self.source), F.lit(0))).alias(self.name)

    def combined(self) -> Column:
        """The measure over reduced rows."""
        if self.kind == "distinct":
            return F.count_distinct("_counted").alias(self.name)
        return F.sum(self.name).alias(self.name)


def pivot_report(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    month: str | None = None,
    months: Sequence[str] = (),
    total: str | None = "Total",
    fill: bool = True,
    total_of_nothing: bool = False,
) -> DataFrame:
    """Measures per key, and per month if ``month`` is given, in columns ``<measure>_<month>``.

    Rows with a NULL key or month count nowhere; '' is a key like any other. With ``total`` (the label) there is
    one more row, the grand total, marked by ``is_total``, and a ``<measure>_Total`` column; neither holds
    subtotals. Distinct counts in them are counted over the rows, not summed. ``fill`` puts 0 in empty cells.
    ``total_of_nothing`` keeps the total row when no row qualifies. Sums of decimals are exact and come out as
    double. The result is not ordered: see ``in_report_order``.

    The rows are read once and reduced to one per key and month (and counted value) before the first shuffle; body
    and totals are both made of these reduced rows. Distinct counts shuffle by group and value, so that no task
    holds all values of a hot group.
    """
    reduced = reduced_rows(df, keys, measures, month, months)
    return report_of_reduced(reduced, keys, measures, month is not None, months, total, fill, total_of_nothing)


def reduced_rows(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Measure], month: str | None = None, months: Sequence[str] = ()
) -> DataFrame:
    """Rows reduced to one per key and month (``_month``), and per counted value (``_counted``).

    They add up: reduced rows of several inputs make one report, if no line is in two of them.
    """
    counted = {m.source for m in measures if m.kind == "distinct"}
    if len(counted) > 1:
        raise ValueError("distinct counts of one column only")
    keyed = _with_keys(df, [*keys, *([month] if month else [])])
    if month:
        keyed = keyed.filter(F.col(month).isin(list(months)))
    grain = [F.col(c) for c in keys] + ([F.col(month).alias("_month")] if month else [])
    grain += [F.col(c).alias("_counted") for c in counted]
    sums = [m.reduced() for m in measures if m.kind != "distinct"]
    return keyed.groupBy(*grain).agg(*sums) if sums else keyed.select(*grain).distinct()


def with_bitmaps(reduced: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Reduced rows whose counted values are whole numbers, as bitmaps: one row per key, month and bucket of 32,768
    numbers (``_bucket``, ``_bits``). Bitmaps are merged by OR, so totals are counted without their values."""
    grain = [*keys, *(["_month"] if "_month" in reduced.columns else [])]
    bucket = F.bitmap_bucket_number("_counted").alias("_bucket")
    sums = [m.combined() for m in measures if m.kind != "distinct"]
    return reduced.groupBy(*grain, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_counted")).alias("_bits"), *sums)


def report_of_reduced(
    reduced: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    monthly: bool,
    months: Sequence[str] = (),
    total: str | None = "Total",
    fill: bool = True,
    total_of_nothing: bool = False,
) -> DataFrame:
    """The report of ``reduced_rows``, or of ``with_bitmaps``; see ``pivot_report``."""
    if total_of_nothing:
        reduced = reduced.unionByName(_blank_row(reduced))
    flag = []
    if total:
        reduced = _repeat_for_totals(reduced, keys, total, monthly)
        flag = [TOTAL_FLAG]
    if "_bits" in reduced.columns:
        reduced = _counted_bits(reduced, [*keys, *flag, *(["_month"] if monthly else [])], measures)
        measures = [Measure(m.name) for m in measures]
    grouped = reduced.groupBy(*keys, *flag)
    combined = [m.combined() for m in measures]
    if not monthly:
        return _finish(grouped.agg(*combined), [*keys, *flag], [m.name for m in measures], fill)
    slots = [*months, TOTAL_COLUMN] if total else list(months)
    # With one aggregate Spark names the columns after the slot alone.
    padding = [F.lit(0).alias("_")] if len(combined) == 1 else []
    wide = grouped.pivot("_month", slots).agg(*combined, *[F.max(p).alias("_") for p in padding])
    cells = {f"{m.name}_{slot}": f"{slot}_{m.name}" for m in measures for slot in slots}
    return _finish(wide, [*keys, *flag], cells, fill)


def _counted_bits(rows: DataFrame, cell: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row per cell and bucket: its bitmaps merged, then counted; sums added up."""
    merged = rows.groupBy(*cell, "_bucket").agg(
        F.bitmap_or_agg("_bits").alias("_bits"), *[F.sum(m.name).alias(m.name) for m in measures if m.kind != "distinct"]
    )
    # A row without bits (``total_of_nothing``) counts nothing.
    count = F.coalesce(F.bitmap_count("_bits"), F.lit(0).cast("long"))
    return merged.withColumns({m.name: count for m in measures if m.kind == "distinct"}).drop("_bits", "_bucket")


def totals_within(
    df: DataFrame,
    outer: str,
    keys: Sequence[str],
    sums: Sequence[str],
    label: str = "Total",
    always: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """Sums per key within each value of ``outer``, with one total row (``is_total``) per value.

    ``always`` holds a row without keys for each value that has a total row even if no row qualifies. The body can
    be large, so both come from one aggregate over grouping sets: rows are read once and shuffled once. With ``unique``
    there is one row per key and value of ``outer`` already (``reduced_rows``): the body is these rows, not shuffled, and
    they are read once more for the totals.
    """
    rows = _with_keys(df, [outer, *keys]).select(outer, *keys, *sums)
    if unique:
        summed = rows.select(outer, *sums)
        if always is not None:
            summed = summed.unionByName(always)
        totals = summed.groupBy(outer).agg(*[F.sum(c).alias(c) for c in sums]).withColumn(TOTAL_FLAG, F.lit(True))
        whole = rows.withColumn(TOTAL_FLAG, F.lit(False)).unionByName(totals, allowMissingColumns=True)
        labelled = whole.withColumns(_labelled_keys(whole, keys, label, F.col(TOTAL_FLAG)))
        return _finish(labelled, [outer, *keys, TOTAL_FLAG], sums, True)
    if always is not None:
        rows = rows.unionByName(always, allowMissingColumns=True)
    columns = [F.col(c) for c in keys]
    grouped = rows.groupingSets([[F.col(outer), *columns], [F.col(outer)]], F.col(outer), *columns).agg(
        *[F.sum(c).alias(c) for c in sums], (F.grouping(keys[0]) == 1).alias(TOTAL_FLAG)
    )
    grouped = grouped.filter(F.col(TOTAL_FLAG) | F.col(keys[0]).isNotNull())
    labelled = grouped.withColumns(_labelled_keys(grouped, keys, label, F.col(TOTAL_FLAG)))
    return _finish(labelled, [outer, *keys, TOTAL_FLAG], sums, True)


def ordered(report: DataFrame, keys: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Rows in key order, the total last. For the sink only. ``numeric`` keys were numbers before labelling."""
    by = [F.col(k).try_cast("decimal(38,10)") if k in numeric else F.col(k) for k in keys]
    return report.orderBy(*([TOTAL_FLAG] if TOTAL_FLAG in report.columns else []), *by)


def in_report_order(report: DataFrame) -> DataFrame:
    """A pivot in the order of its keys (the columns before the total flag), its totals last, by month if it has one.

    A table without totals stays as it is.
    """
    if TOTAL_FLAG not in report.columns:
        return report
    keys = report.columns[: report.columns.index(TOTAL_FLAG)]
    outer = keys[:1] if keys[0] == "month" else []
    return report.orderBy(*outer, TOTAL_FLAG, *keys[len(outer) :])


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for name in keys:
        df = df.filter(F.col(name).isNotNull())
    return df


def _blank_row(reduced: DataFrame) -> DataFrame:
    """A row without keys and amounts: it gives a total row even if no row qualifies, and no body row."""
    fields = reduced.schema.fields
    return reduced.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def _labelled_keys(df: DataFrame, keys: Sequence[str], label: str, on_total: Column) -> dict[str, Column]:
    """On a total row the first key is the label (so it is text on all rows), the others '' or NULL for a number."""
    first, *others = keys
    out = {first: F.when(on_total, F.lit(label)).otherwise(F.col(first).cast("string"))}
    for name in others:
        blank = F.lit("" if isinstance(df.schema[name].dataType, T.StringType) else None)
        out[name] = F.when(on_total, blank).otherwise(F.col(name))
    return out


def _repeat_for_totals(reduced: DataFrame, keys: Sequence[str], label: str, monthly: bool) -> DataFrame:
    """Each reduced row once for its own cell and once for every total it counts in."""
    own, every = F.lit(False), F.lit(True)
    if monthly:
        cells = [F.struct(f.alias("total"), m.alias("month"))
                 for f in (own, every) for m in (F.col("_month"), F.lit(TOTAL_COLUMN))]
    else:
        cells = [F.struct(f.alias("total")) for f in (own, every)]
    rows = reduced.withColumn("_cell", F.explode(F.array(*cells)))
    rows = rows.filter(F.col("_cell.total") | F.col(keys[0]).isNotNull())
    changed = _labelled_keys(reduced, keys, label, F.col("_cell.total"))
    changed[TOTAL_FLAG] = F.col("_cell.total")
    if monthly:
        changed["_month"] = F.col("_cell.month")
    return rows.withColumns(changed).drop("_cell")


def _finish(wide: DataFrame, keys: Sequence[str], cells, fill: bool) -> DataFrame:
    """Keys and cells in report order (``cells``: output names, or output name -> column); decimals as double."""
    columns = cells if isinstance(cells, dict) else {c: c for c in cells}
    kinds = {f.name: f.dataType for f in wide.schema.fields}
    out = [f"`{k}`" for k in keys]
    for name, column in columns.items():
        kind = "double" if isinstance(kinds[column], (T.DecimalType, T.DoubleType)) else "bigint"
        fine = isinstance(kinds[column], T.DecimalType) and kinds[column].scale > SHOWN_DECIMALS
        shown = f"bround(`{column}`, {SHOWN_DECIMALS})" if fine else f"`{column}`"
        value = f"CAST({shown} AS {kind})"
        out.append(f"coalesce({value}, 0) AS `{name}`" if fill else f"{value} AS `{name}`")
    return wide.selectExpr(*out)
