"""Reports merged from month partials that were kept in two rounds: the rows of the reports on all lines."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from checks import billing_checks, usage_checks  # noqa: F401  (their SQL is registered before)
from checks import billing_views as billing
from checks import usage_views as views
from checks.billing_views import MONTHS
from checks.registry import ORACLES, check
from checks.tables import all_within
from cloudtally.operators.partials import Pivot, add_months, merged_report
from cloudtally.plans import invoice_reports, usage, usage_reports
from cloudtally.session import work_folder
from cloudtally.sources.snapshots import load_snapshot, save_snapshot


def _merged(spark: SparkSession, pivot: Pivot, lines: DataFrame, months: list[str]) -> DataFrame:
    folder = f"{work_folder(spark)}/cloudtally-partials/{uuid.uuid4().hex}"
    # As in a run, what both rounds read is worked out once: the months' reduced rows, or those with the values to count.
    if pivot.counted:
        used = dict.fromkeys([pivot.month, *pivot.keys, *[m.source for m in pivot.measures if m.kind != "rows"]])
        rows = pivot.rows(lines).select(*used)
        pivot, month = replace(pivot, rows=lambda kept: kept), pivot.month
    else:
        rows, month = pivot.reduced(lines, months), "_month"
    save_snapshot(rows, folder, "rows")
    saved = load_snapshot(spark, folder, "rows", rows.schema)
    half = len(months) // 2
    for some in (months[half:], months[:half]):
        add_months(pivot, saved.filter(saved[month].isin(some)), some, folder, reduced=not pivot.counted)
    return merged_report(spark, pivot, months, folder)


def _register(name: str, pivot: Callable[[SparkSession, str], Pivot], lines: Callable[[SparkSession, str], DataFrame], months: list[str]) -> None:
    @check(f"merged_{name}", ORACLES[name])
    def _(spark, sf_dir):
        return _merged(spark, pivot(spark, sf_dir), lines(spark, sf_dir), months)


def _invoice_lines(spark, sf_dir):
    return all_within(billing.lines(spark, sf_dir), "billing_month", MONTHS)


def _sheet(number: int) -> Callable[[SparkSession, str], Pivot]:
    return lambda spark, sf_dir: invoice_reports.sheet_pivots(billing.parts(spark, sf_dir))[number]


def _instances(spark, sf_dir):
    return usage.metric_rows(views.instances(spark, sf_dir))


def _accounts(spark, sf_dir):
    return all_within(usage.account_usage(views.account_documents(spark, sf_dir)), "month", MONTHS)


for _name, _pivot in {
    "category_group_summary": lambda *_: invoice_reports.CATEGORY_GROUPS,
    "category_detail": lambda *_: invoice_reports.CATEGORIES,
    "object_storage_detail": lambda *_: invoice_reports.CLASSIC_OBJECT_STORAGE,
    "top_sheet_iaas": _sheet(0),
    "top_sheet_paas": _sheet(1),
    "top_sheet_credit": _sheet(2),
    "hourly_virtual_servers": lambda *_: invoice_reports.server_pivots()[0],
    "monthly_bare_metal": lambda *_: invoice_reports.server_pivots()[3],
}.items():
    _register(_name, _pivot, _invoice_lines, MONTHS)
for _name, _usage_pivot in {
    "virtual_server_summary": usage_reports.VIRTUAL_SERVERS,
    "bare_metal_summary": usage_reports.BARE_METAL_SERVERS,
    "volumes_summary": usage_reports.VOLUMES,
    "kubernetes_summary": usage_reports.CLUSTERS,
}.items():
    _register(_name, lambda *_, p=_usage_pivot: p, _instances, views.WEEKS)
_register("metric_plan_summary", lambda *_: usage_reports.METRIC_PLANS, _accounts, MONTHS)
