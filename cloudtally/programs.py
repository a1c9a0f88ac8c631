"""The reports end to end: landed responses in, one dataset per report out.

Each program writes its core table once into the shared work folder (partitioned by month where it has one) and
builds all selected reports from that table, so that no report repeats the joins and a lost executor costs no more than
the tasks it ran. Joined dimensions are written too: Spark then knows their size when it plans the lookups. These tables
go when the program ends; with ``keep``, a folder, the core tables stay there as a saved run, and with ``saved``, the
folder of such a run, a program reads them instead of the landing and reports on the months that they hold.

With ``store``, a folder that ``compact_landing`` fills, a program reads only the partitions of its months from there, and
the dimensions that are kept there; ``RunInfo`` then tells how many landed lines of each entity were rejected.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.functions.dates import (
    BILLING_ZONE,
    add_month_text,
    default_invoice_months,
    default_usage_months,
    month_list,
    usage_months_for_invoices,
)
from cloudtally.operators.lookup import distinct_values, latest_by_key
from cloudtally.operators.partials import add_months, kept_months, merged_report
from cloudtally.plans import inventory, storage, usage
from cloudtally.plans.invoice_lines import invoice_lines
from cloudtally.plans.invoice_reports import invoice_pivots, invoice_report_set
from cloudtally.plans.usage_reports import billing_usage_report_set, usage_report_set
from cloudtally.sources.landing import (
    LOAD_ORDER,
    read_accounts,
    read_entity,
    read_in_load_order,
    read_latest,
    read_part_descriptions,
)
from cloudtally.sources.runs import Run, program_run, sweep
from cloudtally.sources.snapshots import new_run, write_reports
from cloudtally.sources.store import Compacted, compact, has_dimension, read_dimension, read_months, rejected_lines


SERVER_REPORT = "ServerReport"


def _billing_day(now: dt.datetime) -> dt.date:
    """The day of ``now`` (UTC unless it says otherwise) where billing takes place."""
    at = now if now.tzinfo else now.replace(tzinfo=dt.timezone.utc)
    return at.astimezone(ZoneInfo(BILLING_ZONE)).date()


def _asked(start: str | None, end: str | None, default: tuple[str, str]) -> tuple[str, str]:
    return start or default[0], end or default[1]


def compact_landing(
    spark: SparkSession, landing: str, store: str, max_rejects: int = 0, dimensions: bool = False
) -> dict[str, Compacted]:
    """Take landed pages that are new into the programs' ``store``: invoices and usage by month, and with
    ``dimensions`` the entities with a key. Up to ``max_rejects`` lines of an entity may be left out as unreadable."""
    sweep(spark)
    return compact(spark, landing, store, max_rejects, dimensions)


def _by_month(spark: SparkSession, landing: str, store: str | None, entity: str, first: str, last: str) -> DataFrame:
    return read_months(spark, store, entity, first, last) if store else read_entity(spark, landing, entity)


class _Dimensions:
    """Keyed entities: from the store where it has them, else from all landed pages."""

    def __init__(self, run: Run, landing: str, store: str | None):
        self.run, self.landing, self.store = run, landing, store

    def _kept(self, entity: str) -> bool:
        return bool(self.store) and has_dimension(self.run.spark, self.store, entity)

    def latest(self, entity: str, key: str) -> DataFrame:
        if self._kept(entity):
            return read_dimension(self.run.spark, self.store, entity)
        return read_latest(self.run.spark, self.landing, entity, key, f"{self.run.staging}/latest")

    def in_load_order(self, entity: str) -> DataFrame:
        """Of a kept entity the latest records alone, which is all that the order decides."""
        if self._kept(entity):
            return read_dimension(self.run.spark, self.store, entity, load_columns=True)
        return read_in_load_order(self.run.spark, self.landing, entity)


def _rejected(spark: SparkSession, store: str | None, entities: Iterable[str]) -> dict[str, int] | None:
    return {e: rejected_lines(spark, store, e) for e in entities} if store else None


def _report_months(saved: DataFrame, column: str, start: str, end: str) -> list[str]:
    """The months asked for and any other the table holds: an invoice at the very end of the window bills one month
    later. A table holds at most one month more than its window, and the column is its partition column."""
    held = {row[0] for row in distinct_values(saved, column).filter(F.col(column).isNotNull()).collect()}
    return sorted(held | set(month_list(start, end)))


def invoice_analysis(
    spark: SparkSession,
    landing: str,
    output: str,
    start: str | None,
    end: str | None,
    now: dt.datetime,
    reports: Iterable[str] | None = None,
    storage_notes: bool = False,
    part_file: str | None = None,
    file_format: str = "parquet",
    child_one_time: str = "repeat",
    parents_only: bool = False,
    months: int = 1,
    store: str | None = None,
    keep: str | None = None,
    saved: str | None = None,
) -> dict[str, str]:
    """Invoice reports for the billing cycles ``start`` .. ``end`` (``YYYY-MM``).

    Without them, for the last ``months`` closed cycles as of ``now``. ``child_one_time`` and ``parents_only`` are those
    of ``invoice_lines``. With ``store``, a folder that ``compact_landing`` wrote, only these months are read (and the
    one after, in which an invoice at the very end of the window falls).
    """
    name = new_run(now)
    start, end = _asked(start, end, default_invoice_months(_billing_day(now), months))
    with program_run(spark, "invoice_analysis", name, keep, saved, start=start, end=end) as run:
        start, end = run.facts["start"], run.facts["end"]
        cycles = start, add_month_text(end, 1)

        def built_lines() -> DataFrame:
            return invoice_lines(
                _by_month(spark, landing, store, "invoices", *cycles),
                _by_month(spark, landing, store, "invoice_items", *cycles),
                read_entity(spark, landing, "network_storage") if storage_notes else None,
                start, end, child_one_time, not parents_only, whole=True,
            )

        lines = run.table("invoice_lines", built_lines, "billing_month")
        built = invoice_report_set(
            lines,
            run.table("part_descriptions", lambda: read_part_descriptions(spark, part_file)),
            _report_months(lines, "billing_month", start, end),
            run.table("account", lambda: read_entity(spark, landing, "account")),
            run.table("classic_users", lambda: read_entity(spark, landing, "classic_users")),
        )
        rejected = _rejected(spark, store, ("invoices", "invoice_items"))
        return write_reports(built, output, now, reports, file_format, name, rejected)


def _spans(months: Iterable[str]) -> list[tuple[str, str]]:
    """Months as spans without gaps."""
    out: list[tuple[str, str]] = []
    for month in sorted(months):
        if out and add_month_text(out[-1][1], 1) == month:
            out[-1] = out[-1][0], month
        else:
            out.append((month, month))
    return out


def invoice_summaries(
    spark: SparkSession,
    landing: str,
    output: str,
    start: str | None,
    end: str | None,
    now: dt.datetime,
    partials: str,
    reports: Iterable[str] | None = None,
    refresh: Iterable[str] = (),
    part_file: str | None = None,
    file_format: str = "parquet",
    months: int = 1,
    store: str | None = None,
) -> dict[str, str]:
    """The invoice pivots of ``invoice_analysis`` from month partials that are kept in ``partials``.

    Lines are read of the months alone that have no partials yet, or are named in ``refresh`` (an open month).
    """
    name = new_run(now)
    wanted = month_list(*_asked(start, end, default_invoice_months(_billing_day(now), months)))
    with program_run(spark, "invoice_summaries", name) as run:
        pivots = invoice_pivots(run.table("part_descriptions", lambda: read_part_descriptions(spark, part_file)))
        known = [pivot.name for pivot in pivots]
        unknown = [r for r in reports or () if r not in known]
        if unknown:
            raise ValueError(f"unknown reports: {', '.join(unknown)}")
        pivots = [p for p in pivots if reports is None or p.name in set(reports)]
        todo = {p.name: (set(wanted) - set(kept_months(spark, p, partials))) | (set(refresh) & set(wanted)) for p in pivots}
        for first, last in _spans(set().union(*todo.values())):
            lines = run.table(
                f"lines_{first}",
                lambda: invoice_lines(
                    _by_month(spark, landing, store, "invoices", first, add_month_text(last, 1)),
                    _by_month(spark, landing, store, "invoice_items", first, add_month_text(last, 1)),
                    None, first, last,
                ),
                "billing_month",
            )
            for pivot in pivots:
                new = [m for m in month_list(first, last) if m in todo[pivot.name]]
                if new:
                    add_months(pivot, lines, new, partials)
        built = {p.name: lambda p=p: merged_report(spark, p, wanted, partials) for p in pivots}
        rejected = _rejected(spark, store, ("invoices", "invoice_items"))
        return write_reports(built, output, now, None, file_format, name, rejected)


def invoice_usage(
    spark: SparkSession,
    landing: str,
    output: str,
    start: str | None,
    end: str | None,
    now: dt.datetime,
    reports: Iterable[str] | None = None,
    file_format: str = "parquet",
    months: int = 1,
    store: str | None = None,
    keep: str | None = None,
    saved: str | None = None,
) -> dict[str, str]:
    """Usage behind the invoices of the cycles ``start`` .. ``end``: it took place two months earlier."""
    name = new_run(now)
    start, end = _asked(start, end, default_invoice_months(_billing_day(now), months))
    months = month_list(*usage_months_for_invoices(start, end))
    with program_run(spark, "invoice_usage", name, keep, saved, months=months) as run:
        months = run.facts["months"]
        wanted = F.col("month").isin(months)
        dimensions = _Dimensions(run, landing, store)

        def usage_of(entity: str) -> DataFrame:
            return _by_month(spark, landing, store, entity, months[0], months[-1]).filter(wanted)

        def built_instances() -> DataFrame:
            resources, tags = dimensions.latest("resources", "crn"), dimensions.latest("tags", "crn")
            return usage.metric_rows(usage.billing_instances(usage_of("instance_usage"), resources, tags))

        account = run.table("account_usage", lambda: usage.account_usage(usage_of("account_usage")), "month")
        built = billing_usage_report_set(account, run.table("billing_instances", built_instances, "month"), months)
        rejected = _rejected(spark, store, ("account_usage", "instance_usage"))
        return write_reports(built, output, now, reports, file_format, name, rejected)


def usage_report(
    spark: SparkSession,
    landing: str,
    output: str,
    start: str | None,
    end: str | None,
    now: dt.datetime,
    reports: Iterable[str] | None = None,
    file_format: str = "parquet",
    months: int = 1,
    store: str | None = None,
    keep: str | None = None,
    saved: str | None = None,
) -> dict[str, str]:
    """Account and instance usage reports for the months ``start`` .. ``end``; without them the last ``months``."""
    name = new_run(now)
    months = month_list(*_asked(start, end, default_usage_months(_billing_day(now), months)))
    with program_run(spark, "usage_report", name, keep, saved, months=months) as run:
        months = run.facts["months"]
        wanted = F.col("month").isin(months)
        dimensions = _Dimensions(run, landing, store)

        def usage_of(entity: str) -> DataFrame:
            return _by_month(spark, landing, store, entity, months[0], months[-1]).filter(wanted)

        def built_users() -> DataFrame:
            roles = read_in_load_order(spark, landing, "user_roles").withColumn("place", F.struct(*LOAD_ORDER))
            return usage.cloud_users(dimensions.latest("cloud_users", "iam_id"), roles, "place")

        def built_instances() -> DataFrame:
            servers = latest_by_key(
                usage.union_servers(
                    dimensions.in_load_order("virtual_servers"), dimensions.in_load_order("bare_metal_servers")
                ),
                ["crn"],
                ["bare_metal", *LOAD_ORDER],
            ).drop(*LOAD_ORDER)
            dimension = usage.instance_dimension(
                dimensions.latest("resources", "crn"),
                dimensions.latest("tags", "crn"),
                users,
                servers,
                dimensions.latest("images", "id"),
                dimensions.latest("initializations", "id"),
            )
            named = usage.named_clusters(dimensions.latest("clusters", "id"), dimensions.latest("vpcs", "id"))
            clusters = run.table("clusters", lambda: named)
            return usage.metric_rows(
                usage.enriched_instances(
                    usage_of("instance_usage"),
                    run.table("instance_dimension", lambda: dimension),
                    clusters,
                    run.table(
                        "workers",
                        lambda: usage.named_workers(
                            dimensions.latest("workers", "id"), clusters, dimensions.latest("subnets", "id")
                        ),
                    ),
                )
            )

        users = run.table("users", built_users)
        account = run.table("account_usage", lambda: usage.account_usage(usage_of("account_usage")), "month")
        built = usage_report_set(account, run.table("instances", built_instances, "month"), months, users)
        rejected = _rejected(spark, store, ("account_usage", "instance_usage"))
        return write_reports(built, output, now, reports, file_format, name, rejected)


def hardware_inventory(
    spark: SparkSession,
    landing: str,
    output: str,
    now: dt.datetime,
    reports: Iterable[str] | None = None,
    file_format: str = "parquet",
    store: str | None = None,
    keep: str | None = None,
    saved: str | None = None,
) -> dict[str, str]:
    """Inventory tables and counts, and the server report as text files that read on from one to the next."""
    name = new_run(now)
    with program_run(spark, "hardware_inventory", name, keep, saved) as run:
        dimensions = _Dimensions(run, landing, store)
        hardware = run.table("hardware", lambda: dimensions.latest("hardware", "id"))
        trunks = run.table("trunks", lambda: read_entity(spark, landing, "trunks"))
        built = inventory.inventory_report_set(hardware, trunks)
        wanted = [*built, SERVER_REPORT] if reports is None else list(reports)
        paths = write_reports(built, output, now, [r for r in wanted if r != SERVER_REPORT], file_format, name)
        if keep or SERVER_REPORT in wanted:
            allowed = run.table("allowed_storage", lambda: dimensions.latest("allowed_storage", "id"))
        if SERVER_REPORT in wanted:
            lines = inventory.server_report(hardware, trunks, allowed)
            text = {SERVER_REPORT: lambda: lines.orderBy("id", "section", "line").select("value")}
            paths |= write_reports(text, output, now, file_format="text", run=name)
        return paths


def account_storage(
    spark: SparkSession, landing: str, account_file: str, output: str, now: dt.datetime, store: str | None = None
) -> dict[str, str]:
    """Storage of each listed account as JSON records, and a summary of the accounts that failed."""
    name = new_run(now)
    with program_run(spark, "account_storage", name) as run:
        dimensions = _Dimensions(run, landing, store)
        accounts = read_accounts(spark, account_file)
        errors = read_entity(spark, landing, "fetch_errors")
        allowed = run.table("allowed_storage", lambda: dimensions.latest("allowed_storage", "id"))
        built = {
            "HardwareStorage": lambda: storage.account_records(accounts, allowed, errors),
            "AccountSummary": lambda: storage.account_summary(accounts, errors),
        }
        return write_reports(built, output, now, file_format="json", run=name)
