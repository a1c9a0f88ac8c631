import datetime as dt

import pytest
from pyspark.sql import functions as F

from cloudtally.functions import dates


def local(text):
    return dates.local_time(dates.instant(F.col(text)))


def test_billing_month_turns_on_the_20th_of_local_time(evaluate):
    cases = {
        "2023-01-19T23:59:59-06:00": "2023-01",
        "2023-01-20T00:00:00-06:00": "2023-02",
        "2023-01-20T05:59:59Z": "2023-01",  # still the 19th in local time
        "2023-01-20T06:00:00+0000": "2023-02",
        "2023-07-20T04:59:59Z": "2023-07",  # daylight saving time: five hours
        "2023-07-20T05:00:00Z": "2023-08",
        "2023-12-31T12:00:00-06:00": "2024-01",
        "2024-01-31T12:00:00-06:00": "2024-02",
        "2024-02-29T12:00:00-06:00": "2024-03",
    }
    found = evaluate("t string", [(t,) for t in cases], dates.billing_month(local("t")))
    assert found == list(cases.values())


def test_local_clock_has_the_offset_of_its_season(evaluate):
    times = ["2023-01-15T12:30:00Z", "2023-07-15T02:30:00Z", "not a time", None]
    instant = dates.instant(F.col("t"))
    assert evaluate("t string", [(t,) for t in times], dates.local_clock_text(instant)) == [
        "06:30:00-0600", "21:30:00-0500", None, None,
    ]


def test_local_time_does_not_depend_on_the_session_zone(spark, evaluate):
    times = [("2023-01-20T05:59:59Z",), ("2023-07-20T05:00:00Z",)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        column = F.concat(dates.billing_month(local("t")), F.lit(" "), dates.local_clock_text(dates.instant(F.col("t"))))
        assert evaluate("t string", times, column) == ["2023-01 23:59:59-0600", "2023-08 00:00:00-0500"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_invoice_window(spark):
    first, last = dates.invoice_window("2024-03", "2024-04")
    row = spark.range(1).select(first.cast("string"), last.cast("string")).first()
    assert tuple(row) == ("2024-02-20 06:00:00", "2024-04-20 05:00:00")


def test_month_ranges():
    assert dates.month_list("2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert dates.month_list("2024-02", "2024-01") == []
    assert dates.default_invoice_months(dt.date(2024, 3, 20), 1) == ("2024-03", "2024-03")
    assert dates.default_invoice_months(dt.date(2024, 3, 19), 1) == ("2024-02", "2024-02")
    assert dates.default_invoice_months(dt.date(2024, 1, 5), 3) == ("2023-10", "2023-12")
    assert dates.default_usage_months(dt.date(2024, 1, 5), 2) == ("2023-12", "2024-01")
    assert dates.usage_months_for_invoices("2024-01", "2024-03") == ("2023-11", "2024-01")


@pytest.mark.parametrize(
    ("invoice_type", "tax", "category", "hourly", "expected"),
    [
        ("RECURRING", "PaaS", "x", True, ("2024-02-29", "2024-02-29", "IaaS Usage")),
        ("RECURRING", "PaaS", "x", False, ("2024-01-31", "2024-01-31", "Platform Service Usage")),
        ("RECURRING", "IaaS", "Archive Storage Repository", False, ("2024-02-29", "2024-02-29", "IaaS Usage")),
        ("RECURRING", "IaaS", "x", None, ("2024-03-31", "2024-03-31", "IaaS Monthly")),
        ("NEW", "HELP DESK", "x", False, ("2024-03-31", "2024-03-31", "Support Charges")),
        ("NEW", "IaaS", "x", False, ("2024-03-31", "2024-03-31", "")),
        ("CREDIT", "IaaS", "x", False, ("2024-03-31", "2024-03-31", "")),
        ("RECURRING", "OTHER", "x", False, ("2024-03-31", "2024-03-31", "")),
    ],
)
def test_service_period_rules(spark, invoice_type, tax, category, hourly, expected):
    period = dates.service_period(
        F.lit("2024-03-31 10:00:00").cast("timestamp_ntz"),
        F.lit(invoice_type), F.lit(tax), F.lit(category), F.lit(hourly).cast("boolean"),
    )
    row = spark.range(1).select(period.alias("p")).select("p.*").first()
    assert (str(row[0]), str(row[1]), row[2]) == expected


def test_one_time_charges_end_on_their_day(spark):
    period = dates.service_period(
        F.lit("2024-03-05 10:00:00").cast("timestamp_ntz"), F.lit("ONE-TIME-CHARGE"), F.lit("IaaS"), F.lit("x"), F.lit(False)
    )
    row = spark.range(1).select(period.alias("p")).select("p.*").first()
    assert (str(row[0]), str(row[1])) == ("2024-03-05", "2024-03-05")


def test_provision_dates(evaluate):
    times = ["2023-05-01T23:30:00-0500", "2023-05-01T23:30:00.123Z", "", None]
    assert evaluate("t string", [(t,) for t in times], dates.provision_date(F.col("t"))) == [
        "2023-05-02", "2023-05-01", "", "",
    ]
    assert evaluate("t string", [("2023-05-01T00:30:00-0600",), ("",)], dates.provision_month(F.col("t"))) == [
        "2023-05", "",
    ]


def test_the_cycle_month_reads_the_local_time_once():
    """A filter on the month is pushed down with the whole expression in place of its name."""
    assert str(dates.billing_month(F.col("local_ts"))).count("local_ts") == 1
