"""Billing calendar: local time, billing month, windows and service periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BILLING_ZONE = "US/Central"
CUTOFF_DAY = 19
USAGE_LAG_MONTHS = 2


def instant(text: Column) -> Column:
    """ISO-8601 text with an offset (``Z``, ``+00:00`` or ``+0000``) as a timestamp; NULL if malformed."""
    without_colon = F.substring(text, -5, 1).isin("+", "-")
    spaced = F.concat(F.substring(text, F.lit(1), F.length(text) - 2), F.lit(":"), F.substring(text, -2, 2))
    return F.when(without_colon, spaced).otherwise(text).try_cast("timestamp")


def required_instant(text: Column) -> Column:
    """``instant`` of a text that must have one; anything else fails the run."""
    read = instant(text)
    failed = F.raise_error(F.concat(F.lit("not a time: "), F.coalesce(text, F.lit("NULL")))).cast("timestamp")
    return F.coalesce(read, failed)


def local_time(ts: Column) -> Column:
    """Wall-clock billing time (timestamp without zone) of an instant, whatever the session zone is."""
    return F.convert_timezone(None, F.lit(BILLING_ZONE), ts.cast("timestamp_ntz"))


def utc_time(ts: Column) -> Column:
    return F.convert_timezone(None, F.lit("UTC"), ts.cast("timestamp_ntz"))


def date_text(value: Column) -> Column:
    """``YYYY-MM-DD`` of a date or zone-less timestamp."""
    return F.substring(value.cast("string"), 1, 10)


def month_text(value: Column) -> Column:
    return F.substring(value.cast("string"), 1, 7)


def local_clock_text(ts: Column) -> Column:
    """``HH:MM:SS-0600``: local time of day with its offset from UTC."""
    local, utc = local_time(ts), utc_time(ts)
    minutes = (
        F.datediff(local, utc) * 1440
        + (F.hour(local) - F.hour(utc)) * 60
        + (F.minute(local) - F.minute(utc))
    )
    size = F.abs(minutes)
    offset = F.concat(
        F.when(minutes < 0, "-").otherwise("+"),
        F.lpad(F.floor(size / 60).cast("string"), 2, "0"),
        F.lpad((size % 60).cast("string"), 2, "0"),
    )
    return F.concat(F.substring(local.cast("string"), 12, 8), offset)


def billing_month(local: Column) -> Column:
    """Cycle month: from the 20th on, a charge falls in the next month's cycle.

    The local time stands in it once: filters on the month repeat the whole expression wherever they use it.
    """
    return month_text(F.add_months(F.date_sub(F.to_date(local), CUTOFF_DAY), 1))


def shift_month(month: Column, months: int) -> Column:
    """``YYYY-MM`` moved by whole months."""
    return month_text(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), months))


def usage_month(month: Column) -> Column:
    """Month in which usage billed in ``month`` took place."""
    return shift_month(month, -USAGE_LAG_MONTHS)


def _cycle_start(month: Column) -> Column:
    first = F.to_date(F.concat(month, F.lit("-01")))
    return F.make_timestamp(
        F.year(first), F.month(first), F.lit(CUTOFF_DAY + 1), F.lit(0), F.lit(0), F.lit(0), F.lit(BILLING_ZONE)
    )


def invoice_window(start: Column | str, end: Column | str) -> tuple[Column, Column]:
    """First and last instant of the cycles ``start`` .. ``end``: local midnight on the 20th, both inclusive."""
    start = F.lit(start) if isinstance(start, str) else start
    end = F.lit(end) if isinstance(end, str) else end
    return _cycle_start(shift_month(start, -1)), _cycle_start(end)


def months_between_texts(start: Column, end: Column) -> Column:
    """Array of ``YYYY-MM`` from ``start`` to ``end``, both included."""
    first = F.to_date(F.concat(start, F.lit("-01")))
    last = F.to_date(F.concat(end, F.lit("-01")))
    return F.transform(F.sequence(first, last, F.expr("interval 1 month")), month_text)


def add_month_text(month: str, months: int) -> str:
    year, number = divmod(int(month[:4]) * 12 + int(month[5:7]) - 1 + months, 12)
    return f"{year:04d}-{number + 1:02d}"


def month_list(start: str, end: str) -> list[str]:
    """Report months as plan parameters (pivot values)."""
    out = [start]
    while out[-1] < end:
        out.append(add_month_text(out[-1], 1))
    return out if start <= end else []


def default_invoice_months(today: dt.date, months: int) -> tuple[str, str]:
    """Default report range: the last ``months`` closed billing cycles as of ``today`` (local date)."""
    end = today.strftime("%Y-%m")
    if today.day <= CUTOFF_DAY:
        end = add_month_text(end, -1)
    return add_month_text(end, 1 - months), end


def default_usage_months(today: dt.date, months: int) -> tuple[str, str]:
    """Usage reports run through the current month."""
    end = today.strftime("%Y-%m")
    return add_month_text(end, 1 - months), end


def usage_months_for_invoices(start: str, end: str) -> tuple[str, str]:
    return add_month_text(start, -USAGE_LAG_MONTHS), add_month_text(end, -USAGE_LAG_MONTHS)


def service_period(local: Column, invoice_type: Column, tax: Column, category: Column, hourly: Column) -> Column:
    """Struct(start, end, description): the days a charge covers. First matching rule wins."""
    day = F.to_date(local)
    month_ago, two_months_ago = F.add_months(day, -1), F.add_months(day, -2)

    def period(start: Column, end: Column, description: str) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), F.lit(description).alias("description"))

    infrastructure_recurring = (tax == "IaaS") & (invoice_type == "RECURRING")
    return (
        F.when(F.coalesce(hourly, F.lit(False)), period(month_ago, F.last_day(month_ago), "IaaS Usage"))
        .when(tax == "PaaS", period(two_months_ago, F.last_day(two_months_ago), "Platform Service Usage"))
        .when(
            infrastructure_recurring & (category == "Archive Storage Repository"),
            period(month_ago, F.last_day(month_ago), "IaaS Usage"),
        )
        .when(infrastructure_recurring, period(day, F.last_day(day), "IaaS Monthly"))
        .when(tax == "HELP DESK", period(day, F.last_day(day), "Support Charges"))
        .when(invoice_type.isin("CREDIT", "ONE-TIME-CHARGE"), period(day, day, ""))
        .otherwise(period(day, F.last_day(day), ""))
    )


def provision_date(text: Column) -> Column:
    """UTC day of an ISO-8601 instant; '' when there is none."""
    return F.coalesce(date_text(utc_time(instant(text))), F.lit(""))


def provision_month(text: Column) -> Column:
    """Month of a local timestamp text in its own offset; '' is kept."""
    return F.substring(text, 1, 7)
