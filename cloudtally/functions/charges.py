"""Money and charge derivations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cloudtally.functions.nested import first_child_text

MONEY = "decimal(28,10)"
CHARGE = "decimal(28,3)"
RATE = "decimal(28,5)"
QUANTITY = "decimal(38,15)"

# Fixed values.
IAAS_DIVISIONS = ["7D", "SQ", "5M", "U3", "U6", "U7"]
IAAS_PART_EXCEPTION = "D026XZX"
VIRTUAL_SERVER_GROUP = "Virtual Servers and Attached Services"


def money(text: Column) -> Column:
    """API amount text as an exact decimal; NULL if missing. Text that is no amount, or too large, fails the run."""
    return _read(text, MONEY)


def _read(text: Column, kind: str) -> Column:
    return F.coalesce(text.try_cast(kind), no_amount(text).cast(kind))


def tried_money(text: Column) -> tuple[Column, Column]:
    """An amount, NULL if the text is none, and then that text, for ``checked``: read where not all rows take part."""
    amount = text.try_cast(MONEY)
    return amount, F.when(amount.isNull(), text)


def checked(value: Column, bad: Column, kind: str) -> Column:
    """A value; fails the run if there is a text that was no amount."""
    return F.coalesce(no_amount(bad).cast(kind), value)


def no_amount(text: Column) -> Column:
    """Fails the run on a text, NULL if there is none."""
    failed = F.raise_error(F.concat(F.lit("not an amount: "), text.cast("string")))
    return F.when(text.isNotNull(), failed.cast("string"))


def unreadable(text: Column) -> Column:
    """A text that is no amount, kept for ``no_amount``; NULL for an amount, and for none."""
    return F.when(text.try_cast("double").isNull(), text)


def positive(text: Column) -> Column:
    """Whether an amount is above zero, however small; a missing one is not."""
    return F.coalesce(_read(text, "double") > 0, F.lit(False))


def maybe_positive(text: Column) -> Column:
    """As ``positive``, but a text that is no amount passes rather than fails."""
    return F.coalesce(text.try_cast("double") > 0, text.isNotNull())


def zero(text: Column) -> Column:
    """Whether an amount is zero; a missing one is not."""
    return F.coalesce(_read(text, "double") == 0, F.lit(False))


def charge(amount: Column) -> Column:
    """Amount rounded half-even to 3 decimals."""
    return F.bround(amount, 3).cast(CHARGE)


def rate(amount: Column) -> Column:
    """Hourly rate rounded half-even to 5 decimals."""
    return F.bround(amount, 5).cast(RATE)


def child_rate_sum(children: Column) -> Column:
    """Sum of the children's hourly fees; children without one add nothing."""
    return _rate_sum(children, money)


def _rate_sum(children: Column, read) -> Column:
    nothing = F.lit(0).cast(MONEY)
    total = F.aggregate(
        children, nothing, lambda total, c: (total + F.coalesce(read(c.hourlyRecurringFee), nothing)).cast(MONEY)
    )
    return F.coalesce(total, nothing)


def hourly_rate(hourly: Column, category_code: Column, own_fee: Column, children: Column) -> tuple[Column, Column]:
    """Rate of an hourly item: own fee plus its children's (texts), 0 for items billed by the month; and the first text
    in it that is no amount, for ``checked``.

    File storage has no own fee, so its children alone make the rate.
    """
    nothing = F.lit(0).cast(MONEY)
    own, own_bad = tried_money(own_fee)
    own = F.coalesce(own, nothing)
    billed = F.coalesce(hourly, F.lit(False))
    counted = billed & ((own > 0) | (category_code == "storage_as_a_service"))
    rate = F.when(counted, F.greatest(own, nothing) + _rate_sum(children, lambda text: text.try_cast(MONEY)))
    bad = F.get(F.filter(children, lambda c: tried_money(c.hourlyRecurringFee)[1].isNotNull()), 0).hourlyRecurringFee
    return rate.otherwise(nothing).cast(MONEY), F.coalesce(F.when(billed, own_bad), F.when(counted, bad))


def hours(fee: Column, hourly_fee: Column) -> Column:
    """Whole hours behind a fee, rounded half-even; 0 without a rate."""
    ratio = F.rint(fee.cast("double") / F.when(hourly_fee > 0, hourly_fee.cast("double")))
    return F.coalesce(ratio, F.lit(0.0)).cast("long")


def full_month_estimate(invoice_type: Column, fee: Column, local: Column) -> Column:
    """Full-month amount of a pro-rated NEW charge; 0 for all other invoices."""
    month_days = F.dayofmonth(F.last_day(local))
    days_left = month_days - F.dayofmonth(local) + 1
    estimate = fee.cast("double") / days_left * month_days
    return F.when(invoice_type == "NEW", estimate).otherwise(F.lit(0.0))


def total_amount(one_time: Column, recurring: Column, child_recurring: Column) -> Column:
    return one_time + recurring + child_recurring


def storage_description(code: Column, hourly: Column, children: Column, description: Column) -> Column:
    """Readable description of storage items built from their children; others only lose line breaks."""
    blank = F.lit(" ")
    space = first_child_text(children, "performance_storage_space", "product")
    tier = first_child_text(children, "storage_tier_level", "product")
    snapshot = first_child_text(children, "storage_snapshot_space", "product")
    iops = first_child_text(children, "performance_storage_iops", "product")
    used_space = first_child_text(children, "performance_storage_space", "item")
    used_snapshot = first_child_text(children, "storage_snapshot_space", "item")
    image = first_child_text(children, "guest_storage_usage", "item")

    clean = clean_description(description)
    model = F.concat(F.when(F.coalesce(hourly, F.lit(False)), "Hourly").otherwise("Monthly"), F.lit(" File Storage"))
    file_storage = (
        F.when((used_space == "") | (tier == ""), model)
        .when(snapshot == "", F.concat(model, blank, used_space, F.lit(" at "), tier))
        .otherwise(F.concat(model, blank, used_space, F.lit(" at "), tier, F.lit(" with "), used_snapshot))
    )
    endurance = F.concat(
        space, blank, tier, F.when(snapshot == "", blank).otherwise(F.concat(F.lit(" with "), snapshot))
    )
    return (
        F.when(code == "storage_service_enterprise", endurance)
        .when(code == "performance_storage_iops", F.concat(space, blank, iops))
        .when(code == "storage_as_a_service", file_storage)
        .when((code == "guest_storage") & (image != ""), image)
        .otherwise(clean)
    )


def clean_description(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def host_fqdn(host: Column, domain: Column) -> Column:
    return F.coalesce(F.when(host.isNotNull(), F.concat_ws(".", host, domain)), F.lit(""))


def iops_tier(iops: Column, capacity: Column) -> Column:
    """IOPS per GB, rounded half-even; NULL without a capacity."""
    return F.rint(iops.cast("double") / F.when(capacity > 0, capacity.cast("double")))


def parent_line_category(group: Column, category: Column, description: Column) -> Column:
    """Sheet category of an infrastructure parent item."""
    licence = F.lit("Software License")
    return (
        F.when(group == VIRTUAL_SERVER_GROUP, F.lit(VIRTUAL_SERVER_GROUP))
        .when((category == licence) & F.contains(description, F.lit("vSAN")), F.concat(licence, F.lit(" VMware vSAN")))
        .when((category == licence) & F.contains(description, F.lit("NSX")), F.concat(licence, F.lit(" VMware NSX")))
        .when(
            (group == "Other") & category.isin("Network Vlan", "Network Message Delivery"), F.lit("Network Other")
        )
        .otherwise(category)
    )


def on_iaas_invoice(division: Column, part: Column) -> Column:
    """Whether a metered child is billed on the infrastructure invoice (a missing division is not)."""
    return F.coalesce(division, F.lit("")).isin(IAAS_DIVISIONS) | (
        F.coalesce(part, F.lit("")) == IAAS_PART_EXCEPTION
    )


def with_defaults(columns: Iterable[str], default: str = "") -> list[Column]:
    """The named text columns with ``default`` where the key is missing."""
    return [F.coalesce(F.col(c), F.lit(default)).alias(c) for c in columns]


def discount_and_price(discounts: Column, price: Column) -> tuple[Column, Column]:
    """First discount (NULL if none) and the price list as JSON text (``[]`` if none)."""
    first = F.get(discounts, 0)["discount"]
    return first, F.when(F.size(price) > 0, F.to_json(price)).otherwise(F.lit("[]"))
