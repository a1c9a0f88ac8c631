"""Invoices, their items and charged children as one table of invoice lines."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloudtally.functions import charges, dates, nested, text
from cloudtally.operators.lookup import first_by_key, lookup_join

# Category codes that get the notes of their storage volume.
STORAGE_NOTE_CODES = ["storage_service_enterprise", "performance_storage_iops", "storage_as_a_service"]

LINE_COLUMNS = [
    "Portal_Invoice_Date", "Portal_Invoice_Time", "Service_Date_Start", "Service_Date_End", "billing_month",
    "Portal_Invoice_Number", "Type", "RecordType", "BillingItemId", "hostName", "location", "Category_Group",
    "Category", "TaxCategory", "dPart", "Description", "Memory", "OS", "billing_notes", "Hourly", "Usage", "Hours",
    "HourlyRate", "totalRecurringCharge", "NewEstimatedMonthly", "totalOneTimeAmount", "InvoiceTotal",
    "InvoiceRecurring", "Recurring_Description", "childBillingItemId", "childParentCategory", "childParentProduct",
    "childUsage", "childTotalRecurringCharge", "INV_PRODID", "INV_DIV", "PLAN_ID", "FEATURE_ID",
    "IS_PRIVATE_NETWORK_ONLY", "DUAL_PATH_NETWORK", "INELIGIBLE_FOR_ACCOUNT_DISCOUNT", "storage_notes", "totalAmount",
]

# What a line has of its child, and the types of what is no text.
OWN = [
    "childBillingItemId", "childUsage", "group", "category", "dPart", "description", "fee", "unreadable",
    *nested.CHILD_ATTRIBUTES.values(),
]
OWN_KINDS = {"childBillingItemId": "long", "childUsage": "double"}


def charged_invoices(invoices: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Invoices of the billing cycles ``start`` .. ``end`` (all if not given) that charge anything."""
    total = charges.money(F.col("invoiceTotalAmount"))
    recurring = charges.money(F.col("invoiceTotalRecurringAmount"))
    created = dates.required_instant(F.col("createDate"))
    kept = invoices
    if start and end:
        first, last = dates.invoice_window(start, end)
        kept = kept.filter(created.between(first, last))
    nothing = charges.zero(F.col("invoiceTotalAmount")) & charges.zero(F.col("invoiceTotalRecurringAmount"))
    kept = kept.filter(~nothing)
    local = dates.local_time(created)
    return kept.select(
        F.col("id").alias("Portal_Invoice_Number"),
        F.col("typeCode").alias("Type"),
        local.alias("_local"),
        dates.local_clock_text(created).alias("Portal_Invoice_Time"),
        total.alias("InvoiceTotal"),
        recurring.alias("InvoiceRecurring"),
    )


def network_storage(volumes: DataFrame) -> DataFrame:
    """Storage volumes with decoded notes and their IOPS tier."""
    return volumes.select(
        "id",
        F.col("billingItem.id").alias("billingItemId"),
        F.coalesce("createDate", F.lit("")).alias("createDate"),
        "capacityGb",
        F.coalesce("nasType", F.lit("")).alias("nasType"),
        text.decoded_notes(F.col("notes")).alias("notes"),
        F.coalesce("username", F.lit("")).alias("username"),
        "provisionedIops",
        charges.iops_tier(F.col("provisionedIops"), F.col("capacityGb")).alias("iopsTier"),
    )


def _with_storage_notes(lines: DataFrame, volumes: DataFrame | None, spread: Sequence[str]) -> DataFrame:
    """Only storage is looked up: other lines, or items, are not shuffled for it, where they would all have no key. Both
    kinds are told apart by the item's code, as items are read."""
    if volumes is None:
        return lines.withColumn("storage_notes", F.lit(""))
    notes = first_by_key(
        network_storage(volumes).select("billingItemId", "id", "notes"), ["billingItemId"], ["id"]
    )
    storage = F.coalesce(F.col("_code").isin(STORAGE_NOTE_CODES), F.lit(False))
    found = lookup_join(
        lines.filter(storage), notes, "BillingItemId", "billingItemId", {"notes": "storage_notes"},
        spread=["_invoice", *spread], hashed=True,
    )
    found = found.withColumn("storage_notes", F.coalesce("storage_notes", F.lit("")))
    return found.unionByName(lines.filter(~storage).withColumn("storage_notes", F.lit("")))


def invoice_lines(
    invoices: DataFrame,
    items: DataFrame,
    volumes: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
    child_one_time: str = "repeat",
    children: bool = True,
    whole: bool = False,
) -> DataFrame:
    """One line per invoice item (``RecordType`` Parent) and per charged child (Child).

    Items and children are read once: an item is exploded to itself and its charged children, and each column
    picks the parent's or the child's value. A child repeats the parent's one-time amount, as reported;
    ``child_one_time='zero'`` leaves it out. ``children=False`` gives the parents only. Storage notes need
    ``volumes``; without them they are ''.

    Lines are made before they meet their invoices, so that a shuffle moves flat rows with the columns in use and a
    report's filters go before it; nested children never move. Where all columns of all lines are used (``whole``), flat
    rows would repeat their item's columns: items meet their invoices, with what their charged children have of their own, as
    two JSON texts, which a shuffle holds in half the space of many narrow columns, and lines are made after. Amounts of an item are read once for all its lines; a text that is no amount goes along and
    fails the run only if its invoice takes part.
    """
    rows = _item_columns(items)
    packed = whole and children
    ids = ["BillingItemId"] if packed else ["BillingItemId", "childBillingItemId"]
    child_type = items.schema["children"].dataType.elementType
    charged = F.filter("children", lambda c: charges.maybe_positive(c["recurringFee"]))
    if packed:
        rows = rows.withColumn("children", F.transform(charged, lambda c: _texts(_own_columns(c).values())))
        kinds = {f.name: f.dataType for f in rows.schema.fields if f.name not in ("_invoice", "BillingItemId", "_code", "children")}
        rows = rows.select(
            "_invoice", "BillingItemId", "_code", F.to_json(_texts([F.col(c) for c in kinds])).alias("_item"),
            F.to_json("children").alias("children"),
        )
    elif children:
        rows = _exploded(rows.withColumn("children", charged))
    else:
        rows = rows.withColumn("_child", F.lit(None).cast(child_type))
    charged = charged_invoices(invoices, start, end).withColumns(
        {
            "Portal_Invoice_Date": F.coalesce(dates.date_text(F.col("_local")), F.lit("")),
            "billing_month": dates.billing_month(F.col("_local")),
            "_invoiced": F.col("Portal_Invoice_Number"),
        }
    )
    joined = lookup_join(
        _with_storage_notes(rows if packed else _line_columns(rows, children), volumes, ids),
        charged,
        "_invoice",
        "Portal_Invoice_Number",
        charged.columns,
        spread=ids,
        how="inner",
        hashed=True,
    )
    if packed:
        read = {"_item": "array<string>", "children": "array<array<string>>"}
        joined = joined.withColumns({c: F.from_json(c, kind, {"mode": "FAILFAST"}) for c, kind in read.items()})
        joined = joined.withColumns({c: F.get("_item", F.lit(i)).cast(kind) for i, (c, kind) in enumerate(kinds.items())})
        joined = _line_columns(_exploded(joined.drop("_item")), children, packed=True)
    if children:
        # Names a column of the invoice as well, beside its key, which a line has itself: the check stays with the lines
        # that have an invoice.
        readable = charges.no_amount(F.when(F.col("_invoiced").isNotNull(), F.col("_unreadable")))
        joined = joined.filter(readable.isNull())
    return _invoiced_columns(joined, child_one_time)


def _exploded(items: DataFrame) -> DataFrame:
    """A row per item, without ``_child``, and one for each of its ``children``."""
    kind = items.schema["children"].dataType
    itself = F.array(F.lit(None).cast(kind.elementType))
    return items.withColumn("_child", F.explode(F.concat(itself, F.coalesce("children", F.array().cast(kind)))))


def _texts(columns: Iterable[Column]) -> Column:
    return F.array(*[c.cast("string") for c in columns])


def _own_columns(child: Column) -> dict[str, Column]:
    """What a line has of its child, in the order of ``OWN``; its group is the item's, if it has none."""
    group = F.coalesce(child["category"]["group"]["name"], F.col("_group"))
    usage = text.parsed_usage(group, child["description"])
    attributes = {
        name: nested.attribute(child["product"]["attributes"], key) for key, name in nested.CHILD_ATTRIBUTES.items()
    }
    return {
        "childBillingItemId": child["billingItemId"],
        "childUsage": usage["usage"],
        "group": group,
        "category": F.coalesce(child["product"]["itemCategory"]["name"], F.lit("Unknown")),
        "dPart": child["dPart"],
        "description": usage["description"],
        "fee": child["recurringFee"],
        "unreadable": charges.unreadable(child["recurringFee"]),
        **attributes,
    }


def _item_columns(items: DataFrame) -> DataFrame:
    """What all lines of an item share, worked out once per item; ``_`` columns are the parent line's own.

    Text keys of the reports are coalesced to '': Spark then drops their NULL checks rather than deriving them twice.
    """
    hourly, code, children = F.col("hourlyFlag"), F.col("categoryCode"), F.col("children")
    fee, fee_bad = charges.tried_money(F.col("totalRecurringAmount"))
    one_time, one_time_bad = charges.tried_money(F.col("totalOneTimeAmount"))
    rate, rate_bad = charges.hourly_rate(hourly, code, F.col("hourlyRecurringFee"), children)
    own_attributes = [
        nested.attribute(F.col("product.attributes"), key).alias(f"_{name}")
        for key, name in nested.PARENT_ATTRIBUTES.items()
    ]
    return items.select(
        F.col("invoiceId").alias("_invoice"),
        F.col("billingItemId").alias("BillingItemId"),
        charges.host_fqdn(F.col("hostName"), F.col("domainName")).alias("hostName"),
        F.coalesce("location.longName", F.lit("")).alias("location"),
        F.col("product.taxCategory.name").alias("TaxCategory"),
        nested.first_child_text(children, "ram", "product").alias("Memory"),
        nested.first_child_text(children, "os", "product").alias("OS"),
        F.coalesce("notes", F.lit("")).alias("billing_notes"),
        hourly.alias("Hourly"),
        F.col("usageChargeFlag").alias("Usage"),
        code.alias("_code"),
        fee.alias("_fee"),
        fee_bad.alias("_fee_bad"),
        one_time.alias("_one_time"),
        one_time_bad.alias("_one_time_bad"),
        rate.alias("_rate"),
        rate_bad.alias("_rate_bad"),
        F.coalesce("category.group.name", F.lit("Other")).alias("_group"),
        F.col("category.name").alias("_category"),
        F.col("dPart").alias("_dpart"),
        F.coalesce(
            charges.storage_description(code, hourly, children, F.col("product.description")), F.lit("")
        ).alias("_description"),
        *own_attributes,
        "children",
    )


def _line_columns(rows: DataFrame, children: bool, packed: bool = False) -> DataFrame:
    """The columns in which a parent line and its child lines differ, as far as they need no invoice.

    ``packed`` children are texts of ``_own_columns``.
    """
    child = F.col("_child")
    is_parent = child.isNull()
    if packed:
        own = {name: F.get(child, F.lit(i)).cast(OWN_KINDS.get(name, "string")) for i, name in enumerate(OWN)}
    else:
        own = _own_columns(child)

    def pick(parent: Column, of_child: Column) -> Column:
        return F.when(is_parent, parent).otherwise(of_child)

    def of_child(value: Column) -> Column:
        return F.when(~is_parent, value)

    attributes = {}
    for key, name in nested.CHILD_ATTRIBUTES.items():
        attributes[name] = pick(F.col(f"_{name}"), own[name]) if key in nested.PARENT_ATTRIBUTES else of_child(own[name])
    lines = rows.withColumns(
        {
            "RecordType": F.when(is_parent, "Parent").otherwise("Child"),
            "Category_Group": pick(F.col("_group"), own["group"]),
            "Category": pick(F.col("_category"), own["category"]),
            "dPart": F.coalesce(pick(F.col("_dpart"), own["dPart"]), F.lit("")),
            "Description": F.coalesce(pick(F.col("_description"), own["description"]), F.lit("")),
            "childBillingItemId": own["childBillingItemId"],
            "childParentCategory": of_child(F.col("_category")),
            "childParentProduct": of_child(F.col("_description")),
            "childUsage": of_child(own["childUsage"]),
            "_child_fee": own["fee"],
            "_unreadable": own["unreadable"] if children else F.lit(None).cast("string"),
            **attributes,
        }
    )
    return lines.drop("_child", "children", "_group", "_dpart", *[f"_{n}" for n in nested.PARENT_ATTRIBUTES.values()])


def _invoiced_columns(lines: DataFrame, child_one_time: str) -> DataFrame:
    """The columns that need the invoice, and amounts."""
    local = F.col("_local")
    is_parent = F.col("RecordType") == "Parent"
    nothing = F.lit(0).cast(charges.CHARGE)
    one_time = charges.checked(F.col("_one_time"), F.col("_one_time_bad"), charges.MONEY)
    if child_one_time != "repeat":
        one_time = F.when(is_parent, one_time).otherwise(F.lit(0).cast(charges.MONEY))
    amounts = lines.withColumns(
        {
            "_fee": charges.checked(F.col("_fee"), F.col("_fee_bad"), charges.MONEY),
            "_rate": charges.checked(F.col("_rate"), F.col("_rate_bad"), charges.MONEY),
            "_period": dates.service_period(
                local, F.col("Type"), F.col("TaxCategory"), F.col("_category"), F.col("Hourly")
            ),
        }
    )
    child_charge = charges.charge(charges.money(F.col("_child_fee")))
    lines = amounts.withColumns(
        {
            "Service_Date_Start": F.coalesce(F.col("_period.start").cast("string"), F.lit("")),
            "Service_Date_End": F.coalesce(F.col("_period.end").cast("string"), F.lit("")),
            "Recurring_Description": F.col("_period.description"),
            "Hours": charges.hours(F.col("_fee"), F.col("_rate")),
            "HourlyRate": charges.rate(F.col("_rate")),
            "NewEstimatedMonthly": charges.full_month_estimate(F.col("Type"), F.col("_fee"), local),
            "totalRecurringCharge": F.when(is_parent, charges.charge(F.col("_fee"))).otherwise(nothing),
            "totalOneTimeAmount": one_time,
            "childTotalRecurringCharge": F.when(is_parent, nothing).otherwise(child_charge),
        }
    )
    total = charges.total_amount(
        F.col("totalOneTimeAmount"), F.col("totalRecurringCharge"), F.col("childTotalRecurringCharge")
    )
    return lines.withColumn("totalAmount", total).select(*LINE_COLUMNS)
