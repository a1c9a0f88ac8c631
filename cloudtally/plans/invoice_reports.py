"""Reports on invoice lines: category summaries, reconciliation sheets, storage and server pivots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.functions import charges, nested, text
from cloudtally.operators.lookup import lookup_join
from cloudtally.operators.partials import Pivot
from cloudtally.operators.pivot import Measure
from cloudtally.plans.invoice_lines import LINE_COLUMNS

MONTH = "billing_month"
# Fixed values, here and below: key lists and report names are the columns and names of the output.
SHEET_KEYS = [
    "Portal_Invoice_Number", "Type", "Portal_Invoice_Date", "Service_Date_Start", "Service_Date_End", "dPart",
    "lineItemCategory",
]
OBJECT_STORAGE_PRODUCT = "Cloud Object Storage - S3 API"

_AMOUNT = [Measure("totalAmount")]
_QTY = Measure("qty", "rows")
_RECURRING = Measure("TotalRecurring", column="totalRecurringCharge")


def invoice_detail(lines: DataFrame) -> DataFrame:
    """All invoice lines, amounts as double."""
    amounts = [
        "HourlyRate", "totalRecurringCharge", "totalOneTimeAmount", "InvoiceTotal", "InvoiceRecurring",
        "childTotalRecurringCharge", "totalAmount",
    ]
    return lines.select(*[F.col(c).cast("double").alias(c) if c in amounts else F.col(c) for c in LINE_COLUMNS])


def _parents(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("RecordType") == "Parent")


def _object_storage(lines: DataFrame) -> DataFrame:
    rows = lines.filter((F.col("RecordType") == "Child") & (F.col("childParentProduct") == OBJECT_STORAGE_PRODUCT))
    return rows.withColumn("childUsage", F.col("childUsage").cast(charges.QUANTITY))


def _file_storage(lines: DataFrame) -> DataFrame:
    """File storage of any invoice type and recurring endurance storage."""
    return lines.filter(
        (F.col("Category") == "Storage As A Service")
        | ((F.col("Category") == "Endurance") & (F.col("Type") == "RECURRING"))
    )


def _servers(category: str, hourly: bool, parents_only: bool = False) -> Callable[[DataFrame], DataFrame]:
    def rows(lines: DataFrame) -> DataFrame:
        found = lines.filter((F.col("Category") == category) & (F.col("Hourly") == F.lit(hourly)))
        return found.filter(F.col("RecordType") == "Parent") if parents_only else found

    return rows


CATEGORY_GROUPS = Pivot(
    "CategoryGroupSummary", _parents, ["Type", "dPart", "Category_Group", "Category"], _AMOUNT, MONTH
)
CATEGORIES = Pivot("CategoryDetail", _parents, ["Type", "Category_Group", "Category", "Description"], _AMOUNT, MONTH)
# Empty cells stay empty.
CLASSIC_OBJECT_STORAGE = Pivot(
    "Classic_COS", _object_storage,
    ["Type", "Category_Group", "childParentProduct", "Category", "Description"],
    [Measure("usageQty", column="childUsage"), Measure("totalUsageCharge", column="childTotalRecurringCharge")],
    MONTH, fill=False,
)
STORAGE = Pivot(
    "StoragePivot", _file_storage, ["location", "Category", "billing_notes", "storage_notes", "Description"], [_RECURRING],
    MONTH, total=None,
)


def server_pivots(parents_only: bool = False) -> list[Pivot]:
    hours = Measure("TotalHours", column="Hours")
    kinds = [
        ("HrlyVirtualServers", "Computing Instance", True, ["Description", "OS"], [_QTY, hours, _RECURRING]),
        ("MnthlyVirtualServers", "Computing Instance", False, ["Description", "OS"], [_QTY, _RECURRING]),
        ("HrlyBaremetalServers", "Server", True, ["Description", "OS"], [_QTY, _RECURRING]),
        ("MthlyBaremetalServers", "Server", False, ["location", "Description", "OS"], [_QTY, _RECURRING]),
    ]
    return [
        Pivot(name, _servers(category, hourly, parents_only), keys, measures, MONTH, total=None)
        for name, category, hourly, keys, measures in kinds
    ]


def sheet_pivots(parts: DataFrame) -> list[Pivot]:
    """The top sheets: one a month, all in one table with the month as its first key. A month without lines still
    shows its total on the infrastructure sheet."""
    def iaas(lines: DataFrame) -> DataFrame:
        return iaas_sheet_rows(lines, parts).select(MONTH, *SHEET_KEYS, "totalAmount")

    return [
        Pivot("TopSheet_IaaS", iaas, SHEET_KEYS, _AMOUNT, MONTH, within=True, empty_months=True),
        Pivot("TopSheet_PaaS", lambda lines: paas_sheet_rows(lines, parts), SHEET_KEYS, _AMOUNT, MONTH, "All", within=True),
        Pivot("TopSheet_Credit", credit_sheet_rows, SHEET_KEYS, _AMOUNT, MONTH, within=True),
    ]


def invoice_pivots(parts: DataFrame) -> list[Pivot]:
    """All reports on invoice lines that are made by the month."""
    return [CATEGORY_GROUPS, CATEGORIES, CLASSIC_OBJECT_STORAGE, *sheet_pivots(parts), STORAGE, *server_pivots()]


def category_group_summary(lines: DataFrame, months: Sequence[str]) -> DataFrame:
    return CATEGORY_GROUPS.report(lines, months)


def category_detail(lines: DataFrame, months: Sequence[str]) -> DataFrame:
    return CATEGORIES.report(lines, months)


def object_storage_detail(lines: DataFrame, months: Sequence[str]) -> DataFrame:
    """Usage and charges of classic object storage."""
    return CLASSIC_OBJECT_STORAGE.report(lines, months)


def with_part_description(rows: DataFrame, parts: DataFrame, own: str, hashed: bool = False) -> DataFrame:
    """Line category of metered children: the description of their part, else their own text.

    ``hashed`` is for part lists that grow with the rows: above Spark's broadcast limit the rows would be sorted by their
    part, and many rows share a few parts, so that sorts of single tasks would spill.
    """
    found = lookup_join(
        rows, parts, nested.strip(F.col("INV_PRODID")), "part_code", {"description": "_described"},
        spread=["Portal_Invoice_Number", "BillingItemId", "childBillingItemId"], hashed=hashed,
    )
    return found.withColumn("lineItemCategory", F.coalesce("_described", own, F.lit(""))).drop("_described")


def iaas_sheet_rows(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Lines of the infrastructure invoice: metered children of its divisions and all parents but platform ones.

    Both kinds are told apart within one read of the lines.
    """
    is_child = F.col("RecordType") == "Child"
    metered = is_child & charges.on_iaas_invoice(F.col("INV_DIV"), F.col("INV_PRODID"))
    unmetered = ~is_child & (F.col("TaxCategory") != "PaaS")
    rows = lines.filter((metered | unmetered) & (F.col("totalAmount") > 0)).withColumn(
        "_own",
        F.when(is_child, F.col("Description")).otherwise(
            charges.parent_line_category(F.col("Category_Group"), F.col("Category"), F.col("Description"))
        ),
    ).withColumn("INV_PRODID", F.when(is_child, F.col("INV_PRODID")))
    return with_part_description(rows, parts, "_own")


def paas_sheet_rows(lines: DataFrame, parts: DataFrame) -> DataFrame:
    rows = lines.filter(
        (F.col("RecordType") == "Child")
        & (F.col("TaxCategory") == "PaaS")
        & ~charges.on_iaas_invoice(F.col("INV_DIV"), F.col("INV_PRODID"))
    )
    return with_part_description(rows, parts, "childParentProduct")


def credit_sheet_rows(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("Type") == "CREDIT").withColumn("lineItemCategory", F.col("Category"))


def top_sheet_iaas(lines: DataFrame, parts: DataFrame, months: Sequence[str]) -> DataFrame:
    return sheet_pivots(parts)[0].report(lines, months)


def top_sheet_paas(lines: DataFrame, parts: DataFrame, months: Sequence[str]) -> DataFrame:
    return sheet_pivots(parts)[1].report(lines, months)


def top_sheet_credit(lines: DataFrame, months: Sequence[str]) -> DataFrame:
    return sheet_pivots(None)[2].report(lines, months)


def storage_pivot(lines: DataFrame, months: Sequence[str]) -> DataFrame:
    return STORAGE.report(lines, months)


def hourly_virtual_servers(lines: DataFrame, months: Sequence[str], parents_only: bool = False) -> DataFrame:
    return server_pivots(parents_only)[0].report(lines, months)


def monthly_virtual_servers(lines: DataFrame, months: Sequence[str], parents_only: bool = False) -> DataFrame:
    return server_pivots(parents_only)[1].report(lines, months)


def hourly_bare_metal(lines: DataFrame, months: Sequence[str], parents_only: bool = False) -> DataFrame:
    return server_pivots(parents_only)[2].report(lines, months)


def monthly_bare_metal(lines: DataFrame, months: Sequence[str], parents_only: bool = False) -> DataFrame:
    return server_pivots(parents_only)[3].report(lines, months)


def account_detail(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        "id",
        "companyName",
        "email",
        "bluemixAccountId",
        "proofOfConceptAccountFlag",
        F.col("accountStatus.name").alias("accountStatus"),
        F.col("billingInfo.createDate").alias("billingInfoCreateDate"),
        F.col("billingInfo.currency.name").alias("billingInfoCurrency"),
        F.col("brand.name").alias("brand"),
        nested.joined_notes(
            F.transform("internalNotes", lambda n: F.struct(text.plain_notes(n["note"]).alias("note")))
        ).alias("internalNotes"),
        F.coalesce("masterUser.email", F.lit("")).alias("masterUserEmail"),
        F.coalesce("masterUser.iamId", F.lit("")).alias("masterUserIamId"),
    )


def classic_users(users: DataFrame) -> DataFrame:
    """Users with their last login attempt; a user without attempts has none."""
    attempt = F.get("loginAttempts", 0)
    return users.select(
        "accountId",
        F.coalesce("companyName", F.lit("")).alias("companyName"),
        "id",
        "displayName",
        F.col("firstName").alias("fistName"),
        F.col("lastName").alias("LastName"),
        "createDate",
        "modifyDate",
        "statusDate",
        "iamId",
        F.coalesce("email", F.lit("")).alias("email"),
        "username",
        F.col("userStatus.name").alias("userStatus"),
        "isMasterUserFlag",
        F.col("managedByOpenIdConnectFlag").alias("managedByOpenConnectFlag"),
        F.coalesce(F.col("sslVpnAllowedFlag").cast("string"), F.lit("")).alias("sslVpnAllowedFlag"),
        attempt["createDate"].alias("lastLoginAttempt"),
        attempt["ipAddress"].alias("lastLoginAttemptIpAddress"),
        F.when(
            attempt.isNotNull(), F.coalesce(attempt["successFlag"].cast("string"), F.lit(""))
        ).alias("lastLoginAttemptSuccessFlag"),
    )


def invoice_report_set(
    lines: DataFrame,
    parts: DataFrame,
    months: Sequence[str],
    accounts: DataFrame | None = None,
    users: DataFrame | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """All reports by name, built when asked for."""
    reports: dict[str, Callable[[], DataFrame]] = {
        "Detail": lambda: invoice_detail(lines),
        "CategoryGroupSummary": lambda: category_group_summary(lines, months),
        "CategoryDetail": lambda: category_detail(lines, months),
        "Classic_COS": lambda: object_storage_detail(lines, months),
        "TopSheet_IaaS": lambda: top_sheet_iaas(lines, parts, months),
        "TopSheet_PaaS": lambda: top_sheet_paas(lines, parts, months),
        "TopSheet_Credit": lambda: top_sheet_credit(lines, months),
        "StoragePivot": lambda: storage_pivot(lines, months),
        "HrlyVirtualServers": lambda: hourly_virtual_servers(lines, months),
        "MnthlyVirtualServers": lambda: monthly_virtual_servers(lines, months),
        "HrlyBaremetalServers": lambda: hourly_bare_metal(lines, months),
        "MthlyBaremetalServers": lambda: monthly_bare_metal(lines, months),
    }
    if accounts is not None:
        reports["AccountDetail"] = lambda: account_detail(accounts)
    if users is not None:
        reports["Users"] = lambda: classic_users(users)
    return reports
