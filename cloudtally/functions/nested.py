"""Array and struct access."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters dropped at both ends of a text.
WHITESPACE = " \t\n\r\x0b\x0c"

# Attribute key -> output column.
CHILD_ATTRIBUTES = {
    "BLUEMIX_PART_NUMBER": "INV_PRODID",
    "BLUEMIX_SERVICE_PLAN_DIVISION": "INV_DIV",
    "BLUEMIX_SERVICE_PLAN_ID": "PLAN_ID",
    "BLUEMIX_SERVICE_PLAN_FEATURE_ID": "FEATURE_ID",
    "IS_PRIVATE_NETWORK_ONLY": "IS_PRIVATE_NETWORK_ONLY",
    "DUAL_PATH_NETWORK": "DUAL_PATH_NETWORK",
    "INELIGIBLE_FOR_ACCOUNT_DISCOUNT": "INELIGIBLE_FOR_ACCOUNT_DISCOUNT",
}
PARENT_ATTRIBUTES = {
    "BLUEMIX_PART_NUMBER": "INV_PRODID",
    "BLUEMIX_SERVICE_PLAN_DIVISION": "INV_DIV",
    "BLUEMIX_SERVICE_PLAN_ID": "PLAN_ID",
}


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def attribute(attributes: Column, key: str) -> Column:
    """Value of a key in an attribute list; the last entry wins, '' if there is none."""
    found = F.filter(attributes, lambda a: a["attributeType"]["keyName"] == key)
    return F.coalesce(F.try_element_at(found, F.lit(-1))["value"], F.lit(""))


def first_child_text(children: Column, code: str, source: str) -> Column:
    """Trimmed text of the first child with a category code, '' if there is none.

    ``source`` picks the child's ``product`` description or the child ``item``'s own.
    """
    child = F.get(F.filter(children, lambda c: c["categoryCode"] == code), 0)
    text = child["product"]["description"] if source == "product" else child["description"]
    return F.coalesce(strip(text), F.lit(""))


def first_field(items: Column, *path: str) -> Column:
    """A field of the first array element, NULL for a missing or empty array."""
    value = F.get(items, 0)
    for name in path:
        value = value[name]
    return value


def joined_notes(notes: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(notes, lambda n: n["note"]), ""), F.lit(""))


def role_tags(tags: Column) -> Column:
    """Comma list of what follows the first colon (up to the next) in tags containing ``role:``."""
    roles = F.filter(tags, lambda t: F.contains(t, F.lit("role:")))
    return F.coalesce(F.array_join(F.transform(roles, lambda t: F.split(t, ":")[1]), ","), F.lit(""))


def last_named(components: Column, name: str) -> Column:
    """Last component with a name; a later one replaces an earlier one."""
    return F.try_element_at(F.filter(components, lambda c: c["name"] == name), F.lit(-1))


def nvme_total(disks: Column) -> Column:
    """Total size of the NVMe disks; 0 if there are none."""
    sizes = F.transform(
        F.filter(disks, lambda d: d["interface_type"] == "nvme"), lambda d: d["size"].cast("double")
    )
    return F.coalesce(F.aggregate(sizes, F.lit(0.0), lambda a, b: a + b), F.lit(0.0))


def interface_name(component: Column) -> Column:
    return F.concat(component["name"], component["port"].cast("string"))


def subnet_cidr(subnet: Column) -> Column:
    return F.when(subnet.isNotNull(), F.concat_ws("/", subnet["networkIdentifier"], subnet["cidr"].cast("string")))


def trunk_text(trunks: Column) -> Column:
    """``(number) name, (number) name`` for a list of trunked VLANs; '' if there are none."""
    parts = F.transform(
        trunks,
        lambda t: F.concat(
            F.lit("("), t["vlanNumber"].cast("string"), F.lit(") "), F.coalesce(t["name"], F.lit(""))
        ),
    )
    return F.coalesce(F.array_join(parts, ", "), F.lit(""))
