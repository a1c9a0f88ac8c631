from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cloudtally.functions import charges, nested

ATTRIBUTES = "a array<struct<attributeType: struct<keyName: string>, value: string>>"


def test_last_attribute_wins(evaluate):
    lists = [([(("K",), "1"), (("L",), "x"), (("K",), "2")],), ([],), (None,), ([(("L",), "x")],)]
    assert evaluate(ATTRIBUTES, lists, nested.attribute(F.col("a"), "K")) == ["2", "", "", ""]


def test_first_child(evaluate):
    schema = "c array<struct<categoryCode: string, description: string, product: struct<description: string>>>"
    children = [
        ([(None, "n", ("np",)), ("os", " item\n", (" product ",)), ("os", "second", ("x",))],),
        ([],),
        (None,),
    ]
    assert evaluate(schema, children, nested.first_child_text(F.col("c"), "os", "product")) == ["product", "", ""]
    assert evaluate(schema, children, nested.first_child_text(F.col("c"), "os", "item")) == ["item", "", ""]


def test_role_tags(evaluate):
    tags = [(["role:app", "env:x", "owner-role:a:b"],), (["env:x"],), ([],), (None,)]
    assert evaluate("t array<string>", tags, nested.role_tags(F.col("t"))) == ["app,a", "", "", ""]


def test_money_is_exact_and_rounds_half_even(evaluate):
    amounts = [("0.0005",), ("0.0015",), ("2.6745",), ("-1.0005",), (None,), ("123456789012345678.0005",)]
    assert evaluate("m string", amounts, charges.charge(charges.money(F.col("m")))) == [
        Decimal("0.000"), Decimal("0.002"), Decimal("2.674"), Decimal("-1.000"), None, Decimal("123456789012345678.000"),
    ]


@pytest.mark.parametrize("amount", ["", "x", "12,5", "1" + "0" * 30])
def test_what_is_no_amount_fails_the_run(evaluate, amount):
    with pytest.raises(Exception, match="not an amount"):
        evaluate("m string", [(amount,)], charges.money(F.col("m")))


def test_sign_of_tiny_amounts(evaluate):
    amounts = [("0.0000000000004",), ("0.00",), (None,), ("-1",)]
    assert evaluate("m string", amounts, charges.positive(F.col("m"))) == [True, False, False, False]
    assert evaluate("m string", amounts, charges.zero(F.col("m"))) == [False, True, False, False]


def test_hours_and_tier(evaluate):
    fees = [(10.0, 4.0), (14.0, 4.0), (1.0, 0.0), (1.0, None)]
    assert evaluate("f double, r double", fees, charges.hours(F.col("f"), F.col("r"))) == [2, 4, 0, 0]
    assert evaluate("f double, r double", fees, charges.iops_tier(F.col("f"), F.col("r"))) == [2.0, 4.0, None, None]


def test_full_month_estimate(evaluate):
    cases = [("NEW", 29.0, "2024-02-01"), ("NEW", 1.0, "2024-02-29"), ("RECURRING", 5.0, "2024-02-10")]
    column = charges.full_month_estimate(F.col("t"), F.col("f"), F.col("d").cast("timestamp_ntz"))
    assert evaluate("t string, f double, d string", cases, column) == [29.0, 29.0, 0.0]


def test_host_and_category(evaluate):
    hosts = [("h", "d"), ("h", None), (None, "d")]
    assert evaluate("h string, d string", hosts, charges.host_fqdn(F.col("h"), F.col("d"))) == ["h.d", "h", ""]
    cases = {
        ("Virtual Servers and Attached Services", "x", "x"): "Virtual Servers and Attached Services",
        ("g", "Software License", "VMware vSAN NSX"): "Software License VMware vSAN",
        ("g", "Software License", "NSX"): "Software License VMware NSX",
        ("g", "Software License", "Windows"): "Software License",
        ("Other", "Network Vlan", "x"): "Network Other",
        ("g", "Network Vlan", "x"): "Network Vlan",
    }
    column = charges.parent_line_category(F.col("g"), F.col("c"), F.col("d"))
    assert evaluate("g string, c string, d string", list(cases), column) == list(cases.values())


def test_missing_division_is_not_on_the_iaas_invoice(evaluate):
    cases = [("7D", "x"), (None, None), ("ZZ", "D026XZX"), ("ZZ", "x")]
    column = charges.on_iaas_invoice(F.col("d"), F.col("p"))
    assert evaluate("d string, p string", cases, column) == [True, False, True, False]


def test_nvme_and_trunks(evaluate):
    disks = [([("nvme", 10.0), ("sata", 5.0), ("nvme", 2.5)],), ([],), (None,)]
    assert evaluate(
        "d array<struct<interface_type: string, size: double>>", disks, nested.nvme_total(F.col("d"))
    ) == [12.5, 0.0, 0.0]
    trunks = [([(5, "a"), (7, None)],), ([],), (None,)]
    assert evaluate("t array<struct<vlanNumber: bigint, name: string>>", trunks, nested.trunk_text(F.col("t"))) == [
        "(5) a, (7) ", "", "",
    ]
