"""Storage allocated to the hardware of each account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudtally.functions import nested
from cloudtally.operators.lookup import lookup_join


def hardware_storage(allowed: DataFrame) -> DataFrame:
    """Servers with at least one volume, their volumes kept nested."""
    volumes = F.transform(
        "allowedNetworkStorage",
        lambda v: F.struct(
            v["id"].alias("storageId"),
            F.coalesce(v["nasType"], F.lit("")).alias("storageType"),
            F.coalesce(v["iops"], F.lit(0.0)).alias("iops"),
            F.coalesce(v["capacityGb"], F.lit(0)).alias("capacityGb"),
            F.coalesce(v["bytesUsed"], F.lit(0)).alias("bytesUsed"),
        ),
    )
    system = nested.first_field(F.col("softwareComponents"), "softwareLicense", "softwareDescription", "name")
    return allowed.filter(F.size("allowedNetworkStorage") > 0).select(
        "accountId",
        F.col("id").alias("hardwareId"),
        F.col("datacenter.name").alias("datacenter"),
        F.coalesce(system, F.lit("")).alias("os"),
        volumes.alias("storage"),
    )


def account_records(accounts: DataFrame, allowed: DataFrame, errors: DataFrame) -> DataFrame:
    """One record per server of a listed account, its volumes nested, and one per account without servers.

    The latter has the error of the account's retrieval, or none. Hardware of a failed account is left out.
    """
    failed = errors.select("accountId", "error").groupBy("accountId").agg(F.min("error").alias("error"))
    listed = lookup_join(accounts.select("accountId"), failed, "accountId", "accountId", ["error"])
    servers = hardware_storage(allowed).withColumnRenamed("accountId", "owner")
    owned = (F.col("accountId") == F.col("owner")) & F.col("error").isNull()
    return listed.join(servers, owned, "left").select(
        "accountId", "error", "hardwareId", "datacenter", "os", "storage"
    )


def account_summary(accounts: DataFrame, errors: DataFrame) -> DataFrame:
    """Number of listed accounts, and how many succeeded and failed."""
    failed = errors.select("accountId").distinct().withColumn("_failed", F.lit(True))
    marked = lookup_join(accounts.select("accountId"), failed, "accountId", "accountId", {"_failed": "_failed"})
    return marked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_failed").isNull()).alias("successful"),
        F.count_if(F.col("_failed").isNotNull()).alias("failed"),
    )
