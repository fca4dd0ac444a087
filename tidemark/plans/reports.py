"""Questions the star schema answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import with_packed
from tidemark.operators.history import current_only


def premium_by_month_city_product(
    fct: DataFrame, dim_policy: DataFrame, dim_holder: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Premium per month, city at the time of sale and product."""
    return (
        with_packed(fct, "policy_sk", "policyholder_sk").join(F.broadcast(dim_date.select("date_key", "calendar_month")),
                 F.col("issue_date_key") == F.col("date_key"))
        .join(with_packed(dim_policy, "policy_sk").select("policy_sk", "product_line"), "policy_sk")
        .join(with_packed(dim_holder, "policyholder_sk").select("policyholder_sk", "city"), "policyholder_sk")
        .groupBy("calendar_month", "city", "product_line")
        .agg(F.sum("annual_premium").alias("premium"))
    )


def claims_by_status(fct: DataFrame) -> DataFrame:
    return fct.groupBy("current_status").agg(
        F.count(F.lit(1)).alias("claims"), F.avg("days_to_settle").alias("avg_days_to_settle")
    )


def city_then_and_now(fct: DataFrame, dim_holder: DataFrame) -> DataFrame:
    """Where the customer lived at the time of the claim, and lives today."""
    then = dim_holder.select("policyholder_sk", "policyholder_id", F.col("city").alias("city_then"))
    now = current_only(dim_holder).select("policyholder_id", F.col("city").alias("city_now"))
    # the dimension side is put together first: one lookup per claim
    cities = then.join(now, "policyholder_id").select("policyholder_sk", "city_then", "city_now")
    return fct.join(cities, "policyholder_sk").select(
        "claim_id", "policyholder_sk", "city_then", "city_now"
    )


def current_owner(policies: DataFrame, dim_holder: DataFrame, column: str = "city") -> DataFrame:
    owner = current_only(dim_holder).select("policyholder_id", F.col(column).alias(f"current_{column}"))
    return policies.join(owner, "policyholder_id").select("policy_id", f"current_{column}")
