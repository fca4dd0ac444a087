"""Hand-written change feeds of a small insurer."""

from pyspark.sql import functions as F

HOLDERS = [  # id, city, risk, change
    (1, "Pune", "LOW", "2026-09-01T00:00:00"), (1, "Delhi", "LOW", "2026-09-28T09:00:00"),
    (2, "Delhi", "HIGH", "2026-09-01T00:00:00"), (3, "Chennai", "MEDIUM", "2026-09-01T00:00:00"),
    (3, "Chennai", "LOW", "2026-09-29T09:00:00"), (1, "Mumbai", "LOW", "2026-09-30T09:00:00"),
]
POLICIES = [  # id, holder, product, premium, issued
    ("POL-20260910-001", 1, "AUTO", 100.25, "2026-09-10T10:00:00"),
    ("POL-20260929-001", 1, "HOME", 200.50, "2026-09-29T10:00:00"),
    ("POL-20260929-002", 9, "LIFE", 300.00, "2026-09-29T10:30:00"),
    ("POL-20260930-001", 3, "LIFE", 50.75, "2026-09-30T10:00:00"),
]
CLAIMS = [  # id, policy, loss, reported, amount, status, change
    ("CLM-1", "POL-20260910-001", "2026-09-15", "2026-09-20", 10.0, "OPEN", "2026-09-20T11:00:00"),
    ("CLM-1", "POL-20260910-001", "2026-09-15", "2026-09-20", 12.5, "APPROVED", "2026-09-23T15:00:00"),
    ("CLM-2", "POL-20260929-001", "2026-09-29", "2026-09-29", 20.0, "OPEN", "2026-09-29T11:00:00"),
    ("CLM-1", "POL-20260910-001", "2026-09-15", "2026-09-20", 12.5, "PAID", "2026-09-29T15:00:00"),
    ("CLM-2", "POL-20260929-001", "2026-09-29", "2026-09-29", 20.0, "PAID", "2026-09-30T15:00:00"),
    ("CLM-3", "POL-20260930-001", "2026-08-01", "2026-09-30", 5.0, "OPEN", "2026-09-30T12:00:00"),
]


def _ntz(name):
    return F.col(name).cast("timestamp_ntz").alias(name)


def holders(spark, rows=HOLDERS):
    df = spark.createDataFrame(
        rows, "policyholder_id bigint, city string, risk_tier string, updated_at string")
    return df.select("policyholder_id", F.lit("Asha").alias("first_name"), F.lit("Rao").alias("last_name"),
                     F.lit("1980-02-03").cast("date").alias("date_of_birth"), "city",
                     F.lit("MH").alias("state"), "risk_tier", _ntz("updated_at"))


def policies(spark, rows=POLICIES):
    df = spark.createDataFrame(
        rows, "policy_id string, policyholder_id bigint, product_line string, annual_premium double, issued_at string")
    day = F.to_date("issued_at")
    return df.select("policy_id", "policyholder_id", "product_line", "annual_premium",
                     F.date_add(day, 1).alias("effective_date"), F.date_add(day, 366).alias("expiration_date"),
                     F.lit("ACTIVE").alias("status"), _ntz("issued_at"))


def claims(spark, rows=CLAIMS):
    df = spark.createDataFrame(
        rows, "claim_id string, policy_id string, loss_date string, reported_date string, "
        "claim_amount double, status string, updated_at string")
    return df.select("claim_id", "policy_id", F.col("loss_date").cast("date"), F.col("reported_date").cast("date"),
                     "claim_amount", "status", _ntz("updated_at"))


def feeds(spark):
    return {"policyholders": holders(spark), "policies": policies(spark), "claims": claims(spark)}
