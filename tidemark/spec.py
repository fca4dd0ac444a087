"""Entities and contracts of the insurance star schema.

The operators take names as parameters; this module holds the one set of names
the shipped models use.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class EntitySpec:
    """A change feed: business key, change timestamp, fields with their types."""

    name: str
    key: str
    cursor: str
    fields: Mapping[str, tuple[str, str]]


POLICYHOLDERS = EntitySpec(
    "policyholders",
    "policyholder_id",
    "updated_at",
    {
        "policyholder_id": ("policyholder_id", "bigint"),
        "first_name": ("first_name", "string"),
        "last_name": ("last_name", "string"),
        "date_of_birth": ("date_of_birth", "date"),
        "city": ("city", "string"),
        "state": ("state", "string"),
        "risk_tier": ("risk_tier", "string"),
        "updated_at": ("updated_at", "timestamp_ntz"),
    },
)

POLICIES = EntitySpec(
    "policies",
    "policy_id",
    "issued_at",
    {
        "policy_id": ("policy_id", "string"),
        "policyholder_id": ("policyholder_id", "bigint"),
        "product_line": ("product_line", "string"),
        "annual_premium": ("annual_premium", "decimal(12,2)"),
        "effective_date": ("effective_date", "date"),
        "expiration_date": ("expiration_date", "date"),
        "policy_status": ("status", "string"),
        "issued_at": ("issued_at", "timestamp_ntz"),
    },
)

CLAIMS = EntitySpec(
    "claims",
    "claim_id",
    "updated_at",
    {
        "claim_id": ("claim_id", "string"),
        "policy_id": ("policy_id", "string"),
        "loss_date": ("loss_date", "date"),
        "reported_date": ("reported_date", "date"),
        "claim_amount": ("claim_amount", "decimal(12,2)"),
        "claim_status": ("status", "string"),
        "updated_at": ("updated_at", "timestamp_ntz"),
    },
)

ENTITIES = {e.name: e for e in (POLICYHOLDERS, POLICIES, CLAIMS)}

# The allowed codes of the source system.
RISK_TIERS = ("LOW", "MEDIUM", "HIGH")
PRODUCT_LINES = ("AUTO", "HOME", "LIFE")
CLAIM_STATUSES = ("OPEN", "APPROVED", "REJECTED", "PAID")
MILESTONES = {"approved_at": "APPROVED", "rejected_at": "REJECTED", "paid_at": "PAID"}


def contract(**columns: str) -> T.StructType:
    """Schema from ``name="type"``; a trailing ``!`` means not null."""
    ddl = [f"`{name}` {kind[:-1]} NOT NULL" if kind.endswith("!") else f"`{name}` {kind}"
           for name, kind in columns.items()]
    return T.StructType.fromDDL(", ".join(ddl))


def contracts() -> dict[str, T.StructType]:
    """Enforced contracts of the gold tables (needs a running session to parse types)."""
    holder = contract(
        policyholder_sk="string!", policyholder_id="bigint!", first_name="string",
        last_name="string", date_of_birth="date", city="string", state="string",
        risk_tier="string", valid_from="timestamp_ntz!", valid_to="timestamp_ntz!",
        is_current="boolean",
    )
    return {
        "dim_date": contract(
            date_key="int!", date_day="date", calendar_year="int", calendar_quarter="int",
            calendar_month="int", month_name="string", day_of_month="int", day_of_week="int",
            day_name="string", is_weekend="boolean", month_start_date="date",
        ),
        "dim_policyholder": holder,
        "dim_policyholder_snap": holder,
        "dim_policy": contract(
            policy_sk="string!", policy_id="string!", product_line="string",
            policy_status="string", effective_date="date", expiration_date="date",
            term_days="bigint",
        ),
        "fct_policies_written": contract(
            policy_id="string!", policy_sk="string!", policyholder_sk="string!",
            issue_date_key="int", effective_date_key="int", annual_premium="decimal(12,2)",
            issued_at="timestamp_ntz",
        ),
        "fct_claims": contract(
            claim_id="string!", policy_sk="string!", policyholder_sk="string!",
            loss_date_key="int", reported_date_key="int", approved_date_key="int",
            rejected_date_key="int", paid_date_key="int", current_status="string",
            claim_amount="decimal(12,2)", days_to_settle="bigint",
            last_updated_at="timestamp_ntz", last_loaded_at="timestamp",
        ),
    }
