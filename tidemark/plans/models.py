"""The tables of the pipeline: bronze, staging, silver, snapshots, gold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import BEGINNING, OPEN_END, UNKNOWN_KEY, date_key, hash_key, or_unknown, unpacked_key, with_packed
from tidemark.operators import facts, history, selection, skew
from tidemark.operators.versions import latest_per, typed
from tidemark.spec import CLAIMS, MILESTONES, POLICIES, POLICYHOLDERS

LINEAGE = ("run_id", "source_file", "loaded_at")
LINEAGE_V1 = ("business_date", "source_file", "loaded_at")
LATEST_LOAD = ("loaded_at", "source_file")

# ------------------------------------------------------------ staging (v1)


def stg_policyholders(landing: DataFrame) -> DataFrame:
    """One row per customer and daily dump."""
    rows = typed(landing, POLICYHOLDERS.fields, LINEAGE_V1)
    return latest_per(rows, ["policyholder_id", "business_date"], LATEST_LOAD)


def stg_policies(landing: DataFrame) -> DataFrame:
    return latest_per(typed(landing, POLICIES.fields, LINEAGE_V1), ["policy_id"], LATEST_LOAD)


def stg_claims(landing: DataFrame) -> DataFrame:
    """One row per claim version. (Keyed on the claim: a policy can have several.)"""
    rows = typed(landing, CLAIMS.fields, LINEAGE_V1)
    return latest_per(rows, ["claim_id", "updated_at"], LATEST_LOAD)


# ------------------------------------------------------------ silver


def slv_policyholder_versions(bronze: DataFrame, target: DataFrame | None = None, **pick) -> DataFrame:
    """Typed versions, each once. With a target: only what was loaded since."""
    rows = typed(selection.incremental(bronze, target, **pick), POLICYHOLDERS.fields, LINEAGE)
    return latest_per(rows, ["policyholder_id", "updated_at"], LATEST_LOAD)


def slv_policyholders(versions: DataFrame) -> DataFrame:
    """Current state of every customer."""
    return latest_per(versions, ["policyholder_id"], ["updated_at"]).select(*POLICYHOLDERS.fields)


def slv_policies(bronze: DataFrame, target: DataFrame | None = None, **pick) -> DataFrame:
    rows = typed(selection.incremental(bronze, target, **pick), POLICIES.fields, LINEAGE)
    return latest_per(rows, ["policy_id"], ["issued_at", *LATEST_LOAD])


def slv_claim_events(bronze: DataFrame, target: DataFrame | None = None, **pick) -> DataFrame:
    rows = typed(selection.incremental(bronze, target, **pick), CLAIMS.fields, LINEAGE)
    return latest_per(rows, ["claim_id", "updated_at"], LATEST_LOAD)


# ------------------------------------------------------------ snapshots


def snap_api_policyholders(current: DataFrame, history_: DataFrame | None = None) -> DataFrame:
    return history.snapshot_merge(history_, current, "policyholder_id", "updated_at")


def snap_policyholders(staged: DataFrame, history_: DataFrame | None = None, day=None) -> DataFrame:
    """One daily dump against the history; days must come in order."""
    dump = selection.pick_business_date(staged, "business_date", day)
    return history.snapshot_merge(
        history_, dump.select(*POLICYHOLDERS.fields), "policyholder_id", "updated_at"
    )


# ------------------------------------------------------------ dimensions

_UNKNOWN_HOLDER = {
    "policyholder_sk": UNKNOWN_KEY, "policyholder_id": -1, "first_name": "Unknown",
    "last_name": "Unknown", "city": "Unknown", "state": "Unknown", "risk_tier": "Unknown",
    "valid_from": BEGINNING, "valid_to": OPEN_END, "is_current": True,
}
_HOLDER_ATTRIBUTES = ("first_name", "last_name", "date_of_birth", "city", "state", "risk_tier")


def dim_policyholder(versions: DataFrame, attributes: Sequence[str] = _HOLDER_ATTRIBUTES, **options) -> DataFrame:
    """Every customer version with its validity window and ``attributes``."""
    windows = history.scd2_windows(
        versions, "policyholder_id", "updated_at", attributes, sk="policyholder_sk", **options
    )
    return facts.with_unknown_member(windows, _UNKNOWN_HOLDER)


def late_policyholders(dim: DataFrame, versions: DataFrame, attributes: Sequence[str] = _HOLDER_ATTRIBUTES,
                       **options) -> tuple[DataFrame, DataFrame]:
    """Windows of arriving versions, and the windows they shorten."""
    return history.repaired_windows(
        dim, versions, "policyholder_id", "updated_at", attributes, sk="policyholder_sk", **options)


def dim_policyholder_snap(snapshot: DataFrame) -> DataFrame:
    """The same dimension from the snapshot history."""
    rows = snapshot.select(
        F.col("scd_id").alias("policyholder_sk"), "policyholder_id", *_HOLDER_ATTRIBUTES,
        "valid_from", "valid_to",
        (F.col("valid_to") == F.lit(OPEN_END).cast("timestamp_ntz")).alias("is_current"),
    )
    return facts.with_unknown_member(rows, _UNKNOWN_HOLDER)


_POLICY_ATTRIBUTES = ("product_line", "policy_status", "effective_date", "expiration_date", "term_days")


def dim_policy(policies: DataFrame, attributes: Sequence[str] = _POLICY_ATTRIBUTES) -> DataFrame:
    """Keys and ``attributes`` of every policy; facts that look up the key only ask for no attributes."""
    terms = {"term_days": F.datediff("expiration_date", "effective_date").cast("bigint").alias("term_days")}
    rows = policies.select(
        hash_key("policy_id").alias("policy_sk"), "policy_id", *[terms.get(c, F.col(c)) for c in attributes]
    )
    unknown = {"policy_sk": UNKNOWN_KEY, "policy_id": "UNKNOWN", "product_line": "Unknown",
               "policy_status": "Unknown"}
    return facts.with_unknown_member(rows, unknown)


# ------------------------------------------------------------ facts


def fct_policies_written(policies: DataFrame, dim_policy_: DataFrame, dim_holder: DataFrame,
                         pieces: skew.Pieces | str | None = skew.AUTO, keep: Sequence[str] = ()) -> DataFrame:
    """One row per policy, with the customer version valid at issue, and the policy's columns to ``keep`` beside the facts.

    Keys are packed while they are looked up.
    """
    keyed = facts.lookup(policies, with_packed(dim_policy_, "policy_sk"), "policy_id", ["policy_sk"], "inner")
    if pieces == skew.AUTO:  # looked for in the dimension as it is stored
        pieces = skew.find_pieces(dim_holder, "policyholder_id", "valid_from")
    rows = history.point_in_time(
        keyed, with_packed(dim_holder, "policyholder_sk"), "policyholder_id", "issued_at", ["policyholder_sk"], pieces=pieces
    )
    return rows.select(
        "policy_id",
        unpacked_key("policy_sk").alias("policy_sk"),
        or_unknown(unpacked_key("policyholder_sk")).alias("policyholder_sk"),
        date_key("issued_at").alias("issue_date_key"),
        date_key("effective_date").alias("effective_date_key"),
        "annual_premium",
        "issued_at",
        *keep,
    )


def fct_claims(
    events: DataFrame, policies: DataFrame, dim_policy_: DataFrame, dim_holder: DataFrame,
    target: DataFrame | None = None, also_changed: DataFrame | None = None,
    pieces: skew.Pieces | str | None = skew.AUTO,
) -> DataFrame:
    """One row per claim, milestones filled as they are reached.

    With a target only claims with new events are rebuilt, each from all of its
    events. ``also_changed`` adds claim ids to rebuild for other reasons, such
    as a customer version that arrived late.
    """
    if target is not None:
        changed = selection.changed_keys(events, target, "claim_id")
        if also_changed is not None:
            changed = changed.unionByName(also_changed.select("claim_id")).distinct()
        events = selection.events_of(events, changed, "claim_id")
    claims = facts.accumulate(
        events, "claim_id", "updated_at", "claim_status", MILESTONES,
        latest={"policy_id": "policy_id", "loss_date": "loss_date", "reported_date": "reported_date",
                "claim_amount": "claim_amount", "current_status": "claim_status"},
        loaded_at="loaded_at", ties=("source_file",),
    )
    if target is not None:  # few claims: whole tables shrink to what these refer to before any join
        wanted = events.select("policy_id").distinct()
        policies, dim_policy_ = (d.join(wanted, "policy_id", "left_semi") for d in (policies, dim_policy_))
        holders = policies.select("policyholder_id").distinct()
        dim_holder = dim_holder.join(holders, "policyholder_id", "left_semi")
    # left joins keep the claims' partitioning: these are shuffled by policy once, and so is either table
    owned = claims.join(policies.select("policy_id", "policyholder_id"), "policy_id", "left").join(
        dim_policy_.select("policy_id", "policy_sk"), "policy_id", "left"
    )
    rows = history.point_in_time(
        owned, dim_holder, "policyholder_id", F.col("loss_date").cast("timestamp_ntz"),
        ["policyholder_sk"], pieces=pieces,
    )
    return rows.select(
        "claim_id",
        or_unknown("policy_sk").alias("policy_sk"),
        or_unknown("policyholder_sk").alias("policyholder_sk"),
        *facts.date_keys({
            "loss_date_key": "loss_date", "reported_date_key": "reported_date",
            "approved_date_key": "approved_at", "rejected_date_key": "rejected_at",
            "paid_date_key": "paid_at",
        }),
        "current_status",
        "claim_amount",
        F.datediff(F.to_date("paid_at"), "reported_date").cast("bigint").alias("days_to_settle"),
        "last_updated_at",
        "last_loaded_at",
    )


# ------------------------------------------------------------ late customer versions


def rekeyed_policies_written(written: DataFrame, policies: DataFrame, arrived: DataFrame, **options) -> DataFrame:
    """Stored facts of policies issued within an arrived customer window, under its key."""
    return history.rekeyed(written, policies, arrived, "policy_id", "policyholder_id", "issued_at", "policyholder_sk",
                           packed=("policy_sk",), **options)


def rekeyed_claims(claims: DataFrame, policies: DataFrame, arrived: DataFrame, **options) -> DataFrame:
    """Stored facts of claims lost within an arrived customer window, under its key."""
    owners = policies.select(hash_key("policy_id").alias("policy_sk"), "policyholder_id")
    lost = F.to_date(F.col("loss_date_key").cast("string"), "yyyyMMdd").cast("timestamp_ntz")
    return history.rekeyed(claims, owners, arrived, "policy_sk", "policyholder_id", lost, "policyholder_sk", **options)
