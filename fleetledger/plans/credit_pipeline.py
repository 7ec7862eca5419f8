"""Credits, then payments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetledger.functions import scalars
from fleetledger.operators import credits as ops
from fleetledger.operators import metrics
from fleetledger.session import pin
from fleetledger.sources import writers


@dataclass(frozen=True)
class CreditRun:
    """``issued`` are the credits this run has issued, ``outcome`` one row: how many of how many.

    ``addresses`` and ``flags`` are the values to write back to contacts and records; those two have them applied.
    """

    issued: DataFrame
    state: DataFrame
    contacts: DataFrame
    records: DataFrame
    outcome: DataFrame
    addresses: DataFrame
    flags: DataFrame


@dataclass(frozen=True)
class PaymentRun:
    applied: DataFrame
    outcomes: DataFrame
    outstanding: DataFrame
    records: DataFrame


def publish_credits(raw: DataFrame, contacts: DataFrame, env: str, derive: ops.Derive = scalars.placeholder_address,
                    strict: bool = True, attempts: DataFrame | None = None) -> CreditRun:
    """Issue unpublished credits; returns the state and both record tables with their updates.

    Addresses are derived and written back before the publication test, as a
    contact may need one although its credit is already issued. Only credits that
    ``attempts`` (the run's results in order; all, if none are given) have issued are in
    the state and get their flag; the others, and those without id or owner, stay pending.
    """
    credits, updates = ops.resolve_addresses(ops.flatten_credits(raw, env, strict), contacts, derive)
    waiting = ops.unpublished(credits)
    issued = ops.attempted(ops.issuable(waiting), attempts)
    flags = issued.select("id", F.lit(True).alias(f"published_{env}")).distinct()
    done = waiting.select("id", "credit_id").join(flags, "id", "left")
    return CreditRun(
        issued, ops.issue(issued),
        writers.upsert_fields(contacts, updates, ["celo_address"]),
        writers.upsert_fields(raw, flags, [f"published_{env}"]),
        metrics.run_outcome(done, f"published_{env} is not null"), updates, flags)


def publish_payments(raw: DataFrame, credits_raw: DataFrame, env: str, strict: bool = True,
                     recorded: DataFrame | None = None) -> PaymentRun:
    """Record unpublished payments of published credits; duplicates count as published.

    ``recorded`` are the outcomes of earlier runs: their ids are taken, and what they
    applied is no longer owed. The pending payments, usually a small part of all, and
    their outcomes are pinned, as several later steps read them.
    """
    credits = ops.flatten_credits(credits_raw, env, strict)
    state = ops.issued_totals(credits)
    pending = ops.payments_pending(ops.flatten_payments(raw, env, strict), credits).drop("is_published")
    if recorded is None:
        outcomes = ops.payment_outcomes(state, pin(pending))
    else:
        accepted = recorded.where("outcome in ('applied_full', 'clamped')")
        paid = accepted.groupBy("credit_id").agg(F.sum("applied").alias("_paid"))
        state = state.join(paid, "credit_id", "left").selectExpr(
            "credit_id", "total_repayment - coalesce(_paid, 0) as total_repayment")
        taken = accepted.select("payment_id", F.lit(True).alias("_taken"))  # an id is accepted once
        pending = pin(pending.join(taken, "payment_id", "left"))
        fresh, repeated = (pending.where(f"_taken is {test}").drop("_taken") for test in ("null", "not null"))
        outcomes = ops.payment_outcomes(state, fresh).unionByName(ops.repeated_outcomes(repeated))
    outcomes = pin(outcomes)
    applied = outcomes.where("outcome in ('applied_full', 'clamped')").drop("outcome", "records")
    done = outcomes.where("outcome <> 'error'").select("id").distinct().withColumn(f"published_{env}", F.lit(True))
    return PaymentRun(
        applied, outcomes, ops.outstanding(state, applied), writers.upsert_fields(raw, done, [f"published_{env}"]))
