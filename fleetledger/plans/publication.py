"""One publication run over all days: what was pending, how far it came, the new ledger."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetledger.operators import ledger as ops
from fleetledger.operators.ordering import number_rows


@dataclass(frozen=True)
class PublicationRun:
    completed: DataFrame
    ledger: DataFrame
    outcome: DataFrame


def plan(ready: DataFrame, next_nonce: int, budget: float | None = None, cost: str = "cost") -> DataFrame:
    """What one run sends: ready routes in order of day and id, as far as the budget goes, each with its nonce.

    ``seq`` numbers the routes over all days. Routes need their expected ``cost`` where there is a budget.
    """
    numbered = number_rows(ready, ["date", "routeid"], "seq")
    if budget is not None:
        numbered = ops.within_budget(numbered, budget, cost)
    return ops.assign_nonces(numbered, next_nonce)


def reconcile(items: DataFrame, ledger: DataFrame, attempts: DataFrame, environment: str) -> PublicationRun:
    """Fold the attempts' results into the ledger.

    Attempts on published routes are not part of the run; each day counts up to
    its first failure; the merged ledger is what the next run resumes from, also
    after a partial failure.
    """
    tried = ops.classify(ops.pending(attempts, ledger))
    completed = ops.prefix_until_failure(tried)
    merged = ops.merge(ledger, completed.withColumn("environment", F.lit(environment)), new_only=True)
    return PublicationRun(completed, merged, ops.outcome(items, merged))


def recorded_events(routes: DataFrame, completed: DataFrame) -> DataFrame:
    """A ``RouteRecorded`` event for each route that was sent, in the form of the event log.

    ``routes`` are finished routes. The block is the attempt's ``block`` where it names one, else its nonce, else its
    place: each orders events as they were sent. A route that was recorded before sends no event.
    """
    sent = completed.where("status = 'sent'")
    places = [F.col(c) for c in ("block", "nonce", "seq") if c in sent.columns]
    at = sent.select(F.col("route_id").alias("_route"), F.coalesce(*places).cast("bigint").alias("block"), "seq")
    args = F.struct(F.col("celo_address").alias("to"), F.col("routeid").alias("token_id"), F.col("timestampstart").alias("timestamp_start"),
                    F.col("timestampend").alias("timestamp_end"), F.col("measureddistance").alias("distance"))
    return routes.join(at, routes["routeid"] == at["_route"]).select(
        F.lit("RouteRecorded").alias("event"), "block", "seq", args.alias("args"))
