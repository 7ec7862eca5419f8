"""Publication ledgers: what is pending, what a run achieved, what the state is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetledger.functions import scalars
from fleetledger.operators.ordering import first_per_key, number_rows

# A run stops once this share of its budget is spent.
BUDGET_SHARE = 0.9
# Rows of one day are summed in blocks of this many sequence numbers.
BLOCK = 65_536

DONE = ("sent", "already_minted")
SENT_FIELDS = ("nonce", "gas_price", "tx_hash")


def pending(items: DataFrame, ledger: DataFrame, key: str = "route_id") -> DataFrame:
    """Items whose key is not in the ledger."""
    return items.join(ledger.select(key), key, "left_anti")


def held_back(items: DataFrame, address: str = "celo_address") -> DataFrame:
    """Add ``held``: whether an item cannot be sent for want of an address."""
    return items.withColumn("held", F.col(address).isNull())


def publishable(items: DataFrame, address: str = "celo_address") -> tuple[DataFrame, DataFrame]:
    """Split into items that can be sent and items held back."""
    marked = held_back(items, address)
    return marked.where("not held").drop("held"), marked.where("held").drop("held")


def classify(attempts: DataFrame, message: str = "message") -> DataFrame:
    """Add ``status``: sent, already_minted or failed."""
    return attempts.withColumn("status", scalars.route_status(message))


def prefix_until_failure(results: DataFrame, day: str = "date", order: str = "seq") -> DataFrame:
    """Rows of each day before its first failure; later rows stay pending. Rows without a day are a day of their own."""
    stops = results.where("status = 'failed'").groupBy(F.col(day).alias("_of")).agg(F.min(order).alias("_stop"))
    return (
        results.join(stops, F.col(day).eqNullSafe(F.col("_of")), "left")
        .where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop")))
        .drop("_stop", "_of"))


def within_budget(items: DataFrame, budget: float, cost: str = "cost", day: str = "date", order: str = "seq",
                  block: int = BLOCK) -> DataFrame:
    """Rows of each day whose preceding rows cost at most 90 % of the budget.

    Sums per block of the sequence come first; only blocks that start within the limit
    are looked into, and a day's rows are spread over its blocks.
    """
    limit = BUDGET_SHARE * budget
    # Rows without a day are a day of their own; rows without a number come first in theirs.
    blocked = items.withColumn("_block", F.expr(f"coalesce({order} div {int(block)}, -1L)")).withColumn("_day", F.col(day))
    earlier = Window.partitionBy("_day").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy("_day", "_block").agg(F.sum(cost).alias("_cost"))
        .select("_day", "_block", F.coalesce(F.sum("_cost").over(earlier), F.lit(0)).alias("_start"))
        .where(F.col("_start") <= limit).withColumnsRenamed({"_day": "_of", "_block": "_at"}))
    before = Window.partitionBy("_day", "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_day").eqNullSafe(F.col("_of")) & (F.col("_block") == F.col("_at"))
    return (
        blocked.join(starts, same)
        .withColumn("spent", F.col("_start") + F.coalesce(F.sum(cost).over(before), F.lit(0)))
        .where(F.col("spent") <= limit)
        .drop("_block", "_start", "_day", "_of", "_at"))


def assign_nonces(sent: DataFrame, base: int, order: Sequence[str] = ("date", "seq")) -> DataFrame:
    """Number the rows that are sent, from ``base``; skipped rows take no number."""
    return number_rows(sent, order, "_index").withColumn("nonce", F.col("_index") + base).drop("_index")


def merge(ledger: DataFrame, results: DataFrame, key: str = "route_id", order: Sequence[str] = ("seq",),
          new_only: bool = False) -> DataFrame:
    """Ledger plus newly done items. Known keys keep their entry, a repeated key its first result.

    ``new_only`` states that ``results`` come from ``pending`` items, which saves
    looking them up in the ledger again.
    """
    # Only a route that was sent has a nonce, gas price and hash of its own.
    sent = {c: F.when(F.col("status") == "sent", F.col(c)) for c in SENT_FIELDS if c in results.columns}
    done = results.withColumns(sent) if sent else results
    done = done.where(F.col("status").isin(*DONE)).select(*[c for c in results.columns if c in (*ledger.columns, *order)])
    fresh = first_per_key(done, key, order)
    fresh = fresh if new_only else pending(fresh, ledger, key)
    return ledger.unionByName(fresh.select([c for c in fresh.columns if c in ledger.columns]), allowMissingColumns=True)


def outcome(items: DataFrame, ledger: DataFrame, day: str = "date") -> DataFrame:
    """Per day: items, published so far (older entries count) and whether the run is complete. No day is a day too."""
    total = items.groupBy(day).agg(F.count(F.lit(1)).alias("total"))
    done = ledger.where(F.col("status").isin(*DONE)).groupBy(F.col(day).alias("_of")).agg(F.count(F.lit(1)).alias("published"))
    return total.join(done, F.col(day).eqNullSafe(F.col("_of")), "left").select(
        day, "total", F.coalesce("published", F.lit(0)).alias("published"),
        (F.coalesce("published", F.lit(0)) >= F.col("total")).alias("all_success"))


def first_write(events: DataFrame, key: str = "token_id", order: str = "seq") -> DataFrame:
    """State after an append-once log: a later write to the same key changes nothing."""
    return first_per_key(events, key, [order])
