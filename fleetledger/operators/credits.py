"""Credits and payments: flattening, addresses, terms and clamped balances."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetledger.functions import scalars, times
from fleetledger.operators.ordering import BROADCAST_ROWS, HOT_ROWS, first_per_key, running_total
from fleetledger.session import pin, require_utc

# Date formats of the record tables.
DISBURSED_FORMAT = "%Y-%m-%dT%H:%M:%S.%f"
PAYMENT_DATE_FORMAT = "%Y-%m-%d"

Derive = Callable[[Column], Column]
PAYMENT_ORDER = ("payment_date", "payment_id", "amount", "id")
RECORD = ("id", "payment_id", "credit_id", "amount", "payment_date")
ACCEPTABLE = "amount >= 0 and payment_id is not null and credit_id is not null"


def flatten_credits(raw: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Nested credit records to typed columns."""
    require_utc(raw.sparkSession)
    return raw.select(
        "id",
        scalars.whole_number("fields.credit_id", strict).alias("credit_id"),
        scalars.first_of("fields.client_link").alias("client_record_id"),
        scalars.whole_number("fields.investment", strict).alias("principal"),
        scalars.whole_number("fields.initial_debt", strict).alias("total_repayment"),
        times.epoch_seconds(times.strip_zulu("fields.disbursed"), DISBURSED_FORMAT, strict).alias("issuance_date"),
        scalars.term_days("fields.term_text", strict).alias("term_days"),
        scalars.non_empty("try_element_at(fields.client_address, 1)").alias("own_address"),
        scalars.published_flag(env).alias("is_published"),
    )


def flatten_payments(raw: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Nested payment records to typed columns."""
    require_utc(raw.sparkSession)
    return raw.select(
        "id",
        scalars.whole_number("fields.payment_id", strict).alias("payment_id"),
        scalars.whole_number("fields.credit_id", strict).alias("credit_id"),
        scalars.whole_number("fields.amount", strict).alias("amount"),
        times.epoch_seconds("fields.payment_date", PAYMENT_DATE_FORMAT, strict).alias("payment_date"),
        scalars.published_flag(env).alias("is_published"),
    )


def unpublished(records: DataFrame) -> DataFrame:
    return records.where(~F.col("is_published"))


def payments_pending(payments: DataFrame, credits: DataFrame) -> DataFrame:
    """Unpublished payments whose credit is published."""
    issued = credits.where("is_published").select("credit_id").distinct()
    return unpublished(payments).join(issued, "credit_id", "left_semi")


def resolve_addresses(credits: DataFrame, contacts: DataFrame,
                      derive: Derive = scalars.placeholder_address) -> tuple[DataFrame, DataFrame]:
    """Each credit's owner address, and the contacts that get a derived one (one row per contact)."""
    owners = contacts.select(
        F.col("id").alias("client_record_id"), F.col("fields.client_id").alias("client_id"),
        scalars.non_empty("fields.celo_address").alias("contact_address"))
    address = F.coalesce("own_address", "contact_address", derive(F.col("client_id")))
    resolved = (
        credits.join(owners, "client_record_id", "left")
        .withColumn("address", address)
        .withColumn("is_derived", F.coalesce("own_address", "contact_address").isNull())
        .drop("contact_address"))
    asking = credits.where(F.col("own_address").isNull()).select("client_record_id").distinct()
    updates = (
        owners.where(F.col("contact_address").isNull())
        .join(asking, "client_record_id", "left_semi")
        .select(F.col("client_record_id").alias("id"), derive(F.col("client_id")).alias("celo_address")))
    return resolved, updates


def issuable(credits: DataFrame, address: str = "address") -> DataFrame:
    """Credits that can be issued at all: with an id and an owner."""
    return credits.where(F.col("credit_id").isNotNull() & F.col(address).isNotNull())


def attempted(credits: DataFrame, attempts: DataFrame | None) -> DataFrame:
    """The credits a run has issued, by its attempts in order: those before the first failure.

    An id that was already taken counts as issued; no message counts as a failure. Without
    attempts every credit counts as issued.
    """
    if attempts is None:
        return credits
    status = F.coalesce(scalars.route_status("message"), F.lit("failed"))
    tried = attempts.select("seq", "credit_id", status.alias("status"))
    stop = tried.where("status = 'failed'").agg(F.min("seq")).first()[0]  # one number
    done = tried if stop is None else tried.where(F.col("seq") < stop)
    return credits.join(done.select("credit_id").distinct(), "credit_id", "left_semi")


def issue(credits: DataFrame, address: str = "address") -> DataFrame:
    """Credit state after issuing in order of issuance: the first issue of an id stands."""
    events = credits.select(
        "credit_id", "issuance_date", "id", F.col(address).alias("owner"), "principal",
        F.col("total_repayment").alias("outstanding"), "term_days")
    return first_per_key(events, "credit_id", ["issuance_date", "id"]).drop("id")


def issued_totals(credits: DataFrame) -> DataFrame:
    """What each credit owed when it was first issued, one row per credit."""
    events = credits.select("credit_id", "issuance_date", "id", "total_repayment")
    return first_per_key(events, "credit_id", ["issuance_date", "id"]).select("credit_id", "total_repayment")


def dedup_payments(payments: DataFrame) -> DataFrame:
    """The first record of each payment id, over all credits."""
    columns = [c for c in payments.columns if c in (*PAYMENT_ORDER, "credit_id")]
    return first_per_key(payments.select(*columns), "payment_id", PAYMENT_ORDER)


def acceptable(payments: DataFrame) -> DataFrame:
    """Records that can be recorded at all: an amount that is not negative, and both ids."""
    return payments.where(ACCEPTABLE)


def shared_ids(*tables: DataFrame) -> DataFrame:
    """Payment ids that more than one row of these tables has; only ids are moved."""
    ids = reduce(DataFrame.union, [t.select("payment_id") for t in tables])
    several = ids.groupBy("payment_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 and payment_id is not null")
    return pin(several.select("payment_id"))


def of_ids(payments: DataFrame, shared: DataFrame, found: int) -> DataFrame:
    """At least the payments of ``found`` ids; all, where the ids are too many to be sent to every task."""
    return payments.join(F.broadcast(shared), "payment_id", "left_semi") if found <= BROADCAST_ROWS else payments


def split_by(payments: DataFrame, shared: DataFrame, found: int) -> tuple[DataFrame, DataFrame | None]:
    """Payments whose id is not among ``found`` ids, and those whose id is; no table if there are no ids."""
    if not found:
        return payments, None
    if found <= BROADCAST_ROWS:
        return payments.join(F.broadcast(shared), "payment_id", "left_anti"), of_ids(payments, shared, found)
    # Moved once for both parts.
    marked = pin(payments.join(shared.withColumn("_several", F.lit(True)), "payment_id", "left"), "zstd")
    return marked.where("_several is null").drop("_several"), marked.where("_several").drop("_several")


def apply_payments(credits: DataFrame, payments: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Balance after each accepted payment; a payment beyond the balance is lowered to it.

    ``credits`` has one row per credit (``credit_id, total_repayment``); a credit
    that was never issued owes nothing. Without negative amounts the clamped
    balance is max(total - running sum, 0), which needs no row-by-row state.
    """
    valid = acceptable(payments)
    return _applied(credits, dedup_payments(valid), valid, hot_rows)


def _applied(credits: DataFrame, first: DataFrame, counted: DataFrame, hot_rows: int) -> DataFrame:
    """The same for acceptable payments of which each id has one; ``counted`` as in ``running_total``."""
    summed = running_total(
        first, "credit_id", ["payment_date", "payment_id"], "amount", "_paid",
        hot_rows=hot_rows, counted=counted,
        per_group=credits.select("credit_id", F.col("total_repayment").alias("_owed")))
    return summed.withColumn("_left", F.expr("coalesce(_owed, 0) - _paid")).selectExpr(
        *[c for c in summed.columns if not c.startswith("_")],
        "greatest(_left, 0) as balance", "greatest(_left + amount, 0) - greatest(_left, 0) as applied")


def outstanding(credits: DataFrame, applied: DataFrame) -> DataFrame:
    """Balance of every credit after all its payments."""
    paid = applied.groupBy("credit_id").agg(
        F.sum("applied").alias("paid"), F.count(F.lit(1)).alias("payments"))
    return credits.select("credit_id", "total_repayment").join(paid, "credit_id", "left").select(
        "credit_id", "total_repayment",
        F.coalesce("paid", F.lit(0)).alias("paid"), F.coalesce("payments", F.lit(0)).alias("payments"),
        (F.col("total_repayment") - F.coalesce("paid", F.lit(0))).alias("outstanding"))


def payment_outcomes(credits: DataFrame, payments: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """What became of every payment record.

    applied_full, clamped (also to zero), duplicate (the id was taken) or error (a
    record that cannot be recorded). Equal records are counted in ``records``
    rather than repeated.
    """
    valid = acceptable(payments)
    shared = shared_ids(valid)
    alone, together = split_by(valid.select(*RECORD), shared, shared.count())
    return recorded_outcomes(credits, alone, together, hot_rows).unionByName(unrecordable(payments))


def recorded_outcomes(credits: DataFrame, alone: DataFrame, together: DataFrame | None = None,
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """Outcomes of acceptable records: ``alone`` those whose id no other has, ``together`` those of shared ids.

    Records with an id of their own meet no others but those of their credit. Many copies of one
    record are combined before they meet; only the first of them can be other than a duplicate.
    """
    first = counted = alone.select(*RECORD)
    if together is not None:
        won = dedup_payments(together).select(*RECORD)
        first, counted = first.unionByName(won), counted.unionByName(together.select(*RECORD))
    status = F.when(F.col("applied") == F.col("amount"), "applied_full").otherwise("clamped")
    recorded = _applied(credits, first, counted, hot_rows).select(
        *RECORD, status.alias("outcome"), "applied", "balance", F.lit(1).cast("bigint").alias("records"))
    if together is None:
        return recorded
    record = F.struct(*RECORD)
    distinct = together.groupBy(*RECORD).agg(F.count(F.lit(1)).alias("_copies"))
    later = (
        distinct.join(won.select("payment_id", record.alias("_won")), "payment_id")
        .withColumn("_later", F.col("_copies") - F.when(F.col("_won").eqNullSafe(record), 1).otherwise(0)).where("_later > 0"))
    return recorded.unionByName(_without_effect(later, F.lit("duplicate"), "_later"))


def unrecordable(payments: DataFrame) -> DataFrame:
    """Outcomes of the records that are not ``acceptable``."""
    refused = payments.where(~F.coalesce(F.expr(ACCEPTABLE), F.lit(False)))
    return _without_effect(refused.groupBy(*RECORD).agg(F.count(F.lit(1)).alias("_n")), F.lit("error"), "_n")


def repeated_outcomes(payments: DataFrame) -> DataFrame:
    """Outcomes of records whose id was taken in an earlier run; what cannot be recorded at all stays an error."""
    status = F.expr("if(amount >= 0 and credit_id is not null, 'duplicate', 'error')")
    return _without_effect(payments.groupBy(*RECORD).agg(F.count(F.lit(1)).alias("_n")), status, "_n")


def _without_effect(records: DataFrame, outcome: Column, count: str) -> DataFrame:
    return records.select(
        *RECORD, outcome.alias("outcome"), F.lit(0).cast("bigint").alias("applied"),
        F.lit(None).cast("bigint").alias("balance"), F.col(count).cast("bigint").alias("records"))
