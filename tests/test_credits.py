import collections
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.operators import credits
from fleetledger.plans import credit_pipeline

PAYMENTS = "id string, payment_id bigint, credit_id bigint, amount bigint, payment_date bigint"
DAY = 86_400


def contract(totals, payments):
    """Record payments one by one: ids once, the amount lowered to the balance on overflow."""
    balance, taken, out = dict(totals), set(), []
    for p in sorted(payments, key=lambda p: (p[4], p[1], p[3], p[0])):
        rec, pid, cid, amount, _ = p
        if amount < 0:
            out.append((rec, "error", 0))
        elif pid in taken:
            out.append((rec, "duplicate", 0))
        else:
            taken.add(pid)
            applied = min(amount, balance.get(cid, 0))
            balance[cid] = balance.get(cid, 0) - applied
            out.append((rec, "applied_full" if applied == amount else "clamped", applied))
    return balance, out


@pytest.mark.parametrize("hot_rows, seed", [(10, 1), (1_000_000, 2)])
def test_payments_equal_the_contract(spark, hot_rows, seed):
    rng = random.Random(seed)
    totals = {c: rng.randrange(0, 3000) for c in range(1, 30)}
    payments = [
        (f"r{i}", rng.randrange(1, 700), 5 if i % 3 == 0 else rng.randrange(1, 32), rng.randrange(-5, 200), rng.randrange(20) * DAY)
        for i in range(900)]
    payments += [payments[0]] * 50 + [payments[7]] * 3  # copies of one record
    balance, expected = contract(totals, payments)
    state = spark.createDataFrame(list(totals.items()), "credit_id bigint, total_repayment bigint")
    df = spark.createDataFrame(payments, PAYMENTS).repartition(3)
    got = collections.Counter()
    for r in credits.payment_outcomes(state, df, hot_rows).collect():
        got[(r.id, r.outcome, r.applied)] += r.records
    assert got == collections.Counter(expected)
    applied = credits.apply_payments(state, df, hot_rows)
    left = {r.credit_id: r.outstanding for r in credits.outstanding(state, applied).collect()}
    assert left == {c: balance[c] for c in totals}
    assert applied.where("applied > amount or balance < 0 or applied < 0").count() == 0


def test_negative_amount_does_not_take_the_id(spark):
    state = spark.createDataFrame([(1, 100)], "credit_id bigint, total_repayment bigint")
    df = spark.createDataFrame([("a", 1, 1, -5, 0), ("b", 1, 1, 30, DAY), ("c", 2, 9, 10, 0), ("d", 3, 1, None, 0)], PAYMENTS)
    got = {r.id: (r.outcome, r.applied) for r in credits.payment_outcomes(state, df).collect()}
    assert got == {"a": ("error", 0), "b": ("applied_full", 30), "c": ("clamped", 0), "d": ("error", 0)}


def record(rid, credit_id, link, address, flag, term="4 semanas", debt=1000.9, disbursed="2024-01-02T00:00:00.000Z"):
    return (rid, (credit_id, link, 800.7, debt, disbursed, term, address, flag, None))


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame([
        record("c1", 1, ["k1"], ["0xA"], None), record("c2", 2, ["k1"], None, False), record("c3", 3, ["k2"], [], None),
        record("c4", 4, ["k2"], None, True, disbursed="2024-01-02T00:00:00.5"), record("c5", 5, None, None, False)],
        schemas.CREDITS_RAW)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame([("k1", (11, [], "0xK")), ("k2", (12, None, None)), ("k3", (13, None, None))], schemas.CONTACTS)


def test_credit_run(records, people):
    derive = lambda c: F.concat(F.lit("d"), c.cast("string"))
    run = credit_pipeline.publish_credits(records, people, "staging", derive)
    got = {r.credit_id: (r.owner, r.principal, r.outstanding, r.issuance_date, r.term_days) for r in run.state.collect()}
    assert got == {1: ("0xA", 800, 1000, 1704153600, 28), 2: ("0xK", 800, 1000, 1704153600, 28),
                   3: ("d12", 800, 1000, 1704153600, 28)}
    assert {r.id: r.fields.celo_address for r in run.contacts.collect()} == {"k1": "0xK", "k2": "d12", "k3": None}
    # A credit without an owner is not issued and not flagged.
    assert {r.id: r.fields.published_staging for r in run.records.collect()} == {**dict.fromkeys(["c1", "c2", "c3", "c4"], True), "c5": False}
    assert tuple(run.outcome.first()) == (4, 3, False)
    assert run.records.schema == records.schema
    assert credits.unpublished(credits.flatten_credits(records, "production")).count() == 5


def test_first_issue_of_a_credit_stands(spark, people):
    rows = [record("c2", 1, ["k1"], ["0xB"], None, debt=500.0, disbursed="2024-01-03T00:00:00.0"), record("c1", 1, ["k1"], ["0xA"], None)]
    raw = spark.createDataFrame(rows, schemas.CREDITS_RAW)
    state = credit_pipeline.publish_credits(raw, people, "staging").state.collect()
    assert [(r.credit_id, r.owner, r.outstanding) for r in state] == [(1, "0xA", 1000)]


def test_bad_records(spark):
    raw = spark.createDataFrame([record("c1", 1, [], None, None, term="soon")], schemas.CREDITS_RAW)
    with pytest.raises(PySparkException):
        credits.flatten_credits(raw, "staging").collect()
    assert credits.flatten_credits(raw, "staging", strict=False).first().term_days is None
    late = spark.createDataFrame([record("c1", 1, [], None, None, disbursed="2024-01-02")], schemas.CREDITS_RAW)
    with pytest.raises(PySparkException):
        credits.flatten_credits(late, "staging").collect()


def test_payment_run(spark, records):
    rows = [("p1", (1, 4, 600.9, "2024-02-01", None, None)), ("p2", (2, 4, 600.0, "2024-02-02", False, None)),
            ("p3", (2, 4, 1.0, "2024-02-03", False, None)), ("p4", (3, 4, 5.0, "2024-02-01", True, None)),
            ("p5", (4, 1, 5.0, "2024-02-01", None, None)), ("p6", (5, 4, -1.0, "2024-02-01", None, None))]
    raw = spark.createDataFrame(rows, schemas.PAYMENTS_RAW)
    run = credit_pipeline.publish_payments(raw, records, "staging")
    assert {r.id: (r.outcome, r.applied) for r in run.outcomes.collect()} == {
        "p1": ("applied_full", 600), "p2": ("clamped", 400), "p3": ("duplicate", 0), "p6": ("error", 0)}
    assert {r.id: r.fields.published_staging for r in run.records.collect()} == {
        "p1": True, "p2": True, "p3": True, "p4": True, "p5": None, "p6": None}
    assert {r.credit_id: r.outstanding for r in run.outstanding.collect()}[4] == 0


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_balances_do_not_depend_on_how_large_a_credit_is(spark, hot_rows):
    totals = spark.createDataFrame([(1, 100)], "credit_id bigint, total_repayment bigint")
    rows = [("a", 1, 1, 30, None), ("b", 2, 1, 20, -5), ("c", 3, 1, 20, 200_000), ("d", 4, 1, 60, 300_000)]
    payments = spark.createDataFrame(rows, "id string, payment_id bigint, credit_id bigint, amount bigint, payment_date bigint")
    got = {r.id: (r.outcome, r.applied, r.balance) for r in credits.payment_outcomes(totals, payments, hot_rows).collect()}
    assert got == {"a": ("applied_full", 30, 70), "b": ("applied_full", 20, 50), "c": ("applied_full", 20, 30), "d": ("clamped", 30, 0)}


def test_credits_without_an_id_raise_or_stay(spark, people):
    raw = spark.createDataFrame([record("c1", None, ["k1"], ["0xA"], None), record("c2", None, ["k1"], ["0xB"], None), record("c3", 3, ["k1"], ["0xC"], None)],
                                schemas.CREDITS_RAW)
    with pytest.raises(PySparkException):
        credit_pipeline.publish_credits(raw, people, "staging").state.collect()
    run = credit_pipeline.publish_credits(raw, people, "staging", strict=False)
    assert [r.credit_id for r in run.state.collect()] == [3]
    assert {r.id: r.fields.published_staging for r in run.records.collect()} == {"c1": None, "c2": None, "c3": True}


def test_a_credit_run_stops_at_its_first_failure(spark, people):
    raw = spark.createDataFrame([record(f"c{k}", k, ["k1"], ["0xA"], None) for k in range(1, 7)] + [record("c1", 1, ["k1"], ["0xA"], None)], schemas.CREDITS_RAW)

    def run(*messages):
        rows = [(k, k, m) for k, m in enumerate(messages, 1)]
        found = credit_pipeline.publish_credits(raw, people, "staging", attempts=spark.createDataFrame(rows, schemas.CREDIT_ATTEMPTS))
        assert found.records.count() == raw.count()  # a repeated record stays as often as it was
        return sorted(r.credit_id for r in found.state.collect()), tuple(found.outcome.first())

    minted = "execution reverted: ERC721: token already minted"
    assert run("ok", minted, "ok", "nonce too low", "ok", "ok") == ([1, 2, 3], (7, 4, False))
    assert run("ok", "ok", None, "ok", "ok", "ok") == ([1, 2], (7, 3, False))  # no receipt
    assert run(*["ok"] * 6) == ([1, 2, 3, 4, 5, 6], (7, 7, True))


def test_a_taken_id_without_a_credit_is_an_error_in_either_run(spark):
    totals = spark.createDataFrame([(1, 100)], "credit_id bigint, total_repayment bigint")
    columns = "id string, payment_id bigint, credit_id bigint, amount bigint, payment_date bigint"
    both = spark.createDataFrame([("a", 1, 1, 5, 0), ("b", 1, None, 5, 1)], columns)
    assert {r.id: r.outcome for r in credits.payment_outcomes(totals, both).collect()} == {"a": "applied_full", "b": "error"}
    assert credits.repeated_outcomes(both.where("id = 'b'")).first().outcome == "error"
