import datetime

import pytest
from pyspark.sql import functions as F

from fleetledger import schemas
from fleetledger.operators import ledger, metrics
from fleetledger.plans import publication

D1, D2 = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
OK, MINTED, BAD = "ok", "execution reverted: ERC721: token already minted", "nonce too low"


def entry(route_id, day=D1, status="sent"):
    return ("staging", day, route_id, status, 1, 1, "0x")


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame([entry(1), entry(9, D2)], schemas.LEDGER)


@pytest.fixture(scope="module")
def attempts(spark):
    rows = [(D1, 0, 1, BAD, 5), (D1, 1, 2, OK, 5), (D1, 2, 3, MINTED, 5), (D1, 3, 2, OK, 5), (D1, 4, 4, BAD, 5), (D1, 5, 5, OK, 5),
            (D2, 6, 6, OK, 5), (D2, 7, 9, OK, 5)]
    return spark.createDataFrame([(*r, 50 + r[1], 9, f"0x{r[1]}") for r in rows], schemas.ATTEMPTS)


def test_reconcile(spark, stored, attempts):
    run = publication.reconcile(attempts.select("date", "route_id").distinct(), stored, attempts, "staging")
    assert sorted((r.seq, r.status) for r in run.completed.collect()) == [
        (1, "sent"), (2, "already_minted"), (3, "sent"), (6, "sent")]
    assert sorted((r.route_id, r.status, r.environment) for r in run.ledger.collect()) == [
        (1, "sent", "staging"), (2, "sent", "staging"), (3, "already_minted", "staging"), (6, "sent", "staging"), (9, "sent", "staging")]
    assert {r.date: (r.total, r.published, r.all_success) for r in run.outcome.collect()} == {D1: (5, 3, False), D2: (2, 2, True)}
    # a second run with the same attempts adds nothing, and the merged items are no longer pending
    again = publication.reconcile(attempts, run.ledger, attempts.where("seq < 4"), "staging")
    assert again.ledger.count() == run.ledger.count()
    assert sorted(r.route_id for r in ledger.pending(attempts, run.ledger).collect()) == [4, 5]


def test_merge_is_idempotent(stored, attempts):
    results = ledger.classify(attempts)
    once = ledger.merge(stored, results)
    twice = ledger.merge(once, results)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert once.select("route_id").distinct().count() == once.count()


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_budget_equals_loop(spark, block):
    rows = [(D1 if i % 3 else D2, i, i, OK, i * 7 % 13) for i in range(300)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], schemas.ATTEMPTS)
    expected = []
    for day in (D1, D2):
        elapsed = 0
        for _, seq, _, _, cost in (r for r in rows if r[0] == day):
            if elapsed > 400 * 0.9:
                break
            expected.append((seq, elapsed))
            elapsed += cost
    got = ledger.within_budget(df, 400, block=block).select("seq", "spent").collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def test_budget_bound_is_inclusive(spark):
    df = spark.createDataFrame([(D1, i, i, OK, 9, None, None, None) for i in range(20)], schemas.ATTEMPTS)
    assert sorted(r.seq for r in ledger.within_budget(df, 100).collect()) == list(range(11))


def test_nonces_only_count_sent_rows(spark, stored, attempts):
    run = publication.reconcile(attempts, stored, attempts, "staging")
    got = ledger.assign_nonces(run.completed.where("status = 'sent'"), 40).orderBy("seq").collect()
    assert [(r.seq, r.nonce) for r in got] == [(1, 40), (3, 41), (6, 42)]


def test_prefix_without_failure(spark):
    df = spark.createDataFrame([(D1, 1, 1, OK, 1, None, None, None), (D2, 2, 2, BAD, 1, None, None, None)], schemas.ATTEMPTS)
    assert [r.seq for r in ledger.prefix_until_failure(ledger.classify(df)).collect()] == [1]


def test_held_back_routes(spark):
    df = spark.createDataFrame([(1, "0x1"), (2, None)], "routeid bigint, celo_address string")
    ready, held = ledger.publishable(df)
    assert [r.routeid for r in ready.collect()] == [1] and [r.routeid for r in held.collect()] == [2]


def test_first_write_under_copies(spark):
    rows = [(i, 1 if i % 3 == 0 else i, f"o{i}") for i in range(300)] + [(0, 1, "o0")] * 200
    df = spark.createDataFrame(rows, "seq bigint, token_id bigint, owner string").repartition(5)
    got = {r.token_id: (r.seq, r.owner) for r in ledger.first_write(df).collect()}
    assert got[1] == (0, "o0") and got[2] == (2, "o2") and len(got) == 200


def test_metrics(spark):
    df = spark.createDataFrame(
        [("0x1", D1, 0, 60, 100), ("0x1", D1, 60, 180, 50), (None, D1, 0, 1, 1)],
        "celo_address string, date date, timestampstart bigint, timestampend bigint, measureddistance bigint")
    assert sorted((tuple(r) for r in metrics.daily_driver(df).collect()), key=str) == [
        ("0x1", D1, 2, 180, 150), (None, D1, 1, 1, 1)]
    events = spark.createDataFrame([(86399,), (86400,), (86401,)], "timestamp_start bigint")
    assert {str(r.date): r.routes for r in metrics.routes_per_day(events).collect()} == {"1970-01-01": 1, "1970-01-02": 2}
    watched, seen = metrics.observed(df, "export", unowned=F.count_if(F.col("celo_address").isNull()))
    watched.collect()
    assert seen.get == {"rows": 3, "unowned": 1}


def test_sent_routes_enter_with_nonce_price_and_hash(spark, stored, attempts):
    merged = publication.reconcile(attempts, stored, attempts, "staging").ledger
    got = {r.route_id: (r.status, r.nonce, r.gas_price, r.tx_hash) for r in merged.collect()}
    assert got[2] == ("sent", 51, 9, "0x1") and got[3] == ("already_minted", None, None, None) and got[1] == ("sent", 1, 1, "0x")


def test_a_plan_numbers_what_the_budget_allows(spark):
    ready = spark.createDataFrame([(D2, 7, 4), (D1, 3, 4), (D1, 1, 4), (D1, 2, 4), (None, 9, 4)], "date date, routeid bigint, cost bigint")
    got = sorted(((r.seq, r.routeid, r.nonce) for r in publication.plan(ready, 100, budget=5).collect()))
    assert got == [(0, 9, 100), (1, 1, 101), (2, 2, 102), (4, 7, 103)]  # the third route of the first day is over the budget
    assert publication.plan(ready, 0).count() == 5


def test_rows_without_day_or_number_stay_in_the_budget(spark):
    rows = [(None, 0, 1), (None, 5, 1), (D1, None, 1), (D1, 3, 1)]
    df = spark.createDataFrame(rows, "date date, seq bigint, cost bigint")
    assert ledger.within_budget(df, 100).count() == 4
