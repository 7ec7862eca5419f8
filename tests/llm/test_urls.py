"""Host, path and rules by reading, entropy by counting, verdicts by accuracy."""

import collections
import math
import random
import re

import pytest
from fleetledger.llm import urls
from fleetledger.llm.queries import URL_RULES
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string"
ODD = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x?a=1&b=2#f", "http://a.b.com", "http://com/", "http://x.com?y=/en/",
       "http://example.com/en", "http://example.com/en/", "http://sub.example.com/en/1", "http://www.example.com/en/1", "http://notexample.com/en/",
       "https://x.net/es/1", "https://x.net/fr/", "https://net/es/", "https://x.net/de/", "http://ÉX.com/é?é", "a://b://c/d", "http://x.com/a\nb?c", "http://h#/p"]


def read(url):
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path, rules=URL_RULES):
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def test_hosts_paths_and_rules(spark):
    rows = spark.createDataFrame([(k, u, "") for k, u in enumerate(ODD)], PAGES)
    got = {r.id: r for r in urls.judged(rows, URL_RULES).collect()}
    for k, url in enumerate(ODD):
        host, path = read(url)
        assert (got[k].host, got[k].path) == (host, path), url
        assert (got[k].rule, got[k].decided) == rule(host, path), url


def test_entropy(spark):
    texts = ["", "a", "aaaa", "abab", "http://x.y/z?12", "é😀é", "ab" * 50_000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", urls.entropy(F.col("t")).alias("e")).collect()
    for r in rows:
        counts = collections.Counter(r.t).values()
        assert r.e == pytest.approx(-sum(c / len(r.t) * math.log2(c / len(r.t)) for c in counts) if r.t else 0, abs=1e-9)


def labelled(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        bad = rng.random() < 0.4
        host = f"{'win-777-free' if bad else 'news'}{rng.randint(0, 99) if bad else ''}.{rng.choice('abcdef')}site.{'xyz' if bad else 'org'}"
        query = "?" + "&".join(f"p{j}={rng.randint(0, 10 ** 9)}" for j in range(rng.randint(3, 6))) if bad else ""
        rows.append((k, f"http://{host}/{'/'.join(rng.choices(['a', 'bb', 'ccc'], k=rng.randint(1, 4)))}{query}", "block" if bad else "allow"))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = urls.judged(spark.createDataFrame(labelled(400, 1), "page_id long, url string, decided_by string"), [])
    labels = spark.createDataFrame(labelled(400, 1), "id long, url string, said string").select("id", "said")
    return urls.train(rows.join(labels, "id").withColumn("decided", F.col("said")))


def test_unseen_urls_are_told_apart_without_python(spark, model):
    rows = labelled(200, 7)
    found = urls.verdicts(urls.judged(spark.createDataFrame(rows, "page_id long, url string, x string"), []), model)
    said = {r.id: r.verdict for r in found.collect()}
    assert sum(said[k] == v for k, _, v in rows) >= 190
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())


def test_every_row_gets_a_verdict(spark, model):
    rows = [(k, u, None) for k, u in enumerate(ODD)] + [(None, "http://x.org", None), (3, "http://y.org/" + "a" * 100_000, None), (3, "http://y.org/", "z")]
    frame = spark.createDataFrame(rows, PAGES).withColumns({"rule": F.lit("mine"), "features": F.lit(1), "prediction": F.lit(0)})
    got = urls.verdicts(urls.judged(frame, URL_RULES), model).collect()
    assert len(got) == len(rows) and {r.verdict for r in got} <= {"allow", "block"}
    assert urls.verdicts(urls.judged(spark.createDataFrame([], PAGES), URL_RULES), model).count() == 0


@pytest.mark.parametrize("kind,default", [("block", "block"), ("allow", "allow"), (None, "allow")])
def test_labels_of_one_kind_or_none(spark, kind, default):
    rows = urls.judged(spark.createDataFrame([(1, "http://a.org/", "")], PAGES), [])
    known = rows.withColumn("decided", F.lit(kind).cast("string")).filter(F.col("decided").isNotNull())
    assert urls.verdicts(rows, urls.train(known)).first().verdict == default


def test_suffixes_are_counted_over_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(urls, "TRAIN_ROWS", 100)
    rows = [(k, f"http://h{k}.t{k % 400}/", "block" if k % 400 < 100 else "allow") for k in range(2_000)]
    frame = urls.judged(spark.createDataFrame(rows, "page_id long, url string, x string"), [])
    model = urls.train(frame.withColumn("decided", F.when(F.col("id") % 400 < 100, "block").otherwise("allow")))
    got = {r.suffix: (r.suffix_rate, r.suffix_weight) for r in model.suffixes.collect()}
    assert len(got) == 400 and model.overall == 0.25
    for k in range(400):
        assert got[f"t{k}"] == pytest.approx(((5 * (k < 100) + 20 * 0.25) / 25, 5 / 2_000))


def test_suffix_statistics_too_large_to_broadcast_give_the_same_verdicts(spark, model):
    frame = urls.judged(spark.createDataFrame(labelled(100, 5), "page_id long, url string, x string"), [])
    joined = urls.Model(model.trees, model.default, model.suffixes.hint("merge"), model.overall)
    assert sorted(urls.verdicts(frame, model).collect()) == sorted(urls.verdicts(frame, joined).collect())


def test_a_class_of_one_url_stays_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(urls, "TRAIN_ROWS", 100)
    for seed in range(3):
        good = [(k, u, "allow") for k, u, said in labelled(3_000, seed) if said == "allow"]
        bad = [(5_000 + k, f"http://win-777-free{seed}.asite.xyz/a/bb?p0=12345&p1=6789&p2=1", "block") for k in range(60)]
        frame = spark.createDataFrame(good + bad, "page_id long, url string, decided string")
        rows = urls.judged(frame, []).drop("decided").join(frame.select(F.col("page_id").alias("id"), "decided"), "id")
        model = urls.train(rows)
        new = [(k, u, "") for k, u, said in labelled(100, 50 + seed) if said == "block"]
        found = urls.verdicts(urls.judged(spark.createDataFrame(new, "page_id long, url string, x string"), []), model)
        assert found.filter("verdict = 'block'").count() >= 0.9 * len(new)


def test_copies_are_drawn_one_by_one_and_stand_for_all(spark, monkeypatch):
    monkeypatch.setattr(urls, "TRAIN_ROWS", 100)
    same = [(None if k % 2 else 7, "http://a.com/", 0.0) for k in range(1_000)] + [(k, "http://a.com/", 0.0) for k in range(1_000)]
    other = [(k, f"http://b{k}.com/", 0.0) for k in range(4_000)] + [(k, "http://c.net/", 1.0) for k in range(30)]
    frame = spark.createDataFrame([(i, u, "", "", y) for i, u, y in same + other], "id long, url string, host string, path string, label double")
    got = urls.drawn(frame, {0.0: 6_000, 1.0: 30}).collect()
    assert sum(r.label == 1 for r in got) == 30 and 50 <= sum(r.label == 0 for r in got) <= 95
    assert 15 <= sum(r.url == "http://a.com/" for r in got) <= 35
    assert {r.weight for r in got if r.label} == {1.0} and sum(r.weight for r in got) == pytest.approx(6_030, rel=0.3)


def test_a_urls_own_label_is_no_input_of_its_fit(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(urls, "_vectors", lambda rows, suffixes, overall, make=urls._vectors: seen.append(suffixes) or make(rows, suffixes, overall))
    rows = [(k, f"http://h{k}.t{k % 3}/", "block" if k % 3 == 0 else "allow") for k in range(90)] + [(100, "http://only.here/", "block")] * 3
    frame = spark.createDataFrame(rows, "page_id long, url string, said string")
    rows_in = urls.judged(frame, []).drop("decided").join(frame.select(F.col("page_id").alias("id"), F.col("said").alias("decided")).distinct(), "id")
    model = urls.train(rows_in)
    told = {(r.suffix, r.fold): (r.suffix_rate, r.suffix_weight) for r in seen[0].collect()}
    counted = collections.defaultdict(lambda: [0, 0])
    for r in rows_in.select("host", "decided", urls.fold_of(F.col("url")).alias("fold")).collect():
        counted[r.host.rsplit(".", 1)[-1], r.fold][0] += r.decided == "block"
        counted[r.host.rsplit(".", 1)[-1], r.fold][1] += 1
    total, blocked = 93, 33
    for (suffix, fold), found in told.items():
        others = [v for (s, f), v in counted.items() if s == suffix and f != fold]
        b, n = sum(v[0] for v in others), sum(v[1] for v in others)
        assert found == pytest.approx(((b + 20 * blocked / total) / (n + 20), n / total))
    assert told.keys() == counted.keys() and [v for (s, _), v in told.items() if s == "here"] == [pytest.approx((blocked / total, 0))]
    whole = {r.suffix: r.suffix_weight for r in model.suffixes.collect()}
    assert whole["here"] == pytest.approx(3 / total)


def test_probabilities_and_held_out_accuracy(spark, model):
    rows = urls.judged(spark.createDataFrame(labelled(150, 9), "page_id long, url string, x string"), [])
    for r in urls.verdicts(rows, model).collect():
        assert 0 <= r.probability <= 1 and (r.probability > 0.5) == (r.verdict == "block")
    ruled = urls.verdicts(urls.judged(spark.createDataFrame([(1, "http://x.com/", "")], PAGES), URL_RULES), model).first()
    assert (ruled.verdict, ruled.probability) == ("allow", None)
    frame = spark.createDataFrame(labelled(600, 4), "page_id long, url string, said string")
    known = urls.judged(frame, []).drop("decided").join(frame.select(F.col("page_id").alias("id"), F.col("said").alias("decided")), "id")
    found = urls.accuracy(known).collect()
    assert sum(r.right for r in found) / sum(r.n for r in found) > 0.9 and {r.suffix for r in found} <= {"org", "xyz"}
