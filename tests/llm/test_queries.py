"""The registered queries over whole tables, against SQL or brute force."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from fleetledger.llm.queries import ORACLE, QUERIES
from test_decontaminate import brute as contaminated  # noqa: F401  (the brute force that test is held against)
from test_pii import plain
from test_simhash import groups_of, print_of
from test_urls import read, rule
from tokenizers import Tokenizer

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return duck.execute("select doc_id, text from documents order by doc_id").fetchall()


def by_doc(spark, name, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, FOLDER).collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    cursor = duck.execute(ORACLE[name])
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    want = [tuple(row[found.index(c)] for c in columns) for row in cursor.fetchall()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and got


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_quality(spark, duck, texts):
    got = by_doc(spark, "op1_quality_classifier")
    assert len(got) == len(texts)
    labels = dict(duck.execute("select doc_id, quality from labels").fetchall())
    for i, _ in texts:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and got[i].predicted == int(got[i].score >= 0.7)
    right = [got[i].predicted == q for i, q in labels.items() if got[i].held_out]
    assert np.mean(right) > 0.85


def test_personal_data(spark, texts):
    got = by_doc(spark, "op2_pii_skip_chain")
    for i, text in texts:
        found = plain(text or "")
        base = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, b, k in found)
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(s[2] == k for s in found) for k in range(4)]
        assert set(filter(None, base.split(","))) <= set(got[i].spans.split(","))


def test_pieces(spark, texts):
    got = by_doc(spark, "op5_sentencepiece_viterbi")
    assert len(got) == len(texts) and all(r.same for r in got.values())


def test_urls(spark, duck):
    got = by_doc(spark, "op6_url_filter", "page_id")
    for i, url in duck.execute("select page_id, url from pages").fetchall():
        host, path = read(url)
        name, verdict = rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, name)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def test_toxicity(spark, duck, texts):
    got = by_doc(spark, "op7_toxicity_chain")
    labels = dict(duck.execute("select doc_id, toxic from labels").fetchall())
    assert len(got) == len(texts)
    assert np.mean([1 - got[i].predicted for i, t in labels.items() if not t]) > 0.9


def test_packed_ids(spark, texts):
    got = by_doc(spark, "op8_packed_token_ids")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for i, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_near_copies(spark, texts):
    got = by_doc(spark, "op9_simhash_near_dedup")
    prints = [print_of(t) for _, t in texts]
    for (i, _), value, root in zip(texts, prints, groups_of(prints)):
        assert got[i].fingerprint == f"{value:016x}" and got[i].component_id == texts[root][0]
