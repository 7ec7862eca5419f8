"""The corpus pipeline: each stage on its own input, held against brute force."""

import public_tokenizers
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetledger.llm import pieces
from test_decontaminate import brute as contaminated
from test_pieces import brute as viterbi
from test_pii import plain
from test_simhash import groups_of, print_of

FOLDER = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before and after each stage, every result written and read again."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.pin(stage(spark, docs, FOLDER))
        found.append(docs.collect())
    return found


def test_stages_have_their_order_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "PII", "SentencePiece encoding and decoding"]
    for rows in steps[:-1]:
        assert list(rows[0].asDict()) == DOCUMENTS
    assert [len(rows) for rows in steps] == sorted((len(rows) for rows in steps), reverse=True)


def test_clean_labelled_documents_stay(spark, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1]}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert np.mean([i in kept for i in good]) > 0.95 and np.mean([i in kept for i in bad]) < 0.5


def test_one_of_each_group_stays(steps):
    rows = sorted(steps[1], key=lambda r: r.doc_id)
    roots = groups_of([print_of(r.text) for r in rows])
    assert sorted(r.doc_id for r in steps[2]) == sorted({rows[k].doc_id for k in roots})


def test_only_contaminated_documents_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = [i for i, _, hits, _ in contaminated([(r.doc_id, r.text) for r in steps[2]], items) if not hits]
    assert sorted(r.doc_id for r in steps[3]) == sorted(clean)


def test_personal_data_is_masked_and_nothing_else(steps):
    before, after = ({r.doc_id: r for r in rows} for rows in steps[3:5])
    assert before.keys() == after.keys()
    for i, row in before.items():
        assert not plain(after[i].text)
        if not plain(row.text) and "[" not in after[i].text:
            assert after[i] == row
        assert after[i].n_chars == (len(after[i].text) if after[i].text != row.text else row.n_chars)


def test_ids_are_the_best_paths_and_decode_to_the_text(steps):
    vocabulary = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in steps[4]}
    assert len(steps[5]) == len(texts)
    for k, r in enumerate(steps[5]):
        assert pieces.decode(np.array(r.ids, np.int64), vocabulary.spelling) == texts[r.doc_id].replace("▁", " ")
        if k % 20 == 0 and len(texts[r.doc_id]) < 2_000:
            assert list(r.ids) == viterbi(vocabulary, texts[r.doc_id])


def test_odd_documents_pass_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (5_000, "word " * 50_000, None, "s", None),
                                 (5_001, "same text", "en", "s", 9), (5_001, "same text", "en", "s", 9)], docs.schema)
    for docs in (docs.unionByName(odd).withColumns({"ids": F.lit(1), "score": F.lit("mine"), "id": F.lit(2)}), docs.limit(0)):
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            columns, docs = docs.columns, corpus_pipeline.pin(stage(spark, docs, FOLDER))
            assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
            assert docs.count() <= rows
        assert docs.count() == 0 or docs.filter("doc_id = 5001").count() <= 1
