"""From raw documents to token ids: reject, dedupe, decontaminate, redact, encode.

Every stage takes (spark, docs, folder), where ``folder`` has the other tables, and is
judged on its own input: what a stage decides is decided over all that the one before
kept. The runner writes each result as Parquet and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetledger.llm import decontaminate, pieces, pii, quality, simhash
from fleetledger.llm.frames import table
from fleetledger.llm.queries import piece_vocabulary
from fleetledger.session import pin


def reject_low_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that the quality classifier scores 0.7 or more; it is fitted on the labelled rows of its input."""
    train = [frame.filter(~quality.held_out(frame["doc_id"])) for frame in (docs, table(spark, folder, "labels"))]
    return quality.keep_good(docs, quality.train(*train))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of linked fingerprints the row of least id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows in which no window of a benchmark item occurs."""
    return decontaminate.keep_clean(docs, table(spark, folder, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All rows, with each span of personal data replaced by its kind, and ``n_chars`` to match."""
    return pii.redact(docs, pii.train(docs), length_col="n_chars")


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All rows, with the ids of the pieces in place of the text."""
    return pieces.encode(docs, piece_vocabulary())


STAGES = [
    ("quality classifier", reject_low_quality),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("SentencePiece encoding and decoding", encode),
]

# Compression, message passing and Viterbi are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
