"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, packing.

All stages take any columns beside doc_id, text, source and n_chars and hand them
on, also under names that an operator uses itself; an empty table gives an empty
one. Null and empty texts fail the quality rules, so later stages meet them only
if they are run by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopstar.llm import jaccard_join, line_dedup, mixing, packing, quality_rules
from shopstar.llm.queries import tokenizer_file
from shopstar.llm.tables import Spool, aside, read, restored

# Near copies of the stage; the defaults of the join are those of the op3 contract.
NEAR_COPIES = jaccard_join.JaccardJoin(words=5, percent=80)


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; null and empty texts do not.

    Repeated rows, and rows without an id, are judged one by one and alike.
    """
    return quality_rules.passing(docs, read(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that line dedup leaves; n_chars follows the text.

    No document goes: one that loses all its lines stays with an empty text, as a
    null text does. Rows of the same doc_id are one document; rows without one lose
    every shared line.
    """
    done = line_dedup.dedup_lines(aside(docs, "doc_id", "text"))
    return restored(done, docs, text=F.col("kept_text"), n_chars=F.length("kept_text").cast("bigint"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near-duplicates.

    Texts are near-duplicates if they share at least 80 % of their 5-word shingles.
    Null and empty texts have no shingle and stay, as do all rows without an id.
    Rows that repeat the doc_id that stays, stay with it.
    """
    return jaccard_join.first_of_each(docs, NEAR_COPIES)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not, once or twice.

    Null and empty texts have size 0 and are kept once or not at all; null sources
    are one source, the last. Equal rows are told apart by chance that is fixed, so
    reruns agree.
    """
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of at most 2048 tokens.

    Null texts count as empty and take one token, the end mark. Copies of a document
    are packed as often as they come.
    """
    return packing.pack_documents(docs, tokenizer_file()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", reject_low_quality),
    ("line_dedup", drop_shared_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("mix_sources", mix_to_targets),
    ("best_fit_packing", pack_sequences),
]

# SQL has neither the hashes nor the tokenizer; tests/llm compares lines and near copies of the
# stages with plain Python, of the others only columns, the count and ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    spool = Spool(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        done = spool.write(stage(spark, docs, sf_dir), name)
        if n:
            spool.drop(STAGES[n - 1][0])
        docs = done
    return docs
