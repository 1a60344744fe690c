"""From raw documents to token ids, in five stages.

Each stage is a function of (spark, docs, sf_dir): it takes what its predecessor
kept and returns the columns of documents, the last one the encoded documents.
Between stages the documents are written to the shared folder, so that no stage
is run twice and a lost executor costs no more than a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmap.llm import quality, secrets, simhash, spm, tiling
from reachmap.storage import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives 0.7 or more.

    A null or empty text has the score of the model's bias; with labels of one class
    all stay (class 1) or go (class 0), without labels all go (score 0.5); if the documents of
    one class are not there, all have the share of class 1 among the labels. Equal texts fare alike.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, "doc_id", "text", "quality", ~quality.held_out("id"))
    return quality.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group alike to 0.8 in shingles of five words.

    A null text counts as empty; all texts without words are one group. Rows with a
    null id stay. Of rows that repeat id and text one stays; rows that repeat an id with
    another text are documents of their own.
    """
    return simhash.one_of_each_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; null and empty texts stay, and so do all if the benchmark is empty."""
    return tiling.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in the text replaced by a mark, ``n_chars`` set anew where one was; null stays null."""
    return secrets.redact(docs, length_col="n_chars")


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_chars, n_tokens, ids, exact); exact: the ids decode to the text.

    A null text has null ids and no tokens, an empty one no ids; repeated rows stay repeated.
    """
    encoded = spm.encode(docs.select("doc_id", "text", "n_chars"))
    return encoded.select("doc_id", "n_chars", F.coalesce(F.size("ids"), F.lit(0)).alias("n_tokens"), "ids", "exact")


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", hide_secrets),
    ("SentencePiece encoding and decoding", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = written(docs, "stage")
    return docs


#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None
