"""A corpus pipeline: each stage works on all that the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a frame. All
but the last return the columns of ``docs``, whatever they are. ``run`` writes the result of each
stage to the shared folder as Parquet and reads it back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, line_dedup, minhash, toxicity
from strata.llm import text as X
from strata.session import scratch_path

# The learnt and the hashed stages have no SQL form; the tests hold them against brute force.
ORACLE_SQL = None
RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5 stay; learns from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.fit(docs, labels, F.lit(True))
    # The row travels as one column, so no name of its own can clash with the score's.
    scored = docs.select(F.struct("*").alias("doc"), toxicity.score(F.col("text"), *weights).alias("p"))
    return scored.where("p < 0.5").select("doc.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go; the text is what is left of it, n_chars its length."""
    rows = line_dedup.dedup_lines(docs)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}
    return rows.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the smallest id stays, once.

    Documents without words are in no class and stay.
    """
    known = minhash.classes(docs.select("doc_id", "text"))
    keepers = known.where(F.col("id").eqNullSafe(F.col("class_id")))
    # Of a class whose documents all lack an id, or share the smallest, one text stays.
    keepers = keepers.groupBy("class").agg(F.min(F.struct("node", "id")).alias("k"))
    keepers = keepers.select("k.node.a", "k.node.b", F.col("k.id").alias("id"))
    rows = docs.select(
        F.struct("*").alias("doc"),
        X.fingerprint(F.col("text")).alias("print"),
        (F.btrim(X.filled(F.col("text")), F.lit(X.SPACE)) == "").alias("wordless"),
    )
    same = (
        (F.col("print.a") == F.col("a"))
        & (F.col("print.b") == F.col("b"))
        & F.col("doc.doc_id").eqNullSafe(F.col("id"))
    )
    named = rows.where("NOT wordless").select("doc", "print", F.col("doc.doc_id").alias("own"))
    kept = named.join(keepers, same, "left_semi").dropDuplicates(["print", "own"])
    return kept.select("doc.*").unionAll(rows.where("wordless").select("doc.*"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go.

    What leaks is a matter of the text alone, so texts are told apart by their prints, not by ids.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = docs.select(X.fingerprint(F.col("text")).alias("doc_id"), "text")
    leaked = decontaminate.leaks(texts, benchmark).select("doc_id.a", "doc_id.b").distinct()
    rows = docs.select(F.struct("*").alias("doc"), X.fingerprint(F.col("text")).alias("print"))
    same = (F.col("print.a") == F.col("a")) & (F.col("print.b") == F.col("b"))
    return rows.join(leaked, same, "left_anti").select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its token ids, checked by decoding them."""
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = docs.select("doc_id", "text", bpe.round_trip(F.col("text"), path, pattern).alias("c"))
    return coded.select(
        "doc_id",
        F.col("c.ids").alias("token_ids"),
        F.size("c.ids").cast("bigint").alias("n_tokens"),
        (F.col("c.bytes") == X.filled(F.col("text")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
