"""Line deduplication across documents.

A line's key is the line stripped of ASCII white space at both ends, with A-Z in lower case. A key
of at least ``min_chars`` code points that is found in at least ``min_docs`` documents loses all
its lines but those of the document with the largest id that holds it.

Defined cases: a null or empty text is one empty line. Rows that share an id are one document
when documents are counted; each row keeps its own text. A null id is an id of its own, below all
others. Columns other than the id and the text are carried along untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import text as X


def line_key(line: Column) -> Column:
    return X.lower_ascii(F.btrim(line, F.lit(X.SPACE)))


def _lines(text: Column) -> Column:
    return F.split(X.filled(text), "\n")


def _keyed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row per line long enough: document, row print, position and 128 bits of the key."""
    exploded = rows.select("id", "print", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = exploded.select("id", "print", "pos", line_key(F.col("line")).alias("key"))
    long_enough = keys.where(F.char_length("key") >= min_chars)
    return long_enough.select("id", "print", "pos", X.fingerprint(F.col("key")).alias("key"))


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Returns ``doc`` (the row as it came), ``kept`` (the new text), ``n_lines``, ``n_dropped``.

    Keys are counted per document first, so a line that a third of all documents hold reaches its
    counting task as one row per map task. Lines of such a key are joined by Spark's own join,
    which splits hot keys. Only positions travel; texts are shuffled once, by document.
    """
    rows = docs.select(
        F.struct("*").alias("doc"), F.col(doc_id).alias("id"), F.col(text).alias("text")
    ).withColumn("print", F.xxhash64("id", "text"))
    lines = _keyed_lines(rows, min_chars)
    held = lines.select("key", "id").distinct()
    shared = (
        held.groupBy("key")
        # max passes over nulls, which is what makes a null id the smallest.
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select(F.col("key.a").alias("a"), F.col("key.b").alias("b"), "keeper")
    )
    # Joined by the parts of the key, not the key: so both sides are dealt anew for the join, and
    # Spark may split the lines of a hot key over tasks. The shared keys are the small side.
    same_key = (F.col("key.a") == F.col("a")) & (F.col("key.b") == F.col("b"))
    dropped = (
        lines.join(shared, same_key)
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "print")
        .agg(F.collect_list("pos").alias("gone"))
        .select(F.col("id").alias("gone_id"), F.col("print").alias("gone_print"), "gone")
    )
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("print") == F.col("gone_print"))
    # The text travels once, within the row.
    marked = rows.drop("text").join(dropped, same, "left").select(
        "doc", _lines(F.col(f"doc.`{text}`")).alias("lines"), "gone"
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = X.let(F.col("lines"), lambda all_: F.transform(places, lambda i: F.get(all_, i)))
    kept_lines = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept)
    return marked.select(
        "doc",
        F.array_join(kept_lines, "\n").alias("kept"),
        F.size("lines").cast("bigint").alias("n_lines"),
        # Rows that repeat id and text list their places more than once.
        F.coalesce(F.size(F.array_distinct("gone")), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
