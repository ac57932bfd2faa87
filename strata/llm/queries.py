"""The registered queries of the operators, with their production settings, and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    bpe,
    decontaminate,
    kneser_ney,
    line_dedup,
    merkle,
    minhash,
    quality_pu,
    quality_rules,
    secret_scan,
    toxicity,
    url_filter,
    vector_codes,
    warc,
)
from strata.llm import text as X

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
RANKS = "byte_bpe_multi_50k.tiktoken"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_sha(data: Column) -> Column:
    return F.sha2(data, 256)


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc.archive_pages(spark, read(spark, sf_dir, "pages"))
    found = warc.resolve(warc.read_records(packages))
    return found.select(
        F.col("record_id").try_cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


ORACLES["op1_warc"] = """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM rows WHERE payload_bytes >= 100
  GROUP BY payload_digest)
SELECT page_id, payload_bytes, r.payload_digest,
  CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM rows r LEFT JOIN firsts f ON r.payload_digest = f.payload_digest
"""


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    most = quality_rules.Settings.most_trusted
    sample = X.labelled_sample(labels, "quality", F.lit(True), most, only=1)
    return quality_rules.judge(read(spark, sf_dir, "documents"), sample)


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc.doc_id", "n_lines", "n_dropped", hex_sha(F.col("kept")).alias("kept_sha256")
    )


ORACLES["op3_line_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), path, pattern).alias("c"))
    return coded.select(
        "doc_id",
        F.size("c.ids").cast("bigint").alias("n_tokens"),
        hex_sha(F.array_join(F.col("c.ids").cast("array<string>"), ",")).alias("ids_sha256"),
        hex_sha(F.col("c.bytes")).alias("decoded_sha256"),
    )


@query
def op6_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = X.remainder(F.col("doc_id"), 3) == 1
    weights = quality_pu.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), quality_pu.score(F.col("text"), weights).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


# The rules of the registered query.
URL_RULES = (
    url_filter.UrlRule("allow", "org", "/"),
    url_filter.UrlRule("block", "example.org", "/es/"),
    url_filter.UrlRule("block", "example.org", "/en/1"),
    url_filter.UrlRule("allow", "com", "/fr/"),
    url_filter.UrlRule("block", "com", "/de/"),
)


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labelled = url_filter.labelled_by_rules(pages, URL_RULES)
    judged = url_filter.classify(pages, labelled, URL_RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@query
def op7_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = X.remainder(F.col("doc_id"), 7) == 2
    model = kneser_ney.fit(docs.where(~held_out), order=3)
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), kneser_ney.score(F.col("text"), model).alias("s")
    )
    return scored.select(
        "doc_id",
        "held_out",
        "s.n_tokens",
        "s.n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "s.base_score",
        "s.score",
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = X.remainder(F.col("doc_id"), 5) != 0
    scored = toxicity.predict(docs, read(spark, sf_dir, "labels"), trusted)
    return scored.select(
        "doc_id",
        (X.remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def _lloyd_round(number: int) -> str:
    """One round as SQL: assign the parts, then the new codebook ``b<number>``."""
    before = number - 1
    return f"""
a{before} AS (
  SELECT p.vec_id, p.p, arg_min(b.e, list_sum(list_transform(list_zip(p.part, b.part),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + b.e) AS e
  FROM parts p JOIN b{before} b ON b.p = p.p GROUP BY ALL),
m{before} AS (
  SELECT a.p, a.e, d, floor(sum(p.part[d]) / count(*))::BIGINT AS x
  FROM a{before} a JOIN parts p ON p.vec_id = a.vec_id AND p.p = a.p, range(1, 5) r(d) GROUP BY ALL),
b{number} AS (
  SELECT b.p, b.e, coalesce(n.part, b.part) AS part FROM b{before} b
  LEFT JOIN (SELECT p, e, list(x ORDER BY d) AS part FROM m{before} GROUP BY ALL) n
    ON n.p = b.p AND n.e = b.e),"""


ORACLES["op11_vector_codes"] = f"""
WITH kept AS (
  SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, label, p, v[p * 4 + 1 : p * 4 + 4] AS part FROM kept, range(16) r(p)),
b0 AS (
  SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, part FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
{_lloyd_round(1)}{_lloyd_round(2)}
d AS (
  SELECT p.vec_id, p.p, p.label, b.e, list_sum(list_transform(list_zip(p.part, b.part),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS away
  FROM parts p JOIN b2 b ON b.p = p.p),
n AS (
  SELECT vec_id, p, label, arg_min(e, away * 64 + e) AS e, min(away) AS away FROM d GROUP BY ALL),
codes AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code,
    sum(away)::BIGINT AS error
  FROM n GROUP BY ALL),
book AS (
  SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  codebooks_sha256 FROM codes, book
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    named = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(
        X.remainder(F.col("doc_id"), 5) == 0, merkle.leaf(*named, X.lower_ascii(F.col("text")))
    )
    rows = docs.select(
        F.col("source").alias("group"),
        F.col("doc_id").alias("key"),
        merkle.leaf(*named, F.col("text")).alias("leaf"),
        tampered.alias("changed"),
    )
    return merkle.prove(spark, merkle.build(rows)).withColumnRenamed("key", "doc_id")


def _merkle_levels(first: str, count: int, name: str) -> str:
    """SQL of ``count`` levels over ``first`` (tree, idx, size, digest); one node alone stays as it is."""
    parts = [f"{name}0 AS ({first})"]
    for level in range(count):
        below, up = f"{name}{level}", f"{name}{level + 1}"
        parts.append(f"""{below}r AS (
  SELECT tree, idx // 16 AS idx, max(size) AS size, list(digest ORDER BY idx) AS ds FROM {below} GROUP BY ALL)""")
        parts.append(f"""{up} AS (
  SELECT tree, idx, (size + 15) // 16 AS size,
    CASE WHEN size = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS digest FROM {below}r)""")
    return ",\n".join(parts)


def _merkle_climb(start: str, levels: list[tuple[str, str, str]]) -> str:
    """SQL of the steps of each leaf: (runs of a level, tree column, index column) one after the other."""
    parts = [f"c0 AS ({start})"]
    for step, (runs, tree, idx) in enumerate(levels):
        parts.append(f"""c{step + 1} AS (
  SELECT c.* REPLACE (c.{idx} // 16 AS {idx},
    CASE WHEN r.size = 1 THEN proof ELSE proof || array_to_string(
      r.ds[1 : c.{idx} % 16] || r.ds[c.{idx} % 16 + 2 :], '') END AS proof,
    CASE WHEN r.size = 1 THEN folded ELSE sha256(array_to_string(
      r.ds[1 : c.{idx} % 16] || [folded] || r.ds[c.{idx} % 16 + 2 :], '')) END AS folded)
  FROM c{step} c JOIN {runs} r ON r.tree = c.{tree} AND r.idx = c.{idx} // 16)""")
    return ",\n".join(parts)


_CRC32 = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
_FIELDS = "concat(" + ", ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")
)

ORACLES["op12_merkle_manifest"] = f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree,
    sha256({_FIELDS}, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
    CASE WHEN {_CRC32} % 5 = 0 THEN sha256({_FIELDS}, coalesce(strlen(text) || ':' ||
      translate(text, '{X.UPPER}', '{X.UPPER.lower()}'), '-'))) END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS size FROM leaves),
{_merkle_levels("SELECT tree, idx, size, leaf AS digest FROM placed", 5, "n")},
{_merkle_levels("""SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx,
  count(*) OVER () AS size, digest, tree AS of FROM n5""", 3, "t")},
{_merkle_climb("""SELECT p.doc_id, p.leaf, p.tree, '' AS top, p.idx, t0.idx AS up, t0.digest AS subroot,
  '' AS proof, coalesce(p.changed, p.leaf) AS folded FROM placed p JOIN t0 ON t0.of = p.tree""",
  [(f"n{i}r", "tree", "idx") for i in range(5)] + [(f"t{i}r", "top", "up") for i in range(3)])}
SELECT doc_id, leaf, subroot, t3.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = t3.digest AS verified FROM c8, t3
"""


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", secret_scan.spans(F.col("text")).alias("found"))
    base = F.filter("found", lambda s: s["rule"] < len(secret_scan.BASE))

    def count(place: int) -> Column:
        return F.size(F.filter("found", lambda s: s["rule"] == place)).cast("bigint")

    return found.select(
        "doc_id",
        *(count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(secret_scan.BASE)),
        hex_sha(secret_scan.spelt(base)).alias("base_sha256"),
        secret_scan.spelt(F.col("found")).alias("spans"),
    )
