"""Merkle dataset manifest: a hash tree over the rows of each group, and one over the groups.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its
value. Within a group leaves ascend by key; while several nodes remain, every ``FAN`` consecutive ones
become the hash of their hex digests. What remains is the group's subroot; the subroots, in the order
of the groups, likewise give the root.

``build`` writes each level as a table whose rows are nodes with their children's digests and a link to their
parent. ``prove`` climbs these tables with one recursive query: a step joins each climber to its parent,
appends the siblings found there and hashes each of its digests into the parent's place. Leaves of
one run share all siblings but their own, so a climber is one run and carries the digests of
all its leaves, changed or not, not one row a leaf. A parent high up has many climbers: its row is
written several times under a salt, so that no join key has more than about ``CLIMBERS`` of them.

Leaves are numbered by a range shuffle, a staged table and one offset per (group, range), so a group
with a third of all rows is sorted by as many tasks as its size asks for.

Defined cases: a null group comes before all others, a null key before all other keys. Rows that share
group and key are ordered by their digests. A lone leaf is its group's subroot, a lone subroot the root;
without siblings a proof is the hash of nothing. An empty table has no rows. Columns beyond
those named are not read, whatever their names.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.session import scratch_path

FAN = 16
CLIMBERS = 256


def field(value: Column) -> Column:
    spelt = value.cast("string")
    size = F.octet_length(spelt).cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(size, F.lit(":"), spelt))


def leaf(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the fields."""
    return F.sha2(F.concat(*map(field, values)), 256)


def joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def others(digests: Column, place: Column) -> Column:
    """All digests of a run but the one at ``place`` (from 0), joined."""
    return joined(F.filter(digests, lambda _, i: i != place))


@dataclass(frozen=True)
class Manifest:
    """Tables of a built tree.

    ``runs``: the lowest nodes (tree, idx, own: array of (key, leaf, changed)). ``nodes``: all nodes
    (tree, level, idx, salt, digest, children, subroot, and the link up_tree, up_level, up_idx,
    up_place, up_salts). The tree of the groups has the name ``''``.
    """

    runs: str
    nodes: str


def _staged(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path), path


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, *order, ...) with ``idx``, the place within the tree by ``order``, and the tree's ``width``."""
    by = [F.asc_nulls_first(name) for name in ("tree", *order)]
    ranges = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed, _ = _staged(ranges.withColumn("spot", F.monotonically_increasing_id()), "merkle-placed")
    # The upper bits of the id are the range, the lower 33 the row in it.
    placed = placed.withColumn("range", F.shiftright("spot", 33))
    held = placed.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("n"), F.min("spot").alias("first"))
    earlier = W.partitionBy("tree").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = held.select(
        "tree",
        "range",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(W.partitionBy("tree")).alias("width"),
    )
    offsets, _ = _staged(offsets, "merkle-offsets")
    found = placed.join(offsets, ["tree", "range"]).withColumn("idx", F.col("spot") + F.col("shift"))
    return found.drop("spot", "range", "shift")


def _grown(items: DataFrame, payload: list[str], label: str) -> tuple[DataFrame, str]:
    """All levels above ``items`` (tree, idx, width, digest, n, *payload), and the path of the lowest.

    A node has ``children`` (digests) and ``n``, the runs of leaves below it; the lowest ones keep what
    ``payload`` names as an array. A lone item is its tree's only node, unhashed.
    """
    spark, level, paths = items.sparkSession, 1, []
    nodes = items
    while True:
        run = F.struct((F.col("idx") % FAN).alias("place"), "digest", F.struct(F.lit(1), *payload).alias("own"))
        grouped = nodes.groupBy("tree", F.expr(f"idx div {FAN}").alias("idx")).agg(
            F.sort_array(F.collect_list(run)).alias("run"), F.max("width").alias("below"), F.sum("n").alias("n")
        )
        children = F.col("run.digest")
        digest = F.when(F.col("below") == 1, F.get(children, F.lit(0))).otherwise(F.sha2(joined(children), 256))
        up = grouped.select(
            "tree",
            F.lit(level).alias("level"),
            "idx",
            F.ceil(F.col("below") / FAN).alias("width"),
            digest.alias("digest"),
            children.alias("children"),
            F.greatest("n", F.lit(1)).alias("n"),
            *([F.col("run.own").alias("own")] if payload else []),
        )
        staged, path = _staged(up, f"merkle-{label}-{level}")
        paths.append(path)
        nodes, payload, level = staged.where("width > 1"), [], level + 1
        if nodes.isEmpty():
            tables = [spark.read.parquet(path).drop("own") for path in paths]
            return functools.reduce(DataFrame.unionAll, tables), paths[0]


def build(rows: DataFrame) -> Manifest:
    """Build the tables from ``rows``: group (any type that orders as its text), key, leaf, changed.

    ``leaf`` and ``changed`` are digests; a null ``changed`` is an unchanged leaf. Rows are staged first,
    as a range shuffle reads its input twice.
    """
    tree = F.when(F.col("group").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("group").cast("string")))
    hashed, _ = _staged(
        rows.select(tree.alias("tree"), "key", F.col("leaf").alias("digest"), "changed"), "merkle-leaves"
    )
    numbered = _numbered(hashed, ["key", "digest", "changed"])
    leaves = numbered.withColumn("n", F.lit(0).cast("bigint")).withColumn("leaf", F.col("digest"))
    inner, runs = _grown(leaves, ["key", "leaf", "changed"], "runs")
    subroots = inner.where("width = 1").select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest", "n")
    placed, _ = _staged(_numbered(subroots, ["group"]), "merkle-subroots")
    # A lone subroot is the root; the node above it is linked to nothing.
    upper, _ = _grown(placed, [], "groups")
    no_link = [F.lit(None).cast(t).alias(c) for c, t in (("up_tree", "string"), ("up_level", "int"), ("up_idx", "bigint"), ("up_place", "bigint"))]
    own = ["tree", "level", "idx", "digest", "children", "n"]

    def within(nodes: DataFrame) -> DataFrame:
        return nodes.where("width > 1").select(
            *own, F.lit(False).alias("subroot"), F.col("tree").alias("up_tree"),
            (F.col("level") + 1).alias("up_level"), F.expr(f"idx div {FAN}").alias("up_idx"),
            (F.col("idx") % FAN).alias("up_place"),
        )

    tops = placed.where("width > 1").select(
        F.col("group"), F.lit("").alias("up_tree"), F.lit(1).alias("up_level"),
        F.expr(f"idx div {FAN}").alias("up_idx"), (F.col("idx") % FAN).alias("up_place"),
    )
    ends = inner.where("width = 1").join(tops, F.col("tree") == F.col("group"), "left")
    ends = ends.select(*own, F.lit(True).alias("subroot"), "up_tree", "up_level", "up_idx", "up_place")
    root = upper.where("width = 1").select(*own, F.lit(False).alias("subroot"), *no_link)
    linked, _ = _staged(within(inner).unionAll(ends).unionAll(within(upper)).unionAll(root), "merkle-links")
    salts = F.greatest(F.ceil(F.col("n") / CLIMBERS), F.lit(1)).cast("bigint")
    parents = linked.select(
        F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("idx").alias("up_idx"),
        salts.alias("up_salts"),
    )
    nodes = linked.withColumn("salts", salts).join(parents, ["up_tree", "up_level", "up_idx"], "left")
    salted = nodes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
    _, path = _staged(salted.drop("n", "salts"), "merkle-nodes")
    return Manifest(runs, path)


CLIMB = """
WITH RECURSIVE climb AS (
  SELECT tree, idx, digest, IF(subroot, digest, CAST(NULL AS STRING)) AS subroot,
    up_tree, up_level, up_idx, up_place, up_salts, '' AS above, folded
  FROM {starts}
  UNION ALL
  SELECT c.tree, c.idx, n.digest, coalesce(c.subroot, IF(n.subroot, n.digest, CAST(NULL AS STRING))),
    n.up_tree, n.up_level, n.up_idx, n.up_place, n.up_salts,
    concat(c.above, array_join(filter(n.children, (d, i) -> i <> c.up_place), '')),
    transform(c.folded, f -> sha2(concat(
      array_join(slice(n.children, 1, CAST(c.up_place AS INT)), ''), f,
      array_join(slice(n.children, CAST(c.up_place AS INT) + 2, {fan}), '')), 256))
  FROM climb c JOIN {nodes} n
    ON n.tree = c.up_tree AND n.level = c.up_level AND n.idx = c.up_idx
    AND n.salt = pmod(xxhash64(c.tree, c.idx), c.up_salts)
)
SELECT tree, idx, digest AS root, subroot, above, folded FROM climb WHERE up_tree IS NULL
"""


def _first_folds(leaves: Column, lone: Column) -> Column:
    """Per leaf of a run, the run's digest with the changed leaf in the place of its own."""
    digests = F.transform(leaves, lambda x: x["leaf"])

    def fold(x: Column, i: Column) -> Column:
        now = F.coalesce(x["changed"], x["leaf"])
        parts = (joined(F.slice(digests, 1, i)), now, joined(F.slice(digests, i + 2, FAN)))
        return F.when(lone, now).otherwise(F.sha2(F.concat(*parts), 256))

    return F.transform(leaves, fold)


def prove(spark: SparkSession, made: Manifest) -> DataFrame:
    """Per leaf: key, leaf, subroot, root, proof_sha256, folded_root and verified (folded_root is the root)."""
    runs = spark.read.parquet(made.runs).select("tree", "idx", "width", F.col("own").alias("leaves"))
    # The only run of a group is the group: with one leaf in it, that is a lone leaf.
    lone = (F.size("leaves") == 1) & (F.col("width") == 1)
    runs = runs.withColumn("folds", _first_folds(F.col("leaves"), lone))
    nodes = spark.read.parquet(made.nodes)
    lowest = nodes.where("level = 1 AND tree <> '' AND salt = 0").drop("children", "salt")
    starts = lowest.join(runs.select("tree", "idx", F.array_distinct("folds").alias("folded")), ["tree", "idx"])
    key, limit = "spark.sql.cteRecursionRowLimit", spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    spark.conf.set(key, "-1")  # a row per run and level, which has no bound to state
    try:
        climbed, _ = _staged(spark.sql(CLIMB, starts=starts, nodes=nodes, fan=FAN), "merkle-climb")
    finally:
        spark.conf.set(key, limit) if limit is not None else spark.conf.unset(key)
    met = runs.join(climbed, ["tree", "idx"])
    each = met.select("*", F.posexplode("leaves").alias("place", "x"))
    folded = F.get("folded", F.array_position(F.array_distinct("folds"), F.get("folds", "place")).cast("int") - 1)
    siblings = others(F.transform("leaves", lambda x: x["leaf"]), F.col("place"))
    return each.select(
        "x.key",
        "x.leaf",
        "subroot",
        "root",
        F.sha2(F.concat(siblings, "above"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )
