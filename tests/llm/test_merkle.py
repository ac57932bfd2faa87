"""The Merkle manifest against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import merkle
from strata.llm.queries import op12_merkle_manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def spelt(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(digests, paths):
    """The digest that remains; adds (siblings before, siblings after) a level to each leaf's path."""
    below = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [digests[i : i + 16] for i in range(0, len(digests), 16)]
        for at, _ in enumerate(digests):
            run, place = runs[at // 16], at % 16
            for i in below[at]:
                paths[i].append((run[:place], run[place + 1 :]))
        below = [sum(below[i : i + 16], []) for i in range(0, len(below), 16)]
        digests = [sha("".join(run)) for run in runs]
    return digests[0]


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0], sha("".join(map(spelt, row))), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, paths, members = [], [], []
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        inner = [[] for _ in own]
        subroots.append(climb([leaf for _, leaf, _ in own], inner))
        paths.append(inner)
        members.append(own)
    tops = [[] for _ in order]
    root = climb(subroots, tops)
    out = []
    for own, inner, top, subroot in zip(members, paths, tops, subroots):
        for (doc_id, leaf, row), path in zip(own, inner):
            now = leaf
            if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0:
                text = row[4].translate(LOWER) if row[4] is not None else None
                now = sha("".join(map(spelt, (*row[:4], text))))
            for before, after in path + top:
                now = sha("".join([*before, now, *after]))
            proof = sha("".join(d for before, after in path + top for d in (*before, *after)))
            out.append((doc_id, leaf, subroot, root, proof, now, now == root))
    return sorted(out, key=repr)


def found(spark, folder, rows):
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, idx int"
    frame = spark.createDataFrame([(*row, "t", 3) for row in rows], schema)
    frame.repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    got = op12_merkle_manifest(spark, folder)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_manifest(spark, folder):
    rows = [(i, "hot", "en", i, f"Text {i} ÄB") for i in range(300)]
    rows += [(1000 + i, f"s{i}", None, None, "One") for i in range(20)]
    rows += [(2000 + i, "s3", "de", 1, None) for i in range(17)]
    rows += [(3000, None, "de", 1, ""), (None, None, "x", 2, "Null id"), (3000, None, "de", 1, "B"), (3000, "", "de", 1, "B")]
    rows += [(4000, "ä", "de", 1, "lower"), (4001, "Z-", "de", 1, "Q" * 100_000)]
    want = brute(rows)
    assert found(spark, folder, rows) == want
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_small_tables(spark, folder, n):
    one = [(5 + i, "a", "en", 1, "Xy") for i in range(n)]
    assert found(spark, folder, one) == (brute(one) if n else [])
    each = [(5 + i, f"g{i}", "en", 1, "Xy") for i in range(n)]
    assert found(spark, folder, each) == (brute(each) if n else [])


def test_no_join_key_of_the_climb_is_hot(spark, monkeypatch):
    """All runs climb to one root, whose row is dealt out under salts."""
    monkeypatch.setattr(merkle, "CLIMBERS", 4)
    rows = spark.range(2000).select(
        F.lit("a").alias("group"), F.col("id").alias("key"), merkle.leaf(F.col("id")).alias("leaf"),
        F.lit(None).cast("string").alias("changed"),
    )
    made = merkle.build(rows)
    nodes = spark.read.parquet(made.nodes)
    climbers = spark.read.parquet(made.runs).count()
    assert nodes.where("up_tree IS NULL AND tree = '=a'").count() == -(-climbers // 4)
    proved = merkle.prove(spark, made)
    assert proved.count() == 2000 and proved.where("verified").count() == 2000
    assert proved.select("root").distinct().count() == 1
