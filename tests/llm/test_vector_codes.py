"""Vector codes: the tree search against all pairs, and the operator on awkward rows."""

import hashlib

import numpy as np
import pytest

from strata.llm import vector_codes as V


@pytest.mark.parametrize("n, k, width, side", [(1, 1, 1, 5), (5, 5, 2, 2), (900, 60, 4, 2), (2000, 64, 4, 40), (700, 7, 1, 3)])
def test_tree_search_is_that_of_all_pairs(n, k, width, side):
    points = np.random.default_rng(n).integers(-side, side + 1, (n, width))
    book = points[:k].copy()  # with repeats, so with ties and unused entries
    away = ((points[:, None] - book[None]) ** 2).sum(2)
    code, error = V.nearest(points, book, 4)
    assert (code == away.argmin(1)).all() and (error == away.min(1)).all()
    totals = np.zeros((k, width + 1), np.int64)
    V.add_up(points, book, 4, totals)
    for e in range(k):
        own = points[away.argmin(1) == e]
        assert (totals[e] == [*own.sum(0), len(own)]).all()


def test_whole_nodes_are_assigned_by_their_cached_sums():
    rng = np.random.default_rng(3)
    book = rng.integers(-1000, 1000, (64, 4))
    points = np.repeat(book, 50, 0) + rng.integers(-5, 6, (3200, 4))
    tree = V.Tree(points, 4)
    whole = sum(np.diff(tree.cuts[level])[nodes].sum() for level, nodes, _, sure in V.search(tree, V.entry_tree(book)) if sure)
    assert whole > 3000


def brute(rows, parts=16, entries=64, rounds=2):
    """rows: (id, vector, label) in plain Python integers."""
    kept = []
    for vec_id, vector, label in rows:
        if vector and all(x is not None and np.isfinite(x) for x in vector):
            kept.append((vec_id, [int(np.floor(x * 256)) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // parts)
    cut = lambda v, p: (v + [0] * (parts * width - len(v)))[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def best(p, v):
        return min((away(cut(v, p), entry), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        found = [[best(p, v)[1] for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), f in zip(kept, found) if f[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    out = []
    for vec_id, v, label in kept:
        each = [best(p, v) for p in range(parts)]
        out.append((vec_id, "".join(f"{e:02x}" for _, e in each), sum(a for a, _ in each), label))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sum(o[2] for o in out if o[3] == lab), sha) for i, c, e, lab in out), key=repr)


def answer(frame):
    return sorted((tuple(r) for r in frame.select("id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


@pytest.mark.parametrize("length", [32, 18])
def test_compress(spark, length):
    rng = np.random.default_rng(length)
    rows = [(i, rng.normal(0, 0.2, length).astype(np.float32).tolist(), int(i % 3)) for i in range(200)]
    rows[100:140] = [(i, rows[50][1], 1) for i in range(100, 140)]  # a group of copies
    rows += [(300, None, 1), (301, [], 1), (302, [None] * length, 1), (303, [float("nan")] * length, 2)]
    rows += [(304, [float("inf")] + [0.0] * (length - 1), 1), (305, [0.5] * (length - 1), 1)]
    rows += [(None, rows[7][1], None), (None, rows[8][1], None), (9, rows[10][1], None)]
    frame = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, code string, v int"
    ).repartition(5)
    assert answer(V.compress(frame)) == brute(rows)
    few = frame.where("vec_id < 3 AND code = 'x'")
    assert answer(V.compress(few)) == brute(rows[:3])
    assert V.compress(frame.where("false")).count() == 0
    assert V.compress(frame.where("vec_id = 300")).count() == 0


def test_huge_components_are_held(spark):
    frame = spark.createDataFrame([(1, [1e30] * 16, 1), (2, [-1e30] * 16, 1)], "vec_id bigint, embedding array<float>, label int")
    assert [r.error for r in V.compress(frame).collect()] == [0, 0]
    book = V.train(frame).books
    assert (book[:, 0] == V._MOST).all() and (book[:, 1] == -V._MOST).all()
