"""Vector code compression: a product quantiser whose Lloyd rounds run on two trees.

A component ``x`` is the integer ``floor(256 * x)``; a vector is cut into equal consecutive parts,
and each part position has a codebook. A codebook starts as that part of the first vectors by id.
A round gives every part to its nearest entry (squared Euclidean distance, ties to the lower index)
and replaces each entry by the componentwise ``floor(sum / count)`` of its parts.

The search of a round is a dual-tree search inside each task, over blocks of vectors. One tree halves
the parts of a block along the widest side of their box, another does the same for the entries. For
a pair of nodes the boxes bound all distances between them from below and above, in integers; a pair
goes if its lower bound is above the smallest upper bound of that part node, or, for a single entry, if
another one is nearer at every corner of the box. Where one entry is left for a whole node, its cached sum and count are added at once. Only in leaves with several entries left
are single distances taken, in integers too. So the result is that of a search of all pairs, exactly.

Tasks return sums per (part, entry, component): what reaches the driver is as large as the codebooks,
whatever the number of vectors.

Defined cases: a vector that is null or empty, or holds a null or a non-finite component, or has
another length than the first kept vector by id, is dropped. A length that the number of parts does
not divide is filled up with zeros. Null ids come after all others; rows that share an id count
each, ordered by their components. Components beyond +-2^22 after scaling are held there, so that
squares fit a long. With fewer vectors than entries a codebook has as many entries as vectors.
Without vectors there is no row. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

_MOST = 1 << 22
_FAR = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Settings:
    parts: int = 16
    entries: int = 64  # at most 256: two hex digits
    rounds: int = 2
    scale: int = 256
    leaf: int = 4  # parts in a leaf of the tree
    block: int = 1 << 20  # components searched at once


class Tree:
    """Points halved level by level; node ``j`` of level ``l`` holds the places ``cuts[l][j]`` to ``cuts[l][j + 1]``."""

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        self.depth = max(0, (n // leaf).bit_length() - 1)
        self.cuts = [np.arange(2**level + 1) * n >> level for level in range(self.depth + 1)]
        order = np.arange(n)
        for level in range(self.depth):
            placed, starts = points[order], self.cuts[level][:-1]
            sides = np.maximum.reduceat(placed, starts) - np.minimum.reduceat(placed, starts)
            node = np.repeat(np.arange(2**level), np.diff(self.cuts[level]))
            key = placed[np.arange(n), sides.argmax(1)[node]]
            order = order[np.lexsort((key, node))]
        self.order, self.points = order, points[order]
        each = [cuts[:-1] for cuts in self.cuts]
        self.low = [np.minimum.reduceat(self.points, starts) for starts in each]
        self.high = [np.maximum.reduceat(self.points, starts) for starts in each]
        self.sums = [np.add.reduceat(self.points, starts) for starts in each]

    def places(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the points of ``nodes`` one after the other, and the size of each node."""
        starts = self.cuts[level][nodes]
        sizes = self.cuts[level][nodes + 1] - starts
        ends = np.cumsum(sizes)
        return np.arange(sizes.sum()) + np.repeat(starts - ends + sizes, sizes), sizes


def entry_tree(book: np.ndarray) -> Tree:
    """The tree of a codebook, filled up to a power of two with repeats of its last entry."""
    full = 1 << (len(book) - 1).bit_length()
    tree = Tree(book[np.minimum(np.arange(full), len(book) - 1)], 1)
    tree.order = np.minimum(tree.order, len(book) - 1)
    return tree


def bounds(points: Tree, level: int, nodes, entries: Tree, depth: int, others):
    """Smallest and largest squared distance that the boxes of each pair of nodes allow."""
    low, high = points.low[level][nodes], points.high[level][nodes]
    left, right = entries.low[depth][others], entries.high[depth][others]
    gap = np.maximum(np.maximum(low - right, left - high), 0)
    reach = np.maximum(high - left, right - low)
    return (gap * gap).sum(1), (reach * reach).sum(1)


def outdone(points: Tree, level: int, nodes, entries: Tree, others, most, best):
    """Whether a node's entry of the smallest upper bound is nearer than the pair's at every place of the box."""
    first = np.empty(2**level, np.int64)
    top = most == best[nodes]
    first[nodes[top]] = others[top]
    star, own = entries.points[first[nodes]], entries.points[others]
    # The difference of the two squared distances is linear in the place, so a corner has the largest.
    slope = 2 * (own - star)
    corner = np.maximum(slope * points.low[level][nodes], slope * points.high[level][nodes]).sum(1)
    return corner + (star * star).sum(1) - (own * own).sum(1) < 0


def search(points: Tree, entries: Tree) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """Yields (level, nodes, entries, sure): whole nodes with their entry, or leaves with each entry left."""
    level = depth = 0
    nodes = others = np.zeros(1, np.int64)
    two = np.arange(2)
    while True:
        least, most = bounds(points, level, nodes, entries, depth, others)
        best = np.full(2**level, _FAR)
        np.minimum.at(best, nodes, most)
        near = least <= best[nodes]
        if depth == entries.depth:
            near &= ~outdone(points, level, nodes, entries, others, most, best)
        nodes, others = nodes[near], others[near]
        if depth == entries.depth:
            sure = np.bincount(nodes, minlength=2**level)[nodes] == 1
            yield level, nodes[sure], entries.order[others[sure]], True
            nodes, others = nodes[~sure], others[~sure]
            if level == points.depth or not len(nodes):
                yield level, nodes, entries.order[others], False
                return
        if depth < entries.depth:
            nodes, others, depth = np.repeat(nodes, 2), (2 * others[:, None] + two).ravel(), depth + 1
        if level < points.depth:
            nodes, others, level = (2 * nodes[:, None] + two).ravel(), np.repeat(others, 2), level + 1


def settle(points: Tree, book: np.ndarray, level: int, nodes, entries) -> tuple[np.ndarray, np.ndarray]:
    """Places and entries of the points of uncertain leaves, by single integer distances."""
    places, sizes = points.places(level, nodes)
    entry = np.repeat(entries, sizes)
    away = ((points.points[places] - book[entry]) ** 2).sum(1)
    best = np.full(len(points.points), _FAR)
    np.minimum.at(best, places, away * 256 + entry)  # ties go to the lower entry
    found = np.flatnonzero(best != _FAR)
    return found, best[found] & 255


def add_up(points: np.ndarray, book: np.ndarray, leaf: int, totals: np.ndarray) -> None:
    """Add the parts' sums and, in the last column, counts to the row of their nearest entry."""
    tree = Tree(points, leaf)
    for level, nodes, entries, sure in search(tree, entry_tree(book)):
        if sure:
            np.add.at(totals[:, :-1], entries, tree.sums[level][nodes])
            np.add.at(totals[:, -1], entries, np.diff(tree.cuts[level])[nodes])
        else:
            places, entries = settle(tree, book, level, nodes, entries)
            np.add.at(totals[:, :-1], entries, tree.points[places])
            np.add.at(totals[:, -1], entries, 1)


def nearest(points: np.ndarray, book: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each part."""
    tree = Tree(points, leaf)
    code = np.empty(len(points), np.int64)
    for level, nodes, entries, sure in search(tree, entry_tree(book)):
        if sure:
            places, sizes = tree.places(level, nodes)
            entries = np.repeat(entries, sizes)
        else:
            places, entries = settle(tree, book, level, nodes, entries)
        code[tree.order[places]] = entries
    return code, ((points - book[code]) ** 2).sum(1)


def integers(vector: Column, scale: int) -> Column:
    """The integer components, or null for a vector that is to be dropped."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = lambda x: F.greatest(F.least(x.cast("double") * scale, F.lit(float(_MOST))), F.lit(-float(_MOST)))
    whole = F.transform(vector, lambda x: F.floor(held(x)).cast("int"))
    return F.when((F.size(vector) > 0) & finite, whole)


def _blocks(batch: pa.RecordBatch, parts: int, width: int, block: int):
    """(offset, parts x vectors x width) for runs of vectors of a batch."""
    rows = batch.column("v")
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    whole = flat.reshape(len(rows), -1)
    whole = np.pad(whole, ((0, 0), (0, parts * width - whole.shape[1])))
    step = max(256, block // (parts * width))
    for at in range(0, len(whole), step):
        yield at, whole[at : at + step].reshape(-1, parts, width).transpose(1, 0, 2)


@dataclass(frozen=True)
class Codebooks:
    """``books[p][e]`` is entry ``e`` of part ``p``; ``length`` the length of the vectors."""

    books: np.ndarray
    length: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _start(rows: DataFrame, s: Settings) -> Codebooks | None:
    """The first vectors by id: at most ``entries`` rows come to the driver."""
    order = [F.col("id").asc_nulls_last(), "v"]
    length = rows.orderBy(*order).select(F.size("v")).limit(1).collect()
    if not length:
        return None
    fit = rows.where(F.size("v") == length[0][0]).orderBy(*order).limit(s.entries).collect()
    first = np.array([row.v for row in fit], np.int64)
    width = -(-first.shape[1] // s.parts)
    first = np.pad(first, ((0, 0), (0, s.parts * width - first.shape[1])))
    return Codebooks(first.reshape(len(first), s.parts, width).transpose(1, 0, 2), length[0][0])


def _round(rows: DataFrame, now: Codebooks, s: Settings) -> Codebooks:
    books = now.books
    parts, size, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, size, width + 1), np.int64)
        for batch in batches:
            for _, block in _blocks(batch, parts, width, s.block):
                for p in range(parts):
                    add_up(np.ascontiguousarray(block[p]), books[p], s.leaf, totals[p])
        cell = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(cell), pa.array(totals.ravel()[cell])], ["cell", "total"])

    found = rows.select("v").mapInArrow(sums, "cell bigint, total bigint")
    added = found.groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    totals = np.zeros(parts * size * (width + 1), np.int64)
    totals[added["cell"].to_numpy()] = added["total"].to_numpy()
    totals = totals.reshape(parts, size, width + 1)
    count = totals[:, :, -1:]
    return Codebooks(np.where(count > 0, totals[:, :, :-1] // np.maximum(count, 1), books), now.length)


def _usable(vectors: DataFrame, vec_id: str, vector: str, label: str, s: Settings) -> DataFrame:
    rows = vectors.select(
        F.col(vec_id).alias("id"),
        integers(F.col(vector), s.scale).alias("v"),
        F.col(label).alias("label"),
    )
    return rows.where(F.col("v").isNotNull())


def train(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", s: Settings = Settings()
) -> Codebooks | None:
    """Codebooks after ``rounds`` rounds over all vectors; None without vectors."""
    rows = _usable(vectors, vec_id, vector, vec_id, s)
    now = _start(rows, s)
    if now is not None:
        rows = rows.where(F.size("v") == now.length)
        for _ in range(s.rounds):
            now = _round(rows, now, s)
    return now


def encode(
    vectors: DataFrame, codebooks: Codebooks | None, vec_id: str = "vec_id",
    vector: str = "embedding", label: str = "label", s: Settings = Settings(),
) -> DataFrame:
    """(id, label, code, error) of each vector: two hex digits a part, and the squared distance."""
    rows = _usable(vectors, vec_id, vector, label, s)
    rows = rows.where(F.size("v") == codebooks.length) if codebooks is not None else rows.where("false")
    books = codebooks.books if codebooks is not None else np.zeros((s.parts, 1, 1), np.int64)
    parts, _, width = books.shape

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.empty((batch.num_rows, parts), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for at, block in _blocks(batch, parts, width, s.block):
                for p in range(parts):
                    found, away = nearest(np.ascontiguousarray(block[p]), books[p], s.leaf)
                    code[at : at + len(found), p] = found
                    error[at : at + len(found)] += away
            text = code.tobytes().hex()
            own = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.record_batch(
                [batch.column("id"), batch.column("label"), pa.array(own, pa.string()), pa.array(error)],
                ["id", "label", "code", "error"],
            )

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(codes, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    s: Settings = Settings(),
) -> DataFrame:
    """Train and encode: (id, label, code, error, label_error, codebooks_sha256).

    ``label_error`` is the error summed over the rows with an equal label, nulls together (null if it
    does not fit a long). The codes are staged, so they are searched once for both; the totals
    have one row per label, and Spark broadcasts them only if their file is small, else its skew
    join splits the rows of a hot label.
    """
    spark = vectors.sparkSession
    codebooks = train(vectors, vec_id, vector, s)
    coded, totals = scratch_path(spark, "vector-codes"), scratch_path(spark, "label-errors")
    encode(vectors, codebooks, vec_id, vector, label, s).write.parquet(coded)
    rows = spark.read.parquet(coded)
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    rows.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")).write.parquet(totals)
    joined = rows.join(spark.read.parquet(totals), F.col("label").eqNullSafe(F.col("of")), "left")
    sha = codebooks.sha256() if codebooks is not None else None
    return joined.drop("of").withColumn("codebooks_sha256", F.lit(sha).cast("string"))
