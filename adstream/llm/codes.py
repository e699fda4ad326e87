"""Vector codes: parts of vectors replaced by the nearest entries of small codebooks.

Components become integers, vectors are cut into consecutive parts, and each part position has a
codebook that rounds of assignment and averaging improve. The nearest entry of a part is found in
a GNAT (geometric near-neighbour access tree) over the codebook: a node has split points, each
other entry belongs to its nearest split point, and the node stores the least and the greatest
distance from each split point to the entries of every child. With the distance of a part to a
split point and the best distance so far, a child whose range of distances is too far off on either
side is left out as a whole.

A child is left out only where all its entries are strictly farther than the best one: distances
are rounded outwards, so that a tie is always looked at, and what decides is the squared
distance in integers.

A round reads the stored vectors once; a task returns sums of parts, never vectors. What comes to
the driver and goes out again are the codebooks, whose size does not depend on the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.common import prepare, saved, scratch

# Fixed values of the contract.
SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Split points of a node, and entries below which a node only lists them.
SPLITS = 4
LISTED = 3
# Vectors that are searched for at once.
TILE = 4096
# Distances in double precision are taken this much smaller or larger, relatively.
SLACK = 1e-12
# Squares of differences of integers below this add up within 64 bits for parts of up to 2 ** 20
# components; larger ones are computed with Python's integers.
SMALL = 1 << 20


@dataclass
class Node:
    """Split points with the ranges of their distances to the entries of each child."""

    splits: list[int]
    children: list[Node | None] = field(default_factory=list)
    # least[i, j] and greatest[i, j]: from split point i to split point j and all below it.
    least: np.ndarray | None = None
    greatest: np.ndarray | None = None


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to one entry."""
    apart = x - entry
    return (apart * apart).sum(axis=1)


def _root(squares: np.ndarray, up: bool) -> np.ndarray:
    """Square roots rounded outwards."""
    found = np.sqrt(squares.astype(np.float64))
    return found * (1 + SLACK) if up else found * (1 - SLACK)


def build(entries: np.ndarray, members: Sequence[int] | None = None) -> Node | None:
    """The tree over some of ``entries``; equal entries are all kept."""
    members = list(range(len(entries))) if members is None else list(members)
    if not members:
        return None
    if len(members) <= LISTED:
        return Node(members)
    # Split points far from each other: each next one is the farthest from those taken.
    splits = [members[0]]
    nearest = squared(entries[members], entries[splits[0]])
    while len(splits) < SPLITS:
        splits.append(members[int(np.argmax(nearest))])
        if splits[-1] in splits[:-1]:
            splits.pop()
            break
        nearest = np.minimum(nearest, squared(entries[members], entries[splits[-1]]))
    rest = [m for m in members if m not in splits]
    to_splits = np.stack([squared(entries[rest], entries[s]) for s in splits]) if rest else None
    owner = to_splits.argmin(axis=0) if rest else np.zeros(0, np.int64)
    below = [[m for m, o in zip(rest, owner, strict=True) if o == j] for j in range(len(splits))]
    if len(splits) == 1:
        # All members are equal: nothing to tell apart.
        return Node(members)
    reach = [np.stack([squared(entries[[s, *b]], entries[i]) for i in splits]) for s, b in zip(splits, below, strict=True)]
    least = np.stack([_root(r.min(axis=1), False) for r in reach], axis=1)
    greatest = np.stack([_root(r.max(axis=1), True) for r in reach], axis=1)
    return Node(splits, [build(entries, b) for b in below], least, greatest)


class Search:
    """The nearest entries of many parts at once, and how many distances that took."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.tree, self.computed = entries, build(entries), 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lower of those that tie) and its squared distance."""
        self.x = x
        self.found = np.full(len(x), -1, np.int64)
        self.best = np.zeros(len(x), x.dtype)
        self._visit(self.tree, np.arange(len(x)))
        return self.found, self.best

    def _meet(self, entry: int, rows: np.ndarray) -> np.ndarray:
        """Compare an entry with some parts, in integers."""
        apart = squared(self.x[rows], self.entries[entry])
        self.computed += len(rows)
        found, best = self.found[rows], self.best[rows]
        better = (found < 0) | (apart < best) | ((apart == best) & (entry < found))
        taken = rows[better.astype(bool)]
        self.found[taken], self.best[taken] = entry, apart[better.astype(bool)]
        return apart

    def _visit(self, node: Node | None, rows: np.ndarray) -> None:
        if node is None or not len(rows):
            return
        if node.least is None:
            for entry in node.splits:
                self._meet(entry, rows)
            return
        alive = np.ones((len(node.splits), len(rows)), bool)
        for i, entry in enumerate(node.splits):
            at = np.flatnonzero(alive[i])
            if not len(at):
                continue
            apart = self._meet(entry, rows[at])
            radius = _root(self.best[rows[at]], True)
            near, far = _root(apart, False), _root(apart, True)
            for j in range(len(node.splits)):
                # Any entry of j is at least this far away; NaN leaves nothing out.
                beyond = (near - node.greatest[i, j] > radius) | (node.least[i, j] - far > radius)
                if beyond.any():
                    alive[j, at[beyond]] = False
        for j, child in enumerate(node.children):
            if child is not None:
                self._visit(child, rows[alive[j]])


Codebooks = list[np.ndarray]  # one (entries, width) array for each part


def widths(dimension: int, parts: int) -> list[int]:
    """Lengths of consecutive parts; where they cannot be equal the first are one longer."""
    return [dimension // parts + (p < dimension % parts) for p in range(parts)]


def integers(x: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)``: as 64-bit integers where squares of them add up, else Python's."""
    whole = np.floor(x * SCALE)
    if not len(whole) or np.abs(whole).max(initial=0) < SMALL:
        return whole.astype(np.int64)
    if np.abs(whole).max() >= 1 << 62:
        raise ValueError(f"a component times {SCALE} does not fit a 64-bit integer")
    return np.array([int(v) for v in whole.ravel()], object).reshape(whole.shape)


def _same_kind(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if x.dtype == object or entries.dtype == object:
        return x.astype(object), entries.astype(object)
    return x, entries


def assign(x: np.ndarray, books: Codebooks) -> tuple[np.ndarray, list, list[np.ndarray]]:
    """Entry of every part of the rows of ``x``, squared distances by part, and the parts."""
    codes, errors, pieces, at = [], [], [], 0
    for book in books:
        part, entries = _same_kind(x[:, at : at + book.shape[1]], book)
        at += book.shape[1]
        found, best = Search(entries).nearest(part)
        codes.append(found)
        errors.append(best)
        pieces.append(part)
    return np.stack(codes, axis=1), errors, pieces


def usable(column: str = "embedding") -> F.Column:
    """Vectors that are kept: no NULL, no missing or infinite component."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce(F.forall(column, finite), F.lit(False))


def _tiles(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``TILE`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch.select(columns))
        n += batch.num_rows
        if n >= TILE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return integers(flat.reshape(len(column), dimension))


def _sums(books: Codebooks, dimension: int):
    """Of each part and entry of a task: how many parts it has, and their sums."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [[0] * len(book) for book in books]
        totals = [[[0] * book.shape[1] for _ in book] for book in books]
        for tile in _tiles(batches, ["embedding"]):
            codes, _, pieces = assign(_matrix(tile["embedding"], dimension), books)
            for p, piece in enumerate(pieces):
                for entry, n in zip(*(u.tolist() for u in np.unique(codes[:, p], return_counts=True)), strict=True):
                    counts[p][entry] += n
                    added = piece[codes[:, p] == entry].sum(axis=0).tolist()
                    totals[p][entry] = [a + b for a, b in zip(totals[p][entry], added, strict=True)]
        used = [(p, e) for p, of_part in enumerate(counts) for e, n in enumerate(of_part) if n]
        total = pa.array([[Decimal(v) for v in totals[p][e]] for p, e in used], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in used], pa.int32()),
                pa.array([e for _, e in used], pa.int32()),
                pa.array([counts[p][e] for p, e in used], pa.int64()),
                total,
            ],
            ["part", "entry", "n", "total"],
        )

    return sums


def _kind(values: list[list[int]], width: int) -> np.ndarray:
    wide = any(abs(v) >= SMALL for row in values for v in row)
    return np.array(values, object if wide else np.int64).reshape(len(values), width)


def fit(
    rows: DataFrame, dimension: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """Codebooks of stored vectors (``vec_id``, ``embedding``) of one length.

    They start as the parts of the ``entries`` smallest ids, NULL last; of rows that tie in their
    id the lesser vectors come first. With fewer rows there are fewer entries.
    """
    first = rows.orderBy(F.col("vec_id").isNull(), "vec_id", "embedding").limit(entries).select("embedding")
    start = [[float(v) for v in r["embedding"]] for r in first.collect()]
    whole = integers(np.array(start, np.float64).reshape(len(start), dimension)).tolist()
    books, at = [], 0
    for width in widths(dimension, parts):
        books.append(_kind([row[at : at + width] for row in whole], width))
        at += width
    shape = "part int, entry int, n long, total array<decimal(38,0)>"
    for _ in range(rounds):
        summed = rows.select("embedding").mapInArrow(_sums(books, dimension), shape)
        counted = summed.select("part", "entry", "n", F.posexplode_outer("total").alias("place", "total"))
        found = counted.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        values = [book.tolist() for book in books]
        # At most as many rows as the codebooks have numbers.
        for part, entry, place, n, total in found.collect():
            if place is not None:
                values[part][entry][place] = int(total) // n
        books = [_kind(v, book.shape[1]) for v, book in zip(values, books, strict=True)]
    return books


def digest(books: Codebooks) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    numbers = (str(v) for book in books for row in book.tolist() for v in row)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _encode(books: Codebooks, dimension: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in _tiles(batches, ["row", "embedding"]):
            codes, errors, _ = assign(_matrix(tile["embedding"], dimension), books)
            total = [sum(of_row) for of_row in zip(*(e.tolist() for e in errors), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    tile["row"],
                    pa.array([bytes(of_row).hex() for of_row in codes.astype(np.uint8)], pa.string()),
                    pa.array(total, pa.int64()),
                ],
                ["row", "code", "error"],
            )

    return encode


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """``vec_id``, ``label``, ``code``, ``error`` and ``codebooks_sha256`` of every usable vector.

    Vectors that :func:`usable` rejects are left out. Vectors of different lengths have codebooks of
    their own; a length that ``parts`` does not divide gives the first parts one component more, and
    an empty vector has the code of entry 0 and no error. Repeated and NULL ids keep their rows. A
    table without usable vectors gives an empty result. Components and errors beyond 64-bit
    integers raise an error. At most 256 entries; other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label").where(usable())
    # The number of a row is stored with it: it stays the same when a task runs again.
    rows = saved(rows.withColumn("row", F.struct("vec_id", "label")), scratch(spark, "vectors"))
    lengths = [r[0] for r in rows.select(F.size("embedding")).distinct().collect()]
    found = []
    for dimension in sorted(lengths):
        own = rows.where(F.size("embedding") == dimension)
        books = fit(own, dimension, parts, entries, rounds)
        shape = f"row {rows.schema['row'].dataType.simpleString()}, code string, error long"
        coded = own.select("row", "embedding").mapInArrow(_encode(books, dimension), shape)
        found.append(
            coded.select("row.vec_id", "row.label", "code", "error", F.lit(digest(books)).alias("codebooks_sha256"))
        )
    if not found:
        label = vectors.schema["label"].dataType.simpleString()
        return spark.createDataFrame(
            [], f"vec_id long, label {label}, code string, error long, codebooks_sha256 string"
        )
    return saved(reduce(DataFrame.unionByName, found), scratch(spark, "codes"))


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the sum of ``error`` over equal labels, NULL ones together."""
    summed = coded.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    return coded.join(summed, F.col("label").eqNullSafe(F.col("_of"))).drop("_of")
