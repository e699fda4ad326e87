"""Pack documents into sequences of at most ``capacity`` tokens, in as few as it can.

Lengths are whole numbers up to the capacity, so the instance is a histogram. Martello and
Toth's reduction and best-fit decreasing both run on that histogram, a length with all its
pieces at a time: what the driver holds is at most ``capacity`` counts and the resulting
patterns, however many documents there are. Executors then rank the pieces of each length
and look their places up.

Dominance, for the longest open piece j and the room r it leaves: a set F that holds j
dominates if the companions of any other feasible set can be exchanged for those of F, each
with pieces that fit into it. Then some best packing holds F, which is fixed.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm import tokenizer as tok
from adstream.llm.common import prepare, saved, scratch, text_column

CAPACITY = 1024
END_ID = 2
# Pieces of one length ranked by one task.
RANKED_TOGETHER = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

Pattern = tuple[int, ...]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of ``n`` ids; only the first may be short."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: its place in the document and the CRC-32 of its ids.

    Ids are little-endian unsigned 32-bit numbers, the document's and then ``end_id``. NULL
    is the empty text, so each row of ``docs`` gives a piece at least.
    """
    prepare(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer_ = tok.load(tokenizer)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = memoryview(tokenizer_.ids(text) + end)
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    for column, value in zip(rows, (doc_id, piece, start, length, crc), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return source.mapInArrow(encode, PIECES)


class _Lengths:
    """Counts of the open pieces by length."""

    def __init__(self, counts: dict[int, int]):
        self.n = {length: n for length, n in counts.items() if n > 0}
        self.sorted = sorted(self.n)

    def take(self, pattern: Pattern, times: int) -> None:
        for length in pattern:
            self.n[length] -= times
        for length in set(pattern):
            if not self.n[length]:
                del self.n[length]
                self.sorted.remove(length)

    def left(self, length: int, but: Pattern) -> int:
        return self.n.get(length, 0) - but.count(length)

    def smallest(self, k: int, but: Pattern, above: int = 0) -> list[int]:
        """The ``k`` shortest open pieces longer than ``above``, not counting ``but``."""
        found: list[int] = []
        for length in self.sorted[bisect_right(self.sorted, above) :]:
            found += [length] * min(k - len(found), self.left(length, but))
            if len(found) == k:
                break
        return found

    def largest(self, room: int, but: Pattern) -> int:
        """The longest open piece that fits, 0 if none does."""
        for i in range(bisect_right(self.sorted, room) - 1, -1, -1):
            if self.left(self.sorted[i], but) > 0:
                return self.sorted[i]
        return 0

    def best_pair(self, room: int, but: Pattern) -> Pattern:
        """The two open pieces that fill ``room`` best, the longer one as long as can be."""
        best: Pattern = ()
        for i in range(bisect_right(self.sorted, room) - 1, -1, -1):
            a = self.sorted[i]
            if self.left(a, but) <= 0 or best and 2 * a <= sum(best):
                continue
            b = self.largest(min(a, room - a), (*but, a))
            if b and a + b > sum(best):
                best = (a, b)
        return best


def dominating(j: int, open_: _Lengths, capacity: int) -> Pattern | None:
    """A set with ``j`` that dominates all others with it, if one is found."""
    room, own = capacity - j, (j,)
    one = open_.largest(room, own)
    if not one:
        return own
    if one == room:
        return j, one
    few = open_.smallest(3, own)
    if len(few) < 2 or few[0] + few[1] > room:
        return j, one
    if len(few) == 3 and sum(few) <= room:
        return None
    pair = open_.best_pair(room, own)
    if not pair or one >= sum(pair):
        return j, one
    if pair[0] == one:
        # Any other pair fits into (one, b) unless both of it are longer than b.
        between = open_.smallest(2, (*own, one), above=pair[1])
        if len(between) < 2 or sum(between) > room:
            return j, *pair
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[dict[Pattern, int], dict[int, int]]:
    """Fix dominating sets until none is left: the fixed patterns, and the open counts."""
    open_, fixed = _Lengths(counts), {}
    changed = True
    while changed:
        changed = False
        for j in reversed(open_.sorted[:]):
            while open_.n.get(j):
                pattern = dominating(j, open_, capacity)
                if pattern is None:
                    break
                times = min(open_.n[x] // pattern.count(x) for x in pattern)
                open_.take(pattern, times)
                fixed[pattern] = fixed.get(pattern, 0) + times
                changed = True
    return fixed, open_.n


def best_fit(counts: dict[int, int], capacity: int) -> dict[Pattern, int]:
    """Best-fit decreasing, all pieces of a length at once.

    The fullest sequence a piece fits into is also the fullest for the next of its length,
    so sequences of one filling take as many as they can before others do.
    """
    bins: dict[int, dict[Pattern, int]] = {}

    def put(pattern: Pattern, times: int) -> None:
        group = bins.setdefault(capacity - sum(pattern), {})
        group[pattern] = group.get(pattern, 0) + times

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            room = min((r for r in bins if r >= length), default=capacity)
            if room in bins and room < capacity:
                group = bins[room]
                pattern, there = group.popitem()
                if not group:
                    del bins[room]
            else:
                pattern, there = (), n
            each = room // length
            whole = min(there, n // each)
            if whole:
                put(pattern + (length,) * each, whole)
            n, rest = n - whole * each, there - whole
            if n and n < each and rest:
                put(pattern + (length,) * n, 1)
                n, rest = 0, rest - 1
            if pattern and rest:
                put(pattern, rest)
    packed: dict[Pattern, int] = {}
    for group in bins.values():
        for pattern, times in group.items():
            packed[pattern] = packed.get(pattern, 0) + times
    return packed


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> dict[Pattern, int]:
    """How often each pattern of lengths is packed: reduction first, best-fit for the rest."""
    fixed, rest = reduce_instance(counts, capacity)
    for pattern, times in best_fit(rest, capacity).items():
        fixed[pattern] = fixed.get(pattern, 0) + times
    return fixed


@dataclass
class Slots:
    """Places for the pieces of one length, by their rank: ``each`` in a sequence."""

    first_rank: np.ndarray
    first_sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray


def slots(packed: dict[Pattern, int]) -> dict[int, Slots]:
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern in sorted(packed, reverse=True):
        times, offset = packed[pattern], 0
        ordered = sorted(pattern, reverse=True)
        for length in dict.fromkeys(ordered):
            each = ordered.count(length)
            rank = ranks.get(length, 0)
            rows.setdefault(length, []).append((rank, sequence, each, offset))
            ranks[length] = rank + times * each
            offset += each * length
        sequence += times
    return {k: Slots(*np.array(v, np.int64).T) for k, v in rows.items()}


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces; sequences are gapless from offset 0.

    ``cut_pieces`` has the columns of :func:`pieces` and is read three times: give a stored
    table. Ties and repeated rows take different places; an empty table stays empty.
    """
    counts = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = slots(pack_lengths(counts, capacity))
    # Pieces of a length are ranked in groups of bounded size, and the groups one after another.
    groups = max(1, -(-max(counts.values(), default=0) // RANKED_TOGETHER))
    salted = cut_pieces.withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int")
    )
    by_length = Window.partitionBy("length").orderBy("salt")
    before = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .select("length", "salt", (F.sum("n").over(by_length) - F.col("n")).alias("before"))
    )
    in_group = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(in_group)).join(before, ["length", "salt"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank") - 1).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch[c].to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for own in np.unique(length):
                at, found = length == own, places[int(own)]
                slot = np.searchsorted(found.first_rank, rank[at], "right") - 1
                nth = rank[at] - found.first_rank[slot]
                sequence[at] = found.first_sequence[slot] + nth // found.each[slot]
                offset[at] = found.offset[slot] + nth % found.each[slot] * own
            kept = batch.drop_columns("rank")
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)],
                [*kept.schema.names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Cut and pack every document: one row for each piece, with its place."""
    stored = saved(pieces(docs, tokenizer, capacity, end_id), scratch(docs.sparkSession, "pieces"))
    return pack(stored, capacity)
