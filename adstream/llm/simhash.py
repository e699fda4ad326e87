"""Near-duplicates by SimHash: fingerprints within a Hamming radius are linked.

A fingerprint is the majority, bit by bit, over the 64-bit hashes of a text's word shingles.
Equal fingerprints are merged first. Two fingerprints at most ``radius`` apart agree on two
of ``radius + 2`` blocks of bits, so each is compared within one bucket for each pair of
blocks. In a bucket the bits of 64 fingerprints at a time lie vertically, one word for each
bit plane; a word of counters for 64 distances is then updated with a few bitwise operations
a plane, and a word whose distances all exceed the radius is abandoned.

A bucket with more than ``DENSE`` fingerprints is not compared in one task. Its fingerprints
are linked through the values one bit away: those that share one are at most 2 apart, those
at most 2 apart share one. Each value has 65 such neighbours, whatever the bucket's size.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from adstream.llm.common import prepare, saved, scratch, with_plain_names
from adstream.llm.components import components

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2
# Fingerprints of one bucket that a task compares with each other.
DENSE = 2048
# Query and word pairs that are compared at once.
SLICE = 1 << 17
SEGMENT = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a segment at a time."""
    start = 0
    while len(text) - start > SEGMENT:
        found = SPACE.search(text, start + SEGMENT)
        if not found:
            break
        yield text[start : found.start()].lower().split()
        start = found.end()
    yield text[start:].lower().split()


def _hashes(words: list[bytes], shingle: int) -> array:
    joined = memoryview(b" ".join(words))
    starts, ends, at = [], [], 0
    for word in words:
        starts.append(at)
        at += len(word)
        ends.append(at)
        at += 1
    return array("Q", [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :])])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a text; zero if it has no words."""
    ones, n, tail = np.zeros(BITS, np.int64), 0, []
    for words in _words((text or "").encode()):
        words = tail + words
        if len(words) >= shingle:
            hashes = np.frombuffer(_hashes(words, shingle), np.uint64)
            tail = words[len(words) - shingle + 1 :] if shingle > 1 else []
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            n += len(hashes)
        else:
            tail = words
    if not n and tail:
        return xxh64_intdigest(b" ".join(tail), SEED)
    majority = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, name: str = "fingerprint") -> DataFrame:
    """``docs`` with column ``name``, the 64 bits as a long, added or replaced as its last."""
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != name]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [fingerprint(text, shingle) for text in batch["_text"].to_pylist()]
            found = pa.array(np.array(own, np.uint64).view(np.int64))
            rest = batch.drop_columns("_text")
            yield pa.RecordBatch.from_arrays([*rest.columns, found], [*rest.schema.names, name])

    schema = docs.select(*kept, F.lit(0).cast("long").alias(name)).schema
    return docs.select(*kept, F.col("text").alias("_text")).mapInArrow(add, schema)


def close_pairs(values: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of values of one group at most ``radius`` bits apart, in slices.

    ``values`` is uint64, sorted by ``group``. Pairs come once, larger index first.
    """
    n = len(values)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[first, n])
    lane = np.arange(n) - np.repeat(first, sizes)
    n_words = -(-sizes // BITS)
    first_word = np.r_[0, np.cumsum(n_words)[:-1]]
    word = np.repeat(first_word, sizes) + lane // BITS
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    square = np.zeros((int(n_words.sum()), BITS, BITS), np.uint8)
    square[word, :, lane % BITS] = bits
    planes = np.ascontiguousarray(np.packbits(square, axis=2, bitorder="little").view(np.uint64)[:, :, 0].T)
    # Each value is a query against its own word and those before it.
    own_words = lane // BITS + 1
    query = np.repeat(np.arange(n), own_words)
    asked = np.arange(len(query)) - np.repeat(np.cumsum(own_words) - own_words, own_words)
    asked += np.repeat(word - lane // BITS, own_words)
    for at in range(0, len(query), SLICE):
        yield from _slice(values, planes, word, lane, query[at : at + SLICE], asked[at : at + SLICE], radius)


def _slice(values, planes, word, lane, query, asked, radius):
    counters_n = radius.bit_length()
    bias = (1 << counters_n) - 1 - radius
    # The counters start so that a distance beyond the radius carries out of them.
    counters = [np.full(len(query), ALL if bias >> k & 1 else 0, np.uint64) for k in range(counters_n)]
    # In a query's own word only lanes before it count.
    before = np.left_shift(np.uint64(1), (lane[query] % BITS).astype(np.uint64)) - np.uint64(1)
    over = np.where(word[query] == asked, ~before, np.uint64(0))
    for plane in range(BITS):
        bit = (values[query] >> np.uint64(plane)) & np.uint64(1)
        carry = planes[plane][asked] ^ (np.uint64(0) - bit)
        for k in range(counters_n):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if plane % 8 == 7:
            open_ = np.flatnonzero(over != ALL)
            if len(open_) < len(query):
                query, asked, over = query[open_], asked[open_], over[open_]
                counters = [c[open_] for c in counters]
    if len(query):
        near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, other = np.nonzero(near)
        a = query[row]
        first_of_word = a - lane[a] + (asked[row] - (word[a] - lane[a] // BITS)) * BITS
        yield a, first_of_word + other


def _roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index reachable from each of ``n`` by the pairs."""
    root = np.arange(n)
    if not pairs:
        return root
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _bucket_links(radius: int):
    def links(values: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
        pairs = list(close_pairs(values.view(np.uint64), group, radius))
        root = _roots(len(values), pairs)
        linked = np.flatnonzero(root != np.arange(len(values)))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[linked]), pa.array(values[root[linked]])], ["a", "b"]
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by bucket; the last bucket of a batch may go on in the next.
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch[c].to_numpy() for c in ("bands", "bucket", "fingerprint")], 1)
            rows = np.concatenate([*held, rows])
            last = np.flatnonzero((rows[:, :2] == rows[-1, :2]).all(1))[0]
            held = [rows[last:]]
            if last:
                yield from whole(rows[:last])
        if held:
            yield from whole(held[0])

    def whole(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]
        group = np.cumsum(new)
        several = np.bincount(group)[group] > 1
        if several.any():
            yield links(np.ascontiguousarray(rows[several, 2]), group[several])

    return compare


def near_links(distinct: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """Links ``a``, ``b`` that connect all ``fingerprint`` values within the radius.

    Of the links inside a bucket only a spanning forest is returned.
    """
    if radius != 2:
        dense = 1 << 62  # the neighbourhood of one bit links exactly the radius 2
    width = BITS // (radius + 2)
    edges = [(k * width, width if k < radius + 1 else BITS - k * width) for k in range(radius + 2)]
    block = [F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit((1 << w) - 1)) for at, w in edges]
    keys = [
        F.struct(
            F.lit(n).cast("long").alias("bands"),
            F.shiftleft(block[i], edges[j][1]).bitwiseOR(block[j]).alias("bucket"),
        )
        for n, (i, j) in enumerate(combinations(range(radius + 2), 2))
    ]
    rows = distinct.select("fingerprint", F.inline(F.array(*keys)))
    sizes = rows.groupBy("bands", "bucket").agg(F.count("*").alias("n"))
    large = saved(sizes.where(F.col("n") > dense), scratch(distinct.sparkSession, "dense"))
    compared = (
        rows.join(large, ["bands", "bucket"], "left_anti")
        .repartition("bands", "bucket")
        .sortWithinPartitions("bands", "bucket", "fingerprint")
        .mapInArrow(_bucket_links(radius), "a long, b long")
    )
    if large.isEmpty():
        return compared
    crowded = rows.join(large, ["bands", "bucket"], "left_semi").select("fingerprint").distinct()
    flips = [F.lit(0).cast("long"), *(F.expr(f"shiftleft(1L, {k})") for k in range(BITS))]
    hubs = crowded.select(
        "fingerprint", F.explode(F.transform(F.array(*flips), lambda x: F.col("fingerprint").bitwiseXOR(x))).alias("hub")
    )
    # At most 65 fingerprints meet in a hub.
    first = hubs.groupBy("hub").agg(F.min("fingerprint").alias("b"), F.count("*").alias("n")).where("n > 1")
    linked = hubs.join(first, "hub").where(F.col("fingerprint") != F.col("b"))
    return compared.unionByName(linked.select(F.col("fingerprint").alias("a"), "b").distinct())


def near_duplicates(rows: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """``fingerprint``, ``root`` (one for each component) and ``component_id``, the smallest
    ``doc_id`` of the component, for every fingerprint of ``rows`` (``doc_id``, ``fingerprint``).

    ``rows`` is read several times: give a stored table. A NULL ``doc_id`` is never the
    smallest; a component with no other has a NULL id.
    """
    spark = rows.sparkSession
    distinct = saved(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least_doc")), scratch(spark, "fingerprints")
    )
    found = components(near_links(distinct.select("fingerprint"), radius, dense))
    rooted = distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", "least_doc", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    return saved(rooted.join(least, "root").select("fingerprint", "root", "component_id"), scratch(spark, "classes"))


def label(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` of every row of ``docs``.

    NULL and empty texts and those without words have fingerprint zero and are linked like
    any other. Repeated rows keep their rows. Other columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = saved(fingerprints(source, shingle), scratch(docs.sparkSession, "simhash"))
    classes = near_duplicates(rows, radius, dense).select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, that with the smallest ``doc_id``, with all its columns.

    Of rows that tie in ``doc_id`` one stays; a NULL ``doc_id`` stays only where its
    component has no other.
    """
    names, docs = docs.columns, with_plain_names(docs, "doc_id", "text")
    print_, row = "print", "row"
    # Row numbers are stored with the rows, so they stay the same when a task runs again.
    marked = saved(
        fingerprints(docs, shingle, print_).withColumn(row, F.monotonically_increasing_id()),
        scratch(docs.sparkSession, "simhash"),
    )
    ids = marked.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(print_).alias("fingerprint"), F.col(row).alias("row")
    )
    classes = near_duplicates(ids, radius).select("fingerprint", "root")
    least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("least")
    staying = ids.join(classes, "fingerprint").groupBy("root").agg(least).select(F.col("least.row").alias(row))
    return marked.join(staying, row, "left_semi").select(*docs.columns).toDF(*names)
