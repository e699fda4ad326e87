"""Find and remove documents that hold benchmark passages, by suffix arrays of the documents.

A shard is an Arrow batch of documents. Only words that some item holds can lie inside a
match, so a shard's array is built over its runs of such words that are long enough for a
window. Every test suffix is then located in it by binary search, all of them side by side
and a word further each round, until its range is empty: the last range gives its longest
verbatim match, the range after a window's length all occurrences of that window.

Items are taken in blocks of bounded size, so what reaches each task does not grow with the
benchmark; documents are not shuffled while one block is enough.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.common import prepare, text_column, with_plain_names
from adstream.llm.suffixes import suffix_array

WINDOW = 10
# Text of the items sent to the tasks at once.
BLOCK_BYTES = 8 << 20
SEGMENT = 1 << 20
# What words are made of, after A-Z are lowered.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
LONGEST = "item_id string, item_start int, length int, doc_id long, doc_start int"


@dataclass
class Block:
    """Items as word numbers: the test suffixes, and those that begin a window."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    names: list[str] = field(default_factory=list)
    words: array = field(default_factory=lambda: array("i"))
    item: array = field(default_factory=lambda: array("i"))
    left: array = field(default_factory=lambda: array("i"))  # words to the item's end
    window: array = field(default_factory=lambda: array("i"))  # 0 where none begins
    n_bytes: int = 0

    def add(self, name: str, words: list[bytes], window: int) -> None:
        n = len(words)
        vocabulary = self.vocabulary
        self.words.extend([vocabulary.setdefault(w, len(vocabulary)) for w in words])
        self.item.extend([len(self.names)] * n)
        self.left.extend(range(n, 0, -1))
        size = min(n, window)
        self.window.extend([size if i + size <= n else 0 for i in range(n)])
        self.names.append(name)
        self.n_bytes += sum(map(len, words))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a bounded segment at a time."""
    start = 0
    while len(text) - start > SEGMENT:
        found = BREAK.search(text, start + SEGMENT)
        if not found:
            break
        yield WORD.findall(text[start : found.start()].lower())
        start = found.end()
    yield WORD.findall(text[start:].lower())


def blocks(items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items in blocks; they stream through the driver, one block at a time.

    Items without words are left out; repeated ``item_id`` values count once.
    """
    block = Block()
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), text_column().alias("text"))
    for row in rows.toLocalIterator():
        words = [w for some in words_of(row["text"].encode()) for w in some]
        if words:
            block.add(row["item_id"] or "", words, window)
        if block.n_bytes >= block_bytes:
            yield block
            block = Block()
    if block.words:
        yield block


class Shard:
    """The suffix array of a batch of documents, over the words that a block knows."""

    def __init__(self, block: Block, texts: list[str | None], depth: int):
        """``depth`` is the length of match, in words, that :meth:`search` is to tell."""
        self.depth = depth
        get, ids, counts = block.vocabulary.get, array("i"), []
        for text in texts:
            before = len(ids)
            for words in words_of((text or "").encode()):
                ids.extend(map(get, words, repeat(-1)))
            counts.append(len(ids) - before)
        self.counts = counts
        known = np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32)
        ends = np.cumsum(np.array(counts, np.int64))
        self.first = ends - np.array(counts, np.int64)
        # Runs of known words, cut at the ends of documents; short ones hold no window.
        shortest = min((w for w in block.window if w), default=1)
        is_known = known >= 0
        new = np.r_[True, ~is_known[:-1]][: len(known)] & is_known
        at_first = self.first[(self.first < len(known)) & (np.array(counts) > 0)]
        new[at_first] |= is_known[at_first]
        run_start = np.flatnonzero(new)
        last = np.r_[~is_known[1:], True][: len(known)] & is_known
        at_end = ends[(np.array(counts) > 0)] - 1
        last[at_end] |= is_known[at_end]
        run_length = np.flatnonzero(last) + 1 - run_start
        kept = run_length >= shortest
        run_start, run_length = run_start[kept], run_length[kept]
        # Runs one after another, each followed by a separator below all words.
        total = run_length + 1
        at = np.cumsum(total) - total
        size = int(total.sum())
        self.place = np.arange(size) - np.repeat(at, total) + np.repeat(run_start, total)
        self.symbols = np.zeros(size, np.int64)
        inside = np.ones(size, bool)
        inside[at + run_length] = False
        self.symbols[inside] = known[self.place[inside]] + 1
        self.doc = np.searchsorted(ends, self.place, "right")
        self.order = suffix_array(self.symbols.astype(np.uint64), depth=depth) if size else np.zeros(0, np.int64)

    def search(self, block: Block):
        """Locate every test suffix.

        Returns the matched windows as (test suffix, place in the array) pairs, and for
        each test suffix the length and one place of its longest match.
        """
        n, order = len(self.order), self.order
        tests = len(block.words)
        longest, longest_at = np.zeros(tests, np.int32), np.full(tests, -1, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if not n:
            return found, longest, longest_at
        words = np.frombuffer(block.words, np.int32).astype(np.int64) + 1
        left, window = np.frombuffer(block.left, np.int32), np.frombuffer(block.window, np.int32)
        base = len(block.vocabulary) + 1
        # Class: number of the distinct prefix of the current length, in array order.
        class_of = np.zeros(n, np.int64)
        active, active_class, depth = np.arange(tests), np.zeros(tests, np.int64), 0
        while len(active):
            at = order + depth
            symbol = np.where(at < n, self.symbols[np.minimum(at, n - 1)], 0)
            keys = class_of * base + symbol
            asked = active_class * base + words[active + depth]
            low, high = np.searchsorted(keys, asked, "left"), np.searchsorted(keys, asked, "right")
            hit = high > low
            active, low, high = active[hit], low[hit], high[hit]
            depth += 1
            longest[active], longest_at[active] = depth, order[low]
            full = window[active] == depth
            for test, a, b in zip(active[full], low[full], high[full], strict=True):
                found.append((np.full(b - a, test), order[a:b]))
            new = np.r_[True, keys[1:] != keys[:-1]]
            class_of = np.cumsum(new) - 1
            active_class = class_of[low]
            if depth == self.depth:
                break
            more = left[active] > depth
            active, active_class = active[more], active_class[more]
        return found, longest, longest_at


def _merged(starts: np.ndarray, lengths: np.ndarray) -> int:
    """How many places intervals cover; ``starts`` ascending."""
    ends = np.maximum.accumulate(starts + lengths)
    before = np.r_[0, ends[:-1]]
    return int(np.maximum(ends - np.maximum(starts, before), 0).sum())


def _scan(block: Block):
    """Per document: its words and the spans that windows of the block match."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A window is all that has to match, however long its item.
        depth = max(block.window, default=1)
        for batch in batches:
            shard = Shard(block, batch["_text"].to_pylist(), depth)
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for test, at in shard.search(block)[0]:
                t = int(test[0])
                name, length = block.names[block.item[t]], block.window[t]
                for doc, place in zip(shard.doc[at].tolist(), shard.place[at].tolist(), strict=True):
                    start = place - int(shard.first[doc])
                    spans[doc].append({"start": start, "length": length, "item": name})
            kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("item", pa.string())]))
            rest = batch.drop_columns("_text")
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(shard.counts, pa.int64()), pa.array(spans, kind)],
                [*rest.schema.names, "_words", "_spans"],
            )

    return scan


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits, n_items, digests = [], [], []
        for spans in batch["_spans"].to_pylist():
            spans = sorted(spans or [], key=lambda s: s["start"])
            starts = np.array([s["start"] for s in spans], np.int64)
            lengths = np.array([s["length"] for s in spans], np.int64)
            hits.append(_merged(starts, lengths) if spans else 0)
            names = sorted({s["item"] for s in spans})
            n_items.append(len(names))
            digests.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        rest = batch.drop_columns(["_spans"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(hits, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests)],
            [*rest.schema.names, "_hit", "_items", "_digest"],
        )


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``_words``, ``_hit``, ``_items``, ``_digest``.

    ``_words`` counts a document's words, ``_hit`` those inside any occurrence of a window,
    ``_items`` the items with an occurring window; ``_digest`` is the SHA-256 of their ids,
    sorted as text and joined by commas. NULL texts have no words. A NULL ``item_id`` is
    the empty text, equal ids count as one item. Without items nothing is hit.
    """
    prepare(docs.sparkSession)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    source = docs.select(*kept, text_column().alias("_text"))
    spans = "array<struct<start:int,length:int,item:string>>"
    shape = docs.select(*kept, F.lit(0).cast("long").alias("_words"), F.lit(None).cast(spans).alias("_spans")).schema
    several = list(blocks(items, window, block_bytes)) or [Block()]
    if len(several) == 1:
        found = source.mapInArrow(_scan(several[0]), shape)
    else:
        # A row is known by all its columns: equal rows have equal spans and are counted.
        parts = [source.mapInArrow(_scan(b), shape) for b in several]
        whole = reduce(DataFrame.unionByName, parts)
        found = (
            whole.groupBy(*docs.columns)
            .agg(
                F.max("_words").alias("_words"),
                F.flatten(F.collect_set("_spans")).alias("_spans"),
                (F.count("*") / len(several)).cast("int").alias("_copies"),
            )
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .drop("_copy", "_copies")
        )
    out = docs.select(
        *kept,
        F.lit(0).cast("long").alias("_words"),
        F.lit(0).cast("long").alias("_hit"),
        F.lit(0).cast("long").alias("_items"),
        F.lit("").alias("_digest"),
    ).schema
    return found.mapInArrow(_finish, out)


def longest_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim match of each test suffix over all shards, and one place of it.

    Suffixes with no match of ``window`` words (the whole item, if that is shorter) give no
    row. ``item_start`` and ``doc_start`` count words.
    """
    prepare(docs.sparkSession)

    def locate(block: Block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            left, need = np.array(block.left), np.array(block.window)
            item = np.array(block.item)
            size = np.zeros(len(block.names), np.int64)
            np.maximum.at(size, item, left)
            for batch in batches:
                shard = Shard(block, batch["text"].to_pylist(), int(left.max(initial=1)))
                _, longest, at = shard.search(block)
                tests = np.flatnonzero((need > 0) & (longest >= need))
                doc = shard.doc[at[tests]] if len(tests) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.names[item[t]] for t in tests], pa.string()),
                        pa.array((size[item[tests]] - left[tests]).astype(np.int32)),
                        pa.array(longest[tests]),
                        batch["doc_id"].take(pa.array(doc, pa.int64())),
                        pa.array((shard.place[at[tests]] - shard.first[doc]).astype(np.int32))
                        if len(tests)
                        else pa.array([], pa.int32()),
                    ],
                    ["item_id", "item_start", "length", "doc_id", "doc_start"],
                )

        return run

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    parts = [source.mapInArrow(locate(b), LONGEST) for b in blocks(items, window, block_bytes)]
    if not parts:
        return docs.sparkSession.createDataFrame([], LONGEST)
    best = F.max_by(F.struct("length", "doc_id", "doc_start"), F.struct("length", -F.col("doc_id"), -F.col("doc_start")))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("item_id", "item_start")
        .agg(best.alias("best"))
        .select("item_id", "item_start", "best.*")
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of any item occurs, with their own columns."""
    plain = with_plain_names(docs, "text")
    return matches(plain, items, window).where("_hit = 0").select(*plain.columns).toDF(*docs.columns)
