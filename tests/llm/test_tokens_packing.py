"""Token counts and packing against the tokenizer library and a plain packer."""

import random
import zlib
from array import array
from collections import Counter
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adstream.llm import packing, token_counts
from adstream.llm import tokenizer as tok
from adstream.llm.common import scratch
from adstream.llm.queries import TOKENIZER

TEXTS = ["", None, " a  b\n\nc  ", "don't 12½ été\x85<|endoftext|> x", "日本 語", "x" * 5000, "The cat. " * 9000]
ROWS = [*enumerate(TEXTS), (1, TEXTS[2]), (None, "The cat."), (90, "The cat."), (91, "The cat.")]


@lru_cache
def library():
    return Tokenizer.from_file(TOKENIZER)


def ids(text):
    return library().encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x17F), st.sampled_from(" \n\t'sre")), max_size=60))
def test_ids_are_those_of_the_library(text):
    assert list(array("I", tok.load(TOKENIZER).ids(text))) == ids(text)


def test_long_texts_are_cut_where_no_piece_crosses(monkeypatch):
    monkeypatch.setattr(tok, "SEGMENT", 7)
    text = "a bc  def\n\n ghi'll  x" * 30
    assert "".join(tok.segments(text)) == text
    assert list(array("I", tok.load(TOKENIZER).ids(text))) == ids(text)


def docs(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", F.lit(1).alias("content"), F.lit(2).alias("n_tokens"), F.lit(3).alias("length"))


def test_counts_and_cache(spark):
    cache = scratch(spark, "cache")
    expected = Counter((d, len((t or "").encode()), len(ids(t))) for d, t in ROWS)
    for _ in range(2):  # the second run finds all counts
        got = token_counts.count_tokens(docs(spark), TOKENIZER, cache)
        assert Counter(map(tuple, got.collect())) == expected
        stored = spark.read.parquet(cache)
        assert stored.count() == len({t or "" for _, t in ROWS})
    more = docs(spark, [(5, "new"), (6, "The cat.")])
    assert token_counts.count_tokens(more, TOKENIZER, cache).count() == 2
    assert spark.read.parquet(cache).count() == stored.count() + 1
    # Counts of another version are not taken.
    stored.withColumn("tokenizer", F.lit("old")).withColumn("n_tokens", F.lit(-1).cast("long")).write.parquet(cache + "2")
    got = token_counts.count_tokens(docs(spark), TOKENIZER, cache + "2")
    assert Counter(map(tuple, got.collect())) == expected
    assert token_counts.count_tokens(docs(spark, []), TOKENIZER, scratch(spark, "cache")).count() == 0


def optimal(items, capacity):
    best, items = [len(items)], sorted(items, reverse=True)

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, [*rest, room - items[i]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best[0]


def best_fit(items, capacity):
    rooms = []
    for x in sorted(items, reverse=True):
        fits = [r for r in rooms if r >= x]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else capacity) - x)
    return sorted(rooms)


@settings(max_examples=300, deadline=None)
@given(st.integers(5, 30), st.lists(st.integers(1, 30), max_size=9))
def test_reduction_is_safe_and_bulk_packing_is_best_fit(capacity, items):
    items = [min(x, capacity) for x in items]
    counts = dict(Counter(items))
    fixed, rest = packing.reduce_instance(counts, capacity)
    left = [x for x, n in rest.items() for _ in range(n)]
    assert sum(fixed.values()) + optimal(left, capacity) == optimal(items, capacity)
    packed = packing.best_fit(counts, capacity)
    assert sorted(capacity - sum(p) for p, n in packed.items() for _ in range(n)) == best_fit(items, capacity)


@pytest.mark.parametrize("capacity", [8, 1024])
def test_pack_documents(spark, capacity):
    rng = random.Random(capacity)
    rows = ROWS + [(100 + i, "the cat sat " * rng.randint(0, 40)) for i in range(60)]
    placed = packing.pack_documents(docs(spark, rows), TOKENIZER, capacity).collect()
    expected = Counter()
    for doc_id, text in rows:
        own = [*ids(text), 2]
        for piece, (start, length) in enumerate(packing.cut(len(own), capacity)):
            assert length <= capacity and (piece == 0 or length == capacity or len(own) <= capacity)
            expected[doc_id, piece, start, length, zlib.crc32(array("I", own[start : start + length]).tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed) == expected
    sequences = {}
    for r in placed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    least = -(-sum(r.length for r in placed) // capacity)
    assert least <= len(sequences) <= len(best_fit([r.length for r in placed], capacity))
    assert packing.pack_documents(docs(spark, []), TOKENIZER, capacity).count() == 0
