"""Repeat removal against a scan of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from adstream.llm import suffixdedup
from adstream.llm.suffixes import common_prefixes, packed, suffix_array

LENGTH, FRAGMENT = 24, 8


def brute(docs, length):
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(docs, data, strict=True):
        hit = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                hit[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(d)) if hit[i] and (i == 0 or not hit[i - 1]))
        kept = bytes(b for b, h in zip(d, hit, strict=True) if not h)
        out.append((doc_id, len(d), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def ours(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = suffixdedup.remove_repeats(df, **options).collect()
    return Counter(
        (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows
    )


def corpus(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abé d") for _ in range(n))
    passages = [word(rng.randint(10, 90)) for _ in range(6)]
    docs = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else word(rng.randint(0, 40)) for _ in range(4)]
        docs.append((i, "".join(parts)))
    docs += [(100 + i, docs[i][1]) for i in range(5)]  # copies
    docs += [(i, docs[i][1]) for i in (7, 8)]  # repeated rows
    docs += [(None, docs[3][1]), (None, None), (200, ""), (201, None), (7, "another text of a known id")]
    docs += [(300, "a" * 200), (301, "ab" * 60)]  # repeats that overlap themselves
    return docs


@pytest.mark.parametrize("shard", [3000, 6])
def test_equals_brute_force(spark, shard):
    docs = corpus(shard)
    assert ours(spark, docs, length=LENGTH, fragment=FRAGMENT, shard=shard) == brute(docs, LENGTH)


def test_hot_passage_is_spread_and_merged(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh") for _ in range(60))
    noise = lambda n: "".join(rng.choice("uvwxyz") for _ in range(n))
    docs = [(i, noise(30) + passage + noise(30)) for i in range(80)]
    assert ours(spark, docs, length=LENGTH, fragment=FRAGMENT, shard=7) == brute(docs, LENGTH)


def test_very_long_text_and_default_length(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefghij klm") for _ in range(600_000))
    docs = [(1, long), (2, "x" * 50 + long[300_000:300_700]), (3, "short"), (4, long[599_000:])]
    assert ours(spark, docs) == brute(docs, suffixdedup.LENGTH)


def test_empty_table_and_other_columns(spark):
    assert not ours(spark, [])
    df = spark.createDataFrame([(1, "z", 3, 4)], "doc_id long, text string, row int, anchors int")
    assert [r.n_bytes for r in suffixdedup.remove_repeats(df).collect()] == [1]


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.integers(1, 4, int(rng.integers(1, 60)))
        order = suffix_array(s.astype(np.uint64))
        assert order.tolist() == sorted(range(len(s)), key=lambda i, s=s: s[i:].tolist())
        for limit in (3, 100):
            shared = common_prefixes(packed(s), order, limit)
            for k in range(1, len(s)):
                a, b = s[order[k] :], s[order[k - 1] :]
                m = min(len(a), len(b))
                differ = np.flatnonzero(a[:m] != b[:m])
                assert shared[k] == min(int(differ[0]) if len(differ) else m, limit)


def in_contexts(place, before, after, length):
    return [s for p, b, a in zip(place, before, after, strict=True) for s in range(p - b, p + a - length + 1)]


def test_each_string_is_in_one_context():
    rng = np.random.default_rng(3)
    sizes = [0, 23, 24, 400, 5, 60, 300]
    data = rng.integers(97, 100, sum(sizes)).astype(np.uint8)
    data[100:300] = 97  # fragments that repeat side by side
    ends = np.cumsum(sizes)
    place, before, after, *_ = suffixdedup.anchors(data, ends, LENGTH, FRAGMENT)
    whole = [s for e, n in zip(ends, sizes, strict=True) for s in range(e - n, e - LENGTH + 1)]
    assert in_contexts(place, before, after, LENGTH) == whole
    # Equal strings have their anchor at the same place.
    strings = data.tobytes()
    at = {}
    for p, b, a in zip(place, before, after, strict=True):
        for s in range(p - b, p + a - LENGTH + 1):
            assert at.setdefault(strings[s : s + LENGTH], p - s) == p - s


def test_each_string_of_a_long_text_is_in_one_context():
    data = np.random.default_rng(4).integers(97, 123, (1 << suffixdedup.CHUNK_BITS) * 2 + 77).astype(np.uint8)
    place, before, after, *_ = suffixdedup._text_anchors(data, suffixdedup.LENGTH, suffixdedup.FRAGMENT)
    starts = np.concatenate([np.arange(p - b, p + a - 199) for p, b, a in zip(place, before, after, strict=True)])
    assert np.array_equal(starts, np.arange(len(data) - 199))
