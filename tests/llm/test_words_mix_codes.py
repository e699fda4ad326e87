"""Spelling variants, the mixing of sources and vector codes against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adstream.llm import codes, mixing, spelling

CLASHING = "doc_id long, text string, source string, lang string, key string, word string, n int, size int, `a.b` int, _text int"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, s, None, "k", "w", 1, 2, 3, 4) for d, t, s in rows], CLASHING)


# Words.


def plain_words(rows, every=199, letters=6, least=5):
    counts = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def plain_variants(counts, factor=5):
    letters = set("".join(counts))
    found = {}
    for w, n in counts.items():
        edits = {w[:i] + w[i + 1 :] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + k :] for i in range(len(w) + 1) for c in letters for k in (0, 1)}
        near = [x for x in edits if x in counts and x != w]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        found[w] = (best if best and counts[best] >= factor * n else None, n, len(near))
    result = {}
    for w, (form, n, n_near) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        result[w] = (form, root, n, n_near, counts[form] if form else None)
    return result


def vocabulary_texts(rng, n_words=160):
    """Words of few letters, so that many are near; chains of forms; hot words; a very long word."""
    words = ["".join(rng.choice("abé" if i % 2 else "aabcé") for _ in range(rng.randint(6, 8))) for i in range(n_words)]
    texts = []
    for w in words:
        texts += [w] * rng.choice((3, 5, 6, 30))
    texts += ["planet"] * 5 + ["planets"] * 25 + ["Planetss"] * 130 + ["Straße Ärger"] * 7 + ["STRAßE"] * 7
    texts += [("q" * 70_000) + " " + ("q" * 69_999)] * 5
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("block", "n_classes", "every"), [(7, 3, 7), (spelling.BLOCK, None, 199), (64, 1, 3)])
def test_variants_equal_all_edits(spark, block, n_classes, every):
    rng = random.Random(block)
    texts = vocabulary_texts(rng)
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts)] + [(1, None), (2, ""), (None, None), (3, "1 -- ÷×")]
    docs = documents(spark, [(d, t, None) for d, t in rows]).repartition(3)
    got = {r[0]: tuple(r[1:]) for r in spelling.group_variants(docs, every, block=block, n_classes=n_classes).collect()}
    counts = plain_words(rows, every)
    short = {w: n for w, n in counts.items() if len(w) < 100}
    expected = plain_variants(short)
    assert {w: v for w, v in got.items() if len(w) < 100} == expected
    assert {w: got[w][2] for w in got if len(w) > 100} == {w: n for w, n in counts.items() if len(w) > 100}
    if every == 199:
        assert got["planet"][:2] == ("planets", "planetss") and got["planets"][0] == "planetss"
        assert got["q" * 70_000][3] == 1
    assert any(v[3] > 1 for v in got.values())


def test_words_count_every_row_and_none_without_damage(spark):
    rows = [(7, "Letters letters, LETTERS"), (7, "Letters letters, LETTERS"), (None, "letters short")]
    found = spelling.count_words(documents(spark, [(d, t, None) for d, t in rows]), damaged_every=None).collect()
    assert [tuple(r) for r in found] == [("letters", 7)]


def test_segments_cut_no_word(monkeypatch):
    text = " ".join("wordé" * (i % 4) + "x" for i in range(300))
    whole = [r for runs in spelling._runs(text) for r in runs]
    monkeypatch.setattr(spelling, "SEGMENT", 5)
    assert [r for runs in spelling._runs(text) for r in runs] == whole == re.findall("[A-Za-zÀ-ÿ]+", text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=3, max_size=3), max_size=12, unique=True), st.lists(st.text("abé", min_size=4, max_size=4), max_size=12, unique=True))
def test_pairs_of_blocks_are_those_one_edit_apart(three, four):
    def apart(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    for a, b in ((three, three), (three, four)):
        if a and b:
            i, j = spelling.near_pairs(spelling.Block(a), spelling.Block(b), a is b)
            want = {(x, y) for x, v in enumerate(a) for y, w in enumerate(b) if apart(v, w) and (a is not b or x < y)}
            assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_no_words_give_no_rows(spark):
    for rows in ([], [(1, None, None)], [(1, "short", "s")]):
        assert spelling.group_variants(documents(spark, rows)).count() == 0


# Mixing.


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped = set()
    while True:
        rest = sum(sizes.values()) - most * sum(sizes[s] for s in stopped)
        share = sum(w for s, w in weight.items() if s not in stopped)
        above = {s for s in names if s not in stopped and most * sizes[s] * share < weight[s] * rest}
        if not above:
            return {s: most * sizes[s] if s in stopped else weight[s] * rest / share if share else 0.0 for s in names}
        stopped |= above


def mix_rows(rng):
    text = lambda n: "\t".join(["\n w\x0b"] * n)
    rows = [(i, text(rng.randint(0, 30)), rng.choice(("a", "b", "big", "big", "big", None, "é"))) for i in range(400)]
    rows += [(1000, text(4), "tiny"), (1001, text(3), "A")]  # reach three times their size
    rows += [(5, text(9), "copies")] * 300 + [(None, text(2), "copies")] * 200 + [(None, None, "b")] * 3
    rows += [(2000, None, "empty"), (2001, "", "empty"), (2002, " \t ", "empty"), (7, "x y\x85z \x1f", "b")]
    return rows


@pytest.mark.parametrize(("range_rows", "fan", "copies"), [(10, 4, 32), (mixing.RANGE, mixing.FAN, mixing.COPIES)])
def test_mix_meets_every_budget(spark, monkeypatch, range_rows, fan, copies):
    monkeypatch.setattr(mixing, "FAN", fan)
    monkeypatch.setattr(mixing, "COPIES", copies)
    rows = mix_rows(random.Random(5))
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    docs = documents(spark, rows).repartition(5)
    got = mixing.mix(docs, range_rows=range_rows).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, size(t)) for d, t, _ in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    targets = plain_targets(sizes)
    assert Counter((r.source_size, r.target) for r in got) == Counter((sizes[s], targets[s]) for _, _, s in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    aims = Counter({(sizes[s], targets[s]) for s in targets})
    taken = defaultdict(int)
    for r in got:
        taken[r.source_size, r.target] += r.taken
    assert set(aims.values()) == {1}
    assert all(0 <= target - n < 1 for (_, target), n in taken.items())
    # Whole epochs and at most one document cut inside in each source.
    cut = Counter(r.source_size for r in got if r["size"] and r.taken % r["size"])
    assert max(cut.values(), default=0) <= 1
    again = mixing.mix(documents(spark, rows[::-1]).repartition(2)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixed_texts_hold_the_words_taken(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(i % 17)), "abc"[i % 7 % 3]) for i in range(90)]
    docs = documents(spark, rows)
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    found = Counter()
    for r in mixing.mixed_texts(docs).collect():
        words = r.text.split()
        assert words == rows[r.doc_id][1].split()[: len(words)]
        found[r.doc_id] += len(words) * r.repeats
    assert found == taken


def test_mix_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).count() == 0
    row = mixing.mix(documents(spark, [(1, None, None)])).first()
    assert tuple(row) == (1, 0, 0, 0.0, 0)


# Codes.


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """``rows``: (vec_id, vector) of one length, in the order in which they start the codebooks."""
    x = [[int(np.floor(4096 * float(v))) for v in vector] for _, vector in rows]
    bounds = np.cumsum([0, *codes.widths(len(x[0]), parts)])
    cut = [[v[a:b] for a, b in zip(bounds, bounds[1:])] for v in x]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((m - n) ** 2 for m, n in zip(a, b, strict=True))
    nearest = lambda v, book: min((apart(v, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            owned = defaultdict(list)
            for v in cut:
                owned[nearest(v[p], books[p])[1]].append(v[p])
            books[p] = [[sum(c) // len(owned[i]) for c in zip(*owned[i])] if owned[i] else e for i, e in enumerate(books[p])]
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return ["".join(f"{i:02x}" for _, i in f) for f in found], [sum(d for d, _ in f) for f in found], sha


def test_codes_equal_plain_rounds(spark):
    rng = random.Random(3)
    draw = lambda: [rng.choice((-1, 1)) * rng.random() ** 3 for _ in range(20)]
    rows = [(i, draw(), rng.choice((0, 1, None))) for i in range(300)]
    rows += [(300 + i, rows[4][1], 0) for i in range(200)] + [rows[7]] * 5  # a hot vector, repeated rows
    bad = [(600, None, 1), (601, [0.5, None, *[0.0] * 18], 1), (602, [float("nan")] * 20, 1), (603, [float("inf")] * 20, 1)]
    none = [(None, draw(), 9)]
    shape = "vec_id long, embedding array<double>, label int, row int, code string, `a.b` int"
    frame = spark.createDataFrame([(*r, 1, "c", 2) for r in rows + bad + none], shape).repartition(4)
    got = codes.label_errors(codes.compress(frame)).collect()
    ordered = sorted(rows, key=lambda r: (r[0], r[1])) + none
    code, error, sha = plain_codes([(i, v) for i, v, _ in ordered])
    of_label = Counter()
    for (_, _, label), e in zip(ordered, error, strict=True):
        of_label[label] += e
    want = Counter((r[0], c, e, of_label[r[2]], sha) for r, c, e in zip(ordered, code, error, strict=True))
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == want


def test_lengths_and_large_components_have_codes(spark):
    rows = [(1, [1e9, -3.0, 2.5], 1), (2, [-1e9, 1e-9, 0.0], 1), (3, [1e9, -3.0, 2.4], 1), (4, [], 2), (5, [2.0], 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.code, r.error, r.codebooks_sha256) for r in codes.compress(frame, parts=2).collect()}
    code, error, sha = plain_codes([r[:2] for r in rows[:3]], parts=2)
    assert [got[i] for i in (1, 2, 3)] == [(c, e, sha) for c, e in zip(code, error, strict=True)]
    assert got[4][:2] == ("0000", 0) and got[5][:2] == ("0000", 0)
    assert codes.compress(frame.where("vec_id > 9")).count() == 0
    with pytest.raises(ValueError):
        codes.integers(np.array([[1e300]]))


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_tree_finds_the_lowest_nearest_entry(data):
    width = data.draw(st.integers(0, 3))
    number = st.integers(-3, 3) | st.integers(-(1 << 40), 1 << 40)
    row = st.lists(number, min_size=width, max_size=width)
    entries = data.draw(st.lists(row, min_size=1, max_size=30))
    x = data.draw(st.lists(row, min_size=1, max_size=30))
    kind = object if any(abs(v) >= codes.SMALL for r in entries + x for v in r) else np.int64
    search = codes.Search(np.array(entries, kind).reshape(len(entries), width))
    found, best = search.nearest(np.array(x, kind).reshape(len(x), width))
    want = [min((sum((a - b) ** 2 for a, b in zip(r, e, strict=True)), i) for i, e in enumerate(entries)) for r in x]
    assert [(int(d), int(i)) for d, i in zip(best, found, strict=True)] == want


def test_tree_leaves_subtrees_out():
    rng = np.random.default_rng(1)
    entries = rng.integers(-(1 << 14), 1 << 14, (256, 2))
    search = codes.Search(entries)
    search.nearest(rng.integers(-(1 << 14), 1 << 14, (2000, 2)))
    assert search.computed < 0.5 * 256 * 2000
