"""SimHash, decontamination, personal data, language and quality on small tables."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from adstream.llm import decontaminate, langid, pii, quality, simhash

WORDS = "a b c D é x1".split()


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.select("*", F.lit(1).alias("_words"), F.lit(2).alias("fingerprint"), F.lit(3).alias("score")).drop("_words")


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


# SimHash


def plain_fingerprint(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    if not words:
        return 0
    hashes = [xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    unique = sorted(prints)
    for i, a in enumerate(unique):
        for b in unique[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {p: find(p) for p in unique}


def test_fingerprints_in_segments(monkeypatch):
    rng = random.Random(1)
    texts = [sentence(rng, n) for n in (0, 1, 2, 3, 4, 50)] + ["  A\tb\n\nc ", "", None, "é" * 90]
    for size in (1 << 20, 5):
        monkeypatch.setattr(simhash, "SEGMENT", size)
        assert [simhash.fingerprint(t) for t in texts] == list(map(plain_fingerprint, texts))


def test_bit_sliced_pairs():
    rng = np.random.default_rng(0)
    for radius in (1, 2, 3):
        sizes = rng.integers(1, 200, 6)
        group = np.repeat(np.arange(6), sizes)
        values = rng.integers(0, 1 << 63, 3).astype(np.uint64)[rng.integers(0, 3, len(group))]
        for _ in range(3):
            values ^= np.uint64(1) << rng.integers(0, 64, len(group)).astype(np.uint64)
        got = {(int(a), int(b)) for x, y in simhash.close_pairs(values, group, radius) for a, b in zip(x, y)}
        assert got == {
            (i, j)
            for i in range(len(values))
            for j in range(i)
            if group[i] == group[j] and int(values[i] ^ values[j]).bit_count() <= radius
        }


def test_classes_with_and_without_dense_buckets(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) for b in base for _ in range(25)]
    prints = [p & (1 << 64) - 1 for p in prints]
    rows = [(i if i % 9 else None, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    classes = plain_classes(set(prints))
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[classes[p]] = min(least.get(classes[p], doc_id), doc_id)
    expected = {p: least.get(c) for p, c in classes.items()}
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    for dense in (simhash.DENSE, 5):
        got = simhash.near_duplicates(df, dense=dense).collect()
        assert {r.fingerprint % (1 << 64): r.component_id for r in got} == expected


def test_deduplicate(spark):
    rng = random.Random(4)
    text = sentence(rng, 400)
    rows = [(5, text), (3, text), (3, text), (9, text + " z"), (None, text), (7, None), (8, ""), (None, "alone here")]
    df = frame(spark, [(d, t, "en", "s") for d, t in rows])
    labels = {(r.doc_id, r.component_id) for r in simhash.label(df).collect()}
    assert {(5, 3), (3, 3), (None, 3), (7, 7), (8, 7), (None, None)} <= labels
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    classes = plain_classes({plain_fingerprint(t) for _, t in rows})
    assert kept.count() == len(set(classes.values()))
    assert {3, 7, None} <= {r.doc_id for r in kept.collect()}
    assert simhash.label(df.limit(0)).count() == 0 and simhash.deduplicate(df.limit(0)).count() == 0


# Decontamination


def plain_matches(docs, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    out = Counter()
    for doc_id, text in docs:
        words = word.findall(lower(text))
        hit, found = [0] * len(words), set()
        for name, item in items:
            own = word.findall(lower(item))
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == own[i : i + size]:
                        found.add(str(name))
                        hit[j : j + size] = [1] * size
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id, len(words), sum(hit), len(found), digest] += 1
    return out


def test_matches(spark):
    rng = random.Random(6)
    docs = [(i, sentence(rng, rng.randint(0, 60))) for i in range(50)] + [(0, None), (None, ""), (1, "a b. C-d")]
    docs += docs[:2]
    items = [(i, sentence(rng, rng.randint(0, 9))) for i in range(8)] + [(20, None), (20, "a;B,c"), (21, "É é")]
    df = frame(spark, [(d, t, "x", "y") for d, t in docs])
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 12):
        got = decontaminate.matches(df, table, window=4, block_bytes=block)
        rows = got.select("doc_id", "_words", "_hit", "_items", "_digest").collect()
        assert Counter(map(tuple, rows)) == plain_matches(docs, items, 4)
    kept = decontaminate.decontaminate(df, table, window=4)
    assert kept.columns == df.columns
    assert kept.count() == sum(n for row, n in plain_matches(docs, items, 4).items() if not row[2])
    assert decontaminate.decontaminate(df, table.limit(0)).count() == len(docs)
    assert decontaminate.decontaminate(df.limit(0), table).count() == 0


def test_longest_matches(spark):
    docs = frame(spark, [(1, "q a b c d e r", "", ""), (2, "a b c d f", "", ""), (3, "x", "", "")])
    items = spark.createDataFrame([(7, "z a b c d e y")], "item_id long, text string")
    rows = decontaminate.longest_matches(docs, items, window=3).collect()
    found = {(r.item_start, r.length, r.doc_id, r.doc_start) for r in rows}
    assert found == {(1, 5, 1, 1), (2, 4, 1, 2), (3, 3, 1, 3)}


# Personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15],
    }


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("a0125@.-+ ()é"), max_size=70))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_base(text)


def test_base_spans_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a1" * 150_000):
        pii.proposed(text, pii.base_spans(text))


def test_detect_and_redact(spark):
    rng = random.Random(8)
    secret = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'é mail x.{i}@a.example.com token = "{secret()}" end 4111 1111 1111 1111 at 10.0.0.{i}') for i in range(30)]
    rows += [(None, None), (40, ""), (41, "a clean text of words"), (3, "call +1 (555) 123-4567"), (3, "call +1 (555) 123-4567")]
    df = frame(spark, [(d, t, "", "") for d, t in rows])
    found, model = pii.detect(df)
    got = found.collect()
    assert len(got) == len(rows)
    expected = Counter(
        (d, *(len(plain_base(t or "")[k]) for k in pii.BASE_KINDS), hashlib.sha256(pii.spans_text(plain_base(t or "")).encode()).hexdigest())
        for d, t in rows
    )
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == expected
    assert sum("secret:" in r.spans for r in got) == 30
    assert [r.spans for r in got if r.doc_id in (None, 40, 41)] == ["", "", ""]
    wrong, right = model.reliability["context"][1]
    assert right > wrong
    clean = pii.redact(df, model)
    assert clean.columns == df.columns and clean.count() == len(rows)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[5] == 'é mail [EMAIL] token = "[SECRET]" end [CARD] at [IP]'
    assert texts[None] is None and texts[3] == "call [PHONE]"
    assert pii.detect(df.limit(0))[0].count() == 0


# Language and quality


def test_language(spark):
    rng = random.Random(2)
    words = {"en": "the of and cat house".split(), "de": "der und die haus katze".split(), "fr": "le la et maison chat".split()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, text(lang, 30), lang, "s") for i in range(60) for lang in words]
    model = langid.fit(frame(spark, [*rows, (1, None, "en", ""), (2, "words", None, "")]))
    assert model.languages == ["de", "en", "fr"]
    tests = [(1, "The house", "x", ""), (2, "katzehaus", None, ""), (3, "12 !!", "en", ""), (None, None, "", ""), (5, "la " * 400_000, "", "")]
    got = langid.identify(frame(spark, tests), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in got] == [(1, "en"), (2, "de"), (3, "und"), (None, "und"), (5, "fr")]
    assert all(0 <= r.score <= 1 for r in got)
    empty = langid.fit(frame(spark, []))
    assert [r.lang_pred for r in langid.identify(frame(spark, tests[:1]), empty).collect()] == ["und"]


def test_quality(spark):
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice("some words that make up a text".split()) for _ in range(40))
    bad = lambda: "BUY!! " * 40 + "$$$ ### "
    rows = [(i, bad() if i % 4 == 0 else good(), "en", f"h{i % 3}") for i in range(120)]
    rows += [(500, None, None, None), (None, good(), "en", "new"), (501, good(), "en", "h0"), (501, good(), "en", "h0")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(90)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    df = frame(spark, rows)
    got = quality.classify(df, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == len(rows)
    keep = {r.doc_id: r.keep for r in got}
    assert all(keep[i] == (i % 4 > 0) for i in range(120)) and keep[501] and keep[None]
    lone = next(r for r in got if r.doc_id is None)
    rates = [r.p_host for r in got if r.doc_id is not None and r.doc_id < 120]
    # A host of one document stays near the prior of all hosts.
    assert min(rates) - 0.1 < lone.p_host < 0.95
    assert quality.classify(df.limit(0), labels, F.col("source"), F.col("lang")).count() == 0
    none = quality.classify(df.limit(3), labels.limit(0), F.col("source"), F.col("lang"))
    assert [round(r.p_document, 6) for r in none.collect()] == [0.5] * 3


def plain_language(labelled, texts, rare):
    """Sums of log frequencies word by word, an unseen word by its known parts of the greatest length."""
    words = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    parts = lambda w, n: [f"^{w}$"[i : i + n] for i in range(len(w) + 3 - n)] if n else [w]
    langs = sorted({lang for text, lang in labelled if words(text)})
    tables = []
    for n in range(5):
        counts = {lang: Counter() for lang in langs}
        for text, lang in labelled:
            for w in words(text):
                counts[lang].update(parts(w, n))
        totals = {lang: counts[lang].total() for lang in langs}
        items = {x for lang in langs for x, k in counts[lang].items() if k >= rare * totals[lang]}
        tables.append(
            {x: np.array([np.log((counts[lang][x] + 0.5) / (totals[lang] + 0.5 * (len(items) + 1))) for lang in langs]) for x in items}
        )
    found = []
    for text in texts:
        total = np.zeros(len(langs))
        for w in words(text):
            for n in (0, 4, 3, 2, 1):
                known = [tables[n][x] for x in parts(w, n) if x in tables[n]]
                if known:
                    total += np.mean(known, axis=0)
                    break
        odds = np.exp(total - total.max())
        found.append((langs[int(odds.argmax())], odds.max() / odds.sum()) if words(text) else ("und", 0.0))
    return found


def test_language_equals_plain_scores(spark):
    rng = random.Random(9)
    letters = {"x": "abcde", "y": "cdefg", "z": "efghé"}
    word = lambda lang: "".join(rng.choice(letters[lang]) for _ in range(rng.randint(1, 6)))
    labelled = [(" ".join(word(lang) for _ in range(30)), lang) for lang in "xyzxyzxy"]
    texts = [" ".join(word(rng.choice("xyz")) for _ in range(rng.randint(1, 8))) for _ in range(60)]
    texts += ["", None, "12 --", "É" * 50, "qqq rrr", texts[0]]
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(labelled)]
    for rare in (0, 0.02):
        model = langid.fit(frame(spark, rows), rare=rare)
        docs = frame(spark, [(i, t, None, "s") for i, t in enumerate(texts)])
        got = {r.doc_id: (r.lang_pred, r["score"]) for r in langid.identify(docs.drop("score"), model).collect()}
        for i, (lang, score) in enumerate(plain_language(labelled, texts, rare)):
            assert abs(got[i][1] - score) < 1e-4, texts[i]
            assert got[i][0] == lang or score < 0.51


def plain_proposed(text):
    """Wider spans by comparing each with all before it."""
    taken = [s for spans in pii.base_spans(text).values() for s in spans]
    found = []
    for kind, pattern in pii.WIDER.items():
        for m in pattern.finditer(text):
            a, b = m.span()
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "card" and not pii.luhn(digits):
                continue
            if kind == "secret" and not (digits and re.search("[A-Za-z]", m.group())):
                continue
            if kind != "email" and not re.search("[0-9]", text):
                continue
            if not any(x < b and a < y for x, y in taken):
                taken.append((a, b))
                found.append((a, b, kind))
    return found


PIECES = ["a@b.co", "1.2.3.4", "4111 1111 1111 1111", "+1 (555) 123-4567", "555-123-4567", "joe [at] b (dot) org", "k1" * 12,
          "3782 822463 10005", "sk-" + "a1" * 9, "eyJhb1.c2.d3", "aB3/" * 7 + "==", " ", " ", "-", ".", "word"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_proposed_spans(pieces):
    text = "".join(pieces)
    got = [(a, b, pii.KINDS[f[0]]) for a, b, f in pii.proposed(text, pii.base_spans(text))]
    assert got == plain_proposed(text)


def test_secrets_of_any_length_and_shape():
    keys = ["a1B2" * 500, "z9" * 201, "xoxb-1234567890-abcdefghijkl", "sk-proj_a1b2c3d4e5f6g7h8", "eyJhbGciOi1.eyJzdWIiOjEy.c2ln-_bmF0",
            "aGVsbG8+d29ybGQ/MTIzNDU2Nzg5MA=="]
    for key in keys:
        text = f"the token {key} is secret"
        assert [(a, b) for a, b, _ in pii.proposed(text, pii.base_spans(text))] == [(10, 10 + len(key))], key


def test_many_spans_and_long_runs_take_linear_time():
    for text in ("call 555-123-4567 or " * 32_000, "a/" * 500_000, "eyJ-" * 250_000 + "1", "sk-" * 300_000, "a1" * 500_000):
        base = pii.base_spans(text)
        begun = time.perf_counter()
        pii.proposed(text, base)
        assert time.perf_counter() - begun < 3


def test_a_long_item_is_matched_in_short_time(spark):
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 20_000)}" for _ in range(16_000)]
    block = decontaminate.Block()
    block.add("long", [w.encode() for w in words], 10)
    begun = time.perf_counter()
    shard = decontaminate.Shard(block, ["x " + " ".join(words)], 10)
    found = shard.search(block)[0]
    assert time.perf_counter() - begun < 2
    assert sum(len(at) for _, at in found) == 16_000 - 9


def plain_posteriors(rows):
    """Scores of (host, path, p) rows by the formulas of the operator, group by group."""
    def groups(key):
        found = {}
        for row in rows:
            found.setdefault(key(row), []).append(row[2])
        return found

    def weight(mean, rates):
        if not rates:
            return quality.WEIGHT[1]
        spread = np.mean([(rate - centre) ** 2 for rate, centre, _ in rates])
        noise = np.mean([mean * (1 - mean) / n for _, _, n in rates])
        return float(np.clip(mean * (1 - mean) / max(spread - noise, 1e-9) - 1, *quality.WEIGHT))

    hosts, paths = groups(lambda r: r[0]), groups(lambda r: r[:2])
    prior = min(max(np.mean([r[2] for r in rows]), 1e-4), 1 - 1e-4)
    w = weight(prior, [(np.mean(p), prior, len(p)) for p in hosts.values() if len(p) > 1])
    of_host = {h: (sum(p) + w * prior) / (len(p) + w) for h, p in hosts.items()}
    v = weight(prior, [(np.mean(p), of_host[k[0]], len(p)) for k, p in paths.items() if len(p) > 1])
    logit = lambda x: np.log(np.clip(x, 1e-6, 1 - 1e-6) / (1 - np.clip(x, 1e-6, 1 - 1e-6)))
    for host, path, p in rows:
        own = paths[host, path]
        of_path = (sum(own) + v * of_host[host]) / (len(own) + v)
        others = (sum(own) - p + v * of_host[host]) / (len(own) - 1 + v)
        odds = logit(p) + logit(others) - np.log(prior / (1 - prior))
        yield of_host[host], of_path, 1 / (1 + np.exp(-odds))


def test_posteriors_equal_plain_formulas(spark):
    rng = random.Random(4)
    rows = [(i, "word " * rng.randint(1, 30) + "!" * rng.randint(0, 9), f"p{rng.randint(0, 3)}", f"h{rng.randint(0, 6)}") for i in range(150)]
    rows += [(900 + i, "same text", "hot", "hot") for i in range(100)] + [(7, None, None, None)]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 3 > 0) for i in range(80)], "doc_id long, quality boolean")
    labels = labels.withColumn("quality", F.col("quality").cast("int"))
    got = quality.classify(df, labels, F.col("source"), F.col("lang"))
    measured = quality.measure(df, F.col("source"), F.col("lang")).collect()
    classifier = quality.train(quality.measure(df, F.col("source"), F.col("lang")), labels)
    x = np.array([quality.features(t) for _, t, _, _ in rows], float)
    p = 1 / (1 + np.exp(-classifier.odds(x)))
    plain = list(plain_posteriors([(h or "", a or "", q) for (_, _, a, h), q in zip(rows, p.tolist(), strict=True)]))
    assert len(measured) == len(rows)
    expected = sorted((r[0], round(q, 5), *(round(float(v), 5) for v in own)) for r, q, own in zip(rows, p, plain, strict=True))
    found = sorted(
        (r.doc_id, round(r.p_document, 5), round(r.p_host, 5), round(r.p_path, 5), round(r.quality_score, 5)) for r in got.collect()
    )
    for a, b in zip(found, expected, strict=True):
        assert a[0] == b[0] and np.allclose(a[1:], b[1:], atol=3e-5), (a, b)
