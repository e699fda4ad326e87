"""The whole pipeline against plain versions of its stages, and what is registered."""

import random
import zlib
from array import array
from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
from adstream.llm import packing
from tests.llm.test_documents import plain_base, plain_classes, plain_fingerprint, plain_matches
from tests.llm.test_tokens_packing import ids

WORDS = {"en": "the of and cat house tree".split(), "de": "der und die haus katze baum".split()}
GIBBERISH = 143  # has no label, so nothing is learnt from it


def corpus():
    rng = random.Random(11)
    text = lambda lang, n: " ".join(rng.choice(WORDS[lang]) for _ in range(n))
    rows = [(i, text("en" if i % 3 else "de", rng.randint(5, 300))) for i in range(80)]
    items = [(1, text("en", 14)), (2, text("de", 12)), (3, None)]
    rows += [(100 + i, rows[i][1]) for i in range(10)]  # copies
    rows += [(5, rows[5][1])]  # a repeated row
    rows += [(120 + i, f"{rows[i][1]} {items[i % 2][1]} end") for i in range(6)]
    rows += [(130 + i, f"{rows[i + 20][1]} write to a.{i}@b.example.com or +1 (555) 123-456{i} at 10.1.2.{i}") for i in range(6)]
    rows += [(GIBBERISH, "xqzv wkrrt pflmb dgghk zzxw")]
    rows += [(140, None), (141, ""), (142, "12 -- 34"), (None, "the lone cat without a number of its own")]
    return rows, items


def redacted(text):
    spans = sorted((a, b, kind) for kind, found in plain_base(text).items() for a, b in found)
    for a, b, kind in reversed(spans):
        text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
    return text


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rows, items = corpus()
    langs = [None if d == GIBBERISH else "en" if "the" in (t or "") else "de" for d, t in rows]
    documents = [(d, t, lang, "s", len(t) if t else None) for (d, t), lang in zip(rows, langs)]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(documents, shape).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t) and d != GIBBERISH]
    classes = plain_classes({plain_fingerprint(t) for _, t in kept})
    best = {}
    for d, t in kept:
        own = classes[plain_fingerprint(t)]
        row = (d is None, d or 0, t)
        best[own] = min(best.get(own, row), row)
    kept = [(None if none else d, t) for none, d, t in best.values()]
    clean = [(d, t) for d, t in kept if not next(iter(plain_matches([(d, t)], items, 10)))[2]]
    expected = Counter()
    for d, t in clean:
        own = [*ids(redacted(t)), 2]
        for piece, (start, length) in enumerate(packing.cut(len(own), 1024)):
            crc = zlib.crc32(array("I", own[start : start + length]).tobytes())
            expected[d, piece, start, length, crc] += 1

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    assert 60 < len(expected) < len(rows)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long, _language int, _row int"
    none = spark.createDataFrame([], shape)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, str(tmp_path))
        assert out.count() == 0
        if name != "packing":
            assert out.columns == none.columns


def test_stages_take_any_other_columns(spark, tmp_path):
    names = ("_language", "_score", "_text", "_words", "_hit", "_spans", "print", "row", "c0", "known", "score", "a.b")
    rows = [(i, f"the cat of the house and tree {i}", "en", "s", 9, *range(len(names))) for i in range(6)]
    others = ", ".join(f"`{n}` int" for n in names)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {others}")
    spark.createDataFrame([(1, "no such words here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert {tuple(r[5:]) for r in out.collect()} == {tuple(range(len(names)))}, name


def test_all_are_registered():
    numbers = Counter(name.split("_")[0] for name in contract.queries() if name.startswith("op"))
    assert numbers == {f"op{n}": 1 for n in range(1, 14)}
    assert "pipeline" in contract.queries() and len(corpus_pipeline.STAGES) == 5
    assert set(contract.oracle_sql()) <= set(contract.queries())
