"""Language identification: known words by frequency, unseen words by shorter and shorter parts.

A word is scored by its log frequency in each language. One that the model does not know is
scored by those of its character n-grams that it knows, of the greatest length at which it
knows any. The scores of a text's words add up to the log likelihood of each language.

Words and n-grams rarer than ``RARE`` in every language are left to the shorter n-grams, so a
language has at most ``1 / RARE`` words and as many n-grams of each length, whatever the
corpus: that bounds what is broadcast. The model is fitted on at most about
``DOCS_PER_LANGUAGE`` labelled documents of each language; predictions cover all of them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.common import prepare, saved, scratch, with_plain_names

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 5_000
RARE = 1e-5
LONGEST = 4
# Pseudo-count of a word or n-gram in a language that lacks it.
ALPHA = 0.5
# Unseen words whose scores a worker remembers, and at most so many numbers for them.
REMEMBERED = 500_000
NUMBERS = 1 << 23
SEGMENT = 1 << 20
WORD = re.compile(r"[^\W\d_]+")
_ADDED = ("lang", "score", "known")


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-case runs of letters, a bounded segment at a time."""
    start = 0
    while len(text) - start > SEGMENT:
        end = start + SEGMENT
        while end < len(text) and text[end].isalpha():
            end += 1
        yield WORD.findall(text[start:end].lower())
        start = end
    yield WORD.findall(text[start:].lower())


def parts(word: str, n: int) -> list[str]:
    """Character n-grams of a word between marks for its ends."""
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Log frequencies by language; ``tables[n]`` for n-grams, ``tables[0]`` for words."""

    languages: list[str]
    tables: list[dict[str, np.ndarray]]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            for words in words_of(text):
                for word, n in Counter(words).items():
                    counts[lang, word] += n
        yield _rows(counts)


def _rows(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.string()),
            pa.array(list(counts.values()), pa.int64()),
        ],
        ["lang", "item", "n"],
    )


def _count_parts(n: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for lang, word, times in zip(*(batch[c].to_pylist() for c in ("lang", "item", "n")), strict=True):
                for part in parts(word, n):
                    counts[lang, part] += times
            yield _rows(counts)

    return count


def fit(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, rare: float = RARE) -> Model:
    """Learn from ``text`` and ``lang``; rows where either is NULL teach nothing.

    ``doc_id`` only spreads the sample. Languages are those of the rows; with no rows the
    model knows none and every prediction is ``und``.
    """
    spark = prepare(labelled.sparkSession)
    rows = labelled.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    per_language = rows.groupBy("lang").agg(F.count("*").alias("rows_of_lang"))
    spread = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1 << 30)) / (1 << 30)
    sample = rows.join(F.broadcast(per_language), "lang").where(
        spread * F.col("rows_of_lang") < docs_per_language
    )
    summed = lambda df: df.groupBy("lang", "item").agg(F.sum("n").alias("n"))
    shape = "lang string, item string, n long"
    words = saved(
        summed(sample.select("lang", "text").mapInArrow(_count_words, shape)), scratch(spark, "langid-words")
    )
    languages = [r["lang"] for r in words.select("lang").distinct().orderBy("lang").collect()]
    tables = [_table(words, languages, rare)]
    for n in range(1, LONGEST + 1):
        tables.append(_table(summed(words.mapInArrow(_count_parts(n), shape)), languages, rare))
    return Model(languages, tables)


def _table(counts: DataFrame, languages: list[str], rare: float) -> dict[str, np.ndarray]:
    counts = saved(counts, scratch(counts.sparkSession, "langid-counts"))
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    if not totals:
        return {}
    total_of = F.create_map(*[F.lit(x) for pair in totals.items() for x in pair])
    frequent = counts.where(F.col("n") >= rare * total_of[F.col("lang")]).select("item").distinct()
    number = {lang: i for i, lang in enumerate(languages)}
    found: dict[str, np.ndarray] = {}
    for item, lang, n in counts.join(frequent, "item").select("item", "lang", "n").toLocalIterator():
        found.setdefault(item, np.zeros(len(languages), np.float32))[number[lang]] = n
    smoothed = np.log([totals.get(lang, 0) + ALPHA * (len(found) + 1) for lang in languages])
    return {item: (np.log(row + ALPHA) - smoothed).astype(np.float32) for item, row in found.items()}


class Scorer(dict):
    """Row numbers of words in a matrix of scores; unseen words are added, up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        known = model.tables[0] if model.tables else {}
        self.n_known = len(known)
        super().__init__({w: i for i, w in enumerate(known)})
        width = max(len(model.languages), 1)
        room = max(50_000, min(REMEMBERED, NUMBERS // width))
        self.rows = np.zeros((self.n_known + room, width), np.float32)
        if known:
            self.rows[: self.n_known] = np.stack(list(known.values()))

    def __missing__(self, word: str) -> int:
        row = len(self)
        self.rows[row] = self.back_off(word)
        self[word] = row
        return row

    def back_off(self, word: str) -> np.ndarray:
        for n in range(LONGEST, 0, -1):
            known = self.model.tables[n]
            found = [known[p] for p in parts(word, n) if p in known]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(self.rows.shape[1], np.float32)

    def forget(self) -> None:
        """Drop the unseen words where a text's new ones might not fit any more."""
        for word in list(self)[self.n_known :]:
            del self[word]

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, its probability, and the share of the words that the model knows."""
        total, letters, n, known = np.zeros(self.rows.shape[1]), False, 0, 0
        for words in words_of(text or ""):
            letters = letters or any(c.isalpha() for w in words for c in w)
            for at in range(0, len(words), 50_000):
                some = words[at : at + 50_000]
                if len(self) + len(some) > len(self.rows):
                    self.forget()
                rows = np.fromiter(map(self.__getitem__, some), np.int64, len(some))
                n, known = n + len(some), known + int((rows < self.n_known).sum())
                total += self.rows[rows].sum(axis=0, dtype=np.float64)
        if not letters or not self.model.languages:
            return UNKNOWN, 0.0, 0.0
        odds = np.exp(total - total.max())
        best = int(np.argmax(odds))
        return self.model.languages[best], float(odds[best] / odds.sum()), known / n


def identify(
    docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score", known: str | None = None
) -> DataFrame:
    """``docs`` with the predicted language and its probability as the last columns.

    ``known`` names a further column, the share of a text's words that the model knows. Columns of
    ``docs`` with these names are replaced. Only ``text`` is read. Without a letter, or with NULL
    text, the language is ``und`` and the numbers are 0; of languages that tie the first by name
    is taken.
    """
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    added = [lang, score, *([known] if known else [])]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    plain = with_plain_names(docs, "text")
    columns = plain.columns

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            found = [scorer.predict(text) for text in batch["text"].to_pylist()]
            kinds = (pa.string(), pa.float64(), pa.float64())
            new = [pa.array([x[i] for x in found], kinds[i]) for i in range(len(added))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*columns, *_ADDED[: len(added)]])

    values = (F.lit("").alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("known"))
    shape = plain.select(*columns, *values[: len(added)]).schema
    return plain.mapInArrow(predict, shape).toDF(*docs.columns, *added)
