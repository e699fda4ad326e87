"""Spelling variants: words one edit apart, found by blocked products of letter counts.

The squared distance of two words' letter counts is 0 to 2 if one edit leads from one to the
other: 2 for a replaced letter, 1 for an inserted or deleted one. So words are dealt into
blocks, a product of two blocks' count matrices gives all those distances at once, and only
pairs at most 2 apart are compared letter by letter.

Letters are divided into a few classes. One edit changes the number of a word's letters in one
class by one, or moves one from a class to another, so a block meets only blocks of such class
counts: of the same length or the adjacent one. That leaves out no pair. The number of classes
grows with the vocabulary, so that the pairs of a word grow much slower than the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.common import prepare, saved, scratch, text_column

# Fixed values of the contract.
RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
DAMAGED_EVERY = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
FIRST, LAST = 0x41, 0xFF  # code points of a run
NEAR = 2
# Words of a block, and their letters.
BLOCK = 2048
LETTERS = 1 << 16
SEGMENT = 1 << 20
# Pairs whose letters are compared at once, times their length.
VERIFIED = 1 << 22
_BLOCK_COLUMNS = ("words", "ns")


def _runs(text: str) -> Iterator[list[str]]:
    """The runs of a text with lower-case A-Z, a segment at a time."""
    text = text.encode().lower().decode()
    start = 0
    while len(text) - start > SEGMENT:
        end = start + SEGMENT
        while end < len(text) and RUN.match(text[end]):
            end += 1
        yield RUN.findall(text, start, end)
        start = end
    yield RUN.findall(text, start)


def _count(damaged_every: int | None, least_letters: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                before = zlib.crc32(f"{doc_id}:".encode())
                for runs in _runs(text):
                    for run, n in Counter(runs).items():
                        if damaged_every:
                            h = zlib.crc32(run.encode(), before)
                            if h % damaged_every == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                        if len(run) >= least_letters:
                            counts[run] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

    return count


def count_words(
    docs: DataFrame,
    damaged_every: int | None = DAMAGED_EVERY,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word``, ``n``: the distinct words of ``text`` over all of ``docs``, and how often each occurs.

    A run of letters whose hash with its ``doc_id`` is a multiple of ``damaged_every`` loses the
    letter that the hash names; None leaves runs as they are. A NULL text has no runs, a NULL
    ``doc_id`` hashes as the empty text. Repeated rows count each. Other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_column().alias("text")
    )
    found = rows.mapInArrow(_count(damaged_every, least_letters), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for word in batch["word"].to_pylist():
            counts.update(word)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["letter", "n"]
        )


def letter_classes(words: DataFrame, n_classes: int) -> list[str]:
    """The letters of the vocabulary in classes of about the same use; at most 190 letters exist."""
    found = words.select("word").mapInArrow(_letters, "letter string, n long")
    used = found.groupBy("letter").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "letter").collect()
    classes, load = [""] * n_classes, [0] * n_classes
    for letter, n in used:
        least = load.index(min(load))
        classes[least] += letter
        load[least] += n
    return [c for c in classes if c]


def _offsets(n_classes: int) -> list[list[int]]:
    """By how much class counts change in one edit; of an edit and its reverse only one."""
    offsets = [[0] * n_classes]
    for i in range(n_classes):
        inserted = [0] * n_classes
        inserted[i] = 1
        offsets.append(inserted)
        for j in range(i + 1, n_classes):
            moved = [0] * n_classes
            moved[i], moved[j] = 1, -1
            offsets.append(moved)
    return offsets


def classes_for(n_words: int) -> int:
    """One class more for each doubling of the vocabulary."""
    return max(4, n_words.bit_length() - 15)


def _key(counts: Column) -> Column:
    return F.array_join(F.transform(counts, lambda c: c.cast("string")), ",")


def block_pairs(words: DataFrame, block: int = BLOCK, n_classes: int | None = None) -> DataFrame:
    """Rows of two blocks, ``a_words``, ``a_ns``, ``b_words``, ``b_ns``, that together hold every
    pair of words one edit apart once. The words of a block are sorted; a pair of a block with
    itself is marked by ``same``.

    ``words`` is read several times: give a stored table.
    """
    spark = words.sparkSession
    classes = letter_classes(words, n_classes or classes_for(words.count()))
    if not classes:
        classes = ["a"]
    outside = [F.translate("word", letters, "") for letters in classes]
    counts = F.array(*[F.length("word") - F.length(rest) for rest in outside])
    rows = words.select("word", "n", counts.alias("counts"), F.length("word").alias("letters"))
    sizes = rows.groupBy("counts").agg(F.count("*").alias("n"), F.sum("letters").alias("letters"))
    # Blocks are bounded in words and in letters; a large class is dealt into several.
    parts = F.ceil(F.greatest(F.col("n") / block, F.col("letters") / LETTERS)).cast("int")
    keys = saved(sizes.select("counts", _key(F.col("counts")).alias("key"), parts.alias("parts")), scratch(spark, "keys"))
    dealt = rows.withColumn("key", _key(F.col("counts"))).join(keys.select("key", "parts"), "key")
    part = F.pmod(F.xxhash64("word"), F.col("parts").cast("long")).cast("int").alias("part")
    members = F.array_sort(F.collect_list(F.struct("word", "n")))
    blocks = saved(
        dealt.select("key", part, "word", "n")
        .groupBy("key", "part")
        .agg(members.alias("members"))
        .select("key", "part", F.col("members.word").alias("words"), F.col("members.n").alias("ns")),
        scratch(spark, "blocks"),
    )
    offsets = F.array(*[F.array(*map(F.lit, o)) for o in _offsets(len(classes))])
    partner = F.transform(offsets, lambda o: _key(F.zip_with("counts", o, lambda c, d: c + d)))
    sides = keys.select(F.col("key").alias("a"), F.col("parts").alias("a_parts"), F.explode(partner).alias("b"))
    met = sides.join(keys.select(F.col("key").alias("b"), F.col("parts").alias("b_parts")), "b")
    met = met.select("*", F.explode(F.expr("sequence(0, a_parts - 1)")).alias("a_part"))
    met = met.select("a", "b", "a_part", F.explode(F.expr("sequence(0, b_parts - 1)")).alias("b_part"))
    met = met.where("a <> b OR a_part <= b_part").withColumn("same", F.expr("a = b AND a_part = b_part"))
    # Merged by sorting, so that the pairs are spread over tasks however small the blocks are.
    for side in "ab":
        own = blocks.select(
            F.col("key").alias(side),
            F.col("part").alias(f"{side}_part"),
            *[F.col(c).alias(f"{side}_{c}") for c in _BLOCK_COLUMNS],
        )
        met = met.join(own.hint("merge"), [side, f"{side}_part"])
    return met.select("same", *[f"{side}_{c}" for side in "ab" for c in _BLOCK_COLUMNS])


class Block:
    """Words of one length as code points and letter counts."""

    def __init__(self, words: list[str]):
        self.words, self.length = words, len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        self.points = points.astype(np.uint16)
        width = LAST - FIRST + 1
        place = self.points.astype(np.int64) - FIRST + np.arange(len(words))[:, None] * width
        self.counts = np.bincount(place.ravel(), minlength=len(words) * width).reshape(-1, width)


def close_counts(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words whose letter counts are at most a squared distance of 2 apart."""
    used = np.flatnonzero(a.counts.any(axis=0) | b.counts.any(axis=0))
    # Sums stay exact: products of counts below 2 ** 24 in single precision, else in double.
    exact = np.float32 if max(a.length, b.length) < 2048 else np.float64
    x, y = a.counts[:, used].astype(exact), b.counts[:, used].astype(exact)
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    # 2xy - xx - yy + NEAR in one product.
    left = np.hstack([2 * x, NEAR - xx[:, None], np.ones((len(x), 1), exact)])
    right = np.hstack([y, np.ones((len(y), 1), exact), -yy[:, None]])
    close = np.flatnonzero((left @ right.T).ravel() > -0.5)
    return close // len(y), close % len(y)


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether exactly one edit leads from a row of ``short`` to that of ``long``, as code points."""
    n = short.shape[1]
    if n == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    unlike = short != long[:, :n]
    before = np.where(unlike.any(axis=1), unlike.argmax(axis=1), n)
    unlike = (short != long[:, 1:])[:, ::-1]
    after = np.where(unlike.any(axis=1), unlike.argmax(axis=1), n)
    return before + after >= n


def near_pairs(a: Block, b: Block, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart; in a block with itself the smaller index first."""
    i, j = close_counts(a, b)
    if same:
        i, j = i[i < j], j[i < j]
    # Of adjacent lengths ``b`` has the longer words, as classes gain a letter from a to b.
    step = max(1, VERIFIED // b.length)
    kept = [one_edit(a.points[i[k : k + step]], b.points[j[k : k + step]]) for k in range(0, len(i), step)]
    if not kept:
        return i, j
    right = np.concatenate(kept)
    return i[right], j[right]


def _best(own: np.ndarray, other: np.ndarray, ns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each own word: how many others it met and the most frequent, the first of those that tie."""
    order = np.lexsort((other, -ns[other], own))
    own, other = own[order], other[order]
    words, first, met = np.unique(own, return_index=True, return_counts=True)
    return words, other[first], met


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word, met, best, best_n = [], [], [], []
        columns = [batch[c] for c in ("same", "a_words", "a_ns", "b_words", "b_ns")]
        for row in range(batch.num_rows):
            same, a_words, a_ns, b_words, b_ns = (c[row] for c in columns)
            a, b = (Block(w.as_py()) for w in (a_words, b_words))
            a_ns, b_ns = (n.values.to_numpy(zero_copy_only=False) for n in (a_ns, b_ns))
            i, j = near_pairs(a, b, same.as_py())
            if not len(i):
                continue
            for own, own_at, other, other_at, ns in ((a, i, b, j, b_ns), (b, j, a, i, a_ns)):
                for w, o, n in zip(*(x.tolist() for x in _best(own_at, other_at, ns)), strict=True):
                    word.append(own.words[w])
                    met.append(n)
                    best.append(other.words[o])
                    best_n.append(int(ns[o]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(word, pa.string()), pa.array(met, pa.int64()), pa.array(best, pa.string()), pa.array(best_n, pa.int64())],
            ["word", "met", "best", "best_n"],
        )


def near_words(words: DataFrame, block: int = BLOCK, n_classes: int | None = None) -> DataFrame:
    """``word``, ``n_near`` and the near word of largest count, ``best`` and ``best_n``.

    Words without a near word are left out. Of near words that tie in their count the smallest
    in code-point order is taken.
    """
    pairs = block_pairs(words, block, n_classes)
    found = pairs.mapInArrow(_compare, "word string, met long, best string, best_n long")
    least = F.min(F.struct(-F.col("best_n"), F.col("best")))
    return found.groupBy("word").agg(F.sum("met").alias("n_near"), least.alias("least")).select(
        "word", "n_near", F.col("least.best").alias("best"), (-F.col("least.col1")).alias("best_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of every word with a ``form``: forms followed to the last.

    Each round doubles the steps taken. Counts at least double with each form, so paths have no
    circles and a few rounds end them.
    """
    spark = forms.sparkSession
    at = saved(forms.select("word", F.col("form").alias("root")), scratch(spark, "roots"))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = saved(at.join(onward, "root", "left"), scratch(spark, "roots"))
        if moved.where("next IS NOT NULL").isEmpty():
            return at
        at = moved.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(
    docs: DataFrame,
    damaged_every: int | None = DAMAGED_EVERY,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    factor: int = FORM_FACTOR,
    block: int = BLOCK,
    n_classes: int | None = None,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of ``docs``.

    The form is the near word of largest count if it occurs at least ``factor`` (2 or more) times
    as often; the root is the last of the forms, or the word itself. Words are as
    :func:`count_words` finds them; without any the result is empty.
    """
    if factor < 2:
        raise ValueError("a form has to occur at least twice as often")
    spark = prepare(docs.sparkSession)
    words = saved(count_words(docs, damaged_every, least_letters, least_count), scratch(spark, "words"))
    near = near_words(words, block, n_classes)
    taken = F.col("best_n") >= F.col("n") * factor
    rows = saved(
        words.join(near, "word", "left").select(
            "word",
            F.when(taken, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(taken, F.col("best_n")).alias("form_n"),
        ),
        scratch(spark, "forms"),
    )
    found = roots(rows.where("form IS NOT NULL"))
    return rows.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
