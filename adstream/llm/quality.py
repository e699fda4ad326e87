"""Document quality: a text classifier's evidence, and what its host and path have shown.

A logistic classifier over shares of character classes and repetition gives each document a
probability of being good. Hosts and their paths are then given Beta posteriors from the
probabilities of all their documents: a host's is shrunk toward the global prior, a path's
toward its host's posterior, the more the fewer documents it has. How strongly is learnt from
how far hosts, and paths within hosts, really differ. A document's final odds are its own
evidence times what the other documents of its path say beyond the global prior.

The classifier is fitted on at most about ``TRAIN_ROWS`` labelled rows; every count covers
all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.common import prepare, saved, scratch, text_column

TRAIN_ROWS = 50_000
KEPT_FROM = 0.5
# Bounds of the prior's weight, in documents.
WEIGHT = (1.0, 10_000.0)
CLASSES = (rb"a-z", rb"A-Z", rb"0-9", rb"\x80-\xff", rb" ", rb"\n", rb".,;:'\"?()-", rb"!", rb"|", rb"#$%&*")
TABLES = [
    np.array([bool(re.match(rb"[" + c + rb"]", bytes([b]))) for b in range(256)]) for c in CLASSES
]
CLASS_OF = np.select(TABLES, range(len(CLASSES)), len(CLASSES)).astype(np.uint8)
SEGMENT = 1 << 20
N_FEATURES = 1 + len(CLASSES) + 1 + 5


def features(text: str | None) -> np.ndarray:
    """Shares of character classes, and how words and lines repeat."""
    data = (text or "").encode()
    out = np.zeros(N_FEATURES, np.float32)
    out[0] = 1
    if not data:
        return out
    counts = np.bincount(CLASS_OF[np.frombuffer(data, np.uint8)], minlength=len(CLASSES) + 1)
    out[1 : 2 + len(CLASSES)] = counts / len(data)
    n_words = n_distinct = most = same = 0
    last = b""
    for at in range(0, len(data), SEGMENT):
        words = data[at : at + SEGMENT].split()
        if not words:
            continue
        distinct: dict[bytes, int] = {}
        for word in words:
            distinct[word] = distinct.get(word, 0) + 1
        same += sum(map(bytes.__eq__, words, [last, *words[:-1]]))
        last = words[-1]
        n_words += len(words)
        n_distinct += len(distinct)
        most += max(distinct.values())
    n_words = max(n_words, 1)
    lines = data.split(b"\n")
    out[-5:] = (
        n_distinct / n_words,
        most / n_words,
        same / n_words,
        min(len(data) / n_words, 30) / 10,
        1 - len(set(lines)) / len(lines),
    )
    return out


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights, -20, 20)


def fit(rows: list[tuple[list[float], float]], rounds: int = 25) -> Classifier:
    """Ridge-penalised logistic regression by Newton's method; without rows all odds are 0."""
    x = np.array([r[0] for r in rows], float).reshape(-1, N_FEATURES)
    y = np.array([r[1] for r in rows], float)
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    mean[0], scale[0] = 0, 1
    weights = np.zeros(N_FEATURES)
    z = (x - mean) / scale
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -20, 20)))
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.eye(N_FEATURES)
        weights += np.linalg.solve(curve, z.T @ (y - p) - weights)
    return Classifier(mean, scale, weights, float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5)


def measure(docs: DataFrame, host: F.Column, path: F.Column) -> DataFrame:
    """``doc_id``, ``host``, ``path`` and ``features`` of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch["text"].to_pylist()]
            flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.float32))
            at = pa.array(np.arange(len(found) + 1, dtype=np.int32) * N_FEATURES)
            rest = batch.drop_columns("text")
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.ListArray.from_arrays(at, flat)], [*rest.schema.names, "features"]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(host, F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
        text_column().alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, host string, path string, features array<float>")


def train(measured: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Classifier:
    """Fit on documents with a non-NULL ``quality``; several labels of one are averaged."""
    truth = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.avg("quality").alias("quality"))
    )
    n = truth.count()
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / (1 << 30)
    some = truth.where(spread * n < rows)
    # One row for each id, however often its document is repeated.
    drawn = (
        measured.join(some, "doc_id")
        .groupBy("doc_id")
        .agg(F.min("features").alias("features"), F.min("quality").alias("quality"))
        .toArrow()
    )
    order = np.argsort(drawn["doc_id"].to_numpy(), kind="stable")
    x, y = drawn["features"].to_pylist(), drawn["quality"].to_pylist()
    return fit([(x[i], y[i]) for i in order])


def _weight(mean: F.Column, spread: F.Column, noise: F.Column) -> F.Column:
    """Documents' worth of a Beta prior with this mean whose variance is what remains of the
    spread when the noise of small groups is taken off (method of moments)."""
    between = F.greatest(spread - noise, F.lit(1e-9))
    return F.greatest(F.lit(WEIGHT[0]), F.least(F.lit(WEIGHT[1]), mean * (1 - mean) / between - 1))


def score(measured: DataFrame, classifier: Classifier) -> DataFrame:
    """``doc_id``, ``p_document``, ``p_host``, ``p_path``, ``quality_score``, ``keep``.

    ``p_path`` is the posterior of all documents of the path; the score leaves the row's own out.
    ``measured`` is a stored result of :func:`measure`; each row gives a row.
    """
    spark = measured.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["features"].flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            p = 1 / (1 + np.exp(-classifier.odds(x.astype(float))))
            rest = batch.drop_columns("features")
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(p)], [*rest.schema.names, "p"])

    docs = saved(
        measured.mapInArrow(run, "doc_id long, host string, path string, p double"), scratch(spark, "evidence")
    )
    paths = docs.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good"))
    paths = saved(paths, scratch(spark, "paths"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    hosts = saved(hosts, scratch(spark, "hosts"))
    mean = F.coalesce(F.sum("host_good") / F.sum("host_n"), F.lit(0.5)).alias("mean")
    prior = hosts.agg(mean).first()["mean"]
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    # Groups of one document say nothing about how far groups differ.
    rate, own = F.col("host_good") / F.col("host_n"), F.col("host_n")
    weight = hosts.where("host_n > 1").agg(
        F.coalesce(
            _weight(F.lit(prior), F.avg((rate - prior) ** 2), F.avg(prior * (1 - prior) / own)), F.lit(WEIGHT[1])
        ).alias("w")
    ).first()["w"]
    posterior = hosts.withColumn("p_host", (F.col("host_good") + weight * prior) / (own + weight))
    joined = paths.join(posterior, "host")
    rate, own = F.col("good") / F.col("n"), F.col("n")
    path_weight = joined.where("n > 1").agg(
        F.coalesce(
            _weight(F.lit(prior), F.avg((rate - F.col("p_host")) ** 2), F.avg(prior * (1 - prior) / own)),
            F.lit(WEIGHT[1]),
        ).alias("w")
    ).first()["w"]
    by_path = saved(
        joined.select(
            "host",
            "path",
            "n",
            "good",
            "p_host",
            ((F.col("good") + path_weight * F.col("p_host")) / (own + path_weight)).alias("p_path"),
        ),
        scratch(spark, "posteriors"),
    )
    logit = lambda c: F.log(c / (1 - c))
    inside = lambda c: F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
    # A document's own evidence is not counted again in that of its path.
    others = (F.col("good") - F.col("p") + path_weight * F.col("p_host")) / (F.col("n") - 1 + path_weight)
    odds = logit(inside(F.col("p"))) + logit(inside(others)) - F.lit(float(np.log(prior / (1 - prior))))
    return (
        docs.join(by_path, ["host", "path"])
        .withColumn("quality_score", 1 / (1 + F.exp(-odds)))
        .select(
            "doc_id",
            F.col("p").alias("p_document"),
            "p_host",
            "p_path",
            "quality_score",
            (F.col("quality_score") >= KEPT_FROM).alias("keep"),
        )
    )


def classify(
    docs: DataFrame, labels: DataFrame, host: F.Column, path: F.Column, train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """Quality of every row of ``docs``.

    NULL hosts and paths form one of their own, NULL texts are empty. Without usable labels
    every document's own evidence is even. Repeated rows keep their rows.
    """
    measured = saved(measure(docs, host, path), scratch(docs.sparkSession, "measured"))
    return score(measured, train(measured, labels, train_rows))
