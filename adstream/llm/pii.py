"""Personal data in texts, with labelers that vote and a classifier learnt from their votes.

Four kinds have fixed patterns and checks; their spans are always kept. Wider patterns propose
further spans. On every proposed span a pattern, a gazetteer and a context labeler vote for,
against or not at all. Expectation-maximisation over the counts of equal votes estimates how
reliable each labeler is and how likely each combination is right; a logistic classifier over
the votes and the span's shape is fitted to those probabilities and decides which spans join
the fixed ones. Votes and shapes are few-valued, so both work on tables of bounded size that
cover every span of the corpus.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adstream.llm.common import prepare, saved, scratch, text_column, with_plain_names

Span = tuple[int, int]
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

# The four kinds. Possessive quantifiers and the look-behinds change no match,
# they only keep long runs from being tried again from each of their characters.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
LETTERS = re.compile(r"[A-Za-z]")

# Wider patterns, for proposed spans.
WIDER = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)* ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]+(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]+)+"),
    "card": re.compile(r"(?<![0-9+(])(?<![0-9][\x20.-])[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![\x20.-]?[0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?<![0-9][\x20.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\x20.-]?[0-9])"),
    # Keys of listed services hold hyphens, signed tokens points, padded base 64 plus signs and slashes.
    "secret": re.compile(r"(?<![A-Za-z0-9_])(?:(?<!-)(?:sk|pk|rk|xox[abprs])-[A-Za-z0-9_-]{16,}+|(?<!-)eyJ[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++)+|(?<![+/])[A-Za-z0-9+/]{24,}+={1,2}|[A-Za-z0-9_]{20,}+)(?![A-Za-z0-9_])"),
}
STRICT = {
    "email": re.compile(r".*(?:\.|dot[\])]) ?[A-Za-z]{2,}"),
    "card": re.compile(r"[0-9]{15}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}"),
    "phone": re.compile(r"\([0-9]{3}\)[\x20.-]?.*|[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}"),
    "secret": re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9]).{24,}"),
}
# Beginnings and endings that speak for a kind, words that announce it.
GAZETTEER = {
    "email": re.compile(r".*(?:com|org|net|edu|gov|info|io|de|fr|es|uk)"),
    "card": re.compile(r"3[47].*"),
    "phone": re.compile(r"\(?[2-9][0-9]{2}.*"),
    "secret": re.compile(r"(?:sk|pk|rk|ghp|gho|xox[abprs]|AKIA|ASIA|AIza|eyJ).*|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}"),
}
CUES = {
    "email": ("email", "mail", "contact", "write", "address"),
    "card": ("card", "visa", "amex", "credit", "debit", "payment", "pay"),
    "phone": ("phone", "tel", "telephone", "call", "fax", "mobile", "cell"),
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "apikey", "bearer", "auth"),
}
CUE_CHARACTERS = 40
CUE_WORD = re.compile(r"[a-z]+")
FEATURES = ("kind", "pattern", "gazetteer", "context", "length", "digits", "variety")
# Spans with at least this probability are kept.
KEPT_FROM = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = int(c) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, free = [], 0
    for m in DOMAIN.finditer(text):
        # An address goes back over the local part, not into the match before it.
        start = at = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            found.append((start, m.end()))
            free = m.end()
    return found


def _part(part: str) -> bool:
    small = part.lstrip("0")
    return len(small) < 3 or len(small) == 3 and int(small) <= 255


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of the four fixed kinds: leftmost, not overlapping within a kind, in code points."""
    emails = _emails(text) if "@" in text else []
    if not DIGITS.search(text):
        return {"email": emails, "ip": [], "card": [], "phone": []}
    ips = [m.span() for m in IP.finditer(text) if all(map(_part, m.group().split(".")))]
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = [
        m.span() for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15
    ]
    return {"email": emails, "ip": ips, "card": cards, "phone": phones}


def _vote(kind: str, span: str, before: str) -> tuple[int, int, int]:
    pattern = 1 if STRICT[kind].fullmatch(span) else -1
    if kind == "card" and not luhn(re.sub("[^0-9]", "", span)):
        pattern = -1
    listed = 1 if GAZETTEER[kind].fullmatch(span) else -1
    words = CUE_WORD.findall(before.lower())[-3:]
    return pattern, listed, 1 if any(w in CUES[kind] for w in words) else 0


def proposed(text: str, base: dict[str, list[Span]]) -> list[tuple[int, int, tuple[int, ...]]]:
    """Further spans with their votes and shape; none overlaps a fixed one or another."""
    # Disjoint intervals in order: where a span ends, the last that begins before is the only one to meet.
    taken: list[Span] = []
    for a, b in sorted(s for spans in base.values() for s in spans):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    found = []
    digits = bool(DIGITS.search(text))
    for kind, pattern in WIDER.items():
        if kind == "email":
            if "at]" not in text and "at)" not in text:
                continue
        elif not digits:
            continue
        for m in pattern.finditer(text):
            span = m.group()
            if kind == "card" and not luhn(re.sub("[^0-9]", "", span)):
                continue
            if kind == "secret" and not (DIGITS.search(span) and LETTERS.search(span)):
                continue
            at = bisect_left(taken, (m.end(), 0))
            if at and taken[at - 1][1] > m.start():
                continue
            taken.insert(at, m.span())
            before = text[max(0, m.start() - CUE_CHARACTERS) : m.start()]
            share = sum(c.isdigit() for c in span) / len(span)
            shape = (min(3, int(math.log2(len(span))) - 3), int(share * 3.99), min(3, len(set(span)) // 8))
            found.append((m.start(), m.end(), (KINDS.index(kind), *_vote(kind, span, before), *shape)))
    return found


@dataclass
class Model:
    """What expectation-maximisation and the classifier have learnt."""

    reliability: dict[str, dict[int, tuple[float, float]]]  # labeler, vote: P(vote | wrong, right)
    weights: np.ndarray
    known: dict[tuple[int, ...], bool] = field(default_factory=dict)

    def keeps(self, features: tuple[int, ...]) -> bool:
        """Whether spans with these votes and this shape are personal data."""
        if features not in self.known:
            self.known[features] = self.probability(features) >= KEPT_FROM
        return self.known[features]

    def probability(self, features: tuple[int, ...]) -> float:
        return float(1 / (1 + np.exp(-np.clip(_design([features]) @ self.weights, -30, 30)))[0])


def _design(rows: list[tuple[int, ...]]) -> np.ndarray:
    x = np.zeros((len(rows), 1 + len(KINDS) + 6))
    for i, (kind, *rest) in enumerate(rows):
        x[i, 0] = x[i, 1 + kind] = 1
        x[i, 1 + len(KINDS) :] = rest
    return x


def estimate(counts: dict[tuple[int, ...], int], rounds: int = 50) -> Model:
    """Fit to the number of spans with each combination of features.

    Labelers are taken to err independently. The start is a majority of votes, so that
    the estimate cannot settle with right and wrong exchanged.
    """
    rows = sorted(counts)
    n = np.array([counts[r] for r in rows], float)
    votes = np.array([r[1:4] for r in rows], int).reshape(-1, 3)
    right = 1 / (1 + np.exp(-1.5 * votes.sum(axis=1)))
    likelihood = np.full((3, 3, 2), 1 / 3)
    for _ in range(rounds if rows else 0):
        prior = (n * right).sum() + 1, (n * (1 - right)).sum() + 1
        for k in range(3):
            for v in (-1, 0, 1):
                at = votes[:, k] == v
                # Smoothing holds the belief that a labeler is right more often than not.
                likelihood[k, v + 1] = (
                    ((n * (1 - right))[at].sum() + (2, 1, 1)[v + 1]) / (prior[1] + 3),
                    ((n * right)[at].sum() + (1, 1, 2)[v + 1]) / (prior[0] + 3),
                )
        odds = math.log(prior[0] / prior[1]) + sum(
            np.log(likelihood[k, votes[:, k] + 1, 1] / likelihood[k, votes[:, k] + 1, 0]) for k in range(3)
        )
        right = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    x = _design(rows)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds if rows else 0):  # Newton steps on the ridge-penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (right - p)) - 0.1 * weights
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(weights))
        weights += np.linalg.solve(curve, slope)
    names = FEATURES[1:4]
    return Model({names[k]: {v: tuple(likelihood[k, v + 1]) for v in (-1, 0, 1)} for k in range(3)}, weights)


def spans_text(base: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, spans in base.items() for a, b in spans)


def extract(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts and ``base`` (fixed spans as text), and the proposed spans of each row."""
    prepare(docs.sparkSession)
    found_kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("features", pa.list_(pa.int32()))]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bases = [base_spans(t) for t in batch["text"].to_pylist()]
            more = [
                [{"start": a, "end": b, "features": f} for a, b, f in proposed(t, base)]
                for t, base in zip(batch["text"].to_pylist(), bases, strict=True)
            ]
            counts = [pa.array([len(b[kind]) for b in bases], pa.int64()) for kind in BASE_KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *counts, pa.array(map(spans_text, bases), pa.string()), pa.array(more, found_kind)],
                ["doc_id", *(f"n_{kind}" for kind in BASE_KINDS), "base", "proposed"],
            )

    shape = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, proposed array<struct<start:int,end:int,features:array<int>>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text")).mapInArrow(find, shape)


def fit(found: DataFrame) -> Model:
    """Count the combinations over all of ``found`` (a stored result of :func:`extract`)."""
    rows = found.select(F.explode("proposed").alias("p")).groupBy("p.features").agg(F.count("*").alias("n"))
    return estimate({tuple(r["features"]): r["n"] for r in rows.collect()})


def detect(docs: DataFrame) -> tuple[DataFrame, Model]:
    """Per row of ``docs``: ``doc_id``, the counts, ``base_sha256`` and ``spans``; and the model.

    ``base_sha256`` is the SHA-256 of the fixed spans, ``kind:start:end`` by kind and start,
    joined by commas; ``spans`` joins all spans likewise. NULL is the empty text. An empty
    table gives no rows; other columns are ignored; repeated rows keep their rows.
    """
    found = saved(extract(docs), scratch(docs.sparkSession, "pii"))
    model = fit(found)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, spans = [], []
            for base, more in zip(batch["base"].to_pylist(), batch["proposed"].to_pylist(), strict=True):
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                whole = [(KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
                whole += [
                    (p["features"][0], p["start"], p["end"])
                    for p in more
                    if model.keeps(tuple(p["features"]))
                ]
                spans.append(",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(whole)))
            rest = batch.drop_columns(["base", "proposed"])
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                [*rest.schema.names, "base_sha256", "spans"],
            )

    shape = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return found.mapInArrow(decide, shape), model


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every kept span of ``text`` replaced by its kind in brackets.

    Of spans that overlap the first is replaced, and of those the longest; what it leaves of
    another is replaced with it. A NULL text stays NULL; all rows and columns stay.
    """
    prepare(docs.sparkSession)

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        base = base_spans(text)
        spans = [(a, b, kind) for kind, found in base.items() for a, b in found]
        spans += [
            (a, b, KINDS[f[0]]) for a, b, f in proposed(text, base) if model.keeps(f)
        ]
        if not spans:
            return text
        out, at = [], 0
        for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
            if b <= at:
                continue
            if a >= at:
                out += [text[at:a], f"[{kind.upper()}]"]
            at = b
        return "".join([*out, text[at:]])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            kind = batch.schema.field(at).type
            yield batch.set_column(at, "text", pa.array([clean(t) for t in batch["text"].to_pylist()], kind))

    plain = with_plain_names(docs, "text")
    return plain.mapInArrow(apply, plain.schema).toDF(*docs.columns)
