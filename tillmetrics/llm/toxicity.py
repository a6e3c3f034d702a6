"""Toxic passages by maximal scoring segments of token log-odds, with extreme-value statistics.

A word counts by its first few letters at several lengths, ``LEVELS``, and as a whole. Of each
such stem the share of toxic ones among the labelled documents that hold it is
estimated under a Dirichlet prior: ``PRIOR`` documents split as those of the next shorter stem
are, the shortest ones' as all labelled documents are. A word's score is the log-odds of
its longest known stem against those of all documents, less ``DRIFT``, so that
ordinary text scores below zero.

One pass over a text's scores, after Ruzzo and Tompa, finds all its maximal segments: those
whose score no shorter or longer neighbour improves. The best of n words of clean text follow an
extreme-value law, so a segment of score s is expected ``K n exp(-lambda s)`` times by chance.
Lambda solves ``E exp(lambda s) = 1`` over the words of clean texts, K is set by the upper
tenth of clean texts. Segments expected at most ``ALPHA`` times are the toxic passages; a
document's evidence is the best sum of its best passages under the law of such sums. A
logistic curve over the evidence gives the score. Both are fitted to documents whose
words were not counted.

Learning takes at most ``LABELLED`` labelled documents per class, those least by a hash of their
id, whose ids are sent to all tasks; the lexicon holds at most ``LEXICON`` stems of
two documents or more, those that depart most from the common share. Scoring reads each
text once, whole, in place.

Defined results: a null text is an empty one, and has the evidence of no segment. A null
label is none; of several labels of a document the largest holds; labelled rows of a null id,
and labels without a document, are not learned from. Repeated rows count each. With no document
of one class everything scores by the standard curve, and below one half. Only the named
columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = (4, 7, 16)  # letters of a stem
PRIOR = 3.0  # labelled documents
DRIFT = 1.0
ALPHA = 0.05
LABELLED = 30_000  # per class
LEXICON = 200_000
CALIBRATION = 5  # one labelled document in so many calibrates, the rest are counted
STEMS_AT_ONCE = 200_000  # counted in a task before they go to Spark
WORDS_KEPT = 300_000  # of known score in a task, before its table starts anew
BINS = np.arange(-12.0, 20.0, 0.125)  # of word scores, for lambda
THRESHOLD = 0.5

WORD = re.compile(r"[^\W\d_]+")
PASSAGES = "array<struct<first_word:int,last_word:int,start:int,end:int,score:double,expected:double>>"

STEM_COUNTS = pa.schema([("stem", pa.string()), ("n", pa.int64()), ("toxic", pa.int64())])
MEASURES = pa.schema(
    [("toxic", pa.int32()), ("n", pa.int64()), ("segments", pa.list_(pa.float64())), ("bins", pa.list_(pa.int64()))]
)


def stems(word: str) -> list[str]:
    """A lower-case word's stems, short to long; the last one ends in ``$`` if it is the whole word."""
    out = []
    for n in LEVELS:
        if len(word) <= n:
            out.append(word + "$")
            break
        out.append(word[:n])
    return out


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal segments (score, first, last), from left to right, in linear time."""
    ends = np.cumsum(scores)
    found: list[list] = []  # sum before it, sum at its end, first, last, and the nearest with less before it
    for i in np.flatnonzero(scores > 0).tolist():
        after = float(ends[i])
        before, first = after - float(scores[i]), i
        near = len(found) - 1
        while near >= 0:
            while near >= 0 and found[near][0] >= before:
                near = found[near][4]
            if near < 0 or found[near][1] >= after:
                break
            at = near
            before, _, first, _, near = found[at]
            del found[at:]
        found.append([before, after, first, i, near])
    return [(after - before, first, last) for before, after, first, last, _ in found]


def lambda_of(counts: np.ndarray, middles: np.ndarray) -> float:
    """The positive root of E exp(lambda s) = 1; 1 where scores have no such root."""
    if not counts.sum():
        return 1.0
    p = counts / counts.sum()
    used = p > 0
    p, s = p[used], middles[used]
    if s.max() <= 0 or (p * s).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(high * s)).sum() < 1:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(middle * s)).sum() < 1 else (low, middle)
    return high


@dataclass
class Law:
    """The extreme-value law of clean text, and the curve from evidence to score."""

    rate: float = 1.0  # lambda
    log_k: float = 0.0
    offset: float = math.log(ALPHA)
    slope: float = 1.0

    def surprise(self, score: float, n: int) -> float:
        """Minus the logarithm of how often such a segment is expected in ``n`` clean words."""
        return self.rate * score - self.log_k - math.log(max(n, 1))

    def evidence(self, scores: list[float], n: int) -> float:
        """Of the best segment, or of the best few together where their sum says more."""
        ordered = sorted((self.surprise(s, n) for s in scores), reverse=True)
        best = ordered[0] if ordered else self.surprise(0.0, n)
        total = 0.0
        for r, x in enumerate(ordered, 1):
            if x < -math.log(ALPHA):
                break
            total += x
            chance = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
            best = max(best, -chance - (r - 1) * math.log(2))  # for having looked at several r
        return best

    def score(self, evidence: float) -> float:
        x = self.offset + self.slope * evidence
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


@dataclass
class Model:
    """Stems with their toxic share, the share of all labelled documents, and the law."""

    lexicon: dict[str, float]
    share: float
    law: Law

    def __post_init__(self) -> None:
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def word_score(self, word: str) -> float:
        share = self.share
        for stem in stems(word.lower()):
            share = self.lexicon.get(stem, share)
        return _logit(share) - _logit(self.share) - DRIFT

    def scores(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = self.word_score(w)
        return np.fromiter((known[w] for w in words), np.float64, len(words))

    def judged(self, text: str | None) -> tuple[float, list[tuple]]:
        """The score of a text and its passages."""
        words = WORD.findall(text or "")
        found = segments(self.scores(words))
        score = self.law.score(self.law.evidence([s for s, _, _ in found], len(words)))
        limit = -math.log(ALPHA)
        toxic = [x for x in found if self.law.surprise(x[0], len(words)) >= limit]
        if not toxic:
            return score, []
        places = [m.span() for m in WORD.finditer(text)]
        return score, [
            (a, b, places[a][0], places[b][1], s, math.exp(-self.law.surprise(s, len(words)))) for s, a, b in toxic
        ]


def _logit(share: float) -> float:
    return math.log(share / (1 - share))


def lexicon(counts: dict[str, tuple[int, int]], share: float) -> dict[str, float]:
    """Shares of stems with their (documents, toxic documents), each under its shorter stem's prior."""
    out: dict[str, float] = {}
    for stem in sorted(counts, key=len):  # a shorter stem is ready before those it is the prior of
        prior = share
        for shorter in stems(stem.rstrip("$")):
            if shorter != stem and len(shorter) < len(stem):
                prior = out.get(shorter, prior)
        n, toxic = counts[stem]
        out[stem] = (toxic + PRIOR * prior) / (n + PRIOR)
    return out


def _stem_counts(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and toxic documents per stem, summed in the task as far as memory allows."""
    counts: Counter = Counter()
    toxic: Counter = Counter()

    def out() -> pa.RecordBatch:
        rows = [{"stem": s, "n": n, "toxic": toxic[s]} for s, n in counts.items()]
        counts.clear()
        toxic.clear()
        return pa.RecordBatch.from_pylist(rows, STEM_COUNTS)

    for table in tables:
        for text, label in zip(table["text"].to_pylist(), table["toxic"].to_pylist()):
            own = {s for w in {w.lower() for w in WORD.findall(text or "")} for s in stems(w)}
            counts.update(own)
            if label:
                toxic.update(own)
            if len(counts) > STEMS_AT_ONCE:
                yield out()
    yield out()


def _measures(model: Model):
    """Per text its label, words, segment scores and a count of word scores by bin."""

    def measure(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            rows = []
            for text, label in zip(table["text"].to_pylist(), table["toxic"].to_pylist()):
                scores = model.scores(WORD.findall(text or ""))
                bins = np.bincount(np.digitize(scores, BINS), minlength=len(BINS) + 1).tolist()
                found = [s for s, _, _ in segments(scores)]
                rows.append({"toxic": label, "n": len(scores), "segments": found, "bins": bins})
            yield pa.RecordBatch.from_pylist(rows, MEASURES)

    return measure


def _curve(evidence: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Offset and slope of the logistic curve, by Newton's method with a light ridge."""
    x = np.stack([np.ones(len(evidence)), np.clip(evidence, -50, 50)], axis=1)
    beta = np.zeros(2)
    ridge = np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (toxic - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def calibrated(rows: list) -> Law:
    """The law and the curve of documents measured under a lexicon."""
    clean = [r for r in rows if not r["toxic"]]
    law = Law()
    if clean:
        counts = np.sum([r["bins"] for r in clean], axis=0)
        middles = np.concatenate(([BINS[0]], BINS[:-1] + 0.0625, [BINS[-1]]))
        law.rate = lambda_of(counts, middles)
        best = [law.rate * max(r["segments"], default=0.0) - math.log(max(r["n"], 1)) for r in clean]
        law.log_k = float(np.quantile(best, 0.9)) + math.log(-math.log(0.9))
    if 0 < len(clean) < len(rows):
        evidence = np.array([law.evidence(list(r["segments"]), r["n"]) for r in rows])
        offset, slope = _curve(evidence, np.array([float(bool(r["toxic"])) for r in rows]))
        if slope > 0:
            law.offset, law.slope = offset, slope
    return law


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, calibrates) of the sampled labelled documents."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.withColumn("drawn", F.xxhash64(F.lit("toxicity"), "doc_id"))
    parts = [known.filter(F.col("toxic") == c).orderBy("drawn", "doc_id").limit(LABELLED) for c in (0, 1)]
    # 2 * LABELLED rows of three numbers: small enough for every task, and no text is shuffled.
    sample = F.broadcast(parts[0].union(parts[1]))
    fold = (F.pmod("drawn", F.lit(CALIBRATION)) == 0).alias("calibrates")
    return docs.select("doc_id", "text").join(sample, "doc_id").select("text", "toxic", fold)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of (doc_id, text) and (doc_id, toxic)."""
    sample = _labelled(docs, labels)
    counted = sample.filter(~F.col("calibrates")).select("text", "toxic")
    size = counted.agg(F.count("*"), F.sum("toxic")).first()
    total, toxic = size[0], size[1] or 0
    share = (toxic + 1) / (total + 2)
    found = counted.mapInArrow(_stem_counts, "stem string, n bigint, toxic bigint")
    found = found.groupBy("stem").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).filter("n >= 2")
    apart = F.abs(F.col("toxic") - F.col("n") * share) / F.sqrt(F.col("n") + PRIOR)
    top = found.orderBy(apart.desc(), "stem").limit(LEXICON).collect()  # LEXICON rows at most
    model = Model(lexicon({r["stem"]: (r["n"], r["toxic"]) for r in top}, share), share, Law())
    measured = "toxic int, n bigint, segments array<double>, bins array<bigint>"
    rows = sample.filter("calibrates").select("text", "toxic").mapInArrow(_measures(model), measured)
    return Model(model.lexicon, share, calibrated(rows.collect()))  # a fifth of the sample


def judge(model: Model, text: Column) -> Column:
    """``score`` and ``passages`` of each text; places in code points, ends exclusive."""

    @F.pandas_udf(f"score double, passages {PASSAGES}")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [model.judged(t) for t in texts]
            yield pd.DataFrame({"score": [r[0] for r in rows], "passages": [r[1] for r in rows]})

    return judged(text)
