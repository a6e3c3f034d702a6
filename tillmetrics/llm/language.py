"""Language identification by a small convolutional network over bytes.

A text is cut into fixed windows of bytes. Filters of several widths run over each
window's byte vectors; the greatest response of each filter feeds a softmax over the
learned languages, and the windows' probabilities are averaged over the whole text.
The network is trained in numpy on windows of labelled texts.

Defined results: a null or letterless text, and every text when nothing could be
learned, is ``und`` with score 0. Ties go to the language that sorts first. Repeated
rows are each predicted. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.llm.memory import trimmed

UNKNOWN = "und"
WINDOW = 128  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
VECTOR = 8  # numbers that stand for a byte
WIDEST = max(WIDTHS)
BLOCK = 256  # windows computed at once
BYTES_AT_ONCE = 1_000_000  # of windows, though always one whole text

MIN_SCORE = 0.3  # below it a text is of no learned language

TEXTS_PER_LANGUAGE = 600  # about as many texts of each are trained on
WINDOWS_PER_TEXT = 4


@dataclass(frozen=True)
class Network:
    languages: list[str]
    vectors: np.ndarray  # byte -> VECTOR
    filters: np.ndarray  # WIDEST * VECTOR -> all filters, zero beyond a filter's width
    bias: np.ndarray
    output: np.ndarray  # filters -> languages
    output_bias: np.ndarray


def _mask() -> np.ndarray:
    rows = np.arange(WIDEST * VECTOR)[:, None] // VECTOR
    return (rows < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text's bytes, the last one filled up with zeros; one row at least."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


def _columns(windows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Each position's vector beside those of the next WIDEST - 1 bytes."""
    padded = np.zeros((len(windows), WINDOW + WIDEST - 1), np.uint8)
    padded[:, :WINDOW] = windows
    seen = vectors[padded]
    return np.concatenate([seen[:, j : j + WINDOW] for j in range(WIDEST)], axis=2)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(net: Network, windows: np.ndarray) -> np.ndarray:
    out = np.empty((len(windows), len(net.languages)), np.float32)
    for at in range(0, len(windows), BLOCK):
        x = _columns(windows[at : at + BLOCK], net.vectors)
        pooled = (x.reshape(-1, x.shape[2]) @ net.filters).reshape(*x.shape[:2], -1).max(axis=1)
        pooled = np.maximum(pooled + net.bias, 0)
        out[at : at + BLOCK] = _softmax(pooled @ net.output + net.output_bias)
    return out


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 5) -> Network:
    """Fit by Adam on the cross entropy; the same input gives the same network."""
    rng = np.random.default_rng(7)
    n, mask = len(WIDTHS) * FILTERS, _mask()
    p = [
        rng.normal(0, 0.5, (256, VECTOR)),
        rng.normal(0, 0.3, (WIDEST * VECTOR, n)) * mask,
        np.zeros(n),
        rng.normal(0, 0.2, (n, len(languages))),
        np.zeros(len(languages)),
    ]
    p = [x.astype(np.float32) for x in p]
    p[0][0] = 0  # filler
    m, v, step, batch = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0, 128
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            w, y = windows[pick], labels[pick]
            x = _columns(w, p[0])
            raw = (x.reshape(-1, x.shape[2]) @ p[1]).reshape(len(w), WINDOW, n)
            best = raw.argmax(axis=1)  # window, filter -> position
            top = np.take_along_axis(raw, best[:, None, :], 1)[:, 0] + p[2]
            pooled = np.maximum(top, 0)
            d = _softmax(pooled @ p[3] + p[4])
            d[np.arange(len(w)), y] -= 1
            d /= len(w)
            d_top = (d @ p[3].T) * (top > 0)
            at_best = x[np.arange(len(w))[:, None], best]  # window, filter, inputs
            d_vectors = np.zeros_like(p[0])
            d_in = d_top[:, :, None] * p[1].T[None]
            padded = np.pad(w, ((0, 0), (0, WIDEST - 1)))
            for j in range(WIDEST):
                seen = np.take_along_axis(padded, best + j, 1)
                part = d_in[:, :, j * VECTOR : (j + 1) * VECTOR]
                np.add.at(d_vectors, seen.ravel(), part.reshape(-1, VECTOR))
            d_vectors[0] = 0
            grads = [
                d_vectors,
                np.einsum("bfi,bf->if", at_best, d_top) * mask,
                d_top.sum(axis=0),
                pooled.T @ d,
                d.sum(axis=0),
            ]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                fit = m[i] / (1 - 0.9**step) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
                p[i] = (p[i] - 0.01 * fit).astype(np.float32)
    return Network(languages, *p)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Network | None:
    """A network from labelled texts, or None without any.

    Trained on a sample: of each language about TEXTS_PER_LANGUAGE texts, chosen by a
    hash of the key, and of each WINDOWS_PER_TEXT windows at hashed places of the
    whole text; at most twice that many reach the driver.
    """
    rows = labelled.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter("lang is not null and text is not null and text <> ''")
    counts = rows.groupBy("lang").count()
    counts = {r["lang"]: r["count"] for r in counts.collect()}  # a row per language
    if not counts:
        return None
    pairs = [F.lit(x) for name, count in counts.items() for x in (name, TEXTS_PER_LANGUAGE / count)]
    share = F.try_element_at(F.create_map(*pairs), F.col("lang"))
    draw = F.pmod(F.xxhash64("key"), F.lit(1_000_003)) / 1_000_003
    span = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    places = [F.pmod(F.xxhash64("key", F.lit(i)), span) + 1 for i in range(WINDOWS_PER_TEXT)]
    cuts = F.array(*[F.substring("text", p.cast("int"), F.lit(WINDOW)) for p in places])
    sample = rows.filter(draw < share).select("lang", cuts.alias("cuts"))
    sample = sample.limit(2 * TEXTS_PER_LANGUAGE * len(counts)).collect()
    sample = sorted((r["lang"], *r["cuts"]) for r in sample)  # the order of tasks must not matter
    if not sample:
        return None
    languages = sorted({r[0] for r in sample})
    windows = np.stack([windows_of(c.encode())[0] for r in sample for c in r[1:]])
    labels = np.repeat([languages.index(r[0]) for r in sample], WINDOWS_PER_TEXT)
    return train(windows, labels, languages)


def _predict_batch(net: Network | None, texts: pd.Series) -> pd.DataFrame:
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if net is None:
        return pd.DataFrame({"lang": names, "score": scores})
    rows = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
    at = 0
    while at < len(rows):  # some texts at a time
        part, size = [], 0
        while at < len(rows) and size < BYTES_AT_ONCE:
            part.append((rows[at], windows_of(texts.iloc[rows[at]].encode("utf-8", "replace"))))
            size += part[-1][1].size
            at += 1
        found = probabilities(net, np.concatenate([w for _, w in part]))
        starts = np.cumsum([0] + [len(w) for _, w in part[:-1]])
        lengths = np.array([len(w) for _, w in part])
        means = np.add.reduceat(found, starts, axis=0) / lengths[:, None]
        for (i, _), mean in zip(part, means):
            best = int(mean.argmax())
            names[i], scores[i] = net.languages[best], min(1.0, float(mean[best]))
    return pd.DataFrame({"lang": names, "score": scores})


def predict(net: Network | None, text: Column) -> Column:
    """A struct of the predicted ``lang`` and its ``score`` for each whole text."""

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in trimmed(batches):
            yield _predict_batch(net, texts)

    return run(text)


def accepted(net: Network | None, text: Column) -> Column:
    """Whether a text is of a learned language: it has letters and a score of MIN_SCORE.

    Without a network every text that has letters is.
    """

    @F.pandas_udf("boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in trimmed(batches):
            if net is None:
                yield pd.Series([t is not None and any(map(str.isalpha, t)) for t in texts], dtype=bool)
            else:
                found = _predict_batch(net, texts)
                yield (found["lang"] != UNKNOWN) & (found["score"] >= MIN_SCORE)

    return run(text)
