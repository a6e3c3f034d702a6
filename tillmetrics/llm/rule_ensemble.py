"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of each text are built-in column functions. On a sample of labelled texts small
regression trees are boosted in numpy; each path from a root to a node is a rule, a
conjunction of limits. A logistic regression with an L1 penalty (lasso, by accelerated
proximal gradient steps) weighs the rules and leaves most out. What remains is compiled
into one Spark column expression, so scoring needs no Python.

Defined results: a null or empty text has statistics of 0 and is scored like any other.
Without labelled texts every score is 0.5; with one label only it is that label's share
by Laplace's rule. Repeated rows are each scored; a text labelled several times counts as its
greatest label. Labels other than 0 and 1, and null ones, are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000  # about as many labelled texts are learned from
TREES = 40
DEPTH = 3
BINS = 32
SHARE = 0.5  # of the sample that a tree sees
STEP = 0.3
PENALTY = 0.002  # of the sum of weights, against the mean loss
ROUNDS = 400
THRESHOLD = 0.7

STATISTICS = (
    "n_words", "word_length", "symbols", "marks", "capitals", "digits", "distinct_words", "line_words",
    "repeated_lines", "stops",
)


def statistics(text: Column) -> dict[str, Column]:
    """The SQL-side statistics by name; all finite, 0 for an empty text."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    n = F.greatest(F.size("words"), F.lit(1))
    chars = F.greatest(F.length("text"), F.lit(1))
    n_lines = F.greatest(F.size("lines"), F.lit(1))

    def count(of: str) -> Column:
        return F.length("text") - F.length(F.regexp_replace("text", f"[{of}]+", ""))

    first = {"text": text, "words": words, "lines": lines}
    values = {
        "n_words": F.size("words"),
        "word_length": F.length(F.array_join("words", "")) / n,
        "symbols": count("#*$%&|<>@^~\\\\_+=") / n,
        "marks": count("!?") / n,
        "capitals": count("A-Z") / chars,
        "digits": count("0-9") / chars,
        "distinct_words": F.size(F.array_distinct("words")) / n,
        "line_words": F.size("words") / n_lines,
        "repeated_lines": (F.size("lines") - F.size(F.array_distinct("lines"))) / n_lines,
        "stops": count(".,;:") / n,
    }
    return {**first, **{k: v.cast("double") for k, v in values.items()}}


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and the statistics of each text."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    columns = statistics(F.col("text"))
    rows = rows.withColumns({c: columns[c] for c in ("words", "lines")})
    return rows.select("key", *[columns[c].alias(c) for c in STATISTICS])


@dataclass(frozen=True)
class Rule:
    """A conjunction: each limit is a statistic's name, whether it is below, and the bound."""

    limits: tuple[tuple[str, bool, float], ...]

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, below, bound in self.limits:
            out &= x[name] <= bound if below else x[name] > bound
        return out

    def column(self) -> Column:
        out = None
        for name, below, bound in self.limits:
            one = F.col(name) <= bound if below else F.col(name) > bound
            out = one if out is None else out & one
        return out


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The score of a row of statistics as a column expression."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _bins(x: np.ndarray) -> np.ndarray:
    """Bounds between values, at even shares of the sample."""
    cuts = np.unique(np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
    return cuts[cuts < x.max()]


def _tree(
    names: tuple[str, ...], codes: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, rows: np.ndarray
) -> tuple[list[tuple], list[tuple[np.ndarray, float]]]:
    """One regression tree on the gradient: the paths of its nodes, and its leaves."""
    paths, leaves = [], []
    open_nodes = [((), rows)]
    while open_nodes:
        path, own = open_nodes.pop()
        best = None
        if len(path) < DEPTH and len(own) >= 20:
            total, n = gradient[own].sum(), len(own)
            for f in range(len(names)):
                if not len(cuts[f]):
                    continue
                sums = np.bincount(codes[own, f], weights=gradient[own], minlength=len(cuts[f]) + 1)
                size = np.bincount(codes[own, f], minlength=len(cuts[f]) + 1)
                left, n_left = np.cumsum(sums)[:-1], np.cumsum(size)[:-1]
                ok = (n_left >= 10) & (n - n_left >= 10)
                gain = np.where(ok, left**2 / np.maximum(n_left, 1) + (total - left) ** 2 / np.maximum(n - n_left, 1), -1)
                k = int(gain.argmax())
                if gain[k] > total**2 / n + 1e-9 and (best is None or gain[k] > best[0]):
                    best = (gain[k], f, k)
        if best is None:
            leaves.append((own, path))
            continue
        _, f, k = best
        below = codes[own, f] <= k
        for side, part in ((True, own[below]), (False, own[~below])):
            deeper = (*path, (names[f], side, float(cuts[f][k])))
            paths.append(deeper)
            open_nodes.append((deeper, part))
    return paths, leaves


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def extract_rules(x: dict[str, np.ndarray], y: np.ndarray) -> list[Rule]:
    """Every distinct path of the boosted trees."""
    rng = np.random.default_rng(11)
    names = tuple(x)
    cuts = [_bins(x[n]) for n in names]
    codes = np.stack([np.searchsorted(c, x[n], side="left") for n, c in zip(names, cuts)], axis=1)
    z = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    found: dict[tuple, None] = {}
    for _ in range(TREES):
        gradient = y - _sigmoid(z)
        rows = np.flatnonzero(rng.random(len(y)) < SHARE)
        paths, leaves = _tree(names, codes, cuts, gradient, rows)
        found.update(dict.fromkeys(tuple(sorted(p)) for p in paths))
        for _, path in leaves:
            own = Rule(path).holds(x)
            if own.any():
                p = _sigmoid(z[own])
                z[own] += STEP * gradient[own].sum() / max((p * (1 - p)).sum(), 1e-3)
    return [Rule(p) for p in found]


def lasso(a: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise the mean logistic loss and the weights' L1 norm."""
    n, k = a.shape
    lipschitz = 0.25 * (np.linalg.norm(a, 2) ** 2 / n + 1)
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    v, c, t = w.copy(), b, 1.0
    for _ in range(ROUNDS):
        error = _sigmoid(a @ v + c) - y
        moved = v - a.T @ error / n / lipschitz
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - penalty / lipschitz, 0)
        new_b = c - error.mean() / lipschitz
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return b, w


def train(x: dict[str, np.ndarray], y: np.ndarray) -> Ensemble:
    if not len(y):
        return Ensemble(0.0, [])
    if y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble(float(np.log(share / (1 - share))), [])
    rules = extract_rules(x, y)
    if not rules:
        return Ensemble(float(np.log(y.mean() / (1 - y.mean()))), [])
    a = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float64)
    intercept, weights = lasso(a, y)
    return Ensemble(float(intercept), [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def fit(measures: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Ensemble:
    """Learn from labelled measures; about SAMPLE_ROWS rows, chosen by a hash of the key,
    reach the driver, twice as many at most."""
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("of")).agg(F.max(label).alias("y"))
    joined = measures.join(known, F.col("key") == F.col("of"))
    rows = max(1, known.count())
    draw = F.pmod(F.xxhash64("key"), F.lit(1_000_003)) / 1_000_003
    sample = joined.filter(draw < SAMPLE_ROWS / rows).select("key", "y", *STATISTICS).limit(2 * SAMPLE_ROWS).collect()
    sample = sorted(sample, key=lambda r: tuple(r))
    x = {c: np.array([r[c] for r in sample], np.float64) for c in STATISTICS}
    return train(x, np.array([r["y"] for r in sample], np.float64))
