"""Quality classification by a sparse ensemble of rules over text statistics.

Statistics of each whole text are Spark columns. Small boosted trees are grown on a bounded sample of
labelled rows; every path from a root is a conjunctive rule. A logistic regression with a lasso
penalty keeps few rules and weighs them, and the kept rules are compiled into one Spark column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxledger.llm.common import checkpoint, column, fold, held_out

SAMPLE_ROWS = 20_000  # labelled rows that training takes at most
TREES, DEPTH, BINS, SHRINK = 24, 3, 24, 0.3
LASSO, STEPS = 0.002, 400
THRESHOLD = 0.3
PRIOR = 0.5  # score if nothing is labelled

STATISTICS = [
    "chars",
    "words",
    "word_length",
    "line_words",
    "letters",
    "capitals",
    "marks",
    "digits",
    "distinct_words",
    "distinct_lines",
    "stops",
]

# Characters that count as marks (neither letters, digits, space nor plain sentence
# punctuation).
MARKS = "#$%&*+/<=>@[\\]^_`{|}~!"


def statistics(text: Column) -> list[Column]:
    """The statistics of a whole text as columns; null counts as empty. Shares of nothing are 0."""
    t = F.coalesce(text, F.lit(""))
    chars = F.char_length(t).cast("double")
    words = F.array_remove(F.split(F.lower(t), "[ \\t\\n\\x0B\\f\\r]+"), "")
    lines = F.array_remove(F.split(t, "\n"), "")
    without = lambda drop: chars - F.char_length(F.translate(t, drop, "")).cast("double")
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    n_words, n_lines = F.size(words).cast("double"), F.size(lines).cast("double")
    capitals = without("ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÀÇÊÑÍÓÁÚ")
    blanks = without(" \t\n\x0b\f\r")
    marks, digits, stops = without(MARKS), without("0123456789"), without(".,;:?'\"()-")
    return [
        c.alias(name)
        for name, c in zip(
            STATISTICS,
            [
                chars,
                n_words,
                share(chars - blanks, n_words),
                share(n_words, n_lines),
                share(chars - blanks - marks - digits - stops, chars),
                share(capitals, chars),
                share(marks, chars),
                share(digits, chars),
                share(F.size(F.array_distinct(words)).cast("double"), n_words),
                share(F.size(F.array_distinct(lines)).cast("double"), n_lines),
                share(stops, n_words),
            ],
        )
    ]


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, at most?, bound) that hold together, and their weight."""

    conditions: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, at_most, bound in self.conditions:
            out &= (x[:, k] <= bound) == at_most
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for k, at_most, bound in self.conditions:
            c = F.col(STATISTICS[k]) <= F.lit(bound)
            out = out & (c if at_most else ~c)
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    """A bias and weighted rules; ``score`` is the logistic of the weights of the rules that hold."""

    bias: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for rule in self.rules:
            total = total + F.when(rule.column(), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Rules of all paths of boosted trees, each once.

    Every tree fits the gradient of the log loss; cuts are chosen among quantiles, and of equal gains
    the first statistic and the lowest cut win, so the same rows give the same trees.
    """
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    margin = np.full(len(y), np.log(mean / (1 - mean)))
    found: dict[tuple, Rule] = {}

    def grow(rows: np.ndarray, path: tuple, grad: np.ndarray, hess: np.ndarray) -> None:
        if path:
            found.setdefault(path, Rule(path))
        g, h = grad[rows], hess[rows]
        best = None
        if len(path) < DEPTH and len(rows) >= 20:
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                gs = np.cumsum(np.bincount(binned[rows, k], g, len(c) + 1))[:-1]
                hs = np.cumsum(np.bincount(binned[rows, k], h, len(c) + 1))[:-1]
                ns = np.cumsum(np.bincount(binned[rows, k], minlength=len(c) + 1))[:-1]
                ok = (ns >= 5) & (len(rows) - ns >= 5)
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - g.sum() ** 2 / (h.sum() + 1)
                gain = np.where(ok, gain, -1)
                at = int(gain.argmax())
                if gain[at] > 1e-6 and (best is None or gain[at] > best[0] + 1e-12):
                    best = (gain[at], k, at)
        if best is None:
            margin[rows] += SHRINK * g.sum() / (h.sum() + 1)
            return
        _, k, at = best
        below = binned[rows, k] <= at
        bound = float(cuts[k][at])
        grow(rows[below], (*path, (k, True, bound)), grad, hess)
        grow(rows[~below], (*path, (k, False, bound)), grad, hess)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), (), y - p, p * (1 - p))
    return list(found.values())


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float = LASSO) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic regression with an absolute-value penalty (accelerated proximal
    gradient with a fixed number of steps)."""
    n, m = x.shape
    design = x.astype(np.float64)
    # A bound of the curvature by power iteration.
    v = np.ones(m) / np.sqrt(max(m, 1))
    for _ in range(20):
        v = design.T @ (design @ v)
        v /= max(np.linalg.norm(v), 1e-12)
    step = 1 / (np.linalg.norm(design @ v) ** 2 / n * 0.25 * 1.1 + 0.25)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w, b = np.zeros(m), float(np.log(mean / (1 - mean)))
    w_ahead, b_ahead, momentum = w, b, 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(design @ w_ahead + b_ahead))) - y
        w_new = w_ahead - step * (design.T @ error) / n
        w_new = np.sign(w_new) * np.maximum(np.abs(w_new) - step * penalty, 0)
        b_new = b_ahead - step * float(error.mean())
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        w_ahead = w_new + (momentum - 1) / faster * (w_new - w)
        b_ahead = b_new + (momentum - 1) / faster * (b_new - b)
        w, b, momentum = w_new, b_new, faster
    return b, w


def train(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    """The ensemble for statistics ``x`` and labels ``y`` (0, 1)."""
    if not len(y):
        return RuleEnsemble(float(np.log(PRIOR / (1 - PRIOR))), ())
    rules = tree_rules(x, y)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    if not rules:
        return RuleEnsemble(float(np.log(mean / (1 - mean))), ())
    bias, weights = lasso_logistic(np.stack([r.holds(x) for r in rules], axis=1), y)
    return RuleEnsemble(
        float(bias), tuple(Rule(r.conditions, float(w)) for r, w in zip(rules, weights) if w != 0)
    )


def with_statistics(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id`` and the statistics of every row."""
    return docs.select(column(id_col).alias("id"), column(text).alias("text")).select("id", *statistics(F.col("text")))


def labelled_sample(stats: DataFrame, labels: DataFrame, id_col: str, label: str, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``rows`` labelled rows outside the held-out fold, drawn by a
    hash of the id. An id with several labels counts with each; null labels are no labels."""
    known = labels.select(column(id_col).alias("label_id"), column(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out(F.col("label_id")))
    drawn = min(1.0, 0.95 * rows / max(1, known.count()))
    order = F.xxhash64("label_id", F.lit(3))
    if drawn < 1:
        known = known.where(F.pmod(order, F.lit(1_000_003)) < F.lit(int(drawn * 1_000_003)))
    got = (
        stats.join(known, F.col("id") == F.col("label_id"))
        .orderBy(order, "label_id", "label", *STATISTICS)
        .limit(rows)
        .select("label", *STATISTICS)
        .toPandas()
    )
    return got[STATISTICS].to_numpy(float), got["label"].to_numpy(float)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per input row: ``id``, its statistics and ``quality_score`` (0 to 1).

    Learned from labelled rows outside the held-out fold only; a score depends on the text alone.
    Null and empty texts have the statistics of an empty text. Without labels the score is 0.5, with
    labels of one kind their share. Texts are read once: what moves are a dozen numbers a row.
    """
    stats = checkpoint(with_statistics(docs, id_col, text))
    ensemble = train(*labelled_sample(stats, labels, id_col, label, sample_rows))
    return stats.withColumn("quality_score", ensemble.score())


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score_quality(docs, labels)
    return scored.select(
        F.col("id").alias("doc_id"),
        F.coalesce(fold(F.col("id")) == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
