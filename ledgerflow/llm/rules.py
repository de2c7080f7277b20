"""Quality classifier: a sparse ensemble of conjunctive rules.

Small boosted trees over text statistics are fitted on a bounded sample of
labelled rows; every path from a root is a candidate rule (a conjunction of
thresholds).  A logistic model with an L1 penalty weighs the rules, most to
zero.  The rules that remain compile into Spark column expressions, so scoring
whole corpora needs no Python.

Learning: labels of the learning fold, about ``SAMPLE`` rows (chosen by a hash
of the id).  Inputs are statistics of the text alone.

Defined cases: null text counts as empty and is scored; without labels of both
classes the score is the share of label 1 (0.5 if there are none); rows without
a quality are not learned from; repeated rows and labels are separate rows;
an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import held_out, whole_text

SAMPLE = 20_000
TREES, DEPTH, RATE, MIN_ROWS, CUTS = 24, 3, 0.3, 20, 48
PENALTY = 0.0005
ACCEPT = 0.7

# (statistic, is greater, threshold)
Condition = tuple[str, bool, float]


@dataclass
class RuleModel:
    bias: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text, as columns (doubles, 0 for the empty text)."""
    chars = F.char_length(text)
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    lines = F.split(text, "\n")
    per = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")
    left = lambda pattern: F.char_length(F.regexp_replace(text, pattern, ""))
    letters = left(r"[^\p{L}]+")
    return {
        "words": F.size(words).cast("double"),
        "word_chars": per(chars - F.size(words), F.size(words)),
        "distinct_words": per(F.size(F.array_distinct(words)), F.size(words)),
        "distinct_lines": per(F.size(F.array_distinct(lines)), F.size(lines)),
        "letters": per(letters, chars),
        "capitals": per(left(r"[^\p{Lu}]+"), letters),
        "digits": per(left(r"[^0-9]+"), chars),
        "marks": per(left(r"[\p{L}\p{N}\s.,]+"), chars),
    }


def _grow(x: np.ndarray, bins: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray,
          rows: np.ndarray, depth: int, path: tuple, rules: set, out: np.ndarray) -> None:
    """One regression tree on gradient sums; records every path, adds leaf values to ``out``."""
    value = grad[rows].sum() / (hess[rows].sum() + 1.0)
    best = (1e-6, None, None)
    if depth:
        g0, h0 = grad[rows].sum(), hess[rows].sum()
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            b = bins[rows, f]
            gs = np.cumsum(np.bincount(b, grad[rows], len(c) + 1))[:-1]
            hs = np.cumsum(np.bincount(b, hess[rows], len(c) + 1))[:-1]
            ns = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
            gain = gs ** 2 / (hs + 1) + (g0 - gs) ** 2 / (h0 - hs + 1) - g0 ** 2 / (h0 + 1)
            gain[(ns < MIN_ROWS) | (len(rows) - ns < MIN_ROWS)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, k)
    if best[1] is None:
        out[rows] += RATE * value
        return
    _, f, k = best
    high = bins[rows, f] > k
    for side, part in ((False, rows[~high]), (True, rows[high])):
        longer = (*path, (f, side, k))
        rules.add(longer)
        _grow(x, bins, cuts, grad, hess, part, depth - 1, longer, rules, out)


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> RuleModel:
    """Boosted trees -> paths -> L1 logistic weights (accelerated proximal gradient)."""
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        p = min(max(share, 1e-3), 1 - 1e-3)
        return RuleModel(float(np.log(p / (1 - p))))
    cuts = []
    for f in range(x.shape[1]):
        edges = np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)[1:-1], method="inverted_cdf"))
        values = np.unique(x[:, f])
        after = values[np.minimum(np.searchsorted(values, edges, side="right"), len(values) - 1)]
        cuts.append(np.unique((edges + after)[after > edges] / 2))  # between two values
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin, paths = np.full(len(y), np.log(share / (1 - share))), set()
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        _grow(x, bins, cuts, y - p, p * (1 - p), np.arange(len(y)), DEPTH, (), paths, margin)
    paths = sorted(paths)
    hit = np.ones((len(y), len(paths)))
    for j, path in enumerate(paths):
        for f, above, k in path:
            hit[:, j] *= (bins[:, f] > k) == above
    hit, first = np.unique(hit, axis=1, return_index=True)
    paths = [paths[i] for i in first]
    step = 4.0 / max(np.linalg.norm(hit.T @ hit / len(y), 2) + 1, 1e-9)
    w, b = np.zeros(hit.shape[1]), float(np.log(share / (1 - share)))
    vw, vb, t = w.copy(), b, 1.0
    for _ in range(400):
        err = 1 / (1 + np.exp(-(hit @ vw + vb))) - y
        nw = vw - step * (hit.T @ err) / len(y)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * PENALTY, 0)
        nb = vb - step * err.mean()
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb, t, w, b = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b), nt, nw, nb
    rules = [(tuple((names[f], above, float(cuts[f][k])) for f, above, k in path), float(v))
             for path, v in zip(paths, w) if abs(v) > 1e-6]
    return RuleModel(float(b), rules)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """Fit on labelled rows of the learning fold; the sampled ids (about
    ``sample``) are the broadcast side, statistics are taken of those texts only."""
    known = labels.filter(~held_out() & F.col("quality").isNotNull()).select(
        "doc_id", F.col("quality").cast("double").alias("_quality"))
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * sample / n))
    stats = statistics(whole_text())
    rows = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
            .select(F.col("_quality"), *[c.alias(k) for k, c in stats.items()])
            .toPandas().sort_values(["_quality", *stats], ignore_index=True))  # any input order, one model
    return fit_rules(rows[list(stats)].to_numpy(np.float64), rows["_quality"].to_numpy(np.float64), list(stats))


def score_of(model: RuleModel, stats: dict[str, Column]) -> Column:
    """The model as one column expression, a probability of label 1."""
    margin = F.lit(model.bias)
    for conditions, weight in model.rules:
        every = F.lit(True)
        for name, above, cut in conditions:
            every = every & (stats[name] > cut if above else stats[name] <= cut)
        margin = margin + F.when(every, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def score_documents(docs: DataFrame, model: RuleModel, into: str = "score") -> DataFrame:
    """``docs`` plus the score in column ``into``.  Statistics are computed once a
    row: a struct with a member that is not deterministic is never copied into the
    expressions, or a later filter, that use its other members."""
    stats = statistics(whole_text())
    holder = f"_{into}_stats"
    once = F.monotonically_increasing_id().alias("_once")
    rows = docs.withColumn(holder, F.struct(*[c.alias(k) for k, c in stats.items()], once))
    return rows.withColumn(into, score_of(model, {k: F.col(holder)[k] for k in stats})).drop(holder)
