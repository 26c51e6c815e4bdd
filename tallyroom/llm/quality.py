"""A quality classifier as a sparse ensemble of rules.

Statistics of a text are Spark columns. On a bounded sample of labelled rows, boosted
trees of small depth propose rules: every path from a root to a node is a conjunction
of thresholds on statistics. A lasso logistic regression weighs the rules and leaves
most of them at zero; what remains is compiled into one Spark column expression, so
scoring runs without Python.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let
from .shared import GAP

SYMBOLS = r"[#*$%&|<>]"
#: A word right behind itself.
STUTTER = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]+\1(?![^\x20\x09-\x0D])"


def statistics(text: Column) -> Column:
    """A struct of statistics of a whole text; all are 0 for NULL and for texts without a word.

    Text, words and lines are bound once, so the struct may be used in filters and lambdas
    without being taken apart and computed again.
    """
    def share(pattern: str, whole: Column, size: Column) -> Column:
        return F.regexp_count(whole, F.lit(pattern)) / size

    def values(whole: Column, words: Column, lines: Column) -> Column:
        size = F.greatest(F.length(whole), F.lit(1)).cast("double")
        n_words = F.size(words)
        per_word = F.greatest(n_words, F.lit(1)).cast("double")
        per_line = F.size(lines).cast("double")
        return F.struct(*[value.alias(name) for name, value in {
            "n_words": n_words.cast("double"),
            "word_length": F.length(F.regexp_replace(whole, GAP, "")) / per_word,
            "distinct_words": F.size(F.array_distinct(words)) / per_word,
            "symbols": share(SYMBOLS, whole, size),
            "capitals": share(r"\p{Lu}", whole, size),
            "letters": share(r"\p{L}", whole, size),
            "digits": share(r"\p{Nd}", whole, size),
            "marks": share(r"[.,;:!?]", whole, size),
            "exclamations": share("!", whole, size),
            "stutter": F.regexp_count(whole, F.lit(STUTTER)) / per_word,
            "line_words": n_words / per_line,
            "repeated_lines": F.lit(1.0) - F.size(F.array_distinct(lines)) / per_line,
        }.items()])

    return let(F.coalesce(text, F.lit("")), lambda whole: let(
        F.array_remove(F.split(whole, GAP), ""), lambda words: let(
            F.split(whole, "\n"), lambda lines: values(whole, words, lines))))


NAMES = ("n_words", "word_length", "distinct_words", "symbols", "capitals", "letters", "digits", "marks", "exclamations",
         "stutter", "line_words", "repeated_lines")


@dataclass(frozen=True)
class Rule:
    """A conjunction: each condition is (statistic, lower bound or None, upper bound or None), lower < x <= upper."""

    conditions: tuple
    weight: float = 0.0

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(values.values()))), bool)
        for name, low, high in self.conditions:
            if low is not None:
                out &= values[name] > low
            if high is not None:
                out &= values[name] <= high
        return out

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for name, low, high in self.conditions:
            if low is not None:
                out = out & (stats[name] > low)
            if high is not None:
                out = out & (stats[name] <= high)
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self, stats: Column) -> Column:
        """Probability of label 1 from a struct of `statistics`."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(stats), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(names: list[str], x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, least: int = 10,
               shrink: float = 0.3, cuts: int = 32) -> list[Rule]:
    """The paths of boosted regression trees on the logistic loss, without repeats."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, cuts + 1)[1:-1])) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)  # code <= c: x <= edge c
    rules: dict[tuple, None] = {}
    margin = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-9)
        nodes = [(np.arange(len(y)), {})]
        for level in range(depth + 1):
            deeper = []
            for rows, path in nodes:
                if path:
                    rules[tuple((names[j], *bounds) for j, bounds in sorted(path.items()))] = None
                split = None if level == depth or len(rows) < 2 * least else _best_split(
                    codes[rows], gradient[rows], weight[rows], [len(e) for e in edges], least)
                if split is None:
                    margin[rows] += shrink * gradient[rows].sum() / (weight[rows].sum() + 1.0)
                    continue
                j, code = split
                low, high = path.get(j, (None, None))
                left = codes[rows, j] <= code
                deeper.append((rows[left], path | {j: (low, float(edges[j][code]))}))
                deeper.append((rows[~left], path | {j: (float(edges[j][code]), high)}))
            nodes = deeper
    return [Rule(conditions) for conditions in rules]


def _best_split(codes, gradient, weight, sizes, least):
    best, found = 1e-6, None
    whole_g, whole_w, n = gradient.sum(), weight.sum(), len(gradient)
    for j, size in enumerate(sizes):
        if not size:
            continue
        g = np.cumsum(np.bincount(codes[:, j], gradient, size + 1))[:-1]
        w = np.cumsum(np.bincount(codes[:, j], weight, size + 1))[:-1]
        k = np.cumsum(np.bincount(codes[:, j], minlength=size + 1))[:-1]
        gain = g**2 / (w + 1) + (whole_g - g) ** 2 / (whole_w - w + 1) - whole_g**2 / (whole_w + 1)
        gain[(k < least) | (n - k < least)] = 0
        if gain.max() > best:
            best, found = gain.max(), (j, int(gain.argmax()))
    return found


def lasso(features: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an absolute-value penalty, by accelerated proximal gradient steps."""
    n, k = features.shape
    scale = np.maximum(features.std(axis=0), 0.02)
    z = (features - features.mean(axis=0)) / scale
    step = 4.0 * n / max(np.linalg.norm(z.T @ z, 2) + n, 1.0)
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    ahead, ahead_b, t = w, b, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(z @ ahead + ahead_b))) - y
        moved = ahead - step * (z.T @ error) / n
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_b = ahead_b - step * error.mean()
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, ahead_b = new_w + (t - 1) / t_next * (new_w - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new_w, new_b, t_next
    plain = w / scale
    return plain, b - float(plain @ features.mean(axis=0))


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = 8_000, penalty: float = 2e-3) -> RuleEnsemble:
    """Learns from at most `max_rows` labelled documents, the first by a hash of their key.

    Keys are sampled first, so only the statistics of sampled documents are computed and
    come to the driver, and no text is shuffled. Labels other than 0 and 1 and NULL keys are
    left out. Without rows, or with one label only, the score is a constant: 0.5, or nearly
    that label.
    """
    known = labels.select(F.col(key).alias("__k"), F.col(label).cast("double").alias("__y")).where(
        F.col("__y").isin(0.0, 1.0)).distinct()
    order = [F.xxhash64("__k"), F.col("__k"), F.col("__y")]
    sampled = documents.select(F.col(key).alias("__k")).distinct().join(known, "__k").orderBy(*order).limit(max_rows)
    rows = documents.select(F.col(key).alias("__k"), F.col(text).alias("__t")).join(F.broadcast(sampled), "__k").select(
        "__k", "__y", F.xxhash64("__t").alias("__h"), statistics(F.col("__t")).alias("s"))
    data = rows.orderBy(*order, "__h").limit(max_rows).select("__y", "s.*").toPandas()
    names, y = list(NAMES), data["__y"].to_numpy()
    if not len(y):
        return RuleEnsemble((), 0.0)
    if y.min() == y.max():
        return RuleEnsemble((), 6.0 if y[0] else -6.0)
    rules = tree_rules(names, data[names].to_numpy(), y)
    values = {n: data[n].to_numpy() for n in names}
    features = np.stack([r.holds(values) for r in rules], axis=1).astype(float) if rules else np.zeros((len(y), 0))
    if not rules:
        return RuleEnsemble((), float(np.log(y.mean() / (1 - y.mean()))))
    weights, intercept = lasso(features, y, penalty)
    chosen = tuple(Rule(r.conditions, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-4)
    return RuleEnsemble(chosen, intercept)


def scored(documents: DataFrame, model: RuleEnsemble, text: str = "text", name: str = "score") -> DataFrame:
    """Adds the score (0 to 1) of every whole text; NULL and empty texts are scored like any other.

    The score is one expression with its statistics bound inside: a filter on it computes them
    once, and columns with the names of statistics pass unchanged.
    """
    return documents.withColumn(name, let(statistics(F.col(text)), model.score))
