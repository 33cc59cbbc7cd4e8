"""Quality scores from a sparse ensemble of rules.

Statistics of a text are Spark columns.  Small trees, grown on bootstrap samples of labelled
rows, give rules: each path from a root is a conjunction of comparisons.  A logistic model
with an L1 penalty over the rules keeps few of them, and those become one Spark column
expression; scoring runs no Python.

Labels are read from at most about `max_rows` rows, spread by a hash of doc_id (the
documented bound of the fit); scores read the text only, whole.

Null text counts as empty; every statistic of an empty text is 0 and it is scored like any
other.  Without labelled rows the score is 0.5.  A document with several labels counts with
the lowest.  Repeated rows get equal scores; other columns do not matter; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailstream.llm.common import text_or_empty, words_of

MAX_ROWS = 10_000


def statistics(docs: DataFrame, *kept: Column) -> DataFrame:
    """The `kept` columns and the statistics of each row's text."""
    rows = docs.select(*kept, text_or_empty().alias("_whole_text"))
    names = rows.columns[:-1]
    text = F.col("_whole_text")
    rows = rows.select(
        *names, text.alias("_whole_text"), words_of(text).alias("_words")
    )
    words, chars = F.col("_words"), F.length("_whole_text")
    lines = F.filter(F.split("_whole_text", "\n"), lambda x: x != "")

    def left_of(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, ""))

    def per(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    rows = rows.select(
        *names,
        chars.alias("_chars"),
        F.size("_words").alias("_n"),
        F.size(F.array_distinct("_words")).alias("_distinct"),
        F.size(lines).alias("_lines"),
        F.size(F.array_distinct(lines)).alias("_distinct_lines"),
        left_of(r"[^\p{Lu}]+").alias("_upper"),
        left_of(r"[^\p{L}]+").alias("_letters"),
        left_of(r"[^0-9]+").alias("_digits"),
        left_of(r"[\p{L}\p{N}\s.,]+").alias("_marks"),
        F.array_max(F.transform(words, F.length)).alias("_longest"),
        F.size(F.filter(words, lambda w: w.endswith(".") | w.endswith(","))).alias("_stops"),
    )
    n, chars = F.col("_n"), F.col("_chars")
    stats = {
        "words": F.log1p(n),
        "word_length": per(chars, n),
        "longest_word": F.coalesce(F.col("_longest"), F.lit(0)),
        "distinct_words": per(F.col("_distinct"), n),
        "new_words": per(F.col("_distinct"), F.sqrt(n)),
        "distinct_lines": per(F.col("_distinct_lines"), F.col("_lines")),
        "line_words": per(n, F.col("_lines")),
        "upper": per(F.col("_upper"), F.col("_letters")),
        "letters": per(F.col("_letters"), chars),
        "digits": per(F.col("_digits"), chars),
        "marks": per(F.col("_marks"), chars),
        "stops": per(F.col("_stops"), n),
    }
    return rows.select(*names, *[c.cast("double").alias(k) for k, c in stats.items()])


#: One comparison: statistic number, whether it must be above, limit.
Test = tuple[int, bool, float]
Rule = tuple[Test, ...]


def _grow(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, rng: np.random.Generator, depth: int
) -> list[Rule]:
    """The paths of one tree, each node's own path included."""
    rules: list[Rule] = []

    def grow(rows: np.ndarray, path: Rule) -> None:
        if path:
            rules.append(path)
        if len(path) == depth or len(rows) < 20 or len(set(y[rows])) < 2:
            return
        best = (1e-9, None)
        for column in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
            values = x[rows, column]
            limits = np.unique(np.quantile(values, np.linspace(0.02, 0.98, 25)))
            above = values[:, None] > limits
            weight, positive = w[rows], w[rows] * y[rows]
            wa, pa = weight @ above, positive @ above
            wb, pb = weight.sum() - wa, positive.sum() - pa
            p = positive.sum() / weight.sum()
            with np.errstate(divide="ignore", invalid="ignore"):
                impure = np.nan_to_num(pa * (1 - pa / wa)) + np.nan_to_num(pb * (1 - pb / wb))
            gain = weight.sum() * p * (1 - p) - impure
            gain[(above.sum(axis=0) < 5) | ((~above).sum(axis=0) < 5)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), (int(column), float(limits[gain.argmax()])))
        if best[1] is None:
            return
        column, limit = best[1]
        above = x[rows, column] > limit
        grow(rows[above], (*path, (column, True, limit)))
        grow(rows[~above], (*path, (column, False, limit)))

    grow(rng.choice(len(x), len(x)), ())
    return rules


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    tests = [(x[:, i] > limit) == above for i, above, limit in rule]
    return np.logical_and.reduce(tests)


def _lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600):
    """Weights and offset of a logistic model with an L1 penalty on the weights."""
    weights, offset = np.zeros(z.shape[1]), float(np.log((y.mean() + 1e-3) / (1.001 - y.mean())))
    step = 4.0 * len(z) / (np.linalg.norm(z, 2) ** 2 + len(z))
    ahead, ahead_offset, momentum = weights, offset, 1.0
    for _ in range(rounds):
        wrong = 1 / (1 + np.exp(-(z @ ahead + ahead_offset))) - y
        new = ahead - step * (z.T @ wrong) / len(z)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_offset = ahead_offset - step * wrong.mean()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        pull = (momentum - 1) / following
        ahead, ahead_offset = new + pull * (new - weights), new_offset + pull * (new_offset - offset)
        weights, offset, momentum = new, new_offset, following
    return weights, offset


@dataclass
class RuleModel:
    """Rules with weights, over named statistics."""

    names: list[str]
    rules: list[tuple[float, Rule]]
    offset: float

    @classmethod
    def fit(
        cls,
        names: list[str],
        x: np.ndarray,
        y: np.ndarray,
        trees: int = 60,
        depth: int = 3,
        penalty: float = 0.002,
    ) -> RuleModel:
        if not len(y):
            return cls(names, [], 0.0)
        rng = np.random.default_rng(7)
        share = y.mean()
        # Rare labels count as much as common ones while rules are sought.
        w = np.where(y == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
        rules: dict[bytes, Rule] = {}
        for _ in range(trees):
            for rule in _grow(x, y, w, rng, depth):
                column = _holds(rule, x)
                if 0 < column.sum() < len(x):
                    rules.setdefault(np.packbits(column).tobytes(), rule)
        found = list(rules.values())
        if not found:
            return cls(names, [], float(np.log((share + 1e-3) / (1.001 - share))))
        z = np.stack([_holds(rule, x) for rule in found], axis=1).astype(float)
        weights, offset = _lasso(z, y, penalty)
        kept = [(float(v), r) for v, r in zip(weights, found, strict=True) if abs(v) > 1e-6]
        return cls(names, kept, float(offset))

    def column(self) -> Column:
        """The score as an expression over the statistics' columns."""

        def holds(rule: Rule) -> Column:
            tests = [
                F.col(self.names[i]) > limit if above else F.col(self.names[i]) <= limit
                for i, above, limit in rule
            ]
            return reduce(lambda a, b: a & b, tests)

        terms = [F.when(holds(rule), weight).otherwise(0.0) for weight, rule in self.rules]
        total = reduce(lambda a, b: a + b, terms, F.lit(self.offset))
        return 1.0 / (1.0 + F.exp(-total))


def fit_quality(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS
) -> RuleModel:
    """A model from texts and (doc_id, quality) labels; both must hold training rows only."""
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_labelled"))
        .agg(F.min("quality").alias("_quality"))
    )
    count = one.count()
    spot = F.pmod(F.xxhash64("_labelled", F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    one = one.where(spot < max_rows / max(count, 1))
    joined = docs.select("doc_id", "text").join(one, F.col("doc_id") == F.col("_labelled"))
    stats = statistics(joined, F.col("doc_id"), F.col("_quality"))
    rows = sorted(stats.collect(), key=tuple)
    names = stats.columns[2:]
    x = np.array([row[2:] for row in rows], float).reshape(len(rows), len(names))
    y = np.array([float(row["_quality"] == 1) for row in rows])
    return RuleModel.fit(names, x, y)


def score_quality(docs: DataFrame, model: RuleModel, *kept: Column) -> DataFrame:
    """The `kept` columns of each row and its score."""
    stats = statistics(docs, *kept)
    names = stats.columns[: -len(model.names)] if model.names else stats.columns[: len(kept)]
    return stats.select(*names, model.column().alias("score"))
