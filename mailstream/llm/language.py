"""Language identification by families, then by pairs within a family.

Texts become hashed counts of byte n-grams (one to three bytes of the lower-case text),
square-rooted and scaled to length one.  Languages whose mean vectors are alike form a
family.  A linear support vector machine for each family against the others picks the
family; within it, one for each pair of languages votes.

Training reads labelled rows only: different texts, about `rows_per_language` of them for
each language, chosen by a hash of the text; that is the documented bound, whatever rows
repeat or lack a doc_id.  Prediction reads nothing but the text, whole.

Text that is null, empty or has no letter gets `und` and score 0.  Rows with null language
are not learned from.  Without labelled rows every text is `und`.  One learned language is
the answer for every text with a letter.  Repeated rows get equal answers; other columns do
not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailstream.llm.common import slices, text_or_empty

BUCKETS = 4096
ROWS_PER_LANGUAGE = 500
UNDECIDED = "und"
#: Bytes of a text that are counted at a time.
STEP = 1 << 20


def features(text: str) -> np.ndarray:
    """Scaled n-gram counts of a whole text."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    counts = np.zeros(BUCKETS)
    for start in range(0, len(data), STEP):
        # Two more bytes, for the n-grams that begin before the step's end.
        a = data[start : start + STEP + 2].astype(np.uint32)
        two = a[:-1] * np.uint32(257) + a[1:] + np.uint32(1 << 16)
        three = two[:-1] * np.uint32(263) + a[2:] + np.uint32(1 << 24)
        for grams in (a[:STEP], two[:STEP], three[:STEP]):
            mixed = grams * np.uint32(2654435761)
            counts += np.bincount(mixed >> np.uint32(20), minlength=BUCKETS)
    vector = np.sqrt(counts)
    return (vector / max(np.linalg.norm(vector), 1e-9)).astype(np.float32)


def _machine(x: np.ndarray, y: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights and offset of a linear machine (squared hinge loss) for labels -1 and 1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    y = y.astype(np.float32)
    balance = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    balance = balance.astype(np.float32)
    weights = np.zeros(x.shape[1], np.float32)
    ahead, momentum, rate = weights.copy(), np.float32(1), np.float32(0.2)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        gradient = np.float32(1e-4) * ahead - 2 * ((balance * y * slack) @ x)
        new = ahead - rate * gradient
        following = np.float32((1 + np.sqrt(1 + 4 * momentum**2)) / 2)
        ahead = new + (momentum - 1) / following * (new - weights)
        weights, momentum = new, following
    return weights


def _families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Half as many families as languages, by joining the most alike."""
    names = sorted(means)
    centre = np.mean([means[n] for n in names], axis=0)
    families = [[n] for n in names]

    def alike(a: list[str], b: list[str]) -> float:
        pairs = [(means[p] - centre, means[q] - centre) for p in a for q in b]
        return float(
            np.mean([p @ q / (np.linalg.norm(p) * np.linalg.norm(q) + 1e-9) for p, q in pairs])
        )

    while len(families) > max(1, (len(names) + 1) // 2):
        pairs = [
            (alike(families[i], families[j]), -i, -j)
            for i in range(len(families))
            for j in range(i + 1, len(families))
        ]
        _, i, j = max(pairs)
        families[-i] = families[-i] + families[-j]
        del families[-j]
    return families


@dataclass
class LanguageModel:
    """Families, and one row of weights for each machine."""

    families: list[list[str]]
    family_weights: np.ndarray
    pair_weights: dict[tuple[str, str], np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, labels: list[str]) -> LanguageModel:
        labels = np.asarray(labels, dtype=object)
        means = {name: x[labels == name].mean(axis=0) for name in sorted(set(labels))}
        families = _families(means) if means else []
        family_of = {n: i for i, family in enumerate(families) for n in family}
        owner = np.array([family_of[n] for n in labels], dtype=int)
        against = [_machine(x, np.where(owner == i, 1.0, -1.0)) for i in range(len(families))]
        pairs = {}
        for family in families:
            for i, p in enumerate(family):
                for q in family[i + 1 :]:
                    rows = (labels == p) | (labels == q)
                    pairs[p, q] = _machine(x[rows], np.where(labels[rows] == p, 1.0, -1.0))
        return cls(families, np.array(against).reshape(-1, BUCKETS + 1), pairs)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """A language and a score for each row of features."""
        if not self.families:
            return [UNDECIDED] * len(x), np.zeros(len(x))
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        if len(self.families) == 1:
            chosen, score = np.zeros(len(x), int), np.ones(len(x))
        else:
            margins = x @ self.family_weights.T
            chosen = margins.argmax(axis=1)
            ordered = np.sort(margins, axis=1)
            score = _sigmoid(2 * (ordered[:, -1] - ordered[:, -2]))
        names, score = np.empty(len(x), object), score.astype(float)
        for number, family in enumerate(self.families):
            rows = np.flatnonzero(chosen == number)
            if not len(rows):
                continue
            votes = np.zeros((len(rows), len(family)))
            margin = np.zeros((len(rows), len(family), len(family)))
            for i, p in enumerate(family):
                for j, q in enumerate(family):
                    if i < j:
                        m = x[rows] @ self.pair_weights[p, q]
                        margin[:, i, j], margin[:, j, i] = m, -m
            votes = (margin > 0).sum(axis=2) + 1e-3 * np.tanh(margin.sum(axis=2))
            best = votes.argmax(axis=1)
            names[rows] = np.asarray(family, object)[best]
            if len(family) > 1:
                own = margin[np.arange(len(rows)), best]
                own[np.arange(len(rows)), best] = np.inf
                score[rows] *= _sigmoid(4 * own.min(axis=1))
        return names.tolist(), score


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def fit_languages(
    labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE
) -> LanguageModel:
    """A model from (doc_id, text, lang) rows, of which about `rows_per_language` are read."""
    labelled = labelled.select("text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    # One row for each language; the model keeps as many.
    texts = F.approx_count_distinct(F.xxhash64("text")).alias("texts")
    counts = {row["lang"]: row["texts"] for row in labelled.groupBy("lang").agg(texts).collect()}
    spot = F.pmod(F.xxhash64("text", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.where(F.lit(False))
    if counts:
        shares = [(F.lit(n), F.lit(rows_per_language / max(c, 1))) for n, c in counts.items()]
        share = F.create_map(*[x for pair in shares for x in pair])
        chosen = labelled.where(spot < F.try_element_at(share, F.col("lang")))
    chosen = chosen.dropDuplicates()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [features(x).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(vectors, pa.binary())], ["lang", "vector"]
            )

    rows = chosen.select("lang", "text").mapInArrow(run, "lang string, vector binary").collect()
    rows = sorted((row["lang"], bytes(row["vector"])) for row in rows)
    vectors = [np.frombuffer(vector, np.float32) for _, vector in rows]
    x = np.array(vectors, np.float32).reshape(len(rows), BUCKETS)
    return LanguageModel.fit(x, [name for name, _ in rows])


def predict_languages(docs: DataFrame, model: LanguageModel, *kept: Column) -> DataFrame:
    """doc_id, lang_pred and score for each row, after the `kept` columns of `docs`."""
    parts = model.families, model.family_weights, model.pair_weights
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    rows = docs.select(*kept, text_or_empty().alias("_whole_text"))
    names = rows.columns[:-1]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*shared.value)
        for batch in batches:
            for part in slices(batch, 128):
                texts = part.column("_whole_text").to_pylist()
                written = [i for i, x in enumerate(texts) if any(map(str.isalpha, x))]
                languages, scores = [UNDECIDED] * len(texts), np.zeros(len(texts))
                if written:
                    x = np.array([features(texts[i]) for i in written])
                    found, sure = model.predict(x)
                    scores[written] = sure
                    for i, name in zip(written, found, strict=True):
                        languages[i] = name
                columns = [part.column(name) for name in names]
                columns += [pa.array(languages, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return rows.mapInArrow(run, ", ".join([*fields, "lang_pred string, score double"]))
