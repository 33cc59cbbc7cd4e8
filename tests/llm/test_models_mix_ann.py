"""Mixing, nearest neighbours, language and quality models."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailstream.llm import ann, mixing
from mailstream.llm.ann import nearest
from mailstream.llm.language import fit_languages, predict_languages
from mailstream.llm.mixing import copies_of, mix_sources, source_targets
from mailstream.llm.quality import fit_quality, score_quality


def water_filled(sizes, weights=(5, 2, 1), most=3):
    """Targets by source, by sharing again what is above the limits."""
    names = sorted(n for n in sizes if n is not None) + ([None] if None in sizes else [])
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        left = total - sum(capped.values())
        weighing = sum(w for n, w in weight.items() if n not in capped)
        over = {n for n in names if n not in capped and left * weight[n] / weighing > most * sizes[n]} if weighing else set()
        if not over:
            return {n: capped.get(n, left * weight[n] / weighing if weighing else 0) for n in names}
        capped.update({n: most * sizes[n] for n in over})


def mix_docs(spark, n=600):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "é", None, "z"])) for i in range(n)]
    rows += [(9000, "tiny", "small"), (9001, None, "none"), (9002, "w w", "b"), (9002, "w w", "b"), (None, "w w w", "a")]
    return rows, spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, size int")


@pytest.mark.parametrize("leaf", [mixing.LEAF_ROWS, 8])
def test_mix_comes_near_its_targets(spark, monkeypatch, leaf):
    monkeypatch.setattr(mixing, "LEAF_ROWS", leaf)
    monkeypatch.setattr(mixing, "FAN_IN", 4 if leaf == 8 else 256)
    rows, docs = mix_docs(spark)
    found = mix_sources(docs).collect()
    assert len(found) == len(rows)
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len((text or "").split())
    targets = water_filled(size)
    assert math.isclose(sum(targets.values()), sum(size.values()))
    taken = {}
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        near = [s for s in targets if math.isclose(targets[s], r["target"], abs_tol=1e-6) and size[s] == r["source_size"]]
        assert near
        taken[near[0]] = taken.get(near[0], 0) + r["taken"]
    for source, target in targets.items():
        assert abs(taken.get(source, 0) - target) <= 60
    again = mix_sources(docs.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_copies_are_rows(spark):
    _, docs = mix_docs(spark, 80)
    mixed = mix_sources(docs)
    rows = copies_of(mixed, docs)
    assert rows.columns == docs.columns
    assert rows.count() == mixed.agg(F.sum("copies")).first()[0]
    assert copies_of(mix_sources(docs.limit(0)), docs.limit(0)).count() == 0


def test_targets_of_few_sources(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 0), ("c", 1000)], "source string, size long")
    found = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    assert found == {"a": 30.0, "b": 0.0, "c": 980.0}


def test_neighbours_of_few_vectors_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK_ROWS", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(50)]
    bad = [(200, None), (201, [0.0] * 8), (202, [None] + [1.0] * 7), (203, [math.nan] * 8), (204, [math.inf] * 8)]
    bad += [(205, [1.0, 2.0]), (None, [1.0] * 8)]
    vectors = spark.createDataFrame([(*r, 3) for r in rows + bad], "vec_id long, embedding array<double>, score int")
    found = nearest(vectors, F.col("vec_id") % 20 == 0, neighbours=12, search_share=99.0).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    for query, pairs in got.items():
        score = x @ x[list(ids).index(query)]
        order = [i for i in np.lexsort((ids, -score.round(9))) if ids[i] != query][:12]
        assert pairs == [(ids[i], round(score[i], 9)) for i in order]
    few = nearest(vectors.where("vec_id < 3"), F.col("vec_id") == 0)
    assert few.count() == 2
    assert nearest(vectors.limit(0), F.lit(True)).count() == 0
    assert nearest(vectors.where("vec_id > 199"), F.lit(True)).count() <= 1


def test_recall(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 32))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = nearest(vectors, F.col("vec_id") % 100 == 0).collect()
    hits = 0
    for query in range(0, 3000, 100):
        score = x @ x[query]
        score[query] = -np.inf
        best = set(np.argsort(-score)[:20].tolist())
        hits += len(best & {r["vec_id"] for r in found if r["query_id"] == query})
    assert hits / (30 * 20) >= 0.9


WORDS = {
    "en": "the and house water thing with this that", "de": "der und haus wasser ding mit diese das ß",
    "fr": "le et maison eau chose avec cette que é", "es": "el y casa agua cosa con esta que ñ",
}


def test_language(spark):
    rng = random.Random(4)
    rows = [
        (i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(5, 60))), lang)
        for i, lang in enumerate(list(WORDS) * 60)
    ]
    train = spark.createDataFrame([*rows, (900, "x", None), (901, None, "en")], "doc_id long, text string, lang string")
    model = fit_languages(train)
    assert sorted(map(len, model.families)) == [2, 2]
    fresh = [(i, " ".join(rng.choice(w.split()) for _ in range(30)).upper(), lang) for i, (lang, w) in enumerate(WORDS.items())]
    odd = [(50, None, "n"), (51, "", "n"), (52, "123 !? 漢"[:6], "n"), (53, "the and " * 9000, "n"), (53, "the and " * 9000, "n")]
    docs = spark.createDataFrame([*fresh, *odd], "doc_id long, text string, score string")
    found = [tuple(r) for r in predict_languages(docs, model, docs["doc_id"]).collect()]
    said = {r[0]: r[1] for r in found}
    assert [said[i] for i in range(4)] == list(WORDS)
    assert said[50] == said[51] == said[52] == "und" and said[53] == "en"
    assert all(0 <= r[2] <= 1 for r in found) and len(found) == len(fresh) + len(odd)
    assert predict_languages(docs.limit(0), model, docs["doc_id"]).count() == 0
    nothing = predict_languages(docs, fit_languages(train.limit(0)), docs["doc_id"]).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_training_rows_are_bounded_whatever_repeats(spark):
    """Rows without doc_id, with one doc_id, and one text that is most of the rows."""
    rng = random.Random(4)
    texts = [(" ".join(rng.choice(WORDS[lang].split()) for _ in range(20)), lang) for lang in [*WORDS] * 100]
    for ids in (lambda i: None, lambda i: 7):
        rows = [(ids(i), text, lang) for i, (text, lang) in enumerate(texts)]
        rows += [(ids(0), "the and of", "en")] * 3000
        train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        model = fit_languages(train, 20)
        docs = spark.createDataFrame([(i, text, lang) for i, (text, lang) in enumerate(texts)], "i long, text string, lang string")
        found = predict_languages(docs, model, docs["i"], docs["lang"]).collect()
        assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(texts)


def test_quality(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        words = [rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(rng.randint(5, 80))]
        good = i % 5 > 0
        text = " ".join(words) if good else rng.choice([" ".join(words).upper() + "!!!", "spam " * 40])
        rows.append((i, text, "n"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame([*rows, (900, None, "n"), (901, "", "n")], "doc_id long, text string, words string")
    marks = spark.createDataFrame([*labels, (0, 0), (None, 1), (5, None)], "doc_id long, quality int")
    model = fit_quality(docs, marks.where("doc_id % 3 > 0"))
    assert 0 < len(model.rules) < 400
    found = {r["doc_id"]: r["score"] for r in score_quality(docs, model, docs["doc_id"]).collect()}
    assert all(0 <= s <= 1 for s in found.values()) and len(found) == 302
    held = [(found[i], good) for i, good in labels if i % 3 == 0]
    wrong = [s for s, good in held if (s >= 0.3) != bool(good)]
    assert len(wrong) <= 0.05 * len(held)
    assert score_quality(docs.limit(0), model, docs["doc_id"]).count() == 0
    blank = fit_quality(docs, marks.limit(0))
    assert {r["score"] for r in score_quality(docs, blank, docs["doc_id"]).collect()} == {0.5}
