"""Neighbours of many queries, of which a task holds few at a time."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mailstream.llm import ann
from mailstream.llm.ann import nearest


def batch(ids, x, leaves, asks, part=5):
    columns = [
        pa.array([part] * len(ids), pa.int64()), pa.array([asks] * len(ids)), pa.array(ids, pa.int64()),
        pa.array([v.tolist() for v in x], pa.list_(pa.float32())), pa.array(leaves, pa.list_(pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "asks", "id", "vector", "leaves"])


def test_answers_come_while_queries_stream_past(monkeypatch):
    """All queries of a leaf were held, and all their answers."""
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 8)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 7)
    monkeypatch.setattr(ann, "SCORED_PAIRS", 16)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 6)).astype(np.float32)
    x[60:90] = x[10]  # equal vectors
    ids = np.arange(120)
    ids[100:110] = 3  # one id, several vectors
    leaf = rng.integers(0, 4, 120)
    leaf[60:90] = leaf[10]
    read = []

    def rows():
        for start in range(0, 120, 30):
            at = slice(start, start + 30)
            yield batch(ids[at], x[at], [[k] for k in leaf[at]], False)
        for start in range(0, 120, 20):
            read.append(start)
            at = slice(start, start + 20)
            yield batch(ids[at], x[at], [[k, 3] if k < 3 else [3] for k in leaf[at]], True)

    answers, wide = {}, x.astype(float)
    for some in ann._searched(rows(), 5):
        assert some.num_rows <= 8 * 5 and len(read) <= 1 + len(answers) // 15
        for query, vec, score in zip(*(c.to_pylist() for c in some.columns)):
            answers.setdefault(query, []).append((-score, vec))
    assert len(read) == 6
    for k in [*range(3), *range(4, 100), *range(110, 120)]:
        found = {}
        for i in np.flatnonzero(((leaf == leaf[k]) | (leaf == 3)) & (ids != k)):
            score = (wide[i] * wide[k]).sum()
            found[ids[i]] = max(found.get(ids[i], -np.inf), score)
        assert answers[k] == sorted((-score, i) for i, score in found.items())[:5]


def test_equal_vectors_are_compared_once():
    x = np.repeat(np.random.default_rng(1).normal(size=(3, 4)), 50, axis=0)
    group = ann._group(np.arange(150)[::-1].copy(), x, np.repeat([2, 0, 2], 50), 6)
    assert group.leaves.tolist() == [0, 2] and group.begin.tolist() == [0, 7, 21]
    assert sorted(group.ids.tolist()) == [*range(7), *range(50, 57), *range(100, 107)]


def test_leaves_beyond_a_group_and_repeated_ids(spark, monkeypatch):
    """An id with many good vectors took the places of others."""
    monkeypatch.setattr(ann, "CHUNK_ROWS", 8)
    rng = np.random.default_rng(8)
    x = [(i, rng.normal(size=5).tolist()) for i in range(90)]
    x += [(7, [9.0, 9.0, 9.0, 9.0, 9.0 + i / 99]) for i in range(40)] + [(200, [1.0] * 5)]
    x += [(300 + i, [0.5] * 5) for i in range(30)]
    vectors = spark.createDataFrame(x, "vec_id long, embedding array<double>")
    found = nearest(vectors, F.col("vec_id") == 200, neighbours=12, search_share=99.0).collect()
    best = {}
    for i, v in x:
        if i != 200:
            best[i] = max(best.get(i, -np.inf), sum(v))
    order = sorted(best, key=lambda i: (-round(best[i], 9), i))[:12]
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])] == order and order[0] == 7
