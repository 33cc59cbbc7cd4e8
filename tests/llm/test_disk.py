"""What the Jaccard join leaves out of their shuffles and scratch files."""

import numpy as np
import pytest
from test_jaccard_sketches import brute_components, near_texts

from mailstream.llm import common, jaccard
from mailstream.llm.jaccard import jaccard_components, signatures


@pytest.fixture()
def scratch(monkeypatch, tmp_path):
    """Names of the folders that are left."""
    names = iter(range(10_000))
    monkeypatch.setattr(
        common, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}-{next(names)}"
    )
    return lambda: {x.name.rpartition("-")[0] for x in tmp_path.iterdir()}


@pytest.mark.parametrize("percent, size", [(80, 200), (80, 5000), (90, 3000)])
def test_unlike_sets_do_not_meet_in_empty_segments(percent, size):
    """Sets that share no shingle met by the hundred segments that hold none."""
    random = np.random.default_rng(size)
    sets = [np.unique(random.integers(0, 1 << 63, size).astype(np.uint64)) for _ in range(12)]
    found = np.concatenate([signatures(x, percent) for x in sets])
    assert len(np.unique(found)) == len(found)


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_linked_sets_meet(percent):
    random = np.random.default_rng(percent)
    linked = 0
    for n in [1, 2, 3, 5, 8, 13, 20, 33, 60, 150, 400, 2500] * 25:
        x = random.integers(0, 1 << 63, n).astype(np.uint64)
        changed = int(random.integers(0, n * (100 - percent) // percent + 1))
        gone = int(random.integers(0, changed + 1))
        more = random.integers(0, 1 << 63, changed - gone).astype(np.uint64)
        x, y = np.unique(x), np.unique(np.concatenate([x[gone:], more]))
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= percent * (len(x) + len(y) - both):
            linked += 1
            assert len(np.intersect1d(signatures(x, percent), signatures(y, percent)))
    assert linked > 100


def test_finer_cells_rule_out_unlike_long_sets(spark):
    """256 cells left all pairs of long sets, whose texts then met."""
    random = np.random.default_rng(4)
    sets = [random.integers(0, 1 << 63, n).astype(np.uint64) for n in (9000, 9000, 12_500, 40)]
    sets.append(np.concatenate([sets[0][:8300], random.integers(0, 1 << 63, 700).astype(np.uint64)]))
    cells = [jaccard._fine_cells(x) or jaccard._cells(x) for x in sets]
    assert len(cells[3]) == 256 < len(cells[0])
    rows = [(i, len(x), bytearray(c)) for i, (x, c) in enumerate(zip(sets, cells))]
    texts = spark.createDataFrame(rows, "key long, n_shingles long, cells binary")
    pairs = [(0, 1), (0, 2), (1, 2), (3, 0), (4, 0), (4, 1)]
    pairs = spark.createDataFrame(pairs, "a long, b long")
    assert [tuple(r) for r in jaccard._likely(pairs, texts, 80).collect()] == [(4, 0)]
    placed = texts.selectExpr("1L as signature", "key", "key as root")
    found = jaccard._near_by_cells(placed, texts, 80).collect()
    assert [tuple(r) for r in found] == [(None, 4, 0)]


def test_parts_find_the_same_links(spark, monkeypatch, scratch):
    monkeypatch.setattr(jaccard, "_parts", lambda meeting, texts: 3)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard, "DENSE_PAIRS", 0)
    rows = near_texts(3)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key int, root string")
    assert sorted(map(tuple, jaccard_components(docs).collect())) == brute_components(rows)
    assert "jaccard-texts" not in scratch() and "jaccard-members" in scratch()
