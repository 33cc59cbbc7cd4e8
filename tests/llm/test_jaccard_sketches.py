"""Jaccard components and fingerprints against brute force."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailstream.llm import jaccard, sketches
from mailstream.llm.bruijn import remove_repeated_words
from mailstream.llm.common import components
from mailstream.llm.jaccard import allocation, band_edges, jaccard_components, shingle_set

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(text or "")
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_texts(seed):
    """Groups of texts at similarities on both sides of the limit, of many sizes."""
    rng = random.Random(seed)
    rows = []
    for n in (3, 4, 6, 11, 12, 20, 40, 75, 150):
        words = [f"w{rng.randint(0, 999)}" for _ in range(n)]
        for edits in (0, 0, 1, 1, 2, 3, max(1, n // 30)):
            mine = list(words)
            for _ in range(edits):
                at = rng.choice([0, len(mine) - 1, rng.randrange(len(mine))])
                mine[at] = mine[at].upper() if rng.random() < 0.3 else f"v{rng.randint(0, 9)}"
            if rng.random() < 0.3:
                mine = mine[: -rng.randint(1, max(1, n // 12))] or mine
            rows.append((len(rows), "  \n".join(mine)))
    rows += [(500, ""), (501, None), (502, " \t "), (503, "Alone"), (504, "alone"), (505, "a b"), (505, "a b")]
    return rows


def brute_components(rows):
    sets = [shingles((text or "").translate(SMALL), 3) for _, text in rows]
    root = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    least = {}
    for (doc_id, _), r in zip(rows, root):
        least[r] = min(doc_id, least.get(r, doc_id))
    return sorted((d, len(s), least[r]) for (d, _), s, r in zip(rows, sets, root))


@pytest.mark.parametrize(("seed", "block"), [(1, 256), (2, 2)])
def test_components_as_by_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 8 * block)
    rows = near_texts(seed)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key int, root string")
    assert sorted(map(tuple, jaccard_components(docs).collect())) == brute_components(rows)
    assert jaccard_components(docs.limit(0)).count() == 0


def test_null_ids_link_but_name_nothing(spark):
    rows = [(None, "a b c d"), (7, "a b c d"), (None, "only this one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["doc_id"], r["component_id"]) for r in jaccard_components(docs).collect()}
    assert found == {(None, 7), (7, 7), (None, None)}


def test_cells_rule_out_no_similar_pair(spark):
    """Upper bound on what two sets share, also where cells are full."""
    random = np.random.default_rng(3)
    sets, rows = {}, []
    for key, size in enumerate([1, 40, 40, 700, 700, 90_000, 90_000]):
        sets[key] = random.integers(0, 1 << 63, size).astype(np.uint64)
    sets[2][:34], sets[4][:650] = sets[1][:34], sets[3][:650]
    for key, held in sets.items():
        rows.append((key, len(held), bytearray(jaccard._cells(held))))
    texts = spark.createDataFrame(rows, "key long, n_shingles long, cells binary")
    pairs = spark.createDataFrame([(1, 2), (3, 4), (1, 3), (5, 6), (0, 1)], "a long, b long")
    found = {tuple(r) for r in jaccard._likely(pairs, texts, 70).collect()}
    assert {(1, 2), (3, 4), (5, 6)} <= found and not {(1, 3), (0, 1)} & found
    assert jaccard._likely(pairs.limit(0), texts, 70).count() == 0


def crowd_of(spark, sets):
    """Classes of some texts that all share one bucket, none of them linked yet."""
    rows = []
    for key, text in enumerate(sets):
        held = shingle_set(text)
        rows.append((7, key, text, len(held), bytearray(jaccard._cells(held))))
    texts = spark.createDataFrame(
        rows, "signature long, key long, text string, n_shingles long, cells binary"
    )
    roots = spark.createDataFrame([], "node long, root long")
    return texts.select("signature", "key"), roots, texts.drop("signature")


def test_texts_of_unlike_classes_do_not_travel(spark, monkeypatch):
    """Classes of one bucket were sent once for each two blocks."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 2)
    read = spark.sparkContext.accumulator(0)

    def counted(text, shingle=3):
        read.add(1)
        return shingle_set(text, shingle)

    monkeypatch.setattr(jaccard, "shingle_set", counted)
    rng = random.Random(8)
    sets = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(60)) for _ in range(40)]
    sets[31] = sets[4] + " end"
    found = jaccard._links_between(*crowd_of(spark, sets), 90, 3).collect()
    assert [sorted(r) for r in found] == [[4, 31]] and read.value <= len(sets)


@pytest.mark.parametrize("tile", [3, 10, 2048])
@pytest.mark.parametrize("dense", [0, 1, 1000])
def test_pairs_and_blocks_join_the_same_roots(spark, monkeypatch, tile, dense):
    """Tiles with few and with many likely pairs, of one block and of two."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard, "TILE_SETS", tile)
    monkeypatch.setattr(jaccard, "TILE_PAIRS", 7)
    monkeypatch.setattr(jaccard, "DENSE_PAIRS", dense)
    sets = sorted({text for _, text in near_texts(5) if WORD.search(text or "")})
    crowd, roots, texts = crowd_of(spark, sets)
    more = crowd.where("key < 20").withColumn("signature", F.lit(8).cast("long"))
    links = jaccard._links_between(crowd.unionByName(more), roots, texts, 90, 3)
    found = {r["node"]: r["root"] for r in components(links, "test").collect()}
    keys = {text: key for key, text in enumerate(sets)}
    expected = brute_components([(key, text) for text, key in keys.items()])
    assert {key: found.get(key, key) for key in keys.values()} == {d: r for d, _, r in expected}


def test_band_groups_cover_every_band_once():
    sizes = {3: 10, 4: 500, 5: 20, 9: 7, 20: 3}
    for groups in (1, 2, 4, 50):
        found = jaccard.band_groups(sizes, 80, groups)
        assert [band for bands in found for band in bands] == [*range(2, 21)]
        assert all(len(bands) for bands in found) and (groups > 1) == (len(found) > 1)
    assert jaccard.band_groups({}, 80, 4) == []
    assert jaccard.band_groups({0: 5}, 80, 4) in ([range(0, 1)],)


@pytest.mark.parametrize("groups", [1, 30])
def test_pairs_across_a_border_of_groups_meet(spark, monkeypatch, groups):
    """Sizes of two bands, which lie in one group or in two."""
    monkeypatch.setattr(jaccard, "BAND_GROUPS", groups)
    edge = band_edges(90)[14]
    rows = []
    for n in range(edge - 2, edge + 2):
        words = [f"w{i}" for i in range(n + 2)]
        rows += [(n, " ".join(words), "x"), (1000 + n, " ".join(f"v{w}" for w in words), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()}
    first = edge - 2
    assert found == {n: 1000 + first if n >= 1000 else first for n in found} and len(found) == 8


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_allocation_covers_the_differences(percent):
    edges = band_edges(percent)
    for band in range(40):
        for x in {edges[band], edges[band + 1] - 1}:
            assert 100 * x // percent < edges[band + 2]
            for y in range(x, min(100 * x // percent, x + 400) + 1):
                common = -(-percent * (x + y) // (100 + percent))
                exact, deletions = allocation(percent, band)
                assert exact + 2 * deletions > x + y - 2 * min(common, x)


def test_capitals_and_short_texts():
    assert (shingle_set("A b C") == shingle_set("a B c")).all()
    assert len(shingle_set("É b c")) == 1 and (shingle_set("É b c") != shingle_set("é b c")).all()
    assert len(shingle_set("")) == 0 and len(shingle_set("one")) == 1


def test_components_of_links(spark):
    rng = random.Random(3)
    links = [(rng.randint(-40, 40), rng.randint(-40, 40)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(30)]
    root = {n: n for pair in links for n in pair}
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(links, "a long, b long"), "test")
    found = {r["node"]: r["root"] for r in found.collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: root[n] for n in linked}


DOCS = [
    (5, "one two three four five six seven eight nine ten"), (1, "a"), (2, ""), (3, None), (9, "x y z " * 200),
    (9, "x y z " * 200), (None, "first of all come those without a name"), (40, "été " * 7), (41, " \n"),
]


@pytest.mark.parametrize("group_rows", [1, 2, 2000])
def test_edited_texts_and_fingerprints(spark, monkeypatch, group_rows):
    monkeypatch.setattr(sketches, "GROUP_ROWS", group_rows)
    docs = spark.createDataFrame([(*r, "n") for r in DOCS], "doc_id long, text string, group string")
    found = sketches.fingerprints(docs, 1.0).collect()
    assert len(found) == len(DOCS)
    rows = sorted(((-1 if d is None else d), t or "") for d, t in DOCS)
    want = {}
    for i, (doc_id, text) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + other[:quarter]
        like = []
        for second in (edited, other):
            a, b = shingles(text, 5), shingles(second, 5)
            like.append(len(a & b) / len(a | b) if a | b else 1.0)
        want.setdefault(doc_id, []).append((len(text), hashlib.sha256(edited.encode()).hexdigest(), *like))
    got = {}
    for r in found:
        key = -1 if r["doc_id"] is None else r["doc_id"]
        got.setdefault(key, []).append((r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    prints = {r["fingerprint"] for r in found if r["doc_id"] == 9}
    assert len(prints) == 1
    assert sketches.fingerprints(docs.limit(0)).count() == 0


def test_sketches_merge_and_contain(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    short = " ".join(f"w{i}" for i in range(1000, 1600))
    rows = spark.createDataFrame([(long, short, "u v w x y z " * 9)], "a string, b string, c string")
    s = {n: sketches.sketch(F.col(n)) for n in "abc"}
    row = rows.select(
        F.size(s["a"]).alias("n"),
        sketches.containment(s["b"], s["a"]).alias("inside"),
        (sketches.merge(s["a"], s["b"]) == s["a"]).alias("same"),
        sketches.likeness(s["a"], s["c"]).alias("apart"),
    ).first()
    assert 800 < row["n"] < 1200 and row["inside"] == 1.0 and row["same"] and row["apart"] == 0.0


def test_merging_short_and_long_texts_gives_the_sketch_of_both(spark):
    """At the shipped fraction most short texts have no hash below the limit."""
    pairs = [(n, m) for n in range(0, 11) for m in (0, 5, 7, 60)]
    words = [f"m{i}" for i in range(2000)]
    rows = []
    for at, (n, m) in enumerate(pairs):
        a, b = words[40 * at : 40 * at + n], words[40 * at + 100 : 40 * at + 100 + m]
        rows.append((" ".join(a), " ".join(b)))
    frame = spark.createDataFrame(rows, "a string, b string")
    every = frame.select(
        *(sketches.sketch(F.col(n)).alias(f"s{n}") for n in "ab"),
        *(sketches.sketch(F.col(n), 1.0).alias(f"all_{n}") for n in "ab"),
    )
    limit = int(sketches.FRACTION * 2.0**63)
    for row in every.select("*", sketches.merge(F.col("sa"), F.col("sb")).alias("both")).collect():
        hashes = sorted({*row["all_a"], *row["all_b"]})
        below = [h for h in hashes if h < limit]
        assert row["both"] == (below or hashes[:1])


def test_long_words_that_are_unlike_everywhere_are_different(spark):
    """Two words of two letters whose polynomials modulo 2**64 agree for any base."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, one), (2, other), (3, f"{other}\n")], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()}
    assert found == {1: 1, 2: 2, 3: 2}
    words = " ".join(f"w{i}" for i in range(34))
    docs = spark.createDataFrame([(1, f"{words} {one}"), (2, f"{words} {other}")], "doc_id long, text string")
    assert {r["n_removed"] for r in remove_repeated_words(docs).collect()} == {0}
