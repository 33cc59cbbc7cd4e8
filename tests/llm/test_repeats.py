"""Removal of repeated bytes and words against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from mailstream.llm import suffixes
from mailstream.llm.bruijn import compact, remove_repeated_words
from mailstream.llm.stretches import BYTE_SYMBOLS, stretches
from mailstream.llm.suffixes import least_documents, remove_repeated_bytes, whole_characters

SCHEMA = "doc_id long, text string, n_bytes string, key string"


def brute_bytes(rows, width=50):
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        order = -(2**63) if doc_id is None else doc_id
        for p in range(len(data) - width + 1):
            w = data[p : p + width]
            first[w] = min(first.get(w, order), order)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        order = -(2**63) if doc_id is None else doc_id
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - width + 1):
            if first[data[p : p + width]] < order:
                gone[p : p + width] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, width=35):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    count = Counter(tuple(w[p : p + width]) for w in lists for p in range(len(w) - width + 1))
    out = []
    for (doc_id, _), words in zip(rows, lists):
        gone = np.zeros(len(words), bool)
        for p in range(len(words) - width + 1):
            if count[tuple(words[p : p + width])] > 1:
                gone[p : p + width] = True
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def corpus(seed):
    """Texts with shared passages, copies, edits, loops, nulls, ties and repeated rows."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé漢 ") for _ in range(rng.randint(1, 7))) or "a"
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(8, 60)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randint(0, 40)) for _ in range(rng.randint(1, 4))]
        parts += rng.sample(passages, rng.randint(0, 3))
        rng.shuffle(parts)
        rows.append((i, " \n".join(parts)))
    rows += [(100 + i, rows[i][1][: rng.randint(40, 400)] + "X" + rows[i][1][50:]) for i in range(8)]
    rows += [(200, rows[3][1]), (200, rows[3][1]), (201, "la " * 90), (202, "x" * 49), (203, "y" * 50)]
    rows += [(204, ""), (205, None), (None, rows[5][1]), (None, None), (206, "y" * 51)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, "n", "k") for row in rows], SCHEMA)


@pytest.mark.parametrize("crowded", [suffixes.CROWDED, 1])
def test_bytes_as_by_brute_force(spark, monkeypatch, crowded):
    monkeypatch.setattr(suffixes, "CROWDED", crowded)
    rows = corpus(1)
    found = map(tuple, remove_repeated_bytes(frame(spark, rows)).collect())
    assert Counter(found) == Counter(brute_bytes(rows))


def test_words_as_by_brute_force(spark):
    rows = corpus(2)
    columns = "doc_id", "n_words", "n_removed", "kept_sha256"
    found = map(tuple, remove_repeated_words(frame(spark, rows)).select(*columns).collect())
    assert Counter(found) == Counter(brute_words(rows))


def test_empty_tables(spark):
    docs = frame(spark, corpus(3)[:1]).limit(0)
    assert remove_repeated_bytes(docs).count() == 0
    assert remove_repeated_words(docs).count() == 0


def test_text_keeps_whole_characters(spark):
    shared = "漢字" * 30
    rows = [(1, shared), (2, "a" + shared[:20] + "漢b")]
    found = remove_repeated_bytes(frame(spark, rows), "key", with_text=True)
    left = {r["doc_id"]: (r["text"], r["key"]) for r in found.collect()}
    assert left == {1: (shared, "k"), 2: ("ab", "k")}
    data = np.frombuffer("é漢a".encode(), np.uint8)
    gone = np.array([0, 1, 0, 0, 0, 0], bool)
    assert whole_characters(data, gone).tolist() == [True, True, False, False, False, False]


def test_suffixes_of_random_pieces():
    rng = random.Random(4)
    for _ in range(20):
        base = [bytes(rng.choices(range(97, 97 + rng.randint(1, 3)), k=90)) for _ in range(3)]
        pieces = []
        for _ in range(40):
            at = rng.randint(0, 30)
            pieces.append(rng.choice(base)[at : at + 50 + rng.randint(0, 8)] + bytes([rng.randint(0, 255)]))
        least = np.array([rng.randint(-5, 50) for _ in pieces])
        want = {}
        for piece, low in zip(pieces, least):
            for p in range(len(piece) - 49):
                w = piece[p : p + 50]
                want[w] = min(want.get(w, 99), low)
        found = least_documents(pieces, least)
        assert [x.tolist() for x in found] == [
            [want[piece[p : p + 50]] for p in range(len(piece) - 49)] for piece in pieces
        ]


def test_every_window_is_in_one_stretch_with_its_anchor():
    rng = random.Random(5)
    data = np.array([rng.randint(0, 3) for _ in range(400)], np.uint8)
    found = stretches(BYTE_SYMBOLS[data], 50, 16)
    assert found.windows.sum() == 400 - 49
    assert (found.start[1:] == (found.start + found.windows)[:-1]).all()
    again = stretches(BYTE_SYMBOLS[data[60:300]], 50, 16)
    assert set(again.anchor) <= set(found.anchor)


def test_paths_of_a_graph(spark):
    # 1 -> 2 -> 3 in a row, 4 branches off after 3, and 5, 6 are a ring.
    edges = [
        (11, 3, 100, 101), (12, 1, 101, 102), (13, 2, 102, 103), (14, 1, 103, 104),
        (15, 1, 103, 105), (16, 1, 200, 201), (17, 1, 201, 200), (18, 1, 300, 300),
    ]
    # Edges 11 and 12 lie side by side in document 1, the others are from other documents.
    places = [(1, 0, 5), (1, 0, 8), *[(k, 0, 0) for k in range(2, 8)]]
    table = spark.createDataFrame(
        [(*e, *p) for e, p in zip(edges, places)],
        "kmer long, windows int, left long, right long, doc long, tag int, at int",
    )
    found = {r["kmer"]: (r["path"], r["position"]) for r in compact(table).collect()}
    assert found == {
        11: (11, 0), 12: (11, 3), 13: (11, 4), 14: (14, 0), 15: (15, 0),
        16: (16, 0), 17: (17, 0), 18: (18, 0),
    }
