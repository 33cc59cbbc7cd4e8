"""The pipeline's stages on planted documents."""

import corpus_pipeline
from mailstream.llm.jaccard import jaccard_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    rows = [(i, text, "en", "s", len(text or "")) for i, text in rows]
    return spark.createDataFrame(rows, SCHEMA)


def likeness(a, b, size=5):
    a, b = (
        {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} for w in (a.split(), b.split())
    )
    return len(a & b) / len(a | b)


def test_near_copies_from_80_percent_go(spark):
    rows, gone = [], set()
    for k in range(4):
        words = [f"w{k}x{i}" for i in range(200)]
        text = " ".join(words)
        rows.append((100 * k, text))
        for n in (25, 35, 48, 60):  # an ending is added
            rows.append((100 * k + n, f"{text} " + " ".join(f"e{k}x{n}x{i}" for i in range(n))))
        for n in (3, 4, 6):  # single words are exchanged
            mine = list(words)
            for i in range(n):
                mine[20 + 25 * i] = f"v{k}x{n}x{i}"
            rows.append((100 * k + n, " ".join(mine)))
        for i, other in rows[-7:]:
            if likeness(text, other) >= 0.8:
                assert likeness(text, other) < 0.9
                gone.add(i)
    assert len(gone) == 4 * 5
    left = corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), "")
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in rows} - gone


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = ([f"{k}{i}" for i in range(60)] for k in "abcd")
    ending = [f"z{i}" for i in range(8)]
    rows = [
        (1, " ".join(a)), (1, " ".join(b)),  # one doc_id, texts that have nothing in common
        (2, " ".join(c)), (3, " ".join(a + ending)), (3, " ".join(d)), (2, " ".join(c)),
        (None, " ".join(a)), (None, "e f g"), (None, "E  f g"), (None, "h i j"),
        (None, ""), (None, None), (4, " "),
    ]
    left = corpus_pipeline.near_duplicate_stage(spark, frame(spark, rows), "").collect()
    assert {r["text"].lower().split()[0] for r in left if (r["text"] or "").strip()} == {
        "a0", "b0", "c0", "d0", "e", "h",
    }
    assert len(left) == 6 + 3
    assert {(r["doc_id"], r["text"]) for r in left} >= {(1, rows[0][1]), (3, rows[4][1]), (4, " ")}


def test_rows_without_id_link_others(spark):
    words = [f"w{i}" for i in range(100)]
    cut = [" ".join(words[:n]) for n in (90, 81, 100)]
    # 5 and 6 are linked only through the row without doc_id.
    docs = frame(spark, [(None, cut[0]), (5, cut[1]), (6, cut[2])])
    found = jaccard_components(docs, 88, 5).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(None, 5), (5, 5), (6, 5)}
