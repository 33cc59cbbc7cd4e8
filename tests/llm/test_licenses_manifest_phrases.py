"""Licence scan, Merkle manifest and phrases against brute force on small fixtures."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mailstream.llm import manifest, phrases
from mailstream.llm.licenses import BASE, NOTICES, Template, scan_licenses
from mailstream.llm.manifest import leaf_digest, merkle_manifest
from mailstream.llm.phrases import collocations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER = str.maketrans(CAPITALS, SMALL)


def documents(spark, rows):
    """Rows with further columns whose names operators use inside."""
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.withColumns({n: F.lit(7) for n in ("tree", "pos", "leaf", "words", "phrase", "__text", "n")})


def texts(spark, *some):
    return documents(spark, [(i, text, "en", "s", None) for i, text in enumerate(some)])


# Licence scan


def base_of(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for label, phrase in (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")):
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += found
        labels |= {label} if found else set()
    ends = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), *ends, ",".join(sorted(labels))


def test_base_phrases_are_found_at_all_places(spark):
    random.seed(3)
    vocabulary = "cc by CC general public license All rights reserved the é x1 of".split()
    some = [" ".join(random.choices(vocabulary, k=random.randrange(60))) for _ in range(300)]
    some += [None, "", " .,", "cc-by", "CC\nBY/cc by", "cc byé", "all rights reserved " * 20000]
    found = scan_licenses(texts(spark, *some, *some[:3])).collect()
    assert len(found) == len(some) + 3
    for row in found:
        text = (some + some[:3])[row["doc_id"]]
        assert tuple(row[name] for name in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == base_of(text)
        labels = set(row["labels"].split(","))
        assert not row["base_labels"] or set(row["base_labels"].split(",")) <= labels
        assert row["score"] == (1.0 if row["n_base"] else row["score"]) and 0 <= row["score"] <= 1


def test_notices_are_found_whole_and_slightly_changed(spark):
    filler = "the words of a text that says nothing about it and is used with or without all copies "
    some = []
    for template in NOTICES:
        words = template.text.split()
        some += [template.text, filler * 5 + template.text + ".\n" + filler, "; ".join(words).upper()]
    found = {r["doc_id"]: r for r in scan_licenses(texts(spark, *some)).collect()}
    for at, template in enumerate(NOTICES):
        for k in range(3):
            row = found[3 * at + k]
            assert template.label in row["labels"].split(","), (template, k)
            assert row["score"] >= 0.7
        assert found[3 * at]["score"] == 1.0
    changed = "The software here is hereby licensed really under of the Apache License, Version 2.0"
    row = scan_licenses(texts(spark, changed)).first()
    assert row["labels"] == "apache-2.0" and 0.7 <= row["score"] <= 1


def test_texts_without_a_notice_have_none(spark):
    some = [
        "the license of the software is under the version of the public in the MIT building",
        "permission is granted to use the work",
        " ".join(reversed(NOTICES[3].text.split())),  # all words, not in order
        "licensed under the foundation " * 50,
        "mozilla " + "x " * 60 + "public license v 2 0",  # key words too far apart
    ]
    for row in scan_licenses(texts(spark, *some)).collect():
        assert row["labels"] == "" and row["score"] == 0.0, row


def test_templates_are_a_parameter_and_empty_tables_are_empty(spark):
    mine = (Template("mine", "do what you like with it", ("what you like",)),)
    found = scan_licenses(texts(spark, "You may do what you like with it!"), base=BASE, notices=mine).first()
    assert (found["labels"], found["score"], found["n_base"]) == ("mine", 1.0, 0)
    assert scan_licenses(texts(spark, "a").limit(0)).collect() == []


# Merkle manifest


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def nodes_above(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([digest("".join(level[i : i + 16])) for i in range(0, len(level), 16)])
    return levels


def steps(levels, at):
    for level in levels[:-1]:
        first = at // 16 * 16
        yield level[first:at], level[at + 1 : first + 16]
        at //= 16


def tampered(row):
    if row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 5:
        return row["text"]
    return None if row["text"] is None else row["text"].translate(LOWER)


def manifest_of(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for some in by_source.values():
        some.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
    trees = {s: nodes_above([leaf_of(r, r["text"]) for r in by_source[s]]) for s in order}
    top = nodes_above([trees[s][-1][0] for s in order])
    root = top[-1][0]
    for number, source in enumerate(order):
        for at, row in enumerate(by_source[source]):
            path = [*steps(trees[source], at), *steps(top, number)]
            folded = leaf_of(row, tampered(row))
            for before, after in path:
                folded = digest("".join([*before, folded, *after]))
            proof = digest("".join(d for step in path for side in step for d in side))
            yield (row["doc_id"], trees[source][0][at], trees[source][-1][0], root, proof, folded, folded == root)


def manifest_query(docs, levels):
    small = F.translate(docs["text"], CAPITALS, SMALL)
    changed = F.crc32(docs["doc_id"].cast("string")) % 5 == 0
    found = merkle_manifest(docs, F.when(changed, leaf_digest(docs, text=small)), levels)
    return sorted((tuple(row)[:7] for row in found.collect()), key=str)


@pytest.mark.parametrize("levels", [0, 1])
def test_manifest_is_that_of_brute_force(spark, levels):
    """A hot source, many small ones, nulls everywhere, repeated ids and rows."""
    random.seed(levels)
    sources = [None, "", "é", "z", *["hot"] * 8, *(f"x{i}" for i in range(40))]
    rows = [
        (random.choice([None, *range(300)]), random.choice([None, "", "Ab", "A b é"]), None, random.choice(sources), random.choice([None, 3]))
        for _ in range(700)
    ]
    docs = documents(spark, rows)
    want = sorted(manifest_of([r.asDict() for r in docs.collect()]), key=str)
    assert manifest_query(docs, levels) == want


def test_manifest_of_few_rows(spark):
    """One row, one source of 17 (a run of one), and none at all."""
    one = documents(spark, [(5, "T", "en", "s", 1)])
    [row] = manifest_query(one, 3)
    assert row[1] == row[2] == row[3] == leaf_of(one.first().asDict(), "T") and row[4] == digest("")
    many = documents(spark, [(i, f"T{i}", "en", "s", i) for i in range(17)])
    assert manifest_query(many, 1) == sorted(manifest_of([r.asDict() for r in many.collect()]), key=str)
    assert manifest_query(many.limit(0), 3) == []
    assert manifest.FANOUT**manifest.BLOCK_LEVELS == 4096


def test_untouched_rows_verify(spark):
    docs = documents(spark, [(i, f"t{i}", "en", f"s{i % 3}", i) for i in range(60)])
    assert merkle_manifest(docs).where("not verified").count() == 0


# Phrases


def phrases_of(rows, top, least):
    f = Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                f.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    long = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for lang in {p[0] for p in f}:
        n = sum(a for p, a in f.items() if len(p) == 2 and p[0] == lang)
        found = []
        for (own, *words), a in long.items():
            longer = [b for (o, *w), b in long.items() if o == lang and len(w) > len(words)
                      and any(w[i : i + len(words)] == words for i in range(len(w)))]
            if own != lang or any(100 * b >= 50 * a for b in longer):
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = f[(lang, *words[:k])], f[(lang, *words[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(words).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrase_rows():
    random.seed(8)
    words = "a B c dé é f.g h, i; j:k l!m n?o p\nq r\x0bs t\x0cu v\rw x\ty \x1dz \x00 ü".split(" ")
    rows = []
    for i in range(400):
        text = " ".join(random.choices(words[: 4 + i % 20], k=random.randrange(40)))
        rows.append((random.choice([None, i]), text, random.choice(["en", "en", None, "und", "fr"]), "s", 0))
    rows += [(1, None, "en", None, None), (2, "", None, None, None), (3, " \t.,", "xx", None, None)]
    return rows + rows[:40] + [(9, "hot pair here " * 5000, "en", "s", 0)]


@pytest.mark.parametrize(("top", "least"), [(2000, 10), (7, 3)])
def test_phrases_are_those_of_brute_force(spark, top, least):
    rows = phrase_rows()
    found = collocations(documents(spark, rows), top, least).collect()
    assert sorted(map(tuple, found)) == phrases_of(rows, top, least)


def test_phrases_across_runs(spark, monkeypatch):
    """Texts longer than what a task sorts at once."""
    monkeypatch.setattr(phrases, "RUN", 7)
    rows = phrase_rows()[:120]
    found = collocations(documents(spark, rows), 2000, 3).collect()
    assert sorted(map(tuple, found)) == phrases_of(rows, 2000, 3)


def test_products_beyond_64_bits_are_exact(spark):
    counts = spark.createDataFrame([(7_000_000_000_123, 9_000_000_000_457, 8_999_999_999_999)], "a long, l long, r long")
    score = counts.select(phrases._cut_score(F.col("l"), F.col("r"))).first()[0]
    assert score == 1_000_000 * 7_000_000_000_123**2 // (9_000_000_000_457 * 8_999_999_999_999)


def test_no_phrases(spark):
    assert collocations(documents(spark, []), 2000, 10).collect() == []
    assert collocations(texts(spark, None, "", "a b c"), 2000, 10).collect() == []


def test_tasks_send_no_phrases_with_rare_parts(spark, monkeypatch):
    """Rare phrases of frequent words stay where they are; the result is whole."""
    sent, runs = [], phrases._runs

    def watched(*args):
        sent.append(runs(*args))
        return sent[-1]

    monkeypatch.setattr(phrases, "_runs", watched)
    random.seed(3)
    common = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(random.choices(common, k=40)), "en", "s", 0) for i in range(100)]
    rows += [(900 + i, f"x{i} here it stands y{i}", "en" if i % 2 else None, "s", 0) for i in range(60)]
    rows += [(990, "é " * 30 + "z" * 70 + " " + "\x0b" * 3, "fr", "s", 0)]
    found = collocations(documents(spark, rows), 2000, 10).collect()
    assert sorted(map(tuple, found)) == phrases_of(rows, 2000, 10)
    assert any(r["phrase"] == "here it stands" for r in found)
    single, double, triple = (df.count() for df in sent)
    assert single > 240 and double < 3800 and triple < 20
