"""Licence notices in texts, through a positional index of rare words.

Templates are the words of licence notices and, at their places, the key phrases that a text
must hold.  The index has the postings (template, place) of every word of every template; it
is as large as the templates, whatever the corpus.  How rare these words are is counted over
all documents: the inverse document frequency of each, one row a word.

For each text its rarest licence words are looked up: those that are among the `VOTERS`
rarest of some template, however many.  A posting and a place in the text give the place
where the template would begin; templates on which enough of their voters agree, up to small
shifts, are candidates.  A candidate is verified: its
mandatory phrases must stand in order inside its stretch of the text, and so must the given
share of its words.  A base phrase is a template that is its own mandatory phrase: its rarest
word finds every place where it can stand, and the other words are checked by their places.

Words are runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` of the text with A-Z lower-cased.
Null and empty texts have no words, no labels and score 0.  Each row is judged by itself:
doc_ids may be null or repeat, other columns do not matter, except that their texts count
towards how rare a word is.  Equal rarity is settled by the word's bytes.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailstream.llm.common import slices, text_or_empty

CAPITALS, SMALL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_SMALL = bytes.maketrans(CAPITALS, SMALL)
#: A word in the UTF-8 bytes of a lower-cased text.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Template(NamedTuple):
    """A licence notice: its label, its text, and phrases that it must hold, in order."""

    label: str
    text: str
    keys: tuple[str, ...]


# The phrases that are reported at all their places.
BASE = (
    Template("cc-by", "cc by", ("cc by",)),
    Template("gpl", "general public license", ("general public license",)),
    Template("reserved", "all rights reserved", ("all rights reserved",)),
)

# Opening or customary notices of public licences.
NOTICES = (
    Template("mit", "the MIT license", ("mit license",)),
    Template("mit", "released under the MIT license", ("mit license",)),
    Template("mit", "licensed under the MIT license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this"
        " permission notice appear in all copies",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template("apache-2.0", "licensed under the Apache license version 2 0", ("apache license version 2",)),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of"
        " the license at http www apache org licenses license 2 0",
        ("except in compliance with the license", "apache org licenses license 2"),
    ),
    Template(
        "gpl-2.0",
        "licensed under the GNU general public license version 2",
        ("gnu general public license version 2",),
    ),
    Template(
        "gpl-3.0",
        "licensed under the GNU general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of"
        " the GNU general public license as published by the free software foundation",
        ("you can redistribute it and or modify it", "gnu general public license as published"),
    ),
    Template(
        "lgpl",
        "licensed under the GNU lesser general public license",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl",
        "licensed under the GNU affero general public license",
        ("gnu affero general public license",),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the Mozilla public license v 2 0",
        ("mozilla public license v 2",),
    ),
    Template("cc-by-nc", "licensed under CC BY NC 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under CC BY SA 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under CC BY ND 4 0", ("cc by nd",)),
    Template(
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0",),
    ),
    Template(
        "cc0",
        "to the extent possible under law the author has waived all copyright and related or"
        " neighboring rights to this work",
        ("to the extent possible under law", "waived all copyright and related or neighboring rights"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software", "public domain"),
    ),
)

#: Rarest words of a template that are looked up in texts and vote for it.
VOTERS = 6
#: Share of a template's voters that must agree, and of its words that must be in place.
AGREE, IN_PLACE = 0.5, 0.7
#: Words that may have been put in or left out between two words of a template.
SHIFT = 4


def words_of_bytes(data: bytes) -> list[bytes]:
    return re.findall(WORD, data.translate(_SMALL))


class _Template(NamedTuple):
    label: str
    words: list[bytes]
    keys: list[list[bytes]]


class _Index(NamedTuple):
    """Templates, how many vote for each, postings of voters, and words' ranks by rarity."""

    templates: list[_Template]
    voters: list[int]
    postings: dict[bytes, list[tuple[int, int]]]
    rank: dict[bytes, int]


def _parsed(templates: tuple[Template, ...]) -> list[_Template]:
    return [
        _Template(t.label, words_of_bytes(t.text.encode()), [words_of_bytes(k.encode()) for k in t.keys])
        for t in templates
    ]


def licence_words(*templates: tuple[Template, ...]) -> list[bytes]:
    return sorted({word for some in templates for t in _parsed(some) for word in t.words})


def document_frequency(docs: DataFrame, vocabulary: list[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of texts, and of those that have each licence word: one row a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found, texts = set(vocabulary), dict.fromkeys(vocabulary, 0), 0
        for batch in batches:
            for part in slices(batch):
                for data in part.column("text").to_pylist():
                    texts += 1
                    for word in known.intersection(words_of_bytes(data)):
                        found[word] += 1
        words = [None, *found]
        counts = [texts, *found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts)], ["word", "n"])

    texts = docs.select(text_or_empty().cast("binary").alias("text"))
    counted = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {row["word"] and bytes(row["word"]): row["n"] for row in counted.collect()}
    return found.pop(None, 0), found


def inverse_frequency(texts: int, frequency: Mapping[bytes, int]) -> dict[bytes, float]:
    return {word: math.log((1 + texts) / (1 + n)) for word, n in frequency.items()}


def _index(templates: tuple[Template, ...], idf: Mapping[bytes, float]) -> _Index:
    parsed = _parsed(templates)
    rarest_first = sorted(idf, key=lambda word: (-idf[word], word))
    rank = {word: at for at, word in enumerate(rarest_first)}
    postings: dict[bytes, list[tuple[int, int]]] = {}
    voters = []
    for number, template in enumerate(parsed):
        rarest = set(sorted(set(template.words), key=rank.__getitem__)[:VOTERS])
        voters.append(len(rarest))
        for place, word in enumerate(template.words):
            if word in rarest:
                postings.setdefault(word, []).append((number, place))
    return _Index(parsed, voters, postings, rank)


def _places(words: list[bytes], known: Mapping[bytes, int]) -> dict[bytes, list[int]]:
    """Where each licence word stands in a text."""
    places: dict[bytes, list[int]] = {}
    for at, word in enumerate(words):
        if word in known:
            places.setdefault(word, []).append(at)
    return places


class _Text:
    """A text's words, the places of licence words, and of phrases once they are asked for."""

    def __init__(self, data: bytes, rank: Mapping[bytes, int]):
        self.words = words_of_bytes(data)
        self.rank = rank
        self.places = _places(self.words, rank)
        self._phrases: dict[tuple[bytes, ...], list[int]] = {}

    def begins(self, phrase: list[bytes]) -> list[int]:
        """All places of a phrase: those its rarest word allows, checked word by word."""
        key = tuple(phrase)
        if key not in self._phrases:
            found = []
            if all(word in self.places for word in phrase):
                rare = min(range(len(phrase)), key=lambda at: (self.rank[phrase[at]], at))
                found = [
                    at - rare
                    for at in self.places[phrase[rare]]
                    if at >= rare and self.words[at - rare : at - rare + len(phrase)] == phrase
                ]
            self._phrases[key] = found
        return self._phrases[key]


def _candidates(text: _Text, index: _Index) -> Iterator[tuple[int, int]]:
    """(template, begin) wherever enough of a template's rarest words agree."""
    votes: dict[int, list[tuple[int, bytes]]] = {}
    for word in text.places.keys() & index.postings.keys():
        for template, place in index.postings[word]:
            some = votes.setdefault(template, [])
            some.extend((at - place, word) for at in text.places[word])
    for template, some in sorted(votes.items()):
        need = math.ceil(AGREE * index.voters[template])
        some.sort()
        first = 0
        for last, (begin, _) in enumerate(some):
            while begin - some[first][0] > SHIFT:
                first += 1
            if len({word for _, word in some[first : last + 1]}) >= need:
                yield template, some[first][0]


def _share_in_place(text: _Text, template: _Template, begin: int) -> float:
    """The share of a template's words in place, 0 unless its key phrases stand in order."""
    words = text.words
    low, high = max(0, begin - SHIFT), begin + len(template.words) + 2 * SHIFT
    at = low
    for phrase in template.keys:
        begins = text.begins(phrase)
        nearest = bisect_left(begins, at)
        if nearest == len(begins) or begins[nearest] + len(phrase) > high:
            return 0.0
        at = begins[nearest] + len(phrase)
    in_place, at = 0, low
    for place, word in enumerate(template.words):
        near = range(max(at, begin + place - SHIFT), min(len(words), begin + place + 2 * SHIFT + 1))
        here = next((n for n in near if words[n] == word), None)
        if here is not None:
            in_place, at = in_place + 1, here + 1
    share = in_place / len(template.words)
    return share if share >= IN_PLACE else 0.0


def _scan(data: bytes, base: _Index, notices: _Index) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of a text."""
    text = _Text(data, base.rank)
    places = {t.label: text.begins(t.words) for t in base.templates}
    base_labels = {label for label, begins in places.items() if begins}
    begins = [at for some in places.values() for at in some]
    best: dict[int, float] = {}
    for number, begin in _candidates(text, notices):
        if best.get(number, 0.0) < 1:
            share = _share_in_place(text, notices.templates[number], begin)
            best[number] = max(best.get(number, 0.0), share)
    labels = base_labels | {notices.templates[n].label for n, share in best.items() if share}
    score = max([1.0 if begins else 0.0, *best.values()])
    first, last = (min(begins), max(begins)) if begins else (None, None)
    names = [",".join(sorted(some)) for some in (base_labels, labels)]
    return len(text.words), len(begins), first, last, *names, score


RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)


def scan_licenses(
    docs: DataFrame,
    *carried: Column,
    base: tuple[Template, ...] = BASE,
    notices: tuple[Template, ...] = NOTICES,
) -> DataFrame:
    """`carried` columns (default doc_id) and, for each row, what `RESULT` names.

    n_base, first_word and last_word are the number of places of base phrases and the first
    and last word at which one begins; the score is the greatest share of a found notice's
    words that are in place, 1 for a base phrase.
    """
    texts, frequency = document_frequency(docs, licence_words(base, notices))
    idf = inverse_frequency(texts, frequency)
    names = [part.split()[0] for part in RESULT.split(", ")]
    types = [pa.string() if "string" in p else pa.float64() if "double" in p else pa.int64()
             for p in RESULT.split(", ")]
    kept = docs.select(*(carried or (docs["doc_id"],)), text_or_empty().cast("binary").alias("__text"))
    columns = kept.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_index, notice_index = _index(base, idf), _index(notices, idf)
        for batch in batches:
            for part in slices(batch):
                rows = [_scan(data, base_index, notice_index) for data in part.column("__text").to_pylist()]
                found = [
                    pa.array([row[at] for row in rows], kind) for at, kind in enumerate(types)
                ]
                own = [part.column(name) for name in columns]
                yield pa.RecordBatch.from_arrays([*own, *found], [*columns, *names])

    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kept.schema[:-1])
    return kept.mapInArrow(run, f"{kinds}, {RESULT}")
