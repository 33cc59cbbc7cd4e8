"""Phrases whose words stand together more often than apart, for each language.

The counts of all phrases of one, two and three words are three streams.  Tasks sort the
phrases of a million words at a time and add up equal neighbours; one shuffle for each stream
adds up the runs, so a phrase that is a third of the input arrives as one row per run.  A
phrase of which a candidate consists is at least as frequent as the candidate, so streams
hold the phrases that reach the least count and no others, and tasks leave aside a phrase
before they sort it if one of its two parts that are a word shorter has no bit in a bitmap of
fixed size, in which each phrase of that length that reaches the least count has one (others
may share it, and what they let through is counted and dropped as before).  Streams are merged in lockstep
(sorted merge joins, no hash tables), in prefix order (first words first), where a phrase
meets the count of its left part and of its extensions to the right, and in suffix order,
where it meets the count of its right part and of its extensions to the left.

A text is lower-cased (A-Z only), cut into pieces at `[.,;:!?\\x0A-\\x0D]`, and a piece into
words `[^\\x20\\x09]+`; phrases do not cross pieces.  Everything is per language; null counts
as `und`.  Null and empty texts hold no words, repeated rows count as often as they occur,
doc_id does not matter (null and repeated ones are like others), other columns neither.  A
language without candidates has no rows; an empty table gives an empty result.  Ties are
broken by count and by the phrase's bytes, so the result is the same in each run.  Counts up
to 10**15 are exact, products of them too (38 digits).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailstream.llm.common import slices, text_or_empty, written
from mailstream.llm.stretches import BASE, U64, mix, word_hashes

CAPITALS, SMALL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
#: Bytes at which a text is cut, all of them as one, and those that separate words.
CUTS, CUT, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\n", b"\x20\x09"
_MARKS = bytes.maketrans(CAPITALS + CUTS + BLANKS, SMALL + CUT * len(CUTS) + b" " * len(BLANKS))
#: Words of a run that a task sorts at once; fewer than 2**WORD_BITS.
RUN, WORD_BITS = 1_000_000, 21
NO_LANGUAGE = "und"
#: Bits of a bitmap, as a power of two (4 MB), whatever the input.
BITMAP_BITS = 25
#: Words that are looked up in it at a time.
SLICE = 1 << 15
#: Words of the longest candidate, the least count, phrases reported for each language.
LONGEST, LEAST, TOP = 3, 10, 2000
#: A phrase goes if a longer candidate has this share of its places.
COVERED_PERCENT = 50
SCORE_UNIT = 1_000_000
COUNT = "decimal(15,0)"


def _tokens(data: bytes) -> list[bytes]:
    """The words of a text's bytes, in order, with a `CUT` wherever a piece ends."""
    marked = data.translate(_MARKS).replace(CUT, b" " + CUT + b" ")
    return [word for word in marked.split(b" ") if word] + [CUT]


def _names(words: int) -> list[str]:
    return [f"w{at + 1}" for at in range(words)]


def _bits(hashes: np.ndarray, words: int, lang: str) -> np.ndarray:
    """The bit of each phrase of so many words in a row, from the hashes of the words."""
    seed = hashlib.blake2b(lang.encode(), digest_size=8).digest()
    begin = max(0, len(hashes) - words + 1)
    found = np.full(begin, int.from_bytes(seed, "little"), U64)
    for at in range(words):
        found = mix(found * U64(BASE) + hashes[at : at + begin])
    return (found >> U64(64 - BITMAP_BITS)).astype(np.int64)


def _bitmap(stream: DataFrame, words: int) -> np.ndarray:
    """Bits, packed, of the phrases of a stream; tasks turn them on, Spark brings them together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("phrase").to_pylist()
            # A phrase and the next are apart: only every so manieth row of words is one.
            hashes = word_hashes(np.frombuffer(" ".join(texts).encode(), np.uint8))
            langs = batch.column("lang").dictionary_encode()
            numbers, at = langs.indices.to_numpy(), np.zeros(len(texts), np.int64)
            for number, lang in enumerate(langs.dictionary.to_pylist()):
                own = numbers == number
                some = hashes.reshape(-1, words)[own].ravel()
                at[own] = _bits(some, words, lang)[::words]
            cells, place = np.unique(at >> 6, return_inverse=True)
            bits = np.zeros(len(cells), U64)
            np.bitwise_or.at(bits, place, U64(1) << (at & 63).astype(U64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array(bits.view(np.int64))], ["cell", "bits"]
            )

    rows = stream.select("lang", "phrase").mapInArrow(run, "cell long, bits long")
    # No more rows than the bitmap has cells of 64 bits, whatever the input.
    found = rows.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    bitmap[found.column("cell").to_numpy()] = found.column("bits").to_numpy()
    return bitmap


def _frequent(
    vocabulary: list[bytes], ids: np.ndarray, words: int, lang: str, bitmap: np.ndarray
) -> np.ndarray:
    """Which phrases of so many words in a row may reach the least count."""
    hashes = np.zeros(len(vocabulary), U64)
    named = np.array([word != CUT for word in vocabulary])
    data = b" ".join(word for word in vocabulary if word != CUT)
    hashes[named] = word_hashes(np.frombuffer(data, np.uint8))

    def marked(some: np.ndarray) -> np.ndarray:
        at = _bits(some, words, lang)
        return (bitmap[at >> 6] >> (at & 63)) & 1 == 1

    if words == 1:
        return marked(hashes)[ids]
    found = np.zeros(max(0, len(ids) - words + 1), bool)
    for start in range(0, len(found), SLICE):
        some = hashes[ids[start : start + SLICE + words - 1]]
        found[start : start + SLICE] = marked(some)
    return found


def _sorted_run(
    tokens: list[bytes], words: int, lang: str, bitmap: np.ndarray | None = None
) -> tuple[pa.Array, np.ndarray]:
    """The phrases of so many words that begin in `tokens`, in prefix order, and their counts.

    Words get numbers in their order; a phrase is its words' numbers side by side, and equal
    ones are neighbours once these are sorted.  Those of which `bitmap` rules out a part are
    left aside.
    """
    vocabulary = sorted(set(tokens))
    number = {word: at for at, word in enumerate(vocabulary)}
    ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    whole = ids != number.get(CUT, -1)
    del number
    begin = max(0, len(ids) - words + 1)
    inside = np.ones(begin, bool)
    for at in range(words):
        inside &= whole[at : at + begin]
    if bitmap is not None and begin:
        likely = _frequent(vocabulary, ids, words - 1, lang, bitmap)
        inside &= likely[:begin] & likely[1 : begin + 1]
    key = np.zeros(int(inside.sum()), np.int64)
    for at in range(words):
        key = (key << WORD_BITS) | ids[at : at + begin][inside]
    keys, counts = np.unique(key, return_counts=True)
    del key, ids
    names = pa.array(vocabulary, pa.binary()).cast(pa.string())
    shifts = range(WORD_BITS * (words - 1), -1, -WORD_BITS)
    parts = [names.take(pa.array((keys >> shift) & ((1 << WORD_BITS) - 1))) for shift in shifts]
    return pc.binary_join_element_wise(*parts, " "), counts


def _runs(docs: DataFrame, words: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """lang, phrase, n: each task's phrases of so many words, as sorted runs of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}

        def counted(lang: str, tokens: list[bytes]) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(tokens), RUN):
                # The last phrases of a run reach into the next one.
                part = tokens[start : start + RUN + words - 1]
                phrases, n = _sorted_run(part, words, lang, bitmap)
                columns = [pa.array([lang]).take(pa.array(np.zeros(len(n), int))), phrases, n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) if isinstance(c, np.ndarray) else c for c in columns],
                    ["lang", "phrase", "n"],
                )

        held = 0
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                for lang, data in zip(part.column("lang").to_pylist(), texts, strict=True):
                    tokens = _tokens(data)
                    waiting.setdefault(lang, []).extend(tokens)
                    held += len(tokens)
                    if held >= RUN:
                        for name, some in waiting.items():
                            yield from counted(name, some)
                        waiting, held = {}, 0
        for name, some in waiting.items():
            yield from counted(name, some)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    texts = docs.select(lang, text_or_empty().cast("binary").alias("text"))
    return texts.mapInArrow(run, "lang string, phrase string, n long")


def _counts(docs: DataFrame, words: int, bitmap: np.ndarray | None = None) -> DataFrame:
    """lang, phrase, f: what all runs hold of a phrase; a hot phrase is one row per run."""
    return _runs(docs, words, bitmap).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _stream(counts: DataFrame, words: int, least: int) -> DataFrame:
    """lang, phrase, its words w1.., f: the phrases that reach `least`."""
    parts = F.split("phrase", " ")
    columns = [F.get(parts, F.lit(at)).alias(name) for at, name in enumerate(_names(words))]
    return counts.where(F.col("f") >= least).select("lang", "phrase", *columns, "f")


def _merged(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Two streams merged in the order of `keys`."""
    return left.hint("merge").join(right.hint("merge"), ["lang", *keys], how)


def _part(streams: dict[int, DataFrame], names: list[str], count: str) -> DataFrame:
    """The stream of phrases as long as `names`, its words by these names, f as `count`."""
    stream = streams[len(names)]
    words = [F.col(own).alias(name) for own, name in zip(_names(len(names)), names, strict=True)]
    return stream.select("lang", *words, F.col("f").alias(count))


def _cut_score(left: Column, right: Column) -> Column:
    """floor(10**6 a a / (left right)), exactly; at most 10**6, as no part is rarer than a."""
    a = F.col("a").cast(COUNT)
    above = F.lit(SCORE_UNIT).cast("decimal(7,0)") * a * a
    return F.call_function("div", above, left.cast(COUNT) * right.cast(COUNT))


def _scored(streams: dict[int, DataFrame], words: int) -> DataFrame:
    """lang, phrase, w1.., a and the lowest-scoring cut's l, r, score."""
    names = _names(words)
    rows = streams[words].withColumnRenamed("f", "a")
    cuts = []
    for cut in range(1, words):  # prefix order: left parts
        rows = _merged(rows, _part(streams, names[:cut], f"l{cut}"), names[:cut])
    for cut in range(1, words):  # suffix order: right parts
        rows = _merged(rows, _part(streams, names[cut:], f"r{cut}"), names[cut:])
        left, right = F.col(f"l{cut}"), F.col(f"r{cut}")
        score = _cut_score(left, right)
        cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("k"), left.alias("l"), right.alias("r")))
    lowest = F.array_min(F.array(*cuts))
    return rows.select("lang", "phrase", *names, "a", lowest.alias("cut")).select(
        "lang", "phrase", *names, "a", "cut.l", "cut.r", "cut.score"
    )


def _uncovered(rows: DataFrame, streams: dict[int, DataFrame], words: int) -> DataFrame:
    """Without phrases that a longer candidate holds at too many of their places.

    A phrase inside a candidate that is longer by several words lies in one that is longer
    by one word and at least as frequent, so extensions by one word decide.
    """
    if words == LONGEST:
        return rows
    longer, names = streams[words + 1], _names(words + 1)
    for inside, count in ((names[:-1], "right"), (names[1:], "left")):
        own = [F.col(name).alias(as_name) for name, as_name in zip(inside, _names(words), strict=True)]
        most = longer.select("lang", *own, "f").groupBy("lang", *_names(words)).agg(F.max("f").alias(count))
        rows = _merged(rows, most, _names(words), "left")
    extension = F.greatest(F.coalesce("right", F.lit(0)), F.coalesce("left", F.lit(0)))
    return rows.where(100 * extension < COVERED_PERCENT * F.col("a")).drop("right", "left")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases."""
    single = written(_counts(docs, 1), "phrases-1")
    streams = {1: _stream(single, 1, least)}
    for words in range(2, LONGEST + 1):
        bitmap = _bitmap(streams[words - 1], words - 1)
        counts = _counts(docs, words, bitmap)
        streams[words] = written(_stream(counts, words, least), f"phrases-{words}")
    sizes = single.groupBy("lang").agg(F.sum("f").alias("n"))
    kept = [
        _uncovered(_scored(streams, words), streams, words).drop(*_names(words))
        for words in range(2, LONGEST + 1)
    ]
    rows = reduce(DataFrame.unionByName, kept)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    first = rows.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return first.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
