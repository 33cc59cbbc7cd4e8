"""Exact Jaccard join of documents on word shingles, by pigeonhole over a cut universe.

A document is its set of distinct shingles (hashes of `shingle` words; ASCII capitals made
small; a shorter text is one shingle).  Sets of similar size share a size band; a band's
pairs differ in at most H shingles.  A hash cuts the universe of shingles into segments.
Of segments matched exactly and segments matched up to one deletion, e + 2 d > H are
enough for every linked pair to agree in one of them; `allocation` weighs the rows that
one-deletion neighbourhoods cost against the crowds that short segments draw.  Segments
that hold nothing in either set agree in all sets and would draw most of a band into one
crowd.  There are more segments than H asks for, and a set that has fewer empty ones than
that surplus leaves them out: what it agrees in with others is not only those.  Each set
indexes its segments under its own band and the one below, so a pair meets under the band
of its smaller set, and groups of bands are indexed one after another.

Equal sets are one class.  Classes that share a signature are verified on their whole
sets: first each class with the smallest of its bucket; then, where a bucket still holds
classes of different components, those of different components whose counts of shingles by
cells allow a link, pair by pair where such pairs are few and block by block where they are
many.  Long sets have finer cells besides, as 256 rule out few of their pairs.  Texts travel
in parts where those that meet take more room than all texts.  Links within a component change nothing and are not looked for again, so copies never
become all pairs, and no link between different components is lost.

Null or wordless text has an empty set and links with nothing.  Repeated rows are equal
sets.  Null doc_id links like any other but never names a component.  Only doc_id and text
are read; other columns do not matter.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailstream.llm.common import components, forget, slices, text_or_empty, written
from mailstream.llm.stretches import (
    OTHER_BASE,
    U64,
    mix,
    remembered,
    span_hashes,
    word_hashes,
)

#: What a class costs, in index rows, that meets others by a segment that holds nothing, and
#: one that meets those that have the only shingle of a segment.
CROWD_ROWS = 200.0
SINGLE_ROWS = 10.0
#: Groups of size bands, indexed one after another: each is about that part of the index.
BAND_GROUPS = 4
#: Classes of a block, and shingles of a block that are compared at a time.
BLOCK_SETS = 256
BLOCK_TOKENS = 8192
#: Classes of a bucket whose cells one task compares, and pairs of them at a time.
TILE_SETS = 2048
TILE_PAIRS = 1 << 14
#: Shingles for each of the finer cells of a set with more than 256 times as many, and most
#: cells of a set.
FINE_SHINGLES = 8
MOST_CELLS = 1 << 13
#: Likely pairs for each class of a tile, beyond which its classes meet in blocks instead.
DENSE_PAIRS = 8


def shingle_set(text: str, shingle: int = 3) -> np.ndarray:
    """Ascending distinct hashes of the shingles of a whole text."""
    data = np.frombuffer(text.encode(), np.uint8)
    capital = (data >= 65) & (data <= 90)
    words = word_hashes(np.where(capital, data + np.uint8(32), data))
    if not len(words):
        return np.zeros(0, U64)
    size = min(shingle, len(words))
    starts = np.arange(len(words) - size + 1)
    return np.unique(span_hashes(words, starts, starts + size, OTHER_BASE))


@remembered
def band_edges(percent: int, most: int = 1 << 40) -> tuple[int, ...]:
    """Smallest size of each band; a partner's size is in the same band or the next."""
    edges = [1]
    while edges[-1] < most:
        edges.append(100 * edges[-1] // percent + 1)
    return tuple(edges)


def _differences(percent: int, band: int) -> int:
    """The most shingles that only one of two linked sets has, the smaller one in the band."""
    smaller = band_edges(percent)[band + 1] - 1
    # |x| <= |y| <= |x| / t and |x & y| >= t |x | y| leave at most this many differences.
    return smaller * (100 - percent) // percent


def _empty(exact: float, deletions: float, each: float) -> tuple[float, float]:
    """Expected numbers of segments that hold nothing, and of one shingle at most."""
    nothing = math.exp(-each)
    return exact * nothing, deletions * nothing * (1 + each)


@remembered
def allocation(percent: int, band: int) -> tuple[int, int]:
    """Numbers of exactly matched and of one-deletion segments of a band."""
    edges = band_edges(percent)
    least, smaller = edges[band], edges[band + 1] - 1
    differences = _differences(percent, band)

    def weight(exact: int, deletions: int) -> tuple[float, float]:
        """What the empty segments of a small set of the band weigh: mean and deviation."""
        none, single = _empty(exact, deletions, least / (exact + deletions))
        return none + 2 * single, math.sqrt(none + 4 * single)

    best = (math.inf, differences + 1, 0)
    for deletions in range(min((differences + 2) // 2, 65) + 1):
        fewest = max(0, differences + 1 - 2 * deletions)
        # So many that nearly all sets have fewer empty ones than the surplus.
        many = max(fewest, 1)
        for _ in range(50):
            mean, deviation = weight(many, deletions)
            wanted = differences - 2 * deletions + math.ceil(mean + 4 * deviation) + 1
            if wanted <= many or wanted > 2 * smaller:
                break
            many = wanted
        for exact in {fewest, many}:
            segments = exact + deletions
            if not segments:
                continue
            each = smaller / segments
            mean, deviation = weight(exact, deletions)
            surplus = exact + 2 * deletions - differences
            indexed = 0.5 * math.erfc((surplus - 0.5 - mean) / (deviation * math.sqrt(2) + 1e-9))
            crowded = indexed * sum(_empty(exact, deletions, each))
            single = exact * each * math.exp(-each)
            cost = segments + deletions * each + CROWD_ROWS * crowded + SINGLE_ROWS * single
            best = min(best, (cost, exact, deletions))
    return best[1], best[2]


def signatures(hashes: np.ndarray, percent: int, bands: range | None = None) -> np.ndarray:
    """Segment signatures of one set under its band and the band below, if among `bands`.

    Linked sets agree in segments that weigh `surplus` or more (one-deletion segments two).
    Those that agree as empty, with at most the one shingle deleted, weigh no more than all
    such segments of either set.  So where one of two has less of them than the surplus, they
    agree in another segment too, and else both have indexed them.
    """
    edges = band_edges(percent)
    own = int(np.searchsorted(edges, len(hashes), side="right")) - 1
    out = []
    for band in (own, own - 1):
        if band < 0 or (bands is not None and band not in bands):
            continue
        exact, deletions = allocation(percent, band)
        segments = exact + deletions
        segment = ((hashes >> U64(33)) % U64(segments)).astype(np.int64)
        mixed = mix(hashes + U64(band + 1))
        sums = np.zeros(segments, U64)
        np.add.at(sums, segment, mixed)
        label = mix(np.arange(segments, dtype=U64) + U64((band + 1) << 32))
        held = np.bincount(segment, minlength=segments)
        surplus = exact + 2 * deletions - _differences(percent, band)
        empty = 2 * (held[:deletions] <= 1).sum() + (held[deletions:] == 0).sum()
        # The least shingles of a segment whose signature, or that without one, is indexed.
        least = int(empty < surplus)
        out.append(mix((sums ^ label)[held >= least]))
        if deletions:
            gone = (segment < deletions) & (held[segment] > least)
            at = segment[gone]
            out.append(mix((sums[at] - mixed[gone]) ^ label[at]))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, U64)


def band_groups(sizes: Mapping[int, int], percent: int, groups: int) -> list[range]:
    """Consecutive bands in about `groups` groups with as many signatures each.

    `sizes` tells how many sets each band has.  Sets meet under one band only, so groups can
    be indexed one after another; a band is never cut, so a group may be larger.
    """
    if not sizes:
        return []
    edges = band_edges(percent)

    def signed(band: int) -> float:
        exact, deletions = allocation(percent, band)
        each = edges[band] / (exact + deletions)
        rows = exact + deletions * (1 + each)
        return rows * (sizes.get(band, 0) + sizes.get(band + 1, 0))

    bands = range(max(min(sizes) - 1, 0), max(sizes) + 1)
    most = sum(map(signed, bands)) / groups
    found, start, held = [], bands.start, 0.0
    for band in bands:
        if held and held + signed(band) > most:
            found.append(range(start, band))
            start, held = band, 0.0
        held += signed(band)
    return [*found, range(start, bands.stop)]


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text of each row; the first two name a row even without doc_id."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def _map_sets(docs: DataFrame, schema: str, shingle: int, row) -> DataFrame:
    """Runs `row(doc_id, text_hash, set)`, which gives equally long columns, for each document."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [
                    row(doc_id, text_hash, shingle_set(text, shingle))
                    for doc_id, text_hash, text in zip(
                        part.column("doc_id").to_pylist(),
                        part.column("text_hash").to_pylist(),
                        part.column("text").to_pylist(),
                        strict=True,
                    )
                ]
                columns = [
                    pa.array(np.concatenate(column))
                    if isinstance(column[0], np.ndarray)
                    else pa.array([x for some in column for x in some])
                    for column in zip(*found, strict=True)
                ]
                if columns:
                    yield pa.RecordBatch.from_arrays(columns, names)

    return _rows(docs).mapInArrow(run, schema)


def _key(hashes: np.ndarray) -> np.ndarray:
    """A number for a set; the same for equal sets."""
    total = np.array([mix(hashes).sum(dtype=U64), U64(len(hashes))], U64)
    return mix(total[:1] ^ mix(total[1:])).view(np.int64)


def _cells(hashes: np.ndarray) -> bytes:
    """How many hashes of a set fall into each of 256 cells, 255 standing for that or more."""
    return _counts(hashes, 8)


def _counts(hashes: np.ndarray, bits: int) -> bytes:
    held = np.bincount((mix(hashes) >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(held, 255).astype(np.uint8).tobytes()


def _fine_cells(hashes: np.ndarray) -> bytes:
    """The same by finer cells, twice, four times .. as many; nothing for a short set."""
    cells = min(MOST_CELLS, len(hashes) // FINE_SHINGLES)
    return _counts(hashes, (cells - 1).bit_length()) if cells > 256 else b""


class _Levels:
    """Cells of some sets by level, 256 << level of them; finer ones are added up for coarser."""

    def __init__(self, cells: list[bytes]):
        self.level = np.array([(len(x) >> 8).bit_length() - 1 for x in cells], np.int64)
        self._held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rows, finer = np.zeros(0, np.int64), np.zeros((0, 512), np.uint8)
        for level in range(int(self.level.max(initial=0)), -1, -1):
            own = np.flatnonzero(self.level == level)
            data = b"".join([cells[i] for i in own])
            data = np.frombuffer(data, np.uint8).reshape(-1, 256 << level)
            if len(rows):
                # A cell that is full stays full.
                added = finer.reshape(len(rows), -1, 2).sum(axis=2, dtype=np.uint16)
                data = np.concatenate([data, np.minimum(added, 255).astype(np.uint8)])
            rows, finer = np.concatenate([own, rows]), data
            place = np.zeros(len(cells), np.int64)
            place[rows] = np.arange(len(rows))
            self._held[level] = place, data

    def at(self, level: int, rows: np.ndarray) -> np.ndarray:
        place, data = self._held[level]
        return data[place[rows]]


def _may_link_rows(
    x: _Levels, i: np.ndarray, y: _Levels, j: np.ndarray, sizes: np.ndarray, percent: int
) -> np.ndarray:
    """`_may_link` for rows i of x and j of y, by the cells that both have."""
    keep = np.zeros(len(i), bool)
    levels = np.minimum(x.level[i], y.level[j])
    for level in np.unique(levels).tolist():
        of_level = np.flatnonzero(levels == level)
        step = max(1, TILE_PAIRS >> level)
        for start in range(0, len(of_level), step):
            at = of_level[start : start + step]
            keep[at] = _may_link(x.at(level, i[at]), y.at(level, j[at]), sizes[at], percent)
    return keep


def _may_link(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets their cells do not rule out; `sizes` are those of both together.

    Two sets share no more than the lesser count of each cell, so no similar pair goes.
    """
    both = np.minimum(x, y)
    # Bytes are added in lanes of 16 bits, which 64 of them cannot fill.
    eight, even = both.view(np.uint64).reshape(len(both), -1, 32), U64(0x00FF00FF00FF00FF)
    lanes = (eight & even).sum(axis=2) + ((eight >> U64(8)) & even).sum(axis=2)
    most = lanes.view(np.uint16).sum(axis=1, dtype=np.int64)
    keep = 100 * most >= percent * (sizes - most)
    # Of a full cell only the least count is known.
    unsure = np.flatnonzero(~keep)
    keep[unsure] = (both[unsure] == 255).any(axis=1)
    return keep


def _likely(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their cells do not rule out.

    Most pairs of unlike sets go, before their texts travel.
    """
    first, second = (
        texts.select(*(F.col(x).alias(y) for x, y in zip(("key", "n_shingles", "cells"), names)))
        for names in (("a", "m", "x"), ("b", "n", "y"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2048):
                x, y = (_Levels(part.column(name).to_pylist()) for name in "xy")
                sizes = part.column("m").to_numpy() + part.column("n").to_numpy()
                row = np.arange(part.num_rows)
                keep = _may_link_rows(x, row, y, row, sizes, percent)
                yield part.filter(pa.array(keep)).select(["a", "b"])

    return pairs.join(second, "b").join(first, "a").mapInArrow(run, "a long, b long")


def _parts(meeting: DataFrame, texts: DataFrame) -> int:
    """How many times the texts of all sets those of `meeting` (key, ..) weigh, at least 1."""
    sizes = texts.select("key", "n_shingles")
    held = meeting.select("key").join(sizes, "key").agg(F.sum("n_shingles")).first()[0]
    return -(-(held or 0) // max(sizes.agg(F.sum("n_shingles")).first()[0] or 0, 1)) or 1


def _in_parts(rows: DataFrame, parts: int, by: list[str], run, purpose: str) -> DataFrame:
    """`run(part)` of the parts of `rows`, dealt by some columns and written one by one, so
    that the shuffles of one part lie on disk at a time."""
    if parts == 1:
        return run(rows)
    part = F.pmod(F.xxhash64(*by, F.lit(parts)), F.lit(parts))
    found = [written(run(rows.where(part == number)), purpose) for number in range(parts)]
    return reduce(DataFrame.unionByName, found)


def _all_verified(
    pairs: DataFrame, texts: DataFrame, percent: int, shingle: int
) -> DataFrame:
    """`_verified` in as many parts as the texts of `pairs` take room."""
    sets = texts.select("key", "text")
    parts = _parts(pairs.select(F.col("b").alias("key")), texts)
    return _in_parts(
        pairs, parts, ["a"], lambda some: _verified(some, sets, percent, shingle), "jaccard-part"
    )


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets are similar enough.

    Texts travel and become sets again here, as they take less room than their hashes.
    """
    first = texts.select(F.col("key").alias("a"), F.col("text").alias("x"))
    second = texts.select(F.col("key").alias("b"), F.col("text").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, np.zeros(0, U64)
        for batch in batches:
            for part in slices(batch):
                keep = []
                columns = (part.column(name).to_pylist() for name in "axy")
                for a, text, other in zip(*columns, strict=True):
                    # Rows come in the order of a.
                    if a != last:
                        last, x = a, shingle_set(text, shingle)
                    y = shingle_set(other, shingle)
                    at = np.searchsorted(y, x)
                    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                kept = part.filter(pa.array(keep, pa.bool_()))
                yield kept.select(["a", "b"])

    joined = pairs.join(second, "b").join(first, "a").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def _block_links(
    keys: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], second: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links that join different roots, no more than a tree of them.

    `second` tells the rows of the second block; pairs within the first are left to the
    pair of that block with itself.
    """
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rows, columns = np.flatnonzero(~second), np.flatnonzero(second)
    if not len(columns):
        rows = columns = np.arange(len(sets))
    common = np.zeros((len(rows), len(columns)), np.float32)
    for start in range(0, len(tokens), BLOCK_TOKENS):
        low, high = np.searchsorted(column, [start, start + BLOCK_TOKENS])
        held = np.zeros((len(sets), BLOCK_TOKENS), np.float32)
        held[owner[low:high], column[low:high] - start] = 1
        common += held[rows] @ held[columns].T
    either = sizes[rows][:, None] + sizes[columns] - common
    near = (100 * common >= percent * either) & (roots[rows][:, None] != roots[columns])
    chosen, found = {}, []

    def top(root: int) -> int:
        while root in chosen:
            root = chosen[root]
        return root

    for i, j in zip(*np.nonzero(near), strict=True):
        a, b = top(roots[rows[i]]), top(roots[columns[j]])
        if a != b:
            chosen[max(a, b)] = min(a, b)
            found.append((int(keys[rows[i]]), int(keys[columns[j]])))
    return found


def _tile_pairs(second: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Tile, first and second row of the pairs of some tiles, which begin at `begins`.

    A tile's rows of the first block stand before those of the second, if there are any;
    pairs within the first are then left to the tile of that block with itself.
    """
    ends = np.append(begins[1:], len(second))
    firsts = np.add.reduceat(~second, begins, dtype=np.int64)
    alone = firsts == ends - begins
    row = np.arange(len(second))
    tile = np.repeat(np.arange(len(begins)), ends - begins)
    # Rows that each row of a first block meets: those after it, or the second block.
    start = np.where(alone[tile], row + 1, (begins + firsts)[tile])
    count = np.where(second, 0, ends[tile] - start)
    bounds = np.concatenate([[0], np.cumsum(count)])
    for low in range(0, bounds[-1], TILE_PAIRS):
        at = np.arange(low, min(low + TILE_PAIRS, bounds[-1]))
        i = np.searchsorted(bounds, at, side="right") - 1
        yield tile[i], i, start[i] + at - bounds[i]


def _near_by_cells(placed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """signature, a, b: what the cells leave of the pairs of different roots in buckets.

    Without a signature (a, b) is a pair.  Where a tile, all or two blocks of a bucket, has
    more pairs than `DENSE_PAIRS` for each class, it gives its classes of such pairs alone,
    as a, with the signature.  So the rows grow with those of the tiles, not with the pairs.
    """
    sizes = placed.groupBy("signature").agg(
        F.ceil(F.count("*") / TILE_SETS).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = placed.join(sizes, "signature").withColumn("block", block).withColumn("other", other)
    rows = rows.select(
        "signature",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).alias("second"),
        "key",
        "root",
    )
    rows = rows.join(texts.select("key", "n_shingles", "cells"), "key")
    tile = ["signature", "low", "high"]
    rows = rows.repartition(*tile).sortWithinPartitions(*tile, "second")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < TILE_SETS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            begins = tiles(table)
            # The last tile may go on in the next batch.
            yield from compare(table.slice(0, begins[-1]), begins[:-1])
            held = table.slice(begins[-1]).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from compare(table, tiles(table))

    def tiles(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for name in tile:
            column = table.column(name).to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    def compare(table: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(begins):
            return
        signature, key, root, size = (
            table.column(x).to_numpy() for x in ("signature", "key", "root", "n_shingles")
        )
        cells = _Levels(table.column("cells").to_pylist())
        classes = np.diff(np.append(begins, len(key)))
        pairs = np.zeros(len(begins), np.int64)
        near = np.zeros(len(key), bool)
        waiting: list[tuple[np.ndarray, ...]] = []
        for owner, i, j in _tile_pairs(table.column("second").to_numpy(), begins):
            apart = root[i] != root[j]
            owner, i, j = owner[apart], i[apart], j[apart]
            keep = _may_link_rows(cells, i, cells, j, size[i] + size[j], percent)
            owner, i, j = owner[keep], i[keep], j[keep]
            pairs += np.bincount(owner, minlength=len(begins))
            near[i] = near[j] = True
            few = pairs[owner] <= DENSE_PAIRS * classes[owner]
            waiting.append((owner[few], i[few], j[few]))
        if not waiting:
            return
        owner, i, j = (np.concatenate(column) for column in zip(*waiting, strict=True))
        dense = pairs > DENSE_PAIRS * classes
        few = ~dense[owner]
        a, b = key[i[few]], key[j[few]]
        alone = near & np.repeat(dense, classes)
        none, no_pair = pa.nulls(len(a), pa.int64()), pa.nulls(int(alone.sum()), pa.int64())
        columns = [
            pa.concat_arrays([none, pa.array(signature[alone])]),
            pa.concat_arrays([pa.array(np.maximum(a, b)), pa.array(key[alone])]),
            pa.concat_arrays([pa.array(np.minimum(a, b)), no_pair]),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["signature", "a", "b"])

    found = rows.select(*tile, "second", "key", "root", "n_shingles", "cells")
    found = found.mapInArrow(run, "signature long, a long, b long")
    return found.distinct()


def _links_between(
    crowd: DataFrame,
    roots: DataFrame,
    texts: DataFrame,
    percent: int,
    shingle: int,
    fine: DataFrame | None = None,
) -> DataFrame:
    """Links between components that share a bucket.

    Pairs that cells do not rule out are verified; where they are many, by the finer cells
    (key, n_shingles, cells) of `fine` too, their classes meet in blocks.
    """
    placed = crowd.select("signature", "key").join(
        roots.withColumnRenamed("node", "key"), "key", "left"
    )
    placed = placed.select("signature", "key", F.coalesce("root", "key").alias("root"))
    buckets = placed.groupBy("signature").agg(F.min("root").alias("r"), F.max("root").alias("s"))
    buckets = buckets.where("r != s").select("signature")
    placed = written(placed.join(buckets, "signature"), "jaccard-open")
    pairs, dense = _sorted_out(placed, texts, percent)
    if fine is not None:
        if not dense.isEmpty():
            more, dense = _sorted_out(dense, fine, percent)
            pairs = pairs.unionByName(more).distinct()
        pairs = written(_likely(pairs, fine, percent), "jaccard-near-pairs")
    links = _all_verified(pairs, texts, percent, shingle)
    if dense.isEmpty():
        return links
    return links.unionByName(_links_in_blocks(dense, texts, percent, shingle))


def _sorted_out(
    placed: DataFrame, texts: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Likely pairs by the cells of `texts`, and the rows of `placed` that have too many."""
    near = written(_near_by_cells(placed, texts, percent), "jaccard-near")
    pairs = near.where("signature is null").select("a", "b")
    dense = near.where("signature is not null").select("signature", F.col("a").alias("key"))
    return pairs, written(placed.join(dense, ["signature", "key"]), "jaccard-dense")


def _links_in_blocks(
    placed: DataFrame, texts: DataFrame, percent: int, shingle: int
) -> DataFrame:
    """Links between roots in the buckets of `placed` (signature, key, root).

    Classes of buckets that hang together are dealt into blocks; each two blocks that share
    a bucket meet once, as a matrix product in one task, so that the rows of a large group
    grow with its blocks and never become pairs of classes.
    """
    first = placed.groupBy("signature").agg(F.min("key").alias("first"))
    together = components(
        placed.join(first, "signature").select(F.col("key").alias("a"), F.col("first").alias("b")),
        "jaccard-together",
    ).withColumnRenamed("root", "cluster")
    sizes = together.groupBy("cluster").agg(F.count("*").alias("classes"))
    block = F.pmod(
        F.xxhash64("node").cast("long"), F.ceil(F.col("classes") / BLOCK_SETS)
    ).cast("int")
    blocks = together.join(sizes, "cluster").select(
        F.col("node").alias("key"), "cluster", block.alias("block")
    )
    blocks = written(blocks, "jaccard-blocks")
    in_bucket = placed.join(blocks, "key").select("signature", "cluster", "block").distinct()
    second = in_bucket.select("signature", F.col("block").alias("other"))
    meetings = in_bucket.join(second, "signature").where("block <= other")
    meetings = meetings.select("cluster", "block", "other").distinct()
    classes = placed.select("key", "root").distinct().join(blocks, "key")
    first_side = meetings.join(classes, ["cluster", "block"]).withColumn("second", F.lit(False))
    second_side = meetings.where("block < other").join(
        classes.withColumnRenamed("block", "other"), ["cluster", "other"]
    )
    second_side = second_side.withColumn("second", F.lit(True))
    rows = written(first_side.unionByName(second_side), "jaccard-meetings")
    sets = texts.select("key", "text")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        hashes = [shingle_set(text, shingle) for text in group["text"]]
        keys, tops = group["key"].to_numpy(), group["root"].to_numpy()
        found = _block_links(keys, tops, hashes, group["second"].to_numpy(bool), percent)
        return pd.DataFrame(found, columns=["a", "b"])

    meeting = ["cluster", "block", "other"]

    def links(some: DataFrame) -> DataFrame:
        return some.join(sets, "key").groupBy(*meeting).applyInPandas(run, "a long, b long")

    return _in_parts(rows, _parts(rows, texts), meeting, links, "jaccard-part")


def _index(texts: DataFrame, percent: int, shingle: int, bands: range) -> DataFrame:
    """signature, key of the sets under some bands."""
    edges = band_edges(percent)
    # A set is signed under its own band and the one below.
    size = F.col("n_shingles")
    texts = texts.where((size >= edges[bands.start]) & (size < edges[bands.stop + 1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys = part.column("key").to_numpy()
                found = [
                    signatures(shingle_set(text, shingle), percent, bands).view(np.int64)
                    for text in part.column("text").to_pylist()
                ]
                if found:
                    keys = np.repeat(keys, [len(x) for x in found])
                    columns = [pa.array(np.concatenate(found)), pa.array(keys)]
                    yield pa.RecordBatch.from_arrays(columns, ["signature", "key"])

    return texts.select("key", "text").mapInArrow(run, "signature long, key long")


def _met(texts: DataFrame, percent: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Buckets of several classes, and the members of those of more than two.

    Groups of bands are indexed one after another, so that the shuffles of one group lie on
    disk at a time.
    """
    later = F.lit(list(band_edges(percent)[1:])).cast("array<long>")
    band = F.size(F.filter(later, lambda edge: edge <= F.col("n_shingles")))
    sizes = {r["band"]: r["count"] for r in texts.groupBy(band.alias("band")).count().collect()}
    buckets = texts.sparkSession.createDataFrame([], "signature long, b long, a long")
    crowd = texts.sparkSession.createDataFrame([], "signature long, key long, b long")
    for bands in band_groups(sizes, percent, BAND_GROUPS):
        index = _index(texts, percent, shingle, bands)
        found = written(
            index.groupBy("signature")
            .agg(F.min("key").alias("b"), F.max("key").alias("a"), F.count("*").alias("rows"))
            .where("a != b"),
            "jaccard-buckets",
        )
        # A bucket of two classes is its pair; the others' members are looked up again.
        crowds = found.where("rows > 2").select("signature", "b")
        members = index.join(crowds, "signature").select("signature", "key", "b")
        crowd = crowd.unionByName(written(members, "jaccard-crowds"))
        buckets = buckets.unionByName(found.select("signature", "b", "a"))
    return buckets, crowd


def jaccard_rows(docs: DataFrame, percent: int = 90, shingle: int = 3) -> DataFrame:
    """doc_id, text_hash, n_shingles, root for every row of `docs`.

    Rows of a component have one root.  Rows without words share a root and no component.
    """

    def member(doc_id, text_hash, hashes):
        size = np.array([len(hashes)])
        cells = [_cells(hashes)], [_fine_cells(hashes)]
        return [doc_id], [text_hash], size, _key(hashes), *cells

    members = written(
        _map_sets(
            docs,
            "doc_id long, text_hash long, n_shingles long, key long, cells binary, fine binary",
            shingle,
            member,
        ),
        "jaccard-members",
    )
    # One text of each class of equal sets, by doc_id and text: a doc_id may be null or repeated.
    chosen = members.where("n_shingles > 0").groupBy("key").agg(
        F.min(F.struct("doc_id", "text_hash", "n_shingles", "cells", "fine")).alias("row")
    )
    # Named by plain columns, rows are shuffled once, to find the chosen ones and drop copies.
    name = {"at": F.coalesce("doc_id", F.lit(0)), "none": F.col("doc_id").isNull()}
    chosen = chosen.select("key", "row.*").withColumns(name).drop("doc_id")
    texts = _rows(docs).withColumns(name).drop("doc_id").join(chosen, [*name, "text_hash"])
    texts = texts.dropDuplicates([*name, "text_hash"])
    texts = texts.select("key", "n_shingles", "cells", "fine", "text")
    texts = written(texts, "jaccard-texts")
    cells = F.when(F.length("fine") > 0, F.col("fine")).otherwise(F.col("cells"))
    fine = texts.select("key", "n_shingles", cells.alias("cells"))
    buckets, crowd = _met(texts, percent, shingle)
    pairs = buckets.select("a", "b").unionByName(
        crowd.where("key != b").select(F.col("key").alias("a"), "b")
    )
    pairs = written(_likely(pairs.distinct(), fine, percent), "jaccard-pairs")
    links = written(_all_verified(pairs, texts, percent, shingle), "jaccard-links")
    roots = written(components(links, "jaccard-stars"), "jaccard-roots")
    more = _links_between(crowd, roots, texts, percent, shingle, fine)
    more = written(more, "jaccard-more-links")
    # All links are found; what follows reads no text.
    forget(texts)
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = written(components(links, "jaccard-stars"), "jaccard-roots")
    rooted = members.join(roots.withColumnRenamed("node", "key"), "key", "left")
    return rooted.select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("root", "key").alias("root")
    )


def jaccard_components(docs: DataFrame, percent: int = 90, shingle: int = 3) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs`."""
    rooted = jaccard_rows(docs, percent, shingle)
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )
