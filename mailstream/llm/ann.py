"""Nearest neighbours by inner product from a forest of random-projection trees.

Largest inner product becomes smallest angle by one more coordinate, sqrt(M^2 - |x|^2) with
M the largest norm (0 for queries).  Trees are grown on a bounded sample (`sample_rows`):
each node splits at the median of the projection onto the line between two random centres.
Every vector is then indexed, one leaf in each tree.

A query's branches over all trees wait in one priority queue, best margin first; since the
margin of a branch is the least along its path, leaves come off it in descending order of
that least, which is how they are computed here, for a block of queries at once.  Leaves
are taken until they hold `search_share` of the corpus (counting every tree's copy), then
every candidate is scored exactly, in double precision, on the original vectors.

Trees are searched one after another.  Neighbouring leaves of a tree make up a group of
`GROUP_BYTES` of vectors at most (a larger leaf is cut into several, so that equal vectors,
which no projection can separate, spread over tasks; nothing is left out).  A query goes
once to each group of which it takes leaves and tells which.  A task holds the vectors of
one group while the group's queries stream past, and a batch of leaves to take or of
answers is no longer than a block of queries makes it.

Vectors that are null, zero, of another length than most, or hold null or non-finite
numbers take no part.  Ties go to the smaller vec_id; a repeated vec_id counts once, with
its best score.  A query with fewer than `neighbours` candidates gets all it finds.  Other
columns do not matter; an empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mailstream.llm.common import forget, slices, written
from mailstream.llm.stretches import U64, mix

TREES = 4
SAMPLE_ROWS = 8192
LEAF_ROWS = 4096
LEAST_LEAVES, MOST_LEAVES = 16, 1024
SEARCH_SHARE = 1.5
#: Vectors of a group of leaves, and the fewest that are worth a group.
GROUP_BYTES = 16 << 20
CHUNK_ROWS = 4096
#: Queries, and vectors of a group, that are compared at a time.
BLOCK_QUERIES = 512
BLOCK_ROWS = 4096
#: Pairs that are scored exactly at a time.
SCORED_PAIRS = 1 << 14

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part, of one length."""
    rows = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"),
        vectors["embedding"].alias("vector"),
    ).where(
        F.col("vec_id").isNotNull()
        & F.exists("vector", lambda x: x != 0)
        & F.forall(
            "vector",
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
        )
    )
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    first = lengths.orderBy(F.desc("count"), "length").first()
    return rows.where(F.size("vector") == F.lit(first["length"] if first else 0))


def _tree(x: np.ndarray, depth: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (direction, limit, node or ~leaf above, same below) of one tree."""
    nodes: list[tuple] = []
    leaves = 0

    def grow(rows: np.ndarray, level: int) -> int:
        nonlocal leaves
        if level < depth and len(rows) >= 4:
            some = x[rng.choice(rows, min(len(rows), 256), replace=False)]
            centres = some[rng.choice(len(some), 2, replace=False)]
            for _ in range(5):
                far = ((some[:, None] - centres) ** 2).sum(axis=2)
                nearer = far.argmin(axis=1)
                for k in (0, 1):
                    if (nearer == k).any():
                        centres[k] = some[nearer == k].mean(axis=0)
            direction = centres[0] - centres[1]
            size = np.linalg.norm(direction)
            if size > 1e-9:
                direction /= size
                at = x[rows] @ direction
                limit = float(np.median(at))
                if 0 < (at > limit).sum() < len(rows):
                    number = len(nodes)
                    nodes.append(())
                    above = grow(rows[at > limit], level + 1)
                    below = grow(rows[at <= limit], level + 1)
                    nodes[number] = (direction, limit, above, below)
                    return number
        leaves += 1
        return -leaves

    root = grow(np.arange(len(x)), 0)
    return nodes if root >= 0 else []


def _leaf_of(nodes: list[tuple], x: np.ndarray) -> np.ndarray:
    """The leaf (1, 2, ...) of each row."""
    leaf = np.ones(len(x), np.int64)
    waiting = [(0, np.arange(len(x)))] if nodes else []
    while waiting:
        number, rows = waiting.pop()
        direction, limit, above, below = nodes[number]
        up = x[rows] @ direction > limit
        for child, part in ((above, rows[up]), (below, rows[~up])):
            if child >= 0:
                waiting.append((child, part))
            else:
                leaf[part] = -child
    return leaf


def _leaf_margins(nodes: list[tuple], x: np.ndarray) -> dict[int, np.ndarray]:
    """For each leaf, every row's least margin along the path to it."""
    margins: dict[int, np.ndarray] = {}
    waiting = [(0, np.full(len(x), np.inf))]
    if not nodes:
        return {1: waiting[0][1]}
    while waiting:
        number, least = waiting.pop()
        direction, limit, above, below = nodes[number]
        margin = x @ direction - limit
        for child, signed in ((above, margin), (below, -margin)):
            here = np.minimum(least, signed)
            if child >= 0:
                waiting.append((child, here))
            else:
                margins[-child] = here
    return margins


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(vectors), -1)


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


class _Group(NamedTuple):
    """Vectors of some leaves: those of leaves[k] lie from begin[k] to begin[k + 1]."""

    ids: np.ndarray
    x: np.ndarray
    leaves: np.ndarray
    begin: np.ndarray
    repeated: bool  # whether an id may stand for several vectors


def _group(ids: np.ndarray, x: np.ndarray, leaf: np.ndarray, n: int) -> _Group:
    """Of equal vectors those with the n + 1 smallest ids stay; the others are no answer."""
    same = np.unique(np.ascontiguousarray(x).view(f"V{x.shape[1] * 8}"), return_inverse=True)[1]
    same = same.reshape(-1)
    order = np.lexsort((ids, same))
    ids, x, leaf, same = ids[order], x[order], leaf[order], same[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (same[1:] != same[:-1])
    ids, x, leaf, same = ids[new], x[new], leaf[new], same[new]
    kept = np.arange(len(ids)) - np.searchsorted(same, same) <= n
    order = np.flatnonzero(kept)[np.argsort(leaf[kept], kind="stable")]
    leaves, begin = np.unique(leaf[order], return_index=True)
    begin = np.append(begin, len(order))
    return _Group(ids[order], x[order], leaves, begin, len(np.unique(ids)) < len(ids))


class _Best:
    """The n best answers so far of each of some queries."""

    def __init__(self, group: _Group, queries: np.ndarray, q: np.ndarray, n: int):
        self.group, self.queries, self.q, self.n = group, queries, q, n
        self.floor = np.full(len(queries), -np.inf)
        self.row, self.at = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score = np.zeros(0)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def compare(self, rows: np.ndarray, begin: int, end: int) -> None:
        """Meets some queries with some vectors of the group."""
        ids, x = self.group.ids[begin:end], self.group.x[begin:end]
        rough = self.q[rows] @ x.T
        order = np.argsort(ids, kind="stable")
        low, high = (
            np.searchsorted(ids, self.queries[rows], side=side, sorter=order)
            for side in ("left", "right")
        )
        for i in np.flatnonzero(high > low):
            rough[i, order[low[i] : high[i]]] = -np.inf
        least = self.floor[rows]
        fresh = np.flatnonzero(least == -np.inf)
        if len(fresh) and end - begin > self.n and not self.group.repeated:
            least[fresh] = np.partition(rough[fresh], -self.n, axis=1)[:, -self.n]
        # Rounding of the matrix product must not decide; rows this close are scored too.
        with np.errstate(invalid="ignore"):
            least = np.where(least > -np.inf, least - 1e-9 * (1 + np.abs(least)), least)
        row, column = np.nonzero((rough >= least[:, None]) & (rough > -np.inf))
        for start in range(0, len(row), SCORED_PAIRS):
            i = rows[row[start : start + SCORED_PAIRS]]
            at = begin + column[start : start + SCORED_PAIRS]
            self.waiting.append((i, at, (self.group.x[at] * self.q[i]).sum(axis=1)))
            self.size += len(i)
            if self.size > max(SCORED_PAIRS, len(self.queries) * self.n):
                self.settle()

    def settle(self) -> None:
        """Leaves the best; ties go to the smaller id, an id counts once."""
        columns = zip((self.row, self.at, self.score), *self.waiting, strict=True)
        row, at, score = (np.concatenate(column) for column in columns)
        self.waiting, self.size = [], 0
        ids = self.group.ids[at]
        if self.group.repeated:
            order = np.lexsort((-score, ids, row))
            row, at, score, ids = row[order], at[order], score[order], ids[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
            row, at, score, ids = row[new], at[new], score[new], ids[new]
        order = np.lexsort((ids, -score, row))
        row, at, score = row[order], at[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        kept, last = place < self.n, place == self.n - 1
        self.floor[row[last]] = score[last]
        self.row, self.at, self.score = row[kept], at[kept], score[kept]


def _answers(group: _Group, asked: pa.RecordBatch, n: int) -> Iterator[pa.RecordBatch]:
    """query_id, vec_id, score: the n best of a group for queries (id, vector, leaves)."""
    for part in slices(asked, BLOCK_QUERIES):
        queries = part.column("id").to_numpy()
        best = _Best(group, queries, _matrix(part.column("vector")), n)
        wanted = part.column("leaves")
        row = np.repeat(np.arange(len(queries)), wanted.value_lengths().to_numpy())
        leaf = wanted.flatten().to_numpy()
        order = np.argsort(leaf, kind="stable")
        row, leaf = row[order], leaf[order]
        for k, number in enumerate(group.leaves):
            low, high = np.searchsorted(leaf, number), np.searchsorted(leaf, number, side="right")
            end = group.begin[k + 1]
            for begin in range(group.begin[k], end if high > low else 0, BLOCK_ROWS):
                best.compare(row[low:high], begin, min(begin + BLOCK_ROWS, end))
        best.settle()
        columns = queries[best.row], group.ids[best.at], best.score
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["query_id", "vec_id", "score"]
        )


def _searched(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Answers for rows (part, asks, id, vector, leaves), ordered by part, vectors first."""
    number, held, group = None, [], None
    for batch in batches:
        parts = batch.column("part").to_numpy()
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((parts[1:] != parts[:-1]) | (asks[1:] != asks[:-1])) + 1
        bounds = [0, *cut.tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:]):
            if start == end:
                continue
            some = batch.slice(start, end - start)
            if parts[start] != number:
                number, held, group = parts[start], [], None
            if not asks[start]:
                leaf = some.column("leaves").flatten().to_numpy()
                held.append((some.column("id").to_numpy(), _matrix(some.column("vector")), leaf))
            elif held or group:
                if held:
                    group = _group(*(np.concatenate(c) for c in zip(*held, strict=True)), n)
                    held = []
                yield from _answers(group, some, n)


class _Layout(NamedTuple):
    """The leaves of a forest, tree by tree, and the groups that hold their vectors."""

    tree: np.ndarray
    first: np.ndarray  # the first group of a leaf
    groups: np.ndarray  # how many groups a leaf has; more than one only if it is alone there


def _layout(trees: np.ndarray, held: np.ndarray, most: int) -> _Layout:
    first, groups = np.zeros(len(held), np.int64), np.ones(len(held), np.int64)
    number, filled = -1, 0
    for k, size in enumerate(held):
        if size > most:
            groups[k] = -(-size // most)
            first[k] = number + 1
            number, filled = number + groups[k], most
            continue
        if k == 0 or trees[k] != trees[k - 1] or filled + size > most:
            number, filled = number + 1, 0
        first[k] = number
        filled += size
    return _Layout(trees, first, groups)


ROW = "part long, asks boolean, id long, vector {}, leaves array<int>"


def nearest(
    vectors: DataFrame,
    is_query: Column,
    neighbours: int = 20,
    trees: int = TREES,
    sample_rows: int = SAMPLE_ROWS,
    search_share: float = SEARCH_SHARE,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of `vectors` where `is_query` holds."""
    spark = vectors.sparkSession
    rows = written(usable(vectors), "ann-vectors")
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    count, most, length = rows.agg(F.count("*"), F.max(squares), F.max(F.size("vector"))).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    spot = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(spot < 1.2 * sample_rows / count).orderBy(
        F.xxhash64("vec_id", F.lit(seed)), "vec_id"
    )
    sample = np.array([r["vector"] for r in sample.limit(sample_rows).collect()], float)
    wanted = min(MOST_LEAVES, max(LEAST_LEAVES, count // LEAF_ROWS))
    rng = np.random.default_rng(seed)
    if len(sample):
        lifted = _lifted(sample, most)
        forest = [_tree(lifted, (wanted - 1).bit_length(), rng) for _ in range(trees)]
    else:
        forest = [[]]
    shared = spark.sparkContext.broadcast(forest)
    # A leaf's column is its number after those of the trees before.
    leaves = [max([1, *(-c for node in nodes for c in node[2:])]) for nodes in forest]
    before = np.cumsum([0, *leaves])

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(before[-1], np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _lifted(_matrix(batch.column("vector")), most)
                for number, nodes in enumerate(shared.value):
                    held += np.bincount(before[number] + _leaf_of(nodes, x) - 1, minlength=len(held))
        columns = [pa.array(np.arange(len(held))), pa.array(held)]
        yield pa.RecordBatch.from_arrays(columns, ["leaf", "rows"])

    # One row for each leaf; the forest bounds their number.
    counted = rows.select("vector").mapInArrow(sizes, "leaf long, rows long")
    held = np.zeros(before[-1], np.int64)
    for r in counted.groupBy("leaf").agg(F.sum("rows").alias("rows")).collect():
        held[r["leaf"]] = r["rows"]
    budget = max(search_share * count, 2.0 * neighbours * len(forest))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group_rows = min(max(GROUP_BYTES // (8 * length), 1), max(CHUNK_ROWS, count // tasks))
    layout = _layout(np.repeat(np.arange(len(forest)), leaves), held, group_rows)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BLOCK_QUERIES):
                x = _lifted(_matrix(part.column("vector")), np.inf)
                x[:, -1] = 0
                priority = np.empty((len(x), before[-1]))
                for number, nodes in enumerate(shared.value):
                    for leaf, margin in _leaf_margins(nodes, x).items():
                        priority[:, before[number] + leaf - 1] = margin
                order = np.argsort(-priority, axis=1, kind="stable")
                until = np.cumsum(held[order], axis=1) - held[order]
                asked = np.zeros(priority.shape, bool)
                np.put_along_axis(asked, order, until < budget, axis=1)
                bits = pa.array([x.tobytes() for x in np.packbits(asked, axis=1)], pa.binary())
                columns = [part.column("vec_id"), part.column("vector"), bits]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "asked"])

    kind = rows.schema["vector"].dataType.simpleString()
    asked = written(
        rows.where(is_query)
        .select("vec_id", "vector")
        .mapInArrow(probe, f"vec_id long, vector {kind}, asked binary"),
        "ann-asked",
    )

    def of_tree(number: int) -> DataFrame:
        low, high = int(before[number]), int(before[number + 1])
        names = ["part", "asks", "id", "vector", "leaves"]

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _lifted(_matrix(batch.column("vector")), most)
                leaf = low + _leaf_of(shared.value[number], x) - 1
                ids = batch.column("vec_id").to_numpy()
                dealt = mix(ids.view(U64)) % layout.groups[leaf].astype(U64)
                columns = [
                    pa.array(layout.first[leaf] + dealt.astype(np.int64)),
                    pa.array(np.zeros(len(ids), bool)),
                    batch.column("vec_id"),
                    batch.column("vector"),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(ids) + 1), pa.int32()), pa.array(leaf, pa.int32())
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

        def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, BLOCK_QUERIES):
                    yield questions_of(part)

        def questions_of(part: pa.RecordBatch) -> pa.RecordBatch:
            bits = np.frombuffer(b"".join(part.column("asked").to_pylist()), np.uint8)
            bits = np.unpackbits(bits.reshape(part.num_rows, -1), axis=1)[:, low:high]
            row, leaf = np.nonzero(bits)
            leaf += low
            # All groups of a leaf that has several; the leaves of a group lie together.
            times = layout.groups[leaf]
            inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, leaf = np.repeat(row, times), np.repeat(leaf, times)
            group = layout.first[leaf] + inside
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (group[1:] != group[:-1])
            begin = np.flatnonzero(new)
            taken = pa.array(row[begin])
            columns = [
                pa.array(group[begin]),
                pa.array(np.ones(len(begin), bool)),
                part.column("vec_id").take(taken),
                part.column("vector").take(taken),
                pa.ListArray.from_arrays(
                    pa.array(np.append(begin, len(row)), pa.int32()), pa.array(leaf, pa.int32())
                ),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        schema = ROW.format(kind)
        met = rows.mapInArrow(members, schema).unionByName(asked.mapInArrow(questions, schema))
        own = layout.first[low:high] + layout.groups[low:high]
        tasks = int(own.max() - layout.first[low:high].min())
        met = met.repartition(tasks, "part").sortWithinPartitions("part", "asks")
        found = met.mapInArrow(lambda batches: _searched(batches, neighbours), FOUND)
        return written(_first(found.repartition("query_id"), neighbours), "ann-found")

    found = reduce(DataFrame.unionByName, [of_tree(number) for number in range(len(forest))])
    forget(asked)
    forget(rows)
    # A vector found in several trees counts once.
    return _first(found, neighbours).select("query_id", "rank", "vec_id", "score")


def _first(found: DataFrame, neighbours: int) -> DataFrame:
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)
