"""A Merkle manifest of a dataset: a tree of digests for each source, and one over sources.

The leaves of a source ascend by doc_id; while several nodes remain, every `FANOUT`
consecutive ones become their digest.  What remains is the source's subroot; the subroots,
ordered by source (null first, by UTF-8 bytes), make up a tree of the same kind, whose last
node is the root.

Leaves are dealt to aligned partitions of `FANOUT ** BLOCK_LEVELS` leaves, and a partition
hashes its own part of the tree.  Then partitions exchange what they have, butterfly-wise: in
each round, groups of `FANOUT` partitions whose numbers differ in one digit swap the roots of
the subtrees they know, and each hashes the common ancestor for itself.  After as many rounds
as the numbers have digits, each partition knows its upper proof and the subroot; no pass
goes down the tree.  Where a source's last subtree is cut short, its partitions stand in for
the missing ones in turn, so no partition answers more than its share.  The subroots go
through the same steps, as one more source.  A last pass over the leaves joins the proofs.

Everything is bounded: a partition is a row of exchange plus its leaves, streamed in order;
positions come from counts of sorted ranges, so a source that holds a third of all rows is
many ranges and many partitions.

A null column counts as `-`, an empty text as `0:`.  Rows without doc_id come first in their
source; rows with equal doc_id are ordered by their leaves, and equal rows are leaves of
their own.  Columns other than doc_id, source, lang, n_chars and text do not matter.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailstream.llm.common import written

FANOUT = 16
#: Levels of the tree that one partition hashes by itself: 4,096 leaves.
BLOCK_LEVELS = 3
#: A step of a proof: the siblings' digests before and after the own one.
STEPS = "array<struct<before:string,after:string>>"
#: Blocks of a source that one copy of its path serves.
BLOCKS_A_PATH = 1024
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(docs: DataFrame, **replaced: Column) -> Column:
    """The digest of a row; `replaced` columns take the place of the row's own."""
    columns = (replaced.get(name, docs[name]) for name in LEAF_COLUMNS)
    return F.sha2(F.concat(*(_field(column) for column in columns)), 256)


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _placed(leaves: DataFrame) -> DataFrame:
    """`leaves` (source, doc_id, leaf, ..) with tree (number of the source), n, pos.

    Rows are sorted in ranges; a range's counts for each source, one row each, give the
    places of all rows.
    """
    sorted_rows = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(
        "source", "doc_id", "leaf", "tie"
    ).sortWithinPartitions("source", "doc_id", "leaf", "tie")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = written(
        sorted_rows.drop("tie").withColumns({"range": F.spark_partition_id(), "at": at}),
        "manifest-leaves",
    )
    runs = rows.groupBy("range", "source").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    runs = written(runs, "manifest-runs")
    in_source = Window.partitionBy("source").orderBy("range")
    before = F.sum("rows").over(in_source.rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select(
        "range", "source", "first", F.coalesce(before, F.lit(0)).alias("before")
    )
    # The order of sources is that of the ranges they begin in, then of their places there.
    sources = runs.groupBy("source").agg(
        F.sum("rows").alias("n"), F.min(F.struct("range", "first")).alias("begin")
    )
    begun = sources.groupBy("begin.range").agg(F.count("*").alias("begun"))
    earlier = F.sum("begun").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    begun = begun.select("range", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    in_range = F.row_number().over(Window.partitionBy("begin.range").orderBy("begin.first"))
    numbered = sources.select("source", "n", F.col("begin.range").alias("range"), in_range.alias("k"))
    numbered = numbered.join(begun, "range").select(
        F.col("source").alias("named"), "n", (F.col("earlier") + F.col("k") - 1).alias("tree")
    )
    starts = starts.join(numbered, F.col("source").eqNullSafe(F.col("named")))
    starts = starts.select(
        F.col("range").alias("run_range"), F.col("source").alias("run_source"),
        "tree", "n", (F.col("before") - F.col("first")).alias("shift"),
    )
    same_run = (F.col("range") == F.col("run_range")) & F.col("source").eqNullSafe(F.col("run_source"))
    placed = rows.join(starts, same_run).withColumn("pos", F.col("at") + F.col("shift"))
    return placed.drop("range", "at", "run_range", "run_source", "shift", "source")


def _each_block(rows: DataFrame, columns: str, use: Callable) -> DataFrame:
    """What `use(rows)` yields for each block of `rows` (tree, block, pos, ..), by pos.

    A task sorts what it gets and holds the rows of one block at a time.
    """
    schema = [part.split() for part in columns.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    steps = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(found: list[tuple]) -> pa.RecordBatch:
            values = zip(*found, strict=True)
            fields = [
                pa.array(v, kinds.get(kind, steps)) for v, (_, kind) in zip(values, schema, strict=True)
            ]
            return pa.RecordBatch.from_arrays(fields, [name for name, _ in schema])

        here, held, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["tree"], row["block"]) != here:
                    out.extend(use(held) if held else ())
                    here, held = (row["tree"], row["block"]), []
                    if len(out) >= 1000:
                        yield made(out)
                        out = []
                held.append(row)
        out.extend(use(held) if held else ())
        if out:
            yield made(out)

    return dealt.mapInArrow(run, columns)


def _block_nodes(leaves: list[str], n: int, levels: int) -> list[list[str]]:
    """A block's nodes, level by level; all levels of a tree that has fewer than a block."""
    nodes = [leaves]
    while len(nodes) <= levels and n > FANOUT ** (len(nodes) - 1):
        last = nodes[-1]
        nodes.append([_digest(last[at : at + FANOUT]) for at in range(0, len(last), FANOUT)])
    return nodes


def _block_roots(placed: DataFrame, levels: int) -> DataFrame:
    """tree, block, n, blocks, node: the root of each block."""
    size = FANOUT**levels

    def use(rows: list[dict]) -> Iterator[tuple]:
        first = rows[0]
        nodes = _block_nodes([row["leaf"] for row in rows], first["n"], levels)
        yield first["tree"], first["block"], first["n"], -(-first["n"] // size), nodes[-1][0]

    rows = placed.select("tree", "block", "pos", "n", "leaf")
    return _each_block(rows, "tree long, block long, n long, blocks long, node string", use)


def _exchange(roots: DataFrame) -> DataFrame:
    """`roots` with node, the root of the tree, and upper, the steps from the block to it.

    A step holds the digests before and after the own one among those hashed together.  In a
    round, a block asks each subtree under its next ancestor, in it the block with the same
    lower digits as its own.
    """
    state = written(roots.withColumn("upper", F.array().cast(STEPS)), "manifest-blocks")
    most = state.agg(F.max("blocks")).first()[0] or 0
    span = 1
    while span < most:
        width = F.lit(span).cast("bigint")
        going = state.where(F.col("blocks") > span)
        subtree, low = (F.expr(f"block {how} {span}") for how in ("div", "%"))
        there = F.least(width, F.col("blocks") - subtree * span)
        answers = going.select(
            F.col("tree").alias("its_tree"),
            subtree.alias("child"),
            F.explode(F.sequence(low, width - 1, there)).alias("its_low"),
            F.col("node").alias("digest"),
        )
        first = subtree - F.pmod(subtree, F.lit(FANOUT))
        last = F.least(first + (FANOUT - 1), F.expr(f"(blocks - 1) div {span}"))
        asks = going.withColumn("asked", F.explode(F.sequence(first, last)))
        same = (
            (F.col("tree") == F.col("its_tree"))
            & (F.col("asked") == F.col("child"))
            & (low == F.col("its_low"))
        )
        children = F.sort_array(F.collect_list(F.struct("asked", "digest")))
        met = asks.join(answers, same).groupBy("tree", "block", "n", "blocks")
        met = met.agg(F.first("upper").alias("upper"), children.alias("children"))

        def joined(where: Callable[[Column], Column], subtree: Column = subtree) -> Column:
            some = F.filter("children", lambda child: where(child["asked"] - subtree))
            return F.array_join(some["digest"], "")

        step = F.struct(
            joined(lambda place: place < 0).alias("before"),
            joined(lambda place: place > 0).alias("after"),
        )
        met = met.select(
            "tree", "block", "n", "blocks",
            F.sha2(F.array_join(F.col("children.digest"), ""), 256).alias("node"),
            F.concat("upper", F.array(step)).alias("upper"),
        )
        state = written(
            met.unionByName(state.where(F.col("blocks") <= span)), "manifest-round"
        )
        span *= FANOUT
    return state


def _blocked(placed: DataFrame, levels: int) -> DataFrame:
    return placed.withColumn("block", F.expr(f"pos div {FANOUT**levels}"))


def _on_paths(placed: DataFrame, blocks: DataFrame, levels: int, columns: str, use: Callable):
    """What `use(leaf's row, its steps to the root, the block's row)` returns for each leaf."""
    # The row of a block comes before its leaves.
    head = blocks.withColumn("pos", F.lit(-1).cast("long"))

    def paths(rows: list[dict]) -> Iterator[tuple]:
        top, leaves = rows[0], rows[1:]
        nodes = _block_nodes([row["leaf"] for row in leaves], top["n"], levels)
        upper = [(step["before"], step["after"]) for step in top["upper"]]
        for place, row in enumerate(leaves):
            path = []
            for level in nodes[:-1]:
                at = place - place % FANOUT
                path.append(("".join(level[at:place]), "".join(level[place + 1 : at + FANOUT])))
                place //= FANOUT
            yield use(row, path + upper, top)

    both = placed.unionByName(head, allowMissingColumns=True)
    return _each_block(both, columns, paths)


def _source_paths(subroots: DataFrame, levels: int) -> DataFrame:
    """tree, subroot, root, above: the steps from each source's subroot to the root."""
    count = subroots.count()
    placed = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("pos"),
        F.lit(count).cast("long").alias("n"),
        F.col("node").alias("leaf"),
    )
    placed = _blocked(placed, levels)
    blocks = _exchange(_block_roots(placed, levels)).drop("blocks")

    def use(row: dict, path: list, top: dict) -> tuple:
        steps = [{"before": before, "after": after} for before, after in path]
        return row["pos"], row["leaf"], top["node"], steps

    columns = f"tree long, subroot string, root string, above {STEPS}"
    return _on_paths(placed, blocks, levels, columns, use)


def merkle_manifest(
    docs: DataFrame, found: Column | None = None, levels: int = BLOCK_LEVELS
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, n_siblings.

    `found` is the digest of each row as it is met again (null or none: the leaf); the proof
    is folded from it, and verified says whether that gives the root.
    """
    nothing = F.lit(None).cast("string")
    leaves = docs.select(
        docs["source"].cast("string").alias("source"),
        docs["doc_id"].cast("long").alias("doc_id"),
        leaf_digest(docs).alias("leaf"),
        (nothing if found is None else found).alias("found"),
    )
    placed = written(_blocked(_placed(written(leaves, "manifest-digests")), levels), "manifest-placed")
    blocks = _exchange(_block_roots(placed, levels))
    above = _source_paths(blocks.where("block = 0").select("tree", "node"), levels)
    # A source's path is repeated for every so many of its blocks, so none is hot.
    share = F.expr(f"block div {BLOCKS_A_PATH}")
    lots = blocks.where(f"block % {BLOCKS_A_PATH} = 0").select("tree", share.alias("lot"))
    above = written(above, "manifest-sources").join(lots, "tree")
    blocks = blocks.withColumn("lot", share).join(above, ["tree", "lot"]).select(
        "tree", "block", "n", F.concat("upper", "above").alias("upper"), "subroot", "root"
    )

    def use(row: dict, path: list, top: dict) -> tuple:
        folded = row["found"] or row["leaf"]
        for before, after in path:
            folded = _digest([before, folded, after])
        proof = [digests for step in path for digests in step]
        siblings = sum(map(len, proof)) // len(folded)
        return (
            row["doc_id"], row["leaf"], top["subroot"], top["root"], _digest(proof), folded, siblings,
        )

    columns = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, n_siblings long"
    )
    found_rows = _on_paths(placed, blocks, levels, columns, use)
    verified = F.col("folded_root") == F.col("root")
    return found_rows.withColumn("verified", verified).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "n_siblings"
    )
