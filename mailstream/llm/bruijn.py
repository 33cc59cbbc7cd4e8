"""Repeated word windows, from a compacted De Bruijn graph of word k-mers.

The k-mers are windows of `width` words; each joins the node of its first width - 1 words to
the node of its last.  Stretches (see `stretches`) whose anchor occurs once hold no repeated
window and are left aside; equal stretches collapse to one with a count.  What is left
becomes edges: a stretch that is alone with its anchor is a chain that is compact already
and is one edge; where an anchor has several stretches, each of their windows is an edge
with the sum of the counts, and edges that occur once go.

Repeated edges are compacted: where a node has one edge in and one edge out, the two belong
to one path.  An edge's source coordinates are one place in the corpus where it occurs; edges
that follow each other there become runs, and pointer jumping (joins of runs with runs, the
distance doubling each round) gives every edge its path and its place on it.  In the last pass every occurrence of an edge is
compared, by a second hash of its words, with that source, adjacent occurrences that follow
each other on a path are one span, and spans are cut out.

A word is removed if a window covers it whose words start at another place too, in the same
or another document; windows are judged on the input.  Null text has no words.  Equal rows
count as two places.  Texts shorter than a window stay.  Other columns do not matter; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mailstream.llm.common import forget, slices, written
from mailstream.llm.repeats import covered, keyed, occurrences, with_lists
from mailstream.llm.stretches import OTHER_BASE, span_hashes, word_hashes, word_spans

WIDTH = 35
GRAM = 8

EDGES = (
    "doc long, tag int, at int, anchor long, content long, place int, windows int, rows long, "
    "kmer long, proof long, left long, right long"
)
SPANS = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long, kept string"


def _edges_of(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Edges of the stretches in `wanted`, read back from one place where each occurs."""
    names = [part.split()[0] for part in EDGES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = []
                texts, spans = part.column("text"), part.column("spans").to_pylist()
                names_of = zip(part.column("doc").to_pylist(), part.column("tag").to_pylist())
                for name, text, some in zip(names_of, texts, spans, strict=True):
                    words = word_hashes(np.frombuffer(text.as_buffer(), np.uint8))
                    out.append(edges(name, words, some))
                if out:
                    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def edges(name: tuple, words: np.ndarray, some: list[dict]) -> list[np.ndarray]:
        span = {k: np.array([s[k] for s in some]) for k in some[0]}
        # One edge for a stretch that is alone with its anchor, one a window for others.
        each = np.where(span["alone"], 1, span["windows"])
        owner = np.repeat(np.arange(len(some)), each)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
        long = np.where(span["alone"], span["windows"], 1)[owner]
        start = span["start"][owner] + place
        end = start + long + width - 1
        return [
            np.full(len(owner), name[0], np.int64),
            np.full(len(owner), name[1], np.int32),
            start.astype(np.int32),
            span["anchor"][owner],
            span["content"][owner],
            place.astype(np.int32),
            long.astype(np.int32),
            span["rows"][owner],
            span_hashes(words, start, end).view(np.int64),
            span_hashes(words, start, end, OTHER_BASE).view(np.int64),
            span_hashes(words, start, start + width - 1).view(np.int64),
            span_hashes(words, end - width + 1, end).view(np.int64),
        ]

    fields = "start", "windows", "anchor", "content", "rows", "alone"
    lists = wanted.groupBy("doc", "tag").agg(F.collect_list(F.struct(*fields)).alias("spans"))
    texts = rows.select("doc", "tag", "text").join(lists, ["doc", "tag"])
    edges_read = texts.select("doc", "tag", "text", "spans").mapInArrow(run, EDGES)
    # Rows with equal names have equal texts; an edge read twice is dropped again.
    return edges_read.dropDuplicates(["anchor", "content", "place"])


def compact(edges: DataFrame) -> DataFrame:
    """path and position (in windows) of each edge of the graph.

    `edges` has kmer, windows, left, right and source coordinates doc, tag, at.  Edges that
    follow each other at their source join runs there, without moving; runs join paths by
    pointer jumping, the distance doubling each round.  A path's name is its first edge.
    Closed rings of runs stay runs.
    """
    arriving = edges.groupBy(F.col("right").alias("node")).agg(
        F.count("*").alias("arriving"), F.min("kmer").alias("before")
    )
    leaving = edges.groupBy(F.col("left").alias("node")).agg(F.count("*").alias("leaving"))
    through = arriving.join(leaving, "node").where("arriving = 1 and leaving = 1")
    through = through.select(F.col("node").alias("left"), "before")
    follows = edges.drop("right").join(through, "left", "left").withColumn(
        "before", F.expr("if(before = kmer, null, before)")
    )
    source = Window.partitionBy("doc", "tag").orderBy("at", "kmer")
    goes_on = (F.lag("kmer").over(source) == F.col("before")) & (
        F.lag(F.col("at") + F.col("windows")).over(source) == F.col("at")
    )
    new = F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)
    numbered = follows.withColumn("new", new).withColumn("number", F.sum("new").over(source))
    run = Window.partitionBy("doc", "tag", "number")
    runs = written(
        numbered.select(
            "kmer",
            "windows",
            "before",
            "new",
            F.min_by("kmer", "at").over(run).alias("run"),
            (F.col("at") - F.min("at").over(run)).cast("long").alias("inside"),
        ),
        "bruijn-runs",
    )
    ends = runs.select(
        F.col("kmer").alias("before"),
        F.col("run").alias("path"),
        (F.col("inside") + F.col("windows")).alias("position"),
    )
    # A run's first edge says which run it follows and where on it.
    heads = runs.where("new = 1").select("run", "before")
    state = written(
        heads.join(ends, "before", "left").select(
            "run",
            F.coalesce("path", "run").alias("path"),
            F.coalesce("position", F.lit(0).cast("long")).alias("position"),
        ),
        "bruijn-paths",
    )
    open_before = None
    while True:
        first = state.where("path = run and position = 0").select(F.col("run").alias("path"))
        unfinished = state.join(first, "path", "left_anti")
        open_now = unfinished.count()
        # Rings never come to a first run: their number stays while all else settles.
        if open_now == 0 or open_now == open_before:
            break
        open_before = open_now
        ahead = state.select(
            F.col("run").alias("path"),
            F.col("path").alias("farther"),
            F.col("position").alias("more"),
        )
        moved = unfinished.join(ahead, "path").select(
            "run",
            F.col("farther").alias("path"),
            (F.col("position") + F.col("more")).alias("position"),
        )
        settled = state.join(first, "path", "left_semi").select("run", "path", "position")
        replaced = state
        state = written(settled.unionByName(moved), "bruijn-paths")
        forget(replaced)
    if open_now:
        ring = unfinished.select(
            "run", F.col("run").alias("path"), F.lit(0).cast("long").alias("position")
        )
        settled = state.join(first, "path", "left_semi").select("run", "path", "position")
        state = settled.unionByName(ring)
    return runs.join(state, "run").select(
        "kmer", "path", (F.col("position") + F.col("inside")).alias("position")
    )


def repeated_words(rows: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc, tag, start, windows, proof, path, position: occurrences of repeated edges."""
    found = occurrences(rows, word_hashes, width, gram)
    shared = found.groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1")
    kept = written(found.join(shared.select("anchor"), "anchor"), "bruijn-stretches")
    kinds = kept.groupBy("anchor", "content").agg(
        F.count("*").alias("rows"), F.min(F.struct("doc", "tag", "start", "windows")).alias("place")
    )
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"))
    kinds = kinds.join(several, "anchor").select(
        "anchor", "content", "rows", "place.*", (F.col("kinds") == 1).alias("alone")
    )
    edges = written(_edges_of(rows, kinds, width), "bruijn-edges")
    graph = edges.groupBy("kmer").agg(
        F.sum("rows").alias("rows"),
        F.min("windows").alias("windows"),
        F.min("proof").alias("proof"),
        F.min("left").alias("left"),
        F.min("right").alias("right"),
        # The first values of a group come from one row, so they are one place.
        F.first("doc").alias("doc"),
        F.first("tag").alias("tag"),
        F.first("at").alias("at"),
    )
    graph = written(graph.where("rows > 1"), "bruijn-graph")
    paths = graph.join(compact(graph), "kmer").select("kmer", "proof", "path", "position")
    placed = edges.select("anchor", "content", "place", "windows", "kmer").join(paths, "kmer")
    placed = written(placed, "bruijn-placed")
    forget(edges)
    return kept.select("doc", "tag", "anchor", "content", "start").join(
        placed, ["anchor", "content"]
    ).select(
        "doc",
        "tag",
        (F.col("start") + F.col("place")).alias("start"),
        "windows",
        "proof",
        "path",
        "position",
    )


def remove_repeated_words(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The words of each text that no repeated window covers, and how much went.

    n_spans counts the runs that follow one path each.
    """
    rows = keyed(docs)
    spans = repeated_words(rows, width, gram)
    fields = "start", "windows", "proof", "path", "position"
    joined = with_lists(rows, spans, *fields)
    names = [part.split()[0] for part in SPANS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = []
                columns = (part.column(x) for x in ("doc_id", "text", "spans"))
                for doc_id, text, some in zip(*columns, strict=True):
                    data = np.frombuffer(text.as_buffer(), np.uint8)
                    starts, ends = word_spans(data)
                    gone, runs = removed(data, len(starts), some)
                    whole = data.tobytes()
                    words = [
                        whole[a:b]
                        for a, b in zip(
                            starts[~gone].tolist(), ends[~gone].tolist(), strict=True
                        )
                    ]
                    kept = b" ".join(words)
                    out.append(
                        (
                            doc_id.as_py(),
                            len(starts),
                            int(gone.sum()),
                            hashlib.sha256(kept).hexdigest(),
                            runs,
                            kept.decode(),
                        )
                    )
                arrays = [pa.array(c) for c in zip(*out, strict=True)]
                if arrays:
                    arrays[0] = arrays[0].cast(pa.int64())
                    yield pa.RecordBatch.from_arrays(arrays, names)

    def removed(data: np.ndarray, n: int, some: pa.ListScalar) -> tuple[np.ndarray, int]:
        if not some.is_valid:
            return np.zeros(n, bool), 0
        span = {name: some.values.field(name).to_numpy() for name in fields}
        order = np.argsort(span["start"], kind="stable")
        span = {name: values[order] for name, values in span.items()}
        starts = span["start"].astype(np.int64)
        ends = starts + span["windows"] + width - 1
        proof = span_hashes(word_hashes(data), starts, ends, OTHER_BASE).view(np.int64)
        right = proof == span["proof"]
        starts, ends = starts[right], ends[right]
        path, place = span["path"][right], span["position"][right] - starts
        runs = 1 + int(((np.diff(path) != 0) | (np.diff(place) != 0)).sum()) if len(path) else 0
        return covered(n, starts, ends), runs

    return joined.select("doc_id", "text", "spans").mapInArrow(run, SPANS)
