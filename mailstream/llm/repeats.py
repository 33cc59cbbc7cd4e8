"""What the two searches for repeated spans share: stretches, kept spans and the last pass.

A document is named by its doc_id and a tag: 0 where doc_ids are unique, else a hash of the
text.  Equal rows share both and so a result, and still count as two documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailstream.llm.common import slices, text_or_empty
from mailstream.llm.stretches import stretches

OCCURRENCE = "doc long, tag int, anchor long, start int, windows int, content long"
#: The order of a row without doc_id: before all others.
NO_ID = -(1 << 63)

Symbols = Callable[[np.ndarray], np.ndarray]


def keyed(docs: DataFrame, *carried: str) -> DataFrame:
    """doc (doc_id as a number to compare), tag, doc_id, text and `carried` of each row."""
    doc_id = docs["doc_id"].cast("long")
    repeated = docs.groupBy(doc_id.alias("doc_id")).count().where("count > 1")
    doc = F.coalesce(doc_id, F.lit(NO_ID))
    # Zero, but no constant to the optimizer: that would take the tag out of join keys, and
    # what is grouped by doc and tag would be shuffled again to join by doc alone.
    tag = F.pmod(doc, F.lit(1)).cast("int") if repeated.isEmpty() else F.hash(docs["text"])
    return docs.select(
        doc.alias("doc"),
        tag.alias("tag"),
        doc_id.alias("doc_id"),
        text_or_empty().alias("text"),
        *[docs[name].alias(f"_{name}") for name in carried],
    )


def occurrences(rows: DataFrame, symbols: Symbols, width: int, gram: int) -> DataFrame:
    """Every stretch of every document; anchor and content together identify its symbols."""
    names = [part.split()[0] for part in OCCURRENCE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                found = [
                    stretches(symbols(np.frombuffer(x.encode(), np.uint8)), width, gram)
                    for x in texts
                ]
                if not found:
                    continue
                sizes = [len(x.start) for x in found]
                anchor, start, windows, content = (
                    np.concatenate(column) for column in zip(*found, strict=True)
                )
                columns = [
                    np.repeat(part.column("doc").to_numpy(), sizes),
                    np.repeat(part.column("tag").to_numpy(), sizes),
                    anchor.view(np.int64),
                    start.astype(np.int32),
                    windows.astype(np.int32),
                    content.view(np.int64),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return rows.select("doc", "tag", "text").mapInArrow(run, OCCURRENCE)


def with_lists(rows: DataFrame, spans: DataFrame, *columns: str) -> DataFrame:
    """`rows` with the spans of each in a list (null: none); no longer than the document."""
    lists = spans.groupBy("doc", "tag").agg(F.collect_list(F.struct(*columns)).alias("spans"))
    return rows.join(lists, ["doc", "tag"], "left")


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n symbols lie in one of the spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change)[:n] > 0
