"""A training corpus from `documents`: five stages, each written before the next reads it.

1. Language identification: texts without letters and texts whose language is unsure go.
2. N-gram Jaccard join (five-word shingles, 80 %): one row of each component stays, that
   with the smallest doc_id (null comes last) and, where doc_ids repeat, the smallest hash of
   its text; documents without words stay, as they link with nothing.
3. Suffix-array deduplication: byte strings of 50 bytes that a document with a smaller
   doc_id has go; a character that loses a byte goes whole; a document of which nothing is
   left goes; n_chars is counted anew.
4. Mixing: documents are repeated or left out so that sources come near their targets.
5. SentencePiece: ids of each text, checked against the library, with their digests.

Rows with null doc_id pass stages 2 and 4 like others.
Columns beyond those of `documents` pass through stages 1, 2 and 4 and end at stage 3.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.llm.common import WORD, table, text_or_empty, written
from mailstream.llm.jaccard import jaccard_rows
from mailstream.llm.language import UNDECIDED, fit_languages, predict_languages
from mailstream.llm.mixing import copies_of, mix_sources
from mailstream.llm.pieces import encode_pieces
from mailstream.llm.suffixes import remove_repeated_bytes

#: Least score of a language that counts as found.
SURE = 0.5
#: Words of a shingle, and the least similarity in percent of documents that are near copies.
SHINGLE, NEAR = 5, 80


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have, in whatever case."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_languages(docs)
    found = predict_languages(docs, model, *[docs[name] for name in docs.columns])
    lang, sure = _unused(docs, "_lang_pred"), _unused(docs, "_sure")
    found = found.toDF(*docs.columns, lang, sure)
    return found.where((F.col(lang) != UNDECIDED) & (F.col(sure) >= SURE)).drop(lang, sure)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = written(jaccard_rows(docs, NEAR, SHINGLE), "pipeline-groups")
    worded = groups.where("n_shingles > 0")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    first = worded.groupBy("root").agg(F.min(row).alias("row")).select("row.*").drop("last")
    text = text_or_empty()
    doc, digest = _unused(docs, "_doc"), _unused(docs, "_hash")
    named = docs.withColumns(
        {doc: F.col("doc_id").cast("long"), digest: F.xxhash64(text)}
    ).where(text.rlike(WORD))
    same = named[doc].eqNullSafe(first["doc_id"]) & (named[digest] == first["text_hash"])
    kept = named.join(first, same, "left_semi")
    if not worded.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([doc, digest])
    return kept.select(*docs.columns).unionByName(docs.where(~text.rlike(WORD)))


def repeated_span_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = remove_repeated_bytes(docs, "lang", "source", with_text=True)
    return left.where("n_removed = 0 or text != ''").select(
        "doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars")
    )


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return copies_of(mix_sources(docs), docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_pieces(docs, model, with_ids=True, with_text=False)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_spans", repeated_span_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

#: No stage but the second could be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
