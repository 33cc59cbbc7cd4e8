"""A dictionary from user-agent text to parsed fields that a stream extends as it goes.

Each micro-batch looks its distinct texts up, parses those it does not find, and adds them
as a run; so a text is parsed once over the life of the stream, restarts included.  Runs are
kept like those of the archive: complete or not there, and merged by tens.  A micro-batch that
fails after it added its texts finds them when it is replayed.  A text occurs once in all runs.

The dictionary belongs to one set of rules and one stream: other rules, or a parser of
another version, begin a dictionary of their own beside it.  Its size is that of the distinct
texts.  A micro-batch reads it three times (the texts alone to find new ones, the fields to
measure and to join them); it is not shuffled while the texts of the micro-batch fit the byte
limit of a broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mailstream.functions.agents import BROWSERS, FIELDS, SYSTEMS, Rule
from mailstream.operators.agents import parse_user_agent, struct_expand
from mailstream.operators.lookup import BROADCAST_BYTES, Lookup, lookup_table
from mailstream.plans.schemas import USER_AGENT_REPORT
from mailstream.streaming.archive import Run, complete_runs, live_runs, merge_due, run_folder

AGENT = "http_user_agent"
#: To be raised whenever the parser gives other fields for the same rules.
PARSER_VERSION = 1
TEXTS = StructType([StructField(AGENT, StringType()), *(USER_AGENT_REPORT[f] for f in FIELDS)])


@dataclass(frozen=True)
class AgentTexts:
    """Where the dictionary lies and the rules its texts are parsed by."""

    path: str
    browsers: Sequence[Rule] = BROWSERS
    systems: Sequence[Rule] = SYSTEMS
    broadcast_bytes: int = BROADCAST_BYTES

    @property
    def folder(self) -> str:
        rules = repr((PARSER_VERSION, tuple(self.browsers), tuple(self.systems)))
        return f"{self.path}/rules={hashlib.sha256(rules.encode()).hexdigest()[:16]}"

    def parse(self, rows: DataFrame) -> DataFrame:
        """`rows` with the nine fields, parsed without the dictionary."""
        return struct_expand(parse_user_agent(rows, AGENT, self.browsers, self.systems))


def _read(spark: SparkSession, texts: AgentTexts, runs: Sequence[Run]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], TEXTS)
    return spark.read.schema(TEXTS).parquet(*(run_folder(texts.folder, run) for run in runs))


def read_texts(spark: SparkSession, texts: AgentTexts) -> DataFrame:
    """Every text of the dictionary with its fields, once."""
    return _read(spark, texts, live_runs(complete_runs(spark, texts.folder)))


def fields_of(rows: DataFrame, texts: AgentTexts) -> Lookup:
    """The fields of all texts of `rows`, measured; texts that are new join the dictionary."""
    spark = rows.sparkSession
    wanted = rows.where(F.col(AGENT).isNotNull()).select(AGENT).distinct()
    few = lookup_table(wanted, AGENT, texts.broadcast_bytes, check_unique=False).small
    # Listed before this micro-batch's run is written, and read as listed.
    runs = live_runs(complete_runs(spark, texts.folder))
    asked = F.broadcast(wanted) if few else wanted
    seen = _read(spark, texts, runs).join(asked, AGENT, "left_semi")
    fresh = wanted.join(seen.select(AGENT), AGENT, "left_anti")
    number = max((last for _, last in runs), default=-1) + 1
    run = (number, number)
    parsed = texts.parse(fresh).select(*TEXTS.names)
    parsed.write.mode("overwrite").parquet(run_folder(texts.folder, run))

    def merge(parts: Sequence[Run], whole: Run) -> None:
        merged = _read(spark, texts, parts).hint("rebalance")
        merged.write.mode("overwrite").parquet(run_folder(texts.folder, whole))

    merge_due(spark, number, texts.folder, merge)
    found = seen.unionByName(_read(spark, texts, [run]))
    return lookup_table(found, AGENT, texts.broadcast_bytes, check_unique=False)
