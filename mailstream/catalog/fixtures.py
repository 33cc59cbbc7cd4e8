"""Wire lines, dimension tables and address blocks derived from the test tables.

Every row of a topic's events becomes one line.  The `case` branches on
`event_id` put malformed lines and edge values among them; they select what a row
looks like, not which rows are read.  The SQL texts are shared with the oracle
and differ only in the name of the text type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.catalog.agent_cases import AGENT_CASES

# One text for each remainder of `event_id`; the empty text is among them.
USER_AGENTS = tuple(text for text, _ in AGENT_CASES)

# Event type that stands for each topic.
ACTION_EVENTS = {"open": "view", "click": "click", "unsub": "signup"}
LOG_EVENTS = {"bounce": "error", "delivered": "purchase"}

_AGENT = (
    f"case event_id % {len(USER_AGENTS)} "
    + " ".join(f"when {n} then '{text}'" for n, text in enumerate(USER_AGENTS))
    + " end"
)

_DOTTED = """concat_ws('.', cast(event_id % 223 + 1 as {S}), cast(user_id % 256 as {S}),
      cast(event_id % 7 as {S}), '9')"""

_ACTION_LINE = f"""case
  when event_id % 97 = 0 then concat_ws(',', cast(event_id as {{S}}), 'evt', 'job1')
  when event_id % 109 = 0 then concat_ws(',', cast(event_id as {{S}}), 'evt', 'job2', '5', '1',
    '2024-01-02 03:04:05', '9.9.9.9')
  else concat_ws(',', cast(event_id as {{S}}), 'evt', concat('job', cast(user_id % 20 as {{S}})),
    cast(event_id % 10 as {{S}}), cast(event_id % 8 as {{S}}),
    case when event_id % 101 = 0 then 'baddate' else substring(cast(ts as {{S}}), 1, 19) end,
    case when event_id % 113 = 0 then 'not-an-ip'
      when event_id % 37 = 0 then concat('2001:db8:', lower(hex(user_id % 256)), '::', lower(hex(event_id % 65536)))
      when event_id % 41 = 0 then concat('2001:0DB8:', hex(user_id % 256), ':',
        case when event_id % 2 = 0 then '8000' else '7FFF' end, ':0:0:0:', hex(event_id % 65536))
      when event_id % 43 = 0 then concat('::ffff:', {_DOTTED})
      when event_id % 47 = 0 then '2001:db8::1::2'
      when event_id % 53 = 0 then '2001:db8:1:2:3'
      else {_DOTTED} end,
    '', {_AGENT}, '', '', cast(user_id % 130 as {{S}}), '',
    case when event_id % 103 = 0 then 'x' else cast(event_id % 28 as {{S}}) end) end"""

_LOG_LINE = """case
  when event_id % 97 = 0 then concat_ws(',', 'mta1', '2024-01-01')
  else concat(concat_ws(',', concat('mta', cast(user_id % 5 as {S})),
    case when event_id % 101 = 0 then 'baddate' else substring(cast(ts as {S}), 1, 19) end, '',
    case when event_id % 89 = 0 then 'noat'
      else concat('u', cast(user_id as {S}), '@mail', cast(user_id % 6 as {S}), '.example') end,
    concat_ws('-', concat('job', cast(user_id % 20 as {S})), cast(user_id as {S}),
      case when event_id % 7 = 0 then '1' when event_id % 107 = 0 then 'x' else '0' end,
      cast(event_id as {S}), concat('op', cast(user_id % 3 as {S}))),
    concat('d', cast(event_id % 4 as {S}), '.example-10.0.', cast(user_id % 8 as {S}), '.',
      cast(event_id % 4 as {S}))),
    case when event_type = 'error' then concat(',', case event_id % 6 when 0 then 'bad-mailbox'
      when 1 then 'inactive-mailbox' when 2 then 'policy-related' when 3 then 'quota-issues'
      when 4 then 'spam-related' else '' end) else '' end) end"""


def line_sql(topic: str, text_type: str) -> str:
    """The expression that turns an event of a topic into its line."""
    template = _ACTION_LINE if topic in ACTION_EVENTS else _LOG_LINE
    return template.replace("{S}", text_type)


def topic_event(topic: str) -> str:
    return {**ACTION_EVENTS, **LOG_EVENTS}[topic]


def _lines(events: DataFrame, topic: str) -> DataFrame:
    line = F.expr(line_sql(topic, "string")).cast("binary")
    rows = events.where(F.col("event_type") == topic_event(topic))
    return rows.select("event_id", line.alias("value"))


def topic_lines(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """`(event_id, value BINARY)`: all lines of a topic."""
    return _lines(spark.read.parquet(f"{sf_dir}/events.parquet"), topic)


def action_lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return {topic: _lines(events, topic) for topic in ACTION_EVENTS}


def log_lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return {topic: _lines(events, topic) for topic in LOG_EVENTS}


def isp_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return nation.select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("domain_name")
    )


def list_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("code"))


def nation_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block over half of most /8 networks, off network borders, gaps between."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    first = F.col("id") * 16777216 + 1000
    return (
        spark.range(256)
        .where("id % 9 <> 0")
        .join(nation, F.col("n_nationkey") == F.col("id") % 25)
        .select(
            first.alias("lo"),
            (first + 8388608 + 12345).alias("hi"),
            F.col("n_name").alias("country"),
        )
    )


def nation_blocks6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A /48 prefix, or the lower /49 half of one, for each of the same numbers."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return (
        spark.range(256)
        .where("id % 9 <> 0")
        .join(nation, F.col("n_nationkey") == F.col("id") % 25)
        .select(
            # 2001:db8:<id>::
            (F.lit(0x20010DB8 << 32) + F.shiftleft("id", 16)).alias("net_hi"),
            F.lit(0).cast("bigint").alias("net_lo"),
            F.expr("int(if(id % 9 = 1, 49, 48))").alias("prefix"),
            F.col("n_name").alias("country"),
        )
    )


def customer_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block per customer, spread evenly over all addresses: many blocks that
    grow with the data.  A block ends 300 addresses before the next begins."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    stride = customer.select(F.expr("4294967296 div (max(c_custkey) + 1)")).scalar()
    lo = F.col("c_custkey") * stride
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        lo.alias("lo"), (lo + stride - 301).alias("hi"), F.col("n_name").alias("country")
    )
