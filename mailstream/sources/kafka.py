"""Message-bus source: one topic, from its earliest offset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Topic names by row label.
ACTION_TOPICS = {
    "open": "open_actions",
    "click": "click_actions",
    "unsub": "unsub_actions",
}
LOG_TOPICS = {"bounce": "pmta-bounce", "delivered": "pmta-delivered"}


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of `value BINARY`, one row per message of a topic.

    `max_offsets_per_trigger` bounds a micro-batch, which matters on the first
    run over a topic that already holds a long history.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select("value")
