"""Kafka framing: per-row topic routing, message key and JSON value.

The Kafka connector jar is not part of a plain PySpark install, so the frame
(``topic, key, value``) and the option sets are plain functions; with the
connector on the classpath they feed ``write.format("kafka")`` and
``readStream.format("kafka")`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions import FEED_SYMBOLS, kafka_topic
from tradelake.schema import BRONZE_COLUMNS


def kafka_envelope(trades: DataFrame) -> DataFrame:
    """One message per trade: topic ``lower(symbol)_trades``, key = trade id
    text, value = the trade as JSON.  A ``topic`` column routes each row."""
    return trades.select(
        kafka_topic(F.col("symbol")).alias("topic"),
        F.col("trade_id").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in BRONZE_COLUMNS])).alias("value"),
    )


def topics(symbols=FEED_SYMBOLS) -> list[str]:
    return [f"{s.lower()}_trades" for s in symbols]


def source_options(bootstrap: str, symbols=FEED_SYMBOLS, group: str = "tradelake-bronze",
                   max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options of the source.  Offsets that retention has removed stop the
    query, unless ``fail_on_data_loss`` is switched off on purpose."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": ",".join(topics(symbols)),
            "startingOffsets": "earliest", "kafka.group.id": group,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_kafka_stream(spark: SparkSession, bootstrap: str, **kw) -> DataFrame:
    """Unbounded frames: ``value`` (text) and the broker ``timestamp``."""
    raw = spark.readStream.format("kafka").options(**source_options(bootstrap, **kw)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "timestamp", "topic", "partition", "offset")


def write_kafka(trades: DataFrame, bootstrap: str) -> None:
    kafka_envelope(trades).write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save()


def write_kafka_stream(trades: DataFrame, bootstrap: str, checkpoint: str, processing_time: str = "5 seconds"):
    """Streaming sink with per-row topic routing; returns the started query."""
    return (kafka_envelope(trades).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap).option("checkpointLocation", checkpoint)
            .trigger(processingTime=processing_time).start())
