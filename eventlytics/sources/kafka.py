"""Kafka topics as line sources and sinks.

The reference reads CSV lines from a topic with string deserialisers and
offset ``latest``, and a loader sends every CSV line to a topic. Here the
source is ``readStream.format("kafka")`` and the sink a distributed
``write.format("kafka")``: every executor sends its own partition, no
single process reads the file. The connector jar must be on the classpath
(``spark-sql-kafka-0-10``); it is not bundled, so only the option maps and
the encode / decode steps are exercised: lines, and whole records (key, value,
partition, offset, time) in the columns of Spark's source and sink.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                   starting_offsets: str = "latest") -> dict[str, str]:
    """Options for ``readStream.format("kafka")``; ``group_id`` maps to the
    consumer group prefix Spark allows (Spark manages offsets itself)."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["groupIdPrefix"] = group_id
    return opts


def sink_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}


def decode_lines(records: DataFrame) -> DataFrame:
    """Kafka records -> one text column ``value`` (string deserialiser)."""
    return records.select(F.col("value").cast("string").alias("value"))


def encode_lines(df: DataFrame, cols: Sequence[str], sep: str = ",") -> DataFrame:
    """Rows -> ``value`` text lines in the source's CSV layout."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias("value"))


def encode_records(df: DataFrame, cols: Sequence[str], topic: str, key: str | None = None,
                   partition: str | None = None, sep: str = ",") -> DataFrame:
    """Rows -> records as the sink takes them: ``topic``, ``key`` (bytes; null
    without ``key``), ``value`` (bytes of the CSV line; a null field is empty)
    and, if ``partition`` names a column, its number. All other columns stay
    unless they have one of these names."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    own = {"topic": F.lit(topic), "value": F.concat_ws(sep, *fields).cast("binary"),
           "key": F.col(key).cast("string").cast("binary") if key else F.lit(None).cast("binary")}
    if partition:
        own["partition"] = F.col(partition).cast("int")
    rest = [c for c in df.columns if c.lower() not in own]
    return df.select(*[e.alias(c) for c, e in own.items()], *rest)


def decode_records(records: DataFrame) -> DataFrame:
    """Records as the source gives them -> ``key`` and ``value`` as text (bytes
    that are no UTF-8 become replacement characters; a record without a value,
    a deletion, is left out), ``partition``, ``record_offset``, ``record_time``
    and ``seq``, which sorts the records of a partition in order of arrival
    (across partitions a topic has no order; here the partition's number)."""
    text = lambda c: F.make_valid_utf8(F.col(c).cast("string"))
    return records.where(F.col("value").isNotNull()).select(
        text("key").alias("key"), text("value").alias("value"), "topic", "partition",
        F.col("offset").alias("record_offset"), F.col("timestamp").alias("record_time"),
        F.struct(F.col("partition"), F.col("offset").alias("record_offset")).alias("seq"))


def offsets_after(records: DataFrame) -> DataFrame:
    """``(topic, partition, next_offset)``: where reading goes on after these
    records; with :func:`starting_offsets` the option of a later read."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def starting_offsets(after: DataFrame) -> str:
    """The ``startingOffsets`` text of ``offsets_after``: one number for each
    partition of the topics read, as few as a topic has."""
    per_topic: dict[str, dict[str, int]] = {}
    for r in after.orderBy("topic", "partition").toLocalIterator():
        per_topic.setdefault(r["topic"], {})[str(r["partition"])] = r["next_offset"]
    return json.dumps(per_topic)


def read_topic(spark: SparkSession, bootstrap_servers: str, topic: str,
               group_id: str | None = None, starting_offsets: str = "latest") -> DataFrame:
    """Stream of text lines from a topic."""
    reader = spark.readStream.format("kafka").options(
        **source_options(bootstrap_servers, topic, group_id, starting_offsets))
    return decode_lines(reader.load())


def write_topic(df: DataFrame, bootstrap_servers: str, topic: str, cols: Sequence[str]) -> None:
    """Publish rows as CSV lines, in parallel from every partition."""
    encode_lines(df, cols).write.format("kafka").options(
        **sink_options(bootstrap_servers, topic)).save()
