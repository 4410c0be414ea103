"""Running streams: parquet tables in the shared checkpoint folder, the
per-batch top-k sink, and the console sink (S5).

A run gets a fresh output and checkpoint path below ``spark.checkpoint.dir``
unless the caller gives both; given the paths of an earlier run it goes on
where that one stopped -- unless that one was brought to its end (below). The
per-batch writers overwrite their own batch folder, so a replayed batch writes
the same rows once.

A bounded stream ends: :func:`ending` adds a source that stays empty until
:func:`stream_result` or :func:`top_k_stream` has read everything else, and
then delivers one row far in the future. It moves the watermark past every
real window; its own windows never close, so it appears in no result. The
checkpoint then has that watermark for good, and every further row would be
late: a run that was brought to its end is marked, and starting it again is an
error. Streams that end and go on later are the staged ones (``staged.py``,
``windows.py``), whose end moves no watermark.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventlytics.operators.topk import top_k_per_window
from eventlytics.session import make_folder, path_exists, scratch_path

# The time of the row that ends a stream, beyond any real one.
END = datetime.datetime(9000, 1, 1)


class End:
    """The end marks of a run's streams: one folder each."""

    def __init__(self, spark: SparkSession):
        self.spark, self.marks = spark, []

    def ending(self, df: DataFrame, time_col: str = "et") -> DataFrame:
        """``df`` and, once :meth:`reach` is called, its last row. Call it
        before the watermark is set."""
        folder = scratch_path(self.spark, "end")
        schema = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
        self.spark.createDataFrame([], schema).write.parquet(folder)
        self.marks.append((folder, schema, time_col))
        return df.unionByName(self.spark.readStream.schema(schema).parquet(folder))

    def reach(self) -> None:
        for folder, schema, time_col in self.marks:
            row = [END if f.name == time_col else None for f in schema.fields]
            self.spark.createDataFrame([tuple(row)], schema).coalesce(1).write.mode("append").parquet(folder)


def _ended(spark: SparkSession, checkpoint: str) -> str:
    return f"{checkpoint}/ended"


def _refuse_ended(spark: SparkSession, checkpoint: str) -> None:
    if path_exists(spark, _ended(spark, checkpoint)):
        raise RuntimeError(f"the run of {checkpoint} was brought to its end: all further rows would be late. "
                           "Start anew, or use a staged stream")


def run_available_now(df: DataFrame, name: str, output_mode: str = "append", path: str | None = None,
                      checkpoint: str | None = None, end: End | None = None) -> str:
    """Run a streaming frame over all available input into a parquet table;
    return the table path. With ``end`` the stream is then brought to its
    end, so that every window is emitted."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    _refuse_ended(spark, checkpoint)

    def once() -> None:
        (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode(output_mode)
         .trigger(availableNow=True).start().awaitTermination())

    once()
    if end is not None:
        make_folder(spark, _ended(spark, checkpoint))
        end.reach()
        once()
    return path


def stream_result(df: DataFrame, name: str, end: End | None = None, path: str | None = None,
                  checkpoint: str | None = None) -> DataFrame:
    """Run ``df`` (a stream) over all available input and return its rows."""
    schema = df.schema
    return df.sparkSession.read.schema(schema).parquet(
        run_available_now(df, name, path=path, checkpoint=checkpoint, end=end))


def top_k_stream(counts: DataFrame, key: str, k: int, name: str, window_col: str = "window_end",
                 count_col: str = "cnt", path: str | None = None, checkpoint: str | None = None,
                 end: End | None = None) -> DataFrame:
    """Top-k per window of an append-mode windowed count stream.

    Append mode emits every window once, complete, when the watermark closes
    it, so each micro-batch is ranked with the batch operator (partial
    ``WindowGroupLimit`` and all) and written to its own batch folder.
    ``path`` and ``checkpoint`` belong together: both of one earlier run, or
    neither.
    """
    if (path is None) != (checkpoint is None):
        raise ValueError("give path and checkpoint of one run, or neither")
    spark = counts.sparkSession
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    _refuse_ended(spark, checkpoint)
    cols = list(counts.columns) + ["rank"]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ranked = top_k_per_window(batch, key, k, window_col, count_col).select(*cols)
        ranked.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    def once() -> None:
        (counts.writeStream.foreachBatch(write_batch).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())

    once()
    if end is not None:
        make_folder(spark, _ended(spark, checkpoint))
        end.reach()
        once()
    schema = StructType(counts.schema.fields + [StructField("rank", LongType())])
    if not path_exists(spark, path):  # no batch has run
        return spark.createDataFrame([], schema).select(*cols)
    return spark.read.schema(schema).parquet(path).select(*cols)


def console(df: DataFrame, output_mode: str = "append", truncate: bool = False,
            available_now: bool = False):
    """Print a stream to stdout (the reference's ``print``); returns the query."""
    w = (df.writeStream.format("console").outputMode(output_mode)
         .option("truncate", str(truncate).lower())
         .option("checkpointLocation", scratch_path(df.sparkSession, "console-ckpt")))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def write_sides(df: DataFrame, paths: dict[str, str], column: str = "status") -> None:
    """Several outputs of one result (S6): its rows by the value of
    ``column``, each to its own table, from one run of ``df``."""
    spark = df.sparkSession
    whole = scratch_path(spark, "sides")
    df.write.partitionBy(column).parquet(whole)
    rows = spark.read.schema(StructType([f for f in df.schema.fields if f.name != column]).add(
        df.schema[column])).parquet(whole)
    for value, path in paths.items():
        rows.where(F.col(column) == value).write.mode("overwrite").parquet(path)
