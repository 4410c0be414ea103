"""Batch operators on streams, by closed stretches of event time.

Adjacent pairs, pattern outcomes and timer groups look at most ``reach``
before and after a row of the same key, a window at most its size before its
end. A stream is therefore staged: each micro-batch is written below the
shared checkpoint folder, sorted by time (reads of a stretch skip the other
row groups) -- as it is, or already aggregated by a ``partial`` step (counts
per pane, distinct values, latest rows), so that only partial results are kept. Once the watermark (largest time
seen, less ``delay``) is far enough beyond the end of a stretch of chunks, the
batch operator runs on that stretch and its surroundings, and the results that
belong to it are written. All work is the batch operator's plan on the
executors; no state is kept per key, and nothing but two numbers (largest
time, end of the emitted stretch) goes through the driver.

Rows that only matter to a stretch that has been emitted are late and dropped;
all others count, in whatever order and micro-batches they arrive. Rows
without an event time are left out, as in batch. Each micro-batch overwrites
its own folders, so a replayed one has no effect, and a query started again
with the same ``path`` and ``checkpoint`` goes on where it stopped. Lines read
with their position are numbered within the micro-batch.

A bounded input is read to its end by :meth:`StagedStream.finish`: it stages
what there is and then emits everything that has not been emitted, in one run
of the operator, into a closing folder of its own. That moves neither the
watermark nor the emitted stretch: more input may follow, and the next
``finish`` replaces the closing folder. Staged batches that no open stretch can
reach are deleted, so what is listed and kept does not grow with the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from eventlytics.operators.durations import to_us
from eventlytics.operators.sequence import default_chunk_us
from eventlytics.session import child_names, delete_path, make_folder, path_exists, scratch_path
from eventlytics.sources.files import number_lines

_CLOSING = 1 << 62  # the batch number of what finish() writes


class StagedStream:
    """One staged run: ``op`` over a streaming frame (see the module notes).

    ``op`` takes the staged rows and returns a batch frame; ``emit`` says to
    which stretch a row of its result belongs: a timestamp column, or
    microseconds as an expression. ``reach`` is the operator's gap, delay or
    window size; ``ahead`` how much of it lies after a row (all of it by
    default; 0 for windows, which are complete at their end).
    """

    def __init__(self, df: DataFrame, op: Callable[[DataFrame], DataFrame], reach, emit: str | Column,
                 delay="1 millisecond", time_col: str = "et", chunk=None, name: str = "staged",
                 path: str | None = None, checkpoint: str | None = None,
                 partial: Callable[[DataFrame], DataFrame] | None = None, ahead=None):
        if (path is None) != (checkpoint is None):
            raise ValueError("give path and checkpoint of one run, or neither")
        self.df, self.op, self.time_col = df, op, time_col
        self.at = F.unix_micros(F.col(emit)) if isinstance(emit, str) else emit
        self.partial = partial or (lambda rows: rows)
        self.reach, self.delay = to_us(reach), to_us(delay)
        self.ahead = self.reach if ahead is None else to_us(ahead)
        self.chunk = to_us(chunk) if chunk is not None else default_chunk_us(self.reach)
        self.spark: SparkSession = df.sparkSession
        self.path = path or scratch_path(self.spark, f"{name}-out")
        self.checkpoint = checkpoint or scratch_path(self.spark, f"{name}-ckpt")
        self.closing = False
        rows = self.partial(number_lines(self.spark.createDataFrame([], StructType(list(df.schema.fields)))))
        self.staged_schema = StructType(list(rows.schema.fields)).add("_t", LongType()).add("batch", LongType())
        self.out_schema = op(self.spark.createDataFrame([], rows.schema)).schema

    # What is known after a batch is the name of an empty folder: batch, seen, done.
    def _states(self) -> dict[int, str]:
        return {int(n.split("_")[0]): n for n in child_names(self.spark, f"{self.path}/state")}

    def _state_before(self, batch_id: int) -> tuple[int | None, int | None]:
        """(largest time seen, end of the emitted stretch) before a batch."""
        states = self._states()
        last = max((b for b in states if b < batch_id), default=None)
        if last is None:
            return None, None
        return tuple(None if x == "none" else int(x) for x in states[last].split("_")[1:])

    def _keep_state(self, batch_id: int, seen: int | None, done: int | None) -> None:
        value = "_".join(["none" if x is None else str(x) for x in (batch_id, seen, done)])
        for b, name in self._states().items():
            if b == batch_id or b < batch_id - 1:  # an earlier try of this batch; older than a replay needs
                delete_path(self.spark, f"{self.path}/state/{name}")
        make_folder(self.spark, f"{self.path}/state/{value}")

    def _drop_unreachable(self, done: int) -> None:
        """Deletes staged batches that end before anything a stretch from
        ``done`` on can reach."""
        for name in child_names(self.spark, f"{self.path}/tops"):
            batch, top = name.split("_")
            if int(top) < done - 2 * self.reach:
                delete_path(self.spark, f"{self.path}/stage/batch={batch}")
                delete_path(self.spark, f"{self.path}/tops/{name}")

    def _emit(self, lo: int | None, hi: int | None, batch_id: int) -> None:
        """Write the results of the stretch [lo, hi) (None: no bound)."""
        rows = self.spark.read.schema(self.staged_schema).option("basePath", f"{self.path}/stage").parquet(
            f"{self.path}/stage").where(F.col("batch") <= batch_id)
        if lo is not None:
            rows = rows.where(F.col("_t") >= lo - 2 * self.reach)
        if hi is not None:
            rows = rows.where(F.col("_t") < hi + self.reach)
        out = self.op(rows.drop("_t", "batch"))
        if lo is not None:
            out = out.where(self.at >= lo)
        if hi is not None:
            out = out.where(self.at < hi)
        out.write.mode("overwrite").parquet(f"{self.path}/out/batch={batch_id}")

    def _on_batch(self, batch: DataFrame, batch_id: int) -> None:
        seen, done = self._state_before(batch_id)
        if done is not None:
            self._drop_unreachable(done)
        t = F.unix_micros(F.col(self.time_col))
        rows = number_lines(batch).where(t.isNotNull())
        if done is not None:  # what only emitted stretches need is late
            rows = rows.where(t >= done - (self.reach - self.ahead))
        folder = f"{self.path}/stage/batch={batch_id}"
        self.partial(rows).withColumn("_t", t).sortWithinPartitions("_t").write.mode("overwrite").parquet(folder)
        top = self.spark.read.schema(self.staged_schema).parquet(folder).agg(F.max("_t")).head()[0]
        if top is not None:
            make_folder(self.spark, f"{self.path}/tops/{batch_id}_{top}")
        seen = max((x for x in (seen, top) if x is not None), default=None)
        if seen is not None and not self.closing:
            closed = (seen - self.delay - self.ahead) // self.chunk * self.chunk
            if done is None or closed > done:
                self._emit(done, closed, batch_id)
                done = closed
        self._keep_state(batch_id, seen, done)

    def start(self, **trigger):
        """The running query; ``trigger`` as in ``writeStream.trigger``."""
        w = (self.df.writeStream.foreachBatch(self._on_batch).outputMode("append")
             .option("checkpointLocation", self.checkpoint))
        return (w.trigger(**trigger) if trigger else w).start()

    def results(self) -> DataFrame:
        """What has been emitted so far."""
        if not path_exists(self.spark, f"{self.path}/out"):
            return self.spark.createDataFrame([], self.out_schema)
        return self.spark.read.schema(self.out_schema).parquet(f"{self.path}/out").select(
            *self.out_schema.names)

    def finish(self) -> DataFrame:
        """All results of a bounded input: reads what there is, then emits
        what is left, as no further row can come (or, if some does, until the
        next ``finish``)."""
        self.closing = True
        try:
            self.start(availableNow=True).awaitTermination()
        finally:
            self.closing = False
        seen, done = self._state_before(_CLOSING)
        if seen is not None:
            self._emit(done, None, _CLOSING)
        return self.results()


def staged_stream(df: DataFrame, op: Callable[[DataFrame], DataFrame], reach, emit: str | Column,
                  **options) -> DataFrame:
    """Run ``op`` over a bounded stream to its end; see :class:`StagedStream`."""
    return StagedStream(df, op, reach, emit, **options).finish()
