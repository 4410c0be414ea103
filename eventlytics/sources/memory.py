"""In-memory rows as a table or as a stream.

The reference builds small streams from literal collections. In batch the
rows become a DataFrame with a ``seq`` column (arrival order, the tie-break
of every ordering here). As a stream each row is written as its own file
into a fresh folder below the checkpoint root and read back one file per
micro-batch, so a test can drive a query row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from eventlytics.session import scratch_path


def rows_to_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str | StructType,
                  seq_col: str = "seq") -> DataFrame:
    """Literal rows plus their position as ``seq``."""
    df = spark.createDataFrame([tuple(r) + (i,) for i, r in enumerate(rows)],
                               _with_seq(spark, schema, seq_col))
    return df


def _with_seq(spark: SparkSession, schema: str | StructType, seq_col: str) -> StructType:
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return StructType(st.fields + StructType.fromDDL(f"{seq_col} BIGINT").fields)


def rows_to_stream(spark: SparkSession, rows: Sequence[Sequence], schema: str | StructType,
                   seq_col: str = "seq", rows_per_file: int = 1,
                   folder: str | None = None) -> tuple[DataFrame, str]:
    """A file stream that replays ``rows`` in order, ``rows_per_file`` per
    micro-batch. Returns the streaming frame and its folder."""
    st = _with_seq(spark, schema, seq_col)
    folder = folder or scratch_path(spark, "rows")
    for start in range(0, len(rows), rows_per_file):
        chunk = [tuple(r) + (start + i,) for i, r in enumerate(rows[start:start + rows_per_file])]
        (spark.createDataFrame(chunk, st).coalesce(1).write.mode("overwrite")
         .parquet(f"{folder}/part={start:09d}"))
    stream = (spark.readStream.schema(st).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(folder))
    return stream, folder
