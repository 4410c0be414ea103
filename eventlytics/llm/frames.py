"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.session import scratch_path

# White space of the word contract: space and \t \n \v \f \r (fixed value).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
NONE_VALUE = "(none)"  # stands for a null source or language
LEARN_FOLDS = 3
HELD_OUT_FOLD = 1


def table(spark, sf_dir: str, name: str) -> DataFrame:
    """A driver table: one parquet file or a directory of them."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with a suffix, so that no column of ``df`` has
    that name (column names are matched without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"{base}_{uuid.uuid4().hex[:6]}"
    return name


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns, so that any others cannot clash with ours."""
    return df.select(*[df[n].alias(n) for n in names])


def words(text: Column) -> Column:
    """The words of a text (null or empty: an empty array)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN), F.lit(0))


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 3 is 1; false for a null id."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % LEARN_FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """True where a model may learn from the row (a null id: never)."""
    return doc_id.isNotNull() & ~held_out(doc_id)


def small_side(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """A join side, broadcast only if it is counted to have at most
    ``max_rows`` rows; else returned as it is, for a shuffled join. For
    narrow rows (an id and a number): at most some 40 MB broadcast."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Actions in this block drop their shuffle files when they end; else
    these stay until the driver collects garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back:
    cuts the lineage, is computed once however often it is used, and
    survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def constant_array(values, sql_type: str = "double") -> Column:
    """An array literal of many numbers (folded to one literal once)."""
    text = ",".join(repr(v) for v in values)
    return F.split(F.lit(text), ",").cast(f"array<{sql_type}>")
