"""Text sources: the behaviour CSV and the space-separated access log.

Both read in batch or as a stream (``stream=True``) with the same parse.
``mode`` decides what a malformed line does:

* ``failfast``  -- the job fails on the first bad line (the reference's
  behaviour: its parse lambda throws);
* ``quarantine`` -- bad lines are kept aside: the result carries a
  ``_bad`` flag and :func:`split_quarantine` separates good from bad rows.

With ``position=True`` a line carries its arrival order ``seq``: its file, the
place of its block in the file and its number within the block's read. However
the read is split into tasks, blocks follow each other by their places and
lines are read in order, so that ``seq`` always sorts like the lines of the
files. A stream knows the block at first; :func:`number_lines` adds the number
to each micro-batch (staged streams do it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Access-log token positions and time format of the reference.
LOG_SEPARATOR = " "
LOG_IP, LOG_USER, LOG_TIME, LOG_ZONE, LOG_METHOD, LOG_URL = 0, 2, 3, 4, 5, 6
LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"
BEHAVIOR_SEPARATOR = ","

_MODES = ("failfast", "quarantine")


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None, position: bool = False) -> DataFrame:
    """One row per line, column ``value`` (S1); with ``position`` also ``seq``,
    its arrival order (files by their paths)."""
    r = _reader(spark, stream)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = r.text(path)
    if not position:
        return lines
    block = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.select("value", block.alias("seq"))
    return lines if stream else number_lines(lines)


def number_lines(df: DataFrame) -> DataFrame:
    """Completes the ``seq`` of lines of a stream within a micro-batch; any
    other frame is returned as it is. Rows must still be in the order of the
    read: only projections and filters may come before."""
    kind = df.schema["seq"].dataType if "seq" in df.columns else None
    if not isinstance(kind, StructType) or kind.names != ["file", "block"]:
        return df
    return df.withColumn("seq", F.struct("seq.file", "seq.block", F.monotonically_increasing_id().alias("row")))


def _order(lines: DataFrame) -> list[str]:
    return ["seq"] if "seq" in lines.columns else []


def parse_behavior(lines: DataFrame, mode: str = "failfast", keep: Sequence[str] = ()) -> DataFrame:
    """Split ``value`` on commas into the behaviour record.

    failfast fails on the first line with a missing or bad field, used or
    not; quarantine uses ``try_cast`` and flags the row. A ``seq`` of the
    lines stays, as do the columns named in ``keep``.
    """
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}")
    parts = F.split(F.col("value"), BEHAVIOR_SEPARATOR)
    names = ["user_id", "item_id", "category_id", "behavior", "ts_s"]
    types = ["bigint", "bigint", "int", "string", "bigint"]
    cols = [F.try_element_at(parts, F.lit(i + 1)).try_cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types))]
    good = F.lit(True)
    for c in cols:
        good = good & c.isNotNull()
    if mode == "failfast":
        # a filter: it stays when unused columns are pruned
        checked = F.when(good, True).otherwise(F.raise_error(F.concat(F.lit("bad behaviour line: "), F.col("value"))))
        return lines.where(checked).select(*cols, *_order(lines), *keep)
    return lines.select(*cols, *_order(lines), *keep, F.col("value").alias("_line"), (~good).alias("_bad"))


def read_behavior(spark: SparkSession, path: str, mode: str = "failfast",
                  stream: bool = False, max_files_per_trigger: int | None = None,
                  position: bool = False) -> DataFrame:
    """Behaviour CSV without header (S1 + P1)."""
    return parse_behavior(read_lines(spark, path, stream, max_files_per_trigger, position), mode)


_LENIENT = r"^(\d+)/(\d+)/(\d+):(\d+):(\d+):(\d+)"  # what follows is ignored


def lenient_time(text: Column) -> Column:
    """A log time whose fields may be out of range and then roll over: the
    32nd of January is the 1st of February, the 14th month February of the
    next year, 25:61:61 is 02:02:01 of the next day (UTC). Null if it is no
    such text. Calendar arithmetic: months from January of the year, then days,
    then seconds."""
    day, month, year, hour, minute, second = (F.regexp_extract(text, _LENIENT, i).try_cast("int") for i in range(1, 7))
    first = F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1)
    seconds = (F.unix_date(first).cast("bigint") + day - 1) * 86_400 + hour.cast("bigint") * 3_600 + \
        minute.cast("bigint") * 60 + second
    return F.when(text.rlike(_LENIENT), F.timestamp_seconds(seconds))


def parse_access_log(lines: DataFrame, mode: str = "failfast", use_zone: bool = False,
                     lenient: bool = False) -> DataFrame:
    """Tokens 0 ip, 2 user, 3 time, 5 method, 6 url.

    Time is read in the session zone (UTC); ``use_zone=True`` applies the
    offset token 4 instead. ``lenient=True`` rolls fields over that are out of
    range, as the reference's date reader does (:func:`lenient_time`); only a
    text without these fields is then a bad line.
    """
    if lenient and use_zone:
        raise ValueError("lenient times are read without a zone")
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}")
    tok = F.split(F.col("value"), LOG_SEPARATOR)
    strict = mode == "failfast"

    def at(i):
        return F.element_at(tok, i + 1) if strict else F.try_element_at(tok, F.lit(i + 1))

    if use_zone:
        ts_text, fmt = F.concat_ws(" ", at(LOG_TIME), at(LOG_ZONE)), LOG_TIME_FORMAT + " Z"
    else:
        ts_text, fmt = at(LOG_TIME), LOG_TIME_FORMAT
    if lenient:
        et = lenient_time(ts_text)
        if strict:
            bad = F.raise_error(F.concat(F.lit("bad log time: "), ts_text)).cast("timestamp")
            et = F.coalesce(et, bad)
    else:
        et = F.to_timestamp(ts_text, fmt) if strict else F.try_to_timestamp(ts_text, F.lit(fmt))
    cols = [at(LOG_IP).alias("ip"), at(LOG_USER).alias("user_id"), et.alias("et"),
            at(LOG_METHOD).alias("method"), at(LOG_URL).alias("url"), *_order(lines)]
    if strict:
        return lines.select(*cols)
    out = lines.select(*cols, F.col("value").alias("_line"))
    bad = F.lit(False)
    for n in ("ip", "user_id", "et", "method", "url"):
        bad = bad | F.col(n).isNull()
    return out.withColumn("_bad", bad)


def read_access_log(spark: SparkSession, path: str, mode: str = "failfast", stream: bool = False,
                    use_zone: bool = False, max_files_per_trigger: int | None = None,
                    lenient: bool = False, position: bool = False) -> DataFrame:
    """Access log (S1 + P2)."""
    return parse_access_log(read_lines(spark, path, stream, max_files_per_trigger, position), mode, use_zone, lenient)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the flag columns, bad rows with their raw line)."""
    good = df.where(~F.col("_bad")).drop("_bad", "_line")
    bad = df.where(F.col("_bad")).select("_line")
    return good, bad
