"""Time-chunked keyed partitions with halos.

The keyed sequence operators (adjacent pairs, pattern timeouts, timer
closed forms) need each event's neighbours in time *within its key*. A
plain ``Window.partitionBy(key)`` puts all rows of a key in one task; one
hot key holding a third of all rows would then be sorted by one task.

Here a key's rows are cut into time chunks of width ``chunk_us`` and every
window function is partitioned by ``(key, chunk)``. A row's neighbours lie
at most ``halo_us`` away (the operator's gap or delay), so each chunk also
receives a copy of the rows within ``halo_us`` of its edge from the
adjacent chunk, flagged ``_halo``. Halo rows only give context; results are
taken from the chunk's own rows. With ``chunk_us >= halo_us`` a row is
copied at most once, so the extra volume is at most ``halo_us / chunk_us``.

A chunk may also be narrower than the halo, to split a key whose rows crowd
into a few gaps. Then copying all rows within the halo would copy each one
many times; but all that a chunk needs from another is its edge (its last
row for looking back, its first for looking ahead), so only those are taken
by an aggregation, partial before its shuffle, and copied to the chunks
within reach (:func:`with_edges`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000

# Chunk width default: four halos wide (<= 25% copied rows), at least one hour.
def default_chunk_us(halo_us: int) -> int:
    return max(4 * halo_us, HOUR_US)


def floor_div(a: Column, b: int) -> Column:
    """Exact integer floor division for |a| < 2**53 (epoch µs: ~285 years):
    ``a - pmod(a, b)`` is an exact multiple of ``b``, so the double quotient
    is exact."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("bigint")


def chunk_of(t_us: Column, chunk_us: int) -> Column:
    return floor_div(t_us, chunk_us)


def with_halo(df: DataFrame, t_col: str, halo_us: int, chunk_us: int, side: str) -> DataFrame:
    """Assign ``_chunk`` and ``_halo`` (copies made as described above).

    ``side="before"``: rows near the end of chunk c are copied into c+1
    (context for looking back). ``side="after"``: rows near the start of
    chunk c are copied into c-1 (context for looking ahead).
    """
    if chunk_us < halo_us:
        raise ValueError("chunk width must be at least the halo width")
    t = F.col(t_col)
    c = chunk_of(t, chunk_us)
    offset = t - c * F.lit(chunk_us)
    own = F.struct(c.alias("_chunk"), F.lit(False).alias("_halo"))
    if side == "before":
        near, other = offset >= F.lit(chunk_us - halo_us), c + 1
    elif side == "after":
        near, other = offset < F.lit(halo_us), c - 1
    else:
        raise ValueError("side must be 'before' or 'after'")
    copy = F.struct(other.alias("_chunk"), F.lit(True).alias("_halo"))
    targets = F.when(near, F.array(own, copy)).otherwise(F.array(own))
    return df.select("*", F.inline(targets))


def with_edges(df: DataFrame, keys: list[str], t_col: str, order: list[str], carry: list[str],
               halo_us: int, chunk_us: int, side: str) -> DataFrame:
    """As :func:`with_halo` for chunks of any width: each chunk gets the last
    (``before``) or first (``after``) row of the chunks within the halo, with
    the columns ``keys``, ``t_col``, ``order`` and ``carry``; the others are
    NULL in these rows."""
    own = df.withColumn("_chunk", chunk_of(F.col(t_col), chunk_us)).withColumn("_halo", F.lit(False))
    kept = list(dict.fromkeys([t_col, *order, *carry]))
    pick = F.max_by if side == "before" else F.min_by
    step = 1 if side == "before" else -1
    reach = F.sequence(F.lit(1), F.lit(halo_us // chunk_us + 1))
    edges = own.groupBy(*keys, "_chunk").agg(pick(F.struct(*kept), F.struct(*order)).alias("_e"))
    edges = edges.select(*keys, "_chunk", "_e", F.explode(reach).alias("_k"))
    cols = []
    for f in own.schema.fields:
        if f.name in keys:
            cols.append(F.col(f.name))
        elif f.name == "_chunk":
            cols.append((F.col("_chunk") + F.lit(step) * F.col("_k")).alias("_chunk"))
        elif f.name == "_halo":
            cols.append(F.lit(True).alias("_halo"))
        elif f.name in kept:
            cols.append(F.col(f"_e.{f.name}").alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return own.union(edges.select(*cols))
