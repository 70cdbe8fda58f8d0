"""List-shaped helpers: positional zip, ordered cap, first-match lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import posexplode_rows


def zip_shortest(df: DataFrame, left: str, right: str, left_name: str, right_name: str,
                 keep: list[str], pos_col: str = "pos") -> DataFrame:
    """Pair two array columns by position, stopping at the shorter one (``arrays_zip`` pads
    with nulls, so the zipped array is cut to the smaller size first)."""
    n = F.least(F.size(left), F.size(right))
    z = F.slice(F.arrays_zip(F.col(left).alias(left_name), F.col(right).alias(right_name)), 1, n)
    return (posexplode_rows(df, keep, z, pos_col, "pair")
              .select(*keep, F.col(pos_col).cast("long"), f"pair.{left_name}", f"pair.{right_name}"))


def fan_out_cap(df: DataFrame, run_col: str, order_col: str, cap: int = 10, pos_col: str = "pos") -> DataFrame:
    """First ``cap`` rows of each run in order, numbered from 1.

    ``row_number() <= cap`` is planned as a WindowGroupLimit: each task keeps at most
    ``cap`` rows per run before the shuffle, so a run holding most of the rows costs no more
    than any other."""
    w = Window.partitionBy(run_col).orderBy(order_col)
    return df.withColumn(pos_col, F.row_number().over(w).cast("long")).where(F.col(pos_col) <= cap)


def global_index(df: DataFrame, order_cols: list, start: int = 1, out_col: str = "row_idx") -> DataFrame:
    """Consecutive index over the whole table in the given order, without funnelling the rows
    through one task (which a window with no partition key would do).

    The table is range-sorted (a distributed sort), cut from its lineage by a checkpoint in the
    shared checkpoint folder so both passes see identical partitions, rows are counted per
    partition (one small row per partition), and each row's index is its partition's offset
    plus its position inside the partition.  The offset table is bounded by the number of
    partitions, so it is broadcast."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    s = df.orderBy(*order_cols).checkpoint(eager=True)
    s = s.withColumn("_pid", F.spark_partition_id()) \
         .withColumn("_ord", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    counts = s.groupBy("_pid").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = s.join(F.broadcast(offsets), "_pid")
    return out.withColumn(out_col, (F.col("_off") + F.col("_ord") + start).cast("long")).drop("_pid", "_ord", "_off")


MAX_PROBE_BYTES = 256 * 1024 * 1024


def probe_join(left: DataFrame, right: DataFrame, key: str, how: str = "left",
               max_broadcast_bytes: int = MAX_PROBE_BYTES) -> DataFrame:
    """Join a request table (usually small) to a lookup table (possibly huge).

    When the distinct request keys fit ``max_broadcast_bytes`` they are broadcast and the lookup
    table is first reduced to the matching keys by a map-side semi join, so the big side is
    scanned and filtered but never shuffled whole; the final join then sees only the matches.
    Above the bound it is a plain shuffle join."""
    keys = left.select(key).distinct()
    size = keys.agg(F.sum(F.length(F.col(key).cast("string")) + 16).alias("b")).first()["b"] or 0
    if size <= max_broadcast_bytes:
        right = right.join(F.broadcast(keys), key, "left_semi")
    return left.join(right, key, how)
