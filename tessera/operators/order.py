"""Order-dependent primitives that never funnel a whole table (or one hot
group) through a single task.

Three building blocks carry every operator that needs a rank, a running
total or an exact position in an order:

* ``hash_rank``   -- exact 1-based rank of each row inside a stratum in the
  order of ``md5(seed ':' key)``. Rows are bucketed by the first hex digits
  of the hash (uniform by construction), bucket counts give per-bucket rank
  offsets (a table of at most strata x 16^digits rows), and a window sorts
  only inside one (stratum, bucket). No global sort, no single partition.
* ``hash_head``   -- the first rows of that order, decided by bucket counts,
  without moving the table.
* ``range_split``  -- contiguous ranges of any order, fixed once by a
  reliable checkpoint, their number following the number of rows.
* ``running_sum``  -- inclusive cumulative sums in an order, optionally per
  group: range totals are turned into offsets on a small table, and the
  running sum inside a range is a window over that range only.
  ``global_position`` numbers rows the same way.

Joins against the small offset tables are left to AQE, which turns them into
broadcast joins after measuring their real size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

HASH_SEP = ":"
#: rows of one range of an order (one task's share)
ROWS_PER_RANGE = 1_000_000
#: rows of an offset table (a few numbers each) that may be broadcast
BROADCAST_ROWS = 500_000
#: numbers of buckets that may become literals of a filter
TORN = 200


def hash_hex(key: Column | str, seed) -> Column:
    """md5 of ``seed ':' key`` as 32 hex chars; the same text in DuckDB is
    ``md5(seed || ':' || CAST(key AS VARCHAR))``."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(str(seed)), F.lit(HASH_SEP), key.cast("string")))


def _hash_buckets(df: DataFrame, key: str, seed, digits: int) -> DataFrame:
    """The md5 order as numbers: ``_hb`` = first ``digits`` hex digits, then
    the remaining digits as two numbers (<= 15 hex digits each, so no
    overflow of a long; only 1 digit leaves 16, a decimal); (_hb, _h1, _h2)
    orders exactly like the 32-char hex text, and numbers sort much faster than
    strings. A NULL key hashes like an empty one: its rows keep a rank."""
    h = hash_hex(F.coalesce(F.col(key).cast("string"), F.lit("")), seed)
    rest = 32 - digits
    n1 = min(15, rest)
    return df.withColumn("_h", h).select(
        "*", F.conv(F.substring("_h", 1, digits), 16, 10).cast("int").alias("_hb"),
        F.conv(F.substring("_h", digits + 1, n1), 16, 10).cast("long").alias("_h1"),
        F.conv(F.substring("_h", digits + 1 + n1, rest - n1), 16, 10).cast("long" if rest - n1 <= 15 else "decimal(20,0)").alias("_h2")
    ).drop("_h")


def _bucket_offsets(d: DataFrame, strata: list) -> DataFrame:
    """Per (stratum, bucket): rows ``_hn``, rows before it ``_hoff``, stratum size ``_n_stratum``."""
    cnt = d.groupBy(*strata, "_hb").agg(F.count(F.lit(1)).alias("_hn"))
    before = Window.partitionBy(*strata).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    return cnt.select(*strata, "_hb", "_hn", F.coalesce(F.sum("_hn").over(before), F.lit(0)).alias("_hoff"),
                      F.sum("_hn").over(Window.partitionBy(*strata)).alias("_n_stratum"))


def hash_rank(df: DataFrame, key: str, seed, strata=(), out: str = "_rank",
              digits: int = 3) -> DataFrame:
    """Add ``out``: 1-based rank of the row inside its stratum ordered by
    ``(md5(seed:key), key)``; also keeps ``_n_stratum`` (stratum size).

    ``key`` should be unique; copies of a key share a hash and are ordered
    only by the key itself.
    """
    strata = [strata] if isinstance(strata, str) else list(strata)
    d = _hash_buckets(df, key, seed, digits)
    off = cut_lineage(_bucket_offsets(d, strata).drop("_hn"))
    hint = F.broadcast if off.count() <= BROADCAST_ROWS else (lambda x: x)  # the rows are shuffled once, for the window
    joined = join_null_safe(d, hint(off), [*strata, "_hb"])  # a NULL stratum is a stratum
    inner = Window.partitionBy("_hb", *strata).orderBy("_h1", "_h2", key)  # a sort compares the first column fastest
    return joined.withColumn(out, (F.col("_hoff") + F.row_number().over(inner)).cast("long")) \
        .drop("_h1", "_h2", "_hb", "_hoff")


def hash_head(df: DataFrame, key: str, seed, quota, strata=(), out: str = "_head", digits: int = 3) -> DataFrame:
    """Add ``out``: is the row among the first ``quota`` of its stratum in md5
    order? Same rows as ``hash_rank`` <= quota, without moving the table.

    ``quota``: a Column over ``_n_stratum``, or a function from the frame
    (strata, ``_nc`` = rows) to a frame (strata, ``_quota``).
    Bucket counts alone decide every bucket but the one the quota falls into;
    only that bucket's rows (one in 16^digits) are ranked by a window. The
    offset table is broadcast after its size is checked, so the wide rows
    pass a filter and a projection, not a shuffle."""
    strata = [strata] if isinstance(strata, str) else list(strata)
    d = _hash_buckets(df, key, seed, digits)
    off = _bucket_offsets(d, strata)
    if callable(quota):  # the bucket counts give the strata's sizes: no scan of its own
        off = cut_lineage(off)
        off = join_null_safe(off, quota(off.groupBy(*strata).agg(F.sum("_hn").alias("_nc"))), strata, "left")
    else:
        off = off.withColumn("_quota", quota)
    need = F.col("_quota") - F.col("_hoff")
    off = cut_lineage(off.select(*strata, "_hb", F.when(need >= F.col("_hn"), 1).when(need <= 0, 0).otherwise(2).alias("_state"),
                                 need.alias("_need")))
    hint = F.broadcast if off.count() <= BROADCAST_ROWS else (lambda x: x)
    j = join_null_safe(d, hint(off), [*strata, "_hb"])
    inner = Window.partitionBy("_hb", *strata).orderBy("_h1", "_h2", key)
    sure = j.where(F.col("_state") < 2).withColumn(out, F.col("_state") == 1)
    cut = [r[0] for r in off.where("_state = 2").select("_hb").distinct().limit(TORN + 1).collect()]
    if len(cut) <= TORN:  # the bucket alone, a literal, leaves few rows before any other column is computed
        torn = join_null_safe(d.where(F.col("_hb").isin(cut)), hint(off), [*strata, "_hb"])
    else:
        torn = j
    torn = torn.where(F.col("_state") == 2).withColumn(out, F.row_number().over(inner) <= F.col("_need"))
    return sure.unionByName(torn).drop("_h1", "_h2", "_hb", "_state", "_need")


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (group keys may be
    NULL); the right side's key columns are dropped."""
    keys = list(keys)
    if not keys:
        return left.crossJoin(right)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def range_split(df: DataFrame, order, rows_per_range: int = ROWS_PER_RANGE, partitions: int | None = None,
                out: str = "_rng") -> DataFrame:
    """Cut the frame into contiguous ranges of the order ``order`` (column
    names or sort expressions, any orderable types) and fix the cut: ``out``
    is the range number, ``_mid`` ascends with the order.

    The boundaries come from Spark's range sample, which differs from plan to
    plan, so the ranged and sorted rows are checkpointed: whatever is computed
    from them (range sizes, offsets, the rows themselves) sees the same ranges.
    The number of ranges follows the number of rows."""
    n = partitions
    if n is None:
        rows = df.count()
        par = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        n = max(1, min(par, -(-rows // 20_000)), -(-rows // rows_per_range))
    r = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return cut_lineage(r.withColumns({out: F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}))


def running_sum(df: DataFrame, order: str, values: list[str], partition=(),
                tiebreak=(), descending: bool = False, partitions: int | None = None,
                suffix: str = "_cum", totals: bool = False) -> DataFrame:
    """Inclusive running sums of ``values`` ordered by ``order`` (any
    orderable type, then ``tiebreak``) inside each ``partition`` group; with
    ``totals`` also the group total ``<v>_tot``.

    Meant for pre-aggregated inputs (one row per distinct order value), so a
    hot order value is already one row. The input is materialised once, then
    cut into ranges of (group, order), so a hot group spreads over as many
    ranges as its rows need. Group keys may be NULL (null-safe joins).
    """
    partition = [partition] if isinstance(partition, str) else list(partition)
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    ordering = [F.col(c).desc() if descending else F.col(c) for c in (order, *tiebreak)]
    d = range_split(cut_lineage(df), [*[F.col(c) for c in partition], *ordering], partitions=partitions, out="_rb")
    seg = d.groupBy(*partition, "_rb").agg(*[F.sum(v).alias(f"_seg_{v}") for v in values])
    before = Window.partitionBy(*partition).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*partition)
    off = seg.select(*partition, "_rb", *[
        F.coalesce(F.sum(f"_seg_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in values],
        *[F.sum(f"_seg_{v}").over(whole).alias(f"{v}_tot") for v in values])
    if not totals:
        off = off.drop(*[f"{v}_tot" for v in values])
    d = join_null_safe(d, off, [*partition, "_rb"])
    inner = Window.partitionBy(*partition, "_rb").orderBy("_mid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    for v in values:
        d = d.withColumn(v + suffix, F.col(f"_off_{v}") + F.sum(v).over(inner))
    return d.drop("_mid", "_rb", *[f"_off_{v}" for v in values])


def global_position(df: DataFrame, order, out: str = "_pos", partitions: int | None = None) -> DataFrame:
    """0-based position of each row in a total order over the whole frame
    (works for any orderable type, e.g. strings).

    The ranges are fixed once (``range_split``); inside a range
    ``monotonically_increasing_id`` numbers the sorted rows (its high bits are
    the partition index), and range sizes -- one row per range, a proven
    bound -- become broadcast offsets. No single-partition window on data."""
    order = [order] if isinstance(order, str) else list(order)
    r = range_split(df, [F.col(c) for c in order], partitions=partitions, out="_pid")
    sizes = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_psz"), F.min("_mid").alias("_pfirst"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("_pid", "_pfirst", F.coalesce(F.sum("_psz").over(before), F.lit(0)).alias("_poff"))
    r = r.join(F.broadcast(offs), on="_pid", how="inner")
    return r.withColumn(out, (F.col("_poff") + F.col("_mid") - F.col("_pfirst")).cast("long")) \
        .drop("_mid", "_pid", "_poff", "_pfirst")
