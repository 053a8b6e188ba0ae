"""Look-up joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

LEAST_ROWS = 10_000  # a key below this is never worth splitting
LIST_ROWS = 1_000  # rows of a list that is paired as a whole: some 50 KB
LIST_GROUP = 100_000  # rows of a key whose lists may meet in one task


def spread_join(
    rows: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot_share: float = 0.001,
    part_share: float = 0.0001,
    probe: DataFrame | None = None,
    probed: float = 1.0,
    grown: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Join many rows to a table with few rows per key, splitting the keys that hold many of the rows.

    A key is hot when it holds more than ``hot_share`` of all rows, so there are fewer than 1 / hot_share hot
    keys whatever the data: that proven bound is what allows their list to be broadcast. A hot key has as many sub-keys
    as its measured count needs for parts of ``part_share`` of all rows; its rows get one by a hash of the row and of
    the partition it lies in, so that equal rows part too, and the few matching ``dim`` rows are repeated once per
    sub-key. Other keys join as usual.

    The keys are counted in ``rows`` themselves, which are then evaluated twice, or in ``probe``: rows with the same keys made of
    about ``probed`` of the input. The counts only place the rows; the result does not depend on them.

    ``grown`` says that ``dim`` has many more rows than the tables it is made of (by an explode). Spark would judge it by the
    size of those tables and might send all of it through the driver as a broadcast; it is sorted and merged instead.

    ``tasks`` deals both sides to so many tasks, however few bytes they have: for joins that make far more than they read.
    """
    if how not in ("inner", "left"):
        raise ValueError("spread_join is for inner and left joins")
    if hot_share < 1e-5 or not 0 < probed <= 1:
        raise ValueError("hot_share is at least 0.00001, which bounds the list of hot keys, and probed a share")
    keys = list(keys)
    least = LEAST_ROWS * probed
    counts = (rows if probe is None else probe).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    all_rows = counts.agg(F.sum("_n").alias("t"))
    hot = counts.withColumn("_t", all_rows.scalar()).filter((F.col("_n") > F.col("_t") * hot_share) & (F.col("_n") > least))
    hot = hot.select(
        *[F.col(k).alias(f"_hot_{k}") for k in keys],
        F.ceil(F.col("_n") / F.greatest(F.col("_t") * part_share, F.lit(least / 4))).alias("_salts"),
    )

    def mark(df: DataFrame) -> DataFrame:
        same = [df[k].eqNullSafe(hot[f"_hot_{k}"]) for k in keys]
        return df.join(F.broadcast(hot), same, "left").drop(*[f"_hot_{k}" for k in keys])

    salted = (
        mark(rows)
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.col("_salts")), F.lit(0)).cast("long"))
        .drop("_salts")
    )
    copies = (
        mark(dim)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_salts") - 1, F.lit(0)).cast("long"))))
        .drop("_salts")
    )
    if tasks:
        salted, copies = (df.repartition(tasks, *keys, "_salt") for df in (salted, copies))
    return salted.join(copies.hint("merge") if grown else copies, [*keys, "_salt"], how).drop("_salt")


def pair_join(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every pair of rows with equal keys, where a key may hold many rows on both sides.

    The pairs are the result, so what counts is the time of one pair and that all tasks get their share. ``others`` travel as
    lists of about ``LIST_ROWS`` rows of a key, and a list is read from end to end for each row it meets, instead of looking up its rows
    one by one. ``rows`` are split by :func:`spread_join`, which repeats the lists once per sub-key. A key with more than
    a thousandth of ``others`` and ``LIST_GROUP`` of them has its lists in groups, and its rows are repeated once per group.

    ``others`` are counted first, and so read more than once; equal rows of one partition stay in one list.
    """
    keys = list(keys)
    others = others.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    counts = others.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    all_others = counts.agg(F.sum("_n").alias("t")).scalar()
    grouped = (F.col("_n") > LIST_GROUP) & (F.col("_n") > all_others * 0.001)
    many = counts.filter(F.col("_n") > LIST_ROWS).select(
        *keys, F.ceil(F.col("_n") / LIST_ROWS).alias("_lists"), F.when(grouped, F.ceil(F.col("_n") / LIST_GROUP)).otherwise(F.lit(1)).alias("_groups")
    )
    # fewer than 1,000 keys, as in spread_join
    wide = F.broadcast(many.filter(F.col("_groups") > 1).drop("_lists"))
    place = F.coalesce(F.pmod(F.xxhash64(*others.columns, F.spark_partition_id()), F.col("_lists")), F.lit(0))
    row = F.struct(*[c for c in others.columns if c not in keys])
    lists = (
        others.join(many, keys, "left")
        .select(*keys, row.alias("_row"), place.alias("_list"), F.coalesce("_groups", F.lit(1)).alias("_groups"))
        .groupBy(*keys, F.pmod("_list", "_groups").alias("_group"), "_list")
        .agg(F.collect_list("_row").alias("_rows"))
        .drop("_list")
    )
    groups = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_groups"), F.lit(1)).cast("long") - 1)
    meeting = rows.join(wide, keys, "left").withColumn("_group", F.explode(groups)).drop("_groups")
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    joined = spread_join(meeting, lists, [*keys, "_group"], tasks=tasks)
    kept = [c for c in rows.columns if c not in keys]
    return joined.select(*keys, *kept, F.explode("_rows").alias("_row")).select(*keys, *kept, "_row.*")
