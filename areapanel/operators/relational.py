"""Joins, grouped sums, pivot, stacking, latest rows and splits
(D1-D6, E1-E3, E5-E7, S1, L1-L4, C8).

Lookups (names, edit tables, crosswalks) carry no broadcast hint: Spark compares
their size in bytes with its broadcast threshold, in the plan or at run time, and
splits skewed shuffle joins beyond it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checks import require_columns
from .columns import q

def _as_list(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# --- joins ------------------------------------------------------------------------------------

def lookup_left_join(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], null_safe: bool = False,
                     suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Left join on shared key column(s); right duplicates fan out.

    ``null_safe`` matches NULL keys to NULL keys (pandas ``merge``, N1). Other
    columns present on both sides get ``suffixes``.
    """
    keys = _as_list(on)
    require_columns(df, keys)
    require_columns(lookup, keys)
    clash = (set(df.columns) & set(lookup.columns)) - set(keys)
    left = df.select(*[q(c).alias(c + suffixes[0] if c in clash else c) for c in df.columns])
    right = lookup.select(*[q(c).alias(c + suffixes[1] if c in clash else c) for c in lookup.columns])
    if not null_safe:
        return left.join(right, on=keys, how="left")
    r = right.select(*[q(c).alias("__r_" + c if c in keys else c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [q(k).eqNullSafe(q("__r_" + k)) for k in keys])
    joined = left.join(r, cond, "left")
    return joined.drop(*["__r_" + k for k in keys])


def crosswalk_join(df: DataFrame, crosswalk: DataFrame, source_col: str, crosswalk_source_col: str | None = None
                   ) -> DataFrame:
    """D3: attach every overlapping target of each source row (1 → n), left join."""
    crosswalk_source_col = crosswalk_source_col or source_col
    cw = crosswalk if crosswalk_source_col == source_col else crosswalk.withColumnRenamed(crosswalk_source_col,
                                                                                          source_col)
    return df.join(cw, on=source_col, how="left")


def join_panels(panels: Sequence[DataFrame], keys: Sequence[str] = ("area_code", "date"),
                names: DataFrame | None = None, name_key: str | None = None, how: str = "inner") -> DataFrame:
    """Join panels on ``keys`` (keys appear once, B12) and add names.

    Sort-merge joins on the same keys reuse the first exchange, so n panels cost
    n exchanges; whether the name table is broadcast is left to Spark's size threshold.
    """
    keys = list(keys)
    for p in panels:
        require_columns(p, keys)
    out = reduce(lambda a, b: a.join(b, on=keys, how=how), panels)
    if names is not None:
        k = name_key or keys[0]
        out = out.join(names, on=k, how=how)
    return out


# --- aggregation ------------------------------------------------------------------------------

def join_bucketed(panels: Sequence[DataFrame], keys: Sequence[str] = ("area_code", "date"), names: DataFrame | None = None,
                  name_key: str | None = None) -> DataFrame:
    """D4/D5 on panels from ``sinks.tables.bucket_panel``: joined where they lie. Buckets of the area alone are enough for
    keys that include it once the session lets a join be partitioned by some of its keys, which this sets."""
    panels[0].sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return join_panels(panels, keys, names, name_key)


def group_sum(df: DataFrame, keys: str | Sequence[str], sums: str | Sequence[str], sort: bool = False
              ) -> DataFrame:
    """Sum columns by keys. Rows with a NULL key are dropped (N2); a group
    whose values are all NULL sums to 0 (N3). Partial sums run map-side, so a
    hot key never moves its raw rows through one task."""
    keys, sums = _as_list(keys), _as_list(sums)
    require_columns(df, keys + sums)
    not_null = reduce(lambda a, b: a & b, [q(k).isNotNull() for k in keys])
    out = (df.where(not_null).groupBy(*[q(k) for k in keys])
           .agg(*[F.coalesce(F.sum(q(s)), F.lit(0)).alias(s) for s in sums]))
    return out.orderBy(*keys) if sort else out


def pivot_wide(df: DataFrame, index: str | Sequence[str], columns: str, values: str,
               pivot_values: Sequence | None = None) -> DataFrame:
    """Long → wide. A repeated ``(index, column)`` pair raises at run time
    (as pandas does); gaps are NULL; pivot columns come out sorted.

    Pass ``pivot_values`` to skip the distinct-values job.
    """
    index = _as_list(index)
    require_columns(df, index + [columns, values])
    if pivot_values is None:
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        pivot_values = [r[0] for r in df.select(columns).where(q(columns).isNotNull()).distinct().limit(most + 1).collect()]
        if len(pivot_values) > most:
            raise ValueError(f"{columns} has more than {most} values (spark.sql.pivotMaxValues)")
    pivot_values = sorted(pivot_values)
    cell = F.when(F.count(F.lit(1)) > 1,
                  F.raise_error(F.lit("pivot_wide: index contains duplicate entries, cannot reshape"))) \
        .otherwise(F.first(q(values)))
    out = df.groupBy(*[q(c) for c in index]).pivot(columns, pivot_values).agg(cell.alias(values))
    return out


def stack_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack by column name; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ratio_join_density(population: DataFrame, area: DataFrame, key: str, pop_col: str, area_col: str,
                       out_col: str = "population_density", keep_inputs: bool = False) -> DataFrame:
    """Left join area onto population by key; ``out = pop / area``; inputs dropped."""
    require_columns(population, [key, pop_col])
    require_columns(area, [key, area_col])
    joined = population.join(area.select(key, area_col), on=key, how="left")
    out = joined.withColumn(out_col, F.try_divide(q(pop_col).cast("double"), q(area_col).cast("double")))
    return out if keep_inputs else out.drop(pop_col, area_col)


# --- ordering, latest rows, splits -----------------------------------------------------------

def latest_row(df: DataFrame, key: str, order_col: str = "date") -> DataFrame:
    """L2: the row with the greatest ``order_col`` per key.

    ``max_by`` is a partial aggregate: each task keeps one candidate per key, so
    the shuffle carries one row per key and task whatever the skew.
    """
    require_columns(df, [key, order_col])
    others = [c for c in df.columns if c != key]
    return (df.groupBy(q(key)).agg(F.max_by(F.struct(*[q(c) for c in others]), q(order_col)).alias("_r"))
            .select(q(key), *[F.col("_r").getField(c).alias(c) for c in others]))


def first_k_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """L3: rows of the ``k`` smallest keys (a top-k report: the limit is the feature).

    The k keys are found with a distinct + top-k, then joined back as a broadcast
    semi join; no unpartitioned window.
    """
    require_columns(df, key)
    top = df.select(key).where(q(key).isNotNull()).distinct().orderBy(key).limit(k)
    return df.join(F.broadcast(top), on=key, how="left_semi")


def range_stretches(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition ``df`` on ``order`` and number rows within each partition.

    Adds ``_part`` (the partition, i.e. one contiguous stretch of the order) and
    ``_i`` (1-based position inside it). Equal order values never straddle two
    stretches, and a key holding a third of all rows spreads over many stretches
    when later order columns vary. The result is checkpointed to the session's
    checkpoint folder, so every later branch sees the same numbering of tied rows
    (shuffle fetch order is not fixed) and a lost executor recomputes from it.
    """
    from ..session import reliable_checkpoint
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    staged = df.repartitionByRange(n, *[q(c) for c in order]).withColumn("_part", F.spark_partition_id())
    w = Window.partitionBy("_part").orderBy(*[q(c) for c in order])
    return reliable_checkpoint(staged.withColumn("_i", F.row_number().over(w)))


def stretch_offsets(stretches: DataFrame) -> DataFrame:
    """``(_part, _n, _off)``: rows per stretch and rows in all earlier stretches.
    One row per partition, so it is small whatever the data size."""
    counts = stretches.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    prior = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_off", F.coalesce(F.sum("_n").over(prior), F.lit(0)))


def ordered_split(df: DataFrame, order: Sequence[str] = ("area_code", "date"), test_fraction: float = 0.1
                  ) -> tuple[DataFrame, DataFrame]:
    """L4: unshuffled split: the last ``ceil(test_fraction * n)`` rows in ``order`` are test.

    Global positions come from a distributed scan: rows are numbered inside
    range-partitioned stretches of ``order`` and shifted by the row count of the
    earlier stretches (a table of one row per partition, broadcast). No task
    holds a whole area and nothing per area reaches the driver; the driver sees
    only the total row count.
    """
    order = list(order)
    require_columns(df, order)
    stretches = range_stretches(df, order)
    offsets = stretch_offsets(stretches)
    total = offsets.agg(F.sum("_n")).first()[0] or 0
    start_test = total - math.ceil(test_fraction * total)
    # At most spark.sql.shuffle.partitions rows: a proven broadcast bound.
    pos = stretches.join(F.broadcast(offsets.select("_part", "_off")), "_part") \
        .withColumn("_pos", F.col("_off") + F.col("_i") - 1)
    keep = [q(c) for c in df.columns]
    train = pos.where(F.col("_pos") < start_test).select(*keep)
    test = pos.where(F.col("_pos") >= start_test).select(*keep)
    return train, test


def date_split(df: DataFrame, date_col: str = "date", test_fraction: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """L4 (chronological): test = the latest dates that together hold at least
    ``ceil(test_fraction * n)`` rows. Rows without a date are in the training part.

    The cut is a scalar subquery, nothing is collected: counts per date are ranged by date, added up inside each stretch and
    shifted by the counts of the later stretches (one row a partition); the cut is the latest date with enough rows from it on.
    """
    require_columns(df, date_col)
    day = q(date_col)
    per_date = df.groupBy(day.alias("_d")).agg(F.count(F.lit(1)).alias("_c"))
    stretches = range_stretches(per_date, ["_d"])
    totals = stretches.groupBy("_part").agg(F.sum("_c").alias("_n"))
    later = totals.withColumn("_later", F.coalesce(F.sum("_n").over(Window.orderBy(F.desc("_part")).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)))  # one row a partition
    within = Window.partitionBy("_part").orderBy(F.desc("_i"))
    held = stretches.join(F.broadcast(later.select("_part", "_later")), "_part").withColumn(
        "_from", F.col("_later") + F.sum("_c").over(within)).where("_d is not null")
    need = F.ceil(F.lit(test_fraction) * F.sum("_c")).alias("need")
    need = stretches.agg(need).scalar()
    # Too few dated rows: all of them are test. No row needed: none is.
    cut = held.agg(F.when(need > 0, F.coalesce(F.max(F.when(F.col("_from") >= need, F.col("_d"))), F.min("_d"))).alias("cut")).scalar()
    late = F.coalesce(day >= cut, F.lit(False))
    return df.where(~late), df.where(late)
