"""Running counts and value lookups that never sort a whole column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowmill.functions.columns import col
from rowmill.plans.storage import materialise

# A value holding at least 1 / HOT_SHARE of the weight is hot; so there are at most as many.
HOT_SHARE = 65536

# So many places, on average, are put side by side by one task, however many rows there are.
SLICE = 1 << 19


def _exclusive_sum(weight: str, partition: Sequence[Column], order: Sequence[str]) -> Column:
    w = (
        Window.partitionBy(*partition)
        .orderBy(*[col(o) for o in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(col(weight)).over(w), F.lit(0))


def running_weight(table: DataFrame, groups: Sequence[str], order: str, weights: Sequence[str]) -> DataFrame:
    """Add before_<w> per weight w: its sum over the rows of the group that sort before a row.

    `table` has one row per (groups, order). It is range-partitioned and written once; the totals of the
    ranges give each range its offset, and windows only run inside a range.
    """
    by_group = [col(g) for g in groups]
    ranged = materialise(
        table.repartitionByRange(*by_group, col(order)).withColumn("__range", F.spark_partition_id())
    )
    keys = [*groups, "__range"]
    by_range = [col(k) for k in keys]
    # One row per range and group: its size follows the number of ranges, not of values.
    totals = ranged.groupBy(*by_range).agg(*[F.sum(col(w)).alias(f"__total_{w}") for w in weights])
    offsets = totals.select(
        *by_range,
        *[_exclusive_sum(f"__total_{w}", by_group, ["__range"]).alias(f"__offset_{w}") for w in weights],
    )
    inside = ranged.select("*", *[_exclusive_sum(w, by_range, [order]).alias(f"__inside_{w}") for w in weights])
    return inside.join(offsets, keys).select(
        *[col(c) for c in table.columns],
        *[(col(f"__offset_{w}") + col(f"__inside_{w}")).alias(f"before_{w}") for w in weights],
    )


def placed_values(df: DataFrame, columns: Sequence[str], partners: Sequence[int] = ()) -> DataFrame:
    """Places of the values of several columns of one type in their columns' orders, row by row.

    Per column i: __d<i>, how many smaller values there are; __r<i>, the average rank; and per partner j
    __r<i>_<j>, the average rank over the rows that have column j. NULL has no places, and rows of NULLs alone
    are left out. All columns are one long table: counted, ordered and looked up together, and one shuffle
    by row puts their places side by side, in slices whose number follows the number of places. A hot value is
    one row until the look-up, where it is broadcast, so its rows are not gathered.
    """
    entries = []
    for i, c in enumerate(columns):
        fields = [F.lit(i).alias("item"), col(c).alias("value")]
        fields += [col(columns[j]).isNotNull().cast("int").alias(f"has_{j}") for j in partners]
        entries.append(F.when(col(c).isNotNull(), F.struct(*fields)))
    # Small files, so that no task reads, and holds for its shuffle, all rows of a large one.
    rows = materialise(
        df.select(*[col(c) for c in columns]).withColumn("__row", F.monotonically_increasing_id()),
        max(1, SLICE // len(columns)),
    )
    long = rows.select("__row", F.inline(F.array(*entries))).filter("item is not null")
    weights = {"n": "", **{f"n_{j}": f"_{j}" for j in partners}}
    counts = long.groupBy("item", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"has_{j}").alias(f"n_{j}") for j in partners]
    )
    places = running_weight(counts.withColumn("one", F.lit(1).cast("long")), ["item"], "value", [*weights, "one"])
    ranks = {f"__r{suffix}": col(f"before_{w}") + (col(w) + 1) / F.lit(2.0) for w, suffix in weights.items()}
    places = materialise(
        places.select("item", "value", "n", col("before_one").alias("__d"), *[r.alias(n) for n, r in ranks.items()])
    )
    total = places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slices = max(1, math.ceil(total / SLICE))
    placed = _looked_up(long.select("__row", "item", "value"), places, ["__d", *ranks], total, slices)
    # Dealt by row before they are grouped: hardly any two places of a row are found by one task of the look-up.
    by_row = placed.repartition(slices, "__row")
    named = {f"__d{i}": (i, "__d") for i in range(len(columns))}
    named |= {f"__r{i}{suffix}": (i, f"__r{suffix}") for i in range(len(columns)) for suffix in weights.values()}
    picked = [F.max(F.when(F.col("item") == i, col(c))).alias(n) for n, (i, c) in named.items()]
    return by_row.groupBy("__row").agg(*picked)


def _looked_up(long: DataFrame, places: DataFrame, outputs: Sequence[str], total: int, slices: int) -> DataFrame:
    """(__row, item, *outputs) for every (__row, item, value) of `long`; `places` has one row per (item, value).

    Hot values are broadcast and their rows stay where they are. All others are joined in `slices` parts by a
    hash of the entry, as a join by the values themselves would take Spark's number of parts for any size.
    """
    entry = ["item", "value"]
    is_hot = F.col("n") * HOT_SHARE >= F.lit(total)
    hot, cold = places.filter(is_hot), places.filter(~is_hot)
    key = F.xxhash64(*entry).alias("__key")
    rest = long.join(F.broadcast(hot.select(*entry)), entry, "left_anti")
    rest = rest.select(key, "__row", "item", "value").repartition(slices, "__key")
    there = cold.select(key, F.struct(*entry).alias("__entry"), *outputs).repartition(slices, "__key")
    # Entries that share a hash are told apart by their order, which is no further key of the join.
    own = F.struct(*entry)
    joined = rest.join(there, "__key").filter((own <= F.col("__entry")) & (own >= F.col("__entry")))
    columns = ["__row", "item", *outputs]
    return long.join(F.broadcast(hot), entry).select(*columns).unionByName(joined.select(*columns))


def attach_by_value(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    weight: str,
    outputs: Sequence[str],
    total: int,
) -> DataFrame:
    """Left-join `outputs` of `lookup` (one row per `value`) to `rows` on key = value.

    `total` is the sum of its `weight`. The hot values, at most HOT_SHARE of them, are
    broadcast and their rows, like rows with a NULL key, are spread over all tasks of the join.
    """
    slim = lookup.select(
        col(value).alias("__value"), *[col(o) for o in outputs], col(weight).alias("__weight")
    )
    is_hot = F.col("__weight") * HOT_SHARE >= F.lit(total)
    hot = slim.filter(is_hot).select(
        F.col("__value").alias("__hot"), *[col(o).alias(f"__hot_{o}") for o in outputs]
    )
    cold = slim.filter(~is_hot).drop("__weight").withColumn("__side", F.lit(0).cast("long"))
    marked = rows.join(F.broadcast(hot), col(key) == F.col("__hot"), "left")
    settled = F.col("__hot").isNotNull() | col(key).isNull()
    marked = marked.withColumn(
        "__salt",
        F.when(settled, 1 + F.monotonically_increasing_id() % 65536).otherwise(F.lit(0)),
    )
    joined = marked.join(
        cold, (F.col("__salt") == F.col("__side")) & (col(key) == F.col("__value")), "left"
    )
    return joined.select(
        *[col(c) for c in rows.columns],
        *[F.coalesce(col(f"__hot_{o}"), col(o)).alias(o) for o in outputs],
    )


def count_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(item, value, n) for several columns of one type in one pass: item indexes `columns`.

    NULL is counted as a value. Counts are combined before the shuffle, so a hot value is one row
    per task.
    """
    entries = [
        F.struct(F.lit(i).alias("item"), col(c).alias("value")) for i, c in enumerate(columns)
    ]
    return (
        df.select(F.inline(F.array(*entries)))
        .groupBy("item", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
