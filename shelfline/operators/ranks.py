"""Running totals and exact quantiles without a single-task window.

A window ordered over a whole table runs in one task, and the built-in exact
percentile keeps every distinct value of a group in one task's memory. Here a
sketch cuts each group's value range into buckets, a window per bucket adds up
within it, and the bucket totals (at most ``buckets`` rows per group) supply the
offsets. The sketch only decides where the cuts are; the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.session import materialize, shuffle_width


def interpolate(points: Column) -> Column:
    """The quantile of each struct (low, high, part) of an array: ``low * (1 - part) + high * part``, the first product unrounded.

    That is what a fused multiply-add gives, and the SQL engine. Any other order of the roundings is off in a last digit, which
    decides a comparison with a value that lies on the quantile. Equal neighbours are the quantile themselves.
    """
    # each step is a lambda over the array, so that no expression is repeated
    named = lambda **c: F.struct(*[x.alias(n) for n, x in c.items()])
    # Dekker's split: the upper half of a double, so that products of halves are exact
    upper = lambda x: x * 134217729.0 - (x * 134217729.0 - x)
    terms = F.transform(points, lambda r: named(low=r["low"], same=r["low"] == r["high"], rest=1.0 - r["part"], product=r["low"] * (1.0 - r["part"]), other=r["high"] * r["part"]))
    halves = F.transform(terms, lambda r: named(r=r, a=upper(r["low"]), c=upper(r["rest"]), total=r["product"] + r["other"]))
    ends = F.transform(halves, lambda h: named(h=h, b=h["r"]["low"] - h["a"], d=h["r"]["rest"] - h["c"], back=h["total"] - h["r"]["product"]))

    def rounded_once(e):
        lost = ((e["h"]["a"] * e["h"]["c"] - e["h"]["r"]["product"]) + e["h"]["a"] * e["d"] + e["b"] * e["h"]["c"]) + e["b"] * e["d"]
        return e["h"]["total"] + (((e["h"]["r"]["product"] - (e["h"]["total"] - e["back"])) + (e["h"]["r"]["other"] - e["back"])) + lost)

    return F.transform(ends, lambda e: F.when(e["h"]["r"]["same"], e["h"]["r"]["low"]).otherwise(rounded_once(e)))


def bounded_quantiles(df: DataFrame, keys, value: str, probs, name: str = "quantiles") -> DataFrame:
    """The interpolated quantiles of each group, as an array, for groups that something bounds, such as the calendar: a group is sorted in one row."""
    probs = F.array(*[F.lit(float(p)) for p in probs])
    grouped = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.col(value).cast("double"))).alias("_v"))
    at = F.transform(probs, lambda p: (F.size("_v") - 1) * p)
    points = F.transform(at, lambda r: F.struct(
        F.get("_v", F.floor(r).cast("int")).alias("low"), F.get("_v", F.ceil(r).cast("int")).alias("high"), (r - F.floor(r)).alias("part")))
    return grouped.select(*keys, F.when(F.size("_v") > 0, interpolate(points)).alias(name))


def value_counts_by(df: DataFrame, keys, value: str, **counts: Column) -> DataFrame:
    """One row per key and distinct value, stored in the shared folder.

    Copies of a value are combined before the shuffle. The operators below read the
    counts several times; storing them means that the table itself is read once.
    """
    aggs = [c.alias(name) for name, c in counts.items()] or [F.count("*").alias("n")]
    return materialize(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(*aggs), "counts")


def text_ranks(counted: DataFrame, keys, value: str) -> DataFrame:
    """Add ``rank`` (from 0): the place of each distinct text of its group in binary order.

    The rows are range-partitioned on the whole text, numbered in their partition, and moved up by
    the sizes of the partitions before, so texts with a common beginning are spread like any others.
    """
    keys = list(keys)
    placed = materialize(
        counted.repartitionByRange(shuffle_width(counted.sparkSession), *keys, value).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    within = Window.partitionBy(*keys, "_part").orderBy(value)
    return placed.join(offsets, [*keys, "_part"]).withColumn("rank", F.row_number().over(within) - 1 + F.col("_o")).drop("_part", "_o")


#: distinct values that one bucket may hold on average
BUCKET_ROWS = 50_000


def bucket_count(counted: DataFrame) -> int:
    """Buckets of about BUCKET_ROWS stored value counts, and at least 128."""
    return max(128, -(-counted.count() // BUCKET_ROWS))


def with_bucket(counted: DataFrame, keys, v: Column, buckets: int) -> DataFrame:
    """Add ``_b``: how many of the group's ascending cuts are at most the value.

    The cut is found by a binary search in plain expressions. That stays in generated
    code, where a lambda over the array would not, and looks at seven cuts, not at 127.
    The cuts are one short array per group. ``keys`` name the columns of a table, so
    there are as many rows as features and the broadcast is bounded by the schema.
    """
    points = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = counted.groupBy(*keys).agg(F.array_distinct(F.percentile_approx(v, points, max(10000, 4 * buckets))).alias("_cuts"))
    if keys:
        out = counted.join(F.broadcast(cuts), keys)
        search = F.col("_cuts")
    else:
        out, search = counted, cuts.scalar()
    # one projection per step of the search, so that no step repeats the one before
    step, out = 1 << (buckets - 1).bit_length() - 1, out.withColumn("_b", F.lit(0))
    while step:
        out = out.withColumn("_b", F.col("_b") + F.when(v >= F.get(search, F.col("_b") + (step - 1)), step).otherwise(0))
        step //= 2
    return out.drop("_cuts")


def bucket_offsets(bucketed: DataFrame, keys, sums) -> DataFrame:
    """Per bucket: ``_o_<c>``, the sum of all buckets before, ``_t_<c>``, its own, and ``total_<c>``.

    At most (buckets x groups) rows, which bounds its windows and its broadcast.
    """
    totals = bucketed.groupBy(*keys, "_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    return totals.select(
        *keys, "_b", *[F.col(f"_t_{c}") for c in sums],
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(whole).alias(f"total_{c}") for c in sums],
    )


def running_totals(counted: DataFrame, keys, value: str, sums, buckets: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive, by ascending value) and ``total_<c>`` for each column in ``sums``.

    ``counted`` has one row per key and value. ``keys`` names few groups, such as the
    columns of a table.
    """
    keys, sums = list(keys), list(sums)
    buckets = buckets or bucket_count(counted)
    v = F.col(value).cast("double")
    bucketed = with_bucket(counted, keys, v, buckets)
    offsets = bucket_offsets(bucketed, keys, sums).drop(*[f"_t_{c}" for c in sums])
    within = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.withColumns({f"_l_{c}": F.sum(c).over(within) for c in sums})
    return (
        local.join(F.broadcast(offsets), [*keys, "_b"])
        .withColumns({f"cum_{c}": F.col(f"_l_{c}") + F.col(f"_o_{c}") for c in sums})
        .drop("_b", *[f"_l_{c}" for c in sums], *[f"_o_{c}" for c in sums])
    )


def exact_quantiles(counted: DataFrame, keys, value: str, probs, count: str = "n", buckets: int | None = None) -> DataFrame:
    """``quantiles``: the linearly interpolated quantiles of each group, as an array.

    ``counted`` comes from ``value_counts_by``. The bucket totals tell which buckets hold
    a wanted rank, at most two per quantile; only their rows are sorted.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    buckets = buckets or bucket_count(counted)
    bucketed = with_bucket(counted, keys, F.col(value).cast("double"), buckets)
    offsets = bucket_offsets(bucketed, keys, [count])
    wanted = F.lit(False)
    pos = [(F.col(f"total_{count}") - 1) * F.lit(p) for p in probs]
    holds = lambda rank: (F.col(f"_o_{count}") <= rank) & (rank < F.col(f"_o_{count}") + F.col(f"_t_{count}"))
    for p in pos:
        wanted = wanted | holds(F.floor(p)) | holds(F.ceil(p))
    near = bucketed.join(F.broadcast(offsets.filter(wanted)), [*keys, "_b"])
    within = Window.partitionBy(*keys, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    run = near.withColumn("_last", F.sum(count).over(within) + F.col(f"_o_{count}")).withColumn("_first", F.col("_last") - F.col(count))
    aggs = []
    for i, p in enumerate(pos):
        at = lambda rank: F.max(F.when((F.col("_first") <= rank) & (rank < F.col("_last")), F.col(value).cast("double")))
        aggs += [at(F.floor(p)).alias(f"_lo{i}"), at(F.ceil(p)).alias(f"_hi{i}"), F.max(p - F.floor(p)).alias(f"_f{i}")]
    out = run.groupBy(*keys).agg(*aggs)
    points = F.array(*[F.struct(F.col(f"_lo{i}").alias("low"), F.col(f"_hi{i}").alias("high"), F.col(f"_f{i}").alias("part")) for i in range(len(probs))])
    return out.select(*keys, interpolate(points).alias("quantiles"))


def melt(df: DataFrame, cols, ids=(), name: str = "feature", value: str = "value") -> DataFrame:
    """Columns to (name, value) rows as doubles."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return df.select(*ids, F.inline(pairs))
