"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import WORD, null_key, packed, store, text_or_empty

#: finish times below FAR are counted in STEPS ranges for each unit of virtual time
STEPS, FAR = 16384, 4


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """Target words of each source: a weighted share of the budget, held at ``repeats`` times its size.

    ``sizes`` has source, source_key and source_size. Sources in code-point order, null last, take
    the weights in turn. With sources sorted by the level at which they fill up, the common level of
    those that do not fill is (budget - what the full ones hold) / (weights of the rest).
    """
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("full_at", "source_rank")
    return (
        sizes.withColumn("source_rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("source_rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size").cast("double") * repeats)
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum(F.col("source_size").cast("double")).over(everything) * share)
        .withColumn("before", F.coalesce(F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("rest"))
        .withColumn("level", F.max(F.when(F.col("full_at") > F.col("level"), F.col("level"))).over(everything))
        .withColumn("target", F.least(F.col("most"), F.coalesce(F.col("weight") * F.col("level"), F.col("most"))))
        .select("source_key", "source_rank", "source_size", "target", "budget")
    )


def fair_mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, repeats: int = 2, digits: int = 3) -> DataFrame:
    """How many words of each document the mix takes: doc_id, size, source_size, target, taken.

    Each source is shuffled by the MD5 of doc_id; pass e over it gives a document the virtual finish
    time (e * source_size + words of the source up to and with it) / target. All finish times are put
    in one global order and admitted until the budget is spent, so every source ends near its target.

    Running sums are taken in two steps, inside (source, first ``digits`` hex digits of the MD5) and
    over the totals of those buckets, so a source with most of the rows is spread over 16**digits
    groups. The global cut is found from range totals; only the one range that holds it is ordered.

    Null text has size 0, a document of size 0 is never taken (0 words either way), a null source is a
    source of its own, null doc_ids share one MD5 and follow by size. Rows with equal doc_id and size are
    interchangeable. An empty table gives no rows.
    """
    return _decided(docs, (), weights, share, repeats, digits)


def _decided(docs: DataFrame, keep: tuple[str, ...], weights=(3, 1, 2), share: float = 1.5, repeats: int = 2, digits: int = 3) -> DataFrame:
    """``fair_mix`` with the columns named in ``keep`` beside."""
    rows = store(docs.select(
        *keep, "doc_id", "source", null_key("source").alias("source_key"),
        F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("shuffled"),
    ).withColumn("bucket", F.substring("shuffled", 1, digits)), "sizes")
    buckets = rows.groupBy("source_key", "bucket").agg(F.sum("size").alias("in_bucket"), F.first("source").alias("source"))
    earlier = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("source_key", "bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("offset"))
    sources = buckets.groupBy("source_key").agg(F.sum("in_bucket").alias("source_size"), F.first("source").alias("source"))
    inside = Window.partitionBy("source_key", "bucket").orderBy("shuffled", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = store(
        rows.join(offsets, ["source_key", "bucket"])
        .withColumn("upto", F.sum("size").over(inside) + F.col("offset"))
        .join(source_targets(sources, weights, share, repeats), "source_key")
        .select(*keep, "doc_id", "size", "source_size", "source_rank", "target", "budget", "upto"), "finish")

    def finish(e: Column) -> Column:
        return (e * F.col("source_size") + F.col("upto")).cast("double") / F.col("target")

    entries = (
        placed.filter("size > 0 and target > 0").withColumn("e", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .select("size", "source_rank", "budget", finish(F.col("e")).alias("at"))
        .withColumn("range", F.least(F.floor(F.col("at") * STEPS), F.lit(STEPS * FAR).cast("long")))
    )
    ranges = entries.groupBy("range").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
    over = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        ranges.withColumn("upto", F.sum("words").over(over)).filter("upto > budget")
        .orderBy("range").select("range", F.expr("upto - words").alias("spent")).first()
    )
    if cut is None:  # the budget takes everything
        admitted = lambda e: F.lit(True)
    else:
        inner = Window.orderBy("at", "source_rank").rowsBetween(Window.unboundedPreceding, 0)
        last = (
            entries.filter(F.col("range") == cut["range"]).withColumn("upto", F.sum("size").over(inner) + cut["spent"])
            .filter("upto <= budget").agg(F.max(F.struct("at", "source_rank")).alias("last")).first()["last"]
        )
        # nothing of the range fits: the end of the range before it is the last admitted time
        at, rank = (last["at"], last["source_rank"]) if last else (cut["range"] / STEPS, -1)
        admitted = lambda e: F.struct(finish(e), F.col("source_rank")) <= F.struct(F.lit(at), F.lit(rank))
    times = sum((F.when(admitted(F.lit(e)), 1).otherwise(0) for e in range(repeats)), F.lit(0))
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("size") * times).otherwise(F.lit(0)).cast("long")
    return placed.select(*keep, "doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix with their own columns, whatever their names, a document taken twice as two rows.

    Each row gets its own decision, by its place in a stored table, also where doc_ids are null or repeated.
    """
    rows = store(packed(docs, "mix_row"), "mix-rows")
    asked = rows.select("mix_row", "doc.doc_id", "doc.text", "doc.source")
    times = _decided(asked, ("mix_row",), **settings).filter("taken > 0").select("mix_row", F.expr("taken div size").cast("int").alias("mix_times"))
    return (
        rows.join(times.hint("shuffle_hash"), "mix_row")
        .withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_times"))))
        .select("doc.*")
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS shuffled FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank FROM d GROUP BY source
), w AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(source_rank - 1) % 3 + 1] AS weight, source_size::DOUBLE * 2 AS most,
         sum(source_size::DOUBLE) OVER () * 1.5::DOUBLE AS budget FROM s
), l AS (
  SELECT *, most / weight AS full_at,
         (budget - coalesce(sum(most) OVER (ORDER BY most / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
         / sum(weight) OVER (ORDER BY most / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT *, least(most, coalesce(weight * max(CASE WHEN full_at > level THEN level END) OVER (), most)) AS target FROM l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.source_rank, t.target, t.budget,
         sum(d.size) OVER (PARTITION BY t.source_rank ORDER BY d.shuffled, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT p.*, e.pass, (e.pass * source_size + upto)::DOUBLE / target AS finish
  FROM p CROSS JOIN (VALUES (0), (1)) AS e(pass) WHERE size > 0 AND target > 0
), g AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent FROM e
), k AS (
  SELECT doc_id, upto, source_rank, sum(size) AS taken FROM g WHERE spent <= budget GROUP BY ALL
)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM p LEFT JOIN k ON p.size > 0 AND p.doc_id IS NOT DISTINCT FROM k.doc_id AND p.upto = k.upto AND p.source_rank = k.source_rank
"""
