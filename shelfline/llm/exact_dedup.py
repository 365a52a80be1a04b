"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import WS, store, text_or_empty

#: A chunk ends, after at least 256 characters, at the first space between two letter classes, and after 4096 anyway.
#: The cut depends on nearby content alone.
CHUNK = "(?s).{256,4095}?[aeiouäéíóü][nrst,.]? (?=[b-hp-r])|(?s).{1,4096}"


def normalised(col: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(col), f"[{WS}]+", " ")


def exact_duplicates(docs: DataFrame, key_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one space. Each text
    is cut into content-defined chunks and becomes a recipe, the ordered list of chunk identifiers.
    The text of a chunk is moved once, to the table of distinct chunks, where an identifier is
    verified to stand for one text only. Where one does not, its texts are numbered, and the numbers
    join the recipes of the documents that hold it. Documents are then grouped by their recipes, about two hundredths of the bytes.

    Of a group the smallest doc_id stays, null last. Rows that repeat it are told apart by their place in the
    stored table, so exactly one row of a group has ``kept``. Null counts as the empty text, whose
    recipe is empty. Copies are counted before the shuffle; the join back splits hot groups.
    ``key_bits`` below 64 makes identifiers clash, for tests.
    """
    key = lambda c: F.xxhash64(c) if key_bits == 64 else F.pmod(F.xxhash64(c), F.lit(2**key_bits))
    cut = docs.select("doc_id", normalised().alias("norm")).select(
        "doc_id", F.sha2("norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row"),
        F.transform(F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0)), lambda c: F.struct(key(c).alias("key"), c.alias("chunk"))).alias("chunks"))
    cut = store(cut, "chunks")
    distinct = cut.select(F.explode("chunks").alias("c")).select("c.key", "c.chunk").distinct()
    clashing = store(distinct.groupBy("key").count().filter("count > 1").select("key"), "clashes")
    recipes, same = cut.select("row", "doc_id", "text_sha256", F.col("chunks.key").alias("recipe")), ["recipe"]
    if not clashing.isEmpty():
        recipes, same = recipes.join(_numbered(cut, clashing), "row", "left").withColumn("nths", F.coalesce("nths", F.array().cast("array<int>"))), ["recipe", "nths"]
    keep = recipes.groupBy(*same).agg(
        F.count(F.lit(1)).alias("group_size"), F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("first"))
    keep = store(keep, "first-of-group")  # so that the join can split a hot group
    return recipes.join(keep, same).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")


def _numbered(cut: DataFrame, clashing: DataFrame) -> DataFrame:
    """For each document with a clashing identifier the ranks of those chunks among the texts of their key, in order of place.

    ``clashing`` has few rows (a pair of chunks clashes once in 2**64), so the planner broadcasts it by its stored
    size and only the chunks concerned move.
    """
    entries = cut.select("row", F.posexplode("chunks").alias("pos", "c")).select("row", "pos", "c.key", "c.chunk").join(clashing, "key", "left_semi")
    ids = entries.select("key", "chunk").distinct().withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("chunk")))
    ids = store(ids, "clash-numbers")  # so that the join can split a chunk that very many documents share
    return (
        entries.join(ids, ["key", "chunk"]).groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "nth"))).alias("list")).select("row", F.col("list.nth").alias("nths"))
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns, whatever their names; of rows with equal doc_id and text one stays.

    The texts are shuffled once, to meet the ids that stay; only rows that repeat such an id are compared in full.
    """
    kept = (
        exact_duplicates(docs).groupBy(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("kept_rows")).filter("kept")
    )
    kept = store(kept, "kept")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.col("doc_id").alias("own_id"), F.sha2(normalised(), 256).alias("own_sha"))
    same = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_sha") == F.col("kept_sha"))
    once = rows.join(kept.filter("kept_rows = 1").hint("shuffle_hash"), same, "left_semi")
    again = rows.join(kept.filter("kept_rows > 1").hint("shuffle_hash"), same).dropDuplicates(["kept_id", "kept_sha"])
    return once.select("doc.*").unionByName(again.select("doc.*"))


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM n
"""
