"""One query for each operator on training text, and the SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import bpe, conversations, decontaminate, exact_dedup, line_dedup, mixing, mtree, sharding, simhash, substring_dedup, toxicity, warc, whitening
from shelfline.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mtree_search": lambda spark, sf: mtree.top_inner_products(table(spark, sf, "embeddings")),
    "op2_chunk_recipes": lambda spark, sf: exact_dedup.exact_duplicates(table(spark, sf, "documents")),
    "op3_ring_shards": lambda spark, sf: sharding.ring_shards(table(spark, sf, "documents")),
    "op4_gray_simhash": lambda spark, sf: simhash.near_duplicates(table(spark, sf, "documents")),
    "op5_block_anchors": lambda spark, sf: substring_dedup.passage_digest(table(spark, sf, "documents")),
    "op6_chunked_warc": lambda spark, sf: warc.archived_pages(table(spark, sf, "pages")),
    "op7_weak_toxicity": lambda spark, sf: toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op8_trie_bpe": lambda spark, sf: bpe.token_digest(table(spark, sf, "documents"), VOCABULARY),
    "op9_fair_mix": lambda spark, sf: mixing.fair_mix(table(spark, sf, "documents")),
    "op10_bloom_lines": lambda spark, sf: line_dedup.line_digest(table(spark, sf, "documents")),
    "op11_jacobi_whitening": lambda spark, sf: whitening.whitened(table(spark, sf, "embeddings")),
    "op12_wu_manber": lambda spark, sf: decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
    "op13_dijkstra_repair": lambda spark, sf: conversations.repaired(table(spark, sf, "conversations")),
}

ORACLE: dict[str, str] = {
    "op1_mtree_search": mtree.SQL,
    "op2_chunk_recipes": exact_dedup.SQL,
    "op5_block_anchors": substring_dedup.SQL,
    "op6_chunked_warc": warc.SQL,
    "op9_fair_mix": mixing.SQL,
    "op10_bloom_lines": line_dedup.SQL,
    "op12_wu_manber": decontaminate.SQL,
    "op13_dijkstra_repair": conversations.SQL,
}
