"""The stages against brute force, each on what the one before kept."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelfline.llm import simhash, toxicity
from shelfline.llm.common import store, table
from shelfline.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def kept(spark):
    sf = "/root/testdata/sf0.01"
    docs, out = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, stage(spark, docs, sf) if name == "bpe" else store(stage(spark, docs, sf), name)))
        docs = out[-1][2]
    return out


def stage(kept, name):
    return next((a, b) for n, a, b in kept if n == name)


def test_columns_stay(kept):
    for name, before, after in kept[:-1]:
        assert after.columns == before.columns


def test_toxic_documents_go(spark, kept):
    before, after = stage(kept, "toxicity")
    scores = toxicity.toxicity(before, table(spark, "/root/testdata/sf0.01", "labels"))
    stay = {r.doc_id for r in scores.filter("score < 0.7").collect()}
    assert {r.doc_id for r in after.select("doc_id").collect()} == stay and len(stay) < before.count()


def test_exact_copies_go(kept):
    before, after = stage(kept, "exact_dedup")
    first = {}
    for r in before.select("doc_id", "text").collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        first[key] = min(first.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == sorted(first.values())


def test_near_copies_go(kept):
    before, after = stage(kept, "simhash_near_dedup")
    want = simhash.brute_force([tuple(r) for r in before.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in after.select("doc_id").collect()) == sorted({c for _, _, c in want})


def test_mix_repeats_documents_at_most_twice(kept):
    before, after = stage(kept, "source_mix")
    times = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    ids = {r.doc_id for r in before.select("doc_id").collect()}
    assert set(times) <= ids and set(times.values()) <= {1, 2}
    words = lambda df: sum(len(r.text.split()) for r in df.select("text").collect())
    assert abs(words(after) / words(before) - 1.5) < 0.05


def test_ids_are_those_of_the_library(kept):
    before, after = stage(kept, "bpe")
    t = Tokenizer.from_file(VOCABULARY)
    texts = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows[::10]:
        assert list(r.ids) == t.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


CLASHING = ["mix_row", "mix_times", "mix_copy", "row", "size", "doc", "kept_id", "kept_sha", "kept_rows", "own_id", "own_sha", "kept", "near_row", "kept_row", "fp", "first",
            "source_size", "source_rank", "target", "budget", "taken", "upto", "score", "text_sha256", "recipe", "chunks"]


@pytest.mark.parametrize("name", ["toxicity", "exact_dedup", "simhash_near_dedup", "source_mix"])
def test_columns_named_like_helpers_come_back_unchanged(spark, name):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").limit(60)
    mine = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    mine = store(mine.unionByName(mine.limit(2)).unionByName(mine.limit(1).withColumn("doc_id", F.lit(None).cast("long"))), "clashing")
    out = dict(corpus_pipeline.STAGES)[name](spark, mine, sf)
    assert out.columns == mine.columns
    found, given = out.collect(), {tuple(r) for r in mine.collect()}
    assert found and all(tuple(r) in given for r in found)
