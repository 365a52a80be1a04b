"""SimHash near-duplicates by a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import packed, store, text_or_empty

#: the six blocks of a fingerprint as (lowest bit, width); four differing bits leave two blocks untouched
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
PAIRS = tuple(combinations(range(len(BLOCKS)), 2))
#: fingerprints in a leaf page, and leaf pages under an upper node
PAGE, FANOUT = 128, 32
#: shingles whose hashes are unpacked to bits at a time
SLAB = 1 << 15


def fingerprint(text: bytes, words: int = 4) -> int:
    """SimHash of the word shingles: a bit is set where it is set in over half of the shingle hashes."""
    parts = text.lower().split()
    if not parts:
        return 0
    line, ends = b" ".join(parts), np.cumsum([len(p) + 1 for p in parts])
    starts = (ends - np.array([len(p) + 1 for p in parts])).tolist()
    stops = (ends - 1).tolist()
    n = max(1, len(parts) - words + 1)
    last = min(words, len(parts)) - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLAB):
        end = min(n, at + SLAB)
        h = np.fromiter([digest(line[a:b], 42) for a, b in zip(starts[at:end], stops[at + last:end + last])], np.uint64, end - at)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprint of ``text`` beside all other columns."""
    for batch in batches:
        keep = [n for n in batch.schema.names if n != "text"]
        found = np.fromiter((fingerprint(x.as_py()) for x in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], pa.array(found.view(np.int64))], [*keep, "fp"])


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each 64-bit word in the reflected Gray sequence: neighbours in this order differ in few bits."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_rank_column(c: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, shift))
    return c


def shared(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask, pattern): the bits all values agree on, and their setting."""
    both, any_ = np.bitwise_and.reduce(values), np.bitwise_or.reduce(values)
    mask = ~(both ^ any_)
    return mask, both & mask


def merged(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Component labels after joining left[i] with right[i]: the smallest label of each component."""
    while len(left):
        a, b = labels[left], labels[right]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        if (lo == hi).all():
            break
        np.minimum.at(labels, hi, lo)
        while (labels[labels] != labels).any():
            labels = labels[labels]
    return labels


def near(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= most)


def spanning(values: np.ndarray, before: np.ndarray, after: np.ndarray) -> Iterator[tuple[int, int]]:
    """One edge for each component of ``before`` that hangs on another one in ``after``."""
    for i in np.flatnonzero((before == np.arange(len(values))) & (after != before)):
        yield int(values[i]), int(values[after[i]])


def pages(most: int):
    """Cuts the sorted rows (table, key, fp) into leaf pages: bucket, page number, mask, pattern, values, and the links inside."""

    def cut(table: int, key: int, no: int, values: np.ndarray, rows: list) -> None:
        labels = np.arange(len(values))
        if len(values) > 1:
            labels = merged(labels, *near(values, values, most))
        mask, pattern = shared(values)
        edges = [x for e in spanning(values, np.arange(len(values)), labels) for x in e]
        rows.append((table, key, no, int(mask.view(np.int64)), int(pattern.view(np.int64)), values.tobytes(), np.array(edges, np.uint64).tobytes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_no, tail = None, 0, np.zeros(0, np.uint64)
        for batch in batches:
            rows: list[tuple] = []
            t, k, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "key", "fp"))
            f = f.view(np.uint64)
            ends = np.flatnonzero(np.concatenate([(k[1:] != k[:-1]) | (t[1:] != t[:-1]), [True]])) + 1
            start = 0
            for end in ends:
                own, values = (int(t[start]), int(k[start])), f[start:end]
                if own != open_key:
                    if len(tail):
                        cut(*open_key, open_no, tail, rows)
                    open_key, open_no, tail = own, 0, values
                else:
                    tail = np.concatenate([tail, values])
                while len(tail) > PAGE:
                    cut(*open_key, open_no, tail[:PAGE], rows)
                    open_no, tail = open_no + 1, tail[PAGE:]
                start = end
            yield pack(rows)
        if len(tail):
            rows = []
            cut(*open_key, open_no, tail, rows)
            yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["t", "key", "no", "mask", "pattern", "fps", "links"])

    return run


def across(most: int):
    """Links between the two pages of a pair, as few as join what hangs together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, surely in zip(batch.column("fps_a"), batch.column("fps_b"), batch.column("surely")):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                if surely.as_py():
                    out += [(int(a[0]), int(b[0]))]
                    continue
                left, right = near(a, b, most)
                if len(left):
                    both = np.concatenate([a, b])
                    inside = [near(a, a, most), near(b, b, most)]
                    labels = merged(merged(np.arange(len(both)), *inside[0]), inside[1][0] + len(a), inside[1][1] + len(a))
                    out += spanning(both, labels, merged(labels.copy(), left, right + len(a)))
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("links")]
        pairs = np.concatenate([np.zeros(0, np.uint64), *found]).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def links(distinct: DataFrame, most: int = 4) -> DataFrame:
    """Pairs (a, b) of fingerprints that connect all fingerprints at ``most`` or fewer differing bits.

    Dealing: a pair within four bits agrees on two of six blocks, so each fingerprint goes to fifteen
    tables by the setting of two blocks (21 bits). Inside a table and setting, rows are range-partitioned
    and sorted by Gray rank, so a setting with very many fingerprints is spread over tasks. Runs of PAGE
    neighbours are leaf pages, FANOUT pages an upper node; both carry the bits that all below share.

    Search: node against node, then page against page, inside a setting. The differences on bits that
    both sides share bound all pairs below: over ``most``, the whole group is pruned. If the bits that
    are not shared cannot lift them over ``most``, one link stands for the group. Every page gives a spanning
    forest of its links and not its pairs.
    """
    spark = distinct.sparkSession
    settings = []
    for t, (i, j) in enumerate(PAIRS):
        (a, wa), (b, wb) = BLOCKS[i], BLOCKS[j]
        part = lambda at, w: F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << w) - 1))
        settings.append(F.struct(F.lit(t).alias("t"), F.shiftleft(part(a, wa), wb).bitwiseOR(part(b, wb)).alias("key")))
    dealt = distinct.select("fp", F.explode(F.array(*settings)).alias("s")).select("s.t", "s.key", "fp")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # settings with one fingerprint have no pair
    shared_settings = dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("t", "key")
    dealt = dealt.join(shared_settings, ["t", "key"], "left_semi").withColumn("rank", gray_rank_column(F.col("fp")))
    leaves = store(
        dealt.repartitionByRange(width, "t", "key", "rank").sortWithinPartitions("t", "key", "rank").select("t", "key", "fp")
        .mapInArrow(pages(most), "t int, key long, no long, mask long, pattern long, fps binary, links binary")
        .withColumn("task", F.spark_partition_id()), "gray-pages")
    inside = leaves.filter(F.octet_length("links") > 0).select("links").mapInArrow(unpacked, "a long, b long")
    # only settings with several pages go on; a page is named by task and number, a node by task and number / FANOUT
    several = leaves.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("t", "key")
    leaves = leaves.join(several, ["t", "key"], "left_semi").withColumn("node", F.floor(F.col("no") / FANOUT))
    named = leaves.select("t", "key", "task", "node", "no", "mask", "pattern", "fps")
    # bits shared below a node: shared by every page, and set alike in all
    upper = named.groupBy("t", "key", "task", "node").agg(
        F.expr("bit_and(mask)").alias("mask"), F.expr("bit_and(pattern)").alias("all_set"), F.expr("bit_or(pattern)").alias("some_set"))
    upper = upper.select("t", "key", "task", "node", F.expr("mask & ~(all_set ^ some_set)").alias("mask"), F.col("all_set").alias("pattern"))
    upper = store(upper, "gray-nodes")

    def side(df: DataFrame, name: str, *more: str) -> DataFrame:
        return df.select("t", "key", *[F.col(c).alias(f"{c}_{name}") for c in ("task", "node", "mask", "pattern", *more)])

    apart = F.expr("bit_count((pattern_a ^ pattern_b) & mask_a & mask_b)")
    node_pairs = (
        side(upper, "a").join(side(upper, "b"), ["t", "key"])
        .filter(F.struct("task_a", "node_a") <= F.struct("task_b", "node_b")).filter(apart <= most)
        .select("t", "key", "task_a", "node_a", "task_b", "node_b"))
    a = side(named, "a", "no", "fps").withColumnRenamed("mask_a", "mask_a")
    pairs = (
        node_pairs.join(a, ["t", "key", "task_a", "node_a"]).join(side(named, "b", "no", "fps"), ["t", "key", "task_b", "node_b"])
        .filter(F.struct("task_a", "no_a") < F.struct("task_b", "no_b")).filter(apart <= most)
        .withColumn("surely", apart + F.expr("bit_count(~(mask_a & mask_b))") <= most)
        .select("fps_a", "fps_b", "surely"))
    return inside.unionByName(pairs.mapInArrow(across(most), "a long, b long"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, root): every id that has an edge with the smallest id of its connected component.

    Alternates two steps until nothing changes: every id points its larger neighbours to its smallest
    neighbour, then every id points its smaller ones and itself there. Both keep what is connected and
    shorten paths, in a number of rounds that grows with the logarithm of the longest path. Each round
    is written to the shared folder, so that a lost executor costs no more than the round.
    A node with very many neighbours is counted before the shuffle and never gathered.
    """

    def step(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        lows = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(lows, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lows.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    e = store(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name)
    stamp = None
    while True:
        e = store(step(step(e, True), False), name)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == stamp:
            break
        stamp = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).union(e.select("v", "v")).distinct()


def rooted(distinct: DataFrame, most: int) -> DataFrame:
    """``distinct`` (fp, first) with the smallest fingerprint that links reach as ``root``."""
    if most > 4:
        raise ValueError("two of six blocks are left untouched by at most four differing bits")
    roots = components(links(distinct.select("fp"), most))
    return distinct.join(roots, F.col("fp") == F.col("id"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, most: int = 4) -> DataFrame:
    """Component of each document under near-equal fingerprints: doc_id, fingerprint, component_id.

    Words are runs of other than ASCII white space, A-Z lowered; the fingerprint is the SimHash of the 4-word
    shingles by XXH64 with seed 42. Two documents link when their fingerprints differ in ``most`` (at
    most 4) or fewer bits; component_id is the smallest doc_id that links reach.

    Equal fingerprints are merged before the search, so large groups of copies cost one entry. Null and
    empty texts have fingerprint zero and link as any other. A null doc_id is ignored by the smallest
    (a component of nulls alone has null). Repeated rows keep their number. An empty table gives no rows.
    """
    marked = store(docs.select("doc_id", text_or_empty().cast("binary").alias("text")).mapInArrow(fingerprints, "doc_id long, fp long"), "fingerprints")
    distinct = store(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    named = rooted(distinct, most)
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = store(named.join(lowest, "root").select("fp", "component_id"), "classes")
    return marked.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, most: int = 4) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with its own columns, whatever their names.

    Null doc_ids come last. Rows that share the smallest doc_id, or are all null, are told apart by their place
    in a stored table, and the first stays.
    """
    rows = store(packed(docs, "near_row"), "near-rows")
    marked = rows.select("doc.doc_id", "near_row", F.coalesce("doc.text", F.lit("")).cast("binary").alias("text")).mapInArrow(fingerprints, "doc_id long, near_row long, fp long")
    distinct = store(marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "near_row")).alias("first")), "distinct-fingerprints")
    kept = rooted(distinct, most).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.near_row").alias("kept_row"))
    return rows.join(kept.hint("shuffle_hash"), F.col("near_row") == F.col("kept_row"), "left_semi").select("doc.*")


def brute_force(rows: list[tuple[int, str | None]], most: int = 4) -> list[tuple[int, str, int]]:
    """The same result from the definition, for tests."""
    marks = []
    for _, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        marks.append(sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)))
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= most:
                root[find(i)] = find(j)
    low: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(d, low.get(find(i), d))
    return [(d, f"{marks[i]:016x}", low[find(i)]) for i, (d, _) in enumerate(rows)]
