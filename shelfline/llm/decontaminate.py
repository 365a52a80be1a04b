"""Benchmark decontamination: word windows of benchmark items, found by Wu-Manber search."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import store, text_or_empty

#: words are runs of characters that are not ASCII, or are 0-9 or (after lowering) a-z; as UTF-8 bytes
BETWEEN = re.compile(rb"[^0-9a-zA-Z\x80-\xff]")
#: every byte lowered, and a blank for those in no word
PLAIN = bytes(32 if BETWEEN.match(bytes([b])) else bytes([b]).lower()[0] for b in range(256))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: words of an item in one row; longer items are cut into overlapping pieces
PIECE = 2000
#: bytes of a text that are cut into words at a time
SLICE = 1 << 20
SCANNED = "row long, doc_id long, n_words long, starts array<long>, ends array<long>, items array<string>"


def item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """(item, words): items cut so that every window lies in one piece; items without words are left out."""
    words = F.regexp_extract_all(F.translate(text_or_empty(), UPPER, LOWER), F.lit(WORD), F.lit(0))
    cut = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("words")).filter(F.size("words") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)), F.lit(PIECE)))
    return cut.select("item", "words", at.alias("at")).select("item", F.slice("words", F.col("at"), PIECE + window - 1).alias("words"))


class Windows:
    """Wu-Manber tables for windows of one length, over an alphabet of words (four bytes each)."""

    def __init__(self, length: int, windows: Iterable[bytes], block: int):
        self.m, self.b = 4 * length, 4 * min(block, length)
        #: how far a search may move on when it stands behind a block that no window holds
        self.most = self.m - self.b + 4
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, list[bytes]] = {}
        for w in windows:
            for end in range(self.b, self.m + 4, 4):
                key, left = w[end - self.b:end], self.m - end
                if self.shift.get(key, self.most) > left:
                    self.shift[key] = left
            self.buckets.setdefault(w[self.m - self.b:], []).append(w)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(first word, window) of each occurrence."""
        shift, buckets, m, b, most, end, at = self.shift.get, self.buckets, self.m, self.b, self.most, len(text), self.m
        while at <= end:
            block = text[at - b:at]
            step = shift(block, most)
            if step:
                at += step
                continue
            here = text[at - m:at]
            for w in buckets[block]:
                if w == here:
                    yield (at - m) // 4, w
            at += 4


class Benchmark:
    """The search tables of a pack of items: one set for each window length, as a short item is one short window."""

    def __init__(self, pieces: list[tuple[str, list[str]]], window: int, block: int = 2):
        self.word_id: dict[bytes, int] = {}
        self.items: dict[bytes, set[str]] = {}
        for item, words in pieces:
            ids = array("i", [self.word_id.setdefault(w.encode(), len(self.word_id) + 1) for w in words]).tobytes()
            size = 4 * min(window, len(words))
            for at in range(0, len(ids) - size + 4, 4):
                self.items.setdefault(ids[at:at + size], set()).add(item)
        lengths = sorted({len(w) for w in self.items})
        self.tables = [Windows(n // 4, [w for w in self.items if len(w) == n], block) for n in lengths]

    def numbers(self, text: bytes) -> tuple[int, bytes]:
        """The words of a text as numbers, zero for those of no item; a long text is read slice by slice."""
        out, at, get = array("i"), 0, self.word_id.get
        while at < len(text):
            # a slice ends at a byte that is in no word
            gap = BETWEEN.search(text, at + SLICE)
            end = gap.start() if gap else len(text)
            out.extend(map(get, text[at:end].translate(PLAIN).split(), repeat(0)))
            at = end
        return len(out), out.tobytes()

    def scan(self, text: bytes) -> tuple[int, list[int], list[int], list[str]]:
        """Number of words, hit runs of words as starts and ends, and the items found."""
        n, ids = self.numbers(text)
        spans, found = [], set()
        for t in self.tables:
            for at, w in t.find(ids):
                spans.append((at, at + t.m // 4))
                found.add(w)
        starts, ends = merged(spans)
        return n, starts, ends, sorted(set().union(*[self.items[w] for w in found]))


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Runs that cover the same words, apart and in order."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def scanned(rows: DataFrame, pieces: list, window: int) -> DataFrame:
    """``rows`` (row, doc_id, text as bytes) searched for the windows of one pack."""
    sent = rows.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Benchmark(sent.value, window)
        for batch in batches:
            found = [own.scan(x.as_py()) for x in batch.column("text")]
            cols = list(zip(*found)) or [()] * 4
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, kinds)]],
                                             ["row", "doc_id", "n_words", "starts", "ends", "items"])

    return rows.mapInArrow(run, SCANNED)


def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        runs = [merged([(s["a"], s["b"]) for s in x or ()]) for x in batch.column("spans").to_pylist()]
        starts, ends = ([r[i] for r in runs] for i in (0, 1))
        items = [sorted(set(x or ())) for x in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("row", "doc_id", "n_words")], *[pa.array(c, pa.list_(pa.int64())) for c in (starts, ends)], pa.array(items, pa.list_(pa.string()))],
            ["row", "doc_id", "n_words", "starts", "ends", "items"])


def contaminated_runs(docs: DataFrame, benchmark: DataFrame, window: int = 10, pack_words: int = 200_000) -> DataFrame:
    """One row for each document: doc_id, n_words, starts and ends of the runs of hit words, items (ids as strings, sorted).

    A window is ``window`` consecutive words of an item, or all words of a shorter item. Words are numbered by the
    vocabulary of the items. The search stands behind a block of two words: the shift table tells how far
    no window can end, so most positions are passed over; where the shift is zero, the bucket of
    that block holds the windows that end with it, and each is compared word by word.

    The items are what is broadcast, after their words are counted: beyond ``pack_words`` they are
    dealt into packs, searched one after the other over a stored table, and the runs
    of each document are joined. The documents themselves are not shuffled in either way.

    Null text has no words. Repeated rows and rows that share a doc_id are documents of their own. Item rows
    that share an id are one item, with the windows of all; those without id are one item with the empty id. An empty
    benchmark hits nothing; empty documents give no rows. Other columns are not read.
    """
    pieces = store(item_pieces(benchmark, window), "items")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    packs = max(1, -(-total // pack_words))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))

    def pack(k: int) -> list:
        own = pieces.filter(F.pmod(F.xxhash64("item", "words"), F.lit(packs)) == k) if packs > 1 else pieces
        return [(r["item"], r["words"]) for r in own.collect()]  # about pack_words words

    if packs == 1:
        return scanned(rows, pack(0), window).drop("row")
    rows = store(rows, "numbered")
    parts = [store(scanned(rows, pack(k), window), "hits") for k in range(packs)]
    hits = [p.filter(F.size("items") > 0).select("row", F.arrays_zip(F.col("starts").alias("a"), F.col("ends").alias("b")).alias("spans"), "items") for p in parts]
    all_hits = hits[0]
    for h in hits[1:]:
        all_hits = all_hits.unionByName(h)
    # a document has at most one row in each pack
    joined = all_hits.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return parts[0].select("row", "doc_id", "n_words").join(joined, "row", "left").mapInArrow(join_runs, SCANNED).drop("row")


def n_hit() -> Column:
    return F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda s, x: s + x)


def contamination(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """Counts and digest of ``contaminated_runs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return contaminated_runs(docs, benchmark, **settings).select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"))


SQL = rf"""
WITH b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM benchmark
), p AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS win
  FROM b WHERE len(w) > 0
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents
), s AS (
  SELECT r, k, unnest(range(1, len(w) - k + 2)) AS pos, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS win
  FROM d, (SELECT DISTINCT k FROM p)
), h AS (
  SELECT r, pos, s.k, item FROM s JOIN p ON s.k = p.k AND s.win = p.win
), c AS (
  SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(pos, pos + k)) AS word FROM (SELECT DISTINCT r, pos, k FROM h)) GROUP BY r
), i AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.r = c.r LEFT JOIN i ON d.r = i.r
"""
