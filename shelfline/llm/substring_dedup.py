"""Substring deduplication by fixed-block anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import store, text_or_empty

#: bits of an anchor hash that are compared; false hits only cost a look at the words
BITS = 40
#: stands for a null doc_id, above all others
NULL_ID = 2**63 - 1
EMPTY = np.zeros(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) >> np.uint64(64 - BITS)


def planes(values: np.ndarray) -> bytes:
    """Numbers with their byte planes apart, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def unplanes(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


def shrink(values: np.ndarray) -> bytes:
    """Sorted numbers as differences."""
    return planes(np.diff(values, prepend=np.uint64(0)))


def grow(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, np.uint64), dtype=np.uint64)


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


#: words hashed at a time
SLAB = 1 << 16


class Pack:
    """Documents in one compressed row: ids, numbers of words, and all words joined by single spaces."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, words: np.ndarray, body: bytes):
        self.ids, self.nulls, self.words, self.body = ids, nulls, words, body
        spaces = np.flatnonzero(np.frombuffer(body, np.uint8) == 32)
        some = [0] if body else []
        self.begins, self.ends = np.concatenate([np.array(some, np.int64), spaces + 1]), np.concatenate([spaces, np.array([len(body)] if body else [], np.int64)])
        self.firsts = np.concatenate([[0], np.cumsum(words)])
        #: document of each word and its place there
        self.doc = np.repeat(np.arange(len(ids)), words)
        self.place = np.arange(len(self.doc)) - self.firsts[self.doc]

    @staticmethod
    def write(ids: list, texts: list[list[bytes]]) -> bytes:
        nulls = np.array([x is None for x in ids], bool)
        numbers, words = np.array([NULL_ID if x is None else x for x in ids], np.int64), np.array([len(t) for t in texts], np.int64)
        head = [np.array([len(ids)], np.int64).tobytes(), numbers.tobytes(), nulls.tobytes(), words.tobytes()]
        return zstandard.ZstdCompressor(level=6).compress(b"".join([*head, b" ".join([w for t in texts for w in t])]))

    @classmethod
    def read(cls, data: bytes) -> Pack:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        return cls(np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, bool, n, 8 + 8 * n), np.frombuffer(raw, np.int64, n, 8 + 9 * n), raw[8 + 17 * n:])

    def text(self, d: int) -> bytes:
        return self.body[self.begins[self.firsts[d]]:self.ends[self.firsts[d + 1] - 1]] if self.words[d] else b""

    def word_hashes(self) -> np.ndarray:
        """A 64-bit sum of bytes times powers for each word. Words that collide only cost a look at the words themselves."""
        out = []
        for lo in range(0, len(self.begins), SLAB):
            begins, ends = self.begins[lo:lo + SLAB], self.ends[lo:lo + SLAB]
            at, lengths = begins - begins[0], ends - begins + 1
            data = np.frombuffer(self.body, np.uint8)[begins[0]:ends[-1]].astype(np.uint64)
            data = np.append(data, np.uint64(32))
            data[data == 32] = 0
            powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
            inside = np.arange(len(data)) - np.repeat(at, lengths)
            h = np.add.reduceat(data * powers[inside], at)
            out.append((h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9))
        return np.concatenate([EMPTY, *out])

    def anchors(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Words at which a rolling window of ``block`` words of one document starts, and its hash; where the place in
        the document is a multiple of ``block`` the window is a reference block."""
        h = self.word_hashes()
        h ^= h >> np.uint64(29)
        n = max(0, len(h) - block + 1)
        rolled = np.zeros(n, np.uint64)
        for k in range(block):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + h[k:k + n]
        at = np.flatnonzero(self.place[:n] + block <= self.words[self.doc[:n]])
        return at, mixed(rolled[at])


def pack_documents(most: int):
    """Packs of at least ``most`` words, the last of a task smaller."""

    def packed(number: int, ids: list, texts: list[list[bytes]], held: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([held], pa.int64()), pa.array([Pack.write(ids, texts)], pa.binary())], ["pack", "words", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids.append(doc)
                texts.append(text.as_py().split())
                held += len(texts[-1])
                if held >= most:
                    yield packed(number, ids, texts, held)
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield packed(number, ids, texts, held)

    return run


def cuts(values: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Where each of ``parts`` equal ranges of numbers of ``bits`` bits begins in sorted values, and their end."""
    edges = np.array([(i << bits) // parts for i in range(parts)], np.uint64)
    return np.append(np.searchsorted(values, edges), len(values))


def probes(block: int, parts: int):
    """For each pack and hash range: its reference blocks with those that occur twice, and all other rolling windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, data in zip(batch.column("pack").to_pylist(), batch.column("data")):
                own = Pack.read(data.as_py())
                at, h = own.anchors(block)
                reference = own.place[at] % block == 0
                blocks, n = np.unique(h[reference], return_counts=True)
                sets = [blocks, blocks[n > 1], np.unique(h[~reference])]
                bounds = [cuts(x, parts, BITS) for x in sets]
                rows = [(p, pack, *[shrink(x[c[p]:c[p + 1]]) for x, c in zip(sets, bounds)]) for p in range(parts) if any(c[p] < c[p + 1] for c in bounds)]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["part", "pack", "blocks", "twice", "others"])

    return run


def match(table: pa.Table) -> pa.Table:
    """The index of one hash range, probed: for each pack the hashes that meet a reference block at another place."""
    packs, blocks, twice, others = ([x.as_py() for x in table.column(c)] for c in ("pack", "blocks", "twice", "others"))
    blocks = [grow(x) for x in blocks]
    index, holders = np.unique(np.concatenate([EMPTY, *blocks]), return_counts=True)
    again = np.union1d(index[holders > 1], np.concatenate([EMPTY, *[grow(x) for x in twice]]))
    out = []
    for pack, own, rest in zip(packs, blocks, others):
        rest = grow(rest)
        hits = np.union1d(own[member(own, again)], rest[member(rest, index)])
        if len(hits):
            out.append((pack, shrink(hits)))
    return pa.table({"pack": pa.array([x[0] for x in out], pa.int64()), "hits": pa.array([x[1] for x in out], pa.binary())})


class Candidates:
    """The windows of a pack that hold a hit, extended to both sides, in one table: document, start, and a 96-bit digest of
    the words; equal ones form groups."""

    def __init__(self, pack: Pack, hits: list[bytes], block: int, window: int):
        found = np.sort(np.concatenate([EMPTY, *[grow(x) for x in hits]]))
        at, h = pack.anchors(block)
        # a table of the upper bits spares most of the searches
        table = np.zeros(1 << 20, bool)
        table[found >> np.uint64(BITS - 20)] = True
        maybe = np.flatnonzero(table[h >> np.uint64(BITS - 20)])
        hit = np.zeros(len(pack.doc) + 1, np.int64)
        hit[at[maybe[member(h[maybe], found)]] + 1] = 1
        upto = np.cumsum(hit)
        first = np.flatnonzero(pack.place + window <= pack.words[pack.doc])
        word = first[upto[first + window - block + 1] > upto[first]]
        self.doc, self.start, self.id = pack.doc[word], pack.place[word], pack.ids[pack.doc[word]]
        body, digest = pack.body, hashlib.blake2b
        digests = b"".join([digest(body[a:b], digest_size=12).digest() for a, b in zip(pack.begins[word].tolist(), pack.ends[word + window - 1].tolist())])
        both = np.frombuffer(digests, [("low", "<u8"), ("high", "<u4")])
        self.low, self.high = both["low"], both["high"]
        order = np.lexsort((self.start, self.id, self.high, self.low))
        opens = opening(self.low[order], self.high[order])
        #: the first row of each group in document order, by digest; and the group of each row
        self.first = order[opens]
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(opens) - 1

    def repeated(self, late: np.ndarray) -> np.ndarray:
        """Rows that start later than an equal window; ``late`` are the groups for which another pack has an earlier one."""
        own = self.first[self.group]
        marked = np.zeros(len(self.first), bool)
        marked[late] = True
        return marked[self.group] | (self.id > self.id[own]) | ((self.id == self.id[own]) & (self.start > self.start[own]))


def opening(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where a new digest begins in sorted ones."""
    out = np.ones(len(low), bool)
    out[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return out


def windows(block: int, window: int, parts: int):
    """For each pack and digest range: the first occurrence of each candidate window, as digest, document and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, hits in zip(batch.column("pack").to_pylist(), batch.column("data"), batch.column("hits")):
                c = Candidates(Pack.read(data.as_py()), hits.as_py(), block, window)
                at = c.first
                low, high, ids, starts = c.low[at], c.high[at], c.id[at], c.start[at].astype(np.uint32)
                bounds = cuts(low, parts, 64)
                rows = [(p, number, shrink(low[a:b]), planes(high[a:b]), planes(ids[a:b]), planes(starts[a:b])) for p, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["part", "pack", "low", "high", "ids", "starts"])

    return run


def compare(table: pa.Table) -> pa.Table:
    """Of one digest range, for each pack: the places, among the windows it sent, of those that start earlier in another pack."""
    get = lambda c, f: [f(x.as_py()) for x in table.column(c)]
    lows = get("low", grow)
    sizes = [len(x) for x in lows]
    low, high = np.concatenate(lows), np.concatenate(get("high", lambda x: unplanes(x, np.uint32)))
    ids, starts = np.concatenate(get("ids", lambda x: unplanes(x, np.int64))), np.concatenate(get("starts", lambda x: unplanes(x, np.uint32)))
    order = np.lexsort((starts, ids, high, low))
    opens = opening(low[order], high[order])
    first = order[opens][np.cumsum(opens) - 1]
    late = np.zeros(len(order), bool)
    late[order] = (ids[order] != ids[first]) | (starts[order] != starts[first])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    found = [shrink(np.flatnonzero(late[a:b]).astype(np.uint64)) for a, b in zip(bounds, bounds[1:])]
    return pa.table({"pack": table.column("pack"), "part": table.column("part"), "late": pa.array(found, pa.binary())})


def removed(block: int, window: int, parts: int):
    """Every document of the packs without the words of windows that also start earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, hits, answers in zip(batch.column("data"), batch.column("hits"), batch.column("later")):
                pack = Pack.read(data.as_py())
                c = Candidates(pack, hits.as_py() or [], block, window)
                bounds = cuts(c.low[c.first], parts, 64)
                late = [bounds[x["part"]] + grow(x["late"]).astype(np.int64) for x in answers.as_py() or []]
                marked = c.repeated(np.concatenate([np.zeros(0, np.int64), *late]))
                word = pack.firsts[c.doc[marked]] + c.start[marked]
                steps = np.zeros(len(pack.doc) + 1, np.int64)
                steps[word] += 1
                np.subtract.at(steps, word + window, 1)
                gone = np.cumsum(steps[:-1]) > 0
                upto = np.concatenate([[0], np.cumsum(gone)])
                lost = upto[pack.firsts[1:]] - upto[pack.firsts[:-1]]
                for lo in range(0, len(pack.ids), 1000):
                    hi = min(lo + 1000, len(pack.ids))
                    kept = []
                    for d in range(lo, hi):
                        text = pack.text(d)
                        if lost[d]:
                            stay = (~gone[pack.firsts[d]:pack.firsts[d + 1]]).tolist()
                            text = b" ".join(compress(text.split(b" "), stay))
                        kept.append(text)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pack.ids[lo:hi], mask=pack.nulls[lo:hi]), pa.array(pack.words[lo:hi]), pa.array(lost[lo:hi]), pa.array(kept, pa.binary())],
                        ["doc_id", "n_words", "n_removed", "kept"])

    return run


def without_repeated_passages(docs: DataFrame, window: int = 20, pack_words: int = 1_000_000, range_words: int = 4_000_000) -> DataFrame:
    """Each document without the words covered by a window of ``window`` words that also starts earlier
    (smaller doc_id, or same document and earlier start): doc_id, n_words, n_removed, kept (words joined by one space, UTF-8).

    Reference blocks are the non-overlapping runs of window / 2 words of each document. Any window
    holds a whole one, so of two equal windows each meets, at some rolling position, a reference block of the other.

    1. Documents are packed into compressed rows in the shared folder, which fixes what belongs together.
    2. Every pack sends its reference blocks and all its rolling windows as sorted hashes, by hash range. Each
       range indexes the blocks, probes them with the windows, and answers the packs with the hits.
    3. In the packs hits are extended to all windows around them, and these compared by a 96-bit digest of
       their words; each pack sends the first occurrence of a digest, by digest range, so a passage that very many documents
       share counts once for each pack. The range answers which windows start earlier elsewhere.
    4. Overlapping marked windows make up the maximal repeats, and their words are removed.

    A pack has about ``pack_words`` words and a hash range about ``range_words`` hashes, at every size. Rows that share a doc_id count as one document:
    equal starts in them are not earlier. A null doc_id is above all others. Null and empty texts have no word;
    documents of fewer than ``window`` words lose none. An empty table gives no rows.
    """
    block = window // 2
    packs = store(
        docs.select("doc_id", text_or_empty().cast("binary").alias("text")).mapInArrow(pack_documents(pack_words), "pack long, words long, data binary"), "packs")
    parts = max(1, int((packs.agg(F.sum("words")).first()[0] or 0) / range_words) + 1)
    hits = (
        packs.select("pack", "data").mapInArrow(probes(block, parts), "part int, pack long, blocks binary, twice binary, others binary")
        .groupBy("part").applyInArrow(match, "pack long, hits binary")
        .groupBy("pack").agg(F.collect_list("hits").alias("hits"))  # one entry for each hash range
    )
    hits = store(hits, "anchor-hits")
    found = packs.select("pack", "data").join(hits, "pack").mapInArrow(
        windows(block, window, parts), "part int, pack long, low binary, high binary, ids binary, starts binary")
    later = (
        found.groupBy("part").applyInArrow(compare, "pack long, part int, late binary")
        .groupBy("pack").agg(F.collect_list(F.struct("part", "late")).alias("later"))  # one entry for each digest range
    )
    return (
        packs.select("pack", "data").join(hits, "pack", "left").join(later, "pack", "left").select("data", "hits", "later")
        .mapInArrow(removed(block, window, parts), "doc_id long, n_words long, n_removed long, kept binary"))


def passage_digest(docs: DataFrame, **settings) -> DataFrame:
    return without_repeated_passages(docs, **settings).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], window: int = 20) -> list[tuple]:
    """The same result from the definition, for tests."""
    docs = [(NULL_ID if d is None else d, d, (t or "").encode().split()) for d, t in rows]
    first: dict[tuple, tuple] = {}
    for doc, _, words in docs:
        for s in range(len(words) - window + 1):
            key = tuple(words[s:s + window])
            first[key] = min(first.get(key, (doc, s)), (doc, s))
    out = []
    for doc, doc_id, words in docs:
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            if first[tuple(words[s:s + window])] < (doc, s):
                gone[s:s + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS start, words FROM w WHERE len(words) >= 20
), g AS (
  SELECT doc_id, start, min((doc_id, start)) OVER (PARTITION BY array_to_string(words[start:start + 19], ' ')) AS first FROM s
), r AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS pos FROM g WHERE first <> (doc_id, start)
), l AS (
  SELECT doc_id, list(pos) AS gone FROM r GROUP BY doc_id
)
SELECT w.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(list_filter(words, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)), ' ')) AS kept_sha256
FROM w LEFT JOIN l ON w.doc_id = l.doc_id
"""
