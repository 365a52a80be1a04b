"""Line deduplication with two Bloom filters, for lines seen once and lines seen twice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import store, text_or_empty

SEGMENT = 1 << 20
BLANK = b" \t\n\x0b\x0c\r"
#: stands for a null doc_id, below all others
NULL_ID = -(2**63)
BITS = "segment int, salt int, once binary, twice binary"


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()


def long_keys(text: bytes, least: int) -> set[bytes]:
    """The distinct keys of a document's lines that have at least ``least`` code points."""
    keys = {line_key(x) for x in text.split(b"\n") if len(x) >= least}
    return {k for k in keys if len(k) >= least and len(k.decode("utf-8", "replace")) >= least}


def positions(hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Bit positions of each 64-bit hash, a row each."""
    step = (hashes >> np.uint64(17)) | np.uint64(1)
    return np.stack([((hashes + np.uint64(i) * step) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) % np.uint64(bits) for i in range(probes)], axis=1)


def hashed(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k) for k in keys), np.uint64)


def touched_bits(bits: int, probes: int, least: int, salts: int):
    """Per task and segment: the bits that the task's (document, key) pairs touch once, and more often."""

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        at, n = np.unique(np.concatenate(parts), return_counts=True)
        cuts = np.searchsorted(at, np.arange(0, bits + SEGMENT, SEGMENT))
        rows = []
        for s in np.flatnonzero(np.diff(cuts)):
            own, seen = (at[cuts[s]:cuts[s + 1]] % SEGMENT).astype(np.uint32), n[cuts[s]:cuts[s + 1]]
            rows.append((int(s), TaskContext.get().partitionId() % salts, own[seen == 1].tobytes(), own[seen > 1].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["segment", "salt", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for text in batch.column("text"):
                keys = long_keys(text.as_py(), least)
                if keys:
                    # a key touches each of its bits once, even where two probes meet
                    own = np.sort(positions(hashed(keys), bits, probes), axis=1)
                    parts.append(own[np.concatenate([np.ones((len(own), 1), bool), own[:, 1:] != own[:, :-1]], axis=1)])
                    held += len(parts[-1])
            if held > 4_000_000:
                yield flush(parts)
                parts, held = [], 0
        if parts:
            yield flush(parts)

    return run


def met(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The touched bits and those seen twice of one segment, from those of several tasks: a bit that two of them touch is seen twice."""
    once, twice = np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
    for o, t in zip(table.column("once"), table.column("twice")):
        for buffer, again in ((o, False), (t, True)):
            at = np.frombuffer(buffer.as_buffer(), np.uint32) if len(buffer.as_buffer()) else np.zeros(0, np.uint32)
            twice[at if again else at[once[at]]] = True
            once[at] = True
    return once, twice


def merge_bits(table: pa.Table) -> pa.Table:
    once, twice = met(table)
    return pa.table({
        "segment": table.column("segment")[:1].cast(pa.int32()), "salt": pa.array([0], pa.int32()),
        "once": pa.array([np.flatnonzero(once & ~twice).astype(np.uint32).tobytes()]), "twice": pa.array([np.flatnonzero(twice).astype(np.uint32).tobytes()])})


def twice_bitmap(table: pa.Table) -> pa.Table:
    """The segment of the second filter, packed."""
    return pa.table({"segment": table.column("segment")[:1].cast(pa.int32()), "packed": pa.array([np.packbits(met(table)[1], bitorder="little").tobytes()])})


def filter_bits(lines: int, bits_a_line: int, most_bits: int) -> int:
    """Bits of a filter for that many lines: a power of two with at least ``bits_a_line`` for each, up to ``most_bits``."""
    bits = SEGMENT
    while bits < most_bits and bits < lines * bits_a_line:
        bits *= 2
    return bits


def suspected(filter_of, bits: int, probes: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(filter_of.value, np.uint8)
        for batch in batches:
            ids, found = [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
                keys = list(long_keys(text.as_py(), least))
                if keys:
                    at = positions(hashed(keys), bits, probes)
                    hit = ((packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
                    found += [keys[i] for i in np.flatnonzero(hit)]
                    ids += [doc] * int(hit.sum())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["doc", "line_key"])

    return run


def drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, gone, kept = [], [], []
        for text, drops in zip(batch.column("text"), batch.column("drops").to_pylist()):
            lines = text.as_py().split(b"\n")
            drops = set(drops or ())
            left = [x for x in lines if line_key(x) not in drops] if drops else lines
            n.append(len(lines))
            gone.append(len(lines) - len(left))
            kept.append(b"\n".join(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_lines", "n_dropped", "kept"])


def without_repeated_lines(docs: DataFrame, least: int = 20, documents: int = 3, bits: int | None = None, probes: int = 3, salts: int = 64,
                           bits_a_line: int = 8, most_bits: int = 1 << 30) -> DataFrame:
    """Each document without the lines that ``documents`` or more documents share: doc_id, n_lines, n_dropped, kept (UTF-8 bytes).

    A line's key is the line stripped of ASCII white space and with A-Z lowered. A frequent key of at
    least ``least`` code points keeps its lines only in the largest doc_id that holds it.

    Every (document, key) touches ``probes`` bits. A bit touched twice, in one task or in two, is set in
    the second filter; a key in two documents has all its bits there, so only keys found there can repeat.
    These suspects alone are shuffled, with their text, counted exactly, and dropped.
    The lines of at least ``least`` code points are counted first; the filters have 8 to 16 bits for each (``bits_a_line``), so that
    1 to 3 % of the lines that do not repeat pass as suspects at any size up to ``most_bits`` (128 MB, some 130 million lines), which is
    what is broadcast at most. Beyond it, or with a smaller ``bits``, more lines go through to the exact count and no result changes.

    Null text counts as one empty line. A null doc_id is one document, below all others; rows that share a
    doc_id are one document for the count. Lines of a frequent key that repeat inside the document
    which keeps it all stay. An empty table gives no rows.
    """
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), text_or_empty().cast("binary").alias("text"))
    if bits is None:
        lines = docs.agg(F.sum(F.regexp_count(text_or_empty(), F.lit(f"[^\\n]{{{least},}}"))).alias("n")).first()["n"]
        bits = filter_bits(lines or 0, bits_a_line, most_bits)
    touched = rows.select("text").mapInArrow(touched_bits(bits, probes, least, salts), BITS)
    merged = touched.groupBy("segment", "salt").applyInArrow(merge_bits, BITS).groupBy("segment").applyInArrow(twice_bitmap, "segment int, packed binary")
    seen_twice = bytearray(bits // 8)
    for row in merged.collect():  # one row of 128 KB for each of bits / SEGMENT segments
        seen_twice[row["segment"] * SEGMENT // 8:(row["segment"] + 1) * SEGMENT // 8] = row["packed"]
    sent = docs.sparkSession.sparkContext.broadcast(bytes(seen_twice))
    suspects = store(rows.select("doc", "text").mapInArrow(suspected(sent, bits, probes, least), "doc long, line_key binary"), "suspects")
    # stored, and no aggregate on the line above the join, so that the join can split a line that very many documents share
    frequent = store(suspects.groupBy("line_key").agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("keeper")).filter(F.col("n") >= documents), "frequent")
    drops = (
        suspects.join(frequent, "line_key").filter("doc <> keeper")
        .groupBy("doc").agg(F.collect_set("line_key").alias("drops"))
    )
    # the drops are the hashed side, so the texts are not sorted
    return rows.join(drops.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "drops").mapInArrow(
        drop_lines, "doc_id long, n_lines long, n_dropped long, kept binary")


def line_digest(docs: DataFrame, **settings) -> DataFrame:
    return without_repeated_lines(docs, **settings).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], least: int = 20, documents: int = 3) -> list[tuple]:
    """The same result from the definition, for tests."""
    held: dict[bytes, set] = {}
    docs = [(NULL_ID if d is None else d, d, (t or "").encode()) for d, t in rows]
    for doc, _, text in docs:
        for line in text.split(b"\n"):
            held.setdefault(line_key(line), set()).add(doc)
    out = []
    for doc, doc_id, text in docs:
        lines = text.split(b"\n")
        kept = [x for x in lines if len(line_key(x).decode()) < least or len(held[line_key(x)]) < documents or doc == max(held[line_key(x)])]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return out


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), j AS (
  SELECT k.doc_id, k.pos, k.line, f.key IS NULL OR f.keeper = k.doc_id AS stays FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) - sum(stays::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
