"""Conversation structure repair: the cheapest edits, by bidirectional Dijkstra over the edit lattice."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WS, null_key, store

#: what the roles so far allow next: nothing read yet, after system, after user, after assistant
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: role initial -> the states that it may follow and the one it leads to
MOVES = {"s": ((BEGIN,), SYSTEM), "u": ((BEGIN, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
ENDS = (BEGIN, ASSISTANT)
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE = INSERT = UNFINISHED = 3
DELETE = 4
SUMMARY = "blocks struct<block:long,rows:long,blank:long,duplicate:long,truncated:long,illegal:long,first:string,last:string,low:long,high:long,turns:long,starts:array<int>,ends:array<int>,costs:array<long>,audits:array<string>>"

Row = tuple[str, int]
Best = tuple[int, str]


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by the checksum of ``conv_id:turn``; a null is written as one space, in the checksum as in role and text."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"),
                                (F.crc32(F.concat_ws(":", as_text("conv_id"), as_text("turn")).cast("binary")) % 20).alias("damage"))
    text = F.when(F.col("damage") == 1, F.lit("")).when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, F.lit("user")).otherwise(F.col("role"))
    again = F.array_repeat(F.lit(0), F.when(F.col("damage") == 3, F.lit(2)).otherwise(F.lit(1)))
    return rows.filter("damage <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(again).alias("again")).drop("again")


def own_fault() -> Column:
    """Blank and truncated, which a row shows by itself."""
    last = F.regexp_extract("text", rf"([^{WS}])[{WS}]*\z", 1)
    return F.when(last == "", BLANK).when(last.isin(".", "!", "?"), OK).otherwise(TRUNCATED)


@cache
def steps(state: int, row: Row | None) -> tuple[tuple[str, int, int, int], ...]:
    """(letter, cost, next state, rows read) of the edits at a node of the lattice; ``row`` is the next one, if any."""
    to = {initial: after for initial, (before, after) in MOVES.items() if state in before}
    out = [("I", INSERT, to[x], 0) for x in "ua" if x in to]
    if row:
        initial, fault = row
        out.append(("D", DELETE, state, 1))
        if fault in (OK, TRUNCATED):
            more = UNFINISHED if fault == TRUNCATED else 0
            out += [("K", more, to[initial], 1)] if initial in to else []
            out += [("R", REROLE + more, to[x], 1) for x in "ua" if x in to]
    return tuple(out)


@cache
def back_steps(state: int, row: Row | None) -> tuple[tuple[str, int, int, int], ...]:
    """The same edits from the node they lead to: (letter, cost, state before, rows read); ``row`` is the one before the node."""
    return tuple((letter, cost, before, read) for before in range(4) for letter, cost, after, read in steps(before, row) if after == state)


def cheapest(rows: list[Row], start: int = BEGIN, ends: tuple[int, ...] = ENDS) -> Best | None:
    """Cost and audit of the cheapest edits from ``start`` to one of ``ends``; of equal costs the least audit.

    Nodes are (rows read, state). One heap grows from the start and holds prefixes of audits, one grows from
    the ends and holds suffixes; the side with the smaller cost goes on. When their costs add up to more than the
    best crossing, every cheapest path has an edge from a node that the forward side settled to
    one that the reverse side settled, so all crossings of that cost have been seen, and the least
    audit put together at one of them is the answer.

    Keeping a row is free, so nodes of equal cost are settled in the order of rows, away from each side's
    origin. Two cheapest audits to one node are never prefixes of each other, as the longer one would hold
    more inserts; so the least prefix and the least suffix give the least audit through an edge.
    """
    n = len(rows)
    heaps: tuple[list, list] = ([(0, 0, "", start)], [(0, 0, "", s) for s in ends])
    settled: tuple[dict, dict] = ({}, {})
    best: Best | None = None
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, far, audit, state = heappop(heaps[side])
        at = n - far if side else far
        if (at, state) in settled[side]:
            continue
        settled[side][at, state] = (cost, audit)
        other = settled[1 - side]
        if (at, state) in other:
            best = least(best, joined((cost, audit), other[at, state], side))
        edges = back_steps(state, rows[at - 1] if at else None) if side else steps(state, rows[at] if at < n else None)
        for letter, price, neighbour, read in edges:
            node = (at - read if side else at + read, neighbour)
            path = (cost + price, letter + audit if side else audit + letter)
            if node in other:
                best = least(best, joined(path, other[node], side))
            if node not in settled[side]:
                heappush(heaps[side], (path[0], far + read, path[1], neighbour))
    return best


def joined(own: Best, other: Best, side: int) -> Best:
    return (own[0] + other[0], other[1] + own[1] if side else own[1] + other[1])


def least(a: Best | None, b: Best | None) -> Best | None:
    return b if a is None else a if b is None else min(a, b)


def illegal(before: str | None, after: str | None) -> bool:
    return before is not None and after is not None and before + after not in ("su", "ua", "au")


def block_summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One summary for each run of rows with the same key and block, which arrive in order.

    A whole conversation needs one path, from the beginning to an end. A block of a longer one needs one for each
    state it can be entered and left in, since only the blocks around it tell which.
    """
    done: list[tuple[str, dict]] = []
    now, held, whole = None, [], True

    def close():
        if now is None:
            return
        rows = [(i, f) for i, f, _ in held]
        turns = [t for _, _, t in held if t is not None]
        paths = [(BEGIN, -1, cheapest(rows))] if whole else [(a, b, cheapest(rows, a, (b,))) for a in range(4) for b in range(4)]
        paths = [(a, b, p) for a, b, p in paths if p]
        done.append((now[0], {
            "block": now[1], "rows": len(rows), **{name: sum(f == k for _, f in rows) for name, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))},
            "illegal": sum(illegal(a, b) for (a, _), (b, _) in zip(rows, rows[1:])), "first": rows[0][0], "last": rows[-1][0],
            "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)),
            "starts": [a for a, _, _ in paths], "ends": [b for _, b, _ in paths], "costs": [p[0] for _, _, p in paths], "audits": [p[1] for _, _, p in paths]}))

    def flush() -> pa.RecordBatch:
        keys, blocks = [k for k, _ in done], [b for _, b in done]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(blocks, ARROW)], ["key", "blocks"])

    for batch in batches:
        for key, block, part, initial, fault, turn in zip(*[batch.column(c).to_pylist() for c in ("key", "block", "part", "initial", "fault", "turn")]):
            if (key, block) != now:
                close()
                now, held, whole = (key, block), [], not part
            held.append((initial, fault, turn))
        if len(done) > 1000:
            yield flush()
    close()
    yield flush()


ARROW = pa.struct([*[(c, pa.int64()) for c in ("block", "rows", "blank", "duplicate", "truncated", "illegal")], ("first", pa.string()), ("last", pa.string()),
                   *[(c, pa.int64()) for c in ("low", "high", "turns")], ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
                   ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])


class Repair:
    """One conversation: takes its block summaries, then its rows, both in order; holds the audit and no text."""

    COUNTS = ("blank", "duplicate", "truncated")

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.found = dict.fromkeys(("gaps", *self.COUNTS, "illegal"), 0)
        #: state -> cheapest edits of the blocks so far that lead to it
        self.paths: dict[int, Best] = {BEGIN: (0, "")}
        self.last, self.low, self.high, self.turns = None, None, None, 0
        self.sha, self.at, self.out, self.audit = hashlib.sha256(), 0, 0, None

    def add_block(self, b: dict) -> None:
        for c in self.COUNTS:
            self.found[c] += b[c]
        self.found["illegal"] += b["illegal"] + illegal(self.last, b["first"])
        self.last = b["last"]
        if b["low"] is not None:
            # rows come by turn, so a turn that two blocks share is the last of one and the first of the next
            self.turns += b["turns"] - (self.high == b["low"])
            self.low, self.high = b["low"] if self.low is None else self.low, b["high"]
        after: dict[int, Best] = {}
        for a, end, cost, audit in zip(b["starts"], b["ends"], b["costs"], b["audits"]):
            if a in self.paths:
                end = ASSISTANT if end < 0 else end
                after[end] = least(after.get(end), (self.paths[a][0] + cost, self.paths[a][1] + audit))
        self.paths = after

    def begin_rows(self) -> None:
        if self.audit is None:
            self.cost, self.audit = min(p for s, p in self.paths.items() if s in ENDS)
            self.size = len(self.audit) - self.audit.count("D")

    def write(self, role: str | None, text: str) -> None:
        """One turn of the repaired conversation; a role that an edit sets follows from its place."""
        if role is None:
            role = ("user", "assistant")[(self.out - self.size % 2) % 2]
        self.sha.update((("\n" if self.out else "") + role + ":" + text).encode())
        self.out += 1

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.write(None, "")
            self.at += 1

    def add_row(self, role: str, text: str) -> None:
        self.begin_rows()
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self.write(role if letter == "K" else None, text)

    def result(self) -> tuple:
        self.begin_rows()
        self.inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *[self.found[c] for c in self.COUNTS], self.found["illegal"], self.cost, self.audit, self.sha.hexdigest())


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's rows in order: its id (kind 0), its block summaries (1), its turns (2)."""
    now, repair, done = None, None, []
    names = [c.split()[0] for c in RESULT.split(", ")]

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done)) or [()] * len(names)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n, c in zip(names, cols)], names)

    for batch in batches:
        for i, (key, kind, conv_id) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("key", "kind", "conv_id")])):
            if key != now:
                if repair:
                    done.append(repair.result())
                now, repair = key, Repair(conv_id)
            if kind == 1:
                repair.add_block(batch.column("blocks")[i].as_py())
            elif kind == 2:
                repair.add_row(batch.column("role")[i].as_py(), batch.column("text")[i].as_py())
        if len(done) > 1000:
            yield flush()
    if repair:
        done.append(repair.result())
    yield flush()


def repaired(conversations: DataFrame, block_rows: int = 2048) -> DataFrame:
    """Damage, faults and the cheapest repair of each conversation.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256; one row for each conv_id.

    The damaged rows are range-sorted by conversation and turn, so that a long conversation
    spreads over tasks. A row is a duplicate when its place is not the first of its role and text, found by
    an aggregate. A conversation of up to ``block_rows`` rows is one path search. A longer one is cut into blocks of as many
    rows, searched apart for each state they can be entered and left in, and the blocks' paths are put together. The
    digest of the repaired turns is that of one ordered byte sequence, so the rows of a conversation
    pass through one task in sorted order for it; that task holds the audit letters and no texts.

    Null conv_ids are one conversation with a null id. A null turn comes first, a null role or text is one space (so the text is
    blank). Rows with the same turn are taken by role and by the SHA-256 of their text; equal ones
    are duplicates of each other. A role is read by its first letter; roles that begin otherwise can
    only be replaced or deleted. Texts of any length stay whole. An empty table gives no rows; other columns are not read.
    """
    key = null_key("conv_id").alias("key")
    order = ["key", "turn", "role", "same"]
    rows = damaged(conversations).select(key, "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", F.unhex(F.sha2("text", 256)).alias("same"))
    # the last key spreads equal rows; which of them comes first makes no difference
    rows = rows.withColumn("spread", F.rand(7)).repartitionByRange(*order, "spread").sortWithinPartitions(*order, "spread").drop("spread")
    turns = store(rows.withColumn("pos", F.monotonically_increasing_id()), "turns")
    repeats = store(turns.groupBy("key", "role", "same").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "repeats")
    long = store(turns.groupBy("key").count().filter(F.col("count") > block_rows).select("key", F.lit(True).alias("part")), "long")
    place = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.when(F.col("part"), F.col("pos") - place % block_rows).otherwise(0)
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin(*MOVES), initial).otherwise("-")
    slim = turns.select("key", "pos", "turn", "role", "same", initial.alias("initial"), own_fault().alias("own")).join(repeats, ["key", "role", "same"], "left")
    fault = F.when(F.col("own") == BLANK, BLANK).when(F.col("first") < F.col("pos"), DUPLICATE).otherwise(F.col("own"))
    slim = slim.join(long, "key", "left").select(
        "key", block.alias("block"), F.coalesce("part", F.lit(False)).alias("part"), "pos", "initial", fault.alias("fault"), "turn")
    blocks = slim.repartition("key", "block").sortWithinPartitions("key", "block", "pos").mapInArrow(block_summaries, f"key string, {SUMMARY}")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    struct = SUMMARY.removeprefix("blocks ")
    ids = conversations.select(key, F.col("conv_id").cast("long").alias("conv_id")).distinct()
    parts = [
        ids.select("key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("at"), "conv_id", none(struct, "blocks"), none("string", "role"), none("string", "text")),
        blocks.select("key", F.lit(1).alias("kind"), F.col("blocks.block").alias("at"), none("long", "conv_id"), "blocks", none("string", "role"), none("string", "text")),
        turns.select("key", F.lit(2).alias("kind"), F.col("pos").alias("at"), none("long", "conv_id"), none(struct, "blocks"), "role", "text"),
    ]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return together.repartition("key").sortWithinPartitions("key", "kind", "at").mapInArrow(results, RESULT)


def plain_rows(rows: list[tuple]) -> list[tuple]:
    """The damaged rows of one conversation in order, for tests."""
    out = []
    for conv, turn, role, text in rows:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if hit == 1:
            text = ""
        elif hit == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        elif hit == 4:
            role = "user"
        out += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))


def plain_repair(rows: list[Row]) -> Best:
    """The cheapest edits by trying, row after row, every edit from every state; for tests."""
    paths: dict[int, Best] = {BEGIN: (0, "")}
    for at in range(len(rows) + 1):
        for _ in range(2):  # two inserts lead from any state to any that inserts can reach
            for state, (cost, audit) in list(paths.items()):
                for letter, price, after, read in steps(state, None):
                    paths[after] = least(paths.get(after), (cost + price, audit + letter))
        if at < len(rows):
            after_row: dict[int, Best] = {}
            for state, (cost, audit) in paths.items():
                for letter, price, after, read in steps(state, rows[at]):
                    if read:
                        after_row[after] = least(after_row.get(after), (cost + price, audit + letter))
            paths = after_row
    return min(p for s, p in paths.items() if s in ENDS)


SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)), lambda a, k: xor(a >> 1, (a & 1) * 3988292384)) AS v FROM (SELECT unnest(range(256)) AS b))
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS name FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(name, lambda x: ascii(x)::BIGINT)),
         lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 20 AS damage FROM raw, crc
), rows AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role, CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN damage = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit WHERE damage <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM rows
), faults AS (
  SELECT *, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '-' END AS initial,
         CASE WHEN NOT regexp_matches(text, '[^{WS}]') THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
              WHEN regexp_extract(text, '([^{WS}])[{WS}]*\z', 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault FROM placed
), moves(before, after, initial) AS (
  VALUES ('B', 'S', 's'), ('B', 'U', 'u'), ('S', 'U', 'u'), ('A', 'U', 'u'), ('U', 'A', 'a')
), inserted(before, after, price, letters) AS (
  SELECT s, s, 0, '' FROM (VALUES ('B'), ('S'), ('U'), ('A')) v(s)
  UNION ALL SELECT before, after, 3, 'I' FROM moves WHERE initial <> 's'
  UNION ALL SELECT a.before, b.after, 6, 'II' FROM moves a JOIN moves b ON a.after = b.before AND a.initial <> 's' AND b.initial <> 's' AND a.before <> b.after
), edits AS (
  SELECT s AS before, s AS after, 4 AS price, 'D' AS letter, '*' AS initial FROM (VALUES ('B'), ('S'), ('U'), ('A')) v(s)
  UNION ALL SELECT before, after, 0, 'K', initial FROM moves
  UNION ALL SELECT before, after, 3, 'R', '*' FROM moves WHERE initial <> 's'
), dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 'B' AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM conversations
  UNION ALL
  SELECT dp.conv_id, f.i, e.after, min({{'cost': dp.best.cost + n.price + e.price + CASE WHEN f.fault = 3 AND e.letter <> 'D' THEN 3 ELSE 0 END, 'audit': dp.best.audit || n.letters || e.letter}})
  FROM dp JOIN faults f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1
       JOIN inserted n ON n.before = dp.state
       JOIN edits e ON e.before = n.after AND (e.letter = 'D' OR f.fault IN (0, 3)) AND (e.letter <> 'K' OR e.initial = f.initial)
  GROUP BY dp.conv_id, f.i, e.after
), last AS (
  SELECT conv_id, max(i) AS i FROM dp GROUP BY conv_id
), chosen AS (
  SELECT dp.conv_id, min({{'cost': dp.best.cost + n.price, 'audit': dp.best.audit || n.letters}}) AS best
  FROM dp JOIN last ON last.conv_id IS NOT DISTINCT FROM dp.conv_id AND last.i = dp.i JOIN inserted n ON n.before = dp.state AND n.after IN ('B', 'A') GROUP BY dp.conv_id
), letters AS (
  SELECT conv_id, unnest(string_split(best.audit, '')) AS letter, generate_subscripts(string_split(best.audit, ''), 1) AS spot FROM chosen WHERE best.audit <> ''
), walked AS (
  SELECT conv_id, letter, spot, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY spot) AS i, count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY spot) AS o,
         count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id) AS size FROM letters
), lines AS (
  SELECT w.conv_id, spot, CASE WHEN letter = 'K' THEN role WHEN (o - size % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line
  FROM walked w LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i WHERE letter <> 'D'
), texts AS (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY spot) AS repaired FROM lines GROUP BY conv_id
), beside AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM faults
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
         count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM beside GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, c.best.cost::BIGINT AS cost, c.best.audit AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM chosen c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM c.conv_id
"""
