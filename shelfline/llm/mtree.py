"""Exact top-k search by inner product in a paged M-tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import store

#: entries of a leaf page, and of the block of pages that one row holds
PAGE, BLOCK = 128, 4096
#: queries in one pack
PACK = 256
#: bounds are compared with this much room for rounding
EPS = 1e-6
BLOCKS = "region int, block long, far double, centre binary, radius double, size int, ids binary, vectors binary, starts binary, heads binary, radii binary, parents binary, spokes binary"


def quantised(rows: DataFrame, steps: int = 256) -> DataFrame:
    """(vec_id, v): components floor(steps * x). Rows with a null id, a null vector, or a null or non-finite component are left out."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(~bad)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * steps)).alias("v")))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a batch as rows, shorter ones filled with zeros."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    if len(column) and (np.diff(ends) == dim).all():
        return flat.reshape(len(column), dim).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    for i in range(len(column)):
        out[i, :ends[i + 1] - ends[i]] = flat[ends[i]:ends[i + 1]]
    return out


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with one more component that brings them all to the length sqrt(top)."""
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(0.0, top - (x * x).sum(axis=1)))[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all of b."""
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(0.0, square))


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """Indices of up to n rows, each the farthest from those before it."""
    chosen, least = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(n, len(sample)):
        least = np.minimum(least, distances(sample[chosen[-1:]], sample)[0])
        if least.max() <= EPS:
            break
        chosen.append(int(least.argmax()))
    return np.array(chosen)


def split(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Halve the rows between two far ones until each part fits a page."""
    if len(rows) <= PAGE:
        return [rows]
    own = points[rows]
    a = own[distances(own[:1], own)[0].argmax()]
    from_a = distances(a[None], own)[0]
    b = own[from_a.argmax()]
    order = np.argsort(from_a - distances(b[None], own)[0], kind="stable")
    half = len(rows) // 2
    return split(points, rows[order[:half]]) + split(points, rows[order[half:]])


def medoid(points: np.ndarray) -> int:
    return int(distances(points.mean(axis=0)[None], points)[0].argmin())


def build(region: int, number: int, ids: np.ndarray, vectors: np.ndarray, far: float, top: float) -> tuple:
    """One block: leaf pages with routing objects, covering radii, and distances to the parent's routing object."""
    points = lifted(vectors, top)
    parts = split(points, np.arange(len(ids)))
    order = np.concatenate(parts)
    ids, vectors, points = ids[order], vectors[order], points[order]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    centre = points[medoid(points)]
    heads, radii, spokes = [], [], []
    for lo, hi in zip(starts, starts[1:]):
        head = lo + medoid(points[lo:hi])
        spoke = distances(points[head:head + 1], points[lo:hi])[0]
        heads.append(head)
        radii.append(spoke.max())
        spokes.append(spoke)
    from_centre = distances(centre[None], points)[0]
    return (region, number, far, centre.tobytes(), float(from_centre.max()), len(ids), ids.astype(np.int64).tobytes(), vectors.astype(np.int64).tobytes(),
            starts.astype(np.int64).tobytes(), np.array(heads, np.int64).tobytes(), np.array(radii).tobytes(), from_centre[heads].tobytes(), np.concatenate(spokes).tobytes())


def cut_blocks(dim: int, top: float):
    """Blocks from rows sorted by region and distance to its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        region, ids, vectors, far = None, [], [], 0.0

        def close() -> pa.RecordBatch:
            nonlocal number, ids, vectors, far
            row = build(region, number, np.concatenate(ids), np.concatenate(vectors), far, top)
            number, ids, vectors, far = number + 1, [], [], 0.0
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, BLOCK_TYPES)], BLOCK_NAMES)

        for batch in batches:
            r, d, i, v = batch.column("region").to_numpy(), batch.column("d").to_numpy(), batch.column("vec_id").to_numpy(), matrix(batch.column("v"), dim)
            at = 0
            while at < len(r):
                if ids and r[at] != region:
                    yield close()
                region = int(r[at])
                end = min(int(np.searchsorted(r, region, "right")), at + BLOCK - sum(map(len, ids)))
                ids.append(i[at:end])
                vectors.append(v[at:end])
                far = max(far, float(d[at:end].max()))
                at = end
                if sum(map(len, ids)) == BLOCK:
                    yield close()
        if ids:
            yield close()

    return run


BLOCK_NAMES = [x.split()[0] for x in BLOCKS.split(", ")]
BLOCK_TYPES = [{"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}[x.split()[1]] for x in BLOCKS.split(", ")]


class Queries:
    """A pack of queries: ids, vectors, and for each the distance beyond which nothing can be among its k best."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, reach: np.ndarray):
        self.ids, self.vectors, self.reach = ids, vectors, reach

    @classmethod
    def read(cls, ids, vectors, reach, dim: int) -> Queries:
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int64).reshape(-1, dim), np.frombuffer(reach, np.float64))

    def points(self) -> np.ndarray:
        return np.concatenate([self.vectors.astype(np.float64), np.zeros((len(self.ids), 1))], axis=1)

    def some(self, chosen: np.ndarray) -> tuple[bytes, bytes, bytes]:
        return self.ids[chosen].tobytes(), self.vectors[chosen].tobytes(), self.reach[chosen].tobytes()


def top_k(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k distinct ids with the largest scores, an id by its best one, ties to the smaller id."""
    order = np.lexsort((ids, -scores))
    return order[np.sort(np.unique(ids[order], return_index=True)[1])[:k]]


def by_id(ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The best score of each distinct id, a column each, from columns that belong to ``ids``."""
    order = np.argsort(ids, kind="stable")
    starts = np.unique(ids[order], return_index=True)[1]
    return scores if len(starts) == len(ids) else np.maximum.reduceat(scores[:, order], starts, axis=1)


def search(q: Queries, block: dict, dim: int, k: int, top: float) -> list[tuple[int, int, int]]:
    """Best-first search of one block for each query of a pack: (query id, vec_id, score)."""
    get = lambda name, kind: np.frombuffer(block[name], kind)
    ids, vectors = get("ids", np.int64), get("vectors", np.int64).reshape(-1, dim)
    starts, heads, radii, parents, spokes = get("starts", np.int64), get("heads", np.int64), get("radii", np.float64), get("parents", np.float64), get("spokes", np.float64)
    centres, points = lifted(vectors[heads], top), q.points()
    to_root = distances(get("centre", np.float64)[None], points)[0]
    found = []
    for n, own in enumerate(q.ids):
        reach, vector = q.reach[n], q.vectors[n]
        length = float(vector @ vector) + top
        # stored parent distances rule pages out before their own distance is computed
        left = np.flatnonzero(np.abs(to_root[n] - parents) - radii <= reach + EPS)
        if not len(left):
            continue
        to_head = distances(points[n:n + 1], centres[left])[0]
        least = to_head - radii[left]
        best_s, best_i = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in np.argsort(least, kind="stable"):
            if least[at] > reach + EPS:
                break
            lo, hi = starts[left[at]], starts[left[at] + 1]
            near = lo + np.flatnonzero(np.abs(to_head[at] - spokes[lo:hi]) <= reach + EPS)
            near = near[ids[near] != own]
            if len(near):
                s, i = np.concatenate([best_s, vectors[near] @ vector]), np.concatenate([best_i, ids[near]])
                keep = top_k(s, i, k)
                best_s, best_i = s[keep], i[keep]
                if len(keep) == k:
                    reach = min(reach, float(np.sqrt(max(0.0, length - 2 * float(best_s[-1])))))
        found += [(int(own), int(i), int(s)) for s, i in zip(best_s, best_i)]
    return found


def top_inner_products(rows: DataFrame, k: int = 5, every: int = 50, sample: int = 4096, pivots: int = 64) -> DataFrame:
    """The k rows with the highest integer inner product for each query: query_id, rank, vec_id, score.

    Queries are the rows with vec_id divisible by ``every``, candidates all rows but the query's own.
    With one more component every vector gets the same length, so the order by inner product is the
    order by Euclidean distance, a metric. The tree has four levels: regions around pivots from a
    sample of at most ``sample`` rows, blocks of at most BLOCK rows by distance from the pivot, pages of at
    most PAGE rows, entries. Every node stores its covering radius and every node and entry its distance
    to the parent's routing object. Blocks are rows of a stored table.

    Packs of queries go down by joins on region and block and drop the queries that a covering radius rules out;
    a query's first reach is its k-th best id in the sample. In a block, pages are taken best first,
    and triangle inequalities on stored distances avoid most computations. All bounds are exact, so
    the result is that of a full comparison.

    Of equal vectors the k + 1 smallest ids suffice, so the copies of a frequent vector are cut before the tree by
    rank; no result is lost. Shorter vectors count as filled with zeros. Repeated rows count once; of rows
    that share an id the best score counts. Vectors null or with null or non-finite components and
    null ids take no part; an empty table gives no rows.
    """
    spark = rows.sparkSession
    names = ["query_id", "rank", "vec_id", "score"]
    vectors = store(quantised(rows).distinct(), "vectors")
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda acc, x: acc + x * x)
    dim, longest = vectors.agg(F.max(F.size("v")), F.max(norm)).first()
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top = float(longest)
    same = Window.partitionBy("v").orderBy("vec_id")
    entries = vectors.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1).select("vec_id", "v")
    seen = vectors.orderBy(F.xxhash64("v", "vec_id")).limit(sample).collect()  # at most `sample` rows
    known = np.zeros((len(seen), dim), np.int64)
    for i, r in enumerate(seen):
        known[i, :len(r["v"])] = r["v"]
    known_ids = np.array([r["vec_id"] for r in seen], np.int64)
    centres = lifted(known, top)
    centres = centres[spread(centres, pivots)]

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = distances(lifted(matrix(batch.column("v"), dim), top), centres)
            yield pa.RecordBatch.from_arrays([pa.array(d.argmin(axis=1), pa.int32()), pa.array(d.min(axis=1)), batch.column("vec_id"), batch.column("v")], ["region", "d", "vec_id", "v"])

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = store(
        entries.mapInArrow(regions, "region int, d double, vec_id long, v array<bigint>").repartitionByRange(width, "region", "d")
        .sortWithinPartitions("region", "d").mapInArrow(cut_blocks(dim, top), BLOCKS), "mtree")
    far = {r["region"]: r["far"] for r in blocks.groupBy("region").agg(F.max("far").alias("far")).collect()}  # a row for each pivot

    def to_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, v = batch.column("vec_id").to_numpy(), matrix(batch.column("v"), dim)
            for at in range(0, len(ids), PACK):
                q = Queries(ids[at:at + PACK], v[at:at + PACK], np.full(len(ids[at:at + PACK]), np.inf))
                scores = np.where(known_ids[None, :] == q.ids[:, None], np.iinfo(np.int64).min, q.vectors @ known.T)
                scores = by_id(known_ids, scores)
                if scores.shape[1] > k:  # one of them may be the query itself
                    kth = np.sort(scores, axis=1)[:, -k].astype(np.float64)
                    q.reach = np.where(kth > -1e18, np.sqrt(np.maximum(0.0, (q.vectors * q.vectors).sum(axis=1) + top - 2 * kth)), np.inf)
                d = distances(q.points(), centres)
                out = []
                for region, radius in far.items():
                    chosen = np.flatnonzero(d[:, region] - radius <= q.reach + EPS)
                    if len(chosen):
                        out.append((region, *q.some(chosen)))
                yield packs(out, "region", pa.int32())

    def packs(out: list[tuple], name: str, kind: pa.DataType) -> pa.RecordBatch:
        kinds = (kind, pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], [name, "q_ids", "q_vectors", "q_reach"])

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                q = Queries.read(x["q_ids"], x["q_vectors"], x["q_reach"], dim)
                d = distances(q.points(), np.frombuffer(x["centre"], np.float64)[None])[:, 0]
                chosen = np.flatnonzero(d - x["radius"] <= q.reach + EPS)
                if len(chosen):
                    out.append((x["block"], *q.some(chosen)))
            yield packs(out, "block", pa.int64())

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one block at a time
                x = batch.slice(i, 1).to_pylist()[0]
                found = search(Queries.read(x["q_ids"], x["q_vectors"], x["q_reach"], dim), x, dim, k, top)
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])

    pack = "q_ids binary, q_vectors binary, q_reach binary"
    queries = vectors.filter(F.col("vec_id") % every == 0).mapInArrow(to_regions, f"region int, {pack}")
    roots = blocks.select("region", "block", "centre", "radius")
    at_blocks = queries.join(roots, "region").mapInArrow(to_blocks, f"block long, {pack}")
    found = at_blocks.join(blocks.drop("region", "far", "radius"), "block").mapInArrow(searched, "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(*names)


SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
