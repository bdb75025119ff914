"""Nearest neighbours by a block matrix join of int8 tiles with error bounds.

1. Vectors that take part are written with a row id and packed into tiles of
   ``TILE`` rows: their ids, their originals, and, made where they are used,
   int8 codes q = round(127 x / s) of the vectors scaled to length one, s the
   tile's largest component.
2. Every candidate tile is in one group of about ``GROUP`` tiles, and every query
   tile is sent to each group once.  The work is the stated query set against
   all rows, in blocks.  A task takes a group's candidate tiles first, codes them
   once, and then lets the query tiles pass one after another.
3. A pair of tiles gives one product of codes.  With e the largest length of
   x - s q / 127 in a tile (at most s sqrt(d) / 254), the true cosine is within
   e1 + e2 + e1 e2 of it.  A candidate survives if its upper bound reaches the
   k-th largest lower bound of its tile and the k-th best score that the query
   has so far among the group's tiles.  Survivors are recomputed from the
   original vectors in double precision and kept in a heap a query.  So every
   neighbour is exact, and the recall is 1.
4. The k best of each group are merged with heaps, by query: at most groups * k
   rows a query.

Score: the dot product over the root of the product of the squared lengths, each
summed in order in double precision.  Ties go to the smaller vec_id.

Nulls, ties, emptiness: a vector that is null, empty, zero, or holds a null or
a non-finite component takes no part, neither does a row with a null vec_id;
vectors of different lengths are never compared; rows with an equal vec_id are
rows of their own, each a query if the id is one, and candidates of each other;
fewer candidates than k give all of them; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.llm import common

K = 5
EVERY = 50
#: Rows of a tile, at most.
TILE = 2048
#: Tiles of candidates that meet the queries in one task, about.
GROUP = 8

TILES = pa.schema([("grp", pa.int64()), ("dim", pa.int32()), ("rows", pa.binary()), ("ids", pa.binary()),
                   ("vectors", pa.binary())])
NEAR = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def usable(vector: str = "embedding") -> Column:
    """Whether a vector takes part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def vectors(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """row_id, vec_id and v (array<double>) of the rows that take part, written,
    so that a row keeps its number."""
    return common.written(
        table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        .filter(F.col("vec_id").isNotNull() & usable("v"))
        .select(F.monotonically_increasing_id().alias("row_id"), "vec_id", "v"), "vectors")


def tiles(rows: DataFrame, groups: int) -> DataFrame:
    """Packed tiles: grp, dim, rows and ids (int64 bytes), vectors (float64 bytes)."""
    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[int, int, list[float]]]] = {}

        def tile(key: tuple[int, int]) -> tuple:
            some = held.pop(key)
            return (*key, *(np.array([x[i] for x in some], t).tobytes() for i, t in enumerate(("<i8", "<i8", "<f8"))))

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), TILES)], schema=TILES)

        for batch in parts:
            made = []
            for g, r, i, v in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault((g, len(v)), []).append((r, i, v))
                if len(held[g, len(v)]) == TILE:
                    made.append(tile((g, len(v))))
            if made:
                yield batch_of(made)
        if held:
            yield batch_of([tile(k) for k in list(held)])

    dealt = rows.select(F.pmod(F.xxhash64("row_id"), F.lit(groups)).alias("grp"), "row_id", "vec_id", "v")
    if groups > 1:
        dealt = dealt.repartition(groups, "grp")  # a group's rows together, so that tiles are full
    return dealt.mapInArrow(pack, "grp long, dim int, rows binary, ids binary, vectors binary")


class Tile:
    """A tile's vectors: originals, unit vectors' int8 codes, scale, largest code error."""

    def __init__(self, dim: int, rows: bytes, ids: bytes, data: bytes) -> None:
        self.rows, self.ids = np.frombuffer(rows, "<i8"), np.frombuffer(ids, "<i8")
        self.v = np.frombuffer(data, "<f8").reshape(-1, dim)
        # scaled first, so that neither very large nor very small components leave the doubles
        unit = self.v / np.abs(self.v).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        self.scale = float(np.abs(unit).max()) / 127
        self.code = np.rint(unit / self.scale).astype(np.int8)
        off = unit - self.code * self.scale
        self.error = float(np.sqrt((off * off).sum(axis=1)).max()) + 1e-12

    def cosines(self, other: "Tile") -> tuple[np.ndarray, float]:
        """(cosines from the codes, largest error of one)."""
        # float32 holds products of int8 codes exactly up to 2^24, that is 1,040 components
        kind = np.float32 if self.code.shape[1] <= 1024 else np.float64
        product = self.code.astype(kind) @ other.code.astype(kind).T
        bound = self.error + other.error + self.error * other.error + 1e-9
        return product.astype(np.float64) * (self.scale * other.scale), bound


def exact(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine in double precision, sums in order."""
    dot = aa = bb = 0.0
    for x, y in zip(a.tolist(), b.tolist()):
        dot += x * y
        aa += x * x
        bb += y * y
    if not (1e-280 < aa < 1e280 and 1e-280 < bb < 1e280):
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        dot, aa, bb = float(a @ b), float(a @ a), float(b @ b)
        return max(-1.0, min(1.0, dot / (aa ** 0.5 * bb ** 0.5)))
    return max(-1.0, min(1.0, dot / (aa * bb) ** 0.5))


class Best:
    """The k best (score, smaller id first) of each query, in heaps."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.heaps = k, [[] for _ in range(n)]

    def add(self, query: int, score: float, vec_id: int) -> None:
        heap, item = self.heaps[query], (score, -vec_id)
        if len(heap) < self.k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)

    def floor(self) -> np.ndarray:
        return np.array([h[0][0] if len(h) == self.k else -2.0 for h in self.heaps])


def join_tiles(queries: Tile, others: list[Tile], k: int) -> Iterator[tuple[int, int, int, float]]:
    """(query's row, query id, vec_id, score) of the k best among some tiles."""
    best = Best(len(queries.ids), k)
    for tile in others:
        cos, bound = queries.cosines(tile)
        cos[queries.rows[:, None] == tile.rows[None, :]] = -4.0
        floor = best.floor()
        if cos.shape[1] > k:
            kth = np.partition(cos, cos.shape[1] - k, axis=1)[:, cos.shape[1] - k] - bound
            floor = np.maximum(floor, kth)
        for q, c in zip(*(x.tolist() for x in np.nonzero((cos + bound >= floor[:, None]) & (cos > -3.0)))):
            best.add(q, exact(queries.v[q], tile.v[c]), int(tile.ids[c]))
    for row, q, heap in zip(queries.rows.tolist(), queries.ids.tolist(), best.heaps):
        for score, negative in heap:
            yield row, q, -negative, score


def nearest(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score.  Both tables have the columns of ``vectors``;
    a row is no candidate of itself."""
    groups = max(1, -(-candidates.count() // (TILE * GROUP)))
    base = tiles(candidates, groups).withColumn("asks", F.lit(False))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp")
    asked = tiles(queries, 1).drop("grp").select(every, "dim", "rows", "ids", "vectors", F.lit(True).alias("asks"))

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}
        for batch in parts:
            for at in range(batch.num_rows):
                grp, dim, rows, ids, v, asks = (c[at].as_py() for c in batch.columns)
                if grp != group:
                    group, held = grp, {}
                if not asks:
                    held.setdefault(dim, []).append(Tile(dim, rows, ids, v))
                    continue
                found = list(join_tiles(Tile(dim, rows, ids, v), held.get(dim, []), k))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), NEAR)],
                                                     schema=NEAR)

    # a fixed number of tasks: AQE would merge them by the size of what they read, which is small beside their work
    dealt = base.unionByName(asked).repartition(2 * groups, "grp").sortWithinPartitions("grp", "asks")
    near = dealt.select("grp", "dim", "rows", "ids", "vectors", "asks").mapInArrow(
        compare, "query_row long, query_id long, vec_id long, score double")
    return merged(near, k)


def merged(near: DataFrame, k: int) -> DataFrame:
    """The k best of each query row's rows (k a group), with heaps."""
    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for batch in parts:
            for row, q, v, s in zip(*(c.to_pylist() for c in batch.columns)):
                heap = heaps.setdefault((row, q), [])
                if len(heap) < k:
                    heapq.heappush(heap, (s, -v))
                else:
                    heapq.heappushpop(heap, (s, -v))
        rows = [(q, r, -v, s) for (_, q), heap in heaps.items()
                for r, (s, v) in enumerate(sorted(heap, reverse=True), 1)]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        for lo in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo:lo + 50_000]), kinds)],
                                             names=["query_id", "rank", "vec_id", "score"])

    return near.repartition("query_row").mapInArrow(merge, "query_id long, rank int, vec_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vectors(common.read(spark, sf_dir, "embeddings"))
    return nearest(v.filter(F.col("vec_id") % EVERY == 0), v)


SQL = f"""
WITH v AS (SELECT row_number() OVER () AS row_id, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.row_id, q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM v q JOIN v c ON q.row_id <> c.row_id AND len(q.v) = len(c.v) WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id))::INT AS rank FROM p)
WHERE rank <= {K}
"""
