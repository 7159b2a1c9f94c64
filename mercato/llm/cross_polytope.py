"""Operator 2, approximate nearest neighbours: cross-polytope hashing with multiprobe tables.

A vector's direction is turned by a pseudo-rotation (three rounds of random
signs and a fast Hadamard transform) and hashed to the nearest signed axis.
``TABLES`` tables use different rotations; a query probes the ``PROBES`` axes it is
nearest to in each.  Buckets are also cut by the power of two of the
vector's length and probed at every length, so a long vector is not missed for
its angle.  Candidates are ranked by their exact inner product in double precision.

Equal vectors are one class that is indexed and searched once and keeps its
``NEAREST`` + 1 smallest ids, all that a result can need; the results are
dealt out to the queries afterwards.  A bucket beyond ``CHUNK`` classes is split into
chunks, and one that more than ``QUERY_BLOCK`` queries visit into blocks of queries; each (chunk, block) pair
is a unit of work, so no task holds a bucket whole on either side and nothing is capped.
Queries that find fewer than ``NEAREST`` vectors visit all buckets of one
table, so they miss none.

With one hash per table the buckets grow with the table and the work with its
square over 2 * dimensions; ``tables`` and ``probes`` are parameters.

Edge cases: vectors that are null, empty or zero, or hold a null or non-finite
component take no part, nor do null ids; vectors of different dimensions are
not compared; rows equal in id and vector count once; ties go to the smaller
id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.joins import broadcast_if_small

from .common import bound_batches, grouped, materialize

TABLES = 8
PROBES = 10
NEAREST = 20
CHUNK = 16_384
QUERY_BLOCK = 8192
SEED = 2
MOST_BUCKETS_BROADCAST = 1_000_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row (a power of two long)."""
    n, m = x.shape
    h = 1
    while h < m:
        x = x.reshape(n, m // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, m) / np.sqrt(m)


def rotate(x: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """The pseudo-rotation of one table, of rows padded with zeros to a power of two."""
    n, d = x.shape
    m = 1 << max(0, d - 1).bit_length()
    signs = np.random.default_rng([seed, table, d]).choice([-1.0, 1.0], (3, m))
    y = np.zeros((n, m))
    y[:, :d] = x
    for s in signs:
        y = hadamard(y * s)
    return y


def nearest_axes(x: np.ndarray, table: int, probes: int = 1, seed: int = SEED) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row: 2 * axis, + 1 for its negative end."""
    y = rotate(x / np.linalg.norm(x, axis=1, keepdims=True), table, seed)
    m = y.shape[1]
    both = np.empty((len(y), 2 * m))
    both[:, ::2], both[:, 1::2] = y, -y
    if probes == 1:
        return both.argmax(axis=1)[:, None]
    probes = min(probes, 2 * m)
    return np.argpartition(-both, probes - 1, axis=1)[:, :probes]


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    return flat.astype(np.float64).reshape(n, -1)


def _by_dimension(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.diff(t.column("vector").offsets.to_numpy())
    for d in np.unique(sizes):
        yield t.filter(pa.array(sizes == d)) if (sizes != d).any() else t


_PLACED = "dim int, tab int, axis int, band int, class_id long"


def _place(classes: DataFrame, tables: int, probes: int, bands: list[int] | None, seed: int) -> DataFrame:
    """Each vector at its bucket of every table (``bands`` None), or at every bucket it probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_dimension(batch):
                for a in range(0, len(part), 2048):
                    rows = part.slice(a, 2048)
                    x = _matrix(rows.column("vector"))
                    ids = rows.column("class_id").to_numpy()
                    for table in range(tables):
                        axes = nearest_axes(x, table, probes, seed)
                        if bands is None:
                            band = np.frexp(np.linalg.norm(x, axis=1))[1][:, None]
                        else:
                            axes = np.repeat(axes, len(bands), axis=1)
                            band = np.tile(bands, (len(x), axes.shape[1] // len(bands)))
                        each = axes.shape[1]
                        which = np.repeat(np.arange(len(x)), each)
                        n = len(which)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, x.shape[1], np.int32)), pa.array(np.full(n, table, np.int32)),
                             pa.array(axes.reshape(-1).astype(np.int32)), pa.array(band.reshape(-1).astype(np.int32)),
                             pa.array(ids[which]), rows.column("vector").take(pa.array(which))],
                            ["dim", "tab", "axis", "band", "class_id", "vector"])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("class_id", "vector").mapInArrow(run, f"{_PLACED}, vector {kind}")


def _best(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, point_ids: np.ndarray, k: int):
    """(query, point, score) of the ``k`` best points of each query, ties of the last included."""
    rough = queries @ points.T
    k = min(k, rough.shape[1])
    floor = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
    slack = 1e-9 * (1 + np.abs(floor))
    q, p = np.nonzero(rough >= (floor - slack)[:, None])
    # the exact score is summed the same way whatever else is in the chunk
    return query_ids[q], point_ids[p], (queries[q] * points[p]).sum(axis=1)


_UNIT = ["dim", "tab", "axis", "band", "chunk", "block"]


def _candidates(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_class, class_id, score``: the best classes of every bucket chunk that a query visits."""
    bucket = ["dim", "tab", "axis", "band"]

    def parts(side: DataFrame, size: int, name: str) -> DataFrame:
        return side.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    # buckets that hold points and are visited: how many chunks and blocks each has
    cuts = materialize(parts(points, CHUNK, "chunks").join(parts(queries, QUERY_BLOCK, "blocks"), bucket), "bucket-parts")
    cuts = broadcast_if_small(cuts, MOST_BUCKETS_BROADCAST)

    def numbers(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("class_id", "tab"), F.col(n)).cast("int")

    dealt_points = (points.join(cuts, bucket).withColumn("side", F.lit(0)).withColumn("chunk", own("chunks"))
                    .withColumn("block", numbers("blocks")).drop("chunks", "blocks"))
    dealt_queries = (queries.join(cuts, bucket).withColumn("side", F.lit(1)).withColumn("block", own("blocks"))
                     .withColumn("chunk", numbers("chunks")).drop("chunks", "blocks").select(dealt_points.columns))
    rows = dealt_points.unionByName(dealt_queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, _UNIT, least=1):
            change = np.zeros(len(t), bool)
            for c in _UNIT:
                v = t.column(c).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            at = np.concatenate([[0], np.flatnonzero(change), [len(t)]])
            x, side, ids = _split(t)
            for a, b in zip(at[:-1], at[1:], strict=True):
                m = a + int((side[a:b] == 0).sum())
                if a == m or m == b:
                    continue
                own = x(a, m)
                for c in range(m, b, 512):
                    q, p, s = _best(x(c, min(b, c + 512)), ids[c:min(b, c + 512)], own, ids[a:m], k)
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(p), pa.array(s)],
                                                     ["query_class", "class_id", "score"])

    return (rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT, "side")
            .mapInArrow(run, "query_class long, class_id long, score double").distinct())


def _split(t: pa.Table):
    lists = t.column("vector").combine_chunks()
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)

    def rows(a: int, b: int) -> np.ndarray:
        return flat[ends[a]:ends[b]].astype(np.float64).reshape(b - a, -1)

    return rows, t.column("side").to_numpy(), t.column("class_id").to_numpy()


def _ranked(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """``query_class, hits``: the k + 1 best (score, id) of each query class, best first."""
    # the classes tied with the last one stay too: an id decides between them
    top = found.withColumn("place", F.rank().over(
        Window.partitionBy("query_class").orderBy(F.col("score").desc()))).filter(F.col("place") <= k + 1)
    each = top.join(members, "class_id").select("query_class", "score", F.explode("ids").alias("vec_id"))
    by_rank = Window.partitionBy("query_class").orderBy(F.col("score").desc(), "vec_id")
    return (each.withColumn("place", F.row_number().over(by_rank)).filter(F.col("place") <= k + 1)
            .groupBy("query_class").agg(F.sort_array(F.collect_list(F.struct("place", "score", "vec_id"))).alias("hits")))


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = NEAREST, tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which ``is_query`` holds."""
    bound_batches(vectors)
    vector = F.col(f"`{vector_col}`")
    rows = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
            .filter(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("class_id", F.xxhash64("vector")))
    rows = materialize(rows, "vectors")
    firsts = Window.partitionBy("class_id").orderBy("id")
    least = (rows.select("class_id", "id").withColumn("place", F.dense_rank().over(firsts))
             .filter(F.col("place") <= k + 1))
    members = materialize(least.groupBy("class_id").agg(F.sort_array(F.collect_set("id")).alias("ids")), "class-ids")
    classes = materialize(rows.select("class_id", "vector").dropDuplicates(["class_id"]), "vector-classes")
    asking = rows.filter("asks").select(F.col("id").alias("query_id"), F.col("class_id").alias("query_class")).distinct()
    queries = classes.join(asking.select(F.col("query_class").alias("class_id")).distinct(), "class_id", "left_semi")

    points = materialize(_place(classes, tables, 1, None, seed), "bucket-points")
    bands = [r[0] for r in points.select("band").distinct().orderBy("band").collect()]  # powers of two
    if not bands:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    visits = _place(queries, tables, probes, bands, seed)
    found = materialize(_candidates(points, visits, k + 1), "candidates")
    ranked = materialize(_ranked(found, members, k), "ranked")
    # a query class with too few hits visits every bucket of the first table
    few = queries.join(ranked.filter(F.size("hits") > k).select(F.col("query_class").alias("class_id")), "class_id",
                       "left_anti")
    few = materialize(few, "few-hits")
    if few.limit(1).count():
        wide = _place(few, 1, 1 << 30, bands, seed)
        more = _ranked(_candidates(points.filter("tab = 0"), wide, k + 1), members, k)
        ranked = ranked.join(few, ranked["query_class"] == few["class_id"], "left_anti").unionByName(more)
    hits = asking.join(ranked, "query_class").select("query_id", F.slice(F.filter(
        "hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k).alias("hits"))
    return hits.select("query_id", F.posexplode("hits").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"))
