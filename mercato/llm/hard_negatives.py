"""Hard-negative mining (operator 12) by Four-Russians scoring.

A component x becomes the integer floor(256 * x); a row's score for an anchor is
their exact integer inner product.  Per anchor the best rows of its label are its positives;
per (anchor, positive) the best rows of other labels whose score lies between two percentages
of the positive's are its negatives.

1. **Bit planes.**  Candidates are dealt by hash into chunks of about ``CHUNK`` rows.  A chunk
   stores its values in two's complement as packed planes: one byte holds one bit of eight
   neighbouring dimensions.
2. **Subset-sum tables.**  Anchors are dealt into blocks of about ``BLOCK``.  For each group of eight
   dimensions a table holds, for all 256 subsets, the sum of each anchor's values.
3. **Scores.**  A candidate's byte indexes the table; the looked-up sums of a plane are
   added over the groups, and planes are joined by doubling (the top one counts negative): the full
   product by look-ups, shifts and additions only.
4. **Units.**  A unit is a (chunk, block) pair: chunks meet blocks in an equi-join on the
   block number, by broadcast if the blocks are at most ``MOST_BROADCAST`` bytes, else by a
   shuffle in which blocks are repeated for slices of the chunks.  First every unit scores rows
   of the anchors' own labels and returns its best few; positives are ranked from those.  Then units score
   the rest against the positives' limits.  Every pair is scored, a unit holds ``CHUNK * BLOCK``
   scores, and a unit's result is at most a few rows per anchor, so a label or a vector that a third of all rows
   share changes no size.

Defined results: rows with a null id or label, a null vector, or a null or non-finite
component take no part, nor do rows with a scaled component beyond ``LARGEST`` (their products could pass 64
bits).  Vectors of unequal length are padded with zeros.  Of rows that share an id
one takes part (the smallest by label, then vector).  Ties go to the smaller id.  Anchors without
positives, and positives without negatives, give no rows; an empty table gives an empty result.
Other columns of the input are not read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, grouped, materialize, spread

SCALE = 256
CHUNK, BLOCK = 4096, 256
POSITIVES, NEGATIVES = 5, 3
LEAST_PERCENT, MOST_PERCENT = 50, 95
LARGEST = 1 << 27
MOST_BROADCAST = 32 << 20
_TILE = 256


def bit_planes(values: np.ndarray) -> np.ndarray:
    """``planes[p, g, row]``: bit p (two's complement, the last plane is the sign) of dimensions 8g to 8g + 7."""
    top = max(int(values.max(initial=0)), ~int(values.min(initial=0))).bit_length() + 1
    return np.stack([np.packbits((values >> p & 1).astype(np.uint8), axis=1, bitorder="little").T
                     for p in range(top)])


def from_planes(planes: np.ndarray, dims: int) -> np.ndarray:
    """The values again, one row each."""
    total = np.zeros((planes.shape[2], dims), np.int64)
    for p in range(len(planes)):
        bits = np.unpackbits(planes[p].T.copy(), axis=1, bitorder="little")[:, :dims].astype(np.int64)
        total += -(bits << p) if p == len(planes) - 1 else bits << p
    return total


def subset_sums(anchors: np.ndarray, dtype: type) -> np.ndarray:
    """``sums[g, subset, anchor]`` over the anchors' values in dimensions 8g to 8g + 7."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((groups * 8, n), dtype)
    padded[:dims] = anchors.T
    sums = np.zeros((groups, 256, n), dtype)
    for g in range(groups):
        for i in range(8):
            sums[g, 1 << i:2 << i] = sums[g, :1 << i] + padded[8 * g + i]
    return sums


def scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """``score[row, anchor]``: exact inner products of anchors with the rows of bit planes."""
    top, groups, n = planes.shape
    bound = int(np.abs(anchors).sum(axis=1).max(initial=0)) << top
    dtype = np.int32 if bound < 1 << 30 else np.int64
    out = np.empty((n, len(anchors)), dtype)
    for a in range(0, len(anchors), _TILE):
        sums = subset_sums(anchors[a:a + _TILE], dtype)
        for r in range(0, n, _TILE):
            part = np.ascontiguousarray(planes[:, :, r:r + _TILE])
            shape = (part.shape[2], sums.shape[2])
            total, plane, looked = np.zeros(shape, dtype), np.empty(shape, dtype), np.empty(shape, dtype)
            for p in range(top - 1, -1, -1):
                plane.fill(0)
                for g in range(min(groups, len(sums))):
                    np.take(sums[g], part[p, g], axis=0, out=looked, mode="clip")
                    plane += looked
                if p == top - 1:
                    np.negative(plane, out=total)
                else:
                    total <<= 1
                    total += plane
            out[r:r + _TILE, a:a + _TILE] = total
    return out


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components of a size that this operator takes."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & (F.abs(x.cast("double") * SCALE) < float(LARGEST)))


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Scaled and floored values, short vectors padded with zeros."""
    vectors = vectors.combine_chunks()
    sizes = np.asarray(vectors.value_lengths())
    flat = np.asarray(vectors.flatten(), np.float64)
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.floor(flat * SCALE).astype(np.int64)
    return out


_CHUNKS = "chunk long, dims int, n_planes int, ids binary, labels binary, asks binary, planes binary"


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in grouped(batches, ["chunk"]):
        chunks = whole.column("chunk").to_numpy()
        cuts = [0, *(np.flatnonzero(chunks[1:] != chunks[:-1]) + 1).tolist(), len(chunks)]
        for i, j in zip(cuts, cuts[1:]):
            part = whole.slice(i, j - i)
            ids = part.column("id").to_numpy()
            first = np.append(True, ids[1:] != ids[:-1])  # sorted by id, label, vector
            part = part.filter(pa.array(first))
            ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
            values = _matrix(part.column("vector"))
            asks = part.column("asks").to_numpy(zero_copy_only=False)
            order = np.lexsort((ids, labels))
            planes = bit_planes(values[order])
            yield pa.RecordBatch.from_pylist([{
                "chunk": int(chunks[i]), "dims": values.shape[1], "n_planes": len(planes),
                "ids": ids[order].tobytes(), "labels": labels[order].tobytes(),
                "asks": asks[order].astype(np.uint8).tobytes(), "planes": planes.tobytes()}],
                pa.schema([("chunk", pa.int64()), ("dims", pa.int32()), ("n_planes", pa.int32()), ("ids", pa.binary()),
                           ("labels", pa.binary()), ("asks", pa.binary()), ("planes", pa.binary())]))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def _planes(row: dict) -> np.ndarray:
    return np.frombuffer(row["planes"], np.uint8).reshape(row["n_planes"], -1, len(row["ids"]) // 8)


def _anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids, labels and values of a chunk's anchors."""
    for row in _rows(batches):
        on = np.flatnonzero(np.frombuffer(row["asks"], np.uint8))
        values = from_planes(_planes(row)[:, :, on], row["dims"])
        yield pa.record_batch([
            pa.array(np.frombuffer(row["ids"], np.int64)[on]), pa.array(np.frombuffer(row["labels"], np.int64)[on]),
            pa.array([v.tobytes() for v in values], pa.binary())], ["id", "label", "vals"])


def _block_values(block: dict) -> np.ndarray:
    rows = [np.frombuffer(a["vals"], np.int64) for a in block["anchors"]]
    out = np.zeros((len(rows), max(map(len, rows))), np.int64)
    for i, values in enumerate(rows):
        out[i, :len(values)] = values
    return out


def _best_of_own_label(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _rows(batches):
            ids, labels = np.frombuffer(unit["ids"], np.int64), np.frombuffer(unit["labels"], np.int64)
            planes, values = _planes(unit), _block_values(unit)
            owners = np.array([a["label"] for a in unit["anchors"]], np.int64)
            found = []
            for label in np.unique(owners):
                i, j = np.searchsorted(labels, [label, label + 1])
                mine = np.flatnonzero(owners == label)
                if i == j:
                    continue
                score = scores(values[mine], planes[:, :, i:j])
                for m, anchor in enumerate(mine.tolist()):
                    own = unit["anchors"][anchor]["id"]
                    best = np.argsort(-score[:, m].astype(np.int64), kind="stable")[:k + 1]  # ids ascend within a label
                    best = best[ids[i:j][best] != own][:k]
                    found.append((np.full(len(best), own), ids[i:j][best], score[best, m].astype(np.int64)))
            if found:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)],
                                      ["anchor_id", "id", "score"])
    return run


def _best_between_limits(k: int, least: int, most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _rows(batches):
            ids, labels = np.frombuffer(unit["ids"], np.int64), np.frombuffer(unit["labels"], np.int64)
            wanted: dict[int, list] = {}
            for p in unit["positives"]:
                low, high = -(-least * p["score"] // 100), most * p["score"] // 100
                if low <= high:
                    wanted.setdefault(p["anchor_id"], []).append((low, high, p["id"], p["score"]))
            asking = [i for i, a in enumerate(unit["anchors"]) if a["id"] in wanted]
            if not asking:
                continue
            score = np.ascontiguousarray(scores(_block_values(unit)[asking], _planes(unit)).T)
            found = []
            for m, i in enumerate(asking):
                anchor, own = unit["anchors"][i], score[m]
                limits = wanted[anchor["id"]]
                near = np.flatnonzero((own >= min(w[0] for w in limits)) & (own <= max(w[1] for w in limits))
                                      & (labels != anchor["label"]))
                near = near[np.lexsort((ids[near], -own[near].astype(np.int64)))]
                falling = -own[near].astype(np.int64)
                for low, high, positive, reached in limits:
                    a, b = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
                    pick = near[a:min(b, a + k)]
                    found += [(anchor["id"], positive, reached, int(ids[c]), int(own[c])) for c in pick]
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)],
                                      ["anchor_id", "positive_id", "positive_score", "id", "score"])
    return run


def _meet(chunks: DataFrame, blocks: DataFrame, n_chunks: int, n_blocks: int, small: bool) -> DataFrame:
    """All units: each chunk with each block."""
    dealt = chunks.drop("asks").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    if small:
        return dealt.join(F.broadcast(blocks), "block")
    slices = spread(n_chunks, 64)
    return (dealt.withColumn("slice", F.pmod("chunk", F.lit(slices)))
            .join(blocks.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))),
                  ["block", "slice"]))


def mine(vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id",
         vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
         least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT, chunk: int = CHUNK, block: int = BLOCK,
         most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    bound_batches(vectors)
    out = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
                          F.coalesce(is_anchor, F.lit(False)).alias("asks"), F.col(f"`{vector_col}`").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    n, asking, dims = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.max(F.size("vector"))).first()
    if not asking:
        return vectors.sparkSession.createDataFrame([], out)
    n_chunks, n_blocks = spread(n, chunk, 1 << 40), spread(asking, block, 1 << 30)
    chunks = (rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(n_chunks)))
              .repartition(min(n_chunks, 100_000), "chunk").sortWithinPartitions("chunk", "id", "label", "vector")
              .mapInArrow(_pack, _CHUNKS))
    chunks = materialize(chunks, "packed-chunks")
    number = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_blocks)).cast("int")
    anchors = chunks.select("ids", "labels", "asks", "planes", "n_planes", "dims").mapInArrow(
        _anchors, "id long, label long, vals binary")
    blocks = materialize(anchors.groupBy(number.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("id", "label", "vals"))).alias("anchors")), "anchor-blocks")
    small = asking * (8 * max(dims, 1) + 64) <= most_broadcast

    by_anchor = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "id")
    units = _meet(chunks, blocks, n_chunks, n_blocks, small)
    best = (units.mapInArrow(_best_of_own_label(positives), "anchor_id long, id long, score long")
            .withColumn("place", F.row_number().over(by_anchor)).filter(F.col("place") <= positives))
    number = F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.lit(n_blocks)).cast("int")
    limits = best.groupBy(number.alias("block")).agg(F.collect_list(F.struct("anchor_id", "id", "score")).alias("positives"))
    armed = materialize(blocks.join(limits, "block"), "positives")

    by_pair = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "id")
    return (_meet(chunks, armed, n_chunks, n_blocks, small)
            .mapInArrow(_best_between_limits(negatives, least_percent, most_percent),
                        "anchor_id long, positive_id long, positive_score long, id long, score long")
            .withColumn("rank", F.row_number().over(by_pair)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
