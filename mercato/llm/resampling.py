"""Operator 1, quality classifier: importance resampling with hashed n-gram models.

A text's features are its hashed word and word-pair tokens (runs of letters and
digits, runs of other signs; white space only separates); a pair that repeats a
token, or the pair before the last, is the same feature whatever it repeats.  Two bag-of-n-grams
models over ``BUCKETS`` buckets are estimated in one pass: *raw* from all
documents, *target* from at most ``TARGET_DOCS`` documents labelled good and not
toxic (those with the smallest hash, a documented bound).  A document's log
importance weight is the sum over its features of log p_target - log p_raw.

The weight is judged against the length: the level is a weight per n-gram (with
``PSEUDO`` n-grams of weight 0 added, so few n-grams prove little) that all but
``MISSED`` of other labelled good documents reach (at most ``LEVEL_DOCS`` of them), less
``SLACK``.  *Toxic terms* are the n-grams, told apart by 64 bits, that at least
``TERM_DOCS`` documents labelled toxic (of at most ``TARGET_DOCS``) hold and that are ``TERM_ODDS`` nats more
likely in them than in the target's; a text whose terms' log odds exceed what all but ``MISSED`` of
the good documents stay within is as far under the level as they exceed it.

Documents are resampled without replacement by Gumbel top-k: what the weight is above
the level, in nats, plus Gumbel noise from a hash of the document, the k largest are
kept.  k is the number of documents, over all rows, that reach the level.

Weights are sums of fixed-point integers, so they do not depend on batches or
partitions.  The k-th largest key is found by counting keys in ranges, never by
a sort of all rows or one task; the final pass compares each row with it.

Edge cases: a null or blank text has no features, weight 0 and no toxic terms; ids may be null
or repeated; rows with equal keys (as equal rows have) are kept or dropped
together; without usable labels, or without rows, every row is kept,
and without enough toxic labels there are no toxic terms; columns beside the named ones stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, bound_batches, materialize, mix64, pieces, text_bytes

BUCKETS = 1 << 14
TARGET_DOCS = 5000
LEVEL_DOCS = 5000
MISSED = 0.001
SLACK = 0.1  # per n-gram
PSEUDO = 16
TERM_DOCS = 8
TERM_ODDS = 2.5
MOST_TERMS = 4096
SMOOTHING = 1.0
SEED = 1
UNIT = 1 << 20
RANGES = 4096

_KIND = np.full(256, 2, np.uint8)  # other signs
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1

_REPEAT = np.uint64(1)


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams (tokens, then pairs of neighbours) and the row each belongs to."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kind = _KIND[data]
    cut = np.zeros(n + 1, bool)
    cut[1:n] = kind[1:] != kind[:-1]
    cut[offsets] = True
    cut[[0, n]] = True
    at = np.flatnonzero(cut)
    starts, stops = at[:-1], at[1:]
    word = kind[starts] > 0
    starts, stops = starts[word], stops[word]
    rows = np.searchsorted(offsets, starts, "right") - 1
    tokens = Rolling(data).of(starts, stops)
    pair = rows[1:] == rows[:-1]
    pairs = mix64(tokens[:-1] * np.uint64(3) + tokens[1:])
    again = tokens[1:] == tokens[:-1]
    again[2:] |= (pairs[2:] == pairs[:-2]) & (rows[3:] == rows[:-3])
    pairs[again] = _REPEAT
    return np.concatenate([tokens, pairs[pair]]), np.concatenate([rows, rows[1:][pair]])


def ngram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams and the row each belongs to."""
    both, rows = ngrams(data, offsets)
    return (both % np.uint64(BUCKETS)).astype(np.int64), rows


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.lit(SEED), text).alias("text_hash"),
                       text.alias("text"))


def labelled_sample(labels: DataFrame, n: int, id_col: str = "doc_id", toxic: bool = False) -> list[int]:
    """Ids of ``n`` documents labelled good and not toxic, or labelled toxic, in the order of a hash."""
    is_toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    chosen = labels.filter((is_toxic if toxic else (F.col("quality") == 1) & ~is_toxic) & F.col(id_col).isNotNull())
    rows = (chosen.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.lit(SEED), F.col(id_col)).alias("h"))
            .distinct().orderBy("h", "id").limit(n).collect())
    return [r["id"] for r in rows]


def fit(docs: DataFrame, target_ids: list[int], id_col: str = "doc_id", text_col: str = "text") -> np.ndarray | None:
    """Fixed-point log ratio of each bucket; raw counts cover all rows of ``docs``."""
    known = np.sort(np.array(target_ids, np.int64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in pieces(batches, "text"):
            buckets, rows = ngram_buckets(*text_bytes(batch.column(1)))
            ids = batch.column(0)
            chosen = np.isin(ids.fill_null(0).to_numpy(), known) & ids.is_valid().to_numpy(zero_copy_only=False)
            raw += np.bincount(buckets, minlength=BUCKETS)
            target += np.bincount(buckets[chosen[rows]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
                                         ["bucket", "raw", "target"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counted = (rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket")
               .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())  # at most BUCKETS rows
    if not len(counted) or not counted["target"].sum():
        return None
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counted["bucket"]] = counted["raw"]
    target[counted["bucket"]] = counted["target"]
    p = (target + SMOOTHING) / (target + SMOOTHING).sum()
    q = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    return np.round(np.log(p / q) * UNIT).astype(np.int64)


def toxic_terms(docs: DataFrame, good_ids: list[int], toxic_ids: list[int], id_col: str = "doc_id",
                text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the toxic terms (sorted) and their fixed-point log odds, from the documents of these ids."""
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    toxic_ids = sorted(set(toxic_ids) - set(good_ids))
    if len(toxic_ids) < TERM_DOCS:
        return nothing
    known = np.array(toxic_ids, np.int64)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).filter(
        F.col("id").isin(good_ids + toxic_ids))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, of = ngrams(*text_bytes(batch.column(1)))
            order = np.lexsort((of, hashes))
            hashes, of = hashes[order], of[order]
            first = np.ones(len(of), bool)
            first[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
            toxic = np.isin(batch.column(0).to_numpy(), known)[of[first]]
            held, which = np.unique(hashes[first], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(held.view(np.int64)), pa.array(np.bincount(which[~toxic], minlength=len(held))),
                 pa.array(np.bincount(which[toxic], minlength=len(held)))], ["term", "good", "toxic"])

    totals = {r["toxic"]: r["n"] for r in rows.groupBy(F.col("id").isin(toxic_ids).alias("toxic")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    odds = (F.log((F.col("toxic") + 1) / float(totals.get(True, 0) + 2))
            - F.log((F.col("good") + 1) / float(totals.get(False, 0) + 2)))
    found = (rows.mapInArrow(count, "term long, good long, toxic long").groupBy("term")
             .agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= TERM_DOCS)
             .select("term", F.round(odds * UNIT).cast("long").alias("odds")).filter(F.col("odds") >= int(TERM_ODDS * UNIT))
             .orderBy(F.col("odds").desc(), "term").limit(MOST_TERMS).collect())
    if not found:
        return nothing
    terms, weight = np.array([r["term"] for r in found], np.int64).view(np.uint64), np.array([r["odds"] for r in found])
    order = np.argsort(terms)
    return terms[order], weight[order]


def _scores(model: np.ndarray, terms: tuple[np.ndarray, np.ndarray], data: np.ndarray, offsets: np.ndarray):
    """The weight, the number of n-grams and the log odds of the distinct toxic terms of each row."""
    hashes, rows = ngrams(data, offsets)
    n = len(offsets) - 1
    weight, toxic = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(weight, rows, model[(hashes % np.uint64(BUCKETS)).astype(np.int64)])
    known, odds = terms
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[at] == hashes
        pairs = np.unique(rows[hit] * len(known) + at[hit])
        np.add.at(toxic, pairs // len(known), odds[pairs % len(known)])
    return weight, np.bincount(rows, minlength=n), toxic


def _noise(ids: np.ndarray, text_hash: np.ndarray) -> np.ndarray:
    """Gumbel noise in fixed point, a function of id and text."""
    bits = mix64(mix64(ids.astype(np.uint64) + np.uint64(SEED)) ^ text_hash.astype(np.uint64)) >> np.uint64(11)
    u = (bits.astype(np.float64) + 0.5) / float(1 << 53)
    return np.round(-np.log(-np.log(u)) * UNIT).astype(np.int64)


def score(docs: DataFrame, model: np.ndarray, terms: tuple[np.ndarray, np.ndarray], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id, text_hash, weight, n, toxic, noise`` of every row; all but ``n`` in units of 1 / ``UNIT``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = _scores(model, terms, *text_bytes(batch.column(2)))
            noise = _noise(batch.column(0).fill_null(-1).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, found), pa.array(noise)],
                                             ["id", "text_hash", "weight", "n", "toxic", "noise"])

    return _hashed(docs, id_col, text_col).mapInArrow(
        run, "id long, text_hash long, weight long, n long, toxic long, noise long")


def level(scores: DataFrame, ids: list[int]) -> tuple[int, int] | None:
    """The weight per n-gram, less ``SLACK``, and the toxic log odds that all but ``MISSED`` of the given documents keep to."""
    if not ids:
        return None
    held = (scores.filter(F.col("id").isin(ids)).groupBy("id")
            .agg(F.min(F.col("weight") / (F.col("n") + PSEUDO)).alias("w"), F.max("toxic").alias("toxic"))
            .collect())  # at most LEVEL_DOCS rows
    if not held:
        return None
    at = int(MISSED * len(held))
    return int(np.sort([r["w"] for r in held])[at] - SLACK * UNIT), int(np.sort([-r["toxic"] for r in held])[at] * -1)


def above(weight, n, toxic, least: tuple[int, int], when, lower):
    """What a row's weight is above the level of its length, in fixed point; below 0 if its toxic terms exceed theirs."""
    margin = weight - least[0] * (n + PSEUDO)
    return when(toxic > least[1], lower(margin, least[1] - toxic), margin)


def kth_largest(scores: DataFrame, k: int) -> int:
    """The k-th largest key: keys are counted in ``RANGES`` equal ranges, then in the range that holds it, and so on."""
    low, high = scores.agg(F.min("key"), F.max("key")).first()
    above = 0
    while low < high:
        width = (high - low) // RANGES + 1
        counts = (scores.filter(F.col("key").between(low, high)).groupBy(F.expr(f"(key - ({low}L)) div {width}L")
                  .alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # at most RANGES rows
        for part, n in sorted(((r["part"], r["n"]) for r in counts), reverse=True):
            if above + n >= k:
                low, high = low + part * width, min(high, low + (part + 1) * width - 1)
                break
            above += n
        else:
            raise ValueError(f"fewer than {k} rows")
    return low


def _cut(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str):
    """The model and terms, the scores, the level and the smallest key that is kept; None without usable labels or rows."""
    bound_batches(docs)
    ids = labelled_sample(labels, TARGET_DOCS + LEVEL_DOCS)
    # one in two fits the target model, the others set the level
    model = fit(docs, ids[::2], id_col, text_col)
    if model is None:
        return None
    terms = toxic_terms(docs, ids[::2], labelled_sample(labels, TARGET_DOCS, toxic=True), id_col, text_col)
    scores = materialize(score(docs, model, terms, id_col, text_col), "importance-weights")
    least = level(scores, ids[1::2])
    if least is None:
        return None
    margin = above(F.col("weight"), F.col("n"), F.col("toxic"), least, lambda c, a, b: F.when(c, a).otherwise(b), F.least)
    keys = scores.select("id", margin.alias("weight"), (margin + F.col("noise")).alias("key"))
    k = keys.filter(F.col("weight") >= 0).count()
    return ((model, terms), keys, least, kth_largest(keys, k)) if k else None


def resample_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, weight, noisy_weight`` (in nats above the level) of every document that the resampling keeps."""
    cut = _cut(docs, labels, id_col, text_col)
    if cut is None:
        return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.lit(0.0).alias("weight"),
                           F.lit(0.0).alias("noisy_weight"))
    _, keys, _, last = cut
    return keys.filter(F.col("key") >= last).select(
        F.col("id").alias("doc_id"), (F.col("weight") / float(UNIT)).alias("weight"),
        (F.col("key") / float(UNIT)).alias("noisy_weight"))


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the resampling keeps, with all their columns."""
    cut = _cut(docs, labels, id_col, text_col)
    if cut is None:
        return docs
    (model, terms), _, least, last = cut
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.xxhash64(F.lit(SEED), text).alias("text_hash"), text.alias("text"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("doc"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            margin = above(*_scores(model, terms, *text_bytes(batch.column(2))), least, np.where, np.minimum)
            key = margin + _noise(batch.column(0).fill_null(-1).to_numpy(), batch.column(1).to_numpy())
            yield batch.select([2, 3]).filter(pa.array(key >= last))

    kept = rows.mapInArrow(keep, T.StructType([rows.schema["text"], rows.schema["doc"]]))
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col("doc").getField(c).alias(c)
                         for c in docs.columns])
