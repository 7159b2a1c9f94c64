"""Operator 6, suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that occurs elsewhere.

Only suffixes at *anchors* are sorted.  Each window of ``LENGTH`` bytes has one
anchor, the leftmost place in it whose following ``GRAM`` bytes have the smallest hash; it
depends on the window's content alone, so equal windows have equal anchors at
equal offsets.  Neighbouring windows mostly share an anchor: texts have about
2 / (LENGTH - GRAM) anchors a byte.

1. One pass emits the anchors: hash of the gram, hash of all bytes their windows
   cover (their *context*), place.  Equal contexts are summed up before and after
   the shuffle.  Contexts that occur twice repeat in all their windows.
2. Grams that occur with several contexts, one of them single, are looked at
   more closely: the contexts' bytes are fetched and sorted by deep-shallow
   sorting, both from the anchor on and backwards from it, which gives two
   arrays of longest common prefixes.  A window with d bytes before its anchor
   repeats if another context agrees in the d bytes before and the LENGTH - d after:
   if both lie in one run of either order.
3. Windows become spans, spans meet their text, and covered bytes go.

Beside the bytes, ``n_repeated_marks`` tells which documents share passages that may be shorter: every run of ``MARK_RUN``
words has a *mark*, its run of ``MARK`` words with the smallest hash, so equal runs have equal marks.  A document
without a mark that stands elsewhere shares no run of ``MARK_RUN`` words (A-Z lower-cased); one with such a
mark shares at least ``MARK`` words.

A gram with more than ``GROUP`` contexts is cut into blocks, and each pair of
blocks is a unit of work, so no task holds a hot group whole.

Edge cases: a null or empty text has no bytes; texts shorter than LENGTH keep
all; rows equal in id and text repeat each other like any two texts; null ids
keep their rows; texts of any length are used whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.joins import broadcast_if_small

from .common import Rolling, bound_batches, grouped, materialize, mix64, pieces, text_bytes
from .deep_shallow import common_prefix, deep_shallow_order
from .shingles import word_hashes

LENGTH = 400
GRAM = 160
GROUP = 8192
MOST_BROADCAST = 300_000
MARK, MARK_RUN = 20, 51
_PLACE_BITS = 12  # of a context's bytes before its anchor, and of its windows; both below LENGTH


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, anchor, first window, last window, gram hash, context hash) of every anchor; places in ``data``."""
    n, width = len(data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none, none
    rolling = Rolling(data)
    grams = rolling.windows(gram)
    # the hash's upper half decides, then the place: equal hashes go to the leftmost
    low = least_of_runs((grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64), width)
    inside = np.zeros(n + 1, np.int64)
    sizes = np.diff(offsets)
    long = sizes >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside[:n]))
    if not len(windows):
        return none, none, none, none, none, none
    at = (low[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    lo, hi, place = windows[first], windows[np.append(first[1:], len(at)) - 1], at[first]
    shape = ((place - lo) * length + (hi - lo)).astype(np.uint64)
    context = mix64(rolling.of(lo, hi + length) + mix64(shape))
    return np.searchsorted(offsets, lo, "right") - 1, place, lo, hi, grams[place].view(np.int64), context.view(np.int64)


def least_of_runs(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring keys."""
    low, step = keys, 1
    while 2 * step <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    return np.minimum(low[:len(low) - (width - step)], low[width - step:]) if width > step else low


def marks(data: np.ndarray, offsets: np.ndarray, mark: int = MARK, run: int = MARK_RUN) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every place that is the mark of some run of words in its text."""
    hashes, first = word_hashes(data, offsets)
    if len(hashes) < run:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = Rolling(hashes).windows(mark)
    # the upper half decides, then the place
    keys = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    low = least_of_runs(keys, run - mark + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    inside = row[:len(low)] == row[run - 1:run - 1 + len(low)]  # runs of one text
    at = np.unique((low[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64))
    return row[at], grams[at].view(np.int64)


def _key(id_col: str, text_col: str):
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, doc``: both joins of texts by their key start from this, so that Spark shuffles the texts once."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       _key(id_col, text_col).alias("doc"))


def anchor_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``gram, context, doc, place, before, windows``; places in bytes, relative to the first window."""
    rows = docs.select(_key(id_col, text_col).alias("doc"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4 << 20):
            data, offsets = text_bytes(batch.column(1))
            row, place, lo, hi, gram, context = anchors(data, offsets)
            doc = batch.column(0).to_numpy()[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram), pa.array(context), pa.array(doc), pa.array((lo - offsets[row]).astype(np.int64)),
                 pa.array((place - lo).astype(np.int32)), pa.array((hi - lo + 1).astype(np.int32))],
                ["gram", "context", "doc", "first", "before", "windows"])

    return rows.mapInArrow(run, "gram long, context long, doc long, first long, before int, windows int")


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal contexts of a batch summed up (``n``, and the least of their places), so that a hot one is few rows."""
    for batch in batches:
        gram, context, doc, first, before, windows = (batch.column(i).to_numpy() for i in range(6))
        # one number for the place, as these rows are shuffled
        place = first << 2 * _PLACE_BITS | before.astype(np.int64) << _PLACE_BITS | windows
        cols = [gram, context, doc, place]
        order = np.lexsort((place, doc, context, gram))
        gram, context = cols[0][order], cols[1][order]
        new = np.append(True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1]))[:len(order)]
        firsts = np.flatnonzero(new)
        n = np.diff(np.append(firsts, len(order)))
        yield pa.RecordBatch.from_arrays([*(pa.array(c[order][firsts]) for c in cols), pa.array(n)],
                                         ["gram", "context", "doc", "place", "n"])


def _unpacked(place: str) -> list[Column]:
    part = F.lit((1 << _PLACE_BITS) - 1)
    return [F.shiftright(place, 2 * _PLACE_BITS).alias("first"),
            F.shiftright(place, _PLACE_BITS).bitwiseAND(part).cast("int").alias("before"),
            F.col(place).bitwiseAND(part).cast("int").alias("windows")]


def repeated_marks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, n_repeated_marks`` of the documents (by their key) with marks that stand elsewhere too."""
    rows = docs.select(_key(id_col, text_col).alias("doc"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            row, mark = marks(*text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays([pa.array(mark), pa.array(batch.column(0).to_numpy()[row])], ["mark", "doc"])

    # found twice rather than written: the texts cost less to read again than the marks to keep
    found = rows.mapInArrow(run, "mark long, doc long")
    often = materialize(found.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark"),
                        "repeated-marks")
    # both sides are plain shuffles, so a mark that many documents share is split by AQE's skew join
    return found.join(often, "mark", "left_semi").groupBy("doc").agg(F.count(F.lit(1)).alias("n_repeated_marks"))


def context_bytes(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``gram, context, before, windows, bytes`` of every wanted context, from the text of one document that has it."""
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "context", "first", "before", "windows"))
                                        .alias("items")).withColumnRenamed("doc", "of")
    rows = _keyed(docs, id_col, text_col)
    rows = rows.join(per_doc, rows["doc"] == per_doc["of"]).select("text", "items", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = [[], [], [], [], []]
            for text, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode()
                for x in items:
                    for column, value in zip(out, (x["gram"], x["context"], x["before"], x["windows"],
                                                   raw[x["first"]:x["first"] + x["windows"] - 1 + LENGTH]), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                             ["gram", "context", "before", "windows", "bytes"])

    return rows.mapInArrow(run, "gram long, context long, before int, windows int, bytes binary")


def _sorted_prefixes(strings: list[bytes], groups: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in deep-shallow order, group by group, and each one's common prefix with the one before (-1: new group)."""
    order, common = [], []
    cuts = np.concatenate([[0], np.flatnonzero(groups[1:] != groups[:-1]) + 1, [len(groups)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        own = strings[a:b]
        sorted_ = deep_shallow_order(own, depth)
        order += [a + p for p in sorted_]
        common.append(-1)
        common += [common_prefix(own[p], own[q]) for p, q in zip(sorted_, sorted_[1:], strict=False)]
    return np.array(order), np.array(common)


def repeated_windows(groups: np.ndarray, contexts: list[bytes], before: np.ndarray, windows: np.ndarray,
                     block: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """For each context which of its windows another context of its group has too.

    Groups follow one another.  Where a group has members of two blocks, only
    members of different blocks are held against each other.
    """
    n = len(contexts)
    right = [c[a:] for c, a in zip(contexts, before, strict=True)]
    left = [c[:a][::-1] for c, a in zip(contexts, before, strict=True)]
    right_order, right_common = _sorted_prefixes(right, groups, gram)
    left_order, left_common = _sorted_prefixes(left, groups, 0)
    after = np.array([len(r) for r in right])
    found = np.zeros((n, int(before.max()) + 1), bool)
    run = np.zeros(n, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(groups[1:] != groups[:-1]) + 1])
    which = np.cumsum(np.isin(np.arange(n), starts)) - 1
    crossing = (np.maximum.reduceat(block, starts) != np.minimum.reduceat(block, starts))[which]
    for d in range(found.shape[1]):
        # contexts that agree in the bytes after, and those that agree in the bytes before, lie in runs
        run[right_order] = np.cumsum(right_common < length - d)
        both = run * (n + 1)
        run[left_order] = np.cumsum(left_common < d)
        both += run
        has = np.flatnonzero((before >= d) & (before - d < windows) & (after >= length - d))
        _, inverse, count = np.unique(both[has], return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        if crossing.any():
            least, most = np.full(len(count), 1 << 60), np.full(len(count), -1)
            np.minimum.at(least, inverse, block[has])
            np.maximum.at(most, inverse, block[has])
            twice &= ~crossing[has] | (least != most)[inverse]
        found[has[twice], d] = True
    return [found[i, max(0, before[i] - windows[i] + 1):before[i] + 1][::-1] for i in range(n)]


def group_spans(t: pa.Table) -> pa.RecordBatch:
    """``context, gram, at, n``: runs of repeated windows, from the first window of their context."""
    keys = [t.column(c).to_numpy() for c in ("gram", "i", "j")]
    change = np.zeros(len(t), np.int64)
    for v in keys:
        change[1:] |= v[1:] != v[:-1]
    groups = np.cumsum(change)
    contexts = t.column("bytes").to_pylist()
    before, windows = t.column("before").to_numpy(), t.column("windows").to_numpy()
    hits = repeated_windows(groups, contexts, before, windows, t.column("block").to_numpy())
    gram, context = keys[0], t.column("context").to_numpy()
    out = [[], [], [], []]
    for i, hit in enumerate(hits):
        if hit.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                for column, value in zip(out, (gram[i], context[i], a, b - a), strict=True):
                    column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["gram", "context", "at", "n"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, start, stop``: bytes of each document (by its key) that repeated windows cover; spans may overlap."""
    found = materialize(anchor_rows(docs, id_col, text_col), "anchors")
    one = F.struct("doc", "place")
    # one shuffle, by gram, serves both groupings; grams that occur once are most of all and go before anything is written
    dealt = found.mapInArrow(_combined, "gram long, context long, doc long, place long, n long").repartition("gram")
    repeats = (dealt.groupBy("gram", "context").agg(F.sum("n").alias("n"), F.min(one).alias("one"))
               .withColumn("occurs", F.sum("n").over(Window.partitionBy("gram"))).filter("occurs > 1").drop("occurs"))
    contexts = materialize(repeats, "contexts")
    # several contexts, one of them single: its windows may repeat in the others
    grams = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least"))
    open_grams = materialize(grams.filter("contexts > 1 AND least = 1").select(
        F.col("gram").alias("open_gram"), F.ceil(F.col("contexts") / GROUP).cast("int").alias("blocks")), "open-grams")
    small = broadcast_if_small(open_grams, MOST_BROADCAST)
    wanted = materialize(contexts.join(small, contexts["gram"] == small["open_gram"]).select(
        "gram", "context", "n", "blocks", "one.doc", *_unpacked("one.place")), "open-contexts")
    raw = context_bytes(docs, wanted.select("gram", "context", "doc", "first", "before", "windows"), id_col, text_col)
    blocks = raw.join(small, raw["gram"] == small["open_gram"]).drop("open_gram").withColumn(
        "block", F.pmod(F.xxhash64("context"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    dealt = blocks.withColumn("unit", F.explode(pairs)).select(
        "gram", "unit.i", "unit.j", "block", "context", "before", "windows", "bytes").dropDuplicates(
        ["gram", "i", "j", "context"])
    keys = ["gram", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, keys):
            yield group_spans(t)

    runs = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        run, "gram long, context long, at long, n long")
    runs = runs.withColumnsRenamed({"gram": "run_gram", "context": "run_context", "n": "run"})
    single = wanted.filter("n = 1").join(runs, (wanted["gram"] == runs["run_gram"])
                                         & (wanted["context"] == runs["run_context"])).select(
        "doc", (F.col("first") + F.col("at")).alias("start"),
        (F.col("first") + F.col("at") + F.col("run") - 1 + LENGTH).alias("stop"))
    often = contexts.filter("n > 1").select(F.col("gram").alias("often_gram"), F.col("context").alias("often"))
    often = broadcast_if_small(often, MOST_BROADCAST)
    whole = found.join(often, (found["gram"] == often["often_gram"]) & (found["context"] == often["often"])).select(
        "doc", F.col("first").alias("start"), (F.col("first") + F.col("windows") - 1 + LENGTH).alias("stop"))
    return single.unionByName(whole)


def merged(spans: list) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, n_repeated_marks``: one row per input row; ``kept`` holds the
    remaining bytes."""
    bound_batches(docs)
    spans = repeated_spans(docs, id_col, text_col).distinct()
    per_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    per_doc = per_doc.join(repeated_marks(docs, id_col, text_col), "doc", "full").withColumnRenamed("doc", "of")
    rows = _keyed(docs, id_col, text_col)
    rows = rows.join(per_doc, rows["doc"] == per_doc["of"], "left").select(
        "doc_id", "text", "spans", F.coalesce("n_repeated_marks", F.lit(0)).alias("n_repeated_marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out = [[], [], [], []]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode()
                gone = merged([(s["start"], s["stop"]) for s in spans or ()])
                edges = [0, *(e for s in gone for e in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                for column, value in zip(out, (len(raw), len(raw) - len(kept), len(gone), kept), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary()),
                 batch.column(3)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "n_repeated_marks"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, "
                                "n_repeated_marks long")
