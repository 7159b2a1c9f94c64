"""Phrase collocation mining (operator 13) by top-order marginalisation.

Counts of all phrases of 2 to 5 words come from one count of the longest windows:

1. **Words.**  Every language's words are counted (partial sums per task).  A phrase that
   stands ``least`` times consists of words that do, so only those get ids, by falling count.
2. **Windows.**  Each place leads one window: its word and the next four (lead columns), padded with 0 from the
   end of the piece, or from the first rarer word, on.  Equal windows are summed in the task, then after one shuffle
   by their first two words.
3. **Marginals.**  A phrase of k words is counted by the windows that begin with it, so ``ROLLUP`` over the
   window's columns sums all shorter prefixes; no other n-gram is ever made.  Before it, inside the
   partitions, every window is cut to its longest prefix that stands ``least`` times (nothing longer can), and
   equal ones are summed, so ``ROLLUP`` meets little more than the phrases it returns.
4. **Scores.**  Every cut of a phrase looks up its two parts among the counts; the least score counts.
   A phrase goes if it is part of a phrase one word longer that stands as often (counts fall
   with length, so a phrase inside any longer such phrase is inside one of these).

Hot pairs: two words of which each makes up a hundredth of all words or more (there are at most a hundred such words)
spread their windows by the first further word that is not hot, so no task gets more than about a hundredth of all
windows for one key.  Only prefixes made of hot words alone lie in several partitions; those are never cut, and ``ROLLUP`` sums them.  The id table goes to the tasks if it has at most ``most_broadcast`` rows;
otherwise words meet their ids in a shuffle join, and the windows are lead columns over each piece.

Defined results: a null text is empty, a null language ``und``; repeated rows (ids are not read) count each;
a text of any length is read whole; a table without a phrase of ``least`` places gives an empty result.
Scores are exact integers (38 digits); ties go by a, then by the phrase in byte order.  Other columns
are not read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.ranking import global_rank_running_sum

from .common import Rolling, bound_batches, materialize, mix64, pieces, spans_to_index, spread, text_bytes

LEAST, TOP, PERCENT, SCALE = 100, 2000, 100, 1000
LONGEST = 5
MOST_BROADCAST = 1_000_000
HOT_SHARE = 100
SALTS = 64
_JOINED = 1 << 20  # windows summed together in a task

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_KIND = np.zeros(256, np.uint8)  # 0 letter, 1 blank, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOW, _HIGH = 21, 10  # bits of an id in the columns rest and more


def _joint(lang: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One hash of two, which must not be told apart by their sum alone: (en, es) is not (es, en)."""
    return mix64(lang * np.uint64(3) + word)


class Words:
    """The words of some texts: bounds, text number, and whether the next word stands in the same piece."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        n = len(data)
        kind = _KIND[data]
        edge = np.ones(n + 1, bool)
        edge[1:n] = (kind[1:] == 0) != (kind[:-1] == 0)
        edge[offsets] = True
        at = np.flatnonzero(edge)
        starts, stops = at[:-1], at[1:]
        word = kind[starts] == 0
        self.data, self.starts, self.stops = _LOWER[data], starts[word], stops[word]
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        ends = np.cumsum(kind == 2, dtype=np.int32)
        self.piece = ends[self.starts] if n else np.zeros(0, np.int32)
        self.joined = np.zeros(len(self.starts), bool)
        self.joined[:-1] = (self.row[1:] == self.row[:-1]) & (self.piece[1:] == self.piece[:-1])

    def keys(self, langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of every (language, word)."""
        lang, offsets = text_bytes(langs)
        return tuple(_joint(Rolling(lang, salt).of(offsets[:-1], offsets[1:])[self.row],
                            Rolling(self.data, salt).of(self.starts, self.stops)) for salt in (0, 1))

    def strings(self, which: np.ndarray) -> pa.Array:
        sizes = self.stops[which] - self.starts[which]
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
        data = self.data[spans_to_index(self.starts[which], sizes)]
        return pa.StringArray.from_buffers(len(which), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        words = Words(batch.column(1))
        one, two = words.keys(batch.column(0))
        order = np.argsort(one, kind="stable")
        one, two = one[order], two[order]
        firsts = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[:len(order)])
        which = order[firsts]
        yield pa.record_batch([batch.column(0).take(pa.array(words.row[which])), words.strings(which),
                               pa.array(np.diff(np.append(firsts, len(order))))], ["lang", "word", "n"])


def _placed_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 33
    for batch in pieces(batches, "text"):
        words = Words(batch.column(1))
        n = len(words.starts)
        new = np.append(True, ~words.joined[:-1])[:n]
        piece = np.cumsum(new) - 1
        place = np.arange(n) - np.flatnonzero(new)[piece] if n else piece
        yield pa.record_batch([pa.array(number + piece), pa.array(place.astype(np.int64)),
                               batch.column(0).take(pa.array(words.row)), words.strings(np.arange(n))],
                              ["piece", "place", "lang", "word"])
        number += int(piece[-1]) + 1 if n else 0


class Ids:
    """The ids of frequent words by the two hashes of (language, word); 0 for all others."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        word, offsets = text_bytes(table.column("word"))
        lang, langs = text_bytes(table.column("lang"))
        one, two = (_joint(Rolling(lang, salt).of(langs[:-1], langs[1:]), Rolling(word, salt).of(offsets[:-1], offsets[1:]))
                    for salt in (0, 1))
        order = np.argsort(one)
        self.one, self.two = one[order], two[order]
        self.ids = table.column("id").to_numpy()[order].astype(np.int64)

    def of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        if not len(self.ids):
            return np.zeros(len(one), np.int64)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        return np.where((self.one[at] == one) & (self.two[at] == two), self.ids[at], 0)


def _lead_windows(ids: np.ndarray, joined: np.ndarray) -> list[np.ndarray]:
    """Lead columns of the places whose window has two words or more; padded with 0."""
    reach = np.flatnonzero((ids[:-1] > 0) & joined[:-1] & (ids[1:] > 0))
    columns = [ids[reach], ids[reach + 1]]
    ids, joined = np.append(ids, np.zeros(LONGEST, ids.dtype)), np.append(joined, np.zeros(LONGEST, bool))
    open_ = np.ones(len(reach), bool)
    for k in range(2, LONGEST):
        open_ &= joined[reach + k - 1] & (ids[reach + k] > 0)
        columns.append(np.where(open_, ids[reach + k], 0))
    return columns


def _packed(columns: list, bits: int = 31) -> list:
    """Five ids of so many bits in three numbers (of numpy arrays): the first two words, then the low and the high bits
    of the others.  No more bits are used than ids need, as they are shuffled."""
    small = min(bits, _LOW)
    a, b, *others = columns
    rest = more = 0
    for w in others:
        rest, more = rest << small | w & (1 << small) - 1, more << _HIGH | w >> small
    return [a << bits | b, rest, more]


def _packed_columns(ids: list[Column], bits: int = 31) -> list[Column]:
    """The same of Spark columns."""
    small = min(bits, _LOW)
    rest = more = F.lit(0).cast("long")
    for w in ids[2:]:
        rest = F.shiftleft(rest, small).bitwiseOR(w.bitwiseAND(F.lit((1 << small) - 1)))
        more = F.shiftleft(more, _HIGH).bitwiseOR(F.shiftright(w, small))
    return [F.shiftleft(ids[0], bits).bitwiseOR(ids[1]), rest, more]


def _unpacked(k: int, bits: int = 31) -> Column:
    """Word k (from 1) of a packed window."""
    if k <= 2:
        return F.shiftright("pair", bits) if k == 1 else F.col("pair").bitwiseAND(F.lit((1 << bits) - 1))
    small, down = min(bits, _LOW), LONGEST - k
    low = F.shiftright("rest", small * down).bitwiseAND(F.lit((1 << small) - 1))
    high = F.shiftright("more", _HIGH * down).bitwiseAND(F.lit((1 << _HIGH) - 1))
    return F.shiftleft(high, small).bitwiseOR(low)


def _summed(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    pair, rest, more = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.lexsort((more, rest, pair))
    pair, rest, more = pair[order], rest[order], more[order]
    new = np.append(True, (pair[1:] != pair[:-1]) | (rest[1:] != rest[:-1]) | (more[1:] != more[:-1]))[:len(pair)]
    firsts = np.flatnonzero(new)
    return pa.record_batch([pa.array(c) for c in (pair[firsts], rest[firsts], more[firsts],
                                                  np.diff(np.append(firsts, len(pair))))],
                           ["pair", "rest", "more", "n"])


_WINDOW = "pair long, rest long, more long, n long"


def _windows_by_broadcast(texts: DataFrame, ids: DataFrame, bits: int) -> DataFrame:
    known = texts.sparkSession.sparkContext.broadcast(Ids(ids.select("id", "lang", "word").toArrow()))

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in pieces(batches, "text"):
            words = Words(batch.column(1))
            held.append(_packed(_lead_windows(known.value.of(*words.keys(batch.column(0))), words.joined), bits))
            n += len(held[-1][0])
            if n >= _JOINED:
                yield _summed(held)
                held, n = [], 0
        if held:
            yield _summed(held)

    return texts.mapInArrow(windows, _WINDOW)


def _windows_by_join(texts: DataFrame, ids: DataFrame, bits: int) -> DataFrame:
    placed = materialize(texts.mapInArrow(_placed_words, "piece long, place long, lang string, word string"), "words")
    over = Window.partitionBy("piece").orderBy("place")
    lead = placed.join(ids.select("lang", "word", "id"), ["lang", "word"], "left").withColumn(
        "w1", F.coalesce("id", F.lit(0)))
    lead = lead.select("w1", *[F.coalesce(F.lead("w1", k).over(over), F.lit(0)).alias(f"w{k + 1}")
                               for k in range(1, LONGEST)]).filter("w1 > 0 AND w2 > 0")
    for k in range(3, LONGEST + 1):
        lead = lead.withColumn(f"w{k}", F.when(F.col(f"w{k - 1}") > 0, F.col(f"w{k}")).otherwise(0))
    packed = _packed_columns([F.col(f"w{k}").cast("long") for k in range(1, LONGEST + 1)], bits)
    return lead.select(*[c.alias(name) for c, name in zip(packed, ("pair", "rest", "more"), strict=True)],
                       F.lit(1).cast("long").alias("n"))


def count_phrases(windows: DataFrame, n_words: int, n_hot: int, least: int, bits: int = 31) -> DataFrame:
    """``ids, n``: every phrase of two words or more (as an array of word ids) with ``least`` places."""
    words = [_unpacked(k, bits) for k in range(1, LONGEST + 1)]
    hot = [(w >= 1) & (w <= n_hot) for w in words]
    # the further words up to the first that is not hot decide a hot pair's salt
    salt = F.hash("rest", "more")
    for w, h in reversed(list(zip(words[2:], hot[2:], strict=True))):
        salt = F.when(~h, F.hash(w)).otherwise(salt)
    dealt = windows.select(F.when(hot[0] & hot[1], F.pmod(salt, F.lit(SALTS))).otherwise(0).alias("salt"),
                           F.shiftleft("more", 32).bitwiseOR(F.col("n")).alias("more_n"), "rest", "pair")
    longest = (dealt.repartition(spread(n_words, 1 << 20), "pair", "salt")
               .withColumn("more", F.shiftright("more_n", 32))
               .groupBy("pair", "salt", "rest", "more")
               .agg(F.sum(F.col("more_n").bitwiseAND(F.lit((1 << 32) - 1))).alias("n")))
    others = [f"w{k}" for k in range(3, LONGEST + 1)]
    longest = (longest.select("pair", "salt", *[_unpacked(k, bits).cast("int").alias(f"w{k}")
                                                for k in range(3, LONGEST + 1)], "n")
               .sortWithinPartitions("pair", "salt", *others[:-1]))
    # marginals inside a partition: all windows with a prefix are in one, but for prefixes of hot words only
    kept = longest
    first, second = _unpacked(1, bits), _unpacked(2, bits)
    all_hot = F.greatest(first, second) <= n_hot
    prefix = ["pair", "salt"]
    reach = F.lit(True)
    for w in [None, *others]:
        if w is not None:
            prefix = [*prefix, w]
            all_hot = all_hot & (F.col(w) >= 1) & (F.col(w) <= n_hot)
            whole = F.col("n") if w == others[-1] else F.sum("n").over(Window.partitionBy(*prefix))
            reach = reach & (F.col(w) > 0) & F.col(f"{w}_often")
            kept = kept.withColumn(f"{w}_often", (whole >= least) | all_hot)
            kept = kept.withColumn(f"{w}_cut", F.when(reach, F.col(w)).otherwise(0))
        else:
            kept = (kept.withColumn("pair_n", F.sum("n").over(Window.partitionBy(*prefix)))
                    .filter((F.col("pair_n") >= least) | all_hot))
    # windows cut to their longest frequent prefix: few are left, and no prefix loses a count
    cut = [F.col(f"{w}_cut").alias(w) for w in others]
    frequent = kept.select("pair", "salt", *cut, "n").groupBy("pair", "salt", *others).agg(F.sum("n").alias("n"))
    rolled = (frequent.rollup("pair", *others).agg(F.sum("n").alias("n"))
              .filter((F.col("n") >= least) & F.col("pair").isNotNull()))
    # a rolled-up column is null, padding is 0
    ids = F.array(first.cast("int"), second.cast("int"), *others)
    return (rolled.withColumn("ids", F.filter(ids, lambda w: w.isNotNull()))
            .filter(~F.array_contains("ids", 0)).select("ids", "n"))


def mine_collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, percent: int = PERCENT,
                      text_col: str = "text", lang_col: str = "lang",
                      most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases."""
    bound_batches(docs)
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"),
                        F.col(f"`{text_col}`").alias("text"))
    counted = materialize(texts.mapInArrow(_count_words, "lang string, word string, n long")
                          .groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    n_words = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranked = global_rank_running_sum(counted.filter(F.col("n") >= least), [F.col("n").desc(), F.col("lang"), F.col("word")],
                                     "n", rank_col="id")
    ids = materialize(ranked.select(F.col("id").cast("int").alias("id"), "lang", "word", "n"), "word-ids")
    n_hot, n_ids = ids.agg(F.count_if(F.col("n") * HOT_SHARE >= n_words), F.count(F.lit(1))).first()
    bits = max(1, int(n_ids).bit_length())
    make = _windows_by_broadcast if n_ids <= most_broadcast else _windows_by_join
    phrases = materialize(count_phrases(make(texts, ids, bits), n_words, n_hot, least, bits), "phrases")

    counts = phrases.unionByName(ids.select(F.array("id").alias("ids"), "n"))
    size = F.size("ids")
    cuts = (phrases.select("ids", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .withColumn("first", F.slice("ids", F.lit(1), F.col("k")))
            .withColumn("last", F.slice("ids", F.col("k") + 1, size - F.col("k"))))
    cuts = (cuts.join(counts.select(F.col("ids").alias("first"), F.col("n").alias("l")), "first")
            .join(counts.select(F.col("ids").alias("last"), F.col("n").alias("r")), "last"))
    cuts = (cuts.withColumn("id", F.get("ids", F.lit(0))).join(ids.select("id", "lang"), "id").join(totals, "lang"))
    exact = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "total", "l", "r")}
    cuts = (cuts.withColumn("over", exact["a"] * F.lit(SCALE).cast("decimal(38,0)") * exact["total"])
            .withColumn("under", exact["l"] * exact["r"]).withColumn("score", F.expr("over div under")))
    scored = cuts.groupBy("ids").agg(F.min(F.struct("score", "k", "l", "r", "a", "lang", "total")).alias("cut"))

    # the longest phrase's parts that are one word shorter
    parts = phrases.filter(size > 2).select(
        F.explode(F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))).alias("ids"), "n")
    inside = parts.groupBy("ids").agg(F.max("n").alias("longer"))
    kept = (scored.join(inside, "ids", "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("cut.a"))))
    kept = materialize(kept.select("ids", "cut.*"), "kept-phrases")
    spelt = (kept.select("ids", F.posexplode("ids").alias("place", "id")).join(ids.select("id", "word"), "id")
             .groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("words"))
             .select("ids", F.array_join("words.word", " ").alias("phrase")))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (kept.join(spelt, "ids").withColumn("rank", F.row_number().over(best).cast("long"))
            .filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
