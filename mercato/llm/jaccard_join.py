"""Operator 7, n-gram Jaccard join: a metric-space join with pivots, exact.

Texts are sets of word shingles, Jaccard distance is a metric, and texts link
when their similarity is at least ``similarity`` percent.

1. Equal sets become one class; every later step works on classes.
2. All shingles have one global order: by hash, those that many documents hold last.
   Two linked sets share at least c(n) shingles among their first
   n - ceil(t n) + c(n), their *prefix*, whatever the order (n: of the smaller).
3. *Pivots.*  Of the classes with a shingle in their prefix, the one with the
   smallest id is its pivot, and all of them belong to the pivot's region.  A
   class whose shingles have several pivots is replicated to their regions,
   but for those regions of fewest shingles that together hold less than half
   of the c shingles it must share: of c shared shingles, two classes then still
   have one region in common, and both ends of every link meet there.
4. Inside a region, prefixes alone bound how much two sets can share; classes
   with no partner left under that bound leave the region.
5. *Windows.*  The classes left are joined with their whole sets: the pivot's
   distances first, then cells around further pivots.  A class is in the cell of its
   nearest pivot and, by the triangle inequality, in each cell whose pivot
   is at most 2 * (1 - t) further away; cells are joined the same way,
   recursively, and small ones pair by pair.
6. A linked pair counts in the smallest region that both its classes are in, and there in
   one unit, for both ends and as often as the other class has rows.  Links become
   components; every document gets the smallest id in its own.  Where links are not
   counted, classes known to be connected are not compared again.

A region beyond ``REGION`` classes is cut into blocks, and each pair of blocks
is one unit of work with the pivot in it, so a unit's memory is bounded and no
class, pair or candidate is dropped.  Only links of a region's spanning
forest and each class's number of links leave it, never all its pairs.  Shingles and sets are told apart by
64-bit hashes.

Edge cases: a text with fewer words than a shingle is one shingle; a null,
empty or blank text is the empty set, linked with nothing, its own component, with no links; null
ids are ignored by the smallest id (a component of null ids alone has a null
id); repeated rows are all returned; texts of any length are used whole; an empty
table gives no rows; columns beside the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.joins import broadcast_if_small

from .common import bound_batches, grouped, materialize, pieces, spans_to_index, text_bytes
from .components import components
from .shingles import set_hash, shingle_sets

# Shingles counted as held by many documents: a hint for the global order, any choice is exact.
COMMON_LEAST, MOST_COMMON = 64, 100_000
REGION = 4096
EXTRA = 10  # one prefix shingle more for each so many of a set
MOST_BROADCAST = 300_000
_TOP = np.uint64(1 << 63)


# Sets and prefixes -------------------------------------------------------------

def common_shingles(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """The shingles held by the most documents, at most ``MOST_COMMON`` of them.

    Each batch reports what at least three of its documents and one in a
    thousand hold; the sums over all batches rank them.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(*text_bytes(batch.column(0)), words)
            held, n = np.unique(np.concatenate(sets), return_counts=True)
            often = n >= max(3, len(sets) / 1000)
            yield pa.RecordBatch.from_arrays([pa.array(held[often].view(np.int64)), pa.array(n[often])],
                                             ["shingle", "n"])

    rows = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "shingle long, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON_LEAST)
            .orderBy(F.col("n").desc(), "shingle").limit(MOST_COMMON).select("shingle").collect())
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def least_shared(n: int) -> int:
    """How many prefix shingles a set of n must share with a linked set that is not smaller."""
    return n // EXTRA + 1


def prefix_length(n: int, similarity: int) -> int:
    return min(n, n - -(-similarity * n // 100) + least_shared(n))


def spare(n: int, similarity: int) -> int:
    """How many shared shingles a set of n may pass over: with its partner's, fewer than they must share."""
    return (least_shared(-(-similarity * n // 100)) - 1) // 2


def ordered_prefix(own: np.ndarray, common: np.ndarray, similarity: int) -> np.ndarray:
    """The first shingles of a set in the global order, as order keys (sorted)."""
    keys = own >> np.uint64(1)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        keys[common[at] == own] |= _TOP
    k = prefix_length(len(own), similarity)
    return np.sort(np.partition(keys, k - 1)[:k]) if k < len(keys) else np.sort(keys)


def class_rows(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``id, n, class_id, text_hash`` of every row."""
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(*text_bytes(batch.column(2)), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_hash(s) for s in sets], pa.int64()), batch.column(1)],
                ["id", "n", "class_id", "text_hash"])

    return materialize(rows.mapInArrow(run, "id long, n long, class_id long, text_hash long"), "shingle-classes")


def class_prefixes(docs: DataFrame, words: int, similarity: int, text_col: str) -> DataFrame:
    """``class_id, n, spare, prefix`` of every class with words."""
    common = common_shingles(docs, text_col, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            own = {set_hash(s): s for s in shingle_sets(*text_bytes(batch.column(0)), words) if len(s)}
            if not own:
                continue
            prefixes = [ordered_prefix(s, common, similarity).view(np.int64) for s in own.values()]
            ends = np.cumsum([0] + [len(p) for p in prefixes])
            sizes = [len(s) for s in own.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(own), pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array([spare(n, similarity) for n in sizes], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefixes)))],
                ["class_id", "n", "spare", "prefix"])

    rows = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "class_id long, n long, spare long, prefix array<long>")
    return materialize(rows.groupBy("class_id").agg(*[F.first(c).alias(c) for c in ("n", "spare", "prefix")]),
                       "class-prefixes")


# Regions -----------------------------------------------------------------------

def region_pairs(classes: DataFrame) -> DataFrame:
    """``pivot, x``: each class in each region it belongs to, the pivot itself among them."""
    postings = classes.select(F.explode("prefix").alias("shingle"), "class_id", "spare")
    holders = Window.partitionBy("shingle").orderBy("class_id").rowsBetween(Window.unboundedPreceding, 0)
    held = (postings.withColumn("pivot", F.first("class_id").over(holders)).filter("pivot <> class_id")
            .groupBy(F.col("class_id").alias("x"), "pivot").agg(F.count(F.lit(1)).alias("shingles"),
                                                               F.first("spare").alias("spare")))
    # a class has at most one row per shingle of its own prefix here
    fewest = Window.partitionBy("x").orderBy("shingles", "pivot").rowsBetween(Window.unboundedPreceding, 0)
    pairs = held.withColumn("so_far", F.sum("shingles").over(fewest)).filter("so_far > spare").select("pivot", "x")
    pairs = materialize(pairs, "regions")
    return pairs.unionByName(pairs.select("pivot", F.col("pivot").alias("x")).distinct())


def units(members: DataFrame, most: int = REGION) -> DataFrame:
    """``members`` (``pivot, x, ...``) dealt to units of work: ``block`` and the unit's two blocks ``i``, ``j``.

    A region of up to ``most`` classes is one unit.  A larger one is cut into blocks
    by a hash of the class; each pair of blocks is a unit, and the pivot (block -1) is in all.
    """
    large = materialize(members.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
                        .select(F.col("pivot").alias("of"), F.ceil(F.col("n") / most).cast("int").alias("blocks")),
                        "large-regions")
    large = broadcast_if_small(large, MOST_BROADCAST)
    dealt = (members.join(large, members["pivot"] == large["of"], "left").drop("of")
             .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("block", F.when(F.col("x") == F.col("pivot"), -1)
                         .otherwise(F.pmod(F.xxhash64("x", "pivot"), F.col("blocks")).cast("int"))))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.transform(every, lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    whole = F.flatten(F.transform(every, lambda i: F.transform(
        F.sequence(i, F.col("blocks") - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    return (dealt.withColumn("unit", F.explode(F.when(F.col("block") < 0, whole).otherwise(own)))
            .select(*members.columns, "block", "unit.i", "unit.j"))


def _by_unit(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(table of one unit)`` for every unit, the pivot's row first."""
    keys = ["pivot", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, keys, least=1024):
            change = np.zeros(len(t), bool)
            for k in keys:
                v = t.column(k).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            at = np.concatenate([[0], np.flatnonzero(change), [len(t)]])
            out = [work(t.slice(a, b - a)) for a, b in zip(at[:-1], at[1:], strict=True) if b - a > 1]
            out = [x for x in out if x is not None]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)],
                    [c.split()[0] for c in schema.split(", ")])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "block", "x").mapInArrow(run, schema)


class Index:
    """Which members hold a token."""

    def __init__(self, tokens: np.ndarray, ends: np.ndarray):
        self.n = len(ends) - 1
        self.tokens, self.ends = tokens, ends
        owner = np.repeat(np.arange(self.n), np.diff(ends))
        order = np.argsort(tokens, kind="stable")
        self.sorted, self.owner = tokens[order], owner[order]

    def own(self, u: int) -> np.ndarray:
        return self.tokens[self.ends[u]:self.ends[u + 1]]

    def shared(self, u: int) -> np.ndarray:
        """How many tokens each member shares with ``u``."""
        mine = self.own(u)
        a = np.searchsorted(self.sorted, mine)
        b = np.searchsorted(self.sorted, mine, "right")
        return np.bincount(self.owner[spans_to_index(a, b - a)], minlength=self.n)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks()
    ends = lists.offsets.to_numpy()
    return lists.values.to_numpy()[ends[0]:ends[-1]].view(np.uint64), (ends - ends[0]).astype(np.int64)


def _may_pair(block: np.ndarray, u: int, i: int, j: int) -> np.ndarray | slice:
    """The members that ``u`` is compared with in unit (i, j): the other block, and the pivot."""
    if i == j or block[u] < 0:
        return slice(None)
    return block != block[u]


def active_members(t: pa.Table, similarity: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The members of a unit that may link with another one, judged by their prefixes.

    Of u's prefix, a shingle up to the end of v's prefix that v's prefix lacks
    is not in v at all; so u shares at most n(u) minus those with v.
    """
    block, n = t.column("block").to_numpy(), t.column("n").to_numpy()
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    index = Index(*_flat(t.column("prefix")))
    last = index.tokens[index.ends[1:] - 1]
    active = np.zeros(len(n), bool)
    for u in range(len(n)):
        shared = index.shared(u)
        missing = np.searchsorted(index.own(u), last, "right") - shared
        most = np.minimum(n[u] - missing, n)
        ok = (shared > 0) & (100 * most >= similarity * (n[u] + n - most))
        ok[u] = False
        pairs = np.zeros(len(n), bool)
        pairs[_may_pair(block, u, i, j)] = True
        active[u] = (ok & pairs).any()
    if active.sum() < 2:
        return None
    x = t.column("x").to_numpy()[active]
    return np.full(len(x), t.column("pivot")[0].as_py()), x


class Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def root(self, u: int) -> int:
        while self.up[u] != u:
            self.up[u] = self.up[self.up[u]]
            u = int(self.up[u])
        return u

    def link(self, u: int, v: int) -> None:
        a, b = self.root(u), self.root(v)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.links.append((u, v))

    def connected(self, members: np.ndarray) -> bool:
        first = self.root(int(members[0]))
        return all(self.root(int(m)) == first for m in members)


class MetricJoin:
    """Exact recursive join of sets under Jaccard distance; ``block`` limits which members meet."""

    CELLS = 8
    SMALL = 24

    def __init__(self, index: Index, similarity: int, block: np.ndarray, i: int, j: int, every: bool = False):
        # with ``every``, all links are found and kept as a matrix of the unit's members
        self.near = np.zeros((index.n, index.n), bool) if every else None
        self.index, self.similarity, self.block, self.i, self.j = index, similarity, block, i, j
        self.size = np.diff(index.ends)
        self.radius = 1 - similarity / 100
        self.forest = Forest(index.n)

    def pivot(self, u: int, members: np.ndarray) -> np.ndarray:
        """Link ``u`` with all members near it; its distances to them."""
        shared = self.index.shared(u)[members]
        union = self.size[u] + self.size[members] - shared
        near = 100 * shared >= self.similarity * union
        may = _may_pair(self.block, u, self.i, self.j)
        if not isinstance(may, slice):
            near &= may[members]
        if self.near is not None:
            self.near[u, members[near]] = self.near[members[near], u] = True
        else:
            for v in members[near]:
                if v != u:
                    self.forest.link(u, int(v))
        return 1 - shared / union

    def join(self, members: np.ndarray) -> None:
        if len(members) < 2 or self.near is None and self.forest.connected(members):
            return
        if len(members) <= self.SMALL:
            self.one_by_one(members)
            return
        chosen = members[np.linspace(0, len(members) - 1, self.CELLS).astype(int)]
        distance = np.stack([self.pivot(int(u), members) for u in chosen])  # all links of these are found
        rest = ~np.isin(members, chosen)
        members, distance = members[rest], distance[:, rest]
        nearest = distance.min(axis=0)
        window = distance <= nearest + 2 * self.radius + 1e-9
        cells = []
        for c in range(self.CELLS):
            # a pair is found in the cell of either end's nearest pivot
            own = distance[c] == nearest
            if own.any():
                reach = distance[c][own].max() + self.radius + 1e-9
                cells.append(members[window[c] & (distance[c] <= reach)])
        if max(map(len, cells), default=0) < 0.75 * len(members):
            for cell in cells:
                self.join(cell)
        else:  # pivots that tell nothing apart
            self.one_by_one(members)

    def one_by_one(self, members: np.ndarray) -> None:
        """Every member is a pivot in turn, for those after it (without ``every``, that are not connected with it yet)."""
        for k in range(len(members) - 1):
            u, rest = int(members[k]), members[k + 1:]
            if self.near is None:
                mine = self.forest.root(u)
                rest = rest[[self.forest.root(int(v)) != mine for v in rest]]
            small, large = np.minimum(self.size[u], self.size[rest]), np.maximum(self.size[u], self.size[rest])
            rest = rest[100 * small >= self.similarity * large]
            if len(rest):
                self.pivot(u, rest)


def region_counts(t: pa.Table, similarity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """A spanning forest of the links among the sets of a unit, as (a, b, 0), and every member's links, as (x, x, links).

    ``earlier`` holds the smaller regions that a member is in: pairs that share one are counted there.
    """
    index, earlier = Index(*_flat(t.column("own"))), Index(*_flat(t.column("earlier")))
    block, rows, x = (t.column(c).to_numpy() for c in ("block", "rows", "x"))
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    work = MetricJoin(index, similarity, block, i, j, every=True)
    everyone = np.arange(index.n)
    work.pivot(0, everyone)  # the region's own pivot, where it is still there, comes first
    work.join(everyone[1:])
    near = work.near
    near[everyone, everyone] = False
    counts = np.zeros(index.n, np.int64)
    links, fresh = [], np.ones(index.n, bool)
    for start in range(index.n):
        todo = [start] if fresh[start] else []
        fresh[start] = False
        while todo:
            u = todo.pop()
            own = np.flatnonzero(near[u] & fresh)
            fresh[own] = False
            links += [(u, v) for v in own.tolist()]
            todo += own.tolist()
        here = near[start] & (earlier.shared(start) == 0) if near[start].any() else near[start]
        if i != j:  # the pivot is in every unit: its pairs count where the other end's block meets itself
            here = here & (block >= 0) & (block[start] >= 0)
        counts[start] = rows[here].sum()
    if not links:
        return None
    some = counts > 0
    a, b = np.array(links).T
    return (np.concatenate([x[a], x[some]]), np.concatenate([x[b], x[some]]),
            np.concatenate([np.zeros(len(a), np.int64), counts[some]]))


def region_links(t: pa.Table, similarity: int) -> tuple[np.ndarray, np.ndarray] | None:
    """A spanning forest of the links among the sets of a unit."""
    index = Index(*_flat(t.column("own")))
    work = MetricJoin(index, similarity, t.column("block").to_numpy(), t.column("i")[0].as_py(),
                      t.column("j")[0].as_py())
    everyone = np.arange(index.n)
    work.pivot(0, everyone)  # the region's own pivot, where it is still there, comes first
    work.join(everyone[1:])
    if not work.forest.links:
        return None
    x = t.column("x").to_numpy()
    links = np.array(work.forest.links)
    return x[links[:, 0]], x[links[:, 1]]


def whole_sets(docs: DataFrame, wanted: DataFrame, words: int, text_col: str) -> DataFrame:
    """``class_id, own``: the whole set of every wanted class (``class_id, text_hash``)."""
    text = F.col(f"`{text_col}`")
    keys = broadcast_if_small(wanted.withColumnRenamed("text_hash", "wanted_hash"), MOST_BROADCAST)
    rows = docs.select(F.xxhash64(text).alias("text_hash"), text.alias("text"))
    rows = rows.join(keys, rows["text_hash"] == keys["wanted_hash"]).select("class_id", "text")
    rows = rows.dropDuplicates(["class_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(*text_bytes(batch.column(1)), words)
            ends = np.cumsum([0] + [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                           pa.array(np.concatenate(sets).view(np.int64)))],
                ["class_id", "own"])

    return rows.mapInArrow(run, "class_id long, own array<long>")


def jaccard_components(docs: DataFrame, words: int = 4, similarity: int = 85, id_col: str = "doc_id",
                       text_col: str = "text", count_links: bool = True) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class_id, root, component_id, n_links``: one row per input row.

    ``n_links`` is the number of other rows that a row links with, those of its own class among them (null without ``count_links``).
    ``root`` is the component's smallest class (null without words), ``component_id`` is the smallest id that links of ``similarity`` percent lead to.
    """
    bound_batches(docs)
    rows = class_rows(docs, words, id_col, text_col)
    filled = rows.filter("n > 0")
    classes = filled.groupBy("class_id").agg(F.min("id").alias("smallest"), F.min("text_hash").alias("text_hash"),
                                             F.count(F.lit(1)).alias("rows"))
    prefixes = class_prefixes(docs, words, similarity, text_col)
    pairs = broadcast_if_small(region_pairs(prefixes), MOST_BROADCAST)
    members = prefixes.join(pairs, prefixes["class_id"] == pairs["x"]).select("pivot", "x", "n", "prefix")
    active = materialize(_by_unit(units(members), lambda t: active_members(t, similarity), "pivot long, x long")
                         .distinct(), "active-members")
    wanted = active.select(F.col("x").alias("class_id")).distinct()
    wanted = materialize(wanted.join(classes, "class_id").select("class_id", "text_hash"), "wanted-classes")
    sets = materialize(whole_sets(docs, wanted, words, text_col), "whole-sets")
    small = broadcast_if_small(active, MOST_BROADCAST)
    if count_links:
        # a class has at most one region per shingle of its own prefix
        own = active.groupBy(F.col("x").alias("class_id")).agg(F.collect_list("pivot").alias("regions"))
        sets = sets.join(own, "class_id").join(classes.select("class_id", "rows"), "class_id")
        joined = sets.join(small, sets["class_id"] == small["x"]).select(
            "pivot", "x", "own", "rows", F.expr("filter(regions, r -> r < pivot)").alias("earlier"))
        found = materialize(_by_unit(units(joined), lambda t: region_counts(t, similarity), "a long, b long, n long"),
                            "region-counts")
        links = found.filter("a <> b").select("a", "b")
        counts = found.filter("a = b").groupBy(F.col("a").alias("counted")).agg(F.sum("n").alias("n"))
    else:
        joined = sets.join(small, sets["class_id"] == small["x"]).select("pivot", "x", "own")
        links = _by_unit(units(joined), lambda t: region_links(t, similarity), "a long, b long")
    roots = components(links)
    smallest = classes.select("class_id", "smallest", "rows")
    of_class = smallest.join(roots, smallest["class_id"] == roots["node"], "left").select(
        "class_id", "smallest", F.coalesce("root", "class_id").alias("root"), "rows")
    if count_links:
        of_class = of_class.join(counts, of_class["class_id"] == counts["counted"], "left").withColumn(
            "n_links", F.coalesce("n", F.lit(0)) + F.col("rows") - 1).drop("counted", "n")
    else:
        of_class = of_class.withColumn("n_links", F.lit(None).cast("long"))
    of_class = materialize(of_class, "class-roots")
    of_root = of_class.groupBy("root").agg(F.min("smallest").alias("component_id"))
    ids = materialize(of_class.join(of_root, "root").select(F.col("class_id").alias("of"), "root", "component_id",
                                                        "n_links"),
                      "class-components")
    linked = filled.join(ids, filled["class_id"] == ids["of"]).select(
        "id", "text_hash", "n", "class_id", "root", "component_id", "n_links")
    alone = rows.filter("n = 0").select("id", "text_hash", "n", "class_id", F.lit(None).cast("long").alias("root"),
                                        F.col("id").alias("component_id"),
                                        F.lit(0 if count_links else None).cast("long").alias("n_links"))
    return linked.unionByName(alone).withColumnsRenamed({"id": "doc_id", "n": "n_shingles"})


def keep_one_per_component(docs: DataFrame, words: int = 5, similarity: int = 80, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """One row of each component: that of the smallest id (null ids last; of equal ids, the smallest text hash).

    Rows without words are linked with nothing and all stay.
    """
    found = jaccard_components(docs, words, similarity, id_col, text_col, count_links=False).filter(
        "n_shingles > 0")
    keys = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "rank", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash"))
    first = keys.groupBy(F.col("root").alias("of")).agg(F.min("rank").alias("first"))
    marked = materialize(keys.join(first, keys["root"] == first["of"]).select(
        F.col("doc_id").alias("key_id"), F.col("text_hash").alias("key_hash"), "rows",
        (F.col("rank") == F.col("first")).alias("kept")).filter("NOT kept OR rows > 1"), "near-duplicates")
    text_hash = F.xxhash64(F.col(f"`{text_col}`"))

    def keyed(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        small = broadcast_if_small(keys, MOST_BROADCAST)
        return rows.join(small, F.col(f"`{id_col}`").cast("long").eqNullSafe(small["key_id"])
                         & (text_hash == small["key_hash"]), how)

    out = keyed(docs, marked.filter("NOT kept").select("key_id", "key_hash"), "left_anti")
    repeated = marked.filter("kept").select("key_id", "key_hash")
    if repeated.limit(1).count():  # rows equal in id and text
        out = keyed(out, repeated, "left_anti").unionByName(
            keyed(out, repeated, "left_semi").dropDuplicates([id_col, text_col]))
    return out
