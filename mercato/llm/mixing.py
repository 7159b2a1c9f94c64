"""Operator 10, mixing sources to target weights: Pareto order sampling, Spark expressions only.

Sources in code-point order (null last) weigh 1, 2, 3, 1, ... and share the
words of the whole table; a target stops at ``MOST_COPIES`` times its source's
size, and the excess is shared again by weight among the rest until no target
is above (solved in closed form by a running sum over the sources).

A source with target / size = c + f gives every document c certain whole
copies.  The rest is an unequal-probability Pareto order sample: a document of s words is
included once more with probability p = min(1, level * s ** SIZE_POWER), where the source's level
makes the expected words equal those left (solved exactly by running sums over the
source's distinct sizes); documents whose p reaches 1 are certain.  The others are ranked by their random odds
u / (1 - u), u from a hash of the document, divided by the inclusion odds p / (1 - p), and taken in that
order as long as they fit into the words left.  The one document that comes closest to the words
then still missing is taken as well if that brings the source nearer to its
target.  So a source misses its target by less than half its largest unsampled
document, and usually by a few words.

No window spans a source's documents: ranks are cut into ``RANGES`` ranges, words are summed per (source, range)
before any ordering, and only the range in which a source's sample ends, a few of ``RANGES`` parts of its
documents at most, is ordered row by row.  Certain documents have a range of their own.  What comes out is one small row
per source (whole copies, level, where the sample ends, the one document beyond), against which
every document decides for itself, so texts are never shuffled.

Edge cases: a null or blank text has size 0, is never sampled and takes 0 words; a null source is
a source of its own; null, repeated or tied ids are told apart by a hash of the
text; rows equal in id and text are taken together or not at all; an empty
table gives no rows; columns beside the named ones stay as they are, inside
the struct ``doc``, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.joins import broadcast_if_small

from .common import materialize, uniform, word_count

MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
SIZE_POWER = 0.5
RANGES = 4096
MOST_BROADCAST_SOURCES = 10_000
SEED = 20_10


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target``: one row per source.

    ``sizes`` has ``source`` and ``size``.  The windows run over one row per
    source, after the words are summed.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Spark orders strings by their UTF-8 bytes, which is code-point order
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    capped = (per_source
              .withColumn("weight", F.get(weights, ((F.row_number().over(order) - 1) % len(WEIGHTS)).cast("int")))
              .withColumn("cap", F.col("source_size") * float(MOST_COPIES))
              .withColumn("at", F.col("cap") / F.col("weight")))
    # Water level: sources in the order in which they reach their caps; if those before
    # one are capped, the level is what they leave divided by the weights of the others.
    # The right level is that of the first source which stays under its cap.
    before = Window.orderBy("at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    levels = capped.withColumn(
        "level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (weight - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    found = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
        "at", F.col("source").isNull().alias("last"), "source", "level"))).over(everything)["level"]
    return levels.withColumn("found", found).select(
        "source", "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("found") * F.col("weight"), F.col("cap"))).alias("target"))


def _weight() -> Column:
    """size ** SIZE_POWER in millionths: whole, so that its sums do not depend on their order."""
    return F.round(F.pow(F.col("size").cast("double"), F.lit(SIZE_POWER)) * 1e6).cast("long")


def _room() -> tuple[Column, Column]:
    """Whole copies of a source's documents, and the words left for its sample."""
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    return whole, F.col("target") - whole * F.col("source_size")


def sample_levels(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``whole``, ``room``, ``level`` and ``certain``, the size from which documents are certain.

    With all larger documents certain, those of size s are too if level * s ** SIZE_POWER reaches 1; that holds for every
    size above the least one.  The windows run over a source's distinct sizes, of which there are at
    most the root of twice its words.
    """
    whole, room = _room()
    rooms = targets.withColumn("whole", whole).withColumn("room", room)
    each = sizes.filter("size > 0").groupBy("source", "size").agg(F.sum("size").alias("words"))
    each = each.withColumn("mass", F.col("words").cast("decimal(19,0)") * _weight().cast("decimal(18,0)"))
    each = _with_source(each, rooms.select("source", "room"))
    above = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("room") - F.coalesce(F.sum("words").over(above), F.lit(0))
    reaches = _weight() * left >= F.sum("mass").over(upto).cast("double")
    solved = each.withColumn("reaches", reaches & (left > 0)).groupBy("source").agg(
        F.min(F.when(F.col("reaches"), F.col("size"))).alias("certain"),
        F.sum(F.when(F.col("reaches"), F.col("words")).otherwise(0)).alias("certain_words"),
        F.sum(F.when(~F.col("reaches"), F.col("mass"))).cast("double").alias("mass")).withColumnRenamed("source", "of")
    return rooms.join(solved, rooms["source"].eqNullSafe(solved["of"]), "left").select(
        rooms["*"], "certain", F.coalesce(F.try_divide(F.col("room") - F.col("certain_words"), F.col("mass")), F.lit(0.0))
        .alias("level"))


def _ranked(rows: DataFrame) -> DataFrame:
    """The inclusion probability of each row beyond its whole copies, and its rank."""
    certain = F.col("certain").isNotNull() & (F.col("size") >= F.col("certain"))
    # rounding may bring a level to the edge of the certain ones
    p = F.when(certain, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0 - 1e-12), F.col("level") * _weight())))
    odds = F.try_divide((F.col("u") / (F.lit(1.0) - F.col("u"))) * (F.lit(1.0) - F.col("p")), F.col("p"))
    q = F.when(F.col("p") > 0, odds).otherwise(F.lit(float("inf")))
    return (rows.withColumn("p", F.when((F.col("size") > 0) & (F.col("room") > 0), p).otherwise(F.lit(0.0)))
            .withColumn("q", q)
            .withColumn("range", F.when(F.col("p") >= 1, -1).when(F.col("p") > 0, F.least(
                F.lit(RANGES - 1), F.floor(F.col("q") / (F.col("q") + 1) * RANGES).cast("int"))).otherwise(RANGES))
            .withColumn("rank", F.struct("q", "id", "text_hash")).drop("q"))


def _decisions(narrow: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: the columns of ``targets`` and ``stop, last, extra``."""
    rows = _ranked(_with_source(narrow, targets)).filter("p > 0")
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("words"), F.first("room").alias("room"))
    so_far = F.sum("words").over(Window.partitionBy("source").orderBy("range"))  # at most RANGES rows a source
    stops = (sums.withColumn("so_far", so_far).filter(F.col("so_far") > F.col("room"))
             .groupBy("source").agg(F.min(F.struct("range", (F.col("so_far") - F.col("words")).alias("before")))
                                    .alias("s"))
             .select(F.col("source").alias("stop_source"), F.col("s.range").alias("stop"),
                     F.col("s.before").alias("before")))
    stops = targets.join(stops, targets["source"].eqNullSafe(stops["stop_source"]), "left").select(
        targets["*"], F.coalesce("stop", F.lit(RANGES)).alias("stop"), F.coalesce("before", F.lit(0)).alias("before"))
    at_stop = _ranked(_with_source(narrow, stops)).filter((F.col("p") > 0) & (F.col("range") == F.col("stop")))
    peers = Window.partitionBy("source").orderBy("rank")  # equal rows are peers: in or out together
    fits = (at_stop.withColumn("so_far", F.col("before") + F.sum("size").over(peers))
            .filter(F.col("so_far") <= F.col("room"))
            .groupBy("source").agg(F.max(F.struct("rank", "so_far")).alias("f")))
    fits = fits.select(F.col("source").alias("fit_source"), F.col("f.rank").alias("last"),
                       F.col("f.so_far").alias("reached"))
    ends = materialize(stops.join(fits, stops["source"].eqNullSafe(fits["fit_source"]), "left").select(
        stops["*"], "last", F.coalesce("reached", "before").alias("reached")), "mix-ends")
    # the one document beyond the end whose size is nearest to the words still missing
    beyond = _ranked(_with_source(narrow, ends)).filter(~_sampled())
    missing = F.col("room") - F.col("reached")
    off = F.abs(F.col("size") - missing)
    extra = (beyond.filter(off < missing).groupBy("source")
             .agg(F.min(F.struct(off.alias("off"), "rank"))["rank"].alias("extra"))
             .withColumnRenamed("source", "extra_source"))
    return ends.join(extra, ends["source"].eqNullSafe(extra["extra_source"]), "left").drop("extra_source")


def _sampled():
    in_range = (F.col("range") == F.col("stop")) & F.col("last").isNotNull() & (F.col("rank") <= F.col("last"))
    return (F.col("p") > 0) & ((F.col("range") < F.col("stop")) | in_range)


def _with_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Each row with the columns of its source; broadcast only after a check of the number of sources."""
    small = broadcast_if_small(per_source.withColumnRenamed("source", "its_source"), MOST_BROADCAST_SOURCES)
    return rows.join(small, rows["source"].eqNullSafe(small["its_source"])).drop("its_source")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED) -> DataFrame:
    """``doc, size, source, source_size, target, copies, taken, expected_copies``: one row per input row.

    ``doc`` is the input row; ``copies`` whole copies of it make ``taken`` words; ``expected_copies`` are its whole copies and
    its inclusion probability.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{text_col}`")).alias("text_hash"))
    rows = rows.withColumn("u", uniform(seed, "id", "text_hash"))
    narrow = materialize(rows.drop("doc"), "mix-sizes")
    targets = materialize(sample_levels(narrow, source_targets(narrow)), "mix-targets")
    ends = materialize(_decisions(narrow, targets), "mix-decisions")
    decided = _ranked(_with_source(rows, ends))
    copies = F.col("whole") + F.when(
        _sampled() | (F.col("extra").isNotNull() & (F.col("rank") == F.col("extra"))), 1).otherwise(0)
    return decided.withColumn("copies", copies.cast("long")).select(
        "doc", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        (F.col("whole") + F.col("p")).alias("expected_copies"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every input row as often as it is taken."""
    return mixed.filter(F.col("copies") > 0).select(
        "doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("doc.*")
