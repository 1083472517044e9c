"""Mix sources to target weights: entropy balancing by Newton's method, rounded into copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import hint_if_counted, n_words, stored

# A source gives at most this many times its own words, a document at most so many copies.
CAP = 3

# Weights of the sources in code point order, over and over.
WEIGHTS = (1, 2, 3)

# Newton steps. From 0 the dual variable moves by 1 at most in a step until it is near the solution.
STEPS = 64


def _turn(key: Column) -> Column:
    """The hashed order in which documents get an extra copy; the same in every run."""
    return F.md5(key.cast("string"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: number of words of each whole text."""
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))


def targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, source_size, target)``: all words shared by weight, with no source above ``cap`` times its own.

    Sharing the excess anew until nobody is above the limit ends where all open sources stand at one level of
    words per weight. Sorted by the level at which each source is full, that level is found with running sums.
    One row per source goes through these windows, never documents.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth % len(weights) + 1).cast("int"))
    own = own.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * cap)
    rising = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    full = F.coalesce(F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    own = own.select(
        "source", "source_size", "weight", "most",
        (F.sum("source_size").over(everything) - full).alias("left_words"), open_weight.alias("open_weight"),
    )
    fits = F.col("left_words").cast("double") / F.col("open_weight") <= F.col("most").cast("double") / F.col("weight")
    level = F.min(F.when(fits, F.struct(F.col("most") / F.col("weight"), "left_words", "open_weight"))).over(everything)
    share = F.col("weight").cast("double") * level["left_words"] / level["open_weight"]
    return own.select(
        "source", "source_size", F.coalesce(F.least(share, F.col("most").cast("double")), F.lit(0.0)).alias("target")
    )


def rates(goal: DataFrame, steps: int = STEPS) -> DataFrame:
    """Add ``rate``, the expected copies of each document of a source.

    Of all rates that meet the constraints (the words taken from a source are its target), entropy balancing takes
    those nearest to one copy each, by relative entropy of the words. Their form is an exponential tilt, the rate of a
    document being exp of the sum of the dual variables of its constraints. The dual is convex; a Newton step on
    sum(size * exp(l)) - target * l is l - 1 + target / (size * exp(l)). A document has one constraint, so the sums
    over documents in gradient and Hessian are exp(l) times the words of the source: the grouped sums are all that the
    steps need of the documents, and the sources are solved side by side where their rows lie.
    """
    ratio = F.col("target") / F.col("source_size")
    tilt = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), lambda l, _: l - 1 + ratio * F.exp(-l))
    return goal.withColumn("rate", F.when(F.col("target") > 0, F.exp(tilt)).otherwise(0.0))


def mixing_plan(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: ``source, source_size, target, rate, copies, last_hash, last_id``.

    The whole part of the rate is given to every document. The rest is given to the documents that come first in a
    hashed order, up to the one with which the words taken come nearest to the target: an error of half a document
    at most, however sizes are spread. That document is found in two steps, by sums over 4,096 ranges of the order and
    then in the one range where the target is passed, so that no task sorts a source.
    """
    goal = stored(rates(targets(sizes, cap, weights)), "rates")
    n = goal.count()
    goal = goal.withColumn("copies", F.least(F.floor("rate"), F.lit(cap)))
    goal = stored(goal.withColumn("extra", F.col("target") - F.col("copies") * F.col("source_size")), "goal")
    turn = _turn(F.col("doc_id"))
    keyed = sizes.select("source", "doc_id", "size", turn.alias("hash"), F.substring(turn, 1, 3).alias("range"))
    spread = keyed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy(F.col("range").asc_nulls_first())
    spread = spread.withColumn("before", F.sum("words").over(upto.rowsBetween(Window.unboundedPreceding, -1)))
    extra = goal.select(F.col("source").alias("of"), "extra")
    spread = spread.withColumn("before", F.coalesce("before", F.lit(0))).join(
        hint_if_counted(extra, n), F.col("source").eqNullSafe(F.col("of"))
    )
    # The last range that begins before the target (its words may still all fit).
    at = spread.where("before <= extra").groupBy("of").agg(
        F.max(F.struct("before", "range", "extra")).alias("last"), F.first("source").alias("source")
    )
    at = stored(at.select(F.col("source").alias("of"), F.col("last.range").alias("in_range"), "last.before", "last.extra"), "ranges")
    near = keyed.join(
        hint_if_counted(at, n), F.col("source").eqNullSafe(F.col("of")) & F.col("range").eqNullSafe(F.col("in_range"))
    )
    order = Window.partitionBy("source").orderBy(F.col("hash").asc_nulls_first(), F.col("doc_id").asc_nulls_first())
    passed = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    near = near.select("source", "hash", "doc_id", ((passed - F.col("size") / 2) <= F.col("extra")).alias("taken"), "in_range")
    last = near.groupBy("source").agg(
        F.max(F.when(F.col("taken"), F.struct(F.coalesce("hash", F.lit("")).alias("hash"), "doc_id"))).alias("last"),
        F.first("in_range").alias("in_range"),
    )
    last = last.select(
        F.col("source").alias("of"),
        F.coalesce("last.hash", "in_range").alias("last_hash"),  # none in the range: all before it
        F.col("last.doc_id").alias("last_id"),
    )
    joined = goal.join(last, F.col("source").eqNullSafe(F.col("of")), "left")
    return joined.select("source", "source_size", "target", "rate", "copies", "last_hash", "last_id")


def with_copies(docs: DataFrame, plan: DataFrame, into: str = "copies") -> DataFrame:
    """``docs`` with the number of copies that the mix takes of each row. The plan has one row per source, is
    counted, and broadcast if small, so that texts stay where they are."""
    rows = plan.count()
    own = plan.select(
        *(F.col(c).alias(f"_{c}") for c in ("source", "copies", "last_hash", "last_id")),
        *(F.col(c).alias(f"_{c}") for c in ("source_size", "target")),
    )
    hashed = F.coalesce(_turn(F.col("doc_id")), F.lit(""))
    first = (hashed < F.col("_last_hash")) | (
        (hashed == F.col("_last_hash")) & (F.col("doc_id").eqNullSafe(F.col("_last_id")) | (F.col("doc_id") <= F.col("_last_id")))
    )
    # Without extra copies for anybody there is no last document.
    first = F.coalesce(first, F.lit(False))
    joined = docs.join(hint_if_counted(own, rows), F.col("source").eqNullSafe(F.col("_source")), "left")
    return joined.withColumn(into, F.coalesce(F.col("_copies") + first.cast("int"), F.lit(0)).cast("int"))


def mix(docs: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)``, one row per document.

    Null texts have no words; a null source is a source, the last one. A document without words counts for nothing
    and may be copied or not. A null doc_id comes first in the hashed order; rows that share a doc_id get the same
    number of copies. With no words at all every target is 0. No rows give no rows; other columns are ignored.
    """
    sizes = stored(document_sizes(docs), "sizes")
    copied = with_copies(sizes, stored(mixing_plan(sizes, cap, weights), "plan"))
    return copied.select(
        "doc_id",
        "size",
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        "copies",
    )
