"""Message threads: a table of ``(thread, turn, role, text)``, turns unique within a thread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordered import rank_within, running_total, top_n_per_key


def ordered_messages(
    df: DataFrame, thread: str = "conv_id", turn: str = "turn", partitions: int | None = None
) -> DataFrame:
    """Every message with its position in the thread, from 1: the same rows however long a thread is."""
    return rank_within(df, [thread], turn, turn, name="position", partitions=partitions)


def fold_threads(df: DataFrame, thread: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per thread of any length, with its ordered messages: a last step, for threads that fit in a row.

    Work that must not hold a whole thread in one row goes on from ``ordered_messages``.
    """
    messages = F.array_sort(F.collect_list(F.struct(turn, "role", "text"))).alias("messages")
    return df.groupBy(thread).agg(messages).withColumn("n_messages", F.size("messages"))


def last_messages(df: DataFrame, n: int, thread: str = "conv_id", turn: str = "turn") -> DataFrame:
    return top_n_per_key(df, [thread], [F.col(turn).desc()], n)


def latest_state(df: DataFrame, value: Column, name: str, thread: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Newest non-NULL value of a state field per thread, and the turn that wrote it."""
    written = df.withColumn("_v", value)
    when_written = F.when(F.col("_v").isNotNull(), F.col(turn))
    return written.groupBy(thread).agg(
        F.max_by("_v", when_written).alias(name), F.max(when_written).alias("written_at")
    )


def drop_role(df: DataFrame, role: str) -> DataFrame:
    """Remove one role's messages; a message without a role stays."""
    return df.filter(~F.col("role").eqNullSafe(role))


def over_budget(
    df: DataFrame,
    size: Column,
    budget: int,
    keep: int = 1,
    thread: str = "conv_id",
    turn: str = "turn",
    partitions: int | None = None,
) -> DataFrame:
    """Running size per thread, whether it has passed ``budget``, and whether a trim to the newest
    ``keep`` messages would keep the message."""
    sized = df.withColumn("_size", size)
    running = running_total(sized, [thread], turn, F.col("_size"), "running_size", partitions)
    # One row per thread: its whole size, and the turn of the oldest message that stays.
    totals = sized.groupBy(thread).agg(F.coalesce(F.sum("_size"), F.lit(0)).alias("_total"))
    newest = top_n_per_key(df.select(thread, turn), [thread], [F.col(turn).desc()], keep)
    edges = newest.groupBy(thread).agg(F.min(turn).alias("_edge"))
    trimmed = totals.filter(F.col("_total") >= budget).join(edges, thread).select(thread, "_edge")
    return running.join(trimmed, thread, "left").select(
        *[c for c in running.columns if c != "_size"],
        (F.col("running_size") >= budget).alias("over_budget"),
        (F.col("_edge").isNull() | (F.col(turn) >= F.col("_edge"))).alias("kept"),
    )


def route_by_count(
    df: DataFrame, limit: int = 10, thread: str = "conv_id", above: str = "large", otherwise: str = "standard"
) -> DataFrame:
    """One row per thread: threads of more than ``limit`` messages go to ``above``."""
    counts = df.groupBy(thread).agg(F.count(F.lit(1)).alias("n_messages"))
    return counts.withColumn("route", F.when(F.col("n_messages") > limit, above).otherwise(otherwise))
