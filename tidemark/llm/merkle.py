"""Merkle manifest of a dataset: a tree of fanout 8 over each group's rows, and one over the groups' roots.

Slot pivot: the children of each parent are spread into one column per slot by conditional aggregates. The
columns put together hash to the parent; with the own slot left out they are a child's siblings.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import hint_if_counted, stored
from tidemark.operators.ordered import rank_within

FANOUT = 8

# Fields of a document that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of texts put together; a null part adds nothing."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value so that where it ends is known: byte count, colon, value; ``-`` for a null."""
    said = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said), F.lit("-"))


def lowered(text: Column) -> Column:
    """A-Z in lower case and no other letter changed; texts of ASCII alone take the quick way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, A_Z, A_Z.lower())
    )


def leaves(docs: DataFrame, fields: Sequence[str], group: str, key: str, text: str, altered: Column) -> DataFrame:
    """``(group, key, leaf, forged)``: the digest of a row, and that of the row with its text lower-cased where
    ``altered`` holds and this changes it, else null. Texts go no further than this."""
    cover = lambda body: digest(*(field(body if c == text else F.col(c)) for c in fields))
    leaf = cover(F.col(text))
    changed = F.coalesce(altered, F.lit(False)) & F.col(text).rlike("[A-Z]")
    return docs.select(
        F.col(group).alias("group"), F.col(key).alias("key"), leaf.alias("leaf"),
        F.when(changed, cover(lowered(F.col(text)))).alias("forged"),
    )


def _slots(fanout: int, name: str = "s") -> list[Column]:
    return [F.col(f"{name}{k}") for k in range(fanout)]


def _pivoted(nodes: DataFrame, carried: Sequence[str], fanout: int) -> DataFrame:
    """One row per parent: the digest of its child in slot k is column ``s<k>``, what the child carries ``<name><k>``."""
    slot = F.pmod("i", F.lit(fanout))
    columns = [("hash", "s"), *((c, c) for c in carried)]
    spread = [F.max(F.when(slot == k, F.col(c))).alias(f"{name}{k}") for c, name in columns for k in range(fanout)]
    parent = F.floor(F.col("i") / fanout).cast("long").alias("i")
    return nodes.groupBy("group", parent, "n").agg(*spread)


def ascend(nodes: DataFrame, largest: int, carried: Sequence[str], label: str, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """Fold each group of ``(group, i, n, hash, carried...)`` to one node; n is the group's size, i counts from 0.

    Gives the pivot of each level, lowest first, and ``(group, hash)`` of what remains. A group of one node has no
    level. There are as many levels as the logarithm of the largest group.
    """
    pivots, ends, level = [], [nodes.where("n = 1").select("group", "hash")], nodes
    while largest > 1:
        pivots.append(stored(_pivoted(level.where("n > 1"), () if pivots else carried, fanout), f"{label}-{len(pivots)}"))
        up = F.ceil(F.col("n") / fanout).cast("long").alias("n")
        level = pivots[-1].select("group", "i", up, digest(*_slots(fanout)).alias("hash"))
        ends.append(level.where("n = 1").select("group", "hash"))
        largest = -(-largest // fanout)
    return pivots, stored(reduce(DataFrame.unionByName, ends), f"{label}-ends")


def _children(parents: DataFrame, carried: Sequence[str], fanout: int) -> DataFrame:
    """The children of parents that know their path: its steps, after the step from the child to the parent. A step
    is the siblings left of the own slot, put together, and those right of it."""
    slots = _slots(fanout)
    joined = lambda some: F.concat_ws("", *some) if some else F.lit("")
    each = [
        F.struct(
            (F.col("i") * fanout + k).alias("i"), slots[k].alias("hash"),
            joined(slots[:k]).alias("l"), joined(slots[k + 1 :]).alias("r"),
            *(F.col(f"{c}{k}").alias(c) for c in carried),
        )
        for k in range(fanout)
    ]
    one = parents.select("group", "subroot", "path", F.explode(F.array(*each)).alias("c")).where("c.hash is not null")
    path = F.concat(F.array(F.struct("c.l", "c.r")), "path").alias("path")
    return one.select("group", "c.i", "c.hash", "subroot", path, *(f"c.{c}" for c in carried))


def _with_paths(rows: DataFrame, paths: DataFrame, on: Sequence[str]) -> DataFrame:
    p, q = rows.alias("p"), paths.alias("q")
    match = reduce(Column.__and__, [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in on])
    return p.join(q, match).select("p.*", "q.subroot", "q.path")


def descend(pivots: Sequence[DataFrame], nodes: DataFrame, tops: DataFrame, carried: Sequence[str], fanout: int = FANOUT) -> DataFrame:
    """``(group, i, hash, subroot, path, carried...)`` of each node; ``tops`` is ``(group, subroot, path)``, the steps
    that follow above the group. Paths are made from the top downwards, each once for all nodes below it."""
    paths = None
    for level in range(len(pivots) - 1, -1, -1):
        pivot = pivots[level]
        known = _with_paths(pivot.where(F.col("n") <= fanout), tops, ["group"])  # a parent of a whole group
        if paths is not None:
            known = known.unionByName(_with_paths(pivot.where(F.col("n") > fanout), paths, ["group", "i"]))
        paths = _children(known, () if level else carried, fanout)
    alone = _with_paths(nodes.where("n = 1").select("group", "i", "hash", *carried), tops, ["group"])
    return alone if paths is None else paths.unionByName(alone)


def folded(own: Column, path: Column) -> Column:
    """The root that a node and its path give."""
    return F.aggregate(path, own, lambda h, s: digest(s["l"], h, s["r"]))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    key: str = "doc_id",
    text: str = "text",
    altered: Column | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``, one row per row of ``docs``.

    A leaf is the digest of a row's fields. Of each group (null is one) the leaves ascend by key, and ``fanout``
    consecutive nodes become their digest until one remains, the subroot; subroots, in bytewise order of their
    groups, null first, go on to the root in the same way. ``proof_sha256`` is the digest of all siblings on the
    way up. ``folded_root`` is what the leaf and those siblings fold to; where ``altered`` holds (by default: 3
    divides the CRC-32 of the key), the row's text is lower-cased (A-Z only) before.

    Rows are numbered by prefix sums over ranges, so no group is sorted in one task; what is shuffled is digests,
    never texts. Each level has an eighth of the rows of the one below, and is written out. Leaves of a group that
    repeat their key are ordered by their digest; equal rows are all kept, and differ in their siblings. A null key
    comes first and is not altered. A group of one row has no level: its leaf is the subroot. No rows give no rows.
    """
    if altered is None:
        altered = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 0
    told = leaves(docs, fields, group, key, text, altered)
    told = stored(told.withColumn("row", F.monotonically_increasing_id()), "leaves")
    sizes = stored(told.groupBy("group").agg(F.count("*").alias("n")), "sizes")
    groups, largest = sizes.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    ranked = rank_within(told, ["group"], ["key", "leaf"], "row").alias("t")
    nodes = ranked.join(hint_if_counted(sizes, groups).alias("s"), F.col("t.group").eqNullSafe(F.col("s.group")))
    nodes = nodes.select("t.group", (F.col("rank") - 1).alias("i"), "n", F.col("leaf").alias("hash"), "key", "forged")
    nodes = stored(nodes, "nodes")
    pivots, subroots = ascend(nodes, largest, ("key", "forged"), "level", fanout)

    # The tree over the groups is one group more, whose nodes are the subroots.
    named = subroots.select(F.lit(0).alias("all"), F.col("group").alias("of"), F.col("group").cast("binary").alias("name"), "hash")
    ordered = rank_within(named, ["all"], "name", "hash")
    ordered = ordered.select(F.col("all").alias("group"), (F.col("rank") - 1).alias("i"), F.lit(groups).cast("long").alias("n"), "hash", "of")
    ordered = stored(ordered, "subroots-in-order")
    above, root = ascend(ordered, groups, ("of",), "top", fanout)
    end = root.select("group", F.col("hash").alias("subroot"), F.array().cast("array<struct<l:string,r:string>>").alias("path"))
    over = descend(above, ordered, end, ("of",), fanout)
    tops = stored(over.select(F.col("of").alias("group"), F.col("hash").alias("subroot"), "path"), "tops")

    told_root = (root.first() or {"hash": None})["hash"]
    out = descend(pivots, nodes, tops, ("key", "forged"), fanout).select(
        F.col("key").alias("doc_id"),
        F.col("hash").alias("leaf"),
        "subroot",
        F.lit(told_root).cast("string").alias("root"),
        F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "").cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("forged", "hash"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
