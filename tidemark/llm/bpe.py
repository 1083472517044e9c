"""Byte-level BPE: exact encoding of texts of any length by joining leaves in a tree, and decoding."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from tidemark.llm.common import map_batches, same_type, texts

# Code points of a leaf. A longer text is cut into leaves that are encoded in parallel tasks.
LEAF_CHARS = 16_384

# Tokens on each side of a join that the first window covers; windows double until both sides agree.
WINDOW = 16

# Fixed value: the published split pattern of byte-level BPE (the tokenizer file says only "use_regex").
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: printable Latin-1 stands for itself,
    the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """One tokenizer file, ready to encode and decode. Only byte-level BPE with ids in merge order is accepted,
    as then the lowest id is the first merge and a plain rank table gives the file's own encoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError("needs a byte-level BPE tokenizer without prefix space")
        if spec["normalizer"] or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
            raise ValueError("needs a tokenizer without normalizer and with plain added tokens")
        byte = _byte_of_char()
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(set(made)):
            raise ValueError("needs token ids in the order of the merges")
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.fast = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.split = Tokenizer.from_file(path).pre_tokenizer
        size = max([*ranks.values(), *special.values()]) + 1
        self.bytes_of = np.full(size, b"", dtype=object)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self.length_of = np.array([len(b) for b in self.bytes_of], dtype=np.int64)

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text in which added tokens mean nothing."""
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def parts(self, text: str) -> list[tuple[int | None, str]]:
        """The stretches between added tokens, as ``(None, text)``, and the added tokens as ``(id, text)``."""
        if not self.special:
            return [(None, text)]
        return [(self.special[p] if i % 2 else None, p) for i, p in enumerate(self.cut.split(text)) if p]

    def encode(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            return self.plain(text)
        ids = [self.plain(p) if i is None else np.array([i], np.int32) for i, p in self.parts(text)]
        return np.concatenate([np.empty(0, np.int32), *ids])

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.bytes_of[ids].tolist()).decode("utf-8", "replace")

    def word_starts(self, text: str) -> np.ndarray:
        """Byte offsets at which the pre-tokenizer begins a word (each of its characters stands for a byte)."""
        sizes = [len(w) for w, _ in self.split.pre_tokenize_str(text)]
        return np.cumsum([0, *sizes], dtype=np.int64)[: len(sizes)]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


@dataclass
class Piece:
    """An encoded stretch: its bytes, its ids, where each token starts, and where each word starts."""

    data: bytes
    ids: np.ndarray
    starts: np.ndarray
    words: np.ndarray

    @staticmethod
    def of(c: Codec, data: bytes, ids: np.ndarray | None = None, words: np.ndarray | None = None) -> Piece:
        text = data.decode()
        ids = c.plain(text) if ids is None else ids
        starts = np.cumsum(c.length_of[ids]) - c.length_of[ids]
        return Piece(data, ids, starts, c.word_starts(text) if words is None else words)


def _whole(data: bytes, at: int) -> bool:
    """Whether a character begins (or the text ends) at byte ``at``."""
    return at >= len(data) or data[at] & 0xC0 != 0x80


def _back(data: bytes, at: int, chars: int) -> int:
    """The byte offset ``chars`` characters before ``at``, 0 at the least."""
    while chars and at > 0:
        at -= 1
        chars -= data[at] & 0xC0 != 0x80
    return at


def _left_edge(a: Piece, n: int) -> tuple[int, bool]:
    """Where a window of some ``n`` tokens begins in ``a``: the byte, and whether a word begins there.

    What comes before must not depend on what follows ``a``. A word start with two characters after it
    is final, as the pattern looks at two characters after a word at most. Inside a word so long that no
    such start is near, a token start will do that lies two characters before the word's end.
    """
    near = a.starts[max(0, len(a.ids) - n)] if len(a.ids) else 0
    safe = _back(a.data, len(a.data), 2)
    k = int(np.searchsorted(a.words, min(near, safe), "right")) - 1
    if k < 0:
        return 0, True
    word = int(a.words[k])
    behind = int(np.searchsorted(a.starts, word))
    if len(a.ids) - behind <= 4 * n:
        return word, True
    end = int(a.words[k + 1]) if k + 1 < len(a.words) else len(a.data)
    i = int(np.searchsorted(a.starts, near))
    while i > behind and not (_whole(a.data, int(a.starts[i])) and a.starts[i] <= _back(a.data, end, 2)):
        i -= 1
    return (int(a.starts[i]), False) if i > behind else (word, True)


def join(c: Codec, a: Piece, b: Piece, n: int = WINDOW) -> Piece:
    """The encoding of ``a`` and ``b`` in one, from theirs and from a window around the join.

    The window begins and ends at token starts and is encoded on its own. It agrees with ``b`` from a word
    start on that both have (two characters before the window's end or more: from there on they read the
    same text), or, inside a word that goes beyond the window, from a token on that both have at the same
    place. On the left the window begins at a final word start of ``a``, or in a long word with the very
    token that ``a`` has there. In a long word this is exact, as a sequence of tokens is the BPE encoding
    of a word if and only if each pair of neighbours is that of its own bytes, and all neighbours of the
    result are neighbours in ``a``, in ``b`` or in the window. If a side disagrees, the window doubles;
    at the latest the window that holds both sides whole is right.
    """
    if not a.data or not b.data:
        return b if not a.data else a
    while True:
        at, fresh = _left_edge(a, n)
        j = n
        while j < len(b.ids) and not _whole(b.data, int(b.starts[j])):
            j += 1
        until = int(b.starts[j]) if j < len(b.ids) else len(b.data)
        w = Piece.of(c, a.data[at:] + b.data[:until])
        i = int(np.searchsorted(a.starts, at))
        shift = len(a.data) - at  # of an offset in b to one in the window
        seam = None
        if fresh or (len(w.ids) and i < len(a.ids) and w.ids[0] == a.ids[i]):
            if until == len(b.data):
                seam = until
            else:
                seam = _agreement(w, b, shift, until)
        if seam is not None:
            break
        if at == 0 and until == len(b.data):
            raise AssertionError("a window over everything agrees with itself")
        n *= 2
    keep = int(np.searchsorted(w.starts, seam + shift))
    rest = int(np.searchsorted(b.starts, seam))
    ids = np.concatenate([a.ids[:i], w.ids[:keep], b.ids[rest:]])
    mine = w.words[(w.words < seam + shift) & ((w.words > 0) | fresh)]
    starts = np.concatenate([a.starts[:i], w.starts[:keep] + at, b.starts[rest:] + len(a.data)])
    begun = np.concatenate([a.words[a.words < at], mine + at])
    begun = np.concatenate([begun, b.words[b.words >= seam] + len(a.data)])
    return Piece(a.data + b.data, ids, starts, begun)


def _agreement(w: Piece, b: Piece, shift: int, until: int) -> int | None:
    """The offset in ``b`` from which the window and ``b`` agree, or none."""
    final = _back(w.data, len(w.data), 2) - shift
    both = np.intersect1d(w.words - shift, b.words[b.words <= final])
    both = both[(both >= 0) & (both <= final)]
    if len(both):
        return int(both[0])
    # No common word start: a word of the window must reach its end, and one of b beyond it.
    last = int(w.words[-1]) - shift
    k = int(np.searchsorted(b.words, until, "left")) - 1
    word, after = int(b.words[k]), int(b.words[k + 1]) if k + 1 < len(b.words) else len(b.data)
    if after < until or until - max(last, word) < 8:
        return None
    lo, hi = max(last, word) + 4, _back(w.data, len(w.data), 2) - shift
    wi = np.flatnonzero((w.starts - shift >= lo) & (w.starts - shift < hi))
    at = {int(s): int(t) for s, t in zip(w.starts[wi] - shift, w.ids[wi], strict=True)}
    for j in np.flatnonzero((b.starts >= lo) & (b.starts < hi)):
        s = int(b.starts[j])
        if at.get(s) == int(b.ids[j]) and _whole(b.data, s):
            return s
    return None


def join_all(c: Codec, pieces: list[Piece], window: int = WINDOW) -> Piece:
    """Join neighbours, then the joined, until one is left."""
    while len(pieces) > 1:
        paired = [join(c, a, b, window) for a, b in zip(pieces[::2], pieces[1::2], strict=False)]
        pieces = paired + pieces[len(paired) * 2 :]
    return pieces[0]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))


def encode(docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS, window: int = WINDOW) -> DataFrame:
    """``(doc_id, ids)``: the ids that the tokenizer file gives for each whole text, added tokens in it
    included, none added.

    A text of up to ``leaf_chars`` code points is encoded where it lies. A longer one is cut anywhere into
    leaves of that size, these are dealt to all tasks and encoded, and the leaves of a text are joined in a
    tree (see ``join``). Only long texts are shuffled, and a task never holds more than one of them.

    A null text counts as the empty one and gives no ids. Repeated rows stay repeated, a null doc_id stays
    null, other columns are left out, no rows give no rows.
    """
    frame = texts(docs)
    key = same_type(frame, "doc_id", "doc_id")
    out = StructType([key, StructField("ids", ArrayType(IntegerType(), False))])

    def short():
        c = codec(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [c.encode(t) for t in batch.column("text").to_pylist()]
            return pa.record_batch([batch.column("doc_id"), _lists(found)], ["doc_id", "ids"])

        return run

    def leaves():
        c = codec(path)

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for row, doc, text in zip(*(batch.column(x) for x in ("row", "doc_id", "text")), strict=True):
                cut = [
                    (special, part[i : i + leaf_chars])
                    for special, part in c.parts(text.as_py())
                    for i in range(0, len(part), leaf_chars if special is None else len(part))
                ]
                stretch = np.cumsum([0] + [x[0] is not None or y[0] is not None for x, y in zip(cut, cut[1:], strict=False)])
                n = len(cut)
                yield pa.record_batch(
                    [
                        pa.array([row.as_py()] * n, pa.int64()),
                        pa.array([doc.as_py()] * n, batch.schema.field("doc_id").type),
                        pa.array(stretch, pa.int64()),
                        pa.array(range(n), pa.int64()),
                        pa.array([x[0] for x in cut], pa.int32()),
                        pa.array([x[1] for x in cut], pa.string()),
                    ],
                    ["row", "doc_id", "stretch", "leaf", "special", "text"],
                )

        return run

    def encode_leaves():
        c = codec(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            plain, special = batch.column("text").to_pylist(), batch.column("special").to_pylist()
            ids = [c.plain(t) if s is None else np.array([s], np.int32) for t, s in zip(plain, special, strict=True)]
            begun = [c.word_starts(t).astype(np.int32) for t in plain]
            return pa.RecordBatch.from_arrays([*batch.columns, _lists(ids), _lists(begun)], schema=to)

        to = pa.schema([*batch_schema, pa.field("ids", pa.list_(pa.int32())), pa.field("words", pa.list_(pa.int32()))])
        return run

    def tree(leaf: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        done = []
        for _, part in leaf.sort_values("leaf").groupby("stretch", sort=True):
            if part["special"].notna().any():
                done += [np.asarray(x, np.int32) for x in part["ids"]]
                continue
            rows = zip(part["text"], part["ids"], part["words"], strict=True)
            pieces = [Piece.of(c, t.encode(), np.asarray(i, np.int32), np.asarray(w, np.int64)) for t, i, w in rows]
            done.append(join_all(c, pieces, window).ids)
        return pd.DataFrame({"doc_id": leaf["doc_id"].iloc[:1].values, "ids": [np.concatenate(done)]})

    is_long = F.length("text") > leaf_chars
    long = frame.where(is_long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    cut = StructType(
        [StructField("row", LongType()), key, StructField("stretch", LongType()), StructField("leaf", LongType())]
        + [StructField("special", IntegerType()), StructField("text", StringType())]
    )
    batch_schema = _arrow(cut)
    more = [StructField("ids", ArrayType(IntegerType())), StructField("words", ArrayType(IntegerType()))]
    leaf = map_batches(map_batches(long, leaves, cut).repartition("row", "leaf"), encode_leaves, StructType([*cut, *more]))
    joined = leaf.groupBy("row").applyInPandas(tree, out)
    return map_batches(frame.where(~is_long), short, out).unionByName(joined)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Replace the column of ids by the text they stand for, added tokens included; bytes that are no UTF-8
    become U+FFFD. Null ids give a null text; all other columns stay."""
    out = StructType([*(f for f in encoded.schema if f.name not in (ids, into)), StructField(into, StringType())])
    keep = [f.name for f in out if f.name != into]

    def make():
        c = codec(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column(ids)
            values = lists.values.to_numpy(zero_copy_only=False)
            bounds = lists.offsets.to_numpy()
            found = [
                c.decode(values[a:b]) if there else None
                for a, b, there in zip(bounds, bounds[1:], lists.is_valid().to_pylist(), strict=False)
            ]
            return pa.record_batch([*(batch.column(k) for k in keep), pa.array(found, pa.string())], [*keep, into])

        return run

    return map_batches(encoded.select(*keep, ids), make, out)


def digests(docs: DataFrame, path: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Encode, then decode; per row doc_id, n_tokens, and SHA-256 of the ids and of the decoded text."""
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    told = encode(docs, path, leaf_chars).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        "ids",
    )
    return decode(told, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
