"""Vector expressions and the default text embedder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, functions as F

from tidemark.functions.columns import as_column

EPSILON = 1e-10  # Fixed value: keeps the quotient defined for zero vectors.

Embedder = Callable[[Sequence[str]], np.ndarray]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def _product(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity of two array columns, in double precision."""
    x, y = as_column(a), as_column(b)
    norms = F.sqrt(_sum(_product(x, x))) * F.sqrt(_sum(_product(y, y)))
    return _sum(_product(x, y)) / (norms + F.lit(EPSILON))


class _Hashes(dict):
    """Hash by token; what is known is found without a call of Python code, and forgotten once it is too much."""

    MOST = 1 << 17

    def __missing__(self, token: str) -> int:
        if len(self) >= self.MOST:
            self.clear()
        self[token] = found = int.from_bytes(hashlib.md5(token.encode()).digest()[:4])
        return found


_hashes = _Hashes()

# Tokens that are counted at once: memory does not grow with the number of texts.
TOKENS = 1 << 16


def hashed_embedder(dim: int = 64) -> Embedder:
    """Term counts hashed into ``dim`` slots, over lower-cased tokens between spaces or newlines.

    An offline stand-in for a remote embedding model: it fixes the data flow, not the quality.
    """

    def counts(tokens: list[str], ends: list[int]) -> np.ndarray:
        slots = np.fromiter(map(_hashes.__getitem__, tokens), np.int64, len(tokens)) % dim
        lengths = np.diff(ends, prepend=0)
        full = np.fromiter(map(bool, tokens), bool, len(tokens))
        places = (np.repeat(np.arange(len(ends)) * dim, lengths) + slots)[full]
        return np.bincount(places, minlength=len(ends) * dim).reshape(len(ends), dim)

    def embed(texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        tokens: list[str] = []
        ends: list[int] = []
        for row, text in enumerate(texts, 1):
            tokens += (text or "").lower().replace("\n", " ").split(" ")
            ends.append(len(tokens))
            if len(tokens) >= TOKENS or row == len(texts):
                out[row - len(ends) : row] = counts(tokens, ends)
                tokens, ends = [], []
        return out

    return embed
