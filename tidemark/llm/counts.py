"""Token counts under a unigram vocabulary: Aho-Corasick matches and a Viterbi pass that only counts."""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemark.llm.common import map_batches, same_type, texts

# Fixed values of the unigram tokenizer: the mark for a space, and how far an unknown character's score lies
# below the lowest score of the vocabulary.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0

# Words whose counts a task remembers; when there are more it starts afresh.
REMEMBERED = 400_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file in id order (piece 0 is the unknown one)."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Best segmentation of a text, of which only score and number of pieces are kept.

    The unigram tokenizer gives a text the sequence of pieces with the highest sum of scores. At equal sums the
    path whose last piece begins earlier wins, that is the longer last piece. A character that no piece of length
    one covers may be an unknown piece; with byte fallback it counts as one piece for each of its UTF-8 bytes.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        known = pieces[1:]
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.longest = max(len(p) for p, _ in known)
        self.single = {p for p, _ in known if len(p) == 1}
        self.matches = ahocorasick.Automaton()
        for piece, score in known:
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        # Pieces hold a space mark only at their beginning, or nothing else: then no piece crosses from a word into
        # the next mark, every path parts there, and with whole-numbered scores sums are exact in any order.
        self.parts = all(SPACE not in p.lstrip(SPACE) for p, _ in known) and all(s == int(s) for _, s in known)
        self.seen: dict[str, tuple[int, float]] = {}

    def stretch(self, text: str) -> tuple[int, float]:
        """(pieces, score) of one stretch, in time linear in its length. Each end takes its matches with the longest
        first; only what is better than all before replaces it."""
        n, depth = len(text), self.longest + 1
        score, count = [0.0] * depth, [0] * depth  # a ring: the best up to each of the last few places
        at = 0
        found = self.matches.iter(text)
        match = next(found, None)
        for end in range(1, n + 1):
            here = []
            while match is not None and match[0] == end - 1:
                here.append(match[1])
                match = next(found, None)
            best, pieces = None, 0
            for length, gain in sorted(here, reverse=True):
                start = (end - length) % depth
                value = score[start] + gain
                if best is None or value > best:
                    best, pieces = value, count[start] + 1
            if text[end - 1] not in self.single:
                start = (end - 1) % depth
                value = score[start] + self.unknown
                if best is None or value > best:
                    best, pieces = value, count[start] + len(text[end - 1].encode())
            at = end % depth
            score[at], count[at] = best, pieces
        return (count[at], score[at]) if n else (0, 0.0)

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.parts:
            return self.stretch(marked)
        tokens, total = 0, 0.0
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        for part in _marked_words(marked):
            known = self.seen.get(part)
            if known is None:
                known = self.stretch(part)
                if len(part) <= 64:
                    self.seen[part] = known
            tokens += known[0]
            total += known[1]
        return tokens, total


def _marked_words(marked: str) -> list[str]:
    """Cut before each run of space marks that follows something else."""
    words = marked.split(SPACE)
    out, marks = [], 0
    for i, word in enumerate(words):
        marks += i > 0
        if word or i == len(words) - 1:
            if marks or word:
                out.append(SPACE * marks + word)
            marks = 0
    return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, score)``: how many pieces the unigram tokenizer makes of each whole text, and their summed
    scores. A space is written as a mark and one mark is put in front. Nothing is shuffled.

    A null or empty text has 0 tokens. Repeated rows and null ids stay as they are; other columns are left out; no
    rows give no rows. A word of any length takes linear time and a fixed number of cells.
    """
    frame = texts(docs)
    schema = StructType(
        [same_type(frame, "doc_id", "doc_id"), StructField("n_tokens", LongType()), StructField("score", DoubleType())]
    )

    def make():
        c = counter(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [c.count(t.as_py()) for t in batch.column("text")]
            tokens, scores = pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64())
            return pa.record_batch([batch.column("doc_id"), tokens, scores], schema.names)

        return run

    return map_batches(frame, make, schema)
