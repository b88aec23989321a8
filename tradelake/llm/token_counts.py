"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton over the pieces enumerates all matches in one pass.
For every end the best score and the number of pieces of the best path are
carried; no path is kept.  The rules are those of the ``tokenizers`` library's
Unigram model with Metaspace splitting: a path to the same end replaces the
kept one only if its score is strictly larger, starts are tried from left to
right, a character without a piece of its own costs the smallest score less
ten, and with byte fallback stands for its UTF-8 bytes.

No tokenizer is trained.  The pieces are those of a public vocabulary, whose
model is a BPE: its scores are merge ranks and not probabilities.  Pieces are in
the order of merges, which is that of their frequency, so each one's probability
is taken from its place by Zipf's law.  Nothing is normalised, so counts are those
of the ``tokenizers`` library's Unigram model over the same pieces and scores.

Words repeat, so counts of words are kept in a bounded cache of the worker
process.  Defined results: a null or empty text has no tokens and score 0; null
ids and repeated rows are counted like others; other columns are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
UNKNOWN_PENALTY = 10.0

VOCABULARY = "piece_bpe_32k.model"


class UnigramCounter:
    """Counts pieces of words; ``vocabulary``: (piece, score) pairs."""

    def __init__(self, vocabulary: list[tuple[str, float]], cached: int = 400_000):
        import ahocorasick

        known = {p for p, _ in vocabulary}
        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece and piece not in self.matches:
                self.matches.add_word(piece, (len(piece), float(score)))
        self.matches.make_automaton()
        self.singles = {p for p, _ in vocabulary if len(p) == 1}
        self.bytes = all(f"<0x{b:02X}>" in known for b in range(256))
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.cached, self.cache = cached, {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best path through one word."""
        n = len(word)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        fused = [False] * (n + 1)  # whether the path ends in an unknown character
        ends: list = [()] * n
        for end, match in self.matches.iter(word):  # longest first: starts from left to right
            ends[end] = (*ends[end], match) if ends[end] else (match,)
        for end in range(n):
            top, pieces, unknown = None, 0, False
            for size, score in ends[end]:
                at = end + 1 - size
                candidate = score + best[at]
                if top is None or candidate > top:
                    top, pieces, unknown = candidate, count[at] + 1, False
            if word[end] not in self.singles:
                candidate = self.unknown + best[end]
                if top is None or candidate > top:
                    if self.bytes:
                        more = len(word[end].encode("utf-8", "surrogatepass"))
                    else:
                        more = 0 if fused[end] else 1
                    top, pieces, unknown = candidate, count[end] + more, True
            best[end + 1], count[end + 1], fused[end + 1] = top, pieces, unknown
        return count[n], best[n]

    def text(self, text: str | None) -> tuple[int, float]:
        """(pieces, score) of a text; words begin at blanks."""
        if not text:
            return 0, 0.0
        marked = text.replace(" ", BLANK)
        words = marked.split(BLANK)
        if marked[0] == BLANK:
            del words[0]
        cache, pieces, score = self.cache, 0, 0.0
        for w in words:
            found = cache.get(w)
            if found is None:
                found = self.word(BLANK + w)
                if len(w) <= 64:
                    if len(cache) >= self.cached:
                        cache.clear()
                    cache[w] = found
            pieces += found[0]
            score += found[1]
        return pieces, score


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """Pieces of a SentencePiece model file (default: the public one) in the order
    of ids, with the logarithm of their probability by Zipf's law: 1 / place, all
    places summing to one."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    size = model.get_piece_size()
    total = math.log(math.fsum(1 / place for place in range(1, size + 1)))
    return [(model.id_to_piece(i), -math.log(i + 1) - total) for i in range(size)]


_COUNTERS: dict[int, UnigramCounter] = {}


def counter(pieces: tuple[tuple[str, float], ...]) -> UnigramCounter:
    """The counter of a vocabulary, kept in the worker until another one comes."""
    key = hash(pieces)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = UnigramCounter(list(pieces))
    return _COUNTERS[key]


def token_counts(docs: DataFrame, pieces: list[tuple[str, float]] | None = None) -> DataFrame:
    """doc_id, n_tokens and the score of the best path for every row, by the given
    (piece, score) pairs or else those of ``vocabulary``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = tuple(vocabulary() if pieces is None else pieces)

    def run(batches):
        c = counter(chosen)
        for batch in batches:
            found = [c.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "n_tokens", "score"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, score double")
