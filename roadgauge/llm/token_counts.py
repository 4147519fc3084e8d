"""Token counts by a Viterbi pass that carries only the best score and its number of pieces.

An Aho-Corasick automaton enumerates the vocabulary's matches; for each end the start with the best score is
kept, and of equal scores the earliest start, as the tokenizers library's unigram model does (it visits starts in order and replaces on
a strictly better score). A character without a piece of its own may be unknown, at the lowest score less 10, and counts
its UTF-8 bytes. No piece crosses from another character to a space mark, nor over a line end, so the pass
runs over words, and a worker counts each word once.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from roadgauge.llm import common

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Score of pieces that are no text (control and byte pieces): below any way through their characters.
NO_TEXT = -1e9
MOST_WORDS = 400_000
SEGMENT = re.compile(rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, read as a unigram vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), NO_TEXT if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) else model.get_score(i))
        for i in range(model.get_piece_size())
    ]


class Counter(dict):
    """(pieces, score) by segment, computed when first asked for; bounded by two generations."""

    def __init__(self, path: str):
        import ahocorasick

        super().__init__()
        pieces = vocabulary(path)
        for piece, _ in pieces:
            if SPACE in piece.lstrip(SPACE) or ("\n" in piece and len(piece) > 1):
                raise ValueError("a piece that crosses a space or a line end needs whole texts")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.singles = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.old: dict[str, tuple[int, float]] = {}

    def __missing__(self, segment: str) -> tuple[int, float]:
        found = self.old.get(segment) or self.viterbi(segment)
        if len(self) > MOST_WORDS:
            self.old = dict(self)
            self.clear()
        self[segment] = found
        return found

    def viterbi(self, segment: str) -> tuple[int, float]:
        n = len(segment)
        best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        plain = self.singles.issuperset(segment)
        done = 0  # ends up to here have met their unknown character
        for end, (size, score) in self.automaton.iter(segment):  # by end, longest first: starts in order
            if not plain:
                while done < end:
                    done += 1
                    self._unknown(segment, done, best, count)
            end += 1
            candidate = best[end - size] + score
            if candidate > best[end]:
                best[end], count[end] = candidate, count[end - size] + 1
        if not plain:
            while done < n:
                done += 1
                self._unknown(segment, done, best, count)
        return count[n], best[n]

    def _unknown(self, segment: str, end: int, best: list[float], count: list[int]) -> None:
        char = segment[end - 1]
        if char not in self.singles:
            candidate = best[end - 1] + self.unknown
            if candidate > best[end]:
                best[end], count[end] = candidate, count[end - 1] + len(char.encode("utf-8", "surrogatepass"))

    def text(self, text: str) -> tuple[int, float]:
        """Pieces and score of a text; it begins with a space mark, unless it is empty."""
        if not text:
            return 0, 0.0
        total, score = 0, 0.0
        for n, own in map(self.__getitem__, SEGMENT.findall(SPACE + text.replace(" ", SPACE))):
            total += n
            score += own
        return total, score


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and best_score of every row. A null or empty text has no tokens and score 0.

    Repeated rows are counted each; no shuffle; memory is a batch and the bounded memo.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path)
        found = [own.text(text or "") for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([score for _, score in found], pa.float64())],
            ["doc_id", "n_tokens", "best_score"])

    return common.map_batches(common.id_and_text(docs), run, "doc_id long, n_tokens long, best_score double")
