"""Language identification with segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all its
segmentations into pieces, by the forward algorithm; a text's is the product over its words. The probabilities are fitted
by expectation-maximisation: expected piece counts over all segmentations, from the forward and the backward pass.

Letter runs are lower-cased and scored whole, however long; sums are scaled anew every few letters. Each run is scored once per
worker and kept in a bounded memo.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadgauge.llm import common
from roadgauge.session import stage

#: Training rows per language, about: a fit on so many texts is all the classifier needs.
SAMPLE_PER_LANGUAGE = 1500
ROUNDS = 2
SMOOTHING = 0.05
#: Probability of a letter no piece has; and what each letter's probability is multiplied by, so that products stay in range.
UNKNOWN = 1e-7
SCALE = 20.0
#: Letters after which the sums of a word are scaled anew, so that words of any length stay in range.
STEP = 16
MOST_WORDS = 300_000
UNDETERMINED = "und"
RUN = re.compile(r"[^\W\d_]+")
_BUCKETS = 1 << 20


class Pieces:
    """Lower-case pieces of a sentencepiece model, found in texts by an Aho-Corasick automaton.

    The last id stands for a single unknown letter.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            letters = piece.removeprefix("▁")
            if letters == letters.lower() and (letters.isalpha() or not letters):
                found.setdefault(piece, len(found))
        self.size = len(found) + 1
        self.longest = max(map(len, found), default=1)
        self.automaton = ahocorasick.Automaton()
        for piece, i in found.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def lattice(self, words: list[str]):
        """Arcs (from, to, piece, length) over the joined words, sorted by their end's place in its word; bounds
        of equal places; and each word's first and last node."""
        marked = ["▁" + word for word in words]
        lengths = np.array([len(word) for word in marked], np.int64)
        first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        joined = "\n".join(marked)
        ends, values = [], []
        for end, value in self.automaton.iter(joined):
            ends.append(end)
            values.append(value)
        to = np.array(ends, np.int64) + 1
        values = np.array(values, np.int64).reshape(-1, 2)
        piece, size = values[:, 0], values[:, 1]
        letters = np.concatenate([np.arange(a, a + n) for a, n in zip(first.tolist(), lengths.tolist())])
        start = np.concatenate([to - size, letters])
        to = np.concatenate([to, letters + 1])
        piece = np.concatenate([piece, np.full(len(letters), self.size - 1)])
        place = to - np.repeat(first, lengths + 1)[np.minimum(to, len(joined))] if len(words) else to
        order = np.lexsort((to, place))
        start, to, piece, place = start[order], to[order], piece[order], place[order]
        bounds = np.searchsorted(place, np.arange(1, (place.max() if len(place) else 0) + 2))
        return start, to, piece, bounds, first, first + lengths

    def forward(self, lattice, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per node and language, the summed probability of all ways there, times SCALE per letter: the first array
        times e to the power of the second."""
        start, to, piece, bounds, first, last = lattice
        ways = np.zeros((int(last.max()) + 2, table.shape[1]))
        ways[first] = 1.0
        logs = np.zeros_like(ways)
        weights = table[piece] * (SCALE ** (to - start))[:, None]
        for place, (i, j) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()), 1):
            if i < j:
                ends = to[i:j]
                heads = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
                ways[ends[heads]] = np.add.reduceat(ways[start[i:j]] * weights[i:j], heads, axis=0)
            if place % STEP == 0:
                for word in np.flatnonzero(last - first > place).tolist():
                    low, here = max(first[word], first[word] + place - self.longest), first[word] + place + 1
                    most = ways[low:here].max(axis=0)
                    ways[low:here] /= most
                    logs[low:last[word] + 1] += np.log(most)
        return ways, logs

    def backward(self, lattice, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per node, the summed probability of all ways from there to the word's end; as for forward. One language."""
        start, to, _, bounds, first, last = lattice
        onward = np.zeros(int(last.max()) + 2)
        onward[last] = 1.0
        logs = np.zeros_like(onward)
        for place in range(len(bounds) - 1, 0, -1):
            i, j = bounds[place - 1], bounds[place]
            np.add.at(onward, start[i:j], cost[i:j] * onward[to[i:j]])
            if place % STEP == 0:
                for word in np.flatnonzero(last - first > place).tolist():
                    low, here = max(first[word], first[word] + place - self.longest), first[word] + place
                    most = onward[low:here].max()
                    onward[low:here] /= most
                    logs[first[word]:here] += np.log(most)
        return onward, logs

    def word_scores(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        lattice = self.lattice(words)
        first, last = lattice[4], lattice[5]
        ways, logs = self.forward(lattice, table)
        return np.log(ways[last]) + logs[last] - ((last - first) * np.log(SCALE))[:, None]

    def expected(self, words: list[str], weights: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in weighted words of one language (table has one column)."""
        lattice = self.lattice(words)
        start, to, piece, _, first, last = lattice
        ways, logs = (x[:, 0] for x in self.forward(lattice, table))
        cost = table[piece, 0] * SCALE ** (to - start)
        onward, onward_logs = self.backward(lattice, cost)
        word = np.searchsorted(first, start, "right") - 1
        scale = np.exp(logs[start] + onward_logs[to] - logs[last][word])
        share = ways[start] * cost * onward[to] / ways[last][word] * scale * weights[word]
        return np.bincount(piece, share, self.size)


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def words_of(text: str) -> list[str]:
    return RUN.findall(text.lower())


def train(docs: DataFrame, path: str, per_language: int = SAMPLE_PER_LANGUAGE, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (pieces x languages), from rows with text and lang.

    Reads the ids and languages of all rows, and about per_language whole texts of each language, chosen by a hash of doc_id.
    What reaches the driver is one number per language and piece.
    """
    rows = docs.where("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), "text", F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(_BUCKETS)).alias("draw"))
    counts = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    size = pieces(path).size
    if not languages:
        return [], np.zeros((size, 0))
    rate = F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(_BUCKETS * per_language / counts[lang]) + 1)])
    chosen = rows.where(F.col("draw") < F.element_at(rate, F.col("lang"))).select("lang", "text")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        seen: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            seen.update((lang, word) for word in words_of(text))
        if not seen:
            return None
        keys = list(seen)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

    words = stage(
        common.map_batches(chosen, count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "language-words")
    table = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds):
        table = _round(words, path, languages, table)
    return languages, table


def _round(words: DataFrame, path: str, languages: list[str], table: np.ndarray) -> np.ndarray:
    """One step of expectation-maximisation."""
    column = {lang: i for i, lang in enumerate(languages)}

    def expect(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = pieces(path)
        langs, words_, n = (batch.column(name).to_pylist() for name in ("lang", "word", "n"))
        ids, found, values = [], [], []
        for lang in sorted(set(langs)):
            mine = [i for i, x in enumerate(langs) if x == lang]
            expected = own.expected([words_[i] for i in mine], np.array([n[i] for i in mine], float), table[:, [column[lang]]])
            used = np.flatnonzero(expected)
            ids += [column[lang]] * len(used)
            found.append(used)
            values.append(expected[used])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(np.concatenate(found).astype(np.int32)), pa.array(np.concatenate(values))], ["lang", "piece", "n"])

    sums = common.map_batches(words, expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros_like(table)
    # sums of parts differ in their last digits with the order of tasks
    counts[sums["piece"], sums["lang"]] = sums["n"].round(6)
    counts += SMOOTHING
    counts[-1] = 0.0
    made = counts / counts.sum(0)
    made[-1] = UNKNOWN
    return made


class Scorer:
    """Sums of word scores, with a memo of two generations, so that frequent words stay."""

    def __init__(self, path: str, table: np.ndarray):
        self.pieces, self.table = pieces(path), table
        self.young: dict[str, int] = {}
        self.old: tuple[dict[str, int], np.ndarray] = ({}, np.zeros((0, table.shape[1])))
        self.scores = np.zeros((0, table.shape[1]))

    def text_scores(self, texts: list[list[str]]) -> np.ndarray:
        """Summed log probabilities (texts x languages)."""
        young, (old, old_scores) = self.young, self.old
        needed = [word for word in set().union(*texts) if word not in young]
        again = [word for word in needed if word in old]
        fresh = [word for word in needed if word not in old]
        added = [self.scores]
        if again:
            added.append(old_scores[[old[word] for word in again]])
        for i in range(0, len(fresh), 4000):
            added.append(self.pieces.word_scores(fresh[i:i + 4000], self.table))
        self.scores = np.concatenate(added)
        for i, word in enumerate([*again, *fresh], len(young)):
            young[word] = i
        sums = np.array([self.scores[np.fromiter(map(young.__getitem__, words), np.int64, len(words))].sum(0) if words
                         else np.zeros(self.table.shape[1]) for words in texts])
        if len(young) > MOST_WORDS:
            self.old, self.young, self.scores = (young, self.scores), {}, self.scores[:0]
        return sums


def predict(docs: DataFrame, path: str, languages: list[str], table: np.ndarray) -> DataFrame:
    """doc_id, lang_pred and score of every row; score is the posterior of the prediction with equal priors.

    A null text, and one without letters, is undetermined with score 0; so is every text if no language was
    learned. Of equally likely languages the first by name is taken.
    """
    state: dict[str, Scorer] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state["own"] = Scorer(path, table)
        texts = [words_of(text or "") for text in batch.column("text").to_pylist()]
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if languages:
            sums = np.concatenate([state["own"].text_scores(texts[i:i + 100]) for i in range(0, len(texts), 100)])
            best = sums.argmax(1)
            shares = 1.0 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
            for i, words in enumerate(texts):
                if words:
                    names[i], scores[i] = languages[best[i]], shares[i]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return common.map_batches(common.id_and_text(docs), run, "doc_id long, lang_pred string, score double")
