"""Toxicity by weak supervision.

Many voters (mined lexicon stems, a short public word list, patterns of rate and shouting) vote toxic, clean or nothing. A
generative label model estimates each voter's accuracy in both classes by expectation-maximisation, and discounts voters whose
votes correlate beyond what the class explains. A linear classifier is then fitted to the posterior labels and scores all texts.

The fit uses a sample of labelled rows of bounded size (SAMPLE); copies in it share one weight, so that a copied document's rare
words are not taken for a lexicon. Scoring reads whole texts where they lie, without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadgauge.llm import common
from roadgauge.session import stage

#: Labelled rows used for the fit, about.
SAMPLE = 8000
STEMS = 64
SHORTEST, LONGEST = 3, 9
#: A stem must occur in so many toxic rows (copies count once), and its share of them must lie so many standard errors
#: above its share of clean rows: of a million candidate stems none gets there by chance.
LEAST_DOCUMENTS, LEAST_ERRORS = 4.0, 7.0
RUN = re.compile(r"[^\W\d_]+")
#: Common insults.
INSULTS = "idiot moron stupid dumb loser trash scum pathetic worthless disgusting clown filthy vermin retard bastard".split()
RATES = (0.25, 0.5, 1.0, 1.35, 1.75, 2.5)
MEMO = 200_000
#: Texts whose stems are gathered at once.
MINED_ROWS = 200
#: Added to each vote's probability, so that none is zero.
EVEN = 0.002
_BUCKETS = 1 << 20


def words_of(text: str) -> list[str]:
    return RUN.findall(text.lower())


def stems_of(word: str) -> set[str]:
    """Beginnings of a word, and the whole word marked as such."""
    return {word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1)} | {word + "$"}


class StemIndex(dict):
    """Position of the stem that a word carries, or the number of stems if none; computed when first asked for."""

    def __init__(self, stems: list[str]):
        super().__init__()
        self.places = {stem: i for i, stem in enumerate(stems)}
        self.none = len(stems)

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO:
            self.clear()
        found = self.places.get(word + "$")
        for n in range(min(len(word), LONGEST), SHORTEST - 1, -1):
            if found is not None:
                break
            found = self.places.get(word[:n])
        self[word] = self.none if found is None else found
        return self[word]

    def counts(self, words: list[str]) -> np.ndarray:
        return np.bincount(np.fromiter(map(self.__getitem__, words), np.int64, len(words)), minlength=self.none + 1)[:self.none]


@dataclass
class Model:
    stems: list[str]
    weights: np.ndarray
    bias: float

    def score(self, counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(features(counts, n_words) @ self.weights + self.bias, -30, 30)))


def features(counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Of each text: presence and rate (per hundred words) of each stem, and how far the total rate lies above fixed marks."""
    rates = 100.0 * counts / np.maximum(n_words, 1)[:, None]
    total = rates.sum(1, keepdims=True)
    return np.hstack([counts > 0, np.minimum(rates, 5.0), np.clip(total - np.array((0.0, *RATES)), 0.0, 1.0)]).astype(float)


def votes(counts: np.ndarray, n_words: np.ndarray, shouting: np.ndarray, stems: list[str]) -> np.ndarray:
    """1 toxic, -1 clean, 0 no vote: a voter per stem, the public list, and patterns."""
    rates = 100.0 * counts / np.maximum(n_words, 1)[:, None]
    total = rates.sum(1)
    listed = [i for i, stem in enumerate(stems) if any((insult + "$").startswith(stem) for insult in INSULTS)]
    own = [np.where(counts[:, i] > 0, 1, 0) for i in range(counts.shape[1])]
    patterns = [np.where(total >= mark, 1, -1) for mark in RATES]
    patterns += [
        np.where(counts[:, listed].sum(1) > 0, 1, 0), np.where(counts.sum(1) == 0, -1, 0),
        np.where((counts > 0).sum(1) >= 2, 1, 0), np.where(counts.sum(1) >= 3, 1, 0), np.where(shouting > 0.5, 1, 0),
    ]
    return np.stack([*own, *patterns], axis=1)


def label_model(votes: np.ndarray, start: np.ndarray, weight: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Posterior probability of class 1. start: labels that the class share and the first estimate of accuracies take."""
    posterior, shape = start.astype(float), np.stack([votes == v for v in (-1, 0, 1)]).astype(float)
    prior = np.clip((posterior * weight).sum() / weight.sum(), 1e-4, 1 - 1e-4)
    for _ in range(rounds):
        sides = []
        for share in (1 - posterior, posterior):
            mass = share * weight
            # probability of each vote given the class, per voter
            sides.append((np.einsum("vij,i->vj", shape, mass) / max(mass.sum(), 1e-9) + EVEN) / (1 + 3 * EVEN))
        # correlation of the votes beyond what the class explains
        expected = sum(np.outer(share, side[2] - side[0]) for share, side in zip((1 - posterior, posterior), sides))
        rest = (votes - expected) * np.sqrt(weight)[:, None]
        size = np.sqrt((rest ** 2).sum(0)) + 1e-9
        correlated = np.clip(rest.T @ rest / np.outer(size, size), 0.0, 1.0)
        own = 1.0 / np.where(correlated > 0.1, correlated, 0.0).sum(0).clip(1.0)
        odds = np.log(prior / (1 - prior)) + np.einsum("vij,vj,j->i", shape, np.log(sides[1] / sides[0]), own)
        posterior = 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))
    return posterior


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = 0.5, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton steps; target may be soft."""
    whole = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.append(np.full(x.shape[1], penalty), 1e-6)
    w = np.zeros(whole.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(whole @ w, -30, 30)))
        slope = whole.T @ (weight * (p - target)) + ridge * w
        curve = (whole * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ whole + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def copy_weights(marks: np.ndarray) -> np.ndarray:
    """1 / size of each row's group of near copies: rows that share any of their minimum hashes."""
    parent = list(range(len(marks)))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for column in range(marks.shape[1]):
        first: dict[int, int] = {}
        for i, mark in enumerate(marks[:, column].tolist()):
            parent[top(i)] = top(first.setdefault(mark, i))
    tops = np.array([top(i) for i in range(len(marks))], np.int64)
    return 1.0 / np.bincount(tops, minlength=len(marks))[tops]


def _min_hashes(words: list[str]) -> list[int]:
    from xxhash import xxh32_intdigest as hashed

    if not words:
        return [0, 1, 2]
    trios = np.array([hashed(" ".join(words[i:i + 3])) for i in range(max(1, len(words) - 2))], np.uint64)
    return [int(((trios * np.uint64(a) + np.uint64(b)) & np.uint64(0xFFFFFFFF)).min()) | n << 32
            for n, (a, b) in enumerate(((2654435761, 17), (2246822519, 91), (3266489917, 5)))]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from docs (doc_id, text) and labels (doc_id, toxic 0 or 1); rows with a null in any of these are left out.

    Of repeated labels the smallest counts. What is broadcast to find the sample's texts, and what reaches the driver, is bounded by
    sample. With one class only, or none, every score is that class's share.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("toxic").cast("int").alias("toxic"))
    bound = int(_BUCKETS * sample / max(known.count(), 1)) + 1
    few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(_BUCKETS)) < bound)
    chosen = stage(common.id_and_text(docs).where("text is not null").join(F.broadcast(few), "doc_id"), "toxicity-sample")

    def marks(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [_min_hashes(words_of(text)) for text in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *[pa.array(x, pa.int64()) for x in zip(*made)]], ["doc_id", "toxic", "a", "b", "c"])

    seen = common.map_batches(chosen, marks, "doc_id long, toxic int, a long, b long, c long").toPandas().sort_values(["doc_id", "a"], kind="stable")
    share = float((seen["toxic"] == 1).mean()) if len(seen) else 0.0
    if share in (0.0, 1.0):
        return Model([], np.zeros(len(RATES) + 1), 30.0 * (2 * share - 1))
    group = copy_weights(seen[["a", "b", "c"]].to_numpy())
    weight_of = dict(zip(seen["doc_id"].tolist(), group.tolist()))
    balance = [max(group[(seen["toxic"] == side).to_numpy()].sum(), 1.0) for side in (0, 1)]

    def mine(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sums: dict[str, list[float]] = {}
        for doc_id, text, toxic in zip(*(batch.column(i).to_pylist() for i in range(3))):
            weight, words = weight_of.get(doc_id, 0.0), words_of(text)
            found: dict[str, int] = {}
            for word in words:
                for stem in stems_of(word):
                    found[stem] = found.get(stem, 0) + 1
            for stem, n in found.items():
                own = sums.setdefault(stem, [0.0, 0.0, 0.0, 0.0])
                own[toxic] += weight * n / len(words)
                own[2 + toxic] += weight
        if not sums:
            return None
        values = np.array(list(sums.values()))
        return pa.RecordBatch.from_arrays([pa.array(list(sums)), *[pa.array(values[:, i].copy()) for i in range(4)]], ["stem", "clean", "toxic", "in_clean", "in_toxic"])

    def mine_all(batches):
        # few texts at a time, since each has thousands of stems
        for batch in batches:
            for i in range(0, batch.num_rows, MINED_ROWS):
                made = mine(batch.slice(i, MINED_ROWS))
                if made is not None:
                    yield made

    sums = chosen.mapInArrow(mine_all, "stem string, clean double, toxic double, in_clean double, in_toxic double")
    toxic_rows, clean_rows = balance[1], balance[0]
    in_toxic, in_clean = F.sum("in_toxic"), F.sum("in_clean")
    both = (in_toxic + in_clean) / (toxic_rows + clean_rows)
    error = F.sqrt(both * F.greatest(1 - both, F.lit(1e-6)) * (1 / toxic_rows + 1 / clean_rows))
    lift = (F.sum("toxic") / toxic_rows + 1e-5) / (F.sum("clean") / clean_rows + 1e-5)
    ranked = (
        sums.groupBy("stem").agg(
            in_toxic.alias("n"), ((in_toxic / toxic_rows - in_clean / clean_rows) / error).alias("errors"), lift.alias("lift"))
        .where((F.col("n") >= LEAST_DOCUMENTS) & (F.col("errors") >= LEAST_ERRORS) & (F.col("lift") > 4))
        # of beginnings that occur alike the longest
        .orderBy(F.desc(F.round(F.log("lift") * F.sqrt("n"), 2)), F.desc(F.length("stem")), "stem").limit(40 * STEMS).collect()
    )
    stems: list[str] = []
    for row in ranked:
        stem = row["stem"]
        if len(stems) < STEMS and not any(stem.startswith(other.rstrip("$")) or other.startswith(stem.rstrip("$")) for other in stems):
            stems.append(stem)
    index_of = StemIndex(stems)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        words = [words_of(text) for text in texts]
        counts = [index_of.counts(own).tolist() for own in words]
        loud = [sum(c.isupper() for c in text) / max(1, sum(c.isalpha() for c in text)) for text in texts]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array([len(x) for x in words], pa.int64()),
             pa.array(counts, pa.list_(pa.int64())), pa.array(loud, pa.float64())], ["doc_id", "toxic", "n_words", "counts", "loud"])

    made = common.map_batches(chosen, count, "doc_id long, toxic int, n_words long, counts array<long>, loud double").toPandas()
    made = made.assign(key=[tuple(x) for x in made["counts"]]).sort_values(["doc_id", "n_words", "key"], kind="stable")
    counts = np.array(made["counts"].tolist(), float).reshape(len(made), len(stems))
    n_words, labels = made["n_words"].to_numpy(), (made["toxic"] == 1).to_numpy()
    weight = np.array([weight_of[i] for i in made["doc_id"].tolist()])
    posterior = label_model(votes(counts, n_words, made["loud"].to_numpy(), stems), labels, weight)
    weights, bias = logistic(features(counts, n_words), posterior, weight)
    return Model(stems, weights, bias)


def counted(texts: list[str | None], own: StemIndex) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each stem, and the number of words, of each text. One text's words are held at a time."""
    counts, sizes = [], []
    for text in texts:
        words = words_of(text or "")
        counts.append(own.counts(words))
        sizes.append(len(words))
    return np.array(counts, float).reshape(len(sizes), own.none), np.array(sizes)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row. A null or empty text has no words and scores as such."""
    state: dict[str, StemIndex] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model.score(*counted(batch.column("text").to_pylist(), state.setdefault("own", StemIndex(model.stems))))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return common.map_batches(common.id_and_text(docs), run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that the model does not reject, all columns unchanged. Rows with null text stay."""
    state: dict[str, StemIndex] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model.score(*counted(batch.column("text").to_pylist(), state.setdefault("own", StemIndex(model.stems))))
        empty = batch.column("text").is_null().to_numpy(zero_copy_only=False)
        return batch.filter(pa.array((found < 0.5) | empty))

    return docs.mapInArrow(lambda batches: (run(batch) for batch in batches if batch.num_rows), docs.schema)
