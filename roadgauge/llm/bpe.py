"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last 16 characters cuts every text into chunks of 128 characters on
average. Equal passages of different documents are therefore cut alike, and a worker encodes
each of its chunks once. A cut may fall inside a word, so a chunk keeps only what lies between its first
and its last white space; what is left on both sides of a cut is joined and encoded anew, over as
many chunks as it takes to reach white space at both ends. There the tokenizer starts afresh (its
normaliser maps white space to a space, its splitter drops it, no merge crosses it), so the repaired
ids are those of the whole text.

The memo of a worker is bounded; a chunk that was forgotten is encoded again.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roadgauge.llm import common

WINDOW_STEPS = (1, 2, 4, 8)
CHUNK_BITS = 7
MOST_CHUNKS = 40_000
MOST_WORDS = 500_000
#: Parts of one generation of the memo of encode_parts, which stays in a worker. With 200,000 parts are learned anew so often that op7 exceeds its CPU budget.
MOST_PARTS = 350_000
#: New words of texts of so many characters together are encoded in one call.
LEARN_CHARACTERS = 400_000


#: A letter before a mark: the splitter parts them anyhow, so a space between them changes no id.
LETTER_THEN_MARK = re.compile(r"(?<=[a-z])(?=[.,!?#*%$&|;:])")


#: Parts of a text that the splitter parts anyhow: Latin letters up to white space or a mark, marks up to a letter or white
#: space, and else all up to the next white space. U+0130 is no such letter: its lower case ends with a combining dot.
LATIN, MARKS, WHITE = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f", ".,!?#*%$&|;:", " \\n\\t\\r"
PART = re.compile(f"[{LATIN}]+(?=[{MARKS}{WHITE}]|\\Z)|[{MARKS}]+(?=[{LATIN}{WHITE}]|\\Z)|[^{WHITE}]+")
EXPECTED = {"normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"]}


def check_file(tokenizer) -> None:
    """What the repair and the parts rely on: a normaliser and a splitter that treat words alone, and no decoder."""
    described = json.loads(tokenizer.to_str())
    for name, kinds in EXPECTED.items():
        stage = described[name] or {}
        listed = [part["type"] for part in stage.get("normalizers" if name == "normalizer" else "pretokenizers", [])]
        if listed != kinds:
            raise ValueError(f"this tokenizer file's {name} is not supported")
    if described["pre_tokenizer"]["pretokenizers"][0]["behavior"] != "Removed":
        raise ValueError("a tokenizer that keeps white space is not supported")


def plain(text: str) -> str:
    """A text of the same ids in which more words are alike.

    White space becomes spaces, marks leave the words, and A-Z are lowered, as the tokenizer does later.
    A text that may hold special tokens keeps its case, since these are matched before.
    """
    text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
    if "<|" in text:
        return text
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return LETTER_THEN_MARK.sub(" ", text)


class WordIds(dict):
    """Ids by word. A word that is not known counts as empty and is noted in todo.

    Bounded by two generations: when the young one is full it becomes the old one, and words
    that are asked for again move back. Frequent words therefore stay.
    """

    def __init__(self):
        super().__init__({"": b""})
        self.old: dict[str, bytes] = {}
        self.todo: list[str] = []

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            self.todo.append(word)
            return b""
        self[word] = ids
        return ids

    def trim(self, most: int) -> None:
        if len(self) > most:
            self.old = dict(self)
            self.clear()
            self[""] = b""


class ChunkEncoder:
    """Exact ids of texts, as little-endian unsigned 32-bit integers.

    path: a tokenizer file whose splitter drops white space. Special tokens written in a text are
    matched as the tokenizers library does.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        check_file(self.tokenizer)
        self.names: list[str] = []
        self.chunks: dict[str, tuple[str, bytes, str]] = {}
        self.words = WordIds()
        self.encoded_chunks = 0

    def _cuts(self, text: str) -> list[int]:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        rolled = codes * np.uint32(2654435761)
        factor = 0x9E3779B1
        for step in WINDOW_STEPS:
            if len(rolled) > step:
                longer = rolled.copy()
                longer[step:] += rolled[:-step] * np.uint32(factor)
                rolled = longer
            factor = factor * factor & 0xFFFFFFFF
        return (np.flatnonzero(rolled >> np.uint32(32 - CHUNK_BITS) == 0) + 1).tolist()

    def _learn(self, words: list[str]) -> None:
        """Encode new words in one call; a token belongs to the word in which it starts."""
        words = list(dict.fromkeys(words))
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        starts = np.array([start for start, _ in found.offsets], np.int64)
        limits = np.cumsum(np.array([len(word) + 1 for word in words], np.int64))
        ends = (4 * np.searchsorted(starts, limits, "left")).tolist()
        data, start = ids.tobytes(), 0
        for word, end in zip(words, ends):
            self.words[word] = data[start:end]
            start = end

    def encode(self, text: str) -> bytes:
        """Ids of one text; of an empty text none."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. New words of several texts are encoded in one call."""
        made, pending, size = [], [], 0
        for text in texts:
            pending.append(self._parts(text))
            size += len(text)
            if size > LEARN_CHARACTERS:
                made += self._joined(pending)
                pending, size = [], 0
        return made + self._joined(pending)

    def encode_parts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text from its parts alone, for callers that gain nothing from whole chunks: most texts differ."""
        made, pending, size = [], [], 0
        for text in texts:
            if "<|" not in text:
                text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
            pending.append(PART.findall(text))
            size += len(text)
            if size > LEARN_CHARACTERS:
                made += self._from_parts(pending)
                pending, size = [], 0
        return made + self._from_parts(pending)

    def _from_parts(self, lists: list[list[str]]) -> list[bytes]:
        words, old = self.words, self.words.old
        new = [part for part in set().union(*lists) if part not in words and part not in old]
        if new:
            self._learn(new)
        made = [b"".join(map(words.__getitem__, parts)) for parts in lists]
        words.trim(MOST_PARTS)
        return made

    def _parts(self, text: str) -> tuple[list[bytes], list[tuple]]:
        """Ids of the parts of a text, and the places of parts with words that are not known yet."""
        text = plain(text)
        cuts = self._cuts(text) if text else []
        known, words, out, again, carry, start = self.chunks, self.words, [], [], "", 0
        ids_of, todo = words.__getitem__, words.todo
        for end in [*cuts, len(text)]:
            chunk = text[start:end]
            start = end
            parts = known.get(chunk)
            if parts is None:
                first = chunk.find(" ")
                if first < 0:
                    carry += chunk
                    continue
                last, before = chunk.rfind(" "), len(todo)
                head, tail, inner = chunk[:first], chunk[last + 1:], chunk[first:last].split(" ")
                body = b"".join(map(ids_of, inner))
                if len(todo) > before:
                    again.append((len(out) + 1, chunk, inner))
                else:
                    known[chunk] = (head, body, tail)
                self.encoded_chunks += 1
            else:
                head, body, tail = parts
            joined, before = carry + head, len(todo)
            out.append(ids_of(joined))
            if len(todo) > before:
                again.append((len(out) - 1, None, (joined,)))
            out.append(body)
            carry = tail
        before = len(todo)
        out.append(ids_of(carry))
        if len(todo) > before:
            again.append((len(out) - 1, None, (carry,)))
        return out, again

    def _joined(self, pending: list[tuple[list[bytes], list[tuple]]]) -> list[bytes]:
        """Learn what is missing, and put each text together."""
        if self.words.todo:
            self._learn(self.words.todo)
            self.words.todo.clear()
        ids_of = self.words.__getitem__
        for out, again in pending:
            for place, chunk, inner in again:
                out[place] = b"".join(map(ids_of, inner))
                if chunk is not None:
                    self.chunks[chunk] = (chunk[:chunk.find(" ")], out[place], chunk[chunk.rfind(" ") + 1:])
        self.words.trim(MOST_WORDS)
        if len(self.chunks) > MOST_CHUNKS:
            self.chunks.clear()
        return [b"".join(out) for out, _ in pending]

    def decode(self, ids: bytes) -> str:
        """Text of ids, special tokens included: tokens joined by spaces, as the file names no decoder."""
        if not self.names:
            size = self.tokenizer.get_vocab_size(with_added_tokens=True)
            self.names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
            if self.tokenizer.decoder is not None:
                raise ValueError("a tokenizer file with a decoder is not supported")
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker, so that tasks that follow each other share its chunks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit integers), decoded, for every row.

    A null or empty text has no ids and decodes to an empty text. Repeated rows are encoded each.
    Texts stay where they are read: no shuffle, and memory is a batch and the bounded memo.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(path)
        ids = own.encode_all([text or "" for text in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
             pa.array([own.decode(x) for x in ids], pa.string())],
            ["doc_id", "n_tokens", "ids", "decoded"],
        )

    return common.map_batches(common.id_and_text(docs), run, "doc_id long, n_tokens long, ids binary, decoded string")
