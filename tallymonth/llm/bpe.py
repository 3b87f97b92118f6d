"""BPE encoding and decoding with a public vocabulary of word-end pieces.

A word starts as its bytes. Its parts stand in one contiguous array beside the ranks of
all adjacent pairs; the smallest rank (the leftmost of equals) is found by scanning,
its boundary is deleted and the two ranks beside it are looked up anew. That is
quadratic but fastest for the short words that texts are made of, and done for all new
words of one length at once, a row of the array each. Words of more than ``SHORT``
parts keep the same order of merges with a heap.

The vocabulary file is read by the driver and sent to the tasks; its size is bounded by
``MAX_VOCABULARY_BYTES``. Nothing is learned here.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tallymonth.llm.common import texts

MAX_VOCABULARY_BYTES = 64 << 20
SHORT = 48
CACHED_WORDS = 500_000
CACHED_CHARACTERS = 16 << 20
CHUNK = 1 << 20

# A part of a very long text, up to the next white space as Unicode has it: Python's own \s
# takes in control characters that are no white space to the vocabulary.
PART = regex.compile(rf"(?s).{{1,{CHUNK}}}\P{{White_Space}}*")

NEVER = 1 << 62
ID_BITS = 32
MERGED = (1 << ID_BITS) - 1
GONE = -1

# Characters that normalization leaves alone but for their case, each by itself.
PLAIN_RANGES = [range(0x180), range(0x2010, 0x2028)]


def _characters(kind: str) -> str:
    """The plain characters of a Unicode property, as the inside of a pattern's brackets."""
    plain = (chr(code) for ranges in PLAIN_RANGES for code in ranges)
    return "".join(re.escape(c) for c in plain if regex.match(rf"\p{{{kind}}}", c))


PLAIN = re.compile(f"[{''.join(f'{chr(r[0])}-{chr(r[-1])}' for r in PLAIN_RANGES)}]*\\Z")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the rest follow from U+0100.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in visible]
    letters = {byte: chr(byte) for byte in visible}
    letters |= {byte: chr(0x100 + place) for place, byte in enumerate(hidden)}
    return [letters[byte] for byte in range(256)]


class Coder:
    """Encodes texts to ids and ids to texts by a tokenizer file's contents."""

    def __init__(self, file_text: str) -> None:
        spec = json.loads(file_text)
        model = spec["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocabulary[letter] for letter in letters])
        self.final = np.array([vocabulary[letter + end] for letter in letters])
        # The rank of a pair in the upper bits, the id of the merged part in the lower.
        self.merges = {
            (vocabulary[a], vocabulary[b]): (rank << ID_BITS) + vocabulary[a + b]
            for rank, (a, b) in enumerate(model["merges"], start=1)
        }
        ordered = sorted(((a << ID_BITS) + b, value) for (a, b), value in self.merges.items())
        self.pairs, self.values = np.array(ordered, dtype=np.int64).reshape(-1, 2).T.copy()
        self.pieces = {number: piece for piece, number in vocabulary.items()}
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.pieces |= {number: piece for piece, number in self.special.items()}
        self.special_bytes = {
            piece: np.array([number], "<u4").tobytes() for piece, number in self.special.items()
        }
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile(f"({'|'.join(map(re.escape, longest_first))})")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        letter, number, space = map(_characters, ("L", "N", "White_Space"))
        for sign, inside in ((r"\p{L}", letter), (r"\p{N}", number), (r"\s", space)):
            split = split.replace(sign, inside)
        self.words = re.compile(split)
        # Its normalizer and word splitter serve texts outside PLAIN.
        self.library = Tokenizer.from_str(file_text)
        self.byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self.cache: dict[str, bytes] = {}
        self.cached_characters = 0

    def _parts(self, words: list[str]) -> np.ndarray:
        """The bytes' ids of words of one length, a row each."""
        data = np.frombuffer("".join(words).encode(), np.uint8).reshape(len(words), -1)
        return np.hstack([self.inner[data[:, :-1]], self.final[data[:, -1:]]])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = (left << ID_BITS) + right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.values[at], NEVER)

    def _scan(self, words: list[str]) -> None:
        """Merge new words of one length and keep their ids."""
        parts = self._parts(words)
        ranks = self._ranks(parts[:, :-1], parts[:, 1:])
        names = np.array(words, object)
        while len(names):
            rows = np.arange(len(names))
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(names), int)
            least = ranks[rows, at] if ranks.shape[1] else np.full(len(names), NEVER)
            done = least == NEVER
            for name, row in zip(names[done], parts[done].astype("<u4"), strict=True):
                self.cache[name] = row.tobytes()
            if done.all():
                return
            more = ~done
            names, parts, ranks, at, least = (x[more] for x in (names, parts, ranks, at, least))
            rows, width = np.arange(len(names)), parts.shape[1]
            parts[rows, at] = least & MERGED
            keep = np.arange(width) != at[:, None] + 1
            parts = parts[keep].reshape(len(names), width - 1)
            ranks = ranks[np.arange(width - 1) != at[:, None]].reshape(len(names), width - 2)
            for place in (at - 1, at):
                there = np.flatnonzero((place >= 0) & (place < width - 2))
                pick = place[there]
                ranks[there, pick] = self._ranks(parts[there, pick], parts[there, pick + 1])

    def _learn(self, words: set[str]) -> None:
        """Fill the cache with the ids of words it lacks."""
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word.encode()), []).append(word)
        for length, alike in by_length.items():
            if length <= SHORT:
                self._scan(alike)
                continue
            for word in alike:
                parts = self._heap(self._parts([word])[0].tolist())
                self.cache[word] = np.array(parts, "<u4").tobytes()

    def _heap(self, parts: list[int]) -> list[int]:
        rank_of, size = self.merges.get, len(parts)
        left, right = list(range(-1, size - 1)), list(range(1, size + 1))
        heap = [(rank, at) for at in range(size - 1) if (rank := rank_of((parts[at], parts[at + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            after = right[at]
            if after >= size or rank_of((parts[at], parts[after])) != rank:
                continue
            parts[at], parts[after] = rank & MERGED, GONE
            right[at] = right[after]
            if right[at] < size:
                left[right[at]] = at
            for a, b in ((left[at], at), (at, right[at])):
                if a >= 0 and b < size and (rank := rank_of((parts[a], parts[b]))):
                    heapq.heappush(heap, (rank, a))
        return [part for part in parts if part != GONE]

    def _split(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalized."""
        if PLAIN.match(text):
            return self.words.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        found = self.library.pre_tokenizer.pre_tokenize_str(normal)
        return [bytes(self.byte_of[c] for c in word).decode() for word, _ in found]

    def _pieces(self, text: str) -> list[list[str]]:
        """Words, a special token, words, a special token, ... in turn, each as a list."""
        pieces = enumerate(self.specials.split(text))
        return [[piece] if place % 2 else self._split(piece) for place, piece in pieces]

    def _encode_pieces(self, split: list[list[list[str]]]) -> list[np.ndarray]:
        """Ids of texts that are split; their new words are merged together."""
        words = {word for pieces in split for part in pieces[::2] for word in part}
        new = words.difference(self.cache)
        more = sum(map(len, new))
        if len(self.cache) + len(new) > CACHED_WORDS or self.cached_characters + more > CACHED_CHARACTERS:
            self.cache.clear()
            new, self.cached_characters = words, 0
            more = sum(map(len, new))
        self.cached_characters += more
        self._learn(new)
        ids_of, coded = self.cache.__getitem__, []
        for pieces in split:
            codes: list[bytes] = []
            for place, part in enumerate(pieces):
                codes.extend([self.special_bytes[part[0]]] if place % 2 else map(ids_of, part))
            coded.append(np.frombuffer(b"".join(codes), "<u4"))
        return coded

    def encode_all(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of several texts. Of very long ones, parts that end before white space are
        split and merged one after the other."""
        if all(len(text) <= CHUNK for text in batch):
            return self._encode_pieces([self._pieces(text) for text in batch])
        return [
            np.concatenate(
                [np.empty(0, "<u4")]
                + [self._encode_pieces([self._pieces(m.group())])[0] for m in PART.finditer(text)]
            )
            for text in batch
        ]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The pieces with a blank between each two, as the vocabulary has no decoder."""
        return " ".join(map(self.pieces.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def coder_of(file_text: str) -> Coder:
    """One coder, with its cached words, for all tasks of a Python worker."""
    return Coder(file_text)


def read_vocabulary(path: str) -> str:
    size = os.path.getsize(path)
    if size > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {size} bytes; at most {MAX_VOCABULARY_BYTES} are sent to tasks")
    with open(path, encoding="utf-8") as file:
        return file.read()


OUTPUTS = {
    "n_tokens": ("long", lambda ids, decoded: len(ids)),
    "ids": ("array<int>", lambda ids, decoded: ids.astype("<i4")),
    "decoded": ("string", lambda ids, decoded: decoded),
    "ids_sha256": ("string", lambda ids, decoded: hashlib.sha256(ids.tobytes()).hexdigest()),
    "decoded_sha256": (
        "string",
        lambda ids, decoded: hashlib.sha256(decoded.encode()).hexdigest(),
    ),
}


def coded(docs: DataFrame, path: str, outputs: list[str]) -> DataFrame:
    """doc_id and the named outputs of encoding each whole text and decoding it again.

    Outputs: ``n_tokens``, ``ids``, ``decoded``, and SHA-256 of the ids as little-endian
    32-bit integers (``ids_sha256``) and of the decoded text (``decoded_sha256``). A
    null or empty text has no ids and decodes to the empty text. One row for each
    row, repeated ones too; an empty table gives an empty result; other columns are not read,
    so their names may be any. Texts of any length are coded whole, in parts that end
    before white space. No shuffle.
    """
    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    types = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "string": pa.string()}

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(sent.value)
        for whole in parts:
            for at in range(0, len(whole), 256):
                part = whole.slice(at, 256)
                made: dict[str, list] = {name: [] for name in outputs}
                for ids in coder.encode_all(part.column("text").to_pylist()):
                    decoded = coder.decode(ids)
                    for name in outputs:
                        made[name].append(OUTPUTS[name][1](ids, decoded))
                columns = [pa.array(made[name], types[OUTPUTS[name][0]]) for name in outputs]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *columns], ["doc_id", *outputs]
                )

    schema = ", ".join(f"{name} {OUTPUTS[name][0]}" for name in outputs)
    return rows.mapInArrow(batches, f"doc_id {kind}, {schema}")


def decoded(coded_docs: DataFrame, path: str) -> DataFrame:
    """The frame's rows (doc_id, decoded) from its ``doc_id`` and ``ids``; null ids decode to ''."""
    rows = coded_docs.select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(sent.value)
        for part in parts:
            ids = (np.array(row.as_py() or [], "<u4") for row in part.column("ids"))
            back = pa.array([coder.decode(one) for one in ids], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), back], ["doc_id", "decoded"])

    return rows.mapInArrow(batches, f"doc_id {kind}, decoded string")
