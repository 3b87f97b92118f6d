"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton enumerates the pieces that end at each character; for every
place the search carries the best score, the number of pieces on the way there and
whether the last is unknown, and no path. Ties are the library's: a later candidate
must score strictly more, and candidates come by their start, earliest first. A
character that no piece covers alone may also be unknown, at the least score less
10; neighbouring unknown characters are one token.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tallymonth.llm.common import texts

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 300_000
LONGEST_CACHED = 64

# A longer word is searched by windows of so many characters.
WINDOW = 1 << 16


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, by id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counts(dict):
    """Number of tokens of each word met after a space; up to ``CACHED_WORDS`` of them, none
    longer than ``LONGEST_CACHED``, are kept."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max(len(piece) for piece, _ in pieces)
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        if len(word) > WINDOW:
            return self.search_by_windows(word)
        count = self.search(SPACE + word)
        if len(word) > LONGEST_CACHED:
            return count
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = count
        return count

    def search(self, word: str) -> int:
        """Tokens of one word. The automaton gives the matches by their end and, of those that
        end together, the longest first; a place is settled once its last candidate is seen."""
        size = len(word)
        score, count = [0.0] + [-math.inf] * size, [0] * (size + 1)
        unknown = [False] * (size + 1)

        def settle(places: range) -> None:
            """Let the character before each place be unknown: no piece covers it alone."""
            for end in places:
                reached = score[end - 1] + self.unknown
                if reached > score[end]:
                    score[end], unknown[end] = reached, True
                    count[end] = count[end - 1] + (not unknown[end - 1])

        settled = 0
        for last, (length, piece_score) in self.automaton.iter(word):
            if settled < last:
                settle(range(settled + 1, last + 1))
                settled = last
            end = last + 1
            start = end - length
            reached = score[start] + piece_score
            if reached > score[end]:
                score[end] = reached
                count[end] = count[start] + 1
            if length == 1:
                settled = end
        settle(range(settled + 1, size + 1))
        return count[size]

    def search_by_windows(self, word: str) -> int:
        """``search`` of a space and a word of any length, in memory for a window of it.

        A piece reaches back by the longest piece's length only, so what is known of earlier
        places is dropped at the end of each window. Places count from ``base``.
        """
        score, count, unknown = [0.0], [0], [False]
        base, settled, kept = 0, 0, self.longest + 1
        matches = self.automaton.iter("")
        parts = itertools.chain([SPACE], (word[a : a + WINDOW] for a in range(0, len(word), WINDOW)))
        size = 0
        for part in parts:
            score += [-math.inf] * len(part)
            count += [0] * len(part)
            unknown += [False] * len(part)

            def settle(places: range) -> None:
                for end in places:
                    at = end - base
                    reached = score[at - 1] + self.unknown
                    if reached > score[at]:
                        score[at], unknown[at] = reached, True
                        count[at] = count[at - 1] + (not unknown[at - 1])

            matches.set(part)
            for last, (length, piece_score) in matches:
                if settled < last:
                    settle(range(settled + 1, last + 1))
                    settled = last
                at = last + 1 - base
                reached = score[at - length] + piece_score
                if reached > score[at]:
                    score[at] = reached
                    count[at] = count[at - length] + 1
                if length == 1:
                    settled = last + 1
            size += len(part)
            # The last place may still get shorter matches only within this part: all are known.
            settle(range(settled + 1, size + 1))
            settled = size
            drop = len(score) - kept
            if drop > 0:
                del score[:drop], count[:drop], unknown[:drop]
                base += drop
        return count[-1]

    def of(self, text: str) -> int:
        """Tokens of a text: a space begins the word after it, and so does the text."""
        if not text:
            return 0
        words = text.replace(SPACE, " ").split(" ")
        if not words[0]:
            words = words[1:]
        return sum(map(self.__getitem__, words))


@functools.lru_cache(maxsize=2)
def counts_of(pieces: tuple[tuple[str, float], ...]) -> Counts:
    return Counts(list(pieces))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per row: doc_id, n_tokens. A null or empty text has none.

    Repeated rows have a row each, and an empty table gives none. Texts of any length are
    counted whole, in memory that does not grow with their words; other columns are not read,
    so their names may be any.

    The vocabulary file is read by the driver and sent to the tasks; nothing is shuffled.
    """
    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(tuple(read_pieces(path)))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_of(sent.value)
        for part in parts:
            found = pa.array([counts.of(text.as_py()) for text in part.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], ["doc_id", "n_tokens"])

    return rows.mapInArrow(batches, f"doc_id {kind}, n_tokens long")
