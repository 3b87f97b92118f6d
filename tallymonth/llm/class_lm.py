"""Brown class-based bigram language model.

Words are assigned to classes by exchange. In every round the class is found for each word in
which the training text would become likeliest, were the other words to stay where they are.
As many words move at once, their gains need not add up: so several shares of the moves, those of
the largest gains first, are tried, the likelihood of the whole training text is counted for
each, and the best one is taken. If none raises the likelihood, exchange ends: it
never falls. A token's probability is that of its class after the class before it, times that of the
word in its class, mixed with the smoothed unigram probability.

Words that make up at least ``FREQUENT`` of all tokens move on their own; there are at
most 1 / ``FREQUENT`` of them, whatever the corpus. All rarer words that end alike (one
of ``ENDINGS`` hashes of the last two bytes) move together. So the classes, and what is
sent to the tasks, have a fixed bound, while every word is counted by itself: the counts
of words that make up at least ``LISTED`` of all tokens are sent to the tasks, 1 / ``LISTED`` at
most, and those of rarer words are joined with the texts' rare words.

Every probability has the factor count + 1, so a text's score is a sum of
log10(count + 1) over its tokens and of one number for each pair of adjacent classes.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymonth.llm.common import stored, texts, word_lists

FREQUENT = 2e-5
LISTED = 2e-6
ENDINGS = 1024
CLASSES = 64
ROUNDS = 6

# Shares of the moves that are tried together.
SHARES = [1, 1 / 2, 1 / 4, 1 / 8, 1 / 16, 1 / 32, 1 / 128, 1 / 512]
LEAST_GAIN = 1e-5
LONGEST_CACHED = 64
CLASS_SHARE = 0.9
TRANSITION_SMOOTHING = 0.1
CACHED_WORDS = 100_000
FLUSH_WORDS = 100_000
UNITS_A_TASK = 16


class Units(dict):
    """The unit of a word: its own if it is frequent, else that of its ending. Words that are
    ``listed`` besides have numbers of their own, after all units and the end token."""

    def __init__(self, frequent: list[bytes], listed: list[bytes] | None = None) -> None:
        super().__init__((word, number) for number, word in enumerate(frequent))
        self.own, self.frequent, self.listed = len(frequent), frequent, listed or []
        self.update((word, self.own + ENDINGS + 1 + at) for at, word in enumerate(self.listed))
        self.full = len(self) + CACHED_WORDS

    def __missing__(self, word: bytes) -> int:
        unit = self.own + ending(word)
        if len(self) < self.full and len(word) <= LONGEST_CACHED:
            self[word] = unit
        return unit

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def __reduce__(self):
        return Units, (self.frequent, self.listed)


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


@dataclass(frozen=True)
class Model:
    units: Units
    counts: np.ndarray  # of each frequent word, then of the end token
    class_of: np.ndarray  # of each unit, the last of them the end token
    pair: np.ndarray  # log10 of what a class after a class contributes to a token
    tokens: int
    words: int  # distinct tokens
    likelihoods: tuple[float, ...]  # of the classes, before and after each round
    numbers: Units  # of the words whose counts are sent: the frequent and the listed ones
    listed_counts: np.ndarray

    @property
    def base(self) -> float:
        """log10 of the denominator of the unigram probability."""
        return float(np.log10(self.tokens + self.words + 1))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts; tasks add up before the shuffle."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for part in parts:
            for text in part.column("text"):
                for words in word_lists(text.as_py()):
                    counts.update(words)
                if len(counts) >= FLUSH_WORDS:
                    yield flushed()
        yield flushed()

    counted = texts(docs).select("text").mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _sequences(docs: DataFrame, units: Units) -> DataFrame:
    """(units): the units of each text and, after its last part, that of the end token."""
    sent = docs.sparkSession.sparkContext.broadcast(units)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = sent.value
        end = np.array([units.own + ENDINGS], np.int32)
        for whole in parts:
            for at in range(0, len(whole), 512):
                rows = []
                for text in whole.column("text").slice(at, 512):
                    found = [units.of(words) for words in word_lists(text.as_py())]
                    rows.append(np.concatenate([*found, end]))
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["units"])

    return texts(docs).select("text").mapInArrow(batches, "units array<int>")


def _neighbours(sequences: DataFrame, class_of: np.ndarray, classes: int) -> DataFrame:
    """(unit, counts): how often a unit follows and precedes each class, as one array of whole
    numbers; a row for each unit and task.

    There are as many tasks as the cluster runs at a time, so what a unit's rows take has a
    bound whatever the corpus.
    """
    spark = sequences.sparkSession
    sent = spark.sparkContext.broadcast(class_of)
    width = 2 * classes

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of = sent.value
        sums = np.zeros(len(class_of) * width, np.int64)
        for part in parts:
            units = part.column("units").flatten().to_numpy()
            if not len(units):
                continue
            after = class_of[units]
            before = np.concatenate([class_of[-1:], after[:-1]])
            sums += np.bincount(units.astype(np.int64) * width + before, minlength=len(sums))
            # A text's last token precedes the next text's first; the end token absorbs it.
            place = units[:-1].astype(np.int64) * width + classes + after[1:]
            sums += np.bincount(place, minlength=len(sums))
        counts = sums.reshape(-1, width)
        there = np.flatnonzero(counts.any(axis=1))
        for at in range(0, len(there), 4096):
            some = there[at : at + 4096]
            rows = [row.tobytes() for row in counts[some].astype("<i8")]
            yield pa.RecordBatch.from_pydict({"unit": some, "counts": pa.array(rows, pa.binary())})

    merged = sequences.coalesce(max(1, spark.sparkContext.defaultParallelism))
    return merged.mapInArrow(count, "unit long, counts binary")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(pairs: np.ndarray) -> float:
    """What the classes add to the log likelihood of the training text."""
    return float(
        _xlogx(pairs).sum() - _xlogx(pairs.sum(axis=1)).sum() - _xlogx(pairs.sum(axis=0)).sum()
    )


def _moves(neighbours: DataFrame, pairs: np.ndarray, class_of: np.ndarray) -> pd.DataFrame:
    """(unit, class, gain) of the units that another class suits better, one row a unit."""
    classes = len(pairs)
    sent = neighbours.sparkSession.sparkContext.broadcast((pairs, class_of))

    def move(group: pd.DataFrame) -> pd.DataFrame:
        pairs, class_of = sent.value
        units, place = np.unique(group["unit"], return_inverse=True)
        seen = np.zeros((len(units), 2 * classes))
        np.add.at(seen, place, np.stack([np.frombuffer(c, "<i8") for c in group["counts"]]))
        before, after = seen[:, :classes], seen[:, classes:]
        out, into, plain = pairs.sum(axis=1), pairs.sum(axis=0), _xlogx(pairs)

        def gained(counts: np.ndarray, logs: np.ndarray, own: np.ndarray, here: int) -> np.ndarray:
            """What ``own`` adds to the rows of the counts, once taken out of the row it is in."""
            some = np.flatnonzero(own)
            counts, logs, own = counts[:, some], logs[:, some], own[some]
            counts[here] = np.maximum(counts[here] - own, 0)
            logs[here] = _xlogx(counts[here])
            return (_xlogx(counts + own) - logs).sum(axis=1)

        best, gains = [], []
        for row, unit in enumerate(units):
            here, left, right = class_of[unit], before[row], after[row]
            sent_out, got = out.copy(), into.copy()
            sent_out[here] = max(sent_out[here] - right.sum(), 0)
            got[here] = max(got[here] - left.sum(), 0)
            gain = gained(pairs, plain, right, here) + gained(pairs.T, plain.T, left, here)
            gain -= _xlogx(sent_out + right.sum()) - _xlogx(sent_out)
            gain -= _xlogx(got + left.sum()) - _xlogx(got)
            gain = gain[:-1]  # the end token's class is its own
            to = int(gain.argmax())
            best.append(to)
            gains.append(float(gain[to] - gain[here]))
        found = pd.DataFrame({"unit": units, "class": best, "gain": gains})
        return found[found["gain"] > 1e-9]

    end = len(class_of) - 1
    units = neighbours.filter((F.col("unit") >= 0) & (F.col("unit") < end))
    found = units.groupBy(F.floor(F.col("unit") / UNITS_A_TASK)).applyInPandas(
        move, "unit long, class long, gain double"
    )
    return found.toPandas()


def _pairs_by_map(sequences: DataFrame, maps: list[np.ndarray], classes: int) -> list[np.ndarray]:
    """The counts of adjacent classes under each of several assignments, in one pass."""
    sent = sequences.sparkSession.sparkContext.broadcast(maps)

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps = sent.value
        sums = np.zeros((len(maps), classes * classes), np.int64)
        for part in parts:
            units = part.column("units").flatten().to_numpy()
            if not len(units):
                continue
            for total, class_of in zip(sums, maps, strict=True):
                after = class_of[units]
                before = np.concatenate([class_of[-1:], after[:-1]])
                total += np.bincount(before * classes + after, minlength=len(total))
        which, pair = np.nonzero(sums)
        yield pa.RecordBatch.from_pydict({"map": which, "pair": pair, "n": sums[which, pair]})

    counted = sequences.mapInArrow(count, "map long, pair long, n long")
    pairs = np.zeros((len(maps), classes * classes))
    for row in counted.groupBy("map", "pair").agg(F.sum("n").alias("n")).collect():
        pairs[row["map"], row["pair"]] = row["n"]
    return list(pairs.reshape(len(maps), classes, classes))


def exchange(
    sequences: DataFrame, class_of: np.ndarray, classes: int, rounds: int
) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each unit, counts of adjacent classes, likelihoods) after at most ``rounds``.

    The driver holds the units' classes and what they gain, which the number of units bounds.
    """
    (pairs,) = _pairs_by_map(sequences, [class_of], classes)
    likelihoods = [likelihood(pairs)]
    for _ in range(rounds):
        moves = _moves(_neighbours(sequences, class_of, classes), pairs, class_of).sort_values(["gain", "unit"], ascending=[False, True])
        if moves.empty:
            break
        # Moves to one class hinder each other most, so every class gets its best ones first.
        turn = moves.groupby("class").cumcount()
        moves = moves.iloc[np.lexsort((np.arange(len(moves)), turn))]
        maps = []
        for size in sorted({math.ceil(len(moves) * share) for share in SHARES}):
            maps.append(class_of.copy())
            maps[-1][moves["unit"].to_numpy()[:size]] = moves["class"].to_numpy()[:size]
        tried = _pairs_by_map(sequences, maps, classes)
        values = [likelihood(one) for one in tried]
        best = int(np.argmax(values))
        if values[best] <= likelihoods[-1]:
            break
        gained = values[best] - likelihoods[-1]
        class_of, pairs = maps[best], tried[best]
        likelihoods.append(values[best])
        if gained < LEAST_GAIN * abs(values[best]):
            break
    return class_of, pairs, likelihoods


def fit(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """A model of all texts of ``docs``, and the counts (word, n) of the rarer words.

    Without any text every probability is uniform.
    """
    counted = stored(word_counts(docs), "word-counts")
    texts_seen = docs.count()
    sums = counted.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    tokens = (sums["n"] or 0) + texts_seen
    words = sums["words"] + (texts_seen > 0)
    often = F.col("n") >= FREQUENT * tokens
    sent = counted.filter(F.col("n") >= LISTED * tokens).collect()
    known = sorted((-row["n"], bytes(row["word"])) for row in sent)
    frequent = [pair for pair in known if -pair[0] >= FREQUENT * tokens]
    units = Units([word for _, word in frequent])
    listed = known[len(frequent) :]
    numbers = Units([word for _, word in frequent], [word for _, word in listed])

    classes += 1  # the last one is the end token's
    own = units.own
    class_of = np.arange(own + ENDINGS + 1, dtype=np.int64) % (classes - 1)
    class_of[-1] = classes - 1
    sequences = stored(_sequences(docs, units), "unit-sequences")
    class_of, pairs, likelihoods = exchange(sequences, class_of, classes, rounds)

    rare = counted.filter(~often)
    ends = F.pmod(F.crc32(F.expr("substring(word, -2, 2)")), F.lit(ENDINGS))
    types = np.bincount(class_of[:own], minlength=classes)
    for row in rare.groupBy(ends.alias("ending")).agg(F.count("*").alias("words")).collect():
        types[class_of[own + row["ending"]]] += row["words"]
    types[classes - 1] += texts_seen > 0
    # Each ending stands for one more word, the unknown one.
    unknown = np.bincount(class_of[own:-1], minlength=classes)
    into = pairs.sum(axis=0)
    follows = (pairs + TRANSITION_SMOOTHING) / (pairs + TRANSITION_SMOOTHING).sum(axis=1, keepdims=True)
    emission = 1 / np.maximum(into + types + unknown, 1)
    pair = CLASS_SHARE * follows * emission + (1 - CLASS_SHARE) / (tokens + words + ENDINGS)
    counts = np.array([-count for count, _ in frequent] + [texts_seen])
    listed_counts = np.array([-count for count, _ in listed], np.int64)
    pair = np.log10(pair)
    model = Model(
        units, counts, class_of, pair, tokens, words, tuple(likelihoods), numbers, listed_counts
    )
    return model, rare


_SCORED = "word binary, n long, n_tokens long, n_known long, counts double, pairs double"


def _parts(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """A row for each text with what its classes and frequent words add, and one for each
    of its rarer words."""
    rows = texts(docs).withColumn("held_out", held_out).withColumn("h", F.xxhash64("text"))
    rows = rows.select("doc_id", "held_out", "h", "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, serial = sent.value, 0
        numbers, own, end = model.numbers, model.units.own, model.class_of[-1]
        by_ending = [own + ending(word) for word in numbers.listed]
        class_of = np.concatenate([model.class_of, model.class_of[by_ending]])
        # Rare words, and the end token, have their counts added elsewhere.
        logs = np.zeros(len(class_of))
        logs[:own] = np.log10(model.counts[:own] + 1.0)
        logs[own + ENDINGS + 1 :] = np.log10(model.listed_counts + 1.0)
        ends_known, ends_log = int(model.counts[-1] > 0), np.log10(model.counts[-1] + 1.0)
        for whole in parts:
            for at in range(0, len(whole), 256):
                part = whole.slice(at, 256)
                source: list[int] = []
                word, n, heads = [], [], []
                for row, text in enumerate(part.column("text")):
                    tokens, seen, counts, pairs, last = 1, ends_known, ends_log, 0.0, end
                    for words in word_lists(text.as_py()):
                        found = numbers.of(words)
                        if not len(found):
                            continue
                        classes = class_of[found]
                        pairs += model.pair[np.concatenate([[last], classes[:-1]]), classes].sum()
                        last = classes[-1]
                        rarely = (found >= own) & (found < own + ENDINGS)
                        counts += logs[found].sum()
                        seen += len(found) - int(rarely.sum())
                        tokens += len(found)
                        rare = Counter(compress(words, rarely.tolist()))
                        word.extend(rare)
                        n.extend(rare.values())
                        source.extend([row] * len(rare))
                    heads.append((tokens, seen, counts, pairs + model.pair[last, end]))
                rare = len(word)
                # No word has a blank: these keys match nothing and spread evenly.
                word.extend(b" %d" % (serial + i) for i in range(len(heads)))
                serial += len(heads)
                n.extend([0] * len(heads))
                source.extend(range(len(heads)))
                own_columns = part.select(["doc_id", "held_out", "h"]).take(pa.array(source, pa.int32()))
                head = [
                    pa.concat_arrays([pa.nulls(rare, kind), pa.array(values, kind)])
                    for kind, values in zip(
                        (pa.int64(), pa.int64(), pa.float64(), pa.float64()),
                        zip(*heads, strict=True) if heads else [[]] * 4,
                        strict=True,
                    )
                ]
                columns = [*own_columns.columns, pa.array(word, pa.binary()), pa.array(n, pa.int64())]
                names = [part.split(" ")[0] for part in _SCORED.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *head], ["doc_id", "held_out", "h", *names]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, held_out boolean, h long, {_SCORED}")


def scores(docs: DataFrame, model: Model, rare: DataFrame, held_out: Column) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities: ``base_score`` of the smoothed unigram model,
    ``score`` of the class model; score / n_tokens gives the perplexity. A null or empty text
    is its end token alone. Rows that repeat id and text have one row each; an empty table gives
    none. Texts of any length are scored whole, a bounded list of words at a time; other
    columns are not read but for ``held_out``, so their names may be any.
    """
    parts = _parts(docs, model, held_out)
    counts = rare.select(F.col("word").alias("rare_word"), F.col("n").alias("seen"))
    joined = parts.join(counts, F.col("word") == F.col("rare_word"), "left")
    seen = F.coalesce("seen", F.lit(0))
    log_count = F.coalesce("counts", F.lit(0.0)) + F.col("n") * F.log10(seen + 1.0)
    known = F.coalesce("n_known", F.lit(0)) + F.when(seen > 0, F.col("n")).otherwise(0)
    summed = joined.groupBy("doc_id", "held_out", "h").agg(
        F.count("n_tokens").alias("times"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(known).alias("n_known"),
        F.sum(log_count).alias("counts"),
        F.sum("pairs").alias("pairs"),
    )
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    times = F.col("times")
    tokens, log_counts = F.col("n_tokens") / times, F.col("counts") / times
    return each.select(
        "doc_id",
        "held_out",
        tokens.cast("long").alias("n_tokens"),
        (F.col("n_known") / times).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (log_counts - tokens * model.base).alias("base_score"),
        (log_counts + F.col("pairs") / times).alias("score"),
    )
