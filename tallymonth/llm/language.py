"""Language identification with error-correcting output codes.

Every language has a codeword; for every bit of the codewords a binary classifier of
character n-grams says on which side a text falls. Decoding sums a loss over the
bits, weighted by how well each bit's sides separate, and takes the language whose
codeword loses least, so single wrong bits are outvoted. A text whose second language
loses hardly more is flagged as ambiguous.

The classifiers' parameters are the summed n-gram counts of all labelled documents:
``BUCKETS`` numbers a language, so the model's size does not grow with the corpus.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymonth.llm.common import texts

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
SHARPNESS = 6.0
MARGIN_LIMIT = 3.0
AMBIGUOUS_BELOW = 0.01
UNDETERMINED = "und"
CHUNK = 1 << 19
MOST_LANGUAGES = 1_000

# Odd multipliers that spread the characters of an n-gram over the buckets.
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Buckets of a text's lower-cased letter n-grams, a bounded part of it at a time.

    All that is no letter counts as one blank, and so do both ends; n-grams of blanks alone
    are left out. The last characters of a part go before the next one, so that where a text
    is cut makes no difference.
    """
    whole = f" {text.lower()} "
    tail, tail_letter, after_letter = np.empty(0, np.uint64), np.empty(0, bool), True
    for start in range(0, len(whole), CHUNK):
        part = whole[start : start + CHUNK].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(part, np.uint32)
        letter = _letters()[codes]
        codes = np.where(letter, codes, 32)
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= after_letter
        after_letter, seen = bool(letter[-1]), len(tail)
        codes = np.concatenate([tail, codes[keep].astype(np.uint64) + np.uint64(1)])
        letter = np.concatenate([tail_letter, letter[keep]])
        longest = ORDERS[-1] - 1
        tail, tail_letter = codes[-longest:], letter[-longest:]
        if not letter.any():
            continue
        for order in ORDERS:
            # N-grams that end in the tail were counted with the part before.
            first = max(0, seen - order + 1)
            size = len(codes) - order + 1 - first
            if size <= 0:
                continue
            mixed, some = np.full(size, order, np.uint64), np.zeros(size, bool)
            for place in range(first, first + order):
                mixed = (mixed + codes[place : place + size]) * MULTIPLIERS[place - first]
                some |= letter[place : place + size]
            yield (mixed >> np.uint64(64 - 16))[some].astype(np.int64)


def codewords(count: int) -> np.ndarray:
    """A row of +1 and -1 per language: every split of up to seven languages, and
    fifteen times the bits that tell the languages apart, drawn far apart, beyond."""
    if count <= 7:
        splits = list(itertools.product((-1, 1), repeat=max(0, count - 1)))[:-1]
        return np.array([(1, *split) for split in splits], np.int8).reshape(len(splits), count).T
    bits, random = 15 * int(np.ceil(np.log2(count))), np.random.default_rng(42)
    best, widest = None, -1
    for _ in range(20):
        code = random.choice(np.array([-1, 1], np.int8), (count, bits))
        same = code.astype(np.int64) @ code.T
        np.fill_diagonal(same, -bits)
        nearest = (bits - same.max()) // 2
        if nearest > widest:
            best, widest = code, nearest
    return best


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    odds: np.ndarray  # buckets x bits: log odds of an n-gram
    middle: np.ndarray  # per bit, between the mean odds expected on its two sides
    spread: np.ndarray  # per bit, from there to either

    def predict(self, text: str) -> tuple[str, float, bool]:
        """(language, score, ambiguous); ties go to the first language by code point."""
        total, count = np.zeros(self.odds.shape[1]), 0
        for found in ngrams(text):
            total += self.odds[found].sum(axis=0, dtype=np.float64)
            count += len(found)
        if not count or not self.languages:
            return UNDETERMINED, 0.0, count > 0
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margin = np.clip((total / count - self.middle) / self.spread, -MARGIN_LIMIT, MARGIN_LIMIT)
        weight = self.spread / self.spread.sum()
        loss = np.exp(-margin * self.code) @ weight
        best = int(loss.argmin())
        second = np.partition(loss, 1)[1]
        share = np.exp(-SHARPNESS * (loss - loss[best]))
        return self.languages[best], float(1 / share.sum()), bool(second - loss[best] < AMBIGUOUS_BELOW)


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "lang") -> Model:
    """A model from every row whose label is not null; the text may be.

    One pass: tasks sum n-gram counts by language, a shuffle adds these up. The driver gets
    ``BUCKETS`` sums a language at most, so more than ``MOST_LANGUAGES`` labels are refused: a
    column of so many is no language. Languages without any letter are not learned; an empty
    table gives a model without languages.
    """
    rows = labelled.select(
        F.col(label_col).alias("label"), F.col(text_col).alias("text")
    ).filter("label is not null and text is not null")
    labels = rows.select("label").distinct().limit(MOST_LANGUAGES + 1).count()
    if labels > MOST_LANGUAGES:
        raise ValueError(f"column {label_col} has more than {MOST_LANGUAGES} labels")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for label, counts in sums.items():
                there = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict(
                    {"label": [label] * len(there), "bucket": there, "n": counts[there]}
                )
            sums.clear()

        for part in parts:
            columns = (part.column(name) for name in ("label", "text"))
            for label, text in zip(*columns, strict=True):
                if (label := label.as_py()) not in sums:
                    if len(sums) >= 64:
                        yield from flushed()
                    sums[label] = np.zeros(BUCKETS, np.int64)
                for found in ngrams(text.as_py()):
                    sums[label] += np.bincount(found, minlength=BUCKETS)
        yield from flushed()

    counted = rows.mapInArrow(count, "label string, bucket long, n long")
    sums = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    return from_counts(sums)


def from_counts(sums: pd.DataFrame) -> Model:
    """The model of n-gram counts (label, bucket, n)."""
    languages = sorted(set(sums["label"]))
    counts = np.zeros((len(languages), BUCKETS))
    place = sums["label"].map({label: at for at, label in enumerate(languages)})
    counts[place.to_numpy(np.int64), sums["bucket"].to_numpy(np.int64)] = sums["n"]
    code = codewords(len(languages))
    share = counts + SMOOTHING
    share /= share.sum(axis=1, keepdims=True)
    # A side's n-grams are those of its languages, each language counting alike.
    sides = [
        side.T @ share / side.sum(axis=0)[:, None] for side in ((code > 0) * 1.0, (code < 0) * 1.0)
    ]
    odds = np.log(sides[0] / sides[1])
    high, low = ((side * odds).sum(axis=1) for side in sides)
    return Model(
        languages, code, odds.T.astype(np.float32).copy(), (high + low) / 2, (high - low) / 2
    )


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row: doc_id, lang_pred, score (0 to 1), ambiguous.

    Only the text is looked at. A null text, or one without a letter, is ``und`` with
    score 0, and so is every text if nothing was learned. Texts of any length are read whole.
    Repeated rows have a row each, an empty table gives none; other columns may have any name.
    """
    rows = texts(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [sent.value.predict(text.as_py()) for text in part.column("text")]
            named = zip(*found, strict=True) if found else ([], [], [])
            types = (pa.string(), pa.float64(), pa.bool_())
            columns = [pa.array(c, t) for c, t in zip(named, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "ambiguous"]
            )

    return rows.mapInArrow(batches, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def in_known_language(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, whose language is found without doubt.

    Rejects texts without letters and ambiguous ones.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clear(text: pd.Series) -> pd.Series:
        found = (sent.value.predict(one or "") for one in text)
        return pd.Series([name != UNDETERMINED and not doubt for name, _, doubt in found], dtype=bool)

    return docs.filter(clear(F.col("text")))


def labelled_outside(docs: DataFrame, held_out: Column) -> DataFrame:
    """The text and label of documents that may be learned from."""
    return docs.filter(~held_out).select("text", "lang")
