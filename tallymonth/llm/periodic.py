"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a longest stretch of words that repeats itself with a smallest period, at least
twice over. So every word in it occurs at least twice in any segment that holds the run, and a
word that occurs once in a segment is in no run of it: such words split the segment.
Words that were frequent in a segment may be rare in its parts, so the parts are counted
anew until nothing splits; parts shorter than the shortest run are let go.

What survives is scanned lag by lag. A stretch that repeats with lag q has at least
``step`` = max(shortest - q, q) words that equal the one q further on, so one of the places
0, step, 2 step, ... of its segment is among them: only these are tried, which is n log n
places for all lags together. Places whose neighbours match too are followed to both ends.
Inside a run that is known already, lags that are multiples of its period only find that
run again and are passed over.

Many texts are searched at once, as arrays of word numbers; the texts of a batch never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymonth.llm.common import texts

SHORTEST = 12
TIMES = 2

# Of a text, so much is cut into words at a time, and so many texts are searched together.
CHUNK_BYTES = 1 << 20
WORDS_AT_ONCE = 1 << 17
PLACES_AT_ONCE = 1 << 20

BLANKS = b" \t\n\r\x0b\x0c"


def word_numbers(text: str, numbers: dict[bytes, int]) -> np.ndarray:
    """The text's words as numbers; ``numbers`` learns new words in order."""
    data, parts, start = text.encode(), [], 0
    while start < len(data):
        end = start + CHUNK_BYTES
        while end < len(data) and data[end] not in BLANKS:
            end += 1
        words = data[start:end].split()
        parts.append(
            np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words))
        )
        start = end
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def surviving_segments(
    words: np.ndarray, starts: np.ndarray, shortest: int = SHORTEST
) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the segments that no rare word splits, in order.

    ``starts`` are the first places of the texts that ``words`` holds one after the other.
    """
    ends = np.append(starts[1:], len(words))
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        long_enough = ends - starts >= shortest
        starts, ends = starts[long_enough], ends[long_enough]
        if not len(starts):
            break
        lengths = ends - starts
        segment = np.repeat(np.arange(len(starts)), lengths)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place += np.repeat(starts, lengths)
        key = segment.astype(np.int64) << 32 | words[place]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        first = np.append(True, ranked[1:] != ranked[:-1])
        alone = np.zeros(len(key), bool)
        alone[order] = first & np.append(first[1:], True)
        split = np.zeros(len(starts), bool)
        split[segment[alone]] = True
        done.append((starts[~split], ends[~split]))
        if not split.any():
            break
        # Between two rare words of a split segment, or one and the segment's end, is a part.
        cuts = place[alone]
        begin = np.concatenate([starts[split], cuts + 1])
        end = np.concatenate([ends[split], cuts])
        begin.sort()
        end.sort()
        starts, ends = begin, end
    if not done:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin, end = (np.concatenate(parts) for parts in zip(*done, strict=True))
    order = np.argsort(begin)
    return begin[order], end[order]


def _followed(words: np.ndarray, at: int, lag: int, begin: int, end: int) -> tuple[int, int]:
    """The stretch around ``at`` in which words equal those ``lag`` further on, within a segment."""
    low, size = at, 64
    while low > begin:
        left = max(begin, low - size)
        differ = np.flatnonzero(words[left:low] != words[left + lag : low + lag])
        if len(differ):
            low = left + int(differ[-1]) + 1
            break
        low, size = left, size * 4
    high, size = at + 1, 64
    while high + lag < end:
        right = min(end - lag, high + size)
        differ = np.flatnonzero(words[high:right] != words[high + lag : right + lag])
        if len(differ):
            high += int(differ[0])
            break
        high, size = right, size * 4
    return low, high


def find_runs(
    words: np.ndarray, starts: np.ndarray, shortest: int = SHORTEST, times: int = TIMES
) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period; places count over all texts.

    Runs have at least ``shortest`` words and at least two periods.
    """
    if times < 2 or shortest < 2:
        raise ValueError("a run has at least two periods and two words")
    begins, ends = surviving_segments(words, starts, shortest)
    lengths = ends - begins
    # A row for each segment and lag, short lags first: they explain their multiples.
    lags_of = lengths // times
    segment = np.repeat(np.arange(len(begins)), lags_of)
    lag = np.arange(lags_of.sum()) - np.repeat(np.cumsum(lags_of) - lags_of, lags_of) + 1
    order = np.argsort(lag, kind="stable")
    segment, lag = segment[order], lag[order]
    step = np.maximum(shortest - lag, lag * (times - 1))
    tried = (lengths[segment] - lag - 1) // step + 1
    upto = np.cumsum(tried)
    known_end = np.zeros(len(words), np.int64)
    known_period = np.ones(len(words), np.int64)
    found: dict[tuple[int, int], int] = {}
    row = 0
    while row < len(lag):
        base = upto[row - 1] if row else 0
        last = max(row + 1, int(np.searchsorted(upto, base + PLACES_AT_ONCE, "right")))
        counts = tried[row:last]
        which = np.repeat(np.arange(row, last), counts)
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begins[segment[which]] + nth * step[which]
        same = words[at] == words[at + lag[which]]
        at, which = at[same], which[same]
        q = lag[which]
        again = (known_end[at] > at + q) & (q % known_period[at] == 0)
        at, which, q = at[~again], which[~again], q[~again]
        # A stretch has at least `enough` matches in a row, some before and some after the place.
        enough = shortest - shortest // 2
        left, right = begins[segment[which]], ends[segment[which]] - q
        matches, going = np.ones(len(at), np.int64), np.arange(len(at))
        for sign in (1, -1):
            going = np.arange(len(at))
            for distance in range(1, enough):
                there = at[going] + sign * distance
                going = going[(there >= left[going]) & (there < right[going])]
                there = at[going] + sign * distance
                going = going[words[there] == words[there + q[going]]]
                matches[going] += 1
        keep = matches >= enough
        for place, number, period in zip(
            at[keep].tolist(), which[keep].tolist(), q[keep].tolist(), strict=True
        ):
            if known_end[place] > place + period and period % known_period[place] == 0:
                continue
            home = segment[number]
            low, high = _followed(words, place, period, int(begins[home]), int(ends[home]))
            if high - low < step[number]:
                continue
            high += period
            found.setdefault((low, high), period)
            farther = known_end[low:high] < high
            known_period[low:high][farther] = period
            known_end[low:high][farther] = high
        row = last
    return sorted(
        ((low, high - low, period) for (low, high), period in found.items()),
        key=lambda run: (run[0], run[2]),
    )


def collapsed_words(size: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word stays: none does that a run holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _searched(batch: list[str]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """(number of words, runs, text without what repeats) of each text."""
    numbers: dict[bytes, int] = {}
    each = [word_numbers(text, numbers) for text in batch]
    sizes = np.array([len(words) for words in each], np.int64)
    starts = np.cumsum(sizes) - sizes
    words = np.concatenate(each) if each else np.empty(0, np.int32)
    runs = find_runs(words, starts)
    stays = collapsed_words(len(words), runs)
    spelled = list(numbers)
    home = np.searchsorted(starts + sizes, [run[0] for run in runs], "right").tolist()
    of_text: list[list[tuple[int, int, int]]] = [[] for _ in batch]
    for (start, length, period), text in zip(runs, home, strict=True):
        of_text[text].append((start - int(starts[text]), length, period))
    for at, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
        kept = words[start : start + size][stays[start : start + size]]
        text = b" ".join(map(spelled.__getitem__, kept.tolist())).decode()
        yield size, of_text[at], text


def _groups(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Slices of a batch of texts that are about ``WORDS_AT_ONCE`` words together, at least one text."""
    start, held = 0, 0
    for at, length in enumerate(lengths):
        if held and held + length > 6 * WORDS_AT_ONCE:
            yield start, at
            start, held = at, 0
        held += length
    if start < len(lengths):
        yield start, len(lengths)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words, runs, collapsed.

    ``runs`` is an array of (start, length, period), by start and period: every longest
    stretch of words with that smallest period, at least ``SHORTEST`` words and two periods
    long. Words are numbered from 0 and compared as they are. ``collapsed`` joins by blanks
    the words that no run holds after its first period.

    A null or empty text has no words, no runs and an empty ``collapsed``. Runs that start
    together are told apart by their period; equal rows have equal results, a row each. Texts
    of any length are searched whole, in memory that grows with the longest text. An
    empty table gives an empty result; other columns are not read, so their names may be any.
    No shuffle.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            lengths = [len(text.as_buffer()) for text in whole.column("text")]
            for start, end in _groups(lengths):
                part = whole.slice(start, end - start)
                found = _searched(part.column("text").to_pylist())
                sizes, runs, left = zip(*found, strict=True)
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in one] for one in runs]
                columns = [
                    part.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(runs, pa.list_(RUN)),
                    pa.array(left, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(
        batches,
        f"doc_id {kind}, n_words long, "
        "runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )


def digests(found: DataFrame) -> DataFrame:
    """Of ``periodic_runs``: doc_id, n_runs, the longest run, and digests of runs and text.

    The longest run is the first of equals by start, then period; its four columns are null
    where there is none.
    """
    runs = F.col("runs")
    # Arrays of structs are ordered by their fields in turn.
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    best = F.array_min(ranked)
    listed = F.transform(
        runs, lambda r: F.concat_ws(",", *[r[name].cast("string") for name in ("start", "length", "period")])
    )
    lines = F.when(F.size(runs) > 0, F.concat(F.array_join(listed, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * -best.less) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
