"""Periodic runs, whitening and top-k search against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymonth.llm import bit_sliced, periodic, queries, whitening
from tallymonth.llm.common import table
from tests.llm.cases import ROWS, documents, with_clashes

# Periodic runs


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    least: dict = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end + period - at
            if end > at and length >= max(12, 2 * period):
                least.setdefault((at, length), period)
            at = end + 1
    return sorted(((at, n, period) for (at, n), period in least.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words: list, runs: list) -> list:
    gone = {i for at, n, period in runs for i in range(at + period, at + n)}
    return [word for i, word in enumerate(words) if i not in gone]


def split_words(text: str | None) -> list[str]:
    return [word.decode() for word in (text or "").encode().split()]


def planted(doc_id, text: str | None) -> list[str]:
    words = split_words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else word for i, word in enumerate(words)]


def test_runs_of_random_words() -> None:
    random.seed(4)
    for _ in range(300):
        texts = []
        for _ in range(random.randint(1, 5)):
            kinds, size = random.choice([1, 2, 3, 8, 60]), random.choice([0, 1, 11, 12, 25, 90])
            words = random.choices(range(kinds), k=size)
            for _ in range(random.randint(0, 3)):
                if size:
                    at, period = random.randrange(size), random.randint(1, 12)
                    for i in range(at, min(size, at + random.randint(1, 50))):
                        words[i] = words[at + (i - at) % period]
            texts.append(words)
        starts = np.cumsum([0, *map(len, texts)])[:-1]
        found = periodic.find_runs(np.array(sum(texts, []), np.int32), starts)
        expected = [
            (at + int(start), n, period)
            for start, words in zip(starts, texts, strict=True)
            for at, n, period in brute_runs(words)
        ]
        assert found == sorted(expected, key=lambda run: (run[0], run[2]))


def test_rare_words_split_until_nothing_splits() -> None:
    # Only after "x" has split the text is the second "y" rare, and then "z".
    text = "a b " * 8 + "y z x " + "c d " * 3 + "y " + "e f " * 7 + "z"
    words = periodic.word_numbers(text, {})
    begins, ends = periodic.surviving_segments(words, np.array([0]))
    assert list(zip(begins, ends, strict=True)) == [(0, 16), (26, 40)]


def test_a_very_long_text_and_few_places_at_a_time(monkeypatch) -> None:
    words = periodic.word_numbers(("the onere of thand " * 70_000) + "end", {})
    assert periodic.find_runs(words, np.array([0])) == [(0, 280_000, 4)]
    random.seed(9)
    some = [random.choices(range(3), k=400) for _ in range(3)]
    monkeypatch.setattr(periodic, "PLACES_AT_ONCE", 7)
    found = periodic.find_runs(np.array(sum(some, []), np.int32), np.array([0, 400, 800]))
    assert found == [(400 * t + a, n, p) for t in range(3) for a, n, p in brute_runs(some[t])]


def check_digests(found, rows) -> None:
    expected = []
    for doc_id, words in rows:
        runs = brute_runs(words)
        at, n, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (lines, " ".join(brute_collapsed(words, runs))))
        milli = 1000 * n // period if runs else None
        expected.append((doc_id, len(runs), at, n, period, milli, *digests))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_runs_of_awkward_rows(spark) -> None:
    rows = [row for row in ROWS if len(row[1] or "") < 100_000]
    more = ["ha " * 30, "ha\nha\tha  ha " * 9, "x y " * 5 + "x", "x y " * 6, "Ä ä " * 20, "a b c a b c a b c a b d"]
    rows += [(20 + i, text, None, None, 0) for i, text in enumerate(more)] + [(20, more[0], None, None, 0)]
    docs = with_clashes(documents(spark, rows)).withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit(2))
    found = periodic.digests(periodic.periodic_runs(docs)).collect()
    check_digests(found, [(row[0], split_words(row[1])) for row in rows])
    assert periodic.digests(periodic.periodic_runs(docs.limit(0))).count() == 0
    whole = periodic.periodic_runs(documents(spark)).filter("doc_id = 10").first()
    assert whole.n_words == 280_001
    assert [tuple(run) for run in whole.runs] == [(0, 280_000, 4)]
    assert whole.collapsed == "the onere of thand end"


def test_the_query_finds_the_planted_runs(spark, sf_dir) -> None:
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    short = [(i, text) for i, text in rows if len(text or "") < 8_000]
    assert len(short) > len(rows) / 2
    found = queries.op13_periodic_runs(spark, sf_dir).collect()
    assert len(found) == len(rows)
    ids = {i for i, _ in short}
    check_digests([r for r in found if r.doc_id in ids], [(i, planted(i, text)) for i, text in short])


def test_planting_bears_awkward_rows(spark) -> None:
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    texts = [None, "", " \n", "one", "a b c d e f g h i j k l m n o p", "x " * 50]
    rows = [*zip(ids, texts, strict=True), (None, "a b c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = queries.with_planted_periods(frame).collect()
    assert [(r.doc_id, split_words(r.text)) for r in found] == [(i, planted(i, t)) for i, t in rows]


# Whitening


VECTORS = "vec_id long, embedding array<double>"


def awkward_vectors() -> list:
    random_ = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(random_.normal(size=(60, 6)) @ random_.normal(size=(6, 6)))]
    rows += [(7, rows[7][1])] * 3 + [(None, rows[0][1]), (200, rows[0][1])]
    bad = [None, [], [None] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6, [1.0, 2.0]]
    return rows + [(300 + i, v) for i, v in enumerate(bad)]


def brute_whitened(x: np.ndarray, components: int):
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x.astype(object) - s) ** 2).sum(axis=1)
    centred = x - s / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return deviation, centred @ vectors / np.sqrt(values), values / np.trace(covariance)


def of_vectors(frame):
    good = frame.filter(whitening.finite(F.col("embedding")))
    return good.select(F.col("vec_id").alias("id"), whitening.quantised(F.col("embedding")).alias("x"))


@pytest.mark.parametrize("rows_a_block", [5, 1024])
def test_whitening(spark, rows_a_block) -> None:
    rows = awkward_vectors()
    frame = spark.createDataFrame(rows, VECTORS).repartition(3).withColumn("component", F.lit("clash"))
    used = [(i, v) for i, v in rows if v and None not in v and len(v) == 6 and np.isfinite(v).all()]
    x = np.floor(1024 * np.array([v for _, v in used])).astype(np.int64) + 100_000
    deviation, whitened, explained = brute_whitened(x, 8)
    found = whitening.whiten(of_vectors(frame).withColumn("part", F.lit(0)), rows_a_block=rows_a_block).collect()
    assert len(found) == 6 * len(used)
    assert {r.n for r in found} == {len(used)}
    assert max(r.identity_error for r in found) < 1e-9
    by_row: dict = {}
    for r in found:
        by_row.setdefault((r.id is None, r.id or 0, int(r.deviation)), []).append(r)
    signs = None
    for (vec_id, _), d, w in zip(used, deviation.tolist(), whitened, strict=True):
        mine = sorted(by_row[(vec_id is None, vec_id or 0, d)], key=lambda r: r.component)
        mine = mine[:: len(mine) // 6]
        assert [r.component for r in mine] == [1, 2, 3, 4, 5, 6]
        got = np.array([r.whitened for r in mine])
        signs = np.sign(got * w) if signs is None else signs
        assert np.abs(got * signs - w).max() < 1e-9
        assert np.allclose([r.explained for r in mine], explained, rtol=1e-9)


def test_whitening_of_few_or_equal_vectors(spark) -> None:
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], VECTORS)
    for frame, rows in ((same, 10), (same.limit(1), 2)):
        found = whitening.whiten(of_vectors(frame)).collect()
        assert len(found) == rows
        assert {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in found} == {(0, 0, 0, 0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], VECTORS)
    found = whitening.whiten(of_vectors(line)).collect()
    assert {r.whitened for r in found if r.component == 2} == {0}
    assert max(r.identity_error for r in found) < 1e-9
    assert whitening.whiten(of_vectors(same.limit(0))).count() == 0


def test_deviations_are_exact_beyond_64_bits() -> None:
    numbers = np.array([[2**50 + 3, -(2**55) - 1], [0, 7]], np.int64)
    assert whitening._squares(numbers) == [(2**50 + 3) ** 2 + (2**55 + 1) ** 2, 49]


def test_the_whitening_query(spark, sf_dir) -> None:
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(np.int64) + 100_000
    deviation, whitened, explained = brute_whitened(x, 8)
    frame = queries.op11_whitening(spark, sf_dir).toPandas().sort_values(["vec_id", "component"])
    assert len(frame) == 8 * len(rows)
    order = np.argsort([i for i, _ in rows])
    got = frame["whitened"].to_numpy().reshape(-1, 8)
    signs = np.sign((got * whitened[order]).sum(axis=0))
    assert np.abs(got * signs - whitened[order]).max() < 1e-8
    assert frame["deviation"].tolist()[::8] == deviation[order].tolist()
    assert np.allclose(frame["explained"].to_numpy()[:8], explained, rtol=1e-9)


# Top-k search


def brute_top(rows: list, divisor: int, k: int) -> list:
    used = [(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows
            if v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for a, (query, q) in enumerate(used):
        if query is None or query % divisor:
            continue
        scored = [
            (-sum(x * y for x, y in zip(q, v, strict=True)), i is None, i or 0)
            for b, (i, v) in enumerate(used)
            if a != b and len(v) == len(q)
        ]
        out += [
            (query, rank, None if missing else i, -score)
            for rank, (score, missing, i) in enumerate(sorted(scored)[:k], start=1)
        ]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows", [4, 2048])
@pytest.mark.parametrize("k", [1, 5, 200])
def test_top_rows(spark, block_rows, k) -> None:
    rows = awkward_vectors()
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    frame = frame.withColumn("score", F.lit("clash")).withColumn("rank", F.lit(1))
    found = bit_sliced.top_k(frame, divisor=10, k=k, block_rows=block_rows).collect()
    assert sorted(map(tuple, found), key=repr) == brute_top(rows, 10, k)


@pytest.mark.parametrize("kind", ["unit", "cone", "ties", "negative", "wide", "equal"])
def test_candidates_hold_the_best_of_any_data(kind) -> None:
    random_ = np.random.default_rng(8)
    rows = random_.normal(size=(700, 24))
    rows = {
        "unit": rows / np.linalg.norm(rows, axis=1, keepdims=True),
        "cone": 1 + rows / 100,
        "ties": np.round(rows) / 256,
        "negative": -np.abs(rows),
        "wide": rows * 10.0 ** random_.integers(-3, 5, (700, 1)),
        "equal": np.repeat(rows[:7], 100, axis=0),
    }[kind]
    numbers = np.floor(256 * rows).astype(np.int64)
    searcher = bit_sliced.Searcher(bit_sliced.Block.of(numbers))
    for query, found in zip(numbers[::9], searcher.candidates(numbers[::9], 6), strict=True):
        score = numbers @ query
        assert set(np.flatnonzero(score >= np.sort(score)[-6])) <= set(found.tolist())


def test_bitmap_arithmetic() -> None:
    random_ = np.random.default_rng(2)
    numbers = random_.integers(0, 50, (130, 9))
    slices = bit_sliced.packed(numbers, 10)
    total = bit_sliced.total(slices[None])[0]
    bits = np.unpackbits(total.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(np.int64)
    sums = (bits << np.arange(10)[:, None]).sum(axis=0)
    assert sums.tolist() == numbers.sum(axis=1).tolist()
    valid = bit_sliced.packed(np.ones((130, 1), np.int64), 1)[0, 0]
    for k in (1, 5, 130):
        value = bit_sliced.kth_largest(total, valid, k)
        assert value == np.sort(sums)[-k]
        found = np.unpackbits(bit_sliced.at_least(total, valid, value).view(np.uint8), bitorder="little")
        assert np.flatnonzero(found).tolist() == np.flatnonzero(sums >= value).tolist()
    assert bit_sliced.kth_largest(total, valid, 131) == 0


def test_top_rows_of_none_and_of_numbers_too_large(spark) -> None:
    none = spark.createDataFrame([], VECTORS)
    assert bit_sliced.top_k(none).count() == 0
    large = spark.createDataFrame([(0, [1e30]), (1, [1.0])], VECTORS)
    with pytest.raises(Exception, match="too large"):
        bit_sliced.top_k(large).collect()


def test_lanes_keep_the_number_of_tasks_bounded() -> None:
    assert bit_sliced._lanes(0, 0) == (1, 1)
    assert bit_sliced._lanes(12.5, 3) == (13, 3)
    rows, columns = bit_sliced._lanes(1e6, 1e5)
    assert rows * columns <= 1.1 * bit_sliced.MOST_CELLS


def test_the_top_k_query_matches_its_sql(spark, sf_dir) -> None:
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    expected = con.sql(queries.ORACLE_SQL["op12_bit_sliced"]).fetchall()
    found = queries.op12_bit_sliced(spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert len(found) == 50
