"""Shards and token counts against brute force and the tokenizers library."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from tallymonth.llm import queries, sharding, token_counts
from tallymonth.llm.common import table
from tests.llm.cases import ROWS, documents, with_clashes

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("limit", [1, 5_000, 40_000, 1 << 30])
def test_only_oversized_shards_split(spark, sf_dir, limit) -> None:
    docs = table(spark, sf_dir, "documents")
    sizes = {r.doc_id: len(r.text.encode()) for r in docs.collect()}
    found = sharding.shards(docs, limit).collect()
    assert {r.doc_id: r.bytes for r in found} == sizes
    held, number = Counter(), Counter()
    for r in found:
        held[r.shard] += r.bytes
        number[r.shard] += 1
    assert all(r.shard_bytes == held[r.shard] for r in found)
    assert all(size <= limit or number[s] == 1 for s, size in held.items())
    for shard in filter(None, held):
        parent = shard[:-1]
        assert sum(size for s, size in held.items() if s.startswith(parent)) > limit
        assert not any(s != shard and s.startswith(shard) for s in held)


def test_shards_of_awkward_rows(spark) -> None:
    docs = with_clashes(documents(spark))
    found = sharding.shards(docs, 50).collect()
    assert Counter(r.doc_id for r in found) == Counter(row[0] for row in ROWS)
    assert sharding.shards(docs.limit(0), 50).count() == 0


def library() -> Tokenizer:
    tokenizer = Tokenizer(models.Unigram(token_counts.read_pieces(PIECES), 0, False))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace("▁", "always", True)
    return tokenizer


def test_counts_are_those_of_the_library(spark, sf_dir) -> None:
    tokenizer = library()
    docs = table(spark, sf_dir, "documents")
    expected = {r.doc_id: len(tokenizer.encode(r.text).ids) for r in docs.collect()}
    found = queries.op2_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in found} == expected
    docs = with_clashes(documents(spark))
    awkward = token_counts.token_counts(docs, PIECES).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in awkward) == Counter(
        (row[0], len(tokenizer.encode(row[1] or "").ids)) for row in ROWS
    )
    assert token_counts.token_counts(docs.limit(0), PIECES).count() == 0


def test_ties_and_unknown_characters() -> None:
    random.seed(2)
    counts, tokenizer = token_counts.Counts(token_counts.read_pieces(PIECES)), library()
    for _ in range(3000):
        text = "".join(random.choices("aeinrst  ▁\n你€😀<unk>ß", k=random.randint(0, 25)))
        assert counts.of(text) == len(tokenizer.encode(text).ids), text
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aab", -3.0), ("▁", -1.0)]
    tied = Tokenizer(models.Unigram(pieces, 0, False))
    own = token_counts.Counts(pieces)
    for _ in range(500):
        word = "".join(random.choices("abz", k=random.randint(1, 9)))
        assert own.search(word) == len(tied.encode(word).ids), word


def test_no_key_of_the_directory_holds_many_rows(spark, monkeypatch) -> None:
    rows = spark.range(5_000).select(F.shiftrightunsigned(F.xxhash64("id"), 1).alias("hash"), F.lit(10).cast("long").alias("bytes"))
    keys = []
    real = sharding.stored

    def noted(frame, purpose):
        if purpose == "prefixes":
            keys.append(frame)
        return real(frame, purpose)

    monkeypatch.setattr(sharding, "stored", noted)
    sums = sharding._sums(rows, 0, 13)
    assert len(keys) == 4
    by_level = {r.bits: (r.n, r.bytes) for r in sums.groupBy("bits").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()}
    assert set(by_level) == set(range(14))
    assert {bytes_ for _, bytes_ in by_level.values()} == {50_000}
    assert by_level[0][0] == 1
    # No level is summed from more than 2 ^ LEVELS rows a key.
    assert all(by_level[bits][0] <= 2**bits for bits in by_level)
    leaves = sharding._leaves(sums, 0, 400).collect()
    held = Counter()
    for r in leaves:
        assert r.shard_bytes <= 400
        held[r.split] += r.shard_bytes
    assert sum(held.values()) == 50_000


def test_directories_of_every_depth_agree(spark) -> None:
    rows = [(i, "x" * (i % 50)) for i in range(300)] + [(1, "y" * 9_000), (2, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (1, 60, 100_000):
        found = sharding.shards(docs, limit).collect()
        assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
        held = Counter()
        for r in found:
            held[r.shard] += r.bytes
        assert all(r.shard_bytes == held[r.shard] for r in found)
        names = sorted(held)
        assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False) if a != b)


def test_windows_count_as_one_search(monkeypatch) -> None:
    pieces = token_counts.read_pieces(PIECES)
    counts = token_counts.Counts(pieces)
    random.seed(8)
    letters = "theandofin\u00e9\u4f60\n."
    words = ["".join(random.choices(letters, k=n)) for n in (1, 2, 40, 300, 2_000)]
    words += ["the" * 500, "\u4f60" * 300, "\n" * 100, "internationalization" * 40]
    for window in (1, 2, 5, 64, 1_000):
        monkeypatch.setattr(token_counts, "WINDOW", window)
        for word in words:
            assert counts.search_by_windows(word) == counts.search(token_counts.SPACE + word), (window, word[:40])


def test_a_long_text_without_a_space_takes_little_memory() -> None:
    counts = token_counts.Counts(token_counts.read_pieces(PIECES))
    text = "thequickbrownfox\n" * 30_000
    tracemalloc.start()
    found = counts.of(text)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found > 30_000
    assert peak < 12 << 20
    assert len(counts) == 0
