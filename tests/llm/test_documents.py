"""The document operators against brute force, on awkward rows and on the smallest tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymonth.llm import bpe, class_lm, components, exact_dedup, language, mixing, queries, simhash
from tallymonth.llm.common import in_fold, stored, table
from tallymonth.llm.components import connected_components
from tests.helpers import plan_of
from tests.llm.cases import ROWS, documents, with_clashes

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def docs(spark):
    return with_clashes(documents(spark))


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]


# Exact dedup


def groups_by_text(rows) -> dict[str, list]:
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(row[1] or "", []).append(row[0])
    return groups


def check_assignments(found, rows, choose) -> None:
    groups = groups_by_text(rows)
    expected = Counter()
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        keep = choose((i for i in ids if i is not None), default=None)
        expected.update((i, keep, len(ids), digest) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == expected
    assert sum(r.kept for r in found) == len(groups)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


@pytest.mark.parametrize("hash_of", [exact_dedup.content_hash, lambda text: F.length(text) % 3])
@pytest.mark.parametrize(("keep", "choose"), [("max", max), ("min", min)])
def test_copies_even_where_hashes_collide(docs, hash_of, keep, choose) -> None:
    check_assignments(exact_dedup.assignments(docs, keep, hash_of).collect(), ROWS, choose)
    kept = exact_dedup.deduplicated(docs, keep, hash_of)
    assert kept.columns == docs.columns
    groups = groups_by_text(ROWS)
    ids = [choose((i for i in g if i is not None), default=None) for g in groups.values()]
    texts = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert Counter(texts) == Counter(zip(ids, groups, strict=True))


def test_copies_of_no_documents(docs) -> None:
    none = docs.limit(0)
    assert exact_dedup.assignments(none).count() == 0
    assert exact_dedup.deduplicated(none).count() == 0


# SimHash


def brute_fingerprint(text: str | None) -> int:
    words = words_of(text)
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    shingles = shingles or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(pairs, nodes) -> dict:
    label = {node: node for node in nodes}
    while True:
        before = dict(label)
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def check_near(found, rows) -> None:
    bits = {text or "": brute_fingerprint(text) for _, text in rows}
    prints = sorted(set(bits.values()))
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    root = brute_components(near, prints)
    least: dict = {}
    for doc_id, text in rows:
        ids = [i for i in (doc_id, least.get(root[bits[text or ""]])) if i is not None]
        least[root[bits[text or ""]]] = min(ids, default=None)
    expected = Counter((i, bits[t or ""], least[root[bits[t or ""]]]) for i, t in rows)
    assert Counter((r.doc_id, r.bits & (2**64 - 1), r.component_id) for r in found) == expected


def test_near_copies_on_awkward_rows(docs) -> None:
    found = simhash.near_duplicates(docs).collect()
    check_near(found, [row[:2] for row in ROWS])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({r.component_id for r in found})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_near_copies_on_the_smallest_table(spark, sf_dir, rows) -> None:
    check_near(simhash.near_duplicates(table(spark, sf_dir, "documents")).collect(), rows)
    shown = queries.op9_simhash(spark, sf_dir).first()
    assert len(shown.fingerprint) == 16
    assert int(shown.fingerprint, 16) == brute_fingerprint(dict(rows)[shown.doc_id])


@pytest.mark.parametrize("limit", [0, 2, 64])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_every_link_is_found_however_many_share_a_key(spark, limit, distance) -> None:
    random = np.random.default_rng(7)
    base = int(random.integers(1 << 62))
    flips = [[], *([b] for b in range(0, 64, 3)), *random.integers(0, 64, (150, 2)).tolist()]
    prints = sorted({base ^ sum(1 << b for b in set(f)) for f in flips})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    classes = spark.createDataFrame(signed, "bits long")
    found = simhash.links(classes, distance, pair_limit=limit).collect()
    pairs = {frozenset((a, b)) for (a,) in signed for (b,) in signed if a != b}
    expected = {p for p in pairs if ((min(p) ^ max(p)) & (2**64 - 1)).bit_count() <= distance}
    assert {frozenset(pair) for pair in found} == expected


def test_components_of_a_long_path(spark) -> None:
    edges = [(i, i + 1) for i in range(200)] + [(300, 301), (301, 302), (400, 400)]
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 0 for i in range(201)} | {300: 300, 301: 300, 302: 300}


@pytest.fixture
def plans(monkeypatch) -> list[str]:
    """The plans of all tables that the operators store."""
    seen: list[str] = []

    def noted(frame, purpose):
        seen.append(plan_of(frame, "simple"))
        return stored(frame, purpose)

    for module in (components, exact_dedup, simhash):
        monkeypatch.setattr(module, "stored", noted)
    return seen


@pytest.mark.parametrize(
    "result", [exact_dedup.deduplicated, simhash.one_of_each, simhash.near_duplicates]
)
def test_what_grows_with_documents_is_not_broadcast(docs, plans, result) -> None:
    plans.append(plan_of(result(stored(docs, "documents")), "simple"))
    assert any("SortMergeJoin" in plan for plan in plans)
    assert not any("Broadcast" in plan for plan in plans)


def test_links_are_not_broadcast(spark, plans) -> None:
    found = simhash.links(stored(spark.createDataFrame([(1 << i,) for i in range(40)], "bits long"), "classes"))
    plans.append(plan_of(found, "simple"))
    assert len({frozenset(pair) for pair in found.collect()}) == 40 * 39 / 2
    assert sum("SortMergeJoin" in plan for plan in plans) == 2
    assert not any("Broadcast" in plan for plan in plans)


def test_edges_are_broadcast_by_their_number(spark, plans, monkeypatch) -> None:
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    for most, broadcast in ((components.FEW_EDGES, True), (19, False)):
        monkeypatch.setattr(components, "FEW_EDGES", most)
        plans.clear()
        assert dict(connected_components(edges).collect()) == dict.fromkeys(range(21), 0)
        assert any("Broadcast" in plan for plan in plans) == broadcast


# BPE


def check_coded(found, rows) -> None:
    library = Tokenizer.from_file(VOCABULARY)
    texts = {}
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        packed = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        texts.setdefault(doc_id, []).append((len(ids), packed, hashlib.sha256(back.encode()).hexdigest()))
    for r in found:
        texts[r.doc_id].remove((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    assert not any(texts.values())


def test_ids_are_those_of_the_library(spark, sf_dir, rows, docs) -> None:
    outputs = ["n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"]
    coded = bpe.coded(docs, VOCABULARY, outputs).collect()
    check_coded(coded, [row[:2] for row in ROWS])
    check_coded(queries.op4_bpe(spark, sf_dir).collect(), rows)
    again = bpe.decoded(spark.createDataFrame(coded).select("doc_id", "ids"), VOCABULARY).collect()
    assert Counter(r.decoded for r in again) == Counter(r.decoded for r in coded)
    assert bpe.coded(docs.limit(0), VOCABULARY, outputs).count() == 0


def test_each_word_form_is_coded_as_by_the_library() -> None:
    coder, library = bpe.Coder(bpe.read_vocabulary(VOCABULARY)), Tokenizer.from_file(VOCABULARY)
    texts = ["a" * 3000, "the" * 300 + "é" * 99, "I'll <|startoftext|>x'S", "é ẛ̣ İ ΑΣ", "你好 ½²٣", "\x1c\x85"]
    texts += [f"a{chr(c)}b {chr(c)}" for c in range(0, 0x3000, 7)]
    for text in texts:
        assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("size", [1, 4, 9])
def test_ids_do_not_depend_on_where_a_long_text_is_cut(monkeypatch, size) -> None:
    coder, library = bpe.Coder(bpe.read_vocabulary(VOCABULARY)), Tokenizer.from_file(VOCABULARY)
    monkeypatch.setattr(bpe, "CHUNK", size)
    monkeypatch.setattr(bpe, "PART", regex.compile(rf"(?s).{{1,{size}}}\P{{White_Space}}*"))
    spaces = [*range(0x21), 0x7F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
    for code in spaces:
        for text in ("!" * 9 + chr(code) + "!!!! ab", f"It's{chr(code)}{chr(code)}12 <|endoftext|>{chr(code)}e\u0301x"):
            assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(code)


def test_a_text_beyond_a_part_has_the_librarys_ids() -> None:
    coder, library = bpe.Coder(bpe.read_vocabulary(VOCABULARY)), Tokenizer.from_file(VOCABULARY)
    text = "!" * 2**20 + "\x1c!!!! ab"
    assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_cached_words_are_bounded_by_their_length(monkeypatch) -> None:
    monkeypatch.setattr(bpe, "CACHED_CHARACTERS", 300)
    coder, library = bpe.Coder(bpe.read_vocabulary(VOCABULARY)), Tokenizer.from_file(VOCABULARY)
    for i in range(60):
        text = f"word{i} " + "x" * i * 3
        assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert sum(map(len, coder.cache)) <= 300 + len(text)


# Language


def brute_ngrams(text: str) -> list[str]:
    """The letter n-grams as strings: runs of anything else are one blank, as are both ends."""
    plain = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    plain = re.sub(" +", " ", plain)
    return [g for n in (1, 2, 3) for g in (plain[i : i + n] for i in range(len(plain) - n + 1)) if g.strip()]


def buckets(text: str) -> Counter:
    return Counter(itertools.chain.from_iterable(part.tolist() for part in language.ngrams(text)))


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_ngrams_do_not_depend_on_where_a_text_is_cut(monkeypatch, size) -> None:
    texts = ["", "a", "ab", "  ab  cd ", "1a2b33c", "Der Hund, schläft. Über ΑΣ ΑΣΑ!", "12 34", "x" * 40, "a b " * 9]
    whole = [buckets(text) for text in texts]
    monkeypatch.setattr(language, "CHUNK", size)
    assert [buckets(text) for text in texts] == whole
    for text, found in zip(texts, whole, strict=True):
        assert sum(found.values()) == len(brute_ngrams(text))
        assert len(found) == len(set(brute_ngrams(text)))


def test_decoding_is_brute_force() -> None:
    """Two languages, one bit by hand; then every codeword's loss, one bit after the other."""
    texts = {"aa": "abab abba", "bb": "cdcd dccd", "cc": "abcd dcba", "dd": "efgh abef"}
    rows = [(label, bucket, n) for label, text in texts.items() for bucket, n in buckets(text).items()]
    model = language.from_counts(pd.DataFrame(rows, columns=["label", "bucket", "n"]))
    share = {}
    for label, text in texts.items():
        counts = buckets(text)
        total = sum(counts.values()) + language.SMOOTHING * language.BUCKETS
        share[label] = {b: (n + language.SMOOTHING) / total for b, n in counts.items()}, language.SMOOTHING / total
    probe = "abba cdcd gh"
    losses = []
    for place, label in enumerate(model.languages):
        loss = 0.0
        for bit in range(model.code.shape[1]):
            sides = {side: [x for x, c in zip(model.languages, model.code[:, bit], strict=True) if c == side] for side in (1, -1)}

            def mean(bucket: int, side: int) -> float:
                return np.mean([share[x][0].get(bucket, share[x][1]) for x in sides[side]])

            odds = [math.log(mean(b, 1) / mean(b, -1)) for b in buckets(probe).elements()]
            value = (np.mean(odds) - model.middle[bit]) / model.spread[bit]
            value = min(max(value, -language.MARGIN_LIMIT), language.MARGIN_LIMIT)
            loss += math.exp(-value * model.code[place, bit]) * model.spread[bit] / sum(model.spread)
        losses.append(loss)
    label, score, doubt = model.predict(probe)
    assert label == model.languages[int(np.argmin(losses))]
    weights = [math.exp(-language.SHARPNESS * (x - min(losses))) for x in losses]
    assert score == pytest.approx(1 / sum(weights), rel=1e-4)
    assert doubt == (sorted(losses)[1] - min(losses) < language.AMBIGUOUS_BELOW)


def test_a_column_of_too_many_labels_is_refused(spark, monkeypatch) -> None:
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    rows = [(f"text {i}", f"l{i % 4}") for i in range(9)]
    with pytest.raises(ValueError, match="column tongue has more than 3 labels"):
        language.fit(spark.createDataFrame(rows, "text string, tongue string"), label_col="tongue")
    assert language.fit(spark.createDataFrame(rows, "text string, lang string").filter("lang < 'l3'")).languages == ["l0", "l1", "l2"]


def test_languages(spark, sf_dir, docs) -> None:
    found = {(r.doc_id, r.held_out): r for r in queries.op10_language_id(spark, sf_dir).collect()}
    labels = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").collect()}
    held = [labels[i] == r.lang_pred for (i, out), r in found.items() if out]
    assert all(out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, out in found)
    assert np.mean(held) >= 0.97
    model = language.fit(table(spark, sf_dir, "documents"))
    awkward = language.predictions(docs, model).collect()
    assert len(awkward) == len(ROWS)
    assert all(0 <= r.score <= 1 for r in awkward)
    assert {r.doc_id for r in awkward if r.lang_pred == "und"} == {4, 5, 6, 7}
    kept = language.in_known_language(docs, model)
    assert kept.columns == docs.columns
    assert not {4, 5, 6, 7} & {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("count", [0, 1, 2, 3, 7, 30])
def test_codewords_are_apart_and_models_of_any_size_decode(spark, count) -> None:
    code = language.codewords(count)
    assert len({tuple(row) for row in code}) == count
    texts = [(f"{chr(0x4E00 + i) * 3} {chr(0x5E00 + i) * 4}", f"l{i:02}") for i in range(count)]
    model = language.fit(spark.createDataFrame(texts, "text string, lang string"))
    assert model.languages == [label for _, label in texts]
    found = [model.predict(text)[0] for text, _ in texts]
    assert found == [label for _, label in texts]
    assert model.predict("1 2")[0] == "und"


# Mixing


def brute_targets(sizes: dict, weights: list[float], cap: float) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(cap * sizes[s] for s in full)
        level = left / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if level * weight[s] >= cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def check_mix(found, docs_of: dict, weights, cap=3.0) -> None:
    """docs_of: source to its documents' sizes."""
    expected = brute_targets({s: sum(sizes) for s, sizes in docs_of.items()}, weights, cap)
    taken: Counter = Counter()
    for r in found:
        assert r.target == pytest.approx(expected[r.source])
        assert r.source_size == sum(docs_of[r.source])
        assert 0 <= r.taken <= cap * r.size
        taken[r.source] += r.taken
    for source, sizes in docs_of.items():
        assert sorted(r.size for r in found if r.source == source) == sorted(sizes)
        assert abs(taken[source] - expected[source]) <= mixing.BLOCK_WORDS


def mixed(docs, weights):
    rows = mixing.mix(docs, mixing.cyclic_weights(docs, weights), carry=["doc_id", "source"])
    return rows.select("row.*", "size", "source_size", "target", mixing.taken_words(F.col("spans")).alias("taken"))


def test_mix_of_awkward_rows(docs) -> None:
    docs_of: dict = {}
    for row in ROWS:
        docs_of.setdefault(row[3], []).append(len(words_of(row[1])))
    found = mixed(docs, [5, 2, 1]).collect()
    check_mix(found, docs_of, [5, 2, 1])
    assert Counter(found) == Counter(mixed(docs, [5, 2, 1]).collect())
    out = mixing.mixed_documents(docs, mixing.cyclic_weights(docs, [5, 2, 1]))
    assert out.columns == docs.columns
    assert sum(len(words_of(r.text)) for r in out.collect()) == sum(r.taken for r in found)
    assert mixed(docs.limit(0), [5, 2, 1]).count() == 0


def test_mix_of_the_smallest_table_and_its_parts(spark, sf_dir, monkeypatch) -> None:
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    docs = table(spark, sf_dir, "documents")
    docs_of: dict = {}
    for r in docs.collect():
        docs_of.setdefault(r.source, []).append(len(words_of(r.text)))
    check_mix(mixed(docs, [5, 2, 1]).collect(), docs_of, [5, 2, 1])


def brute_quotas(targets: dict, most: dict, seats: int) -> dict:
    """Highest quotients, one block after the other; ties to the first source, null last."""
    got = dict.fromkeys(targets, 0)
    names = sorted(targets, key=lambda s: (s is None, (s or "").encode()))
    for _ in range(seats):
        open_ = [s for s in names if got[s] < most[s] and targets[s] > 0]
        if not open_:
            break
        got[max(open_, key=lambda s: targets[s] / (2 * got[s] + 1))] += 1
    return got


@pytest.mark.parametrize("seed", range(4))
def test_quotas_are_those_of_highest_quotients(spark, seed) -> None:
    random = np.random.default_rng(seed)
    names = [None, *[f"s{i}" for i in range([3, 12, 40, 25][seed])]]
    sizes = {s: int(n) for s, n in zip(names, random.integers(1, [50, 3000, 40, 9000][seed], len(names)), strict=True)}
    if seed == 3:
        sizes["s0"] = 200_000
    total = sum(sizes.values())
    weight = {s: float(w) for s, w in zip(names, random.choice([5, 2, 1, 0.01, 0], len(names)), strict=True)}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    weights = spark.createDataFrame([(s, w) for s, w in weight.items()], "source string, weight double")
    planned = mixing.with_blocks(mixing.targets(rows, weights), 32, total // 7)
    plan = planned.collect()
    targets, most = {r.source: r.target for r in plan}, {r.source: r.most for r in plan}
    shards, every = plan[0].shards, plan[0].all_blocks
    assert shards >= 6
    found = mixing.shard_quotas(planned).collect()
    before = dict.fromkeys(targets, 0)
    for shard in range(shards):
        dealt = brute_quotas(targets, most, every * (shard + 1) // shards)
        here = {r.source: (r.first_block, r.blocks) for r in found if r.shard == shard}
        assert here == {s: (before[s], dealt[s] - before[s]) for s in targets if targets[s] > 0}
        before = dealt


def test_many_small_sources_keep_the_size_of_the_mix(spark) -> None:
    rows = [(i, " ".join(["w"] * 10), f"s{i:03}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixed(docs, [5, 2, 1]).collect()
    check_mix(found, {f"s{i:03}": [10] for i in range(300)}, [5, 2, 1])
    assert abs(sum(r.taken for r in found) - 3000) <= 1


def test_equal_rows_are_dealt_to_many_parts(spark) -> None:
    repeated, others = 60_000, 4_000
    docs = spark.range(0, repeated + others, 1, 4).select(
        F.when(F.col("id") < repeated, 1).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < repeated, "the same words").otherwise(F.concat(F.lit("a word "), "id")).alias("text"),
        F.lit("a").alias("source"),
    )
    rows = docs.select(
        F.col("source").alias("name"), F.lit(False).alias("unnamed"), F.lit(3).cast("long").alias("size"),
        F.xxhash64("doc_id", "text").alias("order"), F.xxhash64("text").alias("exact"),
        F.monotonically_increasing_id().alias("nth"),
    )
    counts = [r["count"] for r in mixing._laid_out(rows).groupBy(*mixing.LINE).count().collect()]
    assert sum(counts) == repeated + others
    assert max(counts) < 3 * mixing.BUCKET_ROWS
    found = mixed(docs, [1]).agg(F.sum("taken").alias("taken"), F.max("taken").alias("most")).first()
    assert found.taken == 3 * (repeated + others)
    assert found.most <= 9


def test_blocks_of_the_mix_lie_in_their_shards(spark, sf_dir, monkeypatch) -> None:
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    monkeypatch.setattr(mixing, "PARTS_A_RUN", 3)
    docs = table(spark, sf_dir, "documents")
    weights = mixing.cyclic_weights(docs, [5, 2, 1])
    found = mixing.mix(docs, weights, shard_words=997, carry=["doc_id"])
    sizes = found.groupBy("source").agg(F.sum("size").alias("source_size"))
    planned = mixing.with_blocks(mixing.targets(sizes, weights), shard_words=997)
    starts: dict = {}
    for r in mixing.shard_quotas(planned).collect():
        starts.setdefault(r.source, []).append((r.first_block, r.first_block + r.blocks, r.shard))
    assert all(len(parts) > 10 for parts in starts.values())
    rows = found.select("source", "block", "blocks", F.explode("spans").alias("s")).select("source", "block", "blocks", "s.*").collect()
    covered: dict = {}
    for r in rows:
        covered[r.source] = covered.get(r.source, 0) + r.words
        for block, shard in ((r.first_block, r.first_shard), (r.last_block, r.last_shard)):
            assert [n for low, end, n in starts[r.source] if low <= block < end] == [shard]
    quota = {r.source: r.block * r.blocks for r in rows}
    assert covered == quota == {s: max(end for _, end, _ in parts) * rows[0].block for s, parts in starts.items()}


# Language model


def brute_base(train, text) -> tuple[int, int, float]:
    counts, tokens = train
    words = [*words_of(text), b" "]
    base = sum(math.log10((counts[w] + 1) / (tokens + len(counts) + 1)) for w in words)
    return len(words), sum(counts[w] > 0 for w in words), base


def test_scores(spark, sf_dir, rows) -> None:
    counts: Counter = Counter()
    for doc_id, text in rows:
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update([*words_of(text), b" "])
    tokens, texts = sum(counts.values()), dict(rows)
    found = queries.op3_class_lm(spark, sf_dir).collect()
    assert len(found) == len(rows)
    for r in found:
        n, known, base = brute_base((counts, tokens), texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, tokens)
        assert r.base_score == pytest.approx(base)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def brute_score(model, counts, text) -> float:
    """Word by word: log10 of the count and one, and of what a class after a class contributes."""
    last, total = model.class_of[-1], 0.0
    for word in [*words_of(text), None]:
        if word is None:
            unit, count = len(model.class_of) - 1, int(model.counts[-1])
        else:
            unit, count = model.units[word], counts[word]
        here = model.class_of[unit]
        total += math.log10(count + 1) + model.pair[last, here]
        last = here
    return total


def test_scores_are_those_of_a_plain_loop(spark, sf_dir, rows) -> None:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 7, 2)
    model, rare = class_lm.fit(docs.filter(~held_out), classes=20, rounds=2)
    counts: Counter = Counter()
    for doc_id, text in rows:
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(words_of(text))
    found = {r.doc_id: r.score for r in class_lm.scores(docs, model, rare, held_out).collect()}
    for doc_id, text in rows[:40]:
        assert found[doc_id] == pytest.approx(brute_score(model, counts, text))


def test_exchange_climbs(spark, sf_dir) -> None:
    docs = table(spark, sf_dir, "documents").filter(~in_fold("doc_id", 7, 2))
    model, _ = class_lm.fit(docs, classes=30, rounds=5)
    steps = model.likelihoods
    assert len(steps) >= 4
    assert all(b > a for a, b in zip(steps, steps[1:], strict=False))
    # The last one is that of the classes that were kept, counted word by word.
    pairs: Counter = Counter()
    for row in docs.collect():
        classes = [model.class_of[-1], *(model.class_of[model.units[w]] for w in words_of(row.text)), model.class_of[-1]]
        pairs.update(zip(classes, classes[1:], strict=False))
    after, into = Counter(), Counter()
    for (a, b), n in pairs.items():
        after[a] += n
        into[b] += n
    parts = (sum(n * math.log(n) for n in c.values()) for c in (pairs, after, into))
    value = next(parts) - next(parts) - next(parts)
    assert steps[-1] == pytest.approx(value)
    without, _ = class_lm.fit(docs, classes=30, rounds=0)
    assert without.likelihoods == (pytest.approx(steps[0]),)


def test_probabilities_sum_to_one(docs) -> None:
    model, rare = class_lm.fit(docs, classes=4, rounds=2)
    counts = {bytes(r.word): r.n for r in rare.collect()} | {
        word: int(model.counts[unit]) for word, unit in model.units.items() if unit < model.units.own
    }
    units = model.units.of(list(counts))
    weight = np.bincount(model.class_of[units], [n + 1 for n in counts.values()], len(model.pair))
    weight += np.bincount(model.class_of[model.units.own : -1], minlength=len(model.pair))
    weight[-1] += model.counts[-1] + 1
    assert (10**model.pair @ weight) == pytest.approx(np.ones(len(weight)), abs=1e-6)


def test_scores_of_awkward_rows(docs) -> None:
    train = docs.filter("lang = 'en'")
    model, rare = class_lm.fit(train, classes=4, rounds=2)
    counts: Counter = Counter()
    for row in ROWS:
        if row[2] == "en":
            counts.update([*words_of(row[1]), b" "])
    found = class_lm.scores(docs, model, rare, in_fold("doc_id", 7, 2)).collect()
    expected = Counter(
        (row[0], *brute_base((counts, sum(counts.values())), row[1])[:2]) for row in ROWS
    )
    assert Counter((r.doc_id, r.n_tokens, r.n_known) for r in found) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    model, rare = class_lm.fit(docs.limit(0), classes=4, rounds=1)
    empty = class_lm.scores(docs, model, rare, in_fold("doc_id", 7, 2)).collect()
    assert len(empty) == len(ROWS)
    assert all(r.base_score == 0 and r.n_known == 0 for r in empty)
    assert class_lm.scores(docs.limit(0), model, rare, in_fold("doc_id", 7, 2)).count() == 0
