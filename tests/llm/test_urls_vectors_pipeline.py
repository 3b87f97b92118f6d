"""URL rules, vectors, and the pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallymonth.llm import language, queries, url_rules, vector_dedup
from tallymonth.llm.common import table
from tests.llm.cases import ROWS, documents, with_clashes
from tests.llm.test_documents import brute_components, brute_fingerprint, brute_targets, words_of


def brute_verdict(url, rules) -> tuple:
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, _, rule, verdict = max(fits, default=(0, 0, None, "allow"))
    return host, path, rule, verdict


def test_nested_rules_on_awkward_urls(spark) -> None:
    random.seed(3)
    labels, steps = ["a", "b", "example", "org", "com"], ["/", "/a", "/a/b", "", "/é", "/a/b/c"]
    rules = {
        (".".join(random.choices(labels, k=random.randint(1, 3))), random.choice(steps))
        for _ in range(60)
    }
    rules = [(h, p, random.choice(["allow", "block"])) for h, p in sorted(rules)]
    urls = [
        f"HTTP://{'.'.join(random.choices([*labels, 'B'], k=random.randint(1, 5)))}"
        f"{random.choice(steps)}{random.choice(['', 'x', '?q://z', '#f', '/b/c'])}"
        for _ in range(400)
    ]
    urls += [None, "", "no scheme", "x://", "://a", "s://org.", "s://.org/", "s://a\n.org/a", "s://" + "a." * 3000]
    pages = [(i, url) for i, url in enumerate(urls)] + [(None, "s://org/"), (1, urls[1]), (1, urls[1])]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("rule", F.lit("x"))
    frame = frame.withColumn("host", F.lit("clash"))
    found = url_rules.judged(frame, spark.createDataFrame(rules, "host string, path string, verdict string"))
    expected = Counter((i, *brute_verdict(url, rules)) for i, url in pages)
    assert Counter(map(tuple, found.collect())) == expected
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_rules.judged(frame, none).collect()} == {"allow"}
    assert url_rules.judged(frame.limit(0), none).count() == 0


def test_no_python_on_the_way_of_urls(spark, sf_dir) -> None:
    plan = queries.op5_url_rules(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def brute_links(rows) -> dict:
    """Row number to the row numbers it is linked to."""
    def usable(v):
        return v is not None and None not in v and np.isfinite(v).all() and any(v)

    links = {}
    for i, (id_i, a) in enumerate(rows):
        links[i] = set()
        for j, (id_j, b) in enumerate(rows):
            if i == j or id_i is None or id_j is None or not usable(a) or not usable(b) or len(a) != len(b):
                continue
            x, y = np.array(a, float), np.array(b, float)
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links[i].add(j)
    return links


@pytest.mark.parametrize("block", [5, 1000])
def test_vectors(spark, block) -> None:
    random_ = np.random.default_rng(5)
    base = random_.normal(size=(30, 8))
    near = [base[i % 3] + random_.normal(size=8) * 0.05 * (i % 7) for i in range(60)]
    vectors = [v.astype(np.float32).tolist() for v in [*base, *near]]
    vectors += [vectors[0]] * 4 + [None, [], [0.0] * 8, [1.0, None], [float("nan")] * 8, [float("inf")] * 8]
    vectors += [[3.0, 4.0], [6.0, 8.0], [1e-30] * 8, [1e30] * 8]
    rows = [(100 + i, v) for i, v in enumerate(vectors)] + [(None, vectors[0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit(1))
    found = {r.vec_id: r for r in vector_dedup.near_vectors(frame, block=block).collect()}
    links = brute_links(rows)
    root = brute_components([(i, j) for i in links for j in links[i]], links)
    assert len(found) == len(rows)
    for i, (vec_id, _) in enumerate(rows):
        assert found[vec_id].n_links == len(links[i]), vec_id
        assert found[vec_id].component_id == rows[root[i]][0]
        assert found[vec_id].kept == (root[i] == i)
    assert vector_dedup.near_vectors(frame.limit(0)).count() == 0


def test_recall_near_the_threshold(spark) -> None:
    random_ = np.random.default_rng(0)
    base = random_.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = random_.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    both = np.vstack([base, 0.905 * base + np.sqrt(1 - 0.905**2) * aside])
    frame = spark.createDataFrame(list(enumerate(both.tolist())), "vec_id long, embedding array<double>")
    found = vector_dedup.near_vectors(frame).collect()
    assert sum(r.n_links for r in found) >= 0.95 * len(both)


def planted_vectors(kind: str) -> np.ndarray:
    random_ = np.random.default_rng(12)
    noise, direction = random_.normal(size=(300, 32)), np.full(32, 32**-0.5)
    if kind == "two":
        return np.array([direction, direction + [0.01, *[0.0] * 31]])
    if kind == "one":
        return direction[None]
    if kind == "positive":
        return np.abs(noise)
    if kind == "scaled":
        return direction * 10.0 ** random_.integers(-20, 20, (300, 1))
    if kind == "clusters in a cone":
        centres = direction + random_.normal(size=(20, 32)) * 0.35 / 32**0.5
        return centres[random_.integers(0, 20, 300)] + noise * 0.1 / 32**0.5
    # Two vectors of a cone have this cosine on average.
    mean = float(kind)
    return direction + noise / 32**0.5 * np.sqrt(1 / mean - 1)


@pytest.mark.parametrize("long_list", [0, 20_000])
@pytest.mark.parametrize(
    "kind", ["one", "two", "0.3", "0.8", "0.9", "0.99", "positive", "scaled", "clusters in a cone"]
)
def test_no_cone_loses_its_links(spark, kind, long_list) -> None:
    vectors = planted_vectors(kind)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    links = linked.sum(axis=1) - 1
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in vector_dedup.near_vectors(frame, long_list=long_list).collect()}
    got = np.array([found[i].n_links for i in range(len(rows))])
    assert (got <= links).all()
    assert got.sum() >= 0.95 * links.sum()
    if kind in ("two", "scaled"):
        assert (got == links).all()
    if kind in ("two", "0.99", "scaled"):
        assert {r.component_id for r in found.values()} == {0}


def test_lists_of_pairs_give_the_same_candidates(spark) -> None:
    random_ = np.random.default_rng(1)
    base = random_.normal(size=(40, 12))
    rows = [(i, (base[i % 40] + random_.normal(size=12) * 0.25).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    both = [
        Counter(map(tuple, vector_dedup.near_vectors(frame, 0.9, [(8, 2)], block, long_list).collect()))
        for block, long_list in ((1000, 20_000), (7, 0))
    ]
    assert both[0] == both[1]


def test_recall_is_measured_and_the_last_resort_compares_all(spark) -> None:
    rows = [(i, v.tolist()) for i, v in enumerate(planted_vectors("0.99"))]
    frame = spark.createDataFrame(rows, "node long, vector array<double>").withColumn("copies", F.lit(1).cast("long"))
    index = vector_dedup.fit(frame, 300, 3, 3)
    described = vector_dedup._described(frame, index)
    low = vector_dedup.measured_recall(described, index, 0.9)
    assert low < 0.5
    near = {r.node: set(r.nearest) for r in described.collect()}
    shared = [len(near[a] & near[b]) >= 3 for a in range(300) for b in range(300) if a != b]
    assert abs(low - np.mean(shared)) < 0.05
    _, index, count = vector_dedup.described_well(frame, 0.9, [(3, 3)])
    assert (len(index.pivots), index.nearest, index.min_shared, count) == (1, 1, 1, 300)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, sf_dir, name) -> None:
    con = duckdb.connect()
    for view in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    expected = con.sql(queries.ORACLE_SQL[name]).df()
    found = queries.QUERIES[name](spark, sf_dir).toPandas()[list(expected.columns)]
    rows = (Counter(map(tuple, f.astype(object).where(f.notna(), None).values)) for f in (found, expected))
    assert next(rows) == next(rows)


def test_every_stage_works_on_what_the_last_one_kept(spark, sf_dir) -> None:
    docs = table(spark, sf_dir, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "simhash_dedup", "source_mixing", "bpe"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.columns == columns
        kept[name] = before, docs.collect()

    before, after = kept["language_id"]
    assert len(after) >= 0.98 * len(before)
    before, after = kept["exact_dedup"]
    assert {r.doc_id for r in after} == {max(r.doc_id for r in before if r.text == t) for t in {r.text for r in before}}
    before, after = kept["simhash_dedup"]
    bits = {r.doc_id: brute_fingerprint(r.text) for r in before}
    near = [(a, b) for a in bits for b in bits if (bits[a] ^ bits[b]).bit_count() <= 2]
    assert {r.doc_id for r in after} == set(brute_components(near, bits).values())
    before, after = kept["source_mixing"]
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r.source] += len(words_of(r.text))
    for r in after:
        taken[r.source] += len(words_of(r.text))
    for source, target in brute_targets(sizes, queries.WEIGHTS, 3.0).items():
        assert abs(taken[source] - target) <= 32
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert out.count() == docs.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()


def check_languages(before, after, spark) -> None:
    learned = [r for r in before if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    frame = spark.createDataFrame([(r.text, r.lang) for r in learned], "text string, lang string")
    model = language.fit(frame)
    clear = [r for r in before if model.predict(r.text or "")[0] != "und" and not model.predict(r.text)[2]]
    assert Counter(after) == Counter(clear)
    assert any(r.text and any(c.isalpha() for c in r.text) for r in after)


def check_copies(before, after, spark) -> None:
    groups: dict = {}
    for r in before:
        groups.setdefault(r.text or "", []).append(r)
    expected = [max(g, key=lambda r: (r.doc_id is not None, r.doc_id or 0)) for g in groups.values()]
    assert Counter(after) == Counter(expected)


def check_near_copies(before, after, spark) -> None:
    bits = {r.text or "": brute_fingerprint(r.text) for r in before}
    prints = set(bits.values())
    near = [(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 2]
    root = brute_components(near, prints)
    groups: dict = {}
    for r in before:
        groups.setdefault(root[bits[r.text or ""]], []).append(r)
    expected = [min(g, key=lambda r: (r.doc_id is None, r.doc_id or 0)) for g in groups.values()]
    assert Counter(after) == Counter(expected)


def check_sources(before, after, spark) -> None:
    words = Counter()
    for r in before:
        words[r.source] += len(words_of(r.text))
    targets = brute_targets(words, queries.WEIGHTS, 3.0)
    taken, times = Counter(), Counter()
    names = [n for n in before[0].__fields__ if n not in ("text", "n_chars")]
    whole = {tuple(r[n] for n in names): r.text for r in before}
    copies = Counter(tuple(r[n] for n in names) for r in before)
    for r in after:
        key = tuple(r[n] for n in names)
        assert r.text and (whole[key] == r.text or whole[key].startswith(r.text))
        assert r.n_chars == len(r.text)
        taken[r.source] += len(words_of(r.text))
        times[key] += 1
    assert all(n <= 3 * copies[key] for key, n in times.items())
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 32


def check_codes(before, after, spark) -> None:
    library = Tokenizer.from_file(queries.vocabulary_path())
    expected = Counter()
    for r in before:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        packed = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected[r.doc_id, len(ids), tuple(ids), packed, hashlib.sha256(back.encode()).hexdigest()] += 1
    found = Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.ids_sha256, r.decoded_sha256) for r in after)
    assert found == expected


CHECKS = {
    "language_id": check_languages,
    "exact_dedup": check_copies,
    "simhash_dedup": check_near_copies,
    "source_mixing": check_sources,
    "bpe": check_codes,
}


def test_each_stage_does_as_it_says_with_awkward_rows(spark, sf_dir) -> None:
    # Each stage on all awkward rows, and on what its predecessors leave of them.
    rows = [(*row[:4], None if row[1] is None else len(row[1])) for row in ROWS]
    awkward = with_clashes(documents(spark, rows)).withColumn("text_sha256", F.lit("own")).withColumn("spans", F.lit(1))
    docs = awkward
    for name, stage in corpus_pipeline.STAGES:
        for given in (awkward, docs):
            found = stage(spark, given, sf_dir)
            after = found.collect()
            if name != "bpe":
                assert found.columns == awkward.columns
            CHECKS[name](given.collect(), after, spark)
        if name != "bpe":
            docs = spark.createDataFrame(after, awkward.schema)
            assert after


def test_stages_bear_empty_tables(spark, sf_dir) -> None:
    docs = with_clashes(documents(spark, []))
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf_dir)
        assert found.count() == 0
        if name != "bpe":
            assert found.columns == docs.columns
