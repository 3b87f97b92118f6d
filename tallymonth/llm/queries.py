"""The registered queries: each operator over its whole table, and SQL for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymonth.llm import (
    bit_sliced,
    bpe,
    class_lm,
    exact_dedup,
    language,
    mixing,
    periodic,
    sharding,
    simhash,
    token_counts,
    url_rules,
    vector_dedup,
    whitening,
)
from tallymonth.llm.common import WORD, in_fold, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """The installed file of a public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(name)


SHARD_BYTES = 1 << 20


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path)


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 7, 2)
    model, rare = class_lm.fit(docs.filter(~held_out))
    return class_lm.scores(docs, model, rare, held_out)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coded(
        table(spark, sf_dir, "documents"),
        vocabulary_path(),
        ["n_tokens", "ids_sha256", "decoded_sha256"],
    )


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(str(rule) for rule in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_rules.judged(table(spark, sf_dir, "pages"), rules)


WEIGHTS = [5, 2, 1]
SHARD_WORDS = 1 << 17


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = mixing.cyclic_weights(docs, WEIGHTS)
    mixed = mixing.mix(docs, weights, shard_words=SHARD_WORDS, carry=["doc_id"])
    return mixed.select(
        "row.doc_id",
        "size",
        "source_size",
        "target",
        mixing.taken_words(F.col("spans")).alias("taken"),
        F.array_min("spans.first_shard").alias("first_shard"),
        F.array_max("spans.last_shard").alias("last_shard"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assignments(table(spark, sf_dir, "documents"), keep="max")


def op8_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.hexadecimal(F.col("bits")).alias("fingerprint"), "component_id"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 4, 2)
    model = language.fit(language.labelled_outside(docs, held_out))
    found = language.predictions(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").filter(whitening.finite(F.col("embedding")))
    rows = vectors.select(
        F.col("vec_id").alias("id"), whitening.quantised(F.col("embedding")).alias("x")
    )
    return whitening.whiten(rows, components=8).select(
        F.col("id").alias("vec_id"),
        "component",
        "n",
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
    )


def op12_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(table(spark, sf_dir, "embeddings"), divisor=50, k=5)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by its id's checksum repeats some of its words."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", crc.alias("crc"), (crc % 10 == 0).alias("planted"))
    # Only these texts are cut into words here; the words are a column, so that this is done once.
    words = F.when(F.col("planted"), F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words"))
    g = F.floor(F.col("crc") / 10)
    rows = rows.withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))
    rows = rows.withColumn("p", period.cast("int"))
    repeated = F.transform(
        "words",
        lambda word, i: F.when(i < F.col("a"), word).otherwise(
            F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))
        ),
    )
    text = F.when(F.col("planted") & (F.col("n") > 0), F.array_join(repeated, " "))
    return rows.select("doc_id", F.coalesce(text, F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(table(spark, sf_dir, "documents"))
    return periodic.digests(periodic.periodic_runs(docs))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_token_counts": op2_token_counts,
    "op3_class_lm": op3_class_lm,
    "op4_bpe": op4_bpe,
    "op5_url_rules": op5_url_rules,
    "op6_mixing": op6_mixing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_pivot_index": op8_pivot_index,
    "op9_simhash": op9_simhash,
    "op10_language_id": op10_language_id,
    "op11_whitening": op11_whitening,
    "op12_bit_sliced": op12_bit_sliced,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op5_url_rules": r"""
        WITH rules(host, path, verdict) AS (VALUES
            ('org', '/', 'allow'),
            ('example.org', '/es/', 'block'),
            ('example.org', '/en/1', 'block'),
            ('com', '/fr/', 'allow'),
            ('com', '/de/', 'block')
        ),
        parsed AS (
            SELECT page_id,
                translate(
                    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
                ) AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
                row_number() OVER () AS nth
            FROM pages
        ),
        fits AS (
            SELECT p.nth, r.host || r.path AS rule, r.verdict,
                row_number() OVER (
                    PARTITION BY p.nth ORDER BY length(r.host || r.path) DESC, length(r.host) DESC
                ) AS place
            FROM parsed p JOIN rules r
                ON (p.host = r.host OR ends_with(p.host, '.' || r.host))
                AND starts_with(p.path, r.path)
        )
        SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM parsed p LEFT JOIN fits f ON f.nth = p.nth AND f.place = 1
    """,
    "op7_exact_dedup": """
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        grouped AS (
            SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM docs GROUP BY text
        ),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY text, doc_id) AS nth FROM docs
        )
        SELECT n.doc_id, g.keep_id, g.group_size,
            (n.doc_id IS NOT DISTINCT FROM g.keep_id AND n.nth = 1) AS kept,
            sha256(n.text) AS text_sha256
        FROM numbered n JOIN grouped g ON n.text = g.text
    """,
    "op12_bit_sliced": """
        WITH rows_used AS (
            SELECT row_number() OVER () AS nth, vec_id,
                [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        scored AS (
            SELECT q.nth, q.vec_id AS query_id, c.vec_id,
                CAST(coalesce(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]), 0)
                    AS BIGINT) AS score
            FROM rows_used q JOIN rows_used c
                ON q.vec_id % 50 = 0 AND q.nth <> c.nth AND len(q.v) = len(c.v)
        ),
        ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY nth ORDER BY score DESC, vec_id NULLS LAST
            ) AS place
            FROM scored
        )
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
        FROM ranked WHERE place <= 5
    """,
    "op8_pivot_index": """
        WITH RECURSIVE vectors AS (
            SELECT row_number() OVER () AS nth, vec_id, CAST(embedding AS DOUBLE[]) AS v
            FROM embeddings
        ),
        usable AS (
            SELECT * FROM vectors
            WHERE v IS NOT NULL AND vec_id IS NOT NULL
                AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0
                AND len([x FOR x IN v IF x <> 0]) > 0
        ),
        links AS (
            SELECT a.nth AS a, b.nth AS b, b.vec_id
            FROM usable a JOIN usable b ON a.nth <> b.nth AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.9
        ),
        reached(a, b) AS (
            SELECT nth, nth FROM vectors
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        ),
        least AS (
            SELECT r.a, min(v.vec_id) AS component_id
            FROM reached r JOIN vectors v ON r.b = v.nth GROUP BY r.a
        )
        SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.nth) AS n_links,
            c.component_id, v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
        FROM vectors v JOIN least c ON v.nth = c.a
    """,
}
