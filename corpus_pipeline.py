"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame. ``run`` writes each result to the shared folder and reads it
back as the next stage's input. All stages but the last return the columns of documents,
whatever else these hold: further columns pass through, also where they are named like one of
a stage's own. An empty table gives an empty table at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymonth.llm import bpe, exact_dedup, language, mixing, simhash
from tallymonth.llm.common import in_fold, stored, table
from tallymonth.llm.queries import WEIGHTS, vocabulary_path


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or between two languages, go.

    So do null and empty texts. Learned from the rows with a language outside the held-out
    fold, null ids among them; without any such row every document goes. Repeated rows
    stay or go together; texts are read whole, however long.
    """
    labelled = language.labelled_outside(docs, in_fold("doc_id", 4, 2))
    return language.in_known_language(docs, language.fit(labelled))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays.

    A null text equals an empty one. Of rows that tie in the id any one stays; a null id stays
    only where no copy has an id.
    """
    return exact_dedup.deduplicated(docs, keep="max")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints at most 2 bits apart, the smallest id stays.

    Texts without words have the fingerprint 0 and are linked like any other. Of rows that tie
    in the id one stays; a null id stays only where none that is linked has an id.
    """
    return simhash.one_of_each(docs, shingle=3, distance=2)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source as often as its target asks, three times at most.

    A null source is a source, the last one. Texts without words are never taken. The last
    document of a source may be cut after a word; its ``n_chars`` then counts what is left.
    """
    return mixing.mixed_documents(docs, mixing.cyclic_weights(docs, WEIGHTS))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, and digests of them and of the text they decode to.

    A null or empty text has no ids. One row for each row, of doc_id and these outputs alone.
    """
    outputs = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    return bpe.coded(docs, vocabulary_path(), outputs)


STAGES = [
    ("language_id", known_languages),
    ("exact_dedup", without_copies),
    ("simhash_dedup", without_near_copies),
    ("source_mixing", mixed_sources),
    ("bpe", encoded),
]

# XXH64 and BPE have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
