"""Training-corpus pipeline: language, exact copies, near copies, mix, encoding round trip.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the next
one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import bpe, exact, language, mixing, simhash
from creditloom.llm.common import prepare, staged

#: One pass over each leaf, and nine tenths of the tokens the earlier stages kept.
MIX = mixing.Settings(budget=(9, 10), max_epochs=1)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a letter, null and empty texts among them, and rows in which nothing tells the languages apart, go.
    Repeated rows are judged each; with fewer than two known languages every row with a letter stays."""
    prepare(spark)
    return language.drop_unidentified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of identical texts the row with the largest id stays.  A null text is the empty text, a null id the smallest; of rows
    that repeat id and text one stays."""
    prepare(spark)
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (3-word shingles, 2 bits) the row with the smallest id stays, and rows that repeat its id
    and text.  Null ids are the largest; null, empty and blank texts are near copies of each other."""
    prepare(spark)
    return simhash.drop_near_copies(docs, width=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf's prefix in seeded order, up to its share of the budget.  Null languages and sources are leaves of their own,
    null and empty texts have no tokens, repeated rows and rows without an id are taken one by one."""
    prepare(spark)
    return mixing.mix(docs, MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256): token ids, and the digest of the text they decode to.  A null text is
    the empty one, without ids; repeated rows are each returned."""
    prepare(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(docs, path, decoded=True)
    return coded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding", encode),
]

#: Language models, fingerprints and merges have no SQL form; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; an empty table gives an empty result at every stage."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
