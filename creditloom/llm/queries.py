"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import bpe, exact, fim, language, mixing, pii, simhash, suffixes, tokens, toxicity, trie, urls, vectors
from creditloom.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[build.__name__] = build
    return build


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of whole texts; the threshold 0.3 decides."""
    scored, _ = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word-shingle fingerprints link at two bits or fewer."""
    return simhash.near_copies(table(spark, sf_dir, "documents"), width=3, radius=2).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of whole texts, and which documents exceed a context of 2048."""
    counted = tokens.token_counts(table(spark, sf_dir, "documents"), WORD_BPE)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors at cosine 0.95 or more, over all rows."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), 0.95)


LLM_ORACLES["op4_vectors"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), FALSE)))
        AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), linked AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT reached.vec_id, linked.b FROM reached JOIN linked ON linked.a = reached.other
)
SELECT vec_id, (SELECT count(*) FROM linked WHERE a = vec_id) AS n_links, min(other) AS component_id,
       vec_id = min(other) AS kept
FROM reached GROUP BY vec_id
"""


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three quarters of all tokens, dealt to domains, languages and sources by weight, up to two epochs a leaf."""
    return mixing.select_documents(table(spark, sf_dir, "documents"))


LLM_ORACLES["op5_mixing"] = mixing.sql()


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of whole texts; the row with the largest id stays."""
    return exact.copies(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.substring(F.hex("digest"), 1, 64)).alias("text_sha256"),
    )


LLM_ORACLES["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with pseudonyms: how many values of each kind, and the digest of the new text."""
    made = pii.pseudonymise(table(spark, sf_dir, "documents"))
    kinds = [F.size(F.filter("found", pii.is_kind(kind))).alias(f"n_{kind}") for kind in pii.KINDS]
    n_found = F.size("found").alias("n_found")
    return made.select("doc_id", n_found, *kinds, F.sha2("text", 256).alias("text_sha256"))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of whole texts and the text they decode to, as digests."""
    coded = bpe.encode(table(spark, sf_dir, "documents"), WORD_BPE, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of whole texts, learned from two thirds of the documents."""
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url judged by rules, then by the weighted vocabulary."""
    judged = urls.judge(table(spark, sf_dir, "pages"))
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        "verdict",
        F.size("strict_hits").alias("n_strict"),
        F.size("soft_hits").alias("n_soft"),
    )


LLM_ORACLES["op10_url_filter"] = urls.sql()


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts cut at token boundaries and put in prefix, suffix, middle order; digests of output and round trip."""
    made = fim.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


LLM_ORACLES["op11_fill_in_middle"] = fim.sql()


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the conversations, each begun with turns of the first of its twenty."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), heads_of=20).drop("turn")


LLM_ORACLES["op12_prefix_trie"] = trie.sql()


@query
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts without the bytes of 200-byte strings that start anywhere else."""
    rest = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return rest.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


LLM_ORACLES["op13_suffix_dedup"] = suffixes.sql()
