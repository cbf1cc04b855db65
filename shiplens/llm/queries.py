"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL.

Each query applies its operator to the whole of its table and derives the digest
columns from what the operator returns.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm import oracle
from shiplens.sources.tables import table

#: folder of the public tokenizer files, the same on every executor
TOKENIZERS = os.environ.get("SHIPLENS_TOKENIZERS", "/opt/tokenizers")


def share_package(spark: SparkSession) -> None:
    """Let local Python workers import this package whatever their working folder is.

    On a cluster the package is shipped with the job (--py-files) and this is without effect.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)


def _op(build):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return build(spark, sf_dir)
    query.__name__, query.__doc__ = build.__name__, build.__doc__
    return query


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked at Jaccard 0.85 on 4-word shingles."""
    from shiplens.llm.ngram_join import jaccard_classes
    return jaccard_classes(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sainte-Lague mix of all documents by source."""
    from shiplens.llm.mixing import mix_sources
    return mix_sources(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the rows of the other four folds."""
    from shiplens.llm import langid
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(5, 0)
    field = langid.train(docs.filter(F.col("doc_id").isNotNull() & ~out))
    return langid.predict(docs, field).select("row.doc_id", "lang_pred", "score").select(
        "doc_id", out.alias("held_out"), "lang_pred", "score")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words found in documents."""
    from shiplens.llm.decontam import find_contamination
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13)
    return found.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest neighbours of every hundredth vector."""
    from shiplens.llm.ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text, learned from the labels of two of three folds."""
    from shiplens.llm import quality
    from shiplens.llm.langid import held_out
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(3, 1)
    ranker = quality.train(docs, labels.filter(F.col("doc_id").isNotNull() & ~out))
    return quality.score(docs, ranker).select("row.doc_id", "score", "predicted").select(
        "doc_id", out.alias("held_out"), "score", "predicted")


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with keyed surrogates for its personal data."""
    from shiplens.llm.pii import replace_pii
    return replace_pii(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_replaced", F.col("clean").alias("text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeat across documents, kept in the first document only."""
    from shiplens.llm.linededup import dedup_lines
    done = dedup_lines(table(spark, sf_dir, "documents"), min_chars=10)
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-log-likelihood of every document under a network trained on all of them."""
    from shiplens.llm import lmscore
    docs = table(spark, sf_dir, "documents")
    return lmscore.score(docs, lmscore.train(docs)).select(
        "row.doc_id", "n_tokens", "n_unknown", "log_likelihood",
        (F.col("log_likelihood") / F.greatest(F.col("n_tokens"), F.lit(1))).alias("mean_log_likelihood"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC archives, converted to WARC and read back."""
    from shiplens.llm.warc import convert_pages
    return convert_pages(table(spark, sf_dir, "pages"))[1].select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document; one in ten is given a periodic end."""
    from shiplens.llm.periods import digests, periodic_runs
    return digests(periodic_runs(table(spark, sf_dir, "documents"), least=24, power=3, change=True))


def op12_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers, with their document counts."""
    from shiplens.llm.align import link_counts
    return link_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the labels of four of five folds."""
    from shiplens.llm import toxicity
    from shiplens.llm.langid import held_out
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out(5, 0)
    model = toxicity.train(docs, labels.filter(F.col("doc_id").isNotNull() & ~out))
    return toxicity.score(docs, model).select("row.doc_id", "score", "predicted").select(
        "doc_id", out.alias("held_out"), "score", "predicted")


QUERIES = {f.__name__: _op(f) for f in (
    op1_ngram_jaccard, op2_mix_sources, op3_language_id, op4_decontaminate, op5_nearest_neighbours, op6_quality,
    op7_pii_surrogates, op8_line_dedup, op9_lm_score, op10_warc, op11_periodic_runs,
    op12_align_tokenizers, op13_toxicity,
)}
ORACLE = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
