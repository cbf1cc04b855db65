"""A training-corpus pipeline over ``documents``: five stages, each one of the llm operators.

language ID -> line dedup -> n-gram Jaccard join -> benchmark decontamination -> mixing.
Every stage reads all rows its predecessor kept; between stages rows are written as
Parquet and read again.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplens.llm import decontam, langid, linededup, mixing, ngram_join
from shiplens.llm.queries import share_package
from shiplens.session import materialize
from shiplens.sources.tables import table

MIN_LANGUAGE_SCORE = 0.4   # below it no language clearly leads
SHINGLE, NUM, DEN = 5, 80, 100


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a recognised language; null and letterless texts go."""
    share_package(spark)
    field = langid.train(docs)
    found = langid.predict(docs, field)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; n_chars follows.  All rows stay."""
    share_package(spark)
    done = linededup.dedup_lines(docs)
    changed = F.col("n_dropped") > 0
    cols = []
    for f in docs.schema.fields:
        c = F.col("row").getField(f.name)
        if f.name == "text":
            c = F.when(changed, F.col("kept")).otherwise(c)
        elif f.name == "n_chars":
            c = F.when(changed, F.length("kept")).otherwise(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return done.select(*cols)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at Jaccard 0.8 on five-word shingles: the smallest doc_id.

    Rows without doc_id stay.  Of several rows with one doc_id the one with the smallest
    text stays.
    """
    share_package(spark)
    classes = ngram_join.jaccard_classes(docs, k=SHINGLE, num=NUM, den=DEN).filter("doc_id IS NOT NULL")
    losers = classes.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("first")) \
        .filter("first = 0").select("doc_id")
    same = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy("text")
    return docs.join(losers, "doc_id", "left_anti").select(*docs.columns, F.row_number().over(same).alias("__place")) \
        .filter("doc_id IS NULL OR __place = 1").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words lies in benchmark windows go."""
    share_package(spark)
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("NOT contaminated").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: doc_id, size, source_size, target and the words taken, of documents it takes words of."""
    share_package(spark)
    return mixing.mix_sources(docs).filter("taken > 0")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix),
]

#: a learned stage has no SQL form; tests/llm compares the stages with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
