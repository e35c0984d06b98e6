"""A corpus from documents to packed sequences: language ID, n-gram Jaccard join, source mixing, best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from surveil.llm import jaccard, langid, mixing, packing
from surveil.llm.queries import QUERIES, WORD_BPE, table
from surveil.llm.shared import free_name, written
from surveil.operators.joins import skew_join


TARGETS = ("de", "en", "es", "fr")  # languages that the corpus is to hold
MIN_SCORE = 0.5  # of the predicted language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose predicted language is one of ``TARGETS`` with a score of ``MIN_SCORE`` or more.

    So go: texts that the network takes for another label that it has learned, or for none with any certainty, and texts
    that have no language (null, empty or without a letter). Learned from labelled documents of ``docs``; a prediction
    replaces neither lang nor any other column. Without a labelled one to learn from, only texts without a letter are rejected.
    """
    labels, model = langid.fit(docs)
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    aside = {c: free_name(docs, f"{c}_of_input") for c in docs.columns if c.lower() in ("lang_pred", "score")}
    found = langid.predict(docs.withColumnsRenamed(aside), labels, model)
    found = found.filter(F.col("lang_pred").isin(*TARGETS) & (F.col("score") >= MIN_SCORE))
    return found.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest id (null last), of equal ids the least.

    Documents without words are in no group and all stay.
    """
    at, n = free_name(docs, "hash"), free_name(docs, "rows")
    groups = jaccard.jaccard_components(docs.select("doc_id", "text")).withColumnRenamed("text_hash", at)
    chosen = groups.filter("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", at)).alias("first")
    ).select("first.doc_id", f"first.{at}")
    rows = groups.groupBy("doc_id", at).agg(F.count("*").alias(n))
    wordless = groups.filter("component is null").select("doc_id", at, F.lit(1).cast("long").alias(n)).distinct()
    keep = written(skew_join(rows, chosen, ["doc_id", at]).unionByName(wordless), "keep")
    own = docs.withColumn(at, F.xxhash64("text"))
    once = skew_join(own, keep.filter(F.col(n) == 1), ["doc_id", at]).select(*docs.columns)
    often = skew_join(own, keep.filter(F.col(n) > 1), ["doc_id", at])
    order = [F.to_json(c) if isinstance(docs.schema[c].dataType, MapType) else F.col(c) for c in docs.columns]  # maps have no order of their own
    least = F.min_by(F.struct(*docs.columns), F.struct(*[c.alias(f"c{i}") for i, c in enumerate(order)]))
    often = often.groupBy("doc_id", at).agg(least.alias("row")).select("row.*")
    return once.unionByName(often)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources to equal weight: each document as often as its source's rate draws it."""
    names = tuple(free_name(docs, n) for n in mixing.OWN)
    return mixing.mix_sources(docs, names=names).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the packed sequences; copies of a document are packed each."""
    return packing.pack_documents(docs, WORD_BPE)


STAGES = [("language", language), ("deduplicate", deduplicate), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None  # training, exact joins of sets and packing have no SQL; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES["pipeline"] = run
