"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.llm import chat, jaccard, langid, licenses, lm, mixing, neardup, packing, resampling, sharding, simhash, toxicity, vectorcodes
from surveil.llm.shared import written

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SPECIAL_CONVERSATION = "\\### Assistant: </turn> ok"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sharding")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), n_shards=16)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query("op2_jaccard_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), count_links=True)


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query("op4_lm_score")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), PIECES)


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the fingerprints: for ids divisible by 50, how many other rows are within simhash.NEAR bits."""
    prints = written(simhash.next_likeness(table(spark, sf_dir, "documents")), "fingerprints")
    asked = prints.filter("doc_id % 50 = 0")
    near = simhash.search(prints, asked, radius=simhash.NEAR).withColumn("asked", F.lit(True))
    out = prints.withColumn("asked", F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))).join(near, ["high", "low", "asked"], "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        (F.col("n_within") - 1).alias("n_near"),
    )


@query("op6_mix_sources", mixing.oracle())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels, model = langid.fit(docs)
    texts = docs.select("doc_id", langid.held_out("doc_id").alias("held_out"), "text")
    return langid.predict(texts, labels, model).drop("text")


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_BPE, seq_len=2048, end_id=0)


@query("op9_chat_format")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    special = spark.createDataFrame(
        [(-7, 0, "user", SPECIAL_CONVERSATION), (-7, 1, "assistant", SPECIAL_CONVERSATION)], "conv_id long, turn long, role string, text string"
    )
    turns = turns.select("conv_id", "turn", "role", "text").unionByName(special)
    return chat.read_back(chat.format_turns(turns))


@query("op10_embedding_neardup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query("op11_vector_codes", vectorcodes.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.code_vectors(table(spark, sf_dir, "embeddings"))


@query("op12_importance_resampling", resampling.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_toxicity")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    texts = docs.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "text")
    return toxicity.predict(texts, model).drop("text")
