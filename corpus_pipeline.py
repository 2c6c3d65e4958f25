"""From raw documents to packed token sequences, in five stages.

Every stage takes the documents that its predecessor kept, and all but the last return the columns of ``documents``.
A stage's result is written to the shared folder and read again by the next one, so a lost executor costs at most the
stage at work. When a stage begins, the working tables of the one before are removed: its result is stored by then.

Columns beside those of ``documents`` pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.llm import cutting_stock, flow_mix, language_gru, minhash_hamming, secret_markov
from stratakit.llm.common import SPACES, by_rows, discard, noting, stored

UNCERTAIN = 0.3
"""Documents whose best language has a smaller mean probability are rejected."""
OWN = ("doc_id", "text", "lang", "source", "n_chars")
_working: list[str] = []


def staged(stage):
    """The stage with its working tables noted, and those of the stage before removed."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _working)
        aside = {c: c if c in OWN else f"_own_{i}" for i, c in enumerate(docs.columns)}
        with noting(_working):
            found = stage(spark, docs.toDF(*aside.values()), sf_dir)
        named = [F.col(a).alias(c) for c, a in aside.items() if a in found.columns]
        return found if stage is pack_tokens else found.select(*named)

    return run_stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letters, or no language that stands out.

    The model learns from the labelled documents. Without any label, documents with letters stay.
    """
    model = language_gru.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_gru.identify(docs, model)
    sure = (F.col("lang_pred") != language_gru.UNKNOWN) & (F.col("score") >= UNCERTAIN)
    return found.where(sure).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies, and one row of each id.

    Documents without an id can't be told apart from others and stay.
    """
    found = stored(minhash_hamming.near_duplicates(docs).where("id is not null"))
    others = found.groupBy("id").agg(F.bool_and("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
    others = stored(others.where("not kept or rows > 1").withColumnRenamed("id", "doc_id"))
    once = docs.join(by_rows(others).select("doc_id"), "doc_id", "left_anti")
    repeated = docs.join(by_rows(others.where("kept")).select("doc_id"), "doc_id", "left_semi")
    order = "row_number() over (partition by doc_id order by text, lang, source, n_chars)"
    repeated = repeated.withColumn("_n", F.expr(order)).where("_n = 1")
    return once.select(*docs.columns).union(repeated.select(*docs.columns))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark; no document is dropped."""
    changed = secret_markov.redact(docs, secret_markov.fit(docs))
    length = F.when(F.col("n_chars").isNotNull(), F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))
    return changed.withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents to the target weights of their sources; one that is taken twice stands there twice."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(f"[^{SPACES}]+"))
    mixed, _, _ = flow_mix.mix(docs, F.array("source"), words)
    return mixed.select(*docs.columns, F.explode("given")).select(*docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, each with its sequence and its offset there."""
    return cutting_stock.pack(docs)


STAGES = [
    ("language", staged(identify_language)),
    ("near duplicates", staged(drop_near_duplicates)),
    ("secrets", staged(redact_secrets)),
    ("mixing", staged(mix_sources)),
    ("packing", staged(pack_tokens)),
]
# Neither the trained models nor the packing can be stated in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    results: list[str] = []
    for _, stage in STAGES[:-1]:
        made, before = stage(spark, docs, sf_dir), results[:]
        with noting(results):
            docs = stored(made)
        del results[: len(before)]
        discard(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
