"""A corpus pipeline over `documents`: language, near duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscreen.durable import remove
from txscreen.llm import bpe, langid, mixing, pii, simhash
from txscreen.llm.common import free_names, fresh_path, settle, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without an identifiable language (null, or without a letter); keeps all others.

    Repeated rows and ties go the same way; an empty table stays empty; other columns are kept.
    """
    model = langid.train(docs.where(~langid.held_out()))
    (name,) = free_names(docs, "lang_id")
    return langid.predict(docs, model, to=name).where(F.col(f"{name}.lang_pred") != langid.UNKNOWN).drop(name)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the one with the smallest (doc_id, fingerprint, text hash).

    A null doc_id sorts before all others; null, empty and blank texts are copies of each other; of rows with the kept
    doc_id and text one stays; an empty table stays empty; other columns are kept. Texts are shuffled once:
    repeated rows go and the rest is matched to the kept ones under one partitioning.
    """
    key, none, doc = free_names(docs, "key", "none", "doc")
    own = {key: F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), none: F.col("doc_id").isNull(), doc: F.coalesce(F.col("doc_id"), F.lit(0))}
    prints = settle(docs.select("doc_id", own[key].alias("key"), simhash.fingerprint_column().alias("fp")))
    found = simhash.near_duplicates(prints.select("doc_id", "fp"))
    first = prints.join(found.select("fp", "component"), "fp").groupBy("component").agg(F.min(F.struct("doc_id", "fp", "key")).alias("k"))
    kept = first.select(F.col("k.key").alias(key), F.col("k.doc_id").isNull().alias(none), F.coalesce("k.doc_id", F.lit(0)).alias(doc))
    return docs.withColumns(own).dropDuplicates(list(own)).join(kept, list(own), "left_semi").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind and counts n_chars anew; keeps all documents.

    A null text stays null, and so does its count; repeated rows are masked alike; an empty table stays
    empty; other columns are kept.
    """
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops whole documents: as often as the mix takes their words.

    A part of a copy is a whole one with the part as its probability, drawn by a hash of the document, so
    that each source is expected to give the words that the mix takes of it, however long its documents are.
    A document with no words (null and blank texts) is no part of the mix and goes. A null source is a source;
    equal rows share their takings; an empty table stays empty; other columns are kept.
    """
    size, taken, n = free_names(docs, "size", "taken", "n")
    mixed = mixing.mix_documents(docs, size=size, taken=taken)
    times = F.col(taken) / F.col(size)
    drawn = F.pmod(F.xxhash64(F.lit(mixing.SEED), F.lit("copies"), "doc_id", "source", F.xxhash64("text")), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor(times) + F.when(drawn < times - F.floor(times), 1).otherwise(0)).cast("int")
    return mixed.where((F.col(size) > 0) & (F.col(taken) > 0)).withColumn(n, F.explode(F.sequence(F.lit(0), copies))).where(F.col(n) > 0).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_split, round_trip), a row for each row of docs.

    A null text has no ids; repeated rows are encoded alike; an empty table gives no rows; other columns go.
    """
    return bpe.encoding_digests(docs, bpe.public_ranks())


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("PII", mask_personal_data),
    ("mixing", mix_sources),
    ("byte-level BPE", encode_tokens),
]

#: SQL can't express the stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another. A stage's table goes when the next one is written; the last one is the result."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = fresh_path(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
