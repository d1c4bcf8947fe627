"""Corpus pipeline: five operators of ``tradewatch.llm`` over ``documents``, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every result as a Parquet table in the
shared folder and reads it back as the next stage's ``docs``.  All stages but the last return the columns of
``documents``; the last returns the encoded documents.

All stages judge row by row or by the texts, so rows without an id or with equal ids are judged like others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm import byte_bpe, decontamination, jaccard_join, quality_rules, suffix_dedup
from tradewatch.llm.common import prepare, table
from tradewatch.session import scratch_path

#: Near duplicates: shingles of five words, similarity of at least 0.8.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct("*").alias("row"), F.col("text"))  # the documents' columns cannot clash with the measures
    judged = quality_rules.measures(rows, "text", ("row",))
    return judged.filter(quality_rules.verdict(rules)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the smallest id (without an id only if none has one).

    Rows are named by a 64-bit hash of their text, so ids may be missing or repeated; of rows that agree in id and text
    the one with the smallest hash of all columns stays.  Texts without words are near duplicates of nothing.
    """
    node = F.xxhash64(F.coalesce("text", F.lit("")))
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.struct("*").alias("row"), F.col("text"), F.col("doc_id").alias("_id"), node.alias("_node"), whole.alias("_whole"))
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0d]"), F.lit(False))
    worded = rows.filter(words)
    groups = jaccard_join.join(worded.select("_node", "text"), SHINGLE_WORDS, SIMILARITY_PERCENT, id_col="_node")
    groups = groups.select(F.col("doc_id").alias("_node"), F.col("component_id").alias("_component")).distinct()
    firsts = worded.groupBy("_node").agg(F.min("_id").alias("_id")).join(groups, "_node")
    lead = F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_node"))).alias("lead")
    leads = firsts.groupBy("_component").agg(lead).select(F.col("lead._id").alias("_lead_id"), F.col("lead._node").alias("_lead"))
    chosen = worded.select("_node", "_id", "_whole").join(leads, (F.col("_node") == leads["_lead"]) & F.col("_id").eqNullSafe(leads["_lead_id"]), "left_semi")
    chosen = chosen.groupBy("_node").agg(F.min("_whole").alias("_whole")).select("_whole")
    # whole rows are shuffled once: join and deduplication are on the same key
    kept = worded.select("row", "_whole").join(chosen, "_whole", "left_semi").groupBy("_whole").agg(F.first("row").alias("row"))
    return kept.select("row.*").unionByName(rows.filter(~words).select("row.*"))


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the text that an earlier document already has; a document of which nothing is left goes.

    A cut may fall inside a character; its remaining bytes go too.
    """
    cut = (
        suffix_dedup.dedup(docs, with_text=True)
        .filter("n_removed > 0")
        .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("kept_text").alias("_kept"))
        .dropDuplicates(["_id", "_sha"])
    )
    rows = docs.withColumn("_text_sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    joined = rows.join(cut, rows["doc_id"].eqNullSafe(cut["_id"]) & (rows["_text_sha"] == cut["_sha"]), "left").filter("_id is null or length(_kept) > 0")
    new = {"text": F.coalesce("_kept", "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("_kept").cast(docs.schema["n_chars"].dataType), "n_chars")
    return joined.withColumns(new).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and their count; the decoded ids give the text back."""
    import public_tokenizers

    columns = tuple(c for c in docs.columns if c != "text")
    out = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=columns)
    return out.select(*columns, F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_text),
    ("benchmark_decontamination", decontaminate),
    ("byte_level_bpe", encode),
]

#: The learned list and the token ids are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    tag = uuid.uuid4().hex[:8]
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{tag}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
