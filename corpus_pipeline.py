"""A corpus pipeline of five stages: quality, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), docs being what its predecessor kept, and returns a DataFrame; all
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import leave_out, materialize
from tally.llm.exact_dedup import exact_dedup
from tally.llm.jaccard import jaccard_join
from tally.llm.mixing import mix_sources
from tally.llm.packing import pack
from tally.llm.quality import classify_quality
from tally.llm.queries import tokenizer


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; null and empty texts are judged as one token."""
    judged = classify_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=docs.columns)
    return judged.where("_accepted").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest id.

    Null counts as empty.  Rows that repeat an id and a text are one document and stay or go together; of rows without an
    id one stays, if no row with an id has their text.
    """
    decided = exact_dedup(docs, carry={"_sha": F.sha2("_norm", 256)})
    key = lambda i, sha: F.concat_ws("/", F.coalesce(i.cast("string"), F.lit("")), sha)
    gone = decided.where("NOT kept").select(key(F.col("doc_id"), F.col("_sha")).alias("key"))
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return leave_out(docs, gone, key(F.col("doc_id"), F.sha2(text, 256)))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts: the one with the smallest id; rows without an id and texts without
    words stay."""
    gone = jaccard_join(docs).where("doc_id <> component_id").select(F.col("doc_id").cast("string").alias("key"))
    return leave_out(docs, gone, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: files hold ascending slots.

    Rows without an id count as one document -1; rows that repeat an id and a text share its first slot.
    """
    columns = docs.columns
    docs = docs.withColumns({"_doc": F.struct(*columns)}).select("_doc", "doc_id", "source", "text")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size")
    named = docs.withColumn("_row", F.xxhash64("text")).withColumn("_id", F.coalesce("doc_id", F.lit(-1)))
    light = materialize(named.select("_id", "_row", "doc_id", "source", size), "sizes")
    slots = materialize(mix_sources(light, "size").groupBy("_id", "_row").agg(F.min("slot").alias("_slot")), "slots")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = slots.agg(F.percentile_approx("_slot", F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(10_000))).first()[0] if n > 1 else []
    below = F.filter(F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts or []))]), lambda c: c < F.col("_slot"))
    placed = named.join(slots.withColumn("_part", F.size(below)), ["_id", "_row"])
    return placed.repartitionById(n, "_part").sortWithinPartitions("_slot", "_id").select(*[F.col("_doc").getField(c).alias(c) for c in columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens; null texts hold their end only.

    Each file of the mixture is a lot: its documents are packed among themselves, and sequences ascend with the slots.
    """
    file = F.nullif(F.regexp_extract(F.input_file_name(), r"part-(\d+)[^/]*$", 1), F.lit(""))
    return pack(docs, *tokenizer(), lot=file.cast("int"))


STAGES = [
    ("quality classifier", accepted),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources", mixed),
    ("packing", packed),
]

#: SQL can't express the language model, the mixture's schedule or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
