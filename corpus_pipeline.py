"""From raw documents to shards of a training mix: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontaminate import benchmark_hits
from millrace.llm.frames import packed, same_row, saved, small, without
from millrace.llm.mixing import mix_sources
from millrace.llm.ngram_join import jaccard_join
from millrace.llm.quality import classify_quality
from millrace.llm.sharding import shard_documents

COPY_SEED = 3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose posterior chance of good quality is below a half."""
    found = classify_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without(docs, found.where("NOT good"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a similarity of 0.8, the document of the smallest id.

    Documents without words and rows without id belong to no group and stay. Of rows equal in id and text one stays.
    """
    members, _ = jaccard_join(docs, k=5, num=4, den=5, with_links=False)
    members = saved(members, "members")
    left = without(docs, members.where("component_id <> rid"))
    again = members.where("n_shingles > 0 AND rid IS NOT NULL").groupBy("rid", "t1", "t2").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1")
    if again.isEmpty():
        return left
    rows = packed(left, "doc_id", "text")
    once = rows.join(again, same_row(rows, again), "left_semi").dropDuplicates(["rid", "t1", "t2"])
    return rows.join(again, same_row(rows, again), "left_anti").unionAll(once).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of which benchmark windows cover a twentieth of the words or more."""
    hits = benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, hits.where("n_hit > 0 AND 20 * n_hit >= n_words"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words: not at all, once or twice.

    A part of a text that is left over becomes a whole copy with a chance of its size, drawn by the row's key, so that
    documents of any length come up as often as their source's target asks on average.
    """
    rows, _ = mix_sources(docs, pack=False)
    share = rows.where("size > 0").groupBy("rid", "t1", "t2").agg((F.sum("taken") / F.sum("size")).alias("share"))
    drawn = F.pmod(F.xxhash64(F.lit(COPY_SEED), "rid", "t1", "t2"), F.lit(1 << 32)) / float(1 << 32)
    whole = F.floor("share").cast("int")
    times = share.select("rid", "t1", "t2", (whole + (drawn < F.col("share") - whole).cast("int")).alias("times"))
    times = saved(times.where("times > 0"), "times")
    whole, told = packed(docs, "doc_id", "text"), small(times, times.count())
    taken = whole.join(told, same_row(whole, told))
    return taken.withColumn("copy", F.explode(F.expr("sequence(1, times)"))).select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns with shard (0 to 23) and slot, a place in the shard; columns of these names are replaced."""
    # Written with a number per row, by which rows and places meet: equal rows are many rows, and no group of them is gathered.
    rows = saved(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("ordinal")), "numbered", codec="zstd")
    flat = rows.select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "ordinal")
    placed = shard_documents(flat, ordinal_col="ordinal").select("ordinal", F.struct("shard", "slot").alias("place"))
    joined = rows.join(placed, "ordinal")
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    return joined.select(*kept, "place.shard", "place.slot")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL cannot state the classifier's fit, the drawn mix or the sampled splitters; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
