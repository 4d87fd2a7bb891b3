"""What the operators share: row identity, saved intermediates, connected components, offsets."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import scratch_table, shared_dir

#: A broadcast is allowed up to so many rows of a few words each; beyond it a join shuffles.
BROADCAST_ROWS = 200_000

#: Bytes of rows that go to a Python process at once; of long texts, Spark's own number of rows would hold many times this.
BATCH_BYTES = 1 << 22

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def saved(df: DataFrame, purpose: str, partition_by: list[str] | None = None, codec: str | None = None,
          level: int = 3) -> DataFrame:
    """Cuts the lineage: the frame written to the cluster's shared folder and read again. ``level`` is that of zstd."""
    path = shared_dir(df.sparkSession, purpose)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer = writer.option("compression", codec).option("parquet.compression.codec.zstd.level", level) if codec else writer
    with small_batches(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_in_place(df: DataFrame, purpose: str, part: str, level: int = 3) -> DataFrame:
    """As ``saved``, with the rows bucketed by ``part``, the number of their partition, so that no row is moved for it.

    Each partition is one file of one bucket. A join on part and other columns then moves only its other side,
    if it is planned within ``co_partitioned``.
    """
    spark, table = df.sparkSession, scratch_table(df.sparkSession, purpose)
    writer = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), part).option("compression", "zstd")
    writer.option("parquet.compression.codec.zstd.level", level).saveAsTable(table, format="parquet")
    return spark.table(table)


@contextmanager
def _set_within(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def co_partitioned(spark: SparkSession) -> AbstractContextManager[None]:
    """Joins planned within accept sides that are both dealt by only some of the join's keys."""
    return _set_within(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """What runs within gives Python its rows in batches of about ``BATCH_BYTES``; an executor holds one or two of each task."""
    return _set_within(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint, given only where the counted rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone; text of only ASCII takes the faster function."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def text_key(text: Column) -> list[Column]:
    """128 bits of the whole text as two longs; a null text has a key apart from the empty one."""
    marked = F.coalesce(F.concat(F.lit("t"), text), F.lit(""))
    return [F.xxhash64(marked).alias("t1"), F.xxhash64(F.lit(17), marked).alias("t2")]


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id (rid), text and text key of every row; nothing else of the row goes on, so names cannot clash.

    Rows of equal id and text are one document in several rows: decisions are made once for their key
    (rid, t1, t2) and hold for each of them.
    """
    return docs.select(
        F.col(id_col).cast("long").alias("rid"), F.col(text_col).alias("text"), *text_key(F.col(text_col))
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left.rid.eqNullSafe(right.rid) & (left.t1 == right.t1) & (left.t2 == right.t2)


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Whole rows in one column (row) beside their key, so that a join's names cannot clash with theirs."""
    return docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("rid"), *text_key(F.col(text_col)))


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose key (rid, t1, t2) is not in gone."""
    rows, gone = packed(docs, id_col, text_col), saved(gone.select("rid", "t1", "t2").distinct(), "gone")
    gone = small(gone, gone.count())
    return rows.join(gone, same_row(rows, gone), "left_anti").select("row.*")


def min_labels(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node reachable; edges (a, b) of longs, in any direction, repeats allowed.

    Alternates large and small stars until the edges no longer change. Both are joins with an aggregated
    minimum, so a node with very many edges is pre-aggregated and its join can be split.
    """
    edges = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "edges")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        joined = large.join(least, large.a == least.n)
        stars = joined.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b")
        edges = saved(stars.union(least.select("n", "m")).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == state:
            break
        state = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))


def running_total(df: DataFrame, group: str, order: list[str], value: str, purpose: str) -> DataFrame:
    """The rows, saved, with ``before``: the sum of ``value`` over the earlier rows of the group.

    A group may hold most rows: rows are dealt by range, each range sums its own rows, and only the sums
    of the ranges are put in one order.
    """
    dealt = saved(df.repartitionByRange(group, *order).withColumn("_part", F.spark_partition_id()), purpose)
    sums = dealt.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_number")).agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy("_group").orderBy("_number").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("_group", "_number", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    within = W.partitionBy(group, "_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    joined = dealt.join(sums, dealt[group].eqNullSafe(sums["_group"]) & (dealt["_part"] == sums["_number"]))
    before = F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0))
    return joined.withColumn("before", before).drop("_group", "_number", "_part", "_base")
