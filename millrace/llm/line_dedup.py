"""Line dedup with levelled sorted runs of line hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.frames import ascii_lower, identified, same_row, saved
from millrace.session import scratch_table

BLANK = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


class Runs:
    """Sorted runs of (h1, h2, keeper) in levels; ``fanout`` runs of a level are merged into one of the next.

    A run is a table bucketed and sorted by the hash, so joining it moves only the new batch.
    """

    def __init__(self, spark: SparkSession, buckets: int, fanout: int):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def without_known(self, keys: DataFrame) -> DataFrame:
        for name in self.tables():
            keys = keys.join(self.spark.table(name), KEY, "left_anti")
        return keys

    def write(self, keys: DataFrame) -> str:
        name = scratch_table(self.spark, "line_run")
        dealt = keys.repartition(self.buckets, *KEY)
        dealt.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def add(self, name: str, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) < self.fanout:
            return
        merged, self.levels[level] = self.levels[level], []
        both = self.spark.table(merged[0])
        for other in merged[1:]:
            both = both.unionAll(self.spark.table(other))
        self.add(self.write(both), level + 1)


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 4,
    fanout: int = 2, buckets: int | None = None,
) -> DataFrame:
    """Every row with its text after dropping lines that a document of a smaller id holds too.

    A line's key is the line stripped of ASCII blanks and with A-Z lower-cased, as a 128-bit hash; keys under
    ``min_chars`` code points never drop. Documents come in ``batches`` by ascending id. A batch's keys are
    anti-joined with the sorted runs of all earlier ones, and those left, with their smallest id, become a new run.
    Returns rid, n_lines, n_dropped, kept. Null texts count as empty (one empty line); null ids come last, as one
    document; rows of equal id are one document; an empty table gives an empty frame.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = identified(docs, id_col, text_col).withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    owner = F.coalesce("rid", F.lit(2**63 - 1)).alias("owner")
    cuts = []
    if batches > 1:
        shares = [i / batches for i in range(1, batches)]
        cuts = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), shares).alias("cuts")).first().cuts or []
    batch = sum((F.coalesce((F.col("owner") >= F.lit(c)).cast("int"), F.lit(1)) for c in sorted(set(cuts))), F.lit(0))
    stripped = F.btrim(F.col("line"), F.lit(BLANK))
    found = rows.select("rid", "t1", "t2", owner, F.posexplode("lines").alias("pos", "line")).select(
        "rid", "t1", "t2", "owner", "pos", ascii_lower(stripped).alias("key")).where(F.length("key") >= min_chars)
    lines = saved(
        found.select("rid", "t1", "t2", "owner", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(5), "key").alias("h2"), batch.cast("int").alias("batch")),
        "lines", ["batch"])
    runs, drops = Runs(spark, buckets, fanout), None
    for i in range(len(set(cuts)) + 1):
        new = lines.where(F.col("batch") == i)
        keys = new.groupBy(*KEY).agg(F.min("owner").alias("keeper"))
        run = runs.write(runs.without_known(keys))
        kept = spark.table(run).withColumnRenamed("keeper", "owner")
        dropped = new.join(kept, [*KEY, "owner"], "left_anti").select("rid", "t1", "t2", "pos")
        drops = dropped if drops is None else drops.unionAll(dropped)
        runs.add(run)
    by_row = drops.groupBy("rid", "t1", "t2").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    joined = rows.join(by_row, same_row(rows, by_row), "left").select(
        rows.rid, "lines", F.coalesce("gone", F.expr("CAST(array() AS array<int>)")).alias("gone"))
    # The lines between two dropped ones are taken as a slice, so the work follows the number of lines.
    kept = F.expr("""
        flatten(transform(arrays_zip(concat(array(-1), gone), concat(gone, array(size(lines)))),
                          x -> slice(lines, x['0'] + 2, x['1'] - x['0'] - 1)))""")
    return joined.select(
        "rid", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"))
