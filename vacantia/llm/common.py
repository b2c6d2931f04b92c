"""Row keys, written tables and connected components shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.session import shared_dir

#: Parts that the links of one node are spread over, so that no node is one task's work.
SPREAD = 32


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(*columns: str) -> Column:
    """A hash that equal rows share and that tells null from every value."""
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(*parts)


def settle(frame: DataFrame, label: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: the plan behind it is cut, and any
    executor can read the rows again."""
    spark = frame.sparkSession
    path = shared_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def laid_out(frame: DataFrame, column: str, label: str) -> DataFrame:
    """A settled frame whose rows lie by a column: a later join on it moves only the other side."""
    spark = frame.sparkSession
    name, path = f"laid_out_{uuid.uuid4().hex}", shared_dir(spark, label)
    frame.write.bucketBy(partitions(spark), column).option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def discard(frame: DataFrame) -> None:
    """Deletes the files of a settled frame that nothing reads any more."""
    spark = frame.sparkSession
    for file in frame.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _star(links: DataFrame, small: bool) -> DataFrame:
    """One star step over directed links (u, v): each node's neighbours are tied to the least of them.

    The least neighbour is found per (node, part) first; a node with many links is thus summed,
    and met again, in ``SPREAD`` parts.
    """
    if small:
        sides = links.where("u > v")
    else:
        sides = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    sides = sides.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SPREAD)))
    least = (
        sides.groupBy("u", "part").agg(F.min("v").alias("m"))
        .groupBy("u").agg(F.min("m").alias("m"), F.collect_list("part").alias("parts"))
        .select("u", F.explode("parts").alias("part"), F.least("m", "u").alias("m"))
    )
    met = sides.join(least, ["u", "part"])
    if small:
        out = met.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")),
        )).alias("l")).select("l.u", "l.v")
    else:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node that is not its component's least node.

    ``links`` has the columns u and v of any one ordered type. Large-star and small-star steps
    alternate, each round written to the shared folder, until the links are stars: then every
    node is tied to the least node of its component. Rounds grow with the logarithm of a
    component's size. No component is ever in one task.
    """
    now = settle(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        later = settle(_star(_star(now, False), True), "links")
        discard(now)
        now = later
