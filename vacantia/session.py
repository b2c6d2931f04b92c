"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "vacantia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Cluster settings given to spark-submit win: only the SQL behaviour the results
    depend on (UTC days) and runtime re-planning are fixed here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="vacantia-")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder is the one named in ``spark.checkpoint.dir``. Where that is unset a
    single-process session gets a temporary folder; anywhere else it is an error,
    since executors could not see a folder of the driver's machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base()
    return os.path.join(base, "vacantia", f"{label}-{uuid.uuid4().hex}")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back, for what is read more than once."""
    path = shared_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def fixed_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A table of fixed values, for dimensions that are part of the program.

    Rows handed over from Python have no known size, so Spark would shuffle the large side
    of a join with them; as constants of the plan their size is known.
    """
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS fixed({columns})")
