"""Tables whose changed partitions are replaced under a version pointer.

A commit writes the partitions it replaces into a folder of its own and then one small file that names, for each
partition, the folder that holds it. Readers follow the last such file, so they see one version or the next and
never a mixture; a run that breaks before it names its folder leaves the last version as it was. The file is moved into
place whole, and of two runs that start from one version the second fails. Folders are in storage that every
executor reaches, and only ``retire`` deletes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINTER = T.StructType([T.StructField("part", T.StringType()), T.StructField("run", T.StringType())])
#: Name of the folder level that a run's partitions lie in.
_PART = "part_of"


@dataclass(frozen=True)
class Version:
    """A number and the run that holds each partition; number -1 is a table never committed."""

    number: int = -1
    runs: dict[str, str] = field(default_factory=dict)


def _folder(spark: SparkSession, path: str):
    """The file system of a path and the path in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    files, folder = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in names(spark, f"{path}/versions") if n.isdigit())


def at(spark: SparkSession, path: str, number: int) -> Version:
    """A version by its number."""
    rows = spark.read.schema(_POINTER).json(f"{path}/versions/{number}").collect()
    return Version(number, {r["part"]: r["run"] for r in rows})


def current(spark: SparkSession, path: str) -> Version:
    """The last committed version. It has a row for each partition, as many as months or days."""
    numbers = _numbers(spark, path)
    return at(spark, path, numbers[-1]) if numbers else Version()


def read(
    spark: SparkSession, path: str, schema: T.StructType, version: Version | None = None,
    parts: Iterable[str] | None = None,
) -> DataFrame:
    """The rows of a version, or of the named partitions of it. Other partitions' files are not opened."""
    version = current(spark, path) if version is None else version
    wanted = version.runs if parts is None else [p for p in parts if p in version.runs]
    folders = [f"{path}/runs/{version.runs[p]}/{_PART}={p}" for p in sorted(wanted)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write(frame: DataFrame, path: str, part: Column) -> tuple[str, list[str]]:
    """Writes rows into a folder that no version names yet: the run and the partitions it holds.

    Partitions are read off the folder's names. A null partition is refused, for it would have no name.
    """
    run = uuid.uuid4().hex
    named = F.when(part.isNotNull(), part.cast("string")).otherwise(F.raise_error(F.lit("a row without a partition")))
    frame.withColumn(_PART, named).write.partitionBy(_PART).parquet(f"{path}/runs/{run}")
    found = names(frame.sparkSession, f"{path}/runs/{run}")
    return run, [n.split("=", 1)[1] for n in found if n.startswith(f"{_PART}=")]


def point(spark: SparkSession, path: str, base: Version, replaced: Iterable[str], run: str, parts: Iterable[str]) -> Version:
    """The next version: the base's partitions without those replaced, and the run's.

    Fails if another run has made the next version meanwhile.
    """
    gone = set(replaced)
    runs = {p: r for p, r in base.runs.items() if p not in gone} | {p: run for p in parts}
    name = f"trial-{uuid.uuid4().hex}"
    spark.createDataFrame(sorted(runs.items()), _POINTER).coalesce(1).write.json(f"{path}/versions/{name}")
    files, trial = _folder(spark, f"{path}/versions/{name}")
    _, target = _folder(spark, f"{path}/versions/{base.number + 1}")
    # A folder renamed to one that exists either stays or lands inside it.
    _, inside = _folder(spark, f"{path}/versions/{base.number + 1}/{name}")
    if files.exists(target) or not files.rename(trial, target) or files.exists(inside):
        raise RuntimeError(f"version {base.number + 1} of {path} has been committed by another run")
    return Version(base.number + 1, runs)


def commit(
    frame: DataFrame, path: str, part: Column, base: Version, replaced: Iterable[str] | None = None
) -> Version:
    """Replaces the partitions of ``base`` that ``replaced`` names by the rows; by default those the rows are in.

    A partition that is replaced by no rows is gone. The rows may be computed from the version they replace.
    """
    run, parts = write(frame, path, part)
    return point(frame.sparkSession, path, base, parts if replaced is None else replaced, run, parts)


def retire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes the folders that none of the last ``keep`` versions names, and older pointers; the number of folders.

    To be run while no commit is under way, since a run's folder is named last.
    """
    numbers = _numbers(spark, path)
    held = {r for n in numbers[-keep:] for r in at(spark, path, n).runs.values()}
    lost = [r for r in names(spark, f"{path}/runs") if r not in held]
    for name in [f"runs/{r}" for r in lost] + [f"versions/{n}" for n in numbers[:-keep]]:
        files, folder = _folder(spark, f"{path}/{name}")
        files.delete(folder, True)
    return len(lost)
