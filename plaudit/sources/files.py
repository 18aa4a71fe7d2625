"""Names of files and folders, by Hadoop's file systems, which reach whatever Spark reads."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def folders(spark: SparkSession, path: str, files: bool = False) -> list[str]:
    """Names of the folders (or files) directly under a path that Spark's readers would look at; none if it does not exist."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    found = [s for s in system.listStatus(place) if s.isFile() == files]
    return sorted(n for n in (s.getPath().getName() for s in found) if n[0] not in "_.")


def plain_path(path: Column) -> Column:
    """A file's path with one slash after its scheme, however it was written."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")
