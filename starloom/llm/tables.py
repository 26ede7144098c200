"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import starloom
from starloom.session import fits_broadcast, scratch_dir

#: Bytes of a table that may be copied to every executor, measured before it is.
COPIED_BYTES = 16 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(starloom.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="starloom-")) / "starloom-package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, of known size."""
    spark = df.sparkSession
    target = f"{scratch_dir(spark)}/table"
    df.write.option("compression", codec).parquet(target)
    table = spark.read.schema(df.schema).parquet(target)
    table.stored_at = target
    return table


def released(*tables: DataFrame) -> None:
    """Removes the files of ``stored`` tables that nothing reads any more, to free the shared folder early."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def quoted(name: str) -> str:
    """A column's name as one name, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """(row, ...): the rows of ``docs`` as one struct beside columns of their own, so that no names can clash.

    ``select("row.*")`` gives back what there was.
    """
    row = F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns])
    return docs.select(row.alias("row"), *[value.alias(name) for name, value in columns.items()])


def beside(small: DataFrame) -> DataFrame:
    """``small`` marked for a broadcast join if it is measured to be small enough; else as it is.

    Without the mark the join is a shuffled one that can split hot keys.
    """
    return F.broadcast(small) if fits_broadcast(small, COPIED_BYTES) else small


def write_files(df: DataFrame, column: str, path: str) -> None:
    """One file per row of ``df``, holding the bytes of a binary column and a line feed.

    Spark's own writer and committer do it, so any store that Spark reaches will do, and a task
    that is run again replaces its files.
    """
    content = df.select(F.col(column).cast("string").alias("value"))
    content.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The files that ``write_files`` wrote: ``path``, ``content`` without the line feed."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return found.select("path", F.expr("substring(content, 1, length(content) - 1)").alias("content"))


def running_total(df: DataFrame, part: Column, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all earlier rows by (part, order), without one task for all.

    Parts are totalled first; only these totals, a row per part, are summed up in a single task.
    """
    marked = df.withColumn("_part", part).withColumn("_value", value)
    totals = marked.groupBy("_part").agg(F.sum("_value").alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = marked.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    summed = within.join(totals, "_part")
    return summed.withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_value", "_before", "_inside")
