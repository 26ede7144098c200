"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the loads rely on; ``conf`` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="starloom-")
    return _local_roots[app]


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the scratch root, removed when the driver's JVM ends."""
    target = f"{scratch_root(spark).rstrip('/')}/starloom-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return target


def through_table(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    target = f"{scratch_dir(spark)}/table"
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def settled(df: DataFrame) -> DataFrame:
    """``df`` with rows at places that stay: as it is if no row is shuffled in it, else written once.

    Behind a shuffle a task that is run again may see its rows in another order, so what is dealt or
    numbered by place there could lose or double rows.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return through_table(df) if re.search(r"(?<!Broadcast)Exchange\b", plan) else df


def plan_bytes(df: DataFrame) -> int:
    """Spark's own size estimate, the one its broadcast threshold is compared with."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def row_bytes(df: DataFrame) -> int:
    """Bytes of all rows in memory, measured: files say little about rows that compress well."""
    texts = [c for c, kind in df.dtypes if kind in ("string", "binary")]
    fixed = 8 * (1 + len(df.columns) + len(texts))
    totals = [F.count(F.lit(1)) * fixed, *[F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts]]
    return int(sum(df.agg(*totals).first()))


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether ``df`` is proven to be within the limit, by default Spark's own threshold.

    Rows are measured only if the estimate is within the limit as well.
    """
    limit = broadcast_limit(df.sparkSession) if max_bytes is None else max_bytes
    return plan_bytes(df) <= limit and row_bytes(df) <= limit


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 when broadcasting is off."""
    jvm_conf = spark._jsparkSession.sessionState().conf()
    return int(jvm_conf.autoBroadcastJoinThreshold())
