"""Session helpers: a builder for local runs and the reliable-checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", app: str = "addrweave") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call-site capture per column expression
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a fresh local one only where it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder so later readers see one fixed set of rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """As ``stable``, in Parquet: readers take only the columns they need, and joins know how large it is. Read by ``spark``, else by ``df``'s session."""
    path = f"{checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)
