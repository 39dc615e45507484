"""Session set-up, the shared scratch folder and size-checked broadcasting."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The JVM never compiles methods above this size, so wide recodes run faster as split functions.
    METHOD_LIMIT: "8000",
    "spark.ui.enabled": "false",
}

# A lookup is broadcast with a hint only when a count shows it is below this many rows.
BROADCAST_ROWS = 200_000


def get_session(app_name: str = "cohortry", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compiled(df: DataFrame) -> DataFrame:
    """The frame, in a session that lets the JVM compile what its wide projections become: a session not made by
    ``get_session`` would run them interpreted. Rows do not depend on the setting; a lower limit stays."""
    conf = df.sparkSession.conf
    if int(conf.get(METHOD_LIMIT)) > int(DEFAULTS[METHOD_LIMIT]):
        conf.set(METHOD_LIMIT, DEFAULTS[METHOD_LIMIT])
    return df


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master that names none (tests); a cluster without the
    setting is an error, since a machine-local folder would not outlive its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="cohortry-")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/cohortry/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and cut its lineage there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the frame column by column to the shared folder and read it back: lineage ends there, and later readers
    fetch only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    # Parquet has no column without a type.
    untyped = [f.name for f in df.schema if isinstance(f.dataType, NullType)]
    typed = df.withColumns({c: F.col(c).cast("string") for c in untyped})
    typed.write.parquet(path)
    back = df.sparkSession.read.schema(typed.schema).parquet(path)
    return back.withColumns({c: F.lit(None) for c in untyped})


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a bounded count proves the frame small; else leave the join to Spark."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
