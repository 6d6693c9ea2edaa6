"""Session helpers: building a session, the shared checkpoint folder, and
size-checked broadcasts.

Nothing here is specific to one query; operators call these helpers so that
every broadcast in the library goes through one bounded check and every
lineage cut goes to the folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default bound for "small side" broadcasts (rows). Query terms, lambdas,
# judgements of a query set and single-doc vectors sit far below this; a side
# above it is joined with a shuffle instead.
BROADCAST_MAX_ROWS = 500_000


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with AQE, UTC time and the UI off.

    On a cluster ``master`` is left to spark-submit; locally pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from ``spark.checkpoint.dir`` (or the context's current checkpoint
    folder). Only a local-mode session without one gets a fresh temporary
    folder; a cluster session without one is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder for written
    intermediate tables and file fixtures."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/quire-staging/{name}-{uuid.uuid4().hex[:12]}"


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The check runs ``limit(max_rows + 1).count()``, which stops reading as soon
    as the bound is exceeded. Beyond the bound the frame is returned as is and
    the planner joins it with a shuffle. Nothing is cached: expensive small
    sides are checkpointed by their producers, so a long session does not
    accumulate cached blocks.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from it.

    Used where several consumers read one expensive intermediate (a reliable
    checkpoint survives executor loss and cuts the lineage; its partitioning
    is kept, so a frame hash-partitioned on a key stays so).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table below the shared checkpoint folder
    and continue from it. One pass over ``df`` (a checkpoint computes its
    frame twice), with column pruning for the readers; the partitioning is
    not kept."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
