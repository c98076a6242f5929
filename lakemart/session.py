"""Session settings, the shared work folder and small catalog helpers.

Jobs never create their own cluster settings: they take the session they are
given.  ``build_session`` is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings of the sessions this package builds itself (tests, bench).  Jobs
# never change the session they are given: AQE and skew-join handling are
# Spark's defaults, and every timestamp is TIMESTAMP_NTZ, so results do not
# depend on the session time zone.
JOB_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

LAKE_ROOT_CONF = "lakemart.lake.root"
SALTS_CONF = "lakemart.skew.salts"
BUCKETS_CONF = "lakemart.buckets"
BUCKET_BYTES = 256 << 20
MAX_BUCKETS = 50_000
PART_BYTES = 16 << 20


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "lakemart", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    master = master or os.environ.get("LAKEMART_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**JOB_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def sizing(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` on ``total_cores`` cores.

    Scan splits of ``target_partition_bytes``; initial shuffle partitions so
    that a shuffle of the whole input lands near the target per reducer
    (at least 3 waves of tasks), left to AQE to coalesce small ones and split
    skewed ones.  E.g. 100 TB on 8,000 cores → 256 MB splits, ~400k initial
    shuffle partitions that AQE coalesces to the real shuffle size.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir``.  Only a session on one
    machine (``local[...]``: tests) may have none and gets a private folder;
    on a cluster each executor would write to its own disk, so a missing
    setting is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() if sc else current
    if sc is None or not on_one_machine(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="lakemart-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return sc.getCheckpointDir()


def on_one_machine(master: str) -> bool:
    """Whether driver and tasks share one process (``local-cluster`` does not)."""
    return master == "local" or master.startswith("local[")


def lake_root(spark: SparkSession) -> str:
    """Root of the layered lake (raw / stg / ods / mart / checkpoints).

    ``lakemart.lake.root`` wins; otherwise a folder beside the shared
    checkpoint folder, so everything a job writes lands on shared storage.
    """
    root = spark.conf.get(LAKE_ROOT_CONF, None)
    if root:
        return root.rstrip("/")
    ckpt = ensure_checkpoint_dir(spark)
    # getCheckpointDir() returns <dir>/<uuid>; keep lake data beside it.
    return ckpt.rstrip("/") + "-lake"


def skew_salts(spark: SparkSession, default: int = 16) -> int:
    """Sub-keys per hot key for salted joins and aggregates
    (``lakemart.skew.salts``): how many tasks share one hot key."""
    return int(spark.conf.get(SALTS_CONF, str(default)))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as its scans have listed them
    (rows that come from no file count nothing)."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()  # noqa: SLF001
    total = 0
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.nodeName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            total += int(leaf.relation().location().sizeInBytes())
    return total


def part_count(df: DataFrame) -> int | None:
    """Tasks for a shuffle of ``df`` with one per PART_BYTES of the files that
    it reads; None where that is no more than the cores, which adaptive
    execution keeps busy anyway.

    Left to itself it packs the data into as many tasks as there are cores, so
    a task's sorts and hash tables would grow with the input."""
    n = min(MAX_BUCKETS, -(-input_bytes(df) // PART_BYTES))
    return n if n > df.sparkSession.sparkContext.defaultParallelism else None


def dealt_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` by ``key`` in ``part_count`` parts (few: left as it is, to be
    dealt by the join or grouping that follows)."""
    n = part_count(df)
    return df.repartition(n, key) if n else df


def bucket_count(spark: SparkSession, df: DataFrame, minimum: int = 8) -> int:
    """Buckets for a keyed or co-located layout (``lakemart.buckets``), by
    default one per BUCKET_BYTES of the files that ``df`` reads, at least
    ``minimum`` and at most MAX_BUCKETS: Spark refuses more than 100,000
    buckets, and beyond the limit buckets grow instead."""
    fixed = spark.conf.get(BUCKETS_CONF, None)
    if fixed:
        return int(fixed)
    return min(MAX_BUCKETS, max(minimum, -(-input_bytes(df) // BUCKET_BYTES)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the lake root for one job run."""
    return f"{lake_root(spark)}/work/{name}-{uuid.uuid4().hex[:12]}"


def create_layers(spark: SparkSession, layers=("raw", "stg", "ods", "mart")) -> list[str]:
    """Create one database per lake layer (idempotent), located under
    the lake root — never in a warehouse folder of the driver's working
    directory."""
    root = lake_root(spark)
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/warehouse/{layer}.db'")
    return list(layers)


def drop_table_if_exists(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
