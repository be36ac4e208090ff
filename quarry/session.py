"""Session helpers: the shared folder for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_LOCAL_SHARED: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session.  Only a local-mode session without
    it (tests, notebooks) gets a folder of its own, created once per
    application and also set for ``checkpoint()``; a cluster session without it is an error, because a
    machine-local folder is not visible to executors.
    """
    sc = _context(spark)
    if sc is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return base.rstrip("/")
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = _LOCAL_SHARED.get(sc.applicationId)
        if base is None:
            base = tempfile.mkdtemp(prefix="quarry-shared-")
            _LOCAL_SHARED[sc.applicationId] = base
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
    return base.rstrip("/")


def _context(spark: SparkSession):
    """The Spark context, or None where there is none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - which error says so depends on the client
        return None


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    path = f"{shared_dir(spark)}/quarry/{kind}/{uuid.uuid4().hex}"
    _SCRATCH.setdefault(_application(spark), []).append(path)
    return path


def _application(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else "connect"


def scratch_mark(spark: SparkSession) -> int:
    """A place in the list of scratch paths, for :func:`release_scratch`."""
    return len(_SCRATCH.get(_application(spark), []))


def release_scratch(spark: SparkSession, since: int = 0) -> list[str]:
    """Delete the scratch folders that this application has made after the mark
    ``since`` (all by default), through Spark's file system.  Frames that read
    them are of no use afterwards.  Returns the paths."""
    made = _SCRATCH.get(_application(spark), [])
    gone = made[since:]
    for path in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    del made[since:]
    return gone


def unique_name(prefix: str) -> str:
    """A catalog-safe unique name such as ``events_saved_1f2e...``."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input on
    ``total_cores`` executor cores (pass them to the session builder or
    ``spark-submit --conf``).

    Scan tasks read ~512 MB each; shuffles start with enough partitions for
    ~512 MB of input each (partial aggregation makes most shuffles far
    smaller) and AQE coalesces them toward 256 MB and splits skewed join
    partitions.  Broadcasts stay at or below 64 MB of estimated size.
    """
    mb = 1024 * 1024
    shuffle = max(2 * total_cores, min(200_000, input_bytes // (512 * mb)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * mb),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(512 * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, UTC."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
