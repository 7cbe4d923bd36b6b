"""Session helpers: a local test session and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CKPT: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "shardscan") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (classic or Spark Connect session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect: no SparkContext on the client
        return spark.conf.get("spark.app.id", None) or f"session-{id(spark)}"


def cores(spark: SparkSession) -> int:
    """Tasks that the session runs at once (0 where it does not say, as on Spark Connect)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return 0


def is_local(spark: SparkSession) -> bool:
    """Whether tasks run in the driver's process; ``local-cluster[...]`` has executors of its own, so it is a cluster."""
    try:
        master = spark.conf.get("spark.master", "")
    except Exception:  # pragma: no cover - connect sessions
        master = ""
    return str(master).split("[")[0] == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Reads the session's setting; only a local session without one gets a
    fresh folder of its own (as in tests).  A cluster without the setting is
    an error: a machine-local folder would not survive a lost executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this job") from None
        return shared
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not is_local(spark):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this job"
        )
    key = sc.applicationId
    if key not in _LOCAL_CKPT:
        _LOCAL_CKPT[key] = tempfile.mkdtemp(prefix="shardscan-ckpt-")
    sc.setCheckpointDir(_LOCAL_CKPT[key])
    return sc.getCheckpointDir() or _LOCAL_CKPT[key]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``shardscan`` importable in Python workers (``addPyFile`` of a zip).

    Needed by the parts that run Python in tasks: the ``sharded_dbapi`` data
    source and the SQLite fixture writer.
    """
    import shutil

    key = app_key(spark)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="shardscan-pkg-")
    archive = shutil.make_archive(
        os.path.join(folder, "shardscan"), "zip", root_dir=os.path.dirname(pkg), base_dir="shardscan"
    )
    try:
        spark.sparkContext.addPyFile(archive)
    except Exception:  # Spark Connect
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(key)
