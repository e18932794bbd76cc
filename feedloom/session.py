"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that parsed offsets land on the same instant
# the oracle computes, ANSI semantics with try_* functions where input may be junk,
# AQE for runtime re-planning (coalescing, skew splits, runtime broadcast decisions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # windows-1251 and other legacy charsets for decode()
    "spark.sql.legacy.javaCharsets": "true",
    # a malformed byte becomes U+FFFD instead of failing the job
    "spark.sql.legacy.codingErrorAction": "true",
    "spark.ui.enabled": "false",
    # Large inputs: 256 MB scan splits and AQE-sized shuffle partitions; the initial shuffle
    # partition count is high on a cluster (see CLUSTER_SHUFFLE_PARTITIONS) and AQE coalesces
    # it down to the advisory size, so small stages do not pay for it.
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
}
# Of these, sizes that depend on the cluster: a session that sets them keeps its own.
SIZE_CONF = {k for k in BASE_CONF if k.endswith(("maxPartitionBytes", "InBytes"))}
# Initial shuffle width on a cluster (no explicit master). Most plans here shuffle a narrow
# projection (keys and hashes), a few TB at 100 TB of input: 32k partitions keep reducers near
# the advisory size; AQE coalesces the stages that shuffle less. A session that already sets
# spark.sql.shuffle.partitions keeps its own value.
CLUSTER_SHUFFLE_PARTITIONS = 32_768


def build_session(master: str | None = None, app: str = "feedloom",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster ``master`` stays None and the launcher decides; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif not master and "spark.sql.shuffle.partitions" not in (extra or {}):
        conf["spark.sql.shuffle.partitions"] = str(CLUSTER_SHUFFLE_PARTITIONS)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a reused session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Only a local session may leave it unset: it gets
    a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="feedloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:
        pass
    return d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per session, so Python workers can import it
    wherever they start. The archive is made on the driver; Spark copies it to each executor."""
    sc = spark.sparkContext
    if getattr(sc, "_feedloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="feedloom-py-"), "feedloom-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._feedloom_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def env_master(default: str = "local[*]") -> str:
    n = os.environ.get("BENCH_CPUS")
    return f"local[{n}]" if n else default
