"""Session helpers.

Library code never creates a session; it takes the caller's.  ``local_session``
exists for tests, the bench and the examples.  Cluster settings that matter at
scale (AQE, skew join, shuffle partitions, broadcast threshold) are set here
only when the caller did not set them.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings we rely on; applied with ``setdefault`` semantics.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Post-shuffle partitions of ~128 MB, whatever the cluster size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Runtime (post-shuffle, measured) broadcast conversion: this is the size
    # check behind every join whose small side is not statically bounded.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    # Pushes ``row_number() <= k`` below the shuffle (partial top-k per group).
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Duplicate keys of a JSON object: the last one wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "hivewire") -> SparkSession:
    """A local session for tests and the bench (UI off, no servers)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set ``DEFAULT_CONF`` keys that the session does not set yet."""
    for k, v in DEFAULT_CONF.items():
        if k == "spark.sql.streaming.stateStore.providerClass":
            continue  # static once a stream ran; leave to the deployment
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to shared storage and we only read
    it.  Only in local mode (tests, local runs) an unset one becomes a scratch
    folder; a cluster without it is an error, as a folder of one machine is
    not seen by the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = os.environ.get("HIVEWIRE_SCRATCH") or tempfile.mkdtemp(prefix="hivewire-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.conf.get("spark.checkpoint.dir", None) or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``hivewire`` importable in Python workers (stateful stream
    processors are unpickled there): zip the package once per SparkContext
    and add it with ``addPyFile`` (what ``--py-files`` does at submit time)."""
    sc = spark.sparkContext
    if getattr(sc, "_hivewire_shipped", False):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="hivewire-pyfiles-"), "hivewire.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    # The driver-side worker of transformWithState does not read the
    # shipped includes; Python workers take PYTHONPATH from this environment.
    sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in (out, sc.environment.get("PYTHONPATH")) if p)
    sc._hivewire_shipped = True
