"""Session helpers: a sane local session for tests/bench, and a reliable
checkpoint directory read from the cluster configuration."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "textloom",
              shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Local/test session. On a cluster, build the session with the cluster's
    own settings and only call the operators."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder
         .master(master or f"local[{cpus}]")
         .appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only where nothing is configured and the master is local (tests) is a private
    folder under the system temp dir created; on a cluster executors could not see
    it, so the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="textloom-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df):
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``textloom`` importable in Python workers (executors): zip the
    package once per process and register it with ``addPyFile``."""
    sc = spark.sparkContext
    key = id(sc)
    if key in _SHIPPED:
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="textloom-pkg-")
    archive = shutil.make_archive(os.path.join(out, "textloom"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg))
    sc.addPyFile(archive)
    _SHIPPED.add(key)
