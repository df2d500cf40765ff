"""Session helpers: one place that knows how a marketframe job wants Spark configured."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Every timestamp in the data model is UTC (DateTime64(3, 'UTC') in the source DDL).
UTC_CONF = {"spark.sql.session.timeZone": "UTC"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "marketframe", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session tuned for these jobs.

    On a cluster, ``master`` is left to spark-submit and ``shuffle_partitions`` should be sized so a
    shuffle partition stays around 128-256 MB; AQE coalesces small ones and splits skewed joins.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # tiny shuffles (small inputs, per-symbol window stages) keep their parallelism; at scale every
        # partition is far above this floor, so coalescing is unchanged there
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of DataFrames that went out of scope are removed by the context cleaner
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **UTC_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _own_folder(spark: SparkSession) -> str:
    """A folder of this application on the driver's machine."""
    return os.path.join(os.path.realpath(tempfile.gettempdir()), f"marketframe-{spark.sparkContext.applicationId}")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be on shared storage and is configured by the deployment: without the setting this
    raises. Only a local master (tests, laptops), where driver and executors are one process, gets a local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _own_folder(spark)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, unless their Python path has it already.

    Needed when only the driver's ``sys.path`` names the folder; with ``--py-files`` or a shared
    ``PYTHONPATH`` nothing is sent.
    """
    here = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(here)
    on_path = {os.path.realpath(p or ".") for p in [*os.environ.get("PYTHONPATH", "").split(os.pathsep), "."]}
    sc = spark.sparkContext
    if not os.path.isdir(here) or os.path.realpath(root) in on_path or getattr(sc, "_marketframe_sent", False):
        return
    os.makedirs(_own_folder(spark), exist_ok=True)
    made = os.path.join(_own_folder(spark), "marketframe.zip")
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(made)
    sc._marketframe_sent = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for materialised intermediate tables, removed when the application ends."""
    own = os.path.join(ensure_checkpoint_dir(spark), "tables", spark.sparkContext.applicationId)
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
    fs = made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(made)                                             # only what exists can be marked for deletion
    fs.deleteOnExit(made)
    return os.path.join(own, name)


def cut_lineage(df):
    """Materialise ``df`` into the shared checkpoint folder and continue from the written copy.

    Used where one result feeds several later scans: without it every downstream reference
    re-plans (and may recompute) the whole chain above, and a lost executor would recompute it too.
    A reliable checkpoint (never a local one) survives executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
