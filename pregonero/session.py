"""Session helpers shared by every operator: shared-folder checkpoints and checked broadcasts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "pregonero", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the engine expects (UTC clock, AQE on). The number of shuffle partitions is left to the
    cluster unless it is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster names it in spark.checkpoint.dir. Only where all executors run in this
    process (tests, a laptop) an unset one becomes a folder of this machine, removed at the end of the process; on a
    cluster that is an error, as executors would write to disks that the others don't see."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = _local_folder(spark.sparkContext.master)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


@cache
def _local_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="pregonero-checkpoints-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager)


def small(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """Broadcast hint only after counting that df has at most max_rows rows; beyond that the join is left
    to Catalyst (shuffle join with AQE skew handling)."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the lake."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of every executor this package, once a session: it need not be installed there."""
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_pregonero_shipped", False):
        return
    root = Path(__file__).resolve().parent
    base = Path(tempfile.mkdtemp(prefix="pregonero-"))
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    shutil.copytree(root, base / "src" / root.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(base / "pregonero_package"), "zip", base / "src"))
    context._pregonero_shipped = True
