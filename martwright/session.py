"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "martwright") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def expect_skew(spark: SparkSession) -> None:
    """Let adaptive execution split hot join keys at any place of a plan.

    By default it leaves a skewed join alone if the next step relies on its
    partitioning; forced, it shuffles once more, and only where there is skew.
    """
    for name in ("enabled", "skewJoin.enabled", "forceOptimizeSkewedJoin"):
        spark.conf.set(f"spark.sql.adaptive.{name}", "true")


#: Spark's own limit is held against the size of files, which are many times smaller than their rows in memory.
BROADCAST_BYTES = 1 << 20


def bound_broadcasts(spark: SparkSession) -> None:
    """Keep tables that grow with the input from being sent to the driver and from there to every executor.

    A lower limit that is set already, or none (-1), stays.
    """
    name = "spark.sql.autoBroadcastJoinThreshold"
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(name).strip().lower()).groups()
    if int(number) << (10 * " kmgt".index(unit or " ")) > BROADCAST_BYTES:
        spark.conf.set(name, str(BROADCAST_BYTES))


@lru_cache(maxsize=None)
def _local_folder(app_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"martwright-{app_id}-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read, as the cluster names it.

    A machine-local folder is only ever chosen for a local master with no such
    setting; on a cluster without it this raises rather than losing data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder(spark.conf.get("spark.app.id"))
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
