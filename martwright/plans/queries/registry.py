"""Registration of queries and the inputs they share."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from ...session import bound_broadcasts, expect_skew, shared_folder
from ...sources import tpch
from ..star import publish_star


class Inputs:
    """What the queries over one folder may read: the source model and its published star."""

    def __init__(self, spark: SparkSession, folder: str, identity: str):
        self.spark, self.folder, self.identity = spark, folder, identity
        self.src: Mapping[str, DataFrame] = tpch.source_model(spark, folder)
        self._building = threading.Lock()
        self._star: Mapping[str, DataFrame] | None = None

    @property
    def star_root(self) -> str:
        return f"{shared_folder(self.spark)}/martwright/{self.identity}"

    @property
    def star(self) -> Mapping[str, DataFrame]:
        """The star, built and written on first use in the application, or again if its folder is gone."""
        with self._building:
            if self._star is None or not _exists(self.spark, self.star_root):
                self._star = publish_star(self.spark, self.star_root, self.src, tpch.AS_OF)
            return self._star


Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}

_inputs: dict[str, Inputs] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def inputs_for(spark: SparkSession, folder: str) -> Inputs:
    """The inputs of ``folder`` as it is now; changed tables get a new source model and star."""
    expect_skew(spark)
    bound_broadcasts(spark)
    application = spark.conf.get("spark.app.id")
    digest = hashlib.sha256(f"{folder}|{_state_of(spark, folder)}".encode()).hexdigest()[:16]
    identity = f"{application}/{digest}"
    return _inputs.setdefault(identity, Inputs(spark, folder, identity))


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return comparable(QUERIES[name](inputs_for(spark, folder)))


def comparable(df: DataFrame) -> DataFrame:
    """Exact money as doubles and dates as ISO text, which any client prints alike."""

    def plain(field):
        if isinstance(field.dataType, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select([plain(f) for f in df.schema.fields])


def _locate(spark: SparkSession, name: str):
    """A path and its file system, wherever the name points."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, files = _locate(spark, name)
    return files.exists(path)


def _state_of(spark: SparkSession, folder: str) -> str:
    """Sizes and times of the input tables, so changed inputs get a new star."""
    states = []
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        path, files = _locate(spark, f"{folder}/{table}.parquet")
        changed = files.getFileStatus(path).getModificationTime()
        states.append(f"{table}:{changed}:{files.getContentSummary(path).getLength()}")
    return "|".join(states)
