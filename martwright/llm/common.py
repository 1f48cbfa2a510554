"""What the operators share: written intermediates, texts as native expressions, links to components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: The blanks that part words and are stripped from lines: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHINGLE = 5
SIMILARITY_PERCENT = 80


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this library wherever they start: once per application, as a zip."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = Path(tempfile.mkdtemp(prefix="martwright-code-")).resolve()  # the driver's; Spark serves it to executors
        with zipfile.ZipFile(archive := f"{folder}/{package.name}.zip", "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def saved(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df``, written to a new folder beside the session's checkpoints and read again.

    It cuts the lineage, outlives lost executors, and gives the planner true sizes.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/martwright-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character kept."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The lower-cased words of ``text``; none for null."""
    trimmed = F.btrim(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, WORD_GAP)).otherwise(F.array().cast("array<string>"))


def shingle_hashes(text: Column) -> Column:
    """64-bit hashes of the distinct runs of five words of ``text``.

    Fewer words count as one run of them all; a text without words has none.
    """

    def runs(w: Column) -> Column:
        def run(first: Column, at: Column) -> Column:
            return F.xxhash64(first, *(F.get(w, at + k) for k in range(1, SHINGLE)))

        return F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.least(F.size(w), F.lit(1)))), run)

    return F.array_distinct(let(words(text), runs))


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of all ids in ``edges (a, b)``: the smallest id reachable from each.

    Every round each id takes the smallest label around it and then the label of that label, so labels
    travel twice as far as the round before. Rounds are written out; their number is that of the
    doublings, not of the rows, and nothing but one count per round reaches the driver.
    """
    both = saved(
        edges.select(F.col("a").alias("id"), F.col("b").alias("other"))
        .union(edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
        .distinct(),
        "edges",
    )
    labels = saved(
        both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")), "labels"
    )
    while True:
        around = (
            both.join(labels.select(F.col("id").alias("other"), "component"), "other")
            .groupBy("id")
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(around, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("near")
        )
        of_label = labels.select(F.col("id").alias("near"), F.col("component").alias("further"))
        after = saved(
            nearer.join(of_label, "near").select("id", "old", F.least("near", "further").alias("component")),
            "labels",
        )
        labels = after.select("id", "component")
        if after.filter("old != component").isEmpty():
            return labels
