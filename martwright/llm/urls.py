"""URL verdicts: longest fitting rule, else logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, let, saved


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
ALLOW, BLOCK = "allow", "block"

#: The model: length of the n-grams, hash buckets, and most labelled rows it learns from, per verdict.
GRAM = 3
BUCKETS = 1 << 13
SAMPLE = 2000
#: Weight of the penalty on the coefficients.
PENALTY = 0.001


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _best_rule(host: Column, path: Column, rules: tuple[Rule, ...], what) -> Column:
    """``what`` of the longest fitting rule, a blocking one before an allowing one of its length; else null."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(str(r)), r.verdict != BLOCK, str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.lit(what(rule))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("string") if out is None else out


def _grams(text: Column, kind: str) -> Column:
    """Distinct runs of GRAM characters of ``text`` between its two ends, marked by kind."""
    framed = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def runs(chars: Column) -> Column:
        first = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - (GRAM - 1), F.lit(0)))
        return F.transform(
            first, lambda c, at: F.concat(F.lit(kind), c, *(F.get(chars, at + k) for k in range(1, GRAM)))
        )

    return F.array_distinct(let(F.filter(framed, lambda c: c != ""), runs))


def _features(pages: DataFrame) -> DataFrame:
    grams = pages.withColumn("__grams", F.concat(_grams(F.col("host"), "h"), _grams(F.col("path"), "p")))
    return HashingTF(inputCol="__grams", outputCol="__features", numFeatures=BUCKETS, binary=True).transform(grams)


def _model(judged: DataFrame):
    """A model of the verdict, from at most SAMPLE different labelled urls of each; or the only verdict there is."""
    different = judged.dropDuplicates(["host", "path", "verdict"])
    labelled = saved(
        different.filter("verdict = 'allow'").orderBy(F.xxhash64("host", "path"), "host", "path").limit(SAMPLE)
        .union(different.filter("verdict = 'block'").orderBy(F.xxhash64("host", "path"), "host", "path").limit(SAMPLE)),
        "labelled-urls",
    )
    present = [row["verdict"] for row in labelled.select("verdict").distinct().collect()]
    if len(present) < 2:
        return present[0] if present else ALLOW
    rows = _features(labelled.coalesce(1)).withColumn("label", (F.col("verdict") == ALLOW).cast("double"))
    return LogisticRegression(
        featuresCol="__features", labelCol="label", regParam=PENALTY, maxIter=50, standardization=False,
        predictionCol="__allowed", probabilityCol="__probability", rawPredictionCol="__raw",
    ).fit(rows.select("label", "__features"))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labels: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages (page_id, url)``.

    A url gets the verdict of its longest fitting rule (``rule`` names it), else the model's. The model learns from
    ``labels (url, verdict)``, or, without it, from the urls that rules decide: in either case from at most SAMPLE different ones of
    each verdict, those of the least hash of host and path. With one verdict among them that is everyone's, with none it is allow.
    A null url, or one without ``://``, has an empty host and path, which no rule fits. Repeated rows get equal verdicts, a null page_id
    stays null, an empty table gives no row, other columns are ignored.

    Rules and model are applied where the rows lie; nothing is moved but hosts and paths, to tell different urls.
    """

    def parted(urls: DataFrame, *more: str) -> DataFrame:
        return urls.select(*more, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    ruled = parted(pages, "page_id")
    host, path = F.col("host"), F.col("path")
    ruled = ruled.select(
        "page_id",
        "host",
        "path",
        _best_rule(host, path, rules, str).alias("rule"),
        _best_rule(host, path, rules, lambda r: r.verdict).alias("verdict"),
    )
    known = ruled.filter("verdict is not null").select("host", "path", "verdict")
    if labels is not None:
        known = parted(labels, "verdict").select("host", "path", "verdict")
    model = _model(known)
    if isinstance(model, str):
        learned, verdict = ruled, F.lit(model)
    else:
        learned = model.transform(_features(ruled))
        verdict = F.when(F.col("__allowed") == 1, ALLOW).otherwise(BLOCK)
    return learned.select("page_id", "host", "path", "rule", F.coalesce("verdict", verdict).alias("verdict"))
