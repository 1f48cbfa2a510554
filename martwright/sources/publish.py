"""Versioned tables in a shared folder.

Parquet cannot be updated in place, so every publication of a table goes to a
folder of its own, with a name no other writer can pick, and only then enters a
small list, which says what each version adds and what it puts out of force: the
whole table, nothing (a delta), or some partitions. A job that dies half way leaves
no entry and so changes nothing, a listed folder is never written again, and a delta
without rows is not listed.

A publication is made against the version its writer has read, and becomes the next one only if
that is still the newest: of two writers that started from one version at most one
succeeds, and the other raises with nothing of it in force. A store without locks can tell
that much: a writer notes its claim to the next version before it looks for others'. It waits for
a rival whose name is greater to withdraw, and withdraws before one whose name is less, or whose version is listed. A
writer that died between claim and list leaves its claim standing: then others raise until
``clear_claims``.

With ``contents`` a writer notes how many rows it has written and their fingerprint, both observed by the tasks
that write the files, so a load is reconciled without a second scan (``published_contents``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.utils import AnalysisException

from ..functions.contents import Contents

EVERYTHING = "*"
_ENTRY = "version int, folder string, drops boolean, part string"
_CLAIM = "version int, writer string, withdrawn boolean"
_OBSERVED = "folder string, contents string, rows bigint, fingerprint decimal(38,0)"
#: Seconds to wait for a rival to withdraw, and between two looks.
PATIENCE = 60.0
PAUSE = 0.3


class PublicationClash(RuntimeError):
    """Another writer has published, or is publishing, the table since it was read."""


def _listed(spark: SparkSession, path: str, schema: str) -> list:
    try:
        return spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _note(spark: SparkSession, rows: list[tuple], schema: str, path: str) -> None:
    # A folder per note: writers that append to one folder clear away each other's unfinished files.
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)


def _entries(spark: SparkSession, root: str) -> list[tuple[int, str, bool, str]]:
    """The list, oldest version first and drops before additions; a few short rows per version."""
    rows = _listed(spark, f"{root}/published", _ENTRY)
    return sorted(((r.version, r.folder, r.drops, r.part) for r in rows), key=lambda e: (e[0], e[1], not e[2]))


def version_of(spark: SparkSession, root: str) -> int:
    """The newest version; 0 for a table never published. Take it before reading what the next one is made from."""
    return max([version for version, *_ in _entries(spark, root)], default=0)


def _claims(spark: SparkSession, root: str, version: int) -> set[str]:
    rows = [r for r in _listed(spark, f"{root}/claims", _CLAIM) if r.version == version]
    return {r.writer for r in rows} - {r.writer for r in rows if r.withdrawn}


def _withdraw(spark: SparkSession, root: str, version: int, writer: str) -> None:
    _note(spark, [(version, writer, True)], _CLAIM, f"{root}/claims/entry={writer}-{uuid.uuid4().hex}-withdrawn")


def clear_claims(spark: SparkSession, root: str) -> None:
    """Withdraw the claims of writers that have died. Only for a time when no writer is at work."""
    version = version_of(spark, root) + 1
    for writer in _claims(spark, root, version):
        _withdraw(spark, root, version, writer)


def _must_be(spark: SparkSession, root: str, base: int) -> None:
    newest = version_of(spark, root)
    if newest != base:
        raise PublicationClash(f"{root} is at version {newest}, but this was made from version {base}")


def _list_next(spark: SparkSession, root: str, base: int, writer: str, entries: list[tuple[bool, str]]) -> int:
    """Enter the list as the version behind ``base``, or raise."""
    version = base + 1
    _must_be(spark, root, base)
    _note(spark, [(version, writer, False)], _CLAIM, f"{root}/claims/entry={writer}")
    try:
        waited = time.monotonic() + PATIENCE
        while rivals := _claims(spark, root, version) - {writer}:
            _must_be(spark, root, base)
            if min(rivals) < writer or time.monotonic() > waited:
                raise PublicationClash(f"version {version} of {root} is also claimed by {sorted(rivals)}")
            time.sleep(PAUSE)
        _must_be(spark, root, base)
    except BaseException:
        _withdraw(spark, root, version, writer)
        raise
    _note(spark, [(version, writer, *entry) for entry in entries], _ENTRY, f"{root}/published/entry={writer}")
    return version


def _part(columns: Sequence[str], values: Iterable) -> str:
    return "/".join(f"{column}={value}" for column, value in zip(columns, values))


def _write(
    frame: DataFrame,
    root: str,
    partition_by: Sequence[str],
    drops: Iterable[str],
    base: int | None,
    contents: Contents | None,
) -> int:
    spark = frame.sparkSession
    base = version_of(spark, root) if base is None else base
    _must_be(spark, root, base)
    name = uuid.uuid4().hex
    folder = f"{root}/data/version={name}"
    parts, drops = [""], list(drops)
    if partition_by:
        # Adaptive execution cuts this shuffle into even files, also of a partition that holds most rows.
        frame = frame.hint("rebalance", *partition_by)
    observation = Observation()
    if contents:
        # Behind the last shuffle: a task that is run again there counts once.
        frame = frame.observe(observation, contents.rows().alias("rows"), contents.fingerprint().alias("fingerprint"))
    frame.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(folder)
    if partition_by:
        written = spark.read.schema(frame.schema).parquet(folder).select(*partition_by).distinct()
        parts = sorted(_part(partition_by, row) for row in written.collect())
    elif not drops and spark.read.schema(frame.schema).parquet(folder).isEmpty():
        parts = []
    entries = [(True, part) for part in drops] + [(False, part) for part in parts]
    if contents and parts:
        seen = observation.get
        _note(spark, [(name, repr(contents), seen["rows"], seen["fingerprint"])], _OBSERVED, f"{root}/observed/entry={name}")
    return _list_next(spark, root, base, name, entries) if entries else base


def publish(
    frame: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    base: int | None = None,
    contents: Contents | None = None,
) -> int:
    """Write a table whole, in place of all earlier versions.

    This and its siblings return the version now in force. ``base`` is the version
    that ``frame`` was made from, by default the newest one at the time of the call; if
    another has been published since, they raise ``PublicationClash`` and change nothing.
    ``contents``: what to observe of the rows on their way.
    """
    return _write(frame, root, partition_by, [EVERYTHING], base, contents)


def publish_delta(
    frame: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    base: int | None = None,
    contents: Contents | None = None,
) -> int:
    """Add rows to a table already published."""
    return _write(frame, root, partition_by, [], base, contents)


def publish_parts(
    frame: DataFrame,
    root: str,
    partition_by: Sequence[str],
    parts: Iterable[Sequence],
    base: int | None = None,
    contents: Contents | None = None,
) -> int:
    """Write the partitions with the given values anew; the others stay as they are."""
    return _write(frame, root, partition_by, [_part(partition_by, values) for values in parts], base, contents)


def _live(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """``folder, part`` of what is in force."""
    live: list[tuple[str, str]] = []
    for _, folder, drops, part in _entries(spark, root):
        if drops:
            live = [] if part == EVERYTHING else [(f, p) for f, p in live if p != part]
        else:
            live.append((folder, part))
    if not live:
        raise FileNotFoundError(f"nothing published under {root}")
    return live


def _read(spark: SparkSession, root: str, live: list[tuple[str, str]]) -> DataFrame:
    base = f"{root}/data"
    paths = [f"{base}/version={f}/{p}".rstrip("/") for f, p in live]
    return spark.read.option("basePath", base).parquet(*paths).drop("version")


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The table as last published, in one scan."""
    return _read(spark, root, _live(spark, root))


def _order_of(part: str) -> list:
    values = [level.partition("=")[2] for level in part.split("/")]
    return [(v.lstrip("-").isdigit(), int(v) if v.lstrip("-").isdigit() else 0, v) for v in values]


def read_newest(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the greatest partition in force, known from the list alone; a table without partitions as a whole."""
    live = _live(spark, root)
    newest = max((part for _, part in live), key=_order_of)
    return _read(spark, root, [(f, p) for f, p in live if p == newest])


def published_contents(spark: SparkSession, root: str, contents: Contents) -> tuple[int, int]:
    """Rows and fingerprint of what is in force, from what its writers observed.

    Read are only folders of which some parts are out of force, and those written without this observation.
    """
    seen = {r.folder: r for r in _listed(spark, f"{root}/observed", _OBSERVED) if r.contents == repr(contents)}
    listed: dict[str, set[str]] = {}
    for _, folder, drops, part in _entries(spark, root):
        if not drops:
            listed.setdefault(folder, set()).add(part)
    live: dict[str, set[str]] = {}
    for folder, part in _live(spark, root):
        live.setdefault(folder, set()).add(part)
    whole = [folder for folder, parts in live.items() if folder in seen and parts == listed[folder]]
    rows, fingerprint = sum(seen[f].rows for f in whole), sum(int(seen[f].fingerprint) for f in whole)
    unknown = [(folder, part) for folder in sorted(live.keys() - set(whole)) for part in sorted(live[folder])]
    if unknown:
        counted = _read(spark, root, unknown).agg(contents.rows(), contents.fingerprint()).first()
        rows, fingerprint = rows + counted[0], fingerprint + int(counted[1])
    return rows, fingerprint


def compact(
    spark: SparkSession, root: str, partition_by: Sequence[str] = (), contents: Contents | None = None
) -> int:
    """Write the table as it is now whole, so that later reads open one folder instead of one per delta."""
    base = version_of(spark, root)
    return publish(read_published(spark, root), root, partition_by, base, contents)


def side_by_side(spark: SparkSession, actions: list[Callable[[], int]]) -> list[int]:
    """Run independent writes together, so that small ones do not leave executors idle; what they return."""
    run = inheritable_thread_target(spark)(lambda action: action())
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        return list(pool.map(run, actions))
