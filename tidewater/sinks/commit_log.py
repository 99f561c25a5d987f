"""Streaming sink with a commit log: batches appear whole or not at all, files stay few (SK3, SK4, ST4, ST10).

Folder layout under one root::

    log/slot=NN          snapshots: for each table the folders that are live at one version
    <table>/run=l0-NN    rows of one micro-batch, partitioned by ``event_date``
    <table>/run=lK-NN    compacted runs of ``FAN`` folders of level K - 1
    <table>/bucket=B/side=S   buckets of an upsert table

``commit`` stages the rows of every table of a batch and then writes one snapshot, which
is what makes them visible, all tables at once. A batch that dies before that leaves only
staged files which its replay overwrites; a batch that is replayed after it is left out.
Readers take the folders of the highest snapshot.

Compaction is levelled: ``FAN`` folders of a level become one sorted folder of the next, so
a row is rewritten once a level and the number of folders grows with the logarithm of the
batches; folders of the top level are full size and stay. Folder names are reused in turn,
``2 * FAN`` a level, and Spark's overwrite removes what a name held before, which has not
been live for at least ``FAN`` batches. Snapshots are reused the same way.

An upsert table is dealt into buckets by a hash of its key. Only buckets that a batch
touches are rewritten, each into the other of its two sides, and the snapshot names the
side that is current; a replay reads the same old sides again.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FAN = 8
TOP_LEVEL = 4
LOG_SLOTS = 64
BUCKETS = 64
# ``commit`` holds one row a snapshot even when no table has a folder
SNAPSHOT = "version long, batch_id long, table string, level int, number long, folder string, shape string"


@dataclass(frozen=True)
class Append:
    """Rows of a batch for a table that only grows, sorted by ``sort`` when compacted."""
    rows: DataFrame
    sort: tuple[str, ...] = ()
    date: str = "event_date"


@dataclass(frozen=True)
class Upsert:
    """New rows for a table of one row a ``key``; ``merge(old, new)`` gives its rows."""
    rows: DataFrame
    key: str
    merge: Callable[[DataFrame, DataFrame], DataFrame]


@dataclass(frozen=True)
class Folder:
    table: str
    level: int
    number: int  # which folder of its level, or the bucket of an upsert table (level -1)
    folder: str
    shape: str  # the rows' schema as JSON


@dataclass(frozen=True)
class Snapshot:
    version: int
    batch_id: int
    folders: tuple[Folder, ...]

    def of(self, table: str) -> list[Folder]:
        return [f for f in self.folders if f.table == table]


def latest(spark: SparkSession, root: str) -> Snapshot:
    """The highest snapshot; version and batch -1 before the first commit.

    A snapshot is a handful of rows for each table, so the driver reads them.
    """
    try:
        log = spark.read.schema(SNAPSHOT).parquet(f"{root}/log")
    except AnalysisException:
        return Snapshot(-1, -1, ())
    top = log.agg(F.max("version").alias("v")).first()["v"]
    if top is None:
        return Snapshot(-1, -1, ())
    rows = log.where(F.col("version") == top).collect()
    return Snapshot(top, rows[0]["batch_id"], tuple(
        Folder(r["table"], r["level"], r["number"], r["folder"], r["shape"]) for r in rows if r["table"]))


def _publish(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    rows = [(snapshot.version, snapshot.batch_id, f.table, f.level, f.number, f.folder, f.shape)
            for f in snapshot.folders] or [(snapshot.version, snapshot.batch_id, None, None, None, None, None)]
    (spark.createDataFrame(rows, SNAPSHOT).coalesce(1).write.mode("overwrite")
     .parquet(f"{root}/log/slot={snapshot.version % LOG_SLOTS:02d}"))


def read(spark: SparkSession, root: str, table: str, snapshot: Snapshot | None = None) -> DataFrame | None:
    """The committed rows of a table; None before its first row."""
    folders = (snapshot or latest(spark, root)).of(table)
    if not folders:
        return None
    return _rows(spark, root, folders)


def _rows(spark: SparkSession, root: str, folders: list[Folder]) -> DataFrame:
    shape = StructType.fromJson(json.loads(folders[0].shape))
    reader = spark.read.schema(shape)
    if folders[0].level >= 0:  # runs are partitions of their table's folder
        reader = reader.option("basePath", f"{root}/{folders[0].table}")
    return reader.parquet(*(f"{root}/{f.folder}" for f in folders)).select(*shape.names)


def _stage(item: Append, root: str, folder: str, compacted: bool) -> None:
    """Few files: a small batch becomes one file a date, a compacted run sorted files of full size."""
    rows = item.rows
    if compacted and item.sort:
        keys = [item.date, *item.sort]
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    else:
        rows = rows.hint("rebalance", F.col(item.date))
    rows.write.mode("overwrite").partitionBy(item.date).parquet(f"{root}/{folder}")


def commit(spark: SparkSession, root: str, batch_id: int,
           tables: dict[str, Append | Upsert | Callable[[dict[str, DataFrame]], Append | Upsert]]) -> bool:
    """Make one micro-batch visible; False if it already is (a replay after its commit).

    Tables are staged in order. One given as a function is made from the batch's rows that
    were staged before it, so what depends on them is not computed a second time.
    """
    now = latest(spark, root)
    if batch_id <= now.batch_id:
        return False
    version = now.version + 1
    folders = list(now.folders)
    staged: dict[str, DataFrame] = {}
    for name, item in tables.items():
        item = item if isinstance(item, Append | Upsert) else item(staged)
        if isinstance(item, Upsert):
            folders = _upsert(spark, root, now, folders, name, item)
            continue
        number = max(((f.number + 1) * FAN ** f.level for f in now.of(name)), default=0)
        spot = Folder(name, 0, number, f"{name}/run=l0-{number % (2 * FAN):02d}", item.rows.schema.json())
        _stage(item, root, spot.folder, compacted=False)
        staged[name] = _rows(spark, root, [spot])
        folders.append(spot)
        folders = _compact(spark, root, folders, name, item)
    _publish(spark, root, Snapshot(version, batch_id, tuple(folders)))
    return True


def _compact(spark: SparkSession, root: str, folders: list[Folder], name: str, item: Append) -> list[Folder]:
    """Merge the folders of each full level into one of the next."""
    for level in range(TOP_LEVEL):
        full = [f for f in folders if f.table == name and f.level == level]
        if len(full) < FAN:
            break
        number = max(f.number for f in full) // FAN
        turn = number if level + 1 == TOP_LEVEL else number % (2 * FAN)
        spot = f"{name}/run=l{level + 1}-{turn:02d}"
        _stage(Append(_rows(spark, root, full), item.sort, item.date), root, spot, compacted=True)
        folders = [f for f in folders if f not in full] + [Folder(name, level + 1, number, spot, full[0].shape)]
    return folders


def bucket_of(key: str) -> F.Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int")


def _upsert(spark: SparkSession, root: str, now: Snapshot, folders: list[Folder], name: str,
            item: Upsert) -> list[Folder]:
    held = {f.number: f for f in now.of(name)}
    new = item.rows.withColumn("bucket", bucket_of(item.key))
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # at most BUCKETS
    if not touched:
        return folders
    old = [held[b] for b in touched if b in held]
    rows = item.merge(_rows(spark, root, old), item.rows) if old else item.rows
    side = {b: 1 - int(held[b].folder[-1]) if b in held else 0 for b in touched}
    turn = F.create_map(*[F.lit(x) for pair in side.items() for x in pair])
    (rows.withColumn("bucket", bucket_of(item.key)).withColumn("side", turn[F.col("bucket")])
     .repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket", "side").parquet(f"{root}/{name}"))
    kept = [f for f in folders if f.table != name or f.number not in side]
    return kept + [Folder(name, -1, b, f"{name}/bucket={b}/side={s}", item.rows.schema.json()) for b, s in side.items()]
