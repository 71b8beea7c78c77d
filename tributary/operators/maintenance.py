"""Upkeep of stored tables: compaction, snapshots, retention, statistics."""

from __future__ import annotations

import datetime
import json
import math
import re
import time
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions.files import Files


def _leaves(files: Files) -> dict[str, list[tuple[str, int]]]:
    """Data files by the folder that they lie in: a folder's files are of one partition."""
    out: dict[str, list[tuple[str, int]]] = defaultdict(list)
    for path, size in files.data():
        out[path.rsplit("/", 1)[0]].append((path, size))
    return out


def recover(spark: SparkSession, path: str) -> int:
    """Ends what a compaction that was stopped had begun: its journal says what was to come and to go. Returns how many there were."""
    files, n = Files(spark, path), 0
    folders, todo = [], [""]
    while todo:
        at = todo.pop()
        for name, is_folder, _ in files.names(at):
            full = f"{at}/{name}".strip("/")
            if is_folder and not name.startswith((".", "_")):
                todo.append(full)
            elif name.startswith(".compact-"):
                folders.append((full, is_folder))
    for journal in [f for f, is_folder in folders if not is_folder and f.endswith(".json")]:
        _finish(files, journal)
        n += 1
    for rest in [f for f, is_folder in folders if is_folder or not f.endswith(".json")]:
        files.delete(rest)  # of a compaction that had not come to its journal, or has been ended
    return n


def _finish(files: Files, journal: str) -> None:
    said = json.loads(files.read(journal))
    for beside, to in said["new"]:
        if files.exists(beside):
            files.move(beside, to)
    for old in said["old"]:
        files.delete(old)
    files.delete(said["beside"])
    files.delete(journal)


def compact(spark: SparkSession, path: str, small_bytes: int = 10 << 20, target_bytes: int = 128 << 20, dry_run: bool = False) -> dict:
    """Packs the small files of each folder under a path into ones of the target size, within that folder; large ones stay as they are.

    For plain folders of Parquet files, partitioned or not; tables of a Store are packed by Store.compact(). New files are
    written to a hidden folder and a journal tells what is to be moved in and deleted, so that a compaction that is stopped
    anywhere loses nothing and recover() (which this begins with) ends it. A reader may see rows twice for a moment but never miss one.
    """
    files = Files(spark, path)
    if files.exists("_log"):
        raise ValueError(f"{path} is a store: use Store.compact()")
    if not dry_run:
        recover(spark, path)
    groups = {leaf: own for leaf, all_ in _leaves(files).items() if len(own := [f for f in all_ if f[1] < small_bytes]) > max(1, math.ceil(sum(n for _, n in own) / target_bytes))}
    out = {"small_files": sum(map(len, groups.values())), "small_bytes": sum(n for own in groups.values() for _, n in own), "folders": len(groups), "written": 0}
    for leaf, own in groups.items() if not dry_run else []:
        name = f"{leaf}/.compact-{uuid.uuid4().hex}"
        spark.read.parquet(*[f for f, _ in own]).repartition(max(1, math.ceil(sum(n for _, n in own) / target_bytes))).write.parquet(name)
        fresh = [f"{name}/{n}" for n, _, _ in files.names(name) if n.endswith(".parquet")]
        journal = {"beside": name, "new": [(f, f"{leaf}/compact-{uuid.uuid4().hex}.parquet") for f in fresh], "old": [f for f, _ in own]}
        files.write_new(f"{name}.json", json.dumps(journal))
        _finish(files, f"{name}.json")
        out["written"] += len(fresh)
    return out


def expired_partitions(rows: DataFrame, date: str, as_of: datetime.date, days: int) -> DataFrame:
    """Partitions (values of a date column) whose last day is out of retention, with their row counts."""
    g = rows.groupBy(F.col(date).alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
    return g.where(F.col("partition") < F.date_sub(F.lit(as_of), days))


def purge(spark: SparkSession, path: str, column: str, as_of: datetime.date, days: int, dry_run: bool = False) -> list[str]:
    """Drops partition folders column=YYYY-MM-DD, at any depth under a path, that are out of retention; other files are not read or rewritten. Returns their paths under it."""
    files = Files(spark, path)
    limit, gone, todo = as_of - datetime.timedelta(days=days), [], [""]
    while todo:
        at = todo.pop()
        for name, is_folder, _ in files.names(at):
            full = f"{at}/{name}".strip("/")
            if not is_folder or name.startswith((".", "_")):
                continue
            if not name.startswith(f"{column}="):
                todo.append(full)
            elif re.fullmatch(r"\d{4}-\d{2}-\d{2}", value := name.split("=", 1)[1]) and datetime.date.fromisoformat(value) < limit:
                gone.append(full)
                if not dry_run:
                    files.delete(full)
    return sorted(gone)


def beyond_newest(rows: DataFrame, group: str, created: str, keep: int, cutoff: datetime.datetime) -> DataFrame:
    """Rows to delete: not among the newest `keep` of their group and made before the cutoff. Of rows made at the same time the least by their other columns are the newest.

    The newest of each group are found first, in a limited window that each task applies before the shuffle, so a group of any size is not gathered.
    """
    others = [c for c in rows.columns if c not in (group, created)]
    w = Window.partitionBy(group).orderBy(F.col(created).desc(), *others)
    newest = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep)
    last = newest.where(F.col("_rn") == keep).select(F.col(group).alias("_group"), F.struct(F.col(created), *others).alias("_last"))  # a row per group that has so many
    beyond = (F.col(created) < F.col("_last")[created]) | (F.col(created) == F.col("_last")[created]) & (F.struct(*others) > F.struct(*[F.col("_last")[c] for c in others])) if others else F.col(created) < F.col("_last")[created]
    return rows.where(F.col(created) < F.lit(cutoff)).join(last, F.col(group).eqNullSafe(F.col("_group"))).where(beyond).select(*rows.columns)


def savepoints(paths: DataFrame, prefix: str) -> DataFrame:
    """Inventory (path, job_id, created_at) of savepoint folders <prefix>/<job>/<YYYY-MM-DD_HH-MM>."""
    pattern = rf"^{prefix}/([^/]+)/(\d{{4}}-\d{{2}}-\d{{2}}_\d{{2}}-\d{{2}})/?$"
    found = paths.where(F.col("path").rlike(pattern))
    return found.select("path", F.regexp_extract("path", pattern, 1).alias("job_id"), F.to_timestamp(F.regexp_extract("path", pattern, 2), "yyyy-MM-dd_HH-mm").alias("created_at"))


def table_stats(spark: SparkSession, path: str) -> dict:
    """Rows, files, bytes, and warnings for an empty table or one of too many files. Rows come from file footers."""
    own = Files(spark, path).data()
    rows = spark.read.parquet(path).count() if own else 0
    warn = ["table is empty"] * (rows == 0) + ["over 1000 files"] * (len(own) > 1000)
    return {"rows": rows, "files": len(own), "bytes": sum(n for _, n in own), "warnings": warn}


class Savepoints:
    """Copies of a stopped query's checkpoint under <prefix>/<job>/<YYYY-MM-DD_HH-MM>: made, polled, rotated.

    A trigger begins a copy on a thread and returns its id; poll() says how it stands. A copy is whole only once it has its
    mark, and rotation counts whole ones alone.
    """

    MARK = "_SAVEPOINT"

    def __init__(self, spark: SparkSession, prefix: str) -> None:
        self.spark, self.files = spark, Files(spark, prefix)
        self._pool, self._tasks = ThreadPoolExecutor(2), {}

    def trigger(self, job: str, checkpoint: str, now: datetime.datetime | None = None) -> str:
        """Begins a copy of the checkpoint folder; returns the copy's path under the prefix. The query should be between batches or stopped."""
        name = f"{job}/{(now or datetime.datetime.now(datetime.UTC)):%Y-%m-%d_%H-%M}"
        if name in self._tasks and not self._tasks[name].done() or self.files.exists(f"{name}/{self.MARK}"):
            raise ValueError(f"{name} is there already")
        self._tasks[name] = self._pool.submit(self._copy, checkpoint, name)
        return name

    def _copy(self, checkpoint: str, name: str) -> str:
        hadoop, conf = self.spark.sparkContext._jvm.org.apache.hadoop, self.spark.sparkContext._jsc.hadoopConfiguration()
        src, to = hadoop.fs.Path(checkpoint), self.files.path(name)
        self.files.delete(name)  # of a trigger that failed
        fs = to.getFileSystem(conf)
        fs.mkdirs(to.getParent())
        if not hadoop.fs.FileUtil.copy(src.getFileSystem(conf), src, fs, to, False, conf):
            raise OSError(f"cannot copy {checkpoint}")
        self.files.write(f"{name}/{self.MARK}", json.dumps({"checkpoint": checkpoint}))
        return name

    def poll(self, name: str) -> str:
        """IN_PROGRESS, COMPLETED, FAILED or UNKNOWN."""
        task = self._tasks.get(name)
        if task is not None and not task.done():
            return "IN_PROGRESS"
        if self.files.exists(f"{name}/{self.MARK}"):
            return "COMPLETED"
        return "FAILED" if task is not None else "UNKNOWN"

    def wait(self, name: str, seconds: float = 300, every: float = 0.1) -> str:
        """Polls until the copy has ended; FAILED also if that takes longer."""
        end = time.monotonic() + seconds
        while (said := self.poll(name)) == "IN_PROGRESS":
            if time.monotonic() > end:
                return "FAILED"
            time.sleep(every)
        return said

    def inventory(self) -> list[tuple[str, str, datetime.datetime]]:
        """(path, job, made) of the whole ones, oldest first."""
        out = []
        for job, is_folder, _ in self.files.names():
            for made, _, _ in self.files.names(job) if is_folder else []:
                if re.fullmatch(r"\d{4}-\d{2}-\d{2}_\d{2}-\d{2}", made) and self.files.exists(f"{job}/{made}/{self.MARK}"):
                    out.append((f"{job}/{made}", job, datetime.datetime.strptime(made, "%Y-%m-%d_%H-%M")))
        return sorted(out, key=lambda x: (x[2], x[0]))

    def rotate(self, now: datetime.datetime, days: float = 7, keep: int = 2, dry_run: bool = False) -> list[str]:
        """Deletes savepoints older than so many days, but for each job's newest `keep`."""
        by_job = defaultdict(list)
        for path, job, made in self.inventory():
            by_job[job].append((path, made))
        old = [path for own in by_job.values() for path, made in (own[:-keep] if keep else own) if made < now - datetime.timedelta(days=days)]
        for path in old if not dry_run else []:
            self.files.delete(path)
        return sorted(old)


class SnapshotTable:
    """One table as versions: a write makes a new one, readers keep theirs."""

    TABLE = "rows"

    def __init__(self, spark: SparkSession, path: str) -> None:
        from tributary.streaming.store import Store

        self.store = Store(spark, path)

    def snapshots(self) -> list[int]:
        return self.store.versions()

    def commit(self, df: DataFrame) -> int:
        """df in the place of all rows."""
        old = [e["path"] for e in self.store.state()["tables"].get(self.TABLE, [])]
        return self.store.replace(df, self.TABLE, old)

    def read(self, snapshot: int | None = None) -> DataFrame:
        return self.store.read(self.TABLE, snapshot)

    def upsert(self, rows: DataFrame, key: tuple[str, ...] = ("event_id",)) -> int:
        from tributary.operators.dedup import upsert

        return self.commit(upsert(self.read(), rows, key) if self.snapshots() else rows.dropDuplicates(list(key)))

    def expire(self, days: float = 7, keep: int = 1, now: float | None = None, dry_run: bool = False) -> dict:
        """Deletes snapshots older than so many days, but for the newest `keep`."""
        return self.store.expire(now, days, keep, dry_run)

    def stats(self, now: float | None = None) -> dict:
        return self.store.stats(self.TABLE, now)
