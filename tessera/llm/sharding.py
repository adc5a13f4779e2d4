"""Sharding by size-tiered compaction.

Arrivals are appended as small immutable Parquet shards, one a task, without a shuffle. A
compaction sorts the live shards into tiers of similar size, packs those of a tier into runs of
up to the target size, and rewrites every run of at least `fan_in` shards, or of the whole target,
as one file. A run is read and written by one task, so nothing is shuffled; runs are done in
waves, so a plan has a bounded size. Each append and compaction commits a new manifest version
by renaming a finished file onto a name that must not exist: readers see the old shards or
the new ones, never both, and of two writers one fails and can retry. That rests on a file system whose rename onto an
existing name fails as one step, as HDFS and local disks have; a plain object store needs a committer that has.

A writer names its data folder in an intent file before it writes and removes that after its commit. `vacuum` lists the
data folders first, then the intents, then the manifests, so it never takes files of an append or a compaction
that is under way; intents older than `stale_hours` are of writers that died.

Defined cases: an empty arrival commits a version without new shards; null values, texts of any
length and repeated rows are stored as they are; a shard over the target stays alone; any
columns are allowed, the first arrival's names and types bind later ones; `read` adds the shard's file only on demand, under a
name that must be free.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name

TARGET_BYTES = 128 << 20
FAN_IN = 4
#: Sizes of one tier differ by less than this factor.
TIER = 4.0
ARRIVAL_ROWS = 2000
#: Runs merged by one Spark job.
WAVE = 128
#: Shards up to which their table may be broadcast, at some 200 bytes each.
BROADCAST_SHARDS = 50_000


class Conflict(RuntimeError):
    """Another writer committed this version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN):
        self.spark, self.root, self.target, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.conf)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/v{version:012d}.json"

    def version(self) -> int:
        """The newest committed version; 0 before the first."""
        fs, folder = self._fs(), self._path(f"{self.root}/manifest")
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max([0, *(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))])

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "schema": None, "shards": []}
        stream = self._fs().open(self._path(self._manifest(version)))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, base: int, schema: str | None, shards: list[dict]) -> int:
        """Version base + 1 with these shards; Conflict if it exists already."""
        fs = self._fs()
        fs.mkdirs(self._path(f"{self.root}/manifest"))
        draft = self._path(f"{self.root}/manifest/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(json.dumps({"version": base + 1, "schema": schema, "shards": shards}).encode())
        out.close()
        try:
            final = self._path(self._manifest(base + 1))
            if fs.exists(final):
                raise Conflict(f"version {base + 1} exists")
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.conf)
            options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(draft, final, options)
        except Exception as failed:
            fs.delete(draft, False)
            thrown = getattr(failed, "java_exception", None)
            if thrown is not None and thrown.getClass().getSimpleName() == "FileAlreadyExistsException":
                raise Conflict(f"version {base + 1} exists") from failed
            raise
        return base + 1

    @contextmanager
    def _writing(self):
        """A new data folder, named in an intent until the writer is done."""
        name = uuid.uuid4().hex
        fs, intent = self._fs(), self._path(f"{self.root}/intent/{name}")
        fs.mkdirs(self._path(f"{self.root}/intent"))
        fs.create(intent, False).close()
        try:
            yield f"{self.root}/data/{name}"
        finally:
            fs.delete(intent, False)

    def _written(self, folder: str) -> list[tuple[int, str, int]]:
        """(task, path, bytes) of the files that Spark wrote to the folder, in order."""
        found = []
        for status in self._fs().listStatus(self._path(folder)):
            name = status.getPath().getName()
            if name.startswith("part-"):
                found.append((int(name.split("-")[1]), f"{folder}/{name}", int(status.getLen())))
        return sorted(found)

    def _rows(self, paths: list[str], schema: T.StructType) -> dict[str, int]:
        if not paths:
            return {}
        table = self.spark.read.schema(schema).parquet(*paths)
        return {r[0]: r[1] for r in table.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).count().collect()}

    def append(self, arrivals: DataFrame, rows: int = ARRIVAL_ROWS) -> int:
        """The arrivals as new shards of at most `rows` rows each; the new version."""
        now = self.manifest()
        schema = now["schema"] or arrivals.schema.json()
        wanted = T.StructType.fromJson(json.loads(schema))
        if [(f.name, f.dataType) for f in wanted] != [(f.name, f.dataType) for f in arrivals.schema]:
            raise ValueError("arrivals must have the columns of the store")
        with self._writing() as folder:
            arrivals.write.option("maxRecordsPerFile", rows).option("compression", "snappy").parquet(folder)
            files = self._written(folder)
            counts = self._rows([folder], wanted) if files else {}
            fresh = [{"path": p, "bytes": b, "rows": counts.get(p.rsplit("/", 1)[1], 0), "tier": self.tier(b), "made": now["version"] + 1, "of": 1} for _, p, b in files]
            return self.commit(now["version"], schema, now["shards"] + [s for s in fresh if s["rows"]])

    def tier(self, size: int) -> int:
        """0 at the target size and above, 1 for up to a TIER-th of it, and so on."""
        return 0 if size >= self.target else 1 + int(math.log(self.target / max(1, size), TIER))

    def runs(self, shards: list[dict]) -> list[list[dict]]:
        """Of each tier the runs to merge: shards in the order of their making, filled to the target."""
        found = []
        for tier in sorted({s["tier"] for s in shards} - {0}, reverse=True):
            run, size = [], 0
            for shard in (s for s in shards if s["tier"] == tier):
                if run and size + shard["bytes"] > self.target * 1.1:
                    found.append(run)
                    run, size = [], 0
                run.append(shard)
                size += shard["bytes"]
            if len(run) >= self.fan_in:
                found.append(run)
        return [run for run in found if len(run) > 1]

    def compact(self) -> int:
        """Merges until no tier has a run; every round commits a version. Returns the newest."""
        while True:
            now = self.manifest()
            runs = self.runs(now["shards"])
            if not runs:
                return now["version"]
            schema = T.StructType.fromJson(json.loads(now["schema"]))
            made = []
            with ExitStack() as writers:
                for at in range(0, len(runs), WAVE):
                    made += self._merge(runs[at : at + WAVE], schema, now["version"] + 1, writers.enter_context(self._writing()))
                gone = {s["path"] for run in runs for s in run}
                self.commit(now["version"], now["schema"], [s for s in now["shards"] if s["path"] not in gone] + made)

    def _merge(self, runs: list[list[dict]], schema: T.StructType, version: int, folder: str) -> list[dict]:
        parts = [self.spark.read.schema(schema).parquet(*(s["path"] for s in run)).coalesce(1) for run in runs]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        # A union of one-task parts must stay one task a part.
        setting = "spark.sql.unionOutputPartitioning"
        before = self.spark.conf.get(setting, None)
        self.spark.conf.set(setting, "false")
        try:
            whole.write.option("compression", "snappy").parquet(folder)
        finally:
            self.spark.conf.unset(setting) if before is None else self.spark.conf.set(setting, before)
        files = self._written(folder)
        if [task for task, _, _ in files] != list(range(len(runs))):
            raise RuntimeError("a run did not become one file")
        return [{"path": p, "bytes": b, "rows": sum(s["rows"] for s in run), "tier": self.tier(b), "made": version, "of": sum(s["of"] for s in run)} for run, (_, p, b) in zip(runs, files, strict=True)]

    def read(self, version: int | None = None, file_col: str | None = None) -> DataFrame | None:
        """The rows of a version, with the name of the shard's file in column `file_col` if given; None if it has no shards."""
        now = self.manifest(version)
        if not now["shards"]:
            return None
        table = self.spark.read.schema(T.StructType.fromJson(json.loads(now["schema"]))).parquet(*(s["path"] for s in now["shards"]))
        if file_col is None:
            return table
        if free_name(file_col, table.columns) != file_col:
            raise ValueError(f"the store has a column {file_col}")
        return table.withColumn(file_col, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))

    def vacuum(self, keep: int = 1, stale_hours: float = 168) -> int:
        """Deletes the files that none of the newest `keep` versions names and no writer is at, and older manifests; how many files went.

        A reader of an older version must be done: raise `keep` where readers stay behind.
        """
        fs, gone = self._fs(), 0
        if not fs.exists(self._path(f"{self.root}/data")):
            return 0
        folders = [f.getPath() for f in fs.listStatus(self._path(f"{self.root}/data"))]
        busy = set()
        if fs.exists(self._path(f"{self.root}/intent")):
            oldest = (time.time() - stale_hours * 3600) * 1000
            busy = {i.getPath().getName() for i in fs.listStatus(self._path(f"{self.root}/intent")) if i.getModificationTime() >= oldest}
        last = self.version()
        live = {s["path"].rsplit("/", 1)[1] for v in range(max(1, last - keep + 1), last + 1) for s in self.manifest(v)["shards"]}
        folder = self._path(f"{self.root}/manifest")
        old = [n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.startswith("v") and int(n[1:-5]) <= last - keep] if last else []
        for name in old:
            fs.delete(self._path(f"{self.root}/manifest/{name}"), False)
        for path in folders:
            if path.getName() in busy:
                continue
            files = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName().startswith("part-")]
            dead = [p for p in files if p.getName() not in live]
            for p in dead:
                fs.delete(p, False)
            gone += len(dead)
            if len(dead) == len(files):
                fs.delete(path, True)
        return gone

    def shards(self, version: int | None = None) -> DataFrame:
        """The manifest as a table: shard, shard_file, shard_rows, shard_bytes, merged_from; marked for broadcast where it is small."""
        rows = [(i, s["path"].rsplit("/", 1)[1], s["rows"], s["bytes"], s["of"]) for i, s in enumerate(self.manifest(version)["shards"])]
        table = self.spark.createDataFrame(rows, "shard int, shard_file string, shard_rows bigint, shard_bytes bigint, merged_from int")
        return F.broadcast(table) if len(rows) <= BROADCAST_SHARDS else table
