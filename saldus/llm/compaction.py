"""Sharding by size-tiered compaction, in DataFrame operations alone.

A store is a folder of immutable shard files and a manifest in versions. Arrivals are appended as small shards. Compaction looks at the
shards of the newest manifest by size: a tier holds shards of similar size (within a factor `fanout`); a tier with at least `fanout` shards is
merged into files of the target size, in runs that a task writes by itself, without a shuffle.

A version is a table of what it adds to the version before and what it takes from it; every `Setup.whole` versions the shards named so far are also
written whole, so a reader joins few tables. A version is written aside and renamed into place; a rename that finds the version taken
fails, so readers see whole versions only. A writer that was too late tries the next version: an arrival always can, a merge can while all that it merged is
still named, else it raises Conflict. `vacuum` keeps the newest versions, the shards that any of them names, and whatever is younger than an age, so that it takes nothing
from readers or from writers that haven't committed yet.

The manifest is read and written as a table. The driver handles at most `Setup.merge_shards` names of shards in a merge, and counts by tier; it
lists the files of one arrival or one version only as Spark does when it reads them. Rows never reach it.

Defined cases: appending an empty table makes a version without new shards; reading a store without shards gives no rows; nulls, empty and very long texts,
repeated rows and any columns are kept as they are; a row larger than the target makes a larger file. The columns of a store are those of its first arrival.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldus.llm import scratch

MANIFEST = "shard string, bytes long, tier int, live boolean"


@dataclass(frozen=True)
class Setup:
    arrival_rows: int = 2000  # of an arriving shard, at most
    target_bytes: int = 128 << 20
    fanout: int = 4
    merge_shards: int = 4096  # of one merge; further ones follow it
    whole: int = 16  # versions from one whole manifest to the next


class Conflict(Exception):
    """Another writer committed the version first."""


class Store:
    def __init__(self, spark: SparkSession, path: str, setup: Setup = Setup()):
        self.spark, self.path, self.setup = spark, path.rstrip("/"), setup
        self._at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def tier(self, size: Column) -> Column:
        """0 for the target size and above; each tier below is smaller by the fanout."""
        below = F.log(float(self.setup.fanout), F.lit(float(self.setup.target_bytes)) / F.greatest(size, F.lit(1)))
        return F.greatest(F.ceil(below - 0.5).cast("int"), F.lit(0))

    def _versions(self, kind: str = "v") -> list[int]:
        """The versions in the manifest's folder, or those that are there whole ("w")."""
        folder = self._at(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return []
        names = (x.getPath().getName() for x in self._fs.listStatus(folder))
        return sorted(int(x[1:]) for x in names if x.startswith(kind))

    def _named(self, kind: str, version: int) -> str:
        return f"{self.path}/manifest/{kind}{version:08d}"

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return max(self._versions(), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """shard, bytes and tier of the shards that a version names, the newest if none is given."""
        version = self.version() if version is None else version
        start = max((w for w in self._versions("w") if w <= version), default=0)
        paths = [self._named("w", start)] * (start > 0) + [self._named("v", v) for v in range(start + 1, version + 1)]
        rows = self.spark.read.schema(MANIFEST).parquet(*paths) if paths else self.spark.createDataFrame([], MANIFEST)
        # A name is given once and taken back at most once.
        last = rows.groupBy("shard").agg(F.max("bytes").alias("bytes"), F.max("tier").alias("tier"), F.bool_and("live").alias("live"))
        return last.where("live").drop("live")

    def _aside(self, rows: DataFrame) -> str:
        path = f"{self.path}/aside/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return path

    def _place(self, aside: str, to: str) -> bool:
        """Renames a folder into a place that nobody has taken."""
        self._fs.mkdirs(self._at(f"{self.path}/manifest"))
        if self._fs.exists(self._at(to)) or not self._fs.rename(self._at(aside), self._at(to)):
            return False
        inside = self._at(f"{to}/{aside.rpartition('/')[2]}")
        if self._fs.exists(inside):  # some stores move into a folder that appeared meanwhile
            self._fs.rename(inside, self._at(aside))
            return False
        return True

    def _commit(self, aside: str, base: int) -> int:
        """Makes a change that was written aside the version after base."""
        if not self._place(aside, self._named("v", base + 1)):
            raise Conflict(f"version {base + 1} is taken")
        if (base + 1) % self.setup.whole == 0:
            self._whole(base + 1)
        return base + 1

    def _whole(self, version: int) -> None:
        """Writes the shards that a version names as one table; another writer's is the same."""
        aside = self._aside(self.manifest(version).withColumn("live", F.lit(True)))
        if not self._place(aside, self._named("w", version)):
            self._fs.delete(self._at(aside), True)

    def _write(self, df: DataFrame, rows: int = 0) -> str:
        """Writes shards of df into a folder of their own; its name."""
        run = uuid.uuid4().hex
        df.write.options(**{"maxRecordsPerFile": rows, "mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}).parquet(f"{self.path}/data/{run}")
        return run

    def _files(self, path: str) -> DataFrame:
        """shard, bytes and time of the shard files under a path, none of which is opened."""
        files = self.spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", recursiveFileLookup="true").load(path)
        return files.select(F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("shard"), F.col("length").alias("bytes"), F.col("modificationTime").alias("time"))

    def _added(self, run: str) -> DataFrame:
        """The manifest's rows of a folder of new shards."""
        path = f"{self.path}/data/{run}"
        files = self._files(path)
        if self.spark.read.schema(self._schema()).parquet(path).isEmpty():
            files = files.limit(0)
        return files.select("shard", "bytes", self.tier(F.col("bytes")).alias("tier"), F.lit(True).alias("live"))

    def _schema(self):
        return self.spark.read.parquet(f"{self.path}/schema").schema

    def append(self, df: DataFrame) -> int:
        """Adds the rows of df as small shards; the new version."""
        if not self.version():
            df.limit(0).coalesce(1).write.mode("ignore").parquet(f"{self.path}/schema")
        aside = self._aside(self._added(self._write(df, self.setup.arrival_rows)))
        while True:
            try:
                return self._commit(aside, self.version())
            except Conflict:
                continue  # whoever was first, the arrival is as good in the next version

    def compact(self) -> int:
        """Merges full tiers, the smallest shards first, until none is full; the newest version."""
        while True:
            base = self.version()
            state = self.manifest(base)
            tiers = [r["tier"] for r in state.where("tier > 0").groupBy("tier").count().where(F.col("count") >= self.setup.fanout).collect()]
            if not tiers:
                return base
            own = state.where(F.col("tier") == max(tiers)).orderBy("shard").limit(self.setup.merge_shards)
            self._merge([(r["shard"], r["bytes"]) for r in own.collect()])

    def _merge(self, shards: list[tuple[str, int]]) -> int:
        """Puts files of the target size in the place of shards; the new version."""
        into = max(1, round(sum(size for _, size in shards) / self.setup.target_bytes))
        added = self._added(self._write(self.read(shards=[name for name, _ in shards]).coalesce(into)))
        gone = self.spark.createDataFrame([(name, None, None, False) for name, _ in shards], MANIFEST)
        aside = self._aside(added.union(gone))
        while True:
            base = self.version()
            if not gone.join(self.manifest(base), "shard", "left_anti").isEmpty():
                raise Conflict("another writer merged some of these shards")
            try:
                return self._commit(aside, base)
            except Conflict:
                continue  # an arrival came in between, or another merge: look again

    def read(self, version: int | None = None, shards: list[str] | None = None) -> DataFrame:
        """The rows of a version, the newest if none is given, or those of some shards."""
        if shards is None:
            shards = [r["shard"] for r in self.manifest(version).select("shard").toLocalIterator()]
        if not shards:
            return self.spark.read.parquet(f"{self.path}/schema")  # a table without rows
        return self.spark.read.schema(self._schema()).parquet(*(f"{self.path}/data/{x}" for x in shards))

    def vacuum(self, versions: int = 10, hours: float = 24.0) -> None:
        """Removes versions before the newest ones, and what no version that stays names and is older than so many hours."""
        newest = self.version()
        if not newest:
            return
        first = max(1, newest - versions + 1, min(self._versions()))
        if first not in self._versions("w"):
            self._whole(first)
        kept = self.spark.read.schema(MANIFEST).parquet(self._named("w", first), *(self._named("v", v) for v in range(first + 1, newest + 1)))
        old = F.col("time") <= F.current_timestamp() - F.make_dt_interval(secs=F.lit(hours * 3600))
        dead = self._files(f"{self.path}/data").where(old).join(kept.select("shard").distinct(), "shard", "left_anti")
        runs = set()
        for r in dead.select("shard").toLocalIterator():
            self._fs.delete(self._at(f"{self.path}/data/{r['shard']}"), False)
            runs.add(r["shard"].partition("/")[0])
        for run in runs:
            folder = self._at(f"{self.path}/data/{run}")
            if not self._fs.listStatus(folder):
                self._fs.delete(folder, True)
        for kind in "vw":
            for v in self._versions(kind):
                if v < first:
                    self._fs.delete(self._at(self._named(kind, v)), True)


def compacted(docs: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """doc_id, text's length and hash, and the shard, tier and version in which each row of docs stands after arrival and compaction."""
    spark = docs.sparkSession
    store = Store(spark, scratch.folder(spark, "shards"), setup)
    store.append(docs)
    version = store.compact()
    store.vacuum(versions=1, hours=0)  # the store is this query's own
    name = F.concat_ws("/", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2), F.col("_metadata.file_name"))
    rows = store.read(version).select("doc_id", F.length("text").cast("long").alias("n_chars"), F.xxhash64("text").alias("text_hash"), name.alias("shard"))
    return rows.join(store.manifest(version), "shard").withColumn("version", F.lit(version).cast("long"))
