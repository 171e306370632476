"""Stores of customer records: find all, find one, upsert a batch whole or not at all."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldus.operators.lookup import dedup_last
from saldus.schema import EVENT, SCHEMA
from saldus.sources.exports import file_rows, in_file_order
from saldus.sources.storage import Storage

METHODS = ("find_all", "find_by_code", "save_batch")


class StaleBase(RuntimeError):
    """Another writer has saved since the base was read."""

    def __init__(self, read: int, now: int):
        super().__init__(f"the base was read at version {read} and is at {now}: sync again")


class Queue:
    """A lock that is given in the order in which it was asked for; a failure under it passes it on."""

    def __init__(self):
        self._turns: deque[threading.Event] = deque()
        self._guard = threading.Lock()

    def __enter__(self) -> Queue:
        turn = threading.Event()
        with self._guard:
            self._turns.append(turn)
            if len(self._turns) == 1:
                turn.set()
        turn.wait()
        return self

    def __exit__(self, *_: object) -> None:
        with self._guard:
            self._turns.popleft()
            if self._turns:
                self._turns[0].set()


class Tickets:
    """A lock between processes, given in the order in which it was asked for: a numbered file in the repository's folder, made by one atomic create.

    Whoever has the lowest number is next. A ticket is a lease: its holder renews it, and one that hasn't been renewed for `lease` seconds (its process has died) is removed by
    those who wait. A process that comes back after that has lost its turn, not the data: its save meets the check of versions.
    """

    def __init__(self, storage: Storage, lease: float = 60.0, pause: float = 0.1):
        self._storage, self._lease, self._pause = storage, lease, pause
        self._inside = Queue()
        self._own = ""

    def __enter__(self) -> Tickets:
        self._inside.__enter__()
        try:
            while True:
                taken = [int(x) for x in self._storage.names("tickets") if x.isdigit()]
                self._own = f"tickets/{max(taken, default=0) + 1:012d}"
                if self._storage.create(self._own, uuid.uuid4().hex):
                    break
            self._held = threading.Event()
            threading.Thread(target=self._renew, args=(self._own, self._held), daemon=True).start()
            while True:
                now = time.time()
                before = {f"tickets/{x}": t for x, t in self._storage.stats("tickets").items() if x.isdigit() and f"tickets/{x}" < self._own}
                for name in [x for x, t in before.items() if now - t > self._lease]:
                    self._storage.delete(name)
                    del before[name]
                if not before:
                    return self
                time.sleep(self._pause)
        except BaseException:
            self._release()
            raise

    def _renew(self, own: str, held: threading.Event) -> None:
        while not held.wait(self._lease / 4):
            self._storage.touch(own)

    def _release(self) -> None:
        if getattr(self, "_held", None):
            self._held.set()
        if self._own:
            self._storage.delete(self._own)
            self._own = ""
        self._inside.__exit__()

    def __exit__(self, *_: object) -> None:
        self._release()


@runtime_checkable
class Repository(Protocol):
    lock: Queue | Tickets

    def find_all(self) -> DataFrame: ...

    def find_by_code(self, code: object) -> Row | None: ...

    def save_batch(self, records: DataFrame, read: int | None = None) -> None: ...

    def version(self) -> int: ...


def check_contract(repository: object) -> None:
    missing = [m for m in METHODS if not callable(getattr(repository, m, None))]
    if missing:
        raise TypeError("repositorio incompleto, faltam: " + ", ".join(missing))


def upserted(base: DataFrame, batch: DataFrame) -> DataFrame:
    """base with the batch's records in place of those of equal codes, and its new ones at the end; rows without a code are skipped.

    One shuffle by code: both sides are tagged, united and grouped, where the batch's last row wins over the base's.
    """
    fields = [f for f in base.columns if f != "_ord"]
    side = lambda df, of: df.where(F.col("nex_codigo").isNotNull()).select("nex_codigo", F.struct(F.lit(of).alias("side"), F.col("_ord").cast("long").alias("pos")).alias("at"), F.struct(*fields).alias("row"))
    both = side(base, 0).unionByName(side(batch, 1))
    one = both.groupBy("nex_codigo").agg(F.max_by("row", "at").alias("row"), F.min("at").alias("at"))
    return one.select(F.col("at").alias("_at"), "row.*")


class _Faults:
    """A failure for the next save, used up by it: for tests of what calls a repository."""

    _fault: Exception | None = None

    def fail_next_save(self, error: Exception | None = None) -> None:
        self._fault = error or RuntimeError("falha simulada")

    def _raise_fault(self) -> None:
        fault, self._fault = self._fault, None
        if fault:
            raise fault


class MemoryRepository(_Faults):
    """Records in a DataFrame held by the object, for tests and bases that fit the driver; each save makes a new one."""

    def __init__(self, spark: SparkSession, records: DataFrame | None = None):
        self.lock, self._version = Queue(), 0
        empty = spark.createDataFrame([], SCHEMA).withColumn("_ord", F.lit(0).cast("bigint"))
        self._now = empty if records is None else _ordered(dedup_last(records).withColumn("_at", F.struct(F.lit(0).alias("side"), F.col("_pos").alias("pos"))).drop("_ord", "_pos"), 0)

    def find_all(self) -> DataFrame:
        return self._now

    def find_by_code(self, code: object) -> Row | None:
        return self._now.where(F.col("nex_codigo") == str(code)).first()

    def version(self) -> int:
        return self._version

    def save_batch(self, records: DataFrame, read: int | None = None) -> None:
        self._raise_fault()
        if read is not None and read != self._version:
            raise StaleBase(read, self._version)
        # Rows are small in number here; materialised, so that a chain of saves doesn't grow a plan.
        after = _ordered(upserted(self._now, _numbered(records)), self._version + 1)
        self._now = after.sparkSession.createDataFrame(after.collect(), after.schema)
        self._version += 1


#: The record as a bucket holds it: without its history, but with the version from which on the log's events are its own; null where the record has none (not even an empty one).
STORED = T.StructType([f for f in SCHEMA if f.name != "historico"] + [T.StructField("_ord", T.LongType()), T.StructField("_since", T.LongType())])
#: An event of a record: version that wrote it, and its place among those of that version.
LOGGED = T.StructType([T.StructField("nex_codigo", T.StringType()), T.StructField("version", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("event", EVENT)])
#: Log files of a bucket from which on its next save merges them into one.
MERGE_LOGS = 16


class ParquetRepository(_Faults):
    """Records in hash buckets that are written anew only when one of their records changes.

    A version is a small file that names, for each bucket, the folder that holds its records and those that hold its part of the log of events. A save reads and rewrites
    the buckets that its batch touches, writes them and the new events aside, and makes the next version's file by one atomic create: readers see the old version or the new one, and of two
    writers one is told so. A version's file grows with the number of buckets alone, which is fixed when a repository is made: about as many as files of a
    hundred megabytes would hold the base.

    A record's history is kept as events in the log, and put together when records are read with it, so a record doesn't grow with its syncs.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256, lease: float = 60.0):
        self.spark, self.storage = spark, Storage(spark, path)
        self.path, self._buckets = self.storage.path, buckets
        self.lock = Tickets(self.storage, lease)

    # Versions

    def version(self) -> int:
        return max((int(x) for x in self.storage.names("versions") if x.isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """{"buckets": how many, "data": {bucket: run}, "log": {bucket: [run, ...]}} of a version."""
        n = self.version() if version is None else version
        if not n:
            return {"buckets": self._buckets, "data": {}, "log": {}}
        text = self.storage.read(f"versions/{n:012d}")
        if text is None:
            raise LookupError(f"version {n} has expired")
        return json.loads(text)

    @contextmanager
    def snapshot(self, hours: float = 24.0) -> Iterator[Snapshot]:
        """The newest version, kept from expiry while it is read, and for so many hours at most."""
        while True:
            n = self.version()
            pin = f"pins/{n:012d}-{int(time.time() + hours * 3600)}-{uuid.uuid4().hex}"
            self.storage.create(pin, "")
            # Expiry takes a version's name away before it looks for pins a last time: if the name is still there, the pin was seen.
            if not n or self.storage.exists(f"versions/{n:012d}"):
                break
            self.storage.delete(pin)
        try:
            yield Snapshot(self, n)
        finally:
            self.storage.delete(pin)

    def _pinned(self) -> set[int]:
        now = time.time()
        return {int(n) for n, until, _ in (x.split("-") for x in self.storage.names("pins") if x.count("-") == 2) if float(until) > now}

    def expire(self, keep: int = 10, hours: float = 24.0) -> int:
        """Removes the versions before the newest `keep` that no reader has pinned, and the folders of data and log that no version names and that are older than so many hours (a writer may be about to name a younger one); how many versions went."""
        versions = [int(x) for x in self.storage.names("versions") if x.isdigit()]
        gone = 0
        for n in versions[: max(0, len(versions) - max(1, keep))]:
            name = f"versions/{n:012d}"
            if n in self._pinned() or not self.storage.rename(name, f"versions/expiring-{n:012d}"):
                continue
            if n in self._pinned():  # pinned just before its name went
                self.storage.rename(f"versions/expiring-{n:012d}", name)
            else:
                gone += 1
        named = {kind: set() for kind in ("data", "log")}
        for x in self.storage.names("versions"):
            if x.isdigit():
                m = self.manifest(int(x))
                named["data"] |= {f"run={run}/bucket={k}" for k, run in m["data"].items()}
                named["log"] |= {f"run={run}/bucket={k}" for k, runs in m["log"].items() for run in runs}
        for x in self.storage.names("versions"):
            if x.startswith("expiring-"):
                self.storage.delete(f"versions/{x}")
        old = time.time() - hours * 3600
        for kind, kept in named.items():
            for run, written in self.storage.stats(kind).items():
                if written > old:
                    continue
                inside = [x for x in self.storage.names(f"{kind}/{run}") if x.startswith("bucket=")]
                dead = [x for x in inside if f"{run}/{x}" not in kept]
                if len(dead) == len(inside):
                    self.storage.delete(f"{kind}/{run}")
                else:
                    for x in dead:
                        self.storage.delete(f"{kind}/{run}/{x}")
        for run, written in self.storage.stats("aside").items():  # of writers that died
            if written <= old:
                self.storage.delete(f"aside/{run}")
        return gone

    # Reading

    def _read(self, kind: str, schema: T.StructType, folders: list[str]) -> DataFrame:
        """Rows of bucket folders (run=.../bucket=...), with their bucket."""
        whole = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], whole)
        at = self.storage.at(kind)
        # No folder but those named is listed or opened.
        return self.spark.read.schema(whole).option("basePath", at).parquet(*(f"{at}/{x}" for x in folders)).drop("run")

    def _stored(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        return self._read("data", STORED, [f"run={run}/bucket={k}" for k, run in manifest["data"].items() if buckets is None or int(k) in buckets])

    def _logged(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        return self._read("log", LOGGED, [f"run={run}/bucket={k}" for k, runs in manifest["log"].items() if buckets is None or int(k) in buckets for run in runs])

    def _records(self, manifest: dict, buckets: list[int] | None, history: bool) -> DataFrame:
        rows = self._stored(manifest, buckets)
        if history:
            events = self._logged(manifest, buckets).select("bucket", "nex_codigo", F.struct("version", "place", "event").alias("e"))
            lists = events.groupBy("bucket", "nex_codigo").agg(F.array_sort(F.collect_list("e")).alias("_events"))
            rows = rows.join(lists, ["bucket", "nex_codigo"], "left")
            own = F.transform(F.filter(F.coalesce("_events", F.array().cast(lists.schema["_events"].dataType)), lambda e: e["version"] >= F.col("_since")), lambda e: e["event"])
            rows = rows.withColumn("historico", F.when(F.col("_since").isNotNull(), own))
        else:
            rows = rows.withColumn("historico", F.when(F.col("_since").isNotNull(), F.array().cast(SCHEMA["historico"].dataType)))
        return rows.select(*SCHEMA.names, "_ord")

    def find_all(self, history: bool = True, version: int | None = None) -> DataFrame:
        """All records; history: with their events, else with an empty array (which costs no join)."""
        return self._records(self.manifest(version), None, history)

    def bucket_of(self, code: Column, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(code), F.lit(buckets or self._buckets)).cast("int")

    def lookup(self, code: object, version: int | None = None) -> DataFrame:
        """The record of a code, if there is one: its bucket alone is opened, and in it the row groups whose codes reach over it."""
        manifest = self.manifest(version)
        # A constant: worked out on the driver by the expression that dealt the records.
        bucket = self.spark.range(1).select(self.bucket_of(F.lit(str(code)), manifest["buckets"])).first()[0]
        return self._records(manifest, [bucket], True).where(F.col("nex_codigo") == str(code))

    def find_by_code(self, code: object) -> Row | None:
        return self.lookup(code).first()

    def events(self, version: int | None = None) -> DataFrame:
        """nex_codigo, version, place and the fields of each event of the log."""
        return self._logged(self.manifest(version)).select("nex_codigo", "version", "place", "event.*")

    # Writing

    def save_batch(self, records: DataFrame, read: int | None = None) -> None:
        """Puts records in place of those of equal codes, whole, with the history that they bring.

        read: the version that the records were made from; a later one by then is another writer's, whose changes this save would undo.
        """
        self._save(records, read, replaces=True)

    def save_changes(self, records: DataFrame, read: int | None = None) -> None:
        """As save_batch, of records made from this base, with _ord, whose `historico` holds only what has happened now: it goes behind what the log has of them."""
        if records.schema["_ord"].dataType.typeName() == "struct":  # of a plan: what is in the base has its place there
            records = records.withColumn("_ord", F.when(F.col("_ord.side") == 1, F.col("_ord.pos")).otherwise(0))
        self._save(records, read, replaces=False)

    def _save(self, records: DataFrame, read: int | None, replaces: bool) -> None:
        self._raise_fault()
        n = self.version()
        if read is not None and read != n:
            raise StaleBase(read, n)
        manifest, run = self.manifest(n), uuid.uuid4().hex
        aside, version = self.storage.at(f"aside/{run}"), n + 1
        bucket = self.bucket_of(F.col("nex_codigo"), manifest["buckets"])
        try:
            # The batch is written aside first: what made it runs once, and the folders say which buckets it touches.
            rows = _numbered(records).where(F.col("nex_codigo").isNotNull()).select(*SCHEMA.names, "_ord", bucket.alias("bucket"))
            rows.write.partitionBy("bucket").parquet(f"{aside}/rows")
            touched = self._buckets_in(f"aside/{run}/rows")
            logged: list[int] = []
            if touched:
                batch = self.spark.read.schema(rows.schema).parquet(f"{aside}/rows")
                if batch.agg(F.max("_ord")).first()[0] >= PLACES:
                    batch = renumbered(batch, f"{aside}/places")
                merged = self._merged(manifest, touched, batch, version, replaces)
                merged.sortWithinPartitions("bucket", "nex_codigo").write.partitionBy("bucket").parquet(self.storage.at(f"data/run={run}"))
                logged = self._append(manifest, batch, run, version)
            log = {k: list(v) for k, v in manifest["log"].items()}
            for k in map(str, logged):
                log[k] = [run] if len(log.get(k, [])) >= MERGE_LOGS else [*log.get(k, []), run]
            after = {"buckets": manifest["buckets"], "data": manifest["data"] | {str(k): run for k in touched}, "log": log}
            if not self.storage.create(f"versions/{version:012d}", json.dumps(after)):
                raise StaleBase(n, self.version())
        finally:
            self.storage.delete(f"aside/{run}")

    def _buckets_in(self, folder: str) -> list[int]:
        return [int(x.removeprefix("bucket=")) for x in self.storage.names(folder) if x.startswith("bucket=")]

    def _merged(self, manifest: dict, touched: list[int], batch: DataFrame, version: int, replaces: bool) -> DataFrame:
        """The touched buckets' rows with the batch's records in place. Equal codes are in one bucket, so one exchange by bucket serves the grouping and the files."""
        since = F.when(F.col("historico").isNotNull(), F.lit(version).cast("long")).alias("_since")
        fields = [f for f in STORED.names if f not in ("_ord", "_since", "nex_codigo")]
        side = lambda df, of, since: df.select("bucket", "nex_codigo", F.struct(F.lit(of).alias("side"), F.col("_ord").alias("pos")).alias("at"), since, F.struct(*fields).alias("row"))
        both = side(self._stored(manifest, touched), 0, F.col("_since")).unionByName(side(batch, 1, since)).repartition("bucket")
        merged = both.groupBy("bucket", "nex_codigo").agg(F.max_by("row", "at").alias("row"), F.min("at").alias("_at"), F.max_by("_since", "at").alias("_since"), F.max(F.when(F.col("at.side") == 0, F.col("_since"))).alias("_before"))
        if not replaces:  # a record that was there keeps the version from which its events count
            merged = merged.withColumn("_since", F.coalesce("_before", "_since"))
        return _ordered(merged.select("bucket", "nex_codigo", "_at", "_since", "row.*"), version).select(*STORED.names, "bucket")

    def _append(self, manifest: dict, batch: DataFrame, run: str, version: int) -> list[int]:
        """Writes the batch's events, with those before of buckets whose log has come to many files; the buckets that have events."""
        last = batch.groupBy("bucket", "nex_codigo").agg(F.max_by("historico", "_ord").alias("historico"))
        events = last.select("bucket", "nex_codigo", F.lit(version).cast("long").alias("version"), F.posexplode("historico").alias("place", "event"))
        many = [int(k) for k, runs in manifest["log"].items() if len(runs) >= MERGE_LOGS]
        many = sorted(set(many) & set(self._buckets_in(f"aside/{run}/rows")))
        if many:
            since = self._read("data", STORED, [f"run={run}/bucket={k}" for k in many]).select("bucket", "nex_codigo", "_since")
            before = self._logged(manifest, many).join(since, ["bucket", "nex_codigo"]).where(F.col("version") >= F.col("_since"))
            events = events.unionByName(before.select("bucket", *LOGGED.names))
        events.select(*LOGGED.names, "bucket").repartition("bucket").sortWithinPartitions("bucket", "nex_codigo", "version", "place").write.partitionBy("bucket").parquet(self.storage.at(f"log/run={run}"))
        return self._buckets_in(f"log/run={run}")


class Snapshot:
    """A version of a repository, as a reader sees it."""

    def __init__(self, repository: ParquetRepository, version: int):
        self._repository, self.version = repository, version

    def find_all(self, history: bool = True) -> DataFrame:
        return self._repository.find_all(history, self.version)

    def find_by_code(self, code: object) -> Row | None:
        return self._repository.lookup(code, self.version).first()


#: Places of a batch's rows are below it: a new record's _ord is the version that it came with, times it, and its place.
PLACES = 1 << 43


def _numbered(records: DataFrame) -> DataFrame:
    """_ord as a number; of an applied plan's rows, whose order is (side, place), the place: rows that are in the base have theirs already."""
    if "_ord" not in records.columns:
        return records.withColumn("_ord", F.monotonically_increasing_id())
    if records.schema["_ord"].dataType.typeName() == "struct":
        return records.withColumn("_ord", F.col("_ord.pos").cast("long"))
    return records.withColumn("_ord", F.col("_ord").cast("long"))


def renumbered(rows: DataFrame, path: str) -> DataFrame:
    """rows with the numbers from 0 on in order of _ord, by way of a sorted table at path: for places that are too large to stand beside a version."""
    rows.repartitionByRange("_ord").sortWithinPartitions("_ord").write.parquet(path)
    return in_file_order(rows.sparkSession.read.schema(rows.schema).parquet(path).drop("_ord").select("*", *file_rows())).select(*rows.columns)


def _ordered(rows: DataFrame, version: int) -> DataFrame:
    """_ord from _at: records of the base keep theirs, new ones stand after all of earlier versions."""
    pos = F.col("_at.pos")
    fits = F.when((pos >= 0) & (pos < PLACES), pos + version * PLACES).otherwise(F.raise_error(F.concat(F.lit("no place of a row: "), pos.cast("string"))).cast("long"))
    return rows.withColumn("_ord", F.when(F.col("_at.side") == 0, pos).otherwise(fits)).drop("_at")
