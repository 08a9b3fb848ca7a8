"""Publication to a table directory: immutable objects, monotonic pointers, receipts, in commits that are whole or not there.

A commit's files are staged where no reader looks, read back, and moved to a folder of the commit's own. It counts from
the moment that its marker is in the log: the marker of version n + 1 names version n as its parent, and only one
writer can create it. Who comes second looks at what has changed and tries again on top of it. A commit that failed
leaves files that no marker names; tidy() removes them.

Every CHECKPOINT_EVERY versions a checkpoint gathers the log, the newest pointers, the receipts and an index of the
objects in tables of their own. A reader takes the newest checkpoint and the few commits after it, so that what it reads
doesn't grow with the number of past commits. A version that a checkpoint or the log still holds can be read as it was.
"""

from __future__ import annotations

import gzip
import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gustloom.functions.columns import compact_stamp, dated_path
from gustloom.operators.gate import has_work
from gustloom.operators.timeline import last_wins

OBJECTS, POINTERS, RECEIPTS, OUTCOMES = "objects", "pointers", "receipts", "outcomes"
OBJECT = "path string, sha256 string, source_sha256 string, content binary, commit string, kind string, day date"
POINTER = "kind string, path string, sha256 string, generated_at timestamp, commit string"
RECEIPT = "kind string, path string, sha256 string, source_sha256 string, generated_at timestamp, verified_at timestamp, ready boolean, commit string"
OUTCOME = "kind string, path string, outcome string, commit string"
#: Attempts to be the next version, and the seconds before another one; the last counts for all that follow.
ATTEMPTS, DELAYS = 8, (1, 2, 4, 8, 12, 16, 20, 30)
INDEX = "path string, sha256 string, source_sha256 string, commit string, kind string, day date"
COMMIT = "version long, commit string, query string, batch long"
#: Versions between checkpoints.
CHECKPOINT_EVERY = 20


class Conflict(RuntimeError):
    """An immutable path holds other bytes, or a receipt of it names others."""


class Damaged(RuntimeError):
    """The stored bytes of an object aren't those that were recorded."""


class Store:
    """The files of a publication root, on any file system that the session knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.jvm = spark, root.rstrip("/"), spark._jvm
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def listed(self, folder: str) -> list[tuple[str, int]]:
        """Names and times (milliseconds) of what is in a folder, without what is hidden."""
        path = self.path(folder)
        if not self.fs.exists(path):
            return []
        return [(n, int(f.getModificationTime())) for f in self.fs.listStatus(path) if not (n := str(f.getPath().getName())).startswith(("_", "."))]

    def markers(self, folder: str) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n, _ in self.listed(folder) if n.endswith(".json"))

    def marked(self, name: str) -> dict:
        """What a marker says."""
        file = self.fs.open(self.path(name))
        try:
            return json.loads(str(self.jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")))
        finally:
            file.close()

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return max([0, *self.markers("log")[-1:], *self.markers("checkpoints")[-1:]])

    def base(self, version: int | None = None) -> tuple[int, str | None]:
        """The newest checkpoint, of those up to a version, and its folder; (0, None) if there is none."""
        found = [v for v in self.markers("checkpoints") if version is None or v <= version]
        return (found[-1], self.marked(f"checkpoints/{found[-1]:020d}.json")["folder"]) if found else (0, None)

    def commits(self, after: int, version: int | None = None) -> list[dict]:
        """The markers after a version, oldest first: few, if the version is a checkpoint's."""
        return [self.marked(f"log/{v:020d}.json") for v in self.markers("log") if v > after and (version is None or v <= version)]

    def create(self, marker: str, facts: dict) -> bool:
        """Create a marker; False if there is one. It appears with all of its bytes at once."""
        folder, _, name = marker.rpartition("/")
        staged, target = self.path(f"{folder}/_{uuid.uuid4().hex}-{name}"), self.path(marker)
        out = self.fs.create(staged, True)
        out.write(bytearray(json.dumps(facts).encode() + b"\n"))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(staged.toUri() if staged.toUri().getScheme() else self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(context.makeQualified(staged), context.makeQualified(target), none)  # never over a marker that is there
        except Exception as error:
            self.fs.delete(staged, False)
            if self.fs.exists(target):
                return False
            raise error
        return True

    def claim(self, version: int, commit: str, source: tuple[str, int] | None = None) -> bool:
        """Create the marker of a version; False if another writer has, or had before its marker was tidied away."""
        query, batch = source or (None, None)
        if self.base()[0] >= version or not self.create(f"log/{version:020d}.json", {"version": version, "parent": version - 1, "commit": commit, "query": query, "batch": batch}):
            return False
        if self.base()[0] >= version:  # a checkpoint has overtaken a writer that slept for long
            self.fs.delete(self.path(f"log/{version:020d}.json"), False)
            return False
        return True

    def move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise RuntimeError(f"could not move {source} to {target}")

    def table(self, name: str, schema: str, version: int | None = None, folder: str | None = None) -> DataFrame:
        """The rows of a table that commits up to a version brought in, with the ``version`` that did.

        ``folder``: its name in a checkpoint; without one, all commits count by themselves.
        """
        base, place = self.base(version) if folder else (0, None)
        if version is not None and not {*range(base + 1, version + 1)} <= {*self.markers("log")}:
            raise ValueError(f"version {version} is no longer there, or not yet")
        full = f"{schema}, version long"
        out = self.spark.read.schema(full).parquet(f"{self.root}/{place}/{folder}") if place else self.spark.createDataFrame([], full)
        later = [c for c in self.commits(base, version) if self.fs.exists(self.path(f"{name}/commit={c['commit']}"))]
        if not later:
            return out
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*(f"{self.root}/{name}/commit={c['commit']}" for c in later))
        known = self.spark.createDataFrame([(c["commit"], c["version"]) for c in later], "commit string, version long")
        return out.unionByName(rows.join(F.broadcast(known), "commit").select(out.columns))  # as many rows as there are commits after the checkpoint

    def log(self, version: int | None = None) -> DataFrame:
        """All commits up to a version."""
        base, place = self.base(version)
        later = [(c["version"], c["commit"], c.get("query"), c.get("batch")) for c in self.commits(base, version)]
        rows = self.spark.createDataFrame(later, COMMIT)
        return rows.unionByName(self.spark.read.schema(COMMIT).parquet(f"{self.root}/{place}/commits")) if place else rows

    def done(self, source: tuple[str, int]) -> str | None:
        """The commit of a query's batch, if it has been made: the newest of that query, or one before it."""
        found = self.log().where((F.col("query") == source[0]) & (F.col("batch") == source[1])).first()
        return found["commit"] if found else None


def pointers(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current pointer of each kind, or that of a version: the newest; of those with one time the one that came last. An absent one gives no row."""
    return _newest(Store(spark, root).table(POINTERS, POINTER, version, POINTERS)).drop("version")


def _newest(rows: DataFrame) -> DataFrame:
    """Few rows: the pointers of a checkpoint and of the commits after it."""
    return rows.groupBy("kind").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "kind")), F.struct("generated_at", "version")).alias("x")).select("kind", "x.*").select(rows.columns)


def receipts(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    return Store(spark, root).table(RECEIPTS, RECEIPT, version, RECEIPTS).drop("version")


def index(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Committed objects without their content."""
    return Store(spark, root).table(OBJECTS, INDEX, version, "index").drop("version")


def objects(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Committed objects; their content is gzip."""
    store = Store(spark, root)
    if not store.version() or not store.fs.exists(store.path(OBJECTS)):
        return spark.createDataFrame([], OBJECT)
    seen = store.log(version).select("commit")
    return spark.read.schema(OBJECT).parquet(f"{store.root}/{OBJECTS}").join(seen, "commit", "left_semi")


def checkpoint(spark: SparkSession, root: str) -> int:
    """Gather the newest version in tables of its own, if there is none of it yet; the version."""
    store = Store(spark, root)
    version = store.version()
    if not version or store.base()[0] == version:
        return version
    folder = f"checkpointed/{version}-{uuid.uuid4().hex}"
    at = lambda name: f"{store.root}/{folder}/{name}"
    _newest(store.table(POINTERS, POINTER, version, POINTERS)).write.parquet(at(POINTERS))
    store.table(RECEIPTS, RECEIPT, version, RECEIPTS).write.parquet(at(RECEIPTS))
    # By kind and day, so that the footers of files tell a writer which ones its own days are in.
    store.table(OBJECTS, INDEX, version, "index").repartitionByRange("kind", "day").sortWithinPartitions("kind", "day").write.parquet(at("index"))
    store.log(version).write.parquet(at("commits"))
    if not store.create(f"checkpoints/{version:020d}.json", {"version": version, "folder": folder}):
        store.fs.delete(store.path(folder), True)
    return version


def tidy(spark: SparkSession, root: str, now_ms: int, grace_ms: int) -> list[str]:
    """Remove what no reader needs and no writer may still be at work on: what is older than the grace time and

    belongs to a commit that isn't in the log; is staged; is in the newest checkpoint (markers, and the pointers, receipts and
    outcomes of single commits); or is an older checkpoint. Versions before the newest checkpoint can't be read from then on.
    Objects of commits stay. What was removed, by name.
    """
    store, gone = Store(spark, root), []
    old = lambda folder: [n for n, t in store.listed(folder) if t < now_ms - grace_ms]
    live = store.log().select("commit", "version")
    base, place = store.base()
    if place and f"{base:020d}.json" not in old("checkpoints"):
        base, place = 0, None  # readers may still be at the versions before it
    for name in (OBJECTS, RECEIPTS, POINTERS, OUTCOMES):
        given = [(n.removeprefix("commit="),) for n in old(name) if n.startswith("commit=")]
        known = spark.createDataFrame(given, "commit string").join(live, "commit", "left")
        dead = known.where(F.col("version").isNull() | ((F.col("version") <= base) & F.lit(name != OBJECTS)))
        gone += [f"{name}/commit={r['commit']}" for r in dead.select("commit").collect()]
    gone += [f"staging/{n}" for n in old("staging")]
    if place:
        gone += [f"log/{v:020d}.json" for v in store.markers("log") if v <= base and f"{v:020d}.json" in set(old("log"))]
        gone += [f"checkpoints/{v:020d}.json" for v in store.markers("checkpoints") if v < base]
        gone += [f"checkpointed/{n}" for n in old("checkpointed") if int(n.partition("-")[0]) < base or int(n.partition("-")[0]) == base and f"checkpointed/{n}" != place]
    for name in gone:
        store.fs.delete(store.path(name), True)
    return gone


def packed(rows: DataFrame, content: str = "content") -> DataFrame:
    """``content`` as gzip whose bytes depend on nothing but the content, with ``source_sha256`` of what was packed."""
    kept = [f for f in rows.schema.fields if f.name != content]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(content)
            data = pa.array([None if x is None else gzip.compress(x, 9, mtime=0) for x in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(f.name)) for f in kept), data], [*(f.name for f in kept), content])

    source = rows.withColumn("source_sha256", F.sha2(content, 256))
    kept = [f for f in source.schema.fields if f.name != content]
    return source.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{content}` binary")


def place(rows: DataFrame) -> DataFrame:
    """(kind, generated_at, content, ready) with the path, hashes and day that an object gets; its content is packed."""
    out = packed(rows.select("kind", "generated_at", "content", "ready"))
    return out.withColumns({"path": dated_path("payloads", "kind", "generated_at", ".json.gz"), "sha256": F.sha2("content", 256), "day": F.to_date("generated_at")})


def publish(spark: SparkSession, root: str, rows: DataFrame, now: Column, ready: Column | None = None, plan: DataFrame | None = None, sleep: Callable[[float], None] = time.sleep, source: tuple[str, int] | None = None) -> DataFrame:
    """Commit new objects with their receipts and pointers. Returns (kind, path, outcome): written, same, suppressed_noop.

    Other bytes at a path raise Conflict and nothing is committed, and so does a receipt that names others; an object
    that is there is read again, and Damaged is raised where its bytes aren't the recorded ones. A pointer moves only
    forward, and only to ready objects; one of equal time takes the place of the last. With a ``plan`` of the gate that leaves no work, models aren't transferred. If all objects are there and no
    pointer moves, no version is made.

    ``source``: the name and batch number of a stream. They are in the commit's marker, so that a batch that is run again
    finds its commit, wherever the run before it ended.
    """
    store, commit = Store(spark, root), uuid.uuid4().hex
    if source and (made := store.done(source)):
        return _outcomes(store, made)
    given = rows.withColumn("ready", F.lit(True) if ready is None else ready)
    idle = plan is not None and not has_work(plan).first()[0]
    suppressed = given.where("kind = 'models'") if idle else given.limit(0)
    stage = f"staging/{commit}"
    at = lambda name: f"{store.root}/{stage}/{name}"
    place(given.where("kind <> 'models'") if idle else given).dropDuplicates(["path", "sha256"]).write.parquet(at("given"))
    placed = spark.read.parquet(at("given"))
    if placed.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        raise Conflict("two contents for one immutable path")
    try:
        for attempt in range(ATTEMPTS):
            parent = store.version()
            if _stage(store, placed, at, now, parent, suppressed):
                for name in (OBJECTS, RECEIPTS, POINTERS, OUTCOMES):
                    if not store.fs.exists(store.path(f"{name}/commit={commit}")):
                        store.move(f"{stage}/{name}", f"{name}/commit={commit}")
                if store.claim(parent + 1, commit, source):
                    out = _outcomes(store, commit)
                    if parent + 1 - store.base()[0] >= CHECKPOINT_EVERY:
                        checkpoint(spark, root)
                    return out
                for name in (OBJECTS, RECEIPTS, POINTERS, OUTCOMES):
                    store.fs.delete(store.path(f"{name}/commit={commit}"), True)
            else:
                return spark.createDataFrame(spark.read.parquet(at(OUTCOMES)).toArrow())  # nothing new: a row for each object of this run
            if attempt < ATTEMPTS - 1:
                sleep(DELAYS[min(attempt, len(DELAYS) - 1)])
        raise RuntimeError(f"another writer was first {ATTEMPTS} times")
    finally:
        store.fs.delete(store.path(stage), True)


def publish_stream(stream: DataFrame, root: str, name: str, checkpoint: str, now: Column, ready: Column | None = None) -> StreamingQuery:
    """Publish all that a stream of (kind, generated_at, content) has brought, a commit a batch and each batch once.

    The stream's checkpoint is written after the commit. If a run ends between the two, the next one is given the batch
    again, and finds it in the log.
    """

    def write(batch: DataFrame, number: int) -> None:
        publish(batch.sparkSession, root, batch, now, ready, source=(name, number))

    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()


def _outcomes(store: Store, commit: str) -> DataFrame:
    """The outcomes of a commit; none, if they have been tidied away."""
    if not store.fs.exists(store.path(f"{OUTCOMES}/commit={commit}")):
        return store.spark.createDataFrame([], OUTCOME).drop("commit")
    return store.spark.read.schema(OUTCOME).parquet(f"{store.root}/{OUTCOMES}/commit={commit}").drop("commit")


def _stage(store: Store, placed: DataFrame, at: Callable[[str], str], now: Column, parent: int, suppressed: DataFrame) -> bool:
    """Write what this run adds to version ``parent`` and read it back; whether it adds anything."""
    spark = store.spark
    keys = placed.select("kind", "day", "path")
    few = keys.count() < 100_000
    days = F.broadcast(keys.select("kind", "day").distinct()) if few else keys.select("kind", "day").distinct()
    here = store.table(OBJECTS, INDEX, parent, "index").join(days, ["kind", "day"], "left_semi")  # only this run's days
    have = here.select("path", F.col("sha256").alias("have"), F.col("commit").alias("brought_by"))
    state = placed.join(have, "path", "left").select("kind", "day", "path", "sha256", "source_sha256", "content", "generated_at", "ready", "have", "brought_by")
    if bad := state.where("have is not null and have <> sha256").select("path").limit(1).collect():
        raise Conflict(f"immutable path holds other bytes: {bad[0][0]}")
    again = state.where("have is not null").select("path", F.col("sha256").alias("want"), F.col("brought_by").alias("commit"), "kind", "day")
    if not again.isEmpty():
        again = spark.createDataFrame(again.toArrow()) if few else again
        stored = spark.read.schema(OBJECT).parquet(f"{store.root}/{OBJECTS}").join(F.broadcast(again) if few else again, ["commit", "kind", "day", "path"]).select("path", "want", F.sha2("content", 256).alias("read_sha"))
        lost = again.join(stored.select("path", "read_sha"), "path", "left").where("read_sha is null or read_sha <> want").select("path").limit(1).collect()
        if lost:
            raise Damaged(f"stored bytes differ from the recorded hash: {lost[0][0]}")
    new = state.where("have is null")
    new.select("path", "sha256", "source_sha256", "content", "kind", "day").write.mode("overwrite").partitionBy("kind", "day").option("compression", "none").parquet(at(OBJECTS))
    spark.createDataFrame([], "path string, sha256 string, source_sha256 string, content binary").write.mode("append").parquet(at(OBJECTS) + "/kind=none/day=1970-01-01")
    back = spark.read.parquet(at(OBJECTS)).select("path", F.sha2("content", 256).alias("read_sha"))
    fits = new.select("path", "sha256").join(back, "path", "left").agg(F.coalesce(F.bool_and(F.coalesce(F.col("read_sha") == F.col("sha256"), F.lit(False))), F.lit(True))).first()[0]
    if not fits:
        raise RuntimeError("read-back differs from what was written")
    old = store.table(RECEIPTS, RECEIPT, parent, RECEIPTS).select("path", F.lit(True).alias("receipted"), F.col("sha256").alias("receipt_sha"))
    if bad := state.join(old, "path").where("receipt_sha <> sha256").select("path").limit(1).collect():
        raise Conflict(f"a receipt names other bytes: {bad[0][0]}")
    fresh = state.join(old, "path", "left").where("receipted is null").select("kind", "path", "sha256", "source_sha256", "generated_at", now.alias("verified_at"), "ready")
    fresh.write.mode("overwrite").parquet(at(RECEIPTS))
    current = _newest(store.table(POINTERS, POINTER, parent, POINTERS)).select("kind", F.col("generated_at").alias("at"), F.col("path").alias("to"), F.col("sha256").alias("to_sha"))
    ours = last_wins(state.where("ready").select("kind", "path", "sha256", "generated_at"), ["kind"], "generated_at").join(current, "kind", "left")
    moved = ours.where("at is null or generated_at > at or generated_at = at and (path <> to or sha256 <> to_sha)")
    moved.drop("at", "to", "to_sha").write.mode("overwrite").parquet(at(POINTERS))
    outcome = state.select("kind", "path", F.when(F.col("have").isNull(), "written").otherwise("same").alias("outcome"))
    held = suppressed.select("kind", dated_path("payloads", "kind", "generated_at", ".json.gz").alias("path"), F.lit("suppressed_noop").alias("outcome"))
    outcome.unionByName(held).write.mode("overwrite").parquet(at(OUTCOMES))
    return any(not spark.read.parquet(at(name)).isEmpty() for name in (OBJECTS, RECEIPTS, POINTERS))


def preserved(spark: SparkSession, root: str, before: DataFrame) -> DataFrame:
    """Objects of an earlier state (path, sha256) that a later one lost or changed: none, if all is well."""
    return before.join(objects(spark, root).select("path", "sha256"), ["path", "sha256"], "left_anti")


def batch_receipts(reports: DataFrame, found: DataFrame, kinds: tuple[str, ...] = ("wunstorf", "etnw")) -> tuple[DataFrame, DataFrame]:
    """(batches, mismatches). A batch needs every child kind with a receipt that fits its report; its time is the newest child's.

    reports: batch, kind, generated_at, sha256, status, error_count, ready. found: kind, generated_at, sha256 (of the payload that was
    transferred), readback_verified, method_version, and where they are recorded stamp, audit_sha256 (of the payload that was
    audited) and commit_sha. A receipt belongs to a report by kind and time; all else about it is compared.
    """
    extra = {"stamp": "r_stamp", "audit_sha256": "r_audit", "commit_sha": "r_commit"}
    r = found.select(F.col("kind"), F.col("generated_at").alias("r_at"), F.col("sha256").alias("r_sha"), "readback_verified", "method_version", *(F.col(c).alias(a) for c, a in extra.items() if c in found.columns))
    has = lambda c: c in found.columns
    joined = reports.join(r, (reports.kind == r.kind) & (reports.generated_at == r.r_at), "left").drop(r.kind)
    faults = F.filter(F.array(
        F.when(F.col("r_at").isNull(), F.lit("receipt_missing")), F.when(~F.col("r_sha").eqNullSafe(F.col("sha256")) & F.col("r_at").isNotNull() | F.coalesce(F.col("sha256") == "", F.lit(False)), "payload_sha256"),
        *([F.when(~F.col("r_stamp").eqNullSafe(compact_stamp("generated_at")) & F.col("r_at").isNotNull(), "stamp")] if has("stamp") else []),
        *([F.when(~F.col("r_audit").eqNullSafe(F.col("sha256")) & F.col("r_at").isNotNull(), "audit_input_payload_sha256")] if has("audit_sha256") else []),
        *([F.when((F.coalesce("r_commit", F.lit("")) == "") & F.col("r_at").isNotNull(), "verified_data_commit_sha")] if has("commit_sha") else []),
        F.when(~F.coalesce("readback_verified", F.lit(False)), "readback_verified"),
        F.when(F.coalesce(F.col("method_version") != "private-transfer-readback-v2", F.lit(True)), "method_version"), F.when(F.col("error_count") > 0, "error_count"), F.when(~F.coalesce("ready", F.lit(False)), "not_ready"),
    ), lambda x: x.isNotNull())
    checked = joined.withColumn("faults", faults)
    whole = checked.groupBy("batch").agg(F.count_distinct(F.when(F.size("faults") == 0, F.col("kind"))).alias("children"), F.bool_and(F.size("faults") == 0).alias("ok"), F.max("generated_at").alias("generated_at"))
    return whole.where((F.col("children") == len(kinds)) & F.col("ok")).select("batch", "generated_at"), checked.where(F.size("faults") > 0).select("batch", "kind", F.explode("faults").alias("fault"))


def provenance(df: DataFrame, **facts: str) -> DataFrame:
    """Columns that say which invocation made the rows; the caller names the facts."""
    return df.withColumns({k: F.lit(v) for k, v in facts.items()})


def markdown(reports: DataFrame, found: DataFrame) -> DataFrame:
    """(path, markdown): a report's counts and its issues, worst first."""
    order = F.array_position(F.lit(["ERROR", "WARN", "INFO"]), F.col("severity"))
    line = F.concat(F.lit("- **"), "severity", F.lit("** `"), "code", F.lit("` "), "source", F.lit(": "), "details")
    lines = found.groupBy("path").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "source", "code", line.alias("line")))).alias("x"))
    head = F.concat(F.lit("# "), "path", F.lit("\n\nStatus: "), "status", F.lit("\nErrors: "), F.col("error_count").cast("string"), F.lit(", warnings: "), F.col("warning_count").cast("string"), F.lit(", notes: "), F.col("info_count").cast("string"), F.lit("\n\n"))
    return reports.join(lines, "path", "left").select("path", F.concat(head, F.coalesce(F.array_join(F.transform("x", lambda i: i["line"]), "\n"), F.lit("No issues."))).alias("markdown"))


def snapshot(spark: SparkSession, records: DataFrame, out: str, now: Column) -> None:
    """Put a new snapshot of records in place of the last: by lead within each path, with the path's distinct sorted leads and the retrieval time.

    The new one counts from its marker on, so readers see the old or the new one whole, and records may come from the old.
    """
    store, commit = Store(spark, out), uuid.uuid4().hex
    leads = records.groupBy("path").agg(F.array_sort(F.collect_set("lead")).alias("leads_hours"))
    kept = [c for c in records.columns if c not in ("leads_hours", "retrieved_at")]
    whole = records.select(*kept).join(leads, "path").withColumn("retrieved_at", now)
    whole.repartition("path").sortWithinPartitions("path", "lead").write.parquet(f"{store.root}/data/commit={commit}")
    while not store.claim(store.version() + 1, commit):
        pass


def read_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The newest snapshot."""
    store = Store(spark, out)
    with_marker = spark.read.schema("version long, commit string").json(f"{store.root}/log").where(F.col("version") == store.version()).first()
    return spark.read.parquet(f"{store.root}/data/commit={with_marker['commit']}")


def report_json(reports: DataFrame, found: DataFrame) -> DataFrame:
    """(path, json): each report with its issues, worst first and then by source and code, as one JSON text."""
    order = F.array_position(F.lit(["ERROR", "WARN", "INFO"]), F.col("severity"))
    listed = found.groupBy("path").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), "source", "code", "severity", "scope", "details"))).alias("x"))
    issues = F.transform(F.coalesce("x", F.array().cast(listed.schema["x"].dataType)), lambda i: F.struct(*(i[c].alias(c) for c in ("code", "severity", "source", "scope", "details"))))
    kept = [c for c in reports.columns if c != "path"]
    return reports.join(listed, "path", "left").select("path", F.to_json(F.struct("path", *kept, issues.alias("issues")), {"ignoreNullFields": "false"}).alias("json"))


def append_failure(spark: SparkSession, root: str, model: str, stage: str, now: str, kind: str = "timeout") -> None:
    """One failed attempt of a process outside."""
    row = spark.createDataFrame([(model, stage, "failed_external", kind)], "model string, stage string, status string, exception_type string")
    row.withColumn("at", F.lit(now).cast("timestamp")).write.mode("append").parquet(f"{root}/attempts")
