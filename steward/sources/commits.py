"""Tables of Parquet files that change by commits: exactly-once appends (S9) and keyed merges.

A table is a folder. ``data`` holds a folder for each write, cut into buckets by a hash of the key; ``_versions`` holds one small file a
version, which names the folders and buckets that make up the table then. Rows are written first and count for nothing until the
next version's file appears under its name, which is one rename: readers see all of a change or nothing, and an attempt that
broke off leaves unnamed files only. Each change has a batch id. A change whose batch is in the table already does nothing, so it may
be run again whenever its outcome is unknown. Of two writers at a time one gets the next version, the other starts again from
that. The folder must be on a file system whose rename is atomic and refuses an existing name.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steward.operators.coerce import REJECT, accepted, conform, rejected
from steward.operators.keys import key_violations, split_violations
from steward.operators.names import unused
from steward.session import stored
from steward.sources.sinks import KeyViolation, _key_rejects

#: How often a change starts again because another writer was first.
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Another writer made the version that this change was to become."""


@dataclass(frozen=True)
class Version:
    """The state of a table: ``folders`` maps a folder below ``data`` to those of its buckets that are part of the table."""

    number: int
    batch: str
    schema: T.StructType
    key: tuple[str, ...]
    buckets: int
    folders: dict[str, tuple[int, ...]]

    def text(self) -> str:
        state = {
            "number": self.number, "batch": self.batch, "schema": self.schema.jsonValue(), "key": self.key,
            "buckets": self.buckets, "folders": self.folders,
        }
        return json.dumps(state)

    @staticmethod
    def of(text: str) -> Version:
        state = json.loads(text)
        folders = {name: tuple(buckets) for name, buckets in state["folders"].items()}
        schema = T.StructType.fromJson(state["schema"])
        return Version(state["number"], state["batch"], schema, tuple(state["key"]), state["buckets"], folders)


class _Files:
    """The few file operations of a table's folder, by Hadoop, so that any shared file system will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf, self.root = spark._jvm, spark._jsc.hadoopConfiguration(), root.rstrip("/")
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [status.getPath().getName() for status in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def publish(self, name: str, text: str) -> bool:
        """Create a file with this text under a name that nobody has used, at once; whether it was ours."""
        draft = f"_drafts/{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.mkdirs(self.path(name).getParent())
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(self.path(draft), self.path(name), options)
        except Py4JJavaError as error:
            if not self.exists(name):
                raise error
            self.fs.delete(self.path(draft), False)
            return False
        return True


def _version_file(number: int) -> str:
    return f"_versions/{number:012d}.json"


def _batch_file(batch: str) -> str:
    return f"_batches/{hashlib.sha256(batch.encode()).hexdigest()}"


def current_version(spark: SparkSession, root: str) -> Version:
    """The newest version of the table at ``root``."""
    files = _Files(spark, root)
    names = [n for n in files.names("_versions") if n.endswith(".json") and not n.startswith(".")]
    if not names:
        raise ValueError(f"no table at {root}")
    return Version.of(files.read(f"_versions/{max(names)}"))


def _publish(spark: SparkSession, root: str, version: Version, before: Version | None) -> None:
    """Make ``version`` the table's state, if ``before`` still is."""
    files = _Files(spark, root)
    # The newest version tells of its own batch; those before it are marked, so that no list of all batches is carried on.
    if before is not None and before.batch and not files.exists(_batch_file(before.batch)):
        files.publish(_batch_file(before.batch), str(before.number))
    if not files.publish(_version_file(version.number), version.text()):
        raise Conflict(f"version {version.number} of {root} is another writer's")


def is_applied(spark: SparkSession, root: str, batch: str) -> bool:
    """Whether the change ``batch`` is in the table."""
    return current_version(spark, root).batch == batch or _Files(spark, root).exists(_batch_file(batch))


def create_committed(spark: SparkSession, root: str, schema: T.StructType, key: Sequence[str] = (), buckets: int = 16) -> None:
    """An empty table. With a ``key``, rows are kept in ``buckets`` by its hash, the unit in which a merge rewrites; choose as many as
    make each some hundred MB. It is an error if there is a table."""
    missing = set(key) - set(schema.names)
    if missing or buckets < 1:
        raise ValueError(f"unknown key columns {sorted(missing)}" if missing else "at least one bucket")
    _publish(spark, root, Version(0, "", schema, tuple(key), buckets if key else 1, {}), None)


def _bucket_of(version: Version) -> Column:
    if not version.key:
        return F.lit(0)
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in version.key]), F.lit(version.buckets)).cast("int")


def _read(spark: SparkSession, root: str, version: Version, buckets: set[int] | None = None) -> DataFrame:
    paths = [
        f"{root.rstrip('/')}/data/{folder}/_bucket={bucket}"
        for folder, held in version.folders.items()
        for bucket in held
        if buckets is None or bucket in buckets
    ]
    return spark.read.schema(version.schema).parquet(*paths) if paths else spark.createDataFrame([], version.schema)


def read_committed(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of the newest version, or of version ``number``."""
    version = current_version(spark, root) if number is None else Version.of(_Files(spark, root).read(_version_file(number)))
    return _read(spark, root, version)


def _write(rows: DataFrame, root: str, version: Version) -> tuple[str, tuple[int, ...]]:
    """A new folder with ``rows``, which nothing names yet, and its buckets."""
    (bucket,) = unused(rows.columns, "_bucket")
    if bucket != "_bucket":
        raise ValueError("a column may not be called _bucket")
    folder = uuid.uuid4().hex
    dealt = rows.withColumn("_bucket", _bucket_of(version))
    if version.key:
        # A task a bucket, or several where adaptive execution finds a bucket large.
        dealt = dealt.hint("rebalance", F.col("_bucket"))
    dealt.write.partitionBy("_bucket").parquet(f"{root.rstrip('/')}/data/{folder}")
    names = _Files(rows.sparkSession, root).names(f"data/{folder}")
    return folder, tuple(sorted(int(n.partition("=")[2]) for n in names if n.startswith("_bucket=")))


@dataclass(frozen=True)
class OnceReport:
    """What an append did: ``applied`` is False where the batch was in the table before, and then nothing was done."""

    applied: bool
    version: int
    #: Rows that were not appended, with the reasons in ``_reject``; None where nothing was done.
    rejects: DataFrame | None


def _screened(rows: DataFrame, key: Sequence[str], held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed ``rows`` as those to append and those to reject: ill-typed ones and, with a key, absent, repeated or taken keys."""
    good, rejects = accepted(rows), rejected(rows)
    if key:
        violations = stored(key_violations(good, key, held), "key-violations")
        if not violations.isEmpty():
            fine, bad = split_violations(rows.where(F.size(REJECT) == 0), violations, key)
            good, rejects = fine.drop(REJECT), rejects.unionByName(_key_rejects(bad, key))
    return good, rejects


def append_once(rows: DataFrame, root: str, batch: str) -> OnceReport:
    """Append ``rows`` to the table at ``root`` as the change ``batch``, once and for all.

    Rows are brought to the table's types, unless they carry a ``_reject`` column already, and screened as ``append_rows`` does.
    Run again, after a failure at whatever point or after success, the table holds them once.
    """
    if not batch:
        raise ValueError("a batch needs an id")
    spark = rows.sparkSession
    typed = None
    for _ in range(ATTEMPTS):
        version = current_version(spark, root)
        if is_applied(spark, root, batch):
            return OnceReport(False, version.number, None)
        if typed is None:
            typed = stored(rows if REJECT in rows.columns else conform(rows, version.schema), "staged-rows")
        good, rejects = _screened(typed, version.key, _read(spark, root, version))
        folder, buckets = _write(good.select(*[F.col(f"`{c}`") for c in version.schema.names]), root, version)
        folders = {**version.folders, **({folder: buckets} if buckets else {})}
        try:
            _publish(spark, root, replace(version, number=version.number + 1, batch=batch, folders=folders), version)
        except Conflict:
            continue
        return OnceReport(True, version.number + 1, rejects)
    raise Conflict(f"{ATTEMPTS} attempts at {root} came second")


def replace_once(rows: DataFrame, root: str, batch: str) -> bool:
    """Make ``rows``, of the table's types, the whole contents of the table as the change ``batch``; whether it was to be done."""
    spark = rows.sparkSession
    for _ in range(ATTEMPTS):
        version = current_version(spark, root)
        if is_applied(spark, root, batch):
            return False
        folder, buckets = _write(rows.select(*[F.col(f"`{c}`") for c in version.schema.names]), root, version)
        folders = {folder: buckets} if buckets else {}
        try:
            _publish(spark, root, replace(version, number=version.number + 1, batch=batch, folders=folders), version)
        except Conflict:
            continue
        return True
    raise Conflict(f"{ATTEMPTS} attempts at {root} came second")


def compact(spark: SparkSession, root: str) -> int:
    """Write the rows of the table anew in one folder, for a table that many small appends have made of many; gives the version.

    Which batches are applied stays known. Follow it by :func:`clean_up` when no reader needs the versions before.
    """
    for _ in range(ATTEMPTS):
        version = current_version(spark, root)
        if len(version.folders) < 2:
            return version.number
        folder, buckets = _write(_read(spark, root, version), root, version)
        folders = {folder: buckets} if buckets else {}
        following = replace(version, number=version.number + 1, batch=f"compacted {version.number}", folders=folders)
        try:
            _publish(spark, root, following, version)
        except Conflict:
            continue
        return following.number
    raise Conflict(f"{ATTEMPTS} attempts at {root} came second")


def clean_up(spark: SparkSession, root: str, versions: int = 2) -> None:
    """Remove the versions before the newest ``versions`` ones and folders of rows that none of these names. Readers of what is
    removed fail, and so do changes that run meanwhile, whose rows no version names yet; they may be run again."""
    files = _Files(spark, root)
    names = sorted(n for n in files.names("_versions") if n.endswith(".json") and not n.startswith("."))
    kept = {folder for n in names[-versions:] for folder in Version.of(files.read(f"_versions/{n}")).folders}
    for n in names[:-versions]:
        files.remove(f"_versions/{n}")
    for folder in files.names("data"):
        if folder not in kept:
            files.remove(f"data/{folder}")


#: What a merge calls a key, beside those of the table that no change names.
CLASSES = ("insert", "update", "delete", "same", "absent")


@dataclass(frozen=True)
class MergeReport:
    """Keys by what became of them: ``same`` had the same values before, ``absent`` were to be deleted and did not exist."""

    applied: bool
    version: int
    counts: dict[str, int]
    #: Buckets that were written anew.
    rewritten: tuple[int, ...] = ()


def classified(held: DataFrame, changes: DataFrame, key: Sequence[str], deletes: str) -> DataFrame:
    """One row per key of either side, ``(_class, _row)``: what the change of the key amounts to, by a single full outer join, and the
    row that stays (NULL for none). ``deletes`` is the boolean column of ``changes`` that marks keys to delete. Keys no change names
    are ``kept``; rows are equal where all columns are, NULL being equal to NULL."""
    names = held.columns
    slots = [f"_k{i}" for i in range(len(key))]

    def keyed(df: DataFrame, row: str, *more: Column) -> DataFrame:
        return df.select(*[F.col(f"`{k}`").alias(s) for k, s in zip(key, slots)], F.struct(*[F.col(f"`{c}`") for c in names]).alias(row), *more)

    gone = F.coalesce(F.col(f"`{deletes}`"), F.lit(False)).alias("_gone")
    both = keyed(held, "_old").join(keyed(changes, "_new", gone), slots, "full")
    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    kind = (
        F.when(~new, "kept")
        .when(F.col("_gone"), F.when(old, "delete").otherwise("absent"))
        .when(~old, "insert")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "same")
        .otherwise("update")
    )
    stays = F.when(kind.isin("kept", "same"), F.col("_old")).when(kind.isin("insert", "update"), F.col("_new"))
    return both.select(kind.alias("_class"), stays.alias("_row"), *slots)


def merge_once(changes: DataFrame, root: str, batch: str, deletes: str | None = None) -> MergeReport:
    """Bring the keyed table at ``root`` up to date with ``changes`` as the change ``batch``, once and for all.

    A change holds a key and the values its row has from now on; where the boolean column ``deletes`` is true the row goes.
    ``changes`` must be of the table's types and may name each key once, or nothing is done and :class:`KeyViolation` raised.

    Only buckets that changes fall into are read, and of those only such with an insert, an update or a delete are written anew;
    the files of all others stay what they are. The new buckets take the place of the old ones with the next version.
    """
    if not batch:
        raise ValueError("a batch needs an id")
    spark = changes.sparkSession
    staged = None
    for _ in range(ATTEMPTS):
        version = current_version(spark, root)
        if not version.key:
            raise ValueError(f"{root} has no key")
        if is_applied(spark, root, batch):
            return MergeReport(False, version.number, {})
        if staged is None:
            marker = deletes or unused(version.schema.names, "_deletes")[0]
            if marker in version.schema.names:
                raise ValueError(f"{marker} is a column of the table")
            flag = F.col(f"`{deletes}`") if deletes else F.lit(False)
            typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in version.schema.fields]
            staged = stored(changes.select(*typed, flag.cast("boolean").alias(marker)), "staged-changes")
            if not key_violations(staged, version.key).isEmpty():
                raise KeyViolation(f"{root}: a change's key ({', '.join(version.key)}) is absent or repeated")
        # As many numbers as there are buckets, at most.
        touched = {r[0] for r in staged.select(_bucket_of(version)).distinct().collect()}
        slots = [F.col(f"_k{i}") for i in range(len(version.key))]
        bucket = F.pmod(F.xxhash64(*slots), F.lit(version.buckets)).cast("int").alias("_bucket")
        judged = classified(_read(spark, root, version, touched), staged, version.key, marker)
        judged = stored(judged.select("_class", "_row", bucket), "classified")
        found = judged.groupBy("_bucket", "_class").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {c: sum(r["n"] for r in found if r["_class"] == c) for c in CLASSES}
        changed = {r["_bucket"] for r in found if r["_class"] in ("insert", "update", "delete")}
        folders = {f: tuple(b for b in held if b not in changed) for f, held in version.folders.items()}
        folders = {f: held for f, held in folders.items() if held}
        if changed:
            stays = judged.where(F.col("_bucket").isin(changed) & F.col("_row").isNotNull()).select("_row.*")
            folder, buckets = _write(stays, root, version)
            folders |= {folder: buckets} if buckets else {}
        try:
            _publish(spark, root, replace(version, number=version.number + 1, batch=batch, folders=folders), version)
        except Conflict:
            continue
        return MergeReport(True, version.number + 1, counts, tuple(sorted(changed)))
    raise Conflict(f"{ATTEMPTS} attempts at {root} came second")
