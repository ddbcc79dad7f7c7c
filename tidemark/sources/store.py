"""Versioned table store on any Hadoop-compatible file system.

Parquet tables cannot be updated in place, so every sync writes new
directories and publishes them through a commit manifest:

    <root>/<table>/v=000007-<attempt>/part-*.parquet   one directory per attempt
    <root>/_logs/<log>/<attempt>/part-*.parquet        run log rows
    <root>/_commits/c=000012.json                      one manifest per commit

A manifest describes the whole published state: per table its version,
segments, schema, bucket count and largest id, per log its files.  Readers
use the newest one, so a commit is all-or-nothing for every table and log
row it names, and a run that dies leaves only directories nobody names.
A manifest is written aside and renamed without overwriting; a commit
whose tables changed since the run's snapshot is refused
(``ConcurrentUpdate``), one whose tables did not is retried on the newer
state.

A version is a list of segments.  Usually that is its own directory; a
history table whose old rows never change (inactive SCD versions) writes
only the rows a run touched or inserted, partitioned by the active flag,
and lists the ``<flag>=false`` directories of earlier versions as further
segments.  A run then costs the active set plus the batch, not the whole
history.  Past ``MAX_SEGMENTS`` the oldest half is merged into one.

A table whose rows carry a flag for "in the latest batch" may keep the flag
beside its rows (``presence``): a run adds segments of new rows and of the
ids it saw again, and ``read`` derives flag and stamp.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import presence

# carried segments (or log files) allowed before the oldest half is merged
MAX_SEGMENTS = 64
#: Directory columns of tables in buckets; no data column has these names.
BUCKET, VERSION = "_bucket", "v"


class ConcurrentUpdate(RuntimeError):
    """Another run published a table after this run read it."""


def bucket_of(key, buckets: int):
    """Hash bucket of a key (the same on every run and every executor)."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in key]), F.lit(buckets)).cast("int")


def buckets_of(rows: DataFrame, key, buckets: int) -> DataFrame:
    """The bucket numbers of ``rows``: ``buckets`` rows at most, so that they
    may be broadcast.  The filter is always true; it lets the engine prune
    the other side's partitions by them."""
    return F.broadcast(rows.select(bucket_of(key, buckets).alias(BUCKET)).distinct()
                       .where(F.col(BUCKET) >= 0))


class Snapshot:
    """The published state as of one commit."""

    def __init__(self, number: int = 0, tables: dict | None = None, logs: dict | None = None,
                 applied: dict | None = None):
        self.number = number
        self.tables: dict[str, dict] = tables or {}
        self.logs: dict[str, dict] = logs or {}
        self.applied: dict[str, str] = applied or {}

    def table(self, name: str) -> dict | None:
        return self.tables.get(name)

    def version(self, name: str) -> int | None:
        return self.tables[name]["version"] if name in self.tables else None


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._pending: dict[tuple[str, int], dict] = {}
        self._pending_logs: dict[str, list[str]] = {}
        self._cache: Snapshot | None = None

    # -- file system (the cluster's, through Spark's Hadoop configuration) --
    def _fs_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, p

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs_path(path)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def _read_text(self, path: str) -> str:
        fs, p = self._fs_path(path)
        return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
            fs.open(p), "UTF-8")

    def _publish_text(self, path: str, text: str) -> bool:
        """Write a file whole under a name nobody has; False if it is taken."""
        sc = self.spark.sparkContext
        jvm = sc._jvm
        fs, target = self._fs_path(path)
        folder, name = path.rsplit("/", 1)
        _, aside = self._fs_path(f"{folder}/_aside-{uuid.uuid4().hex}-{name}")
        out = fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        aside, target = fs.makeQualified(aside), fs.makeQualified(target)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            target.toUri(), sc._jsc.hadoopConfiguration())
        no_options = sc._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(aside, target, no_options)
        except Py4JJavaError as e:
            fs.delete(aside, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    # -- published state ------------------------------------------------------
    def _commit_path(self, number: int) -> str:
        return f"{self.root}/_commits/c={number:06d}.json"

    def snapshot(self) -> Snapshot:
        """The newest published state (one listing, one small file)."""
        numbers = [int(n[2:-5]) for n in self._children(f"{self.root}/_commits")
                   if n.startswith("c=") and n.endswith(".json")]
        newest = max(numbers, default=0)
        if self._cache is None or self._cache.number != newest:
            m = json.loads(self._read_text(self._commit_path(newest))) if newest else {}
            self._cache = Snapshot(newest, m.get("tables"), m.get("logs"), m.get("applied"))
        return self._cache

    def current_versions(self) -> dict[str, int]:
        return {t: e["version"] for t, e in self.snapshot().tables.items()}

    # -- versions -----------------------------------------------------------
    def write_version(self, table: str, df: DataFrame, partition_by=None, carry=None,
                      bucket_key=None, buckets: int = 0, max_id: int | None = None,
                      carry_buckets: Snapshot | None = None, follows=None,
                      seen: DataFrame | None = None, seen_flag: str | None = None,
                      carry_seen=None) -> int:
        """Write ``df`` as a new version of ``table`` (not yet published).

        ``partition_by``: directory partitioning (e.g. the active flag, so
        that readers of active rows prune the rest).  ``carry``: segments of
        the current version that stay part of the new one.
        ``bucket_key`` / ``buckets``: lay rows out in ``buckets`` hash
        buckets of the key, one directory each, a file each (rows are dealt
        by bucket before the write).  ``carry_buckets``: that snapshot's
        bucket directories stay part of the table where ``df`` has no row.
        ``max_id``: largest surrogate id of the table.  ``follows``: what of
        another table this one was derived from (its version or segments).
        ``seen``: presence rows of the run (``presence.rows``) for the flag
        ``seen_flag``, stored beside those of ``carry_seen``.
        """
        version = 1 + max([self.snapshot().version(table) or 0,
                           *(v for t, v in self._pending if t == table)])
        path = f"{self.root}/{table}/v={version:06d}-{uuid.uuid4().hex[:12]}"
        schema = df.schema
        if bucket_key:
            if {BUCKET, VERSION} & set(df.columns):
                raise ValueError(f"{table}: {BUCKET} and {VERSION} are names of directories")
            df = df.withColumn(BUCKET, bucket_of(bucket_key, buckets)).repartition(
                min(buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions"))), BUCKET)
            df.write.partitionBy(BUCKET).parquet(path)
            written = [(f"{path}/{n}", n) for n in self._children(path)
                       if n.startswith(BUCKET + "=")]
            if carry_buckets is not None:
                new = {n for _, n in written}
                old = carry_buckets.table(table)
                carry = [x for x in (old["segments"] if old else []) if x[1] not in new]
        else:
            w = df.write
            (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
            written = [(path, None)]
        marks = None
        if seen is not None:
            marks = {"flag": seen_flag, "paths": [*(carry_seen or []), f"{path}-seen"]}
            seen.write.parquet(f"{path}-seen")
        self._pending[(table, version)] = {
            "version": version, "segments": [list(x) for x in [*(carry or []), *written]],
            "schema": schema.jsonValue(), "buckets": buckets if bucket_key else None,
            "max_id": max_id, "follows": follows, "seen": marks}
        return version

    def commit(self, versions: dict[str, int], logs: dict[str, DataFrame] | None = None,
               base: Snapshot | None = None, applied: dict[str, str] | None = None) -> int:
        """Publish written versions and log rows together.

        ``base``: the snapshot the run read; a table of ``versions`` that
        another commit changed since then is refused.  ``applied``: tags of
        applied inputs by log (``Snapshot.applied``).
        """
        written = {log: self._write_log(log, rows) for log, rows in (logs or {}).items()}
        while True:
            now = self.snapshot()
            if base is not None and now.number != base.number:
                stale = [t for t in versions if now.version(t) != base.version(t)]
                stale += [log for log in written
                          if now.logs.get(log) != base.logs.get(log)]
                if stale:
                    raise ConcurrentUpdate(
                        f"published by another run since it was read: {', '.join(stale)}")
            tables, all_logs = dict(now.tables), dict(now.logs)
            for t, v in versions.items():
                tables[t] = self._pending[(t, v)]
            for log, (path, last_id) in written.items():
                known = all_logs.get(log, {"paths": [], "last_id": 0})
                all_logs[log] = {"paths": self._merged_logs(log, [*known["paths"], path]),
                                 "last_id": max(known["last_id"], last_id)}
            manifest = {"tables": tables, "logs": all_logs,
                        "applied": {**now.applied, **(applied or {})}}
            if self._publish_text(self._commit_path(now.number + 1), json.dumps(manifest)):
                return now.number + 1

    # -- reads ----------------------------------------------------------------
    def segments(self, table: str, at: Snapshot | None = None):
        got = (at or self.snapshot()).table(table)
        return [tuple(s) for s in got["segments"]] if got else None

    def stored_buckets(self, table: str, at: Snapshot | None = None) -> int | None:
        got = (at or self.snapshot()).table(table)
        return got["buckets"] if got else None

    def follows(self, table: str, at: Snapshot | None = None):
        got = (at or self.snapshot()).table(table)
        return got.get("follows") if got else None

    def seen_paths(self, table: str, at: Snapshot | None = None) -> list[str] | None:
        """Where the presence rows of a table lie; None if it has none."""
        got = (at or self.snapshot()).table(table)
        return got["seen"]["paths"] if got and got.get("seen") else None

    def with_written(self, at: Snapshot, table: str, version: int) -> Snapshot:
        """``at`` with a written, not yet published version of ``table``."""
        return Snapshot(at.number, {**at.tables, table: self._pending[(table, version)]},
                        at.logs, at.applied)

    def max_id(self, table: str, at: Snapshot | None = None) -> int | None:
        got = (at or self.snapshot()).table(table)
        return got["max_id"] if got else 0

    def _read_segment(self, path: str, partition: str | None, stored: T.StructType) -> DataFrame:
        # files of one segment come from one write and share a schema: no
        # footer-merging pass over the history
        df = self.spark.read.parquet(path)
        if partition:
            name, value = partition.split("=", 1)
            value = None if value.startswith("__HIVE") else value
            df = df.withColumn(name, F.lit(value))
        # a directory-partition column has its stored type again
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                           for f in stored.fields if f.name in df.columns])

    def read(self, table: str, schema: T.StructType | None = None,
             touched: DataFrame | None = None, at: Snapshot | None = None,
             but=()) -> DataFrame | None:
        """Published version of ``table`` (None if never published), with the
        stored schema or, with ``schema``, in that one: columns missing in
        older versions are added as NULLs (forward migration).
        ``touched``: read only these buckets of a bucketed table
        (``buckets_of``); the scan's partitions are pruned by them at run
        time.  ``at``: read that snapshot's version.  ``but``: segment paths
        to leave out (what an earlier run has read)."""
        got = (at or self.snapshot()).table(table)
        return self._read_entry(table, got, schema, touched, but) if got else None

    def read_version_rows(self, table: str, version: int) -> DataFrame:
        """Rows of a written, not yet published version."""
        return self._read_entry(table, self._pending[(table, version)], None, None)

    def _read_entry(self, table: str, entry: dict, schema, touched, but=()) -> DataFrame:
        stored = T.StructType.fromJson(entry["schema"])
        segs = [tuple(s) for s in entry["segments"] if s[0] not in set(but)]
        if entry["buckets"]:
            df = self._read_buckets(table, [p for p, _ in segs], stored) if segs else None
            if df is not None and touched is not None:
                df = df.join(touched, BUCKET, "left_semi")
        else:
            df = None
            for p, part in segs:
                one = self._read_segment(p, part, stored)
                df = one if df is None else df.unionByName(one, allowMissingColumns=True)
        if df is None:
            return self.spark.createDataFrame([], schema or stored)
        if entry.get("seen"):
            df = presence.derive(df, self.spark.read.parquet(*entry["seen"]["paths"]),
                                 entry["seen"]["flag"])
            stored = T.StructType([f for f in stored.fields if f.name != presence.RUN])
        return self._conform(df, schema or stored)

    @staticmethod
    def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
        have = set(df.columns)
        return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None))
                           .cast(f.dataType).alias(f.name) for f in schema.fields])

    def _read_buckets(self, table: str, paths: list[str], stored: T.StructType) -> DataFrame:
        """One scan over bucket directories, whatever versions wrote them,
        with the bucket as a partition column.  Columns that an older version
        lacks are NULL."""
        return (self.spark.read.option("basePath", f"{self.root}/{table}")
                .schema(T.StructType([*stored.fields, T.StructField(VERSION, T.StringType()),
                                      T.StructField(BUCKET, T.IntegerType())])).parquet(*paths))

    def frozen_segments(self, table: str, flag: str, at: Snapshot | None = None):
        """Segments of the current version that hold only ``flag = false``
        rows and can be carried as they are; None when the table is not laid
        out by ``flag``.  Too many of them: the oldest half is merged."""
        got = (at or self.snapshot()).table(table)
        if not got:
            return None
        out = []
        for path, part in map(tuple, got["segments"]):
            if part is not None:
                out.append((path, part))
                continue
            names = self._children(path)
            if any(n.startswith("part-") for n in names):
                return None                 # not partitioned by the flag
            if f"{flag}=false" in names:
                out.append((f"{path}/{flag}=false", f"{flag}=false"))
        if len(out) > MAX_SEGMENTS:
            out = self._merge_segments(table, flag, out, T.StructType.fromJson(got["schema"]))
        return out

    def _merge_segments(self, table: str, flag: str, segs, stored: T.StructType):
        oldest, rest = segs[:len(segs) // 2], segs[len(segs) // 2:]
        df = None
        for p, part in oldest:
            one = self._read_segment(p, part, stored)
            df = one if df is None else df.unionByName(one, allowMissingColumns=True)
        path = f"{self.root}/{table}/merged-{uuid.uuid4().hex[:12]}/{flag}=false"
        df.drop(flag).write.parquet(path)
        return [(path, f"{flag}=false"), *rest]

    def vacuum(self, keep_commits: int = 20) -> list[str]:
        """Delete version and log directories that none of the newest
        ``keep_commits`` manifests names, and older manifests.  Not while
        other runs are writing: what they wrote is not named yet."""
        numbers = sorted(int(n[2:-5]) for n in self._children(f"{self.root}/_commits")
                         if n.startswith("c=") and n.endswith(".json"))
        named = set()
        for n in numbers[-keep_commits:]:
            m = json.loads(self._read_text(self._commit_path(n)))
            for e in m["tables"].values():
                named |= {p for p, _ in map(tuple, e["segments"])}
                named |= set((e.get("seen") or {}).get("paths", ()))
            for e in m["logs"].values():
                named |= set(e["paths"])
        gone = [self._commit_path(n) for n in numbers[:-keep_commits]]
        for top in self._children(self.root):
            folders = ([f"_logs/{x}" for x in self._children(f"{self.root}/_logs")]
                       if top == "_logs" else [] if top == "_commits" else [top])
            for folder in folders:
                for child in self._children(f"{self.root}/{folder}"):
                    path = f"{self.root}/{folder}/{child}"
                    if not any(p == path or p.startswith(path + "/") for p in named):
                        gone.append(path)
        for path in gone:
            fs, p = self._fs_path(path)
            fs.delete(p, True)
        return gone

    # -- run logs -----------------------------------------------------------
    def _log_folder(self, log: str) -> str:
        return f"{self.root}/_logs/{log}/{uuid.uuid4().hex}"

    def _write_log(self, log: str, rows: DataFrame) -> tuple[str, int]:
        path = self._log_folder(log)
        rows.coalesce(1).write.parquet(path)
        return path, int(self.spark.read.parquet(path).agg(F.max("id")).first()[0] or 0)

    def _merged_logs(self, log: str, paths: list[str]) -> list[str]:
        if len(paths) <= MAX_SEGMENTS:
            return paths
        half, path = len(paths) // 2, self._log_folder(log)
        self._read_logs(paths[:half]).coalesce(1).write.parquet(path)
        return [path, *paths[half:]]

    def _read_logs(self, paths: list[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(*paths)

    def append_log(self, log: str, metrics: DataFrame) -> None:
        """Publish log rows on their own (a run's go with its commit)."""
        self.commit({}, logs={log: metrics})

    def read_log(self, log: str, at: Snapshot | None = None) -> DataFrame | None:
        known = (at or self.snapshot()).logs.get(log)
        return self._read_logs(known["paths"]) if known else None

    def next_log_id(self, log: str, at: Snapshot | None = None) -> int:
        known = (at or self.snapshot()).logs.get(log)
        return known["last_id"] + 1 if known else 1
