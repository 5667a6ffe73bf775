"""A dataset whose live files are named by a log of commits, so that compaction and readers never meet.

Layout: ``<path>/data/commit=<id>/<partition columns>/*.parquet`` holds what was
written, ``<path>/log/<version>.json`` what each commit adds and retires. Files
never change once written. A commit becomes visible in one step, when its log
entry gets its name: entries are written beside the log and renamed without
overwriting, so of two writers of one version one is refused. The refused one
reads what the other did: rows appended by another stand beside its own, and it
takes the next version; files that both retire are a conflict, as its input is
gone. So a reader of any moment sees whole commits; a run that dies before its
rename leaves files that no entry names, which ``vacuum`` deletes.

The rename must fail where the name is taken, as it does on HDFS and on local
disks; on stores without that, writers need a lock of their own.

Entries are rows of file, partition, rows, bytes and action; what is live is an
aggregate over them. Only file names of the partitions that are read reach the
driver, as for any file scan.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidalbook.operators.dedup import keep_first

ENTRY = "version bigint, action string, file string, part map<string,string>, n_rows bigint, n_bytes bigint, table_schema string"
ADD, RETIRE = "add", "retire"


class CommitConflict(RuntimeError):
    """Another writer retired files that this commit wanted to retire."""


class SnapshotTable:
    """One dataset at ``path``, partitioned by ``by``, its rows ordered by ``order`` within files."""

    def __init__(self, spark: SparkSession, path: str, by: Sequence[str], order: Sequence[str]) -> None:
        self.spark, self.path, self.by, self.order = spark, path.rstrip("/"), list(by), list(order)

    # The log

    def _hadoop(self, name: str) -> tuple[object, object]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def version(self) -> int:
        """The number of the newest commit; 0 before any."""
        fs, at = self._hadoop("log")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json")), default=0)

    def _publish(self, version: int, entries: list[dict]) -> bool:
        """Make the entries version ``version``; False if that number is taken."""
        fs, draft = self._hadoop(f"drafts/{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        stream.write("\n".join(json.dumps({**e, "version": version}) for e in entries).encode())
        stream.close()
        _, at = self._hadoop(f"log/{version:012d}.json")
        fs.mkdirs(at.getParent())
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, at, options)
        except Exception as refused:
            if "FileAlreadyExistsException" not in str(refused):
                raise
            fs.delete(draft, False)
            return False
        return True

    def log(self, upto: int | None = None) -> DataFrame:
        """All entries up to a version (the newest)."""
        last = self.version() if upto is None else upto
        files = [f"{self.path}/log/{v:012d}.json" for v in range(1, last + 1)]
        return self.spark.read.schema(ENTRY).json(files) if files else self.spark.createDataFrame([], ENTRY)

    def live(self, upto: int | None = None) -> DataFrame:
        """(file, part, n_rows, n_bytes) of the files that make up a version."""
        last = F.max_by(F.struct("action", "part", "n_rows", "n_bytes"), F.col("version"))
        return self.log(upto).groupBy("file").agg(last.alias("last")).where(F.col("last.action") == ADD).select("file", "last.part", "last.n_rows", "last.n_bytes")

    def commit(self, added: list[dict], retired: list[str], read: int) -> int:
        """Publish files to add and to retire, decided on version ``read``; the version that it became."""
        entries = [{"action": ADD, **e} for e in added] + [{"action": RETIRE, "file": f} for f in retired]
        while True:
            if self._publish(read + 1, entries):
                return read + 1
            read += 1
            gone = {r["file"] for r in self.spark.read.schema(ENTRY).json(f"{self.path}/log/{read:012d}.json").where(F.col("action") == RETIRE).select("file").collect()} if retired else set()
            if gone.intersection(retired):
                raise CommitConflict(f"version {read} retired files that this commit reads")

    # Rows

    def _write(self, rows: DataFrame, files: int) -> list[dict]:
        """Write rows as files of a new commit folder; what an entry says of each."""
        folder = f"{self.path}/data/commit={uuid.uuid4().hex}"
        salt = F.pmod(F.xxhash64(*self.order), F.lit(files))
        dealt = rows.repartition(*[F.col(c) for c in self.by], salt).sortWithinPartitions(*self.by, *self.order)
        dealt.write.partitionBy(*self.by).parquet(folder)
        fs, at = self._hadoop(folder[len(self.path) + 1 :])
        if not any(s.isDirectory() for s in fs.listStatus(at)):
            return []
        back = self.spark.read.schema(rows.schema).option("basePath", folder).parquet(folder)
        part = F.create_map(*[x for c in self.by for x in (F.lit(c), F.col(c).cast("string"))])
        named = back.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("n_bytes"), part.alias("part"))
        found = named.groupBy("file", F.to_json("part").alias("part")).agg(F.count("*").alias("n_rows"), F.max("n_bytes").alias("n_bytes"))
        schema = rows.schema.json()
        return [{"file": r["file"], "part": json.loads(r["part"]), "n_rows": r["n_rows"], "n_bytes": r["n_bytes"], "table_schema": schema} for r in found.collect()]

    def append(self, rows: DataFrame, files: int = 1) -> int:
        """Add rows, each partition in up to ``files`` files. An empty table adds nothing and is no commit."""
        read = self.version()
        added = self._write(rows, files)
        return self.commit(added, [], read) if added else read

    def schema(self) -> T.StructType | None:
        last = self.log().where(F.col("table_schema").isNotNull()).agg(F.max_by("table_schema", "version").alias("schema")).first()["schema"]
        return None if last is None else T.StructType.fromJson(json.loads(last))

    def _rows(self, files: list[str], schema: T.StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField("commit", T.StringType())])).option("basePath", f"{self.path}/data").parquet(*files).select(*[f"`{c}`" for c in schema.names])

    def read(self, upto: int | None = None, only: Column | str | None = None) -> DataFrame:
        """Rows of a version (the newest); ``only`` is a condition on the map ``part`` and leaves out whole files."""
        schema = self.schema()
        if schema is None:
            raise FileNotFoundError(f"{self.path} has no commit")
        live = self.live(upto) if only is None else self.live(upto).where(only)
        return self._rows([r["file"] for r in live.select("file").collect()], schema)

    # Upkeep

    def candidates(self, min_files: int = 2, only: Column | str | None = None, limit: int | None = None) -> DataFrame:
        """(part, files, n_rows, n_bytes) of partitions that compaction would rewrite, those of most files first."""
        live = self.live() if only is None else self.live().where(only)
        found = live.groupBy(F.to_json("part").alias("part")).agg(F.count("*").alias("files"), F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes")).where(F.col("files") >= min_files)
        out = found.orderBy(F.desc("files"), "part")
        return out if limit is None else out.limit(limit)

    def compact(self, only: Column | str | None = None, dedup_key: Sequence[str] = (), files: int = 1, min_files: int = 2, limit: int | None = None, attempts: int = 3, dry_run: bool = False) -> DataFrame:
        """Rewrite partitions of ``min_files`` files or more into ``files`` sorted ones, and report what came of it.

        The report has (part, files, n_rows, status, attempts): status is
        ``planned`` in a dry run, else ``compacted``, or ``failed`` when each
        attempt met a conflict. With ``dedup_key`` the first row by order of
        each key stays. Readers see the old files until the commit and the new
        ones after it; old versions can be read until ``vacuum``.
        """
        for attempt in range(1, attempts + 1):
            read = self.version()
            report = [(r["part"], r["files"], r["n_rows"]) for r in self.candidates(min_files, only, limit).collect()]
            if dry_run or not report:
                status, attempt = "planned", 0
                break
            wanted = self.live(read).where(F.to_json("part").isin([p for p, _, _ in report]))
            old = [r["file"] for r in wanted.select("file").collect()]
            rows = self._rows(old, self.schema())
            rows = keep_first(rows, [*self.by, *dedup_key], self.order) if dedup_key else rows
            try:
                self.commit(self._write(rows.select(*self.schema().names), files), old, read)
                status = "compacted"
                break
            except CommitConflict:
                status = "failed"
        return self.spark.createDataFrame([(*r, status, attempt) for r in report], "part string, files bigint, n_rows bigint, status string, attempts int")

    def vacuum(self, keep: int = 0, older_than_us: int | None = None) -> int:
        """Delete files that no version since ``keep`` versions ago has, and, if written before ``older_than_us``, files that no commit names; how many."""
        newest = self.version()
        entries = self.log()
        retired = entries.groupBy("file").agg(F.max(F.when(F.col("action") == RETIRE, F.col("version"))).alias("at")).where(F.col("at") <= newest - keep).select("file")
        gone = retired
        fs, at = self._hadoop("data")
        if older_than_us is not None and fs.exists(at):
            there = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{self.path}/data").where(F.unix_micros("modificationTime") < older_than_us)
            plain = F.regexp_replace("file", "^file:/+", "file:///")
            stray = there.select(F.regexp_replace("path", "^file:/+", "file:///").alias("plain"), F.col("path").alias("file")).join(entries.select(plain.alias("plain")), "plain", "left_anti").select("file")
            gone = retired.unionByName(stray)
        deleted = 0
        for row in gone.distinct().toLocalIterator():
            where = self.spark._jvm.org.apache.hadoop.fs.Path(row["file"])
            deleted += bool(where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, False))
        return deleted
