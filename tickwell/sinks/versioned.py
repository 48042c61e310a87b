"""A partitioned Parquet table whose content changes all at once.

Rows are written into folders of a new version; nothing that readers use is
touched.  A manifest lists the folder of every partition, and one small commit
file names the manifest that counts.  The highest numbered whole commit file
is the table, so writing it is the commit, and naming an older manifest again
is the rollback.  A writer that dies before its commit leaves folders that no
manifest lists; ``vacuum`` removes them.

    data/version=<id>/<partitions>/part-*.parquet
    manifests/<id>/part-*.parquet      partition values and version
    commits/<number>                   one line of JSON: manifest, schema, note
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.functions.scalar import null_safe_join
from tickwell.session import remove_path
from tickwell.sinks import lake


class ConcurrentCommit(RuntimeError):
    """Another writer committed first; nothing of this one counts."""


class VersionedTable:
    def __init__(self, path: str, partitions: tuple[str, ...] = lake.PARTITIONS, sort: tuple[str, ...] = lake.SORT):
        self.path, self.partitions, self.sort = path.rstrip("/"), partitions, sort

    # --- commits ---

    def _hadoop(self, spark: SparkSession, path: str):
        found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found

    def _commits(self, spark: SparkSession) -> list[tuple[int, dict]]:
        """Numbers and contents, oldest first; {} for a file that was never finished."""
        fs, folder = self._hadoop(spark, f"{self.path}/commits")
        if not fs.exists(folder):
            return []
        read = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        found = []
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.isdigit():
                stream = fs.open(status.getPath())
                try:
                    text = read.toString(stream, "UTF-8")
                finally:
                    stream.close()
                found.append((int(name), json.loads(text) if text.endswith("\n") else {}))
        return sorted(found, key=lambda c: c[0])

    def _commit(self, spark: SparkSession, after: int, content: dict) -> None:
        """Write the commit file that follows number ``after``; only one writer can."""
        fs, file = self._hadoop(spark, f"{self.path}/commits/{after + 1:012d}")
        try:
            out = fs.create(file, False)
        except Py4JJavaError as e:
            raise ConcurrentCommit(f"{self.path}: commit {after + 1} exists") from e
        out.write((json.dumps(content) + "\n").encode())
        out.close()

    def _state(self, spark: SparkSession) -> tuple[int, dict | None]:
        """The last number in use, and the content of the last whole commit."""
        commits = self._commits(spark)
        whole = [content for _, content in commits if content]
        return (commits[-1][0] if commits else 0), (whole[-1] if whole else None)

    def exists(self, spark: SparkSession) -> bool:
        return self._state(spark)[1] is not None

    def history(self, spark: SparkSession) -> DataFrame:
        """One row per commit, oldest first."""
        rows = [(number, content["manifest"], content.get("note")) for number, content in self._commits(spark) if content]
        return spark.createDataFrame(rows, "number bigint, manifest string, note string")

    # --- reading ---

    def _manifest(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        fields = [schema[p] for p in self.partitions]
        return spark.read.schema(T.StructType([*fields, T.StructField("version", T.StringType())])).parquet(f"{self.path}/manifests/{name}")

    def manifest(self, spark: SparkSession) -> DataFrame | None:
        """Partition values and versions of the table as it is."""
        content = self._state(spark)[1]
        return None if content is None else self._manifest(spark, content["manifest"], T.StructType.fromJson(content["schema"]))

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """The rows of the last commit, or of commit ``number``.

        Folders of the manifest are read by name, as the file index keeps them,
        so superseded folders are neither listed nor read.
        """
        commits = [(n, c) for n, c in self._commits(spark) if c and number in (None, n)]
        if not commits:
            raise FileNotFoundError(f"{self.path} has no commit{'' if number is None else f' {number}'}")
        content = commits[-1][1]
        schema = T.StructType.fromJson(content["schema"])
        rows = self._manifest(spark, content["manifest"], schema).toLocalIterator()
        folders = [lake.partition_path(f"{self.path}/data/version={r['version']}", self.partitions, [r[p] for p in self.partitions]) for r in rows]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

    # --- writing ---

    def replace(self, rows: DataFrame, clear: DataFrame | None = None, note: str | None = None) -> str:
        """Replace the partitions in ``rows``, and empty those in ``clear``; readers see all of it or nothing.

        ``rows`` may read the table itself.  Returns the version's name.
        """
        spark = rows.sparkSession
        number, content = self._state(spark)
        version = uuid.uuid4().hex
        data = f"{self.path}/data/version={version}"
        lake.write_partitions(rows, data, self.partitions, self.sort)
        schema = T.StructType([f for f in rows.schema.fields if f.name not in self.partitions] + [rows.schema[p] for p in self.partitions])
        new = spark.read.schema(schema).parquet(data).select(*self.partitions).distinct()  # from the folder names
        listed = new.withColumn("version", F.lit(version))
        if content is not None:
            before = T.StructType.fromJson(content["schema"])
            schema = T.StructType([f for f in before.fields if f.name not in schema.names] + schema.fields)
            kept = null_safe_join(self._manifest(spark, content["manifest"], before), new, list(self.partitions), "left_anti")
            if clear is not None:
                kept = null_safe_join(kept, clear.select(*self.partitions).distinct(), list(self.partitions), "left_anti")
            listed = listed.unionByName(kept)
        listed.write.parquet(f"{self.path}/manifests/{version}")
        self._commit(spark, number, {"manifest": version, "schema": schema.jsonValue(), "note": note})
        return version

    def rollback(self, spark: SparkSession, to: int | None = None) -> int:
        """Make an older commit the table again, by default the one before the last; returns its number."""
        commits = self._commits(spark)
        whole = [(n, c) for n, c in commits if c]
        wanted = [(n, c) for n, c in whole if n == to] if to is not None else whole[-2:-1]
        if not wanted:
            raise ValueError(f"{self.path} has no commit to go back to")
        number, content = wanted[0]
        self._commit(spark, commits[-1][0], content | {"note": f"rollback to {number}"})
        return number

    def vacuum(self, spark: SparkSession, keep: int = 1) -> int:
        """Delete partition folders that none of the last ``keep`` commits lists; returns how many."""
        last = [c for _, c in self._commits(spark) if c][-keep:]
        if not last:
            return 0
        schema = T.StructType.fromJson(last[-1]["schema"])
        columns = ["version", *self.partitions]
        live = [self._manifest(spark, name, schema).select(*columns) for name in sorted({c["manifest"] for c in last})]
        listed = live[0]
        for other in live[1:]:
            listed = listed.unionByName(other)
        fields = T.StructType([T.StructField("version", T.StringType()), *schema.fields])
        stored = spark.read.schema(fields).parquet(f"{self.path}/data").select(*columns).distinct()
        removed = lake.remove_partitions(spark, f"{self.path}/data", tuple(columns), null_safe_join(stored, listed.distinct(), columns, "left_anti"))
        fs, folder = self._hadoop(spark, f"{self.path}/data")
        for status in fs.listStatus(folder):  # versions without a folder left
            if not any(s.isDirectory() for s in fs.listStatus(status.getPath())):
                remove_path(spark, status.getPath().toString())
        return removed
