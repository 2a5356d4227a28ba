"""Landed tables in a shared folder, published by one commit file per change.

Layout under ``root``::

    tables/<table>/<commit>-<token>/part-*.parquet   data written by executors
    _commits/<commit>.json                            names the directories a
                                                      commit publishes, per table

A commit becomes visible when its JSON file appears, whole, under the next
commit number, and never over an existing one: of two writers racing for a
number one wins, and until the other publishes too its data directories stay
unnamed (readers never see them).  Rows, run status and checkpoint of one ingestion
run are therefore published together or not at all.  This is a publish step
only: data files are ordinary Parquet written by Spark, and readers are
``spark.read.parquet`` over the committed directories.

File-system calls go through the Hadoop FileSystem API of the session: a mounted
shared folder or HDFS.  An object store whose rename is a copy does not refuse
an existing name in one step and is not supported for commits.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ConcurrentCommit(RuntimeError):
    pass


class FileSystem:
    """The few Hadoop FileSystem calls the package needs."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._jvm, self._gateway = jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(self._conf)

    def _p(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._p(path))

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._p(path))

    def create_new(self, path: str, text: str) -> bool:
        """Publish ``text`` as ``path`` unless it exists; False if it did.

        The text is written to a hidden file beside ``path`` first and appears
        under its name whole, or not at all: by a hard link on a mounted folder
        (a link refuses an existing name), elsewhere by a rename that does not
        overwrite, which HDFS does in one step.  A crash leaves only a hidden
        file that no reader looks at.
        """
        folder, name = path.rsplit("/", 1)
        hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.write_text(hidden, text)
        if str(self._fs.getScheme()) == "file":
            local = [self._p(p).toUri().getPath() for p in (hidden, path)]
            try:
                os.link(*local)
                return True
            except FileExistsError:
                return False
            finally:
                self._fs.delete(self._p(hidden), False)
        fs = self._jvm.org.apache.hadoop.fs
        keep = self._gateway.new_array(fs.Options.Rename, 1)
        keep[0] = getattr(fs.Options.Rename, "NONE")
        try:
            fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(
                self._p(hidden), self._p(path), keep)
            return True
        except Py4JJavaError as exc:
            self._fs.delete(self._p(hidden), False)
            if "FileAlreadyExists" in exc.java_exception.getClass().getName():
                return False
            raise

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._p(path), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._p(path))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def list_names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._p(path)))

    def rename(self, src: str, dst: str) -> bool:
        return bool(self._fs.rename(self._p(src), self._p(dst)))

    def size(self, path: str) -> int:
        return int(self._fs.getFileStatus(self._p(path)).getLen())

    def qualify(self, path: str) -> str:
        return str(self._fs.makeQualified(self._p(path)).toString())


@dataclass
class Commit:
    number: int
    meta: dict


class Lake:
    """Committed tables under one shared root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = FileSystem(spark, self.root)
        self.fs.mkdirs(f"{self.root}/_commits")

    # -- reading -------------------------------------------------------------
    def commits(self) -> list[Commit]:
        out = []
        for name in self.fs.list_names(f"{self.root}/_commits"):
            if name.endswith(".json") and not name.startswith("."):
                meta = json.loads(self.fs.read_text(f"{self.root}/_commits/{name}"))
                out.append(Commit(int(name[:-5]), meta))
        return out

    def last_commit(self) -> int:
        names = [n for n in self.fs.list_names(f"{self.root}/_commits")
                 if n.endswith(".json") and not n.startswith(".")]
        return max((int(n[:-5]) for n in names), default=0)

    def read(self, table: str, schema: StructType, as_of: int | None = None,
             commits: list[Commit] | None = None) -> DataFrame:
        """All committed rows of ``table`` (optionally as of a commit number, or
        by a commit list read before, for several tables at one moment)."""
        dirs = []
        for c in self.commits() if commits is None else commits:
            if as_of is not None and c.number > as_of:
                continue
            for d in c.meta.get("tables", {}).get(table, []):
                dirs.append(f"{self.root}/tables/{table}/{d}")
        if not dirs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*dirs)

    def batch_ids(self, stream: str) -> set:
        return {c.meta["batch"][1] for c in self.commits()
                if c.meta.get("batch") and c.meta["batch"][0] == stream}

    # -- writing -------------------------------------------------------------
    def stage(self, table: str, df: DataFrame) -> str:
        """Write ``df`` as a new, not yet committed directory of ``table``."""
        token = uuid.uuid4().hex
        # hashes in hex are half as long with a coder of entropy
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{self.root}/tables/{table}/{token}")
        return token

    def scratch(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """Write ``df`` once to a staging folder of this lake and return it read
        back with its row count (measured during the write).  Cuts the lineage:
        later steps read files, so a lost executor never recomputes the source."""
        path = f"{self.root}/staging/{name}-{uuid.uuid4().hex}"
        obs = Observation(f"scratch_{name}_{uuid.uuid4().hex[:8]}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), int(obs.get["rows"])

    def commit(self, staged: dict[str, list[str]], info: dict | None = None,
               batch: tuple[str, int] | None = None, guard: tuple[str, ...] = (),
               since: int | None = None) -> int:
        """Publish staged directories atomically under the next commit number.

        With ``guard``/``since`` the publish is optimistic-concurrency checked:
        it is refused when any commit after ``since`` touched a guarded table
        (another run of the same pipeline got there first).  The check and the
        create-if-absent of the next number repeat until the number is ours, so
        nothing can slip in between them.
        """
        meta = {"tables": staged, "info": info or {}}
        if batch is not None:
            meta["batch"] = list(batch)
        while True:
            number = self.last_commit() + 1
            if guard and since is not None:
                for c in self.commits():
                    if c.number > since and any(t in c.meta.get("tables", {}) for t in guard):
                        raise ConcurrentCommit("pipeline_already_running")
            if self.fs.create_new(f"{self.root}/_commits/{number:020d}.json", json.dumps(meta)):
                return number   # else another writer took it: an unguarded commit takes the next one

    def append(self, frames: dict[str, DataFrame], info: dict | None = None,
               batch: tuple[str, int] | None = None) -> int:
        """Stage every frame, then publish them in one commit."""
        staged = {name: [self.stage(name, df)] for name, df in frames.items()}
        return self.commit(staged, info, batch)
