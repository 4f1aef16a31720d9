"""Writing tables. Nothing here overwrites what a plan still reads."""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_url_batches(df: DataFrame, path: str) -> None:
    """URL batches in folders by server and partition. Rows meet by folder first, so a folder has few files; AQE splits a hot one."""
    df.hint("rebalance", "server_name", "partition_id").write.mode("overwrite").partitionBy("server_name", "partition_id").parquet(path)


def write_rejects(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_profiles(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


class ResultStore:
    """Fetched results, each written once: a run's folder, split by kind and batch, counts from the moment that its row in the list of commits is written, and never changes after.

    Spark's committer makes the files of finished tasks visible together; a folder whose job failed or whose row is missing is nobody's.
    """

    def __init__(self, spark: SparkSession, root: str, kind: str):
        self.spark, self.root, self.kind = spark, root.rstrip("/"), kind
        self._commits = f"{self.root}/commits"

    def _there(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    @property
    def base(self) -> str:
        return f"{self.root}/results"

    @property
    def schema(self) -> str:
        """Columns of a row, and the folder that it is in."""
        return f"{self.kind}, run string"

    def folders(self, name: str | None = None) -> list[str]:
        """Paths of what is committed, or of the one folder."""
        if name is not None:
            return [f"{self.base}/run={name}"]
        if not self._there(self._commits):
            return []
        return [f"{self.base}/run={r['folder']}" for r in self.spark.read.schema("folder string, run_id long").parquet(self._commits).orderBy("run_id", "folder").collect()]

    def write(self, rows: DataFrame, run_id: int) -> str:
        """Rows into a folder of their own, which nobody reads before :meth:`commit`. Returns its name."""
        name = f"{run_id}-{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").partitionBy("kind", "server_name", "partition_id").parquet(f"{self.base}/run={name}")
        return name

    def commit(self, name: str, run_id: int) -> None:
        self.spark.createDataFrame([(name, run_id)], "folder string, run_id long").coalesce(1).write.mode("append").parquet(self._commits)

    def read(self, name: str | None = None) -> DataFrame:
        """All committed rows, or those of one folder."""
        paths = self.folders(name)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.base).parquet(*paths)


class ConcurrentWrite(RuntimeError):
    """Somebody else published a version on which this one isn't based. Nothing that is published was touched."""


class VersionedTable:
    """A table whose writers publish versions, each a small pointer to immutable data.

    Data go to folders of unique names, so writers never meet there. Pointer n lists the layers of version n: whole tables and, above them, the partitions that later rewrites changed; a reader takes each partition from the
    last layer that has it. A pointer is created only if nobody has created it, in one step and with its whole content (a hard link on local files, a rename that doesn't replace elsewhere), and is never changed: of two
    writers from one version one wins, and the other goes on from there if it changed other partitions, or raises :class:`ConcurrentWrite`. After a crash, the old version stands.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._local = self._files.getScheme() == "file"

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def version(self) -> int:
        """The newest version; 0 where nothing was written."""
        if not self._files.exists(self._path("pointers")):
            return 0
        names = [x.getPath().getName() for x in self._files.listStatus(self._path("pointers"))]
        return max((int(x) for x in names if x.isdigit()), default=0)

    def pointer(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/pointers/{version}", wholetext=True).head()[0])

    def _create(self, version: int, text: str) -> bool:
        """Whether the pointer is ours. False if that version exists."""
        aside, target = self._path(f"pointers/next-{version}-{uuid.uuid4().hex}"), self._path(f"pointers/{version}")
        self._files.mkdirs(self._path("pointers"))
        if self._local:
            source, goal = (str(self._files.makeQualified(x).toUri().getPath()) for x in (aside, target))
            with open(source, "x") as file:
                file.write(text)
            try:
                os.link(source, goal)
                return True
            except FileExistsError:
                return False
            finally:
                os.remove(source)
        stream = self._files.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        jvm = self.spark._jvm
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration()).rename(aside, target, never)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
                raise
            self._files.delete(aside, False)
            return False

    def _publish(self, base: int, layers: list[dict], schema: StructType, partition_by: list[str], note: dict | None) -> bool:
        return self._create(base + 1, json.dumps({"layers": layers, "schema": schema.json(), "partition_by": partition_by, "note": note or {}}))

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or the one that is named."""
        pointer = self.pointer(self.version() if version is None else version)
        kind, keys = StructType.fromJson(json.loads(pointer["schema"])), pointer["partition_by"]
        out = None
        for layer in pointer["layers"]:
            rows = self._layer(layer, kind)
            if out is None or not layer.get("changed"):
                out = rows
                continue
            changed = self.spark.read.schema(StructType([kind[k] for k in keys])).parquet(f"{self.root}/{layer['changed']}")
            out = out.join(changed, reduce(and_, [out[k].eqNullSafe(changed[k]) for k in keys]), "left_anti").union(rows)
        return out

    def _layer(self, layer: dict, kind: StructType) -> DataFrame:
        if "folders" not in layer:
            return self.spark.read.schema(kind).parquet(f"{self.root}/{layer['data']}").select(kind.names)
        if not layer["folders"]:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.option("basePath", layer["base"]).schema(layer["schema"]).parquet(*layer["folders"]).where(layer["where"]).select(kind.names)

    def _data(self, df: DataFrame, partition_by: list[str]) -> str:
        name = f"data/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(f"{self.root}/{name}")
        return name

    def _given_up(self, base: int, *names: str) -> ConcurrentWrite:
        for name in names:
            self._files.delete(self._path(name), True)
        return ConcurrentWrite(f"version {base + 1} of {self.root} was published meanwhile")

    def adopt(self, base: str, folders: list[str], schema: str, where: str, kind: StructType, *partition_by: str) -> int:
        """A first version of files that are there already, read with ``schema`` from ``folders`` under ``base``: nothing is copied. The folders must not change any more."""
        layer = {"base": base, "folders": folders, "schema": schema, "where": where}
        if not self._publish(0, [layer], kind, list(partition_by), None):
            raise self._given_up(0)
        return 1

    def write(self, df: DataFrame, *partition_by: str, base: int | None = None, note: dict | None = None) -> int:
        """A whole new version after ``base``, which is the newest one unless given. ``note`` is kept in the pointer."""
        base = self.version() if base is None else base
        name = self._data(df, list(partition_by))
        if not self._publish(base, [{"data": name}], df.schema, list(partition_by), note):
            raise self._given_up(base, name)
        return base + 1

    def rewrite(self, df: DataFrame, changed: DataFrame, base: int | None = None, note: dict | None = None) -> int:
        """A new version in which the partitions of ``changed`` have the rows ``df``, made from version ``base`` (the newest unless given), and all others stay as and where they are.

        Where others published in between, it is published after them if none of them changed a partition of ``changed``.
        """
        base = self.version() if base is None else base
        pointer = self.pointer(base)
        kind, keys = StructType.fromJson(json.loads(pointer["schema"])), pointer["partition_by"]
        name, listed = self._data(df.select(kind.names), keys), f"changed/{uuid.uuid4().hex}"
        changed.select(*[F.col(k).cast(kind[k].dataType).alias(k) for k in keys]).distinct().coalesce(1).write.parquet(f"{self.root}/{listed}")
        while not self._publish(base, [*pointer["layers"], {"data": name, "changed": listed}], kind, keys, note):
            later = self.pointer(base + 1)
            if later["layers"][:-1] != pointer["layers"] or self._meet(listed, later["layers"][-1]["changed"], kind, keys):
                raise self._given_up(base, name, listed)
            base, pointer = base + 1, later
        return base + 1

    def _meet(self, one: str, two: str, kind: StructType, keys: list[str]) -> bool:
        a, b = (self.spark.read.schema(StructType([kind[k] for k in keys])).parquet(f"{self.root}/{x}") for x in (one, two))
        return not a.join(b, reduce(and_, [a[k].eqNullSafe(b[k]) for k in keys]), "left_semi").isEmpty()
