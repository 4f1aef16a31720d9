"""Which stages are done: a small YAML file in the output root, replaced as a whole on each change.

The new file is complete before the old one goes, so after a crash in between the new one is read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Checkpoint:
    def __init__(self, spark: SparkSession, path: str, defaults: dict[str, bool]):
        self._spark, self._path = spark, path
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        self.values = dict(defaults)
        if found := next((x for x in (path, f"{path}.new", path) if self._files.exists(spark._jvm.org.apache.hadoop.fs.Path(x))), None):
            import yaml

            text = "\n".join(r[0] for r in spark.read.text(found).collect())
            self.values |= {k: bool(v) for k, v in (yaml.safe_load(text) or {}).items() if k in defaults}

    def __getitem__(self, name: str) -> bool:
        return self.values[name]

    def __setitem__(self, name: str, value: bool) -> None:
        if name not in self.values:
            raise KeyError(name)
        self.values[name] = value
        new = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}.new")
        out = self._files.create(new, True)
        out.writeBytes("".join(f"{k}: {str(v).lower()}\n" for k, v in sorted(self.values.items())))
        out.close()
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self._path)
        self._files.delete(path, False)
        self._files.rename(new, path)
