"""Reading raw inputs and the engine's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tarnlake.schema import SUCCESSES

# Separators in order of preference.
SEPARATORS = ("\t", ",", " ", "|", ";")


def sniff_separator(line: str) -> str:
    """The first separator, in order of preference, that a header line has."""
    for separator in SEPARATORS:
        if separator in line:
            return separator
    raise ValueError("no known separator in the first line")


def load_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A raw table by its extension: csv, tsv, txt (separator from the first line), else Spark's default format. Delimited text has a header and string columns unless a schema is given."""
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind in ("csv", "tsv", "txt"):
        first = spark.read.text(path).head() if kind == "txt" else None
        if kind == "txt" and first is None:
            raise ValueError(f"{path} is empty")
        separator = {"csv": ",", "tsv": "\t"}.get(kind) or sniff_separator(first[0])
        reader = spark.read.option("sep", separator).option("header", True)
        return (reader.schema(schema) if schema else reader).csv(path)
    return (spark.read.schema(schema) if schema else spark.read).load(path)


def optional_csv(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """A CSV side input with a header, or an empty table where no path is given."""
    return spark.read.option("header", True).schema(schema).csv(path) if path else spark.createDataFrame([], schema)


def ignored_servers(spark: SparkSession, path: str | None) -> DataFrame:
    """Distinct server names to leave alone. The column may be server_name or ServerName."""
    if not path:
        return spark.createDataFrame([], "server_name string")
    table = spark.read.option("header", True).csv(path)
    column = next((c for c in table.columns if c.replace("_", "").lower() == "servername"), None)
    if column is None:
        raise ValueError("the table of ignored servers has no column server_name")
    return table.select(table[column].alias("server_name")).distinct()


def csv_folder(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All CSV files of a folder as one table; empty where there are none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.option("header", True).schema(schema).csv(folder) if files.exists(path) else spark.createDataFrame([], schema)


def url_batches(spark: SparkSession, path: str, servers: list[str] | None = None) -> DataFrame:
    """The partitioned URL batches, pruned to servers if asked."""
    table = spark.read.parquet(path)
    return table.where(table["server_name"].isin(servers)) if servers is not None else table


def successes(spark: SparkSession, path: str) -> DataFrame:
    """Downloaded rows with partition columns from the folder names."""
    return spark.read.schema(SUCCESSES).option("basePath", path).parquet(path)
