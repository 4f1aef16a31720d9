"""Dataset recipes: from a raw table to rows with uuid, identifier, source_id and what else the table has."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.columns import stable_id

# Fixed values.
FATHOM_LICENSE = "https://creativecommons.org/licenses/by-nc-nd/4.0/legalcode.en"

RECIPES: dict[str, Callable[..., DataFrame]] = {}


def recipe(name: str):
    """Register a recipe under the name that a configuration selects it by."""

    def add(f):
        if name in RECIPES:
            raise ValueError(f"recipe {name} is registered already")
        RECIPES[name] = f
        return f

    return add


def get_recipe(name: str) -> Callable[..., DataFrame]:
    if name not in RECIPES:
        raise ValueError(f"unknown recipe {name!r}; known: {sorted(RECIPES)}")
    return RECIPES[name]


def with_uuid(rows: DataFrame) -> DataFrame:
    return rows.withColumn("uuid", stable_id(F.col("source_id"), F.col("identifier")))


@recipe("gbif")
def gbif(raw: DataFrame) -> DataFrame:
    """Still images, by type or, where that is null, by format; no material citations. A null basisOfRecord drops the row."""
    image = (F.col("type") == "StillImage") | (F.col("type").isNull() & F.col("format").contains("image"))
    kept = raw.where(F.col("gbifID").isNotNull() & F.col("identifier").isNotNull() & image & ~F.col("basisOfRecord").contains("MATERIAL_CITATION"))
    return with_uuid(kept.withColumn("source_id", F.col("gbifID").cast("string")))


@recipe("fathom_net")
def fathom_net(raw: DataFrame) -> DataFrame:
    """Valid rows with an id and a URL. A flag that is no boolean drops the row."""
    kept = raw.where(F.col("uuid").isNotNull() & F.col("url").isNotNull() & F.col("valid").try_cast("boolean"))
    return with_uuid(kept.withColumnsRenamed({"uuid": "source_id", "url": "identifier"}).withColumn("license", F.lit(FATHOM_LICENSE)))


@recipe("lila")
def lila(raw: DataFrame) -> DataFrame:
    """Labelled rows with any of three cloud URLs; the first that is given counts."""
    url = F.coalesce("url_gcp", "url_aws", "url_azure")
    return with_uuid(raw.where(url.isNotNull() & (F.col("original_label") != "empty")).withColumn("identifier", url).withColumnRenamed("image_id", "source_id"))


@recipe("eol")
def eol(raw: DataFrame) -> DataFrame:
    names = {"EOL content ID": "source_id", "EOL Full-Size Copy URL": "identifier", "License Name": "license", "Copyright Owner": "owner"}
    return with_uuid(raw.where(F.col("EOL content ID").isNotNull() & F.col("EOL Full-Size Copy URL").isNotNull()).withColumnsRenamed(names))


@recipe("tol200m_general")
def tol_general(raw: DataFrame, included_sources: list[str], excluded_servers: DataFrame | None = None) -> DataFrame:
    """Rows of the listed sources, without those of excluded servers. The raw table brings its uuids."""
    from tarnlake.operators.batching import with_server

    kept = with_server(raw.where(F.col("data_source").isin(included_sources)).withColumnRenamed("source_url", "identifier"))
    return kept if excluded_servers is None else kept.join(excluded_servers.select("server_name"), "server_name", "left_anti")


def one_per_url(raw: DataFrame) -> DataFrame:
    """One row of each source_url, that with the smallest uuid, and an ``image_uuid`` of the URL. The smallest row is found by partial aggregation, whatever a URL's share."""
    others = [c for c in raw.columns if c not in ("source_url", "uuid")]
    first = raw.groupBy("source_url").agg(F.min_by(F.struct("uuid", *others), F.struct(F.col("uuid"), F.xxhash64(*others))).alias("r"))
    return first.select("source_url", "r.*", stable_id(F.col("source_url")).alias("image_uuid"))


@recipe("tol200m_fathomNet")
def tol_fathom(raw: DataFrame, included_sources: list[str]) -> DataFrame:
    """One row per URL of the listed sources, under a new uuid."""
    first = one_per_url(raw.where(F.col("data_source").isin(included_sources)))
    return first.withColumn("uuid", F.col("image_uuid")).drop("image_uuid").withColumnRenamed("source_url", "identifier")


def uuid_reference(raw: DataFrame, included_sources: list[str], boxes: DataFrame) -> DataFrame:
    """Every original row with a bounding box, and the uuid that its URL was given. A function of the URL alone, so no join to the kept rows is needed."""
    kept = raw.where(F.col("data_source").isin(included_sources) & F.col("source_url").isNotNull())
    return kept.select(stable_id(F.col("source_url")).alias("image_uuid"), "uuid", "source_id").join(boxes, "uuid")
