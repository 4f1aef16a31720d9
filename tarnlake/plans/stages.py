"""The two entry points: download images, and apply a tool to what was downloaded."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnlake import schema
from tarnlake.operators import batching, imaging, ledger, recipes, scheduling, tools
from tarnlake.operators import fetch as fetching
from tarnlake.operators.codecs import Codecs
from tarnlake.plans.checkpoint import Checkpoint
from tarnlake.plans.config import Config
from tarnlake.plans.staging import staged
from tarnlake.sources import sinks, tables

log = logging.getLogger(__name__)
# Names of the stages in the checkpoint.
DOWNLOAD_STAGES = ("batched", "profiled", "schedules_created", "finished")
TOOL_STAGES = ("filtered", "applied")
_RATES = "server_name string, rate double, run_id long"


class Unchanged(RuntimeError):
    """A run completed nothing though batches are left. ``suppress_unchanged_error`` makes that a plain False."""


class Downloader:
    """Batches, profiles, schedules and layers of fetching under one output root. Nothing is ever deleted there but by an explicit reset of a stage's own table."""

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        self.checkpoint = Checkpoint(spark, config.path("inner_checkpoint_file"), dict.fromkeys(DOWNLOAD_STAGES, False))

    def _path(self, name: str) -> str:
        return f"{self.config.path('schedules_folder')}/{name}"

    def _table(self, name: str, kind) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(name))
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(kind).parquet(self._path(name)) if there else self.spark.createDataFrame([], kind)

    def _log_run(self, stage: str, run_id: int = 0) -> None:
        """One row in the run log: when which stage was done."""
        self.spark.createDataFrame([(stage, run_id)], "stage string, run_id long").withColumn("finished_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self._path("runs"))

    def reset(self, stage: str) -> None:
        """Have a stage done again. Of its own tables, those that a rerun wouldn't replace are deleted; nothing else is."""
        self.checkpoint[stage] = False
        if stage == "batched":
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.config.path('tools_folder')}/uuid_ref")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    @property
    def store(self) -> sinks.ResultStore:
        return sinks.ResultStore(self.spark, self.config.path("images_folder"), fetching.RESULT)

    def results(self, kind: str) -> DataFrame:
        """What was fetched and ended as ``kind``: successes, errors, or images that nobody could decode yet. One that was decided later is no longer undecided."""
        rows = self.store.read()
        found = rows.where(F.col("kind") == kind)
        if kind == fetching.UNDECIDED:
            found = fetching.unfinished(found, rows.where(F.col("kind") != kind))
        return found.select(*fetching.SHOWN[kind])

    def recheck(self) -> None:
        """Write the ledger anew from the results on disk, whatever it said before."""
        rows = self.store.read()
        last = rows.groupBy("server_name", "partition_id").agg(F.max(F.substring_index("run", "-", 1).cast("long")).alias("run_id"))
        urls = tables.url_batches(self.spark, self.config.path("urls_folder"))
        found = fetching.finished_batches(urls, rows).join(last, ["server_name", "partition_id"]).select("server_name", "partition_id", F.lit(ledger.COMPLETED).alias("status"), "run_id")
        staged(found, "ledger").write.mode("overwrite").parquet(self._path("ledger"))

    def batch(self) -> None:
        """Recipe, batches, and the table of URL batches."""
        c = self.config
        make = recipes.get_recipe(c.initializer_type)
        raw = self.spark.read.parquet(c.path_to_input) if c.initializer_type.startswith("tol") else tables.load_table(self.spark, c.path_to_input)
        options = {}
        if c.initializer_type.startswith("tol"):
            options["included_sources"] = c.extra["included_sources"]
        if c.initializer_type == "tol200m_general" and c.extra.get("excluded_servers_path"):
            options["excluded_servers"] = tables.ignored_servers(self.spark, c.extra["excluded_servers_path"])
        rows = make(raw, **options)
        rows = rows if "server_name" in rows.columns else batching.with_server(rows)
        sinks.write_url_batches(batching.assign_batches(rows, c.parameter("batch_size", 10_000)), c.path("urls_folder"))
        batching.without_server(rows).select("identifier").write.mode("overwrite").parquet(self._path("no_server"))
        if c.initializer_type == "tol200m_fathomNet":
            boxes = self.spark.read.parquet(c.extra["bounding_box_information_path"])
            recipes.uuid_reference(raw, c.extra["included_sources"], boxes).write.parquet(f"{c.path('tools_folder')}/uuid_ref")

    def profile(self) -> None:
        batches = tables.url_batches(self.spark, self.config.path("urls_folder"))
        sinks.write_profiles(batching.server_profiles(batches, self.config.parameter("default_rate_limit", 10)), self.config.path("profiles_table"))

    def profiles(self) -> DataFrame:
        return tables.csv_folder(self.spark, self.config.path("profiles_table"), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.PROFILES))

    def status(self) -> DataFrame:
        return ledger.latest_status(self._table("ledger", schema.LEDGER))

    def schedule(self) -> None:
        """Servers with work left, by the rules, in packed groups."""
        c = self.config
        left = ledger.remaining_work(self.profiles(), self.status())
        chosen = scheduling.with_nodes(left, c.schedule_rules)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(c.path("ignored_table"))
        if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            chosen = scheduling.not_ignored(chosen, tables.ignored_servers(self.spark, c.path("ignored_table")))
        staged(scheduling.create_schedule(chosen, c.workers), "groups").coalesce(1).write.mode("overwrite").parquet(self._path("groups"))

    def assignments(self, group: DataFrame, status: DataFrame) -> DataFrame:
        """One layer of one group: what is left of each server, in blocks, dealt to workers."""
        servers = group.select("server_name", "nodes", "process_per_node", F.lit(0).alias("start_index"), (F.col("total_batches") - 1).alias("end_index"), (F.col("nodes") * F.col("process_per_node")).alias("blocks"))
        ids = scheduling.ids_to_download(servers, ledger.done_batches(status))
        ranges = scheduling.as_intervals(scheduling.with_blocks(ids, servers), "server_name", "block")
        known = ledger.with_one(group.join(ranges, "server_name"), self.profiles().select("server_name", "rate_limit"), "server_name")
        return scheduling.assign_schedules(known, self.config.workers).drop("schedule_id")

    def codecs(self) -> Codecs:
        return Codecs(self.config.parameter("codecs", None))

    def decode_kept(self, run_id: int) -> None:
        """Settle what was fetched before and can be decoded now."""
        rows = self.store.read()
        kept = rows.where(F.col("kind") == fetching.UNDECIDED)
        if kept.isEmpty():
            return
        # Only folders of batches with such images are opened.
        decided = rows.where(F.col("kind") != fetching.UNDECIDED).join(kept.select("server_name", "partition_id").distinct(), ["server_name", "partition_id"], "left_semi")
        open_ = fetching.unfinished(kept, decided)
        if open_.isEmpty():
            return
        name = self.store.write(fetching.decode_kept(open_, self.config.parameter("image_size", 1024), self.codecs()), run_id)
        self.store.commit(name, run_id)

    def download_layer(self, group: DataFrame, run_id: int, getter: Callable = fetching.http_get) -> bool:
        """Fetch what is left of a group once. Returns whether the ledger moved."""
        c, status = self.config, self.status()
        todo = staged(self.assignments(group, status).withColumn("layer", F.lit(run_id)), "assignments")
        if todo.isEmpty():
            return False
        todo.write.mode("append").parquet(self._path("assignments"))
        self.decode_kept(run_id)
        urls = tables.url_batches(self.spark, c.path("urls_folder"))
        batches = fetching.assigned_batches(todo).select("server_name", "partition_id")
        known = lambda: self.store.read().join(batches, ["server_name", "partition_id"], "left_semi")  # noqa: E731  folders of other batches aren't opened
        rates = fetching.newest_rates(self._table("rates", _RATES))
        fetched = fetching.fetch(urls, todo, c.parameter("image_size", 1024), c.header, c.parameter("rate_multiplier", 0.5), c.parameter("layer_seconds", None), c.parameter("write_seconds", 0), getter, results=known(), rates=rates, codecs=self.codecs())
        counts = Observation("fetched")
        kinds = [F.count_if(F.col("kind") == k).alias(k) for k in fetching.SHOWN]
        # Images leave their task once, into the folder that readers see after the commit.
        name = self.store.write(fetched.observe(counts, *kinds), run_id)
        log.info("layer %s: %s", run_id, counts.get)
        self.store.commit(name, run_id)
        mine = self.store.read(name)
        fetching.last_rates(mine).select("server_name", "rate", F.lit(run_id).cast("long").alias("run_id")).write.mode("append").parquet(self._path("rates"))
        # The ledger row comes after the data: a crash before it only means that the next layer finds nothing left to fetch of the batch, and enters it.
        wanted = urls.join(batches, ["server_name", "partition_id"], "left_semi")
        done = staged(fetching.finished_batches(wanted, known()), "finished").withColumn("status", F.lit(ledger.COMPLETED)).withColumn("run_id", F.lit(run_id).cast("long"))
        # Batches that were begun but aren't whole failed in this layer; the next goes on with them.
        begun = mine.select("server_name", "partition_id").distinct().join(done, ["server_name", "partition_id"], "left_anti")
        failed = begun.withColumn("status", F.lit(ledger.FAILED)).withColumn("run_id", F.lit(run_id).cast("long"))
        done.unionByName(failed).write.mode("append").parquet(self._path("ledger"))
        return not done.isEmpty()

    def run(self, getter: Callable = fetching.http_get) -> bool:
        """All stages that aren't done, then up to ``num_downloads`` layers of every group. True once nothing is left.

        ``layer_seconds`` bounds a layer: what isn't fetched by then is left to the next."""
        for stage, work in (("batched", self.batch), ("profiled", self.profile), ("schedules_created", self.schedule)):
            if not self.checkpoint[stage]:
                work()
                self.checkpoint[stage] = True
                self._log_run(stage)
        groups = self.spark.read.schema(schema.SCHEDULE).parquet(self._path("groups"))
        ids = [r[0] for r in groups.select("schedule_id").distinct().orderBy("schedule_id").collect()]
        last = self._table("ledger", schema.LEDGER).agg(F.max("run_id")).first()[0] or 0
        moved = False
        for layer in range(1, max(1, self.config.parameter("num_downloads", 1)) + 1):
            now = [self.download_layer(groups.where(F.col("schedule_id") == i), last + layer, getter) for i in ids]
            moved |= any(now)
            self._log_run("layer", last + layer)
            if not any(now):
                break
        self.checkpoint["finished"] = ledger.incomplete_servers(groups, self.status(), self.profiles()).isEmpty()
        if not (moved or self.checkpoint["finished"] or self.config.suppress_unchanged_error):
            raise Unchanged("no batch was completed, and some are left")
        return self.checkpoint["finished"]


def download_images(config: str | Config, spark: SparkSession | None = None, reset: tuple[str, ...] = (), getter: Callable = fetching.http_get) -> bool:
    """Run the download of a configuration; ``reset`` names stages to do again."""
    spark = spark or SparkSession.builder.config("spark.speculation", "false").getOrCreate()
    job = Downloader(spark, config if isinstance(config, Config) else Config.from_path(config))
    for stage in reset:
        job.reset(stage)
    return job.run(getter)


def apply_tools(config: str | Config, tool: str, spark: SparkSession | None = None, reset: bool = False) -> int:
    """Run one tool over the current version of the images and publish the next, in which only the partitions that the tool changes are written. Returns the version's number; a tool that is done isn't run again unless
    ``reset``. The first tool takes the downloaded results over as version 1 as they are, without those of later runs."""
    spark = spark or SparkSession.builder.getOrCreate()
    config = config if isinstance(config, Config) else Config.from_path(config)
    table = sinks.VersionedTable(spark, f"{config.path('tools_folder')}/images")
    done = Checkpoint(spark, f"{config.path('tools_folder')}/{tool}.yaml", dict.fromkeys(TOOL_STAGES, False))
    if done["applied"] and not reset:
        return table.version()
    if not table.version():
        store = sinks.ResultStore(spark, config.path("images_folder"), fetching.RESULT)
        kind = store.read().select(*fetching.SHOWN[fetching.SUCCESS]).schema
        table.adopt(store.base, store.folders(), store.schema, f"kind = '{fetching.SUCCESS}'", kind, "server_name", "partition_id")
    base = table.version()
    rows = table.read(base)
    if tool == "resize":
        limit = int(config.tools_parameters["new_resize_size"])
        touched = staged(rows.where(F.array_max("resized_size") > limit).select("server_name", "partition_id").distinct(), "touched-resize")
        change = lambda some: imaging.resize_stored(some, limit)
    else:
        options = {"threshold_size": int(config.tools_parameters["threshold_size"])} if tool == "size_based" else {}
        rejects = staged(tools.get_tool(tool)(rows, **options), f"rejects-{tool}")
        sinks.write_rejects(rejects, f"{config.path('tools_folder')}/{tool}/filter_table")
        done["filtered"] = True
        touched = staged(tools.touched_partitions(rejects), f"touched-{tool}")
        change = lambda some: tools.without(some, rejects)
    version = table.rewrite(change(rows.join(touched, ["server_name", "partition_id"], "left_semi")), touched, base=base)
    done["applied"] = True
    return version
