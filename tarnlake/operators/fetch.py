"""Polite fetching: one task per server slot, adaptive rate, bounded retries."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.columns import is_license_full, or_placeholder
from tarnlake.functions.rates import REQUEST_FAILED, UNDECODABLE, Rate, enough_time, wants_retry
from tarnlake.operators.codecs import Codecs, Undecided, format_of
from tarnlake.operators.imaging import process
from tarnlake.operators.placement import place_lines

#: Seconds of one request.
TIMEOUT = 5
# What a fetched URL ends as.
SUCCESS, ERROR, UNDECIDED = "success", "error", "undecided"
_ITEM = "server_name string, partition_id int, uuid string, source_id string, identifier string, is_license_full boolean, license string, source string, title string"
_IMAGE = "original_size array<long>, resized_size array<long>, hashsum_original string, hashsum_resized string, image binary"
#: A result of any kind. ``slot`` and ``place``: the line and the order in it in which it came, for the rate that a server was last asked at. ``encoded``: an undecided image as it came.
RESULT = f"kind string, {_ITEM}, {_IMAGE}, retry_count int, error_code int, error_msg string, format string, encoded binary, rate double, slot int, place long"


class FetchFailed(Exception):
    def __init__(self, code: int, message: str):
        super().__init__(message)
        self.code = code


class PastDeadline(Exception):
    """Time is up: the task ends, and batches that it hasn't finished are left to the next layer."""


def http_get(header: dict[str, str], pool: int = 10, timeout: float = TIMEOUT) -> Callable[[str], bytes]:
    """A fetcher with one session that keeps up to ``pool`` connections, as many as the rate allows at once. Redirects are followed and content encodings undone."""
    import requests
    from requests.adapters import HTTPAdapter
    from urllib3.util.retry import Retry

    session = requests.Session()
    session.headers.update(header)
    adapter = HTTPAdapter(pool_connections=pool, pool_maxsize=pool, max_retries=Retry(total=5, backoff_factor=0.1, status_forcelist=(500, 502, 503, 504)))
    session.mount("http://", adapter)
    session.mount("https://", adapter)

    def get(url: str) -> bytes:
        try:
            answer = session.get(url, timeout=timeout)
        except requests.RequestException as error:
            raise FetchFailed(REQUEST_FAILED, str(error)) from error
        except Exception as error:  # what a URL can't be made into is that row's error, not the task's
            raise FetchFailed(UNDECODABLE, f"{type(error).__name__}: {error}") from error
        if answer.status_code >= 400:
            raise FetchFailed(answer.status_code, f"{answer.status_code} {answer.reason}")
        return answer.content

    return get


def _one(get: Callable[[str], bytes], url: str, limit: int, codecs: Codecs | None) -> tuple[dict, float]:
    began = time.monotonic()
    data = get(url)
    try:
        return process(data, limit, codecs) | {"kind": SUCCESS}, time.monotonic() - began
    except Undecided as error:
        return {"kind": UNDECIDED, "format": error.kind, "encoded": data, "error_msg": str(error)}, time.monotonic() - began
    except Exception as error:  # whatever a decoder makes of bad data
        raise FetchFailed(UNDECODABLE, str(error) or type(error).__name__) from error


def fetch_all(urls: list[str], get: Callable[[str], bytes], rate: Rate, image_size: int, deadline: float | None = None, clock=time.monotonic, sleep=time.sleep, codecs: Codecs | None = None) -> Iterator[tuple[int, dict]]:
    """``(place, result)`` of every URL as it is done. One request starts every 1 / rate seconds, and at most ``rate.high`` are open; retried ones go to the end of the line."""
    line = deque((i, 0) for i in range(len(urls)))
    open_: dict = {}
    with ThreadPoolExecutor(max_workers=max(1, int(rate.high))) as pool:
        while line or open_:
            if deadline is not None and clock() > deadline:
                for f in open_:
                    f.cancel()
                raise PastDeadline
            if line and len(open_) < max(1, int(rate.high)):
                i, tries = line.popleft()
                open_[pool.submit(_one, get, urls[i], image_size, codecs)] = (i, tries)
                sleep(1 / rate.value)
            done, _ = wait(open_, timeout=0 if line and len(open_) < rate.high else 1, return_when=FIRST_COMPLETED)
            for f in done:
                i, tries = open_.pop(f)
                try:
                    result, seconds = f.result()
                    rate.succeeded(seconds)
                    yield i, result | {"retry_count": tries}
                except FetchFailed as error:
                    if wants_retry(error.code, tries + 1):
                        rate.retried()
                        line.append((i, tries + 1))
                    else:
                        counted = tries + (error.code not in (UNDECODABLE,) and wants_retry(error.code, 0))
                        yield i, {"kind": ERROR, "retry_count": counted, "error_code": error.code, "error_msg": str(error)}


def as_items(urls: DataFrame) -> DataFrame:
    """Download items: what a result needs of a URL row. Missing optional columns are null, blank licence fields the placeholder."""
    has = lambda c: F.col(c).cast("string") if c in urls.columns else F.lit(None).cast("string")
    full = is_license_full(has("license"), has("source"), has("title"))
    return urls.select("server_name", F.col("partition_id").cast("int").alias("partition_id"), "uuid", F.coalesce(has("source_id"), F.lit("None")).alias("source_id"), "identifier", full.alias("is_license_full"), *[or_placeholder(has(c)).alias(c) for c in ("license", "source", "title")])


def assigned_batches(assignments: DataFrame) -> DataFrame:
    """``(server_name, partition_id, rank, rate_limit, slots)``: each batch of the half-open ranges (server_name, partition_id_from, partition_id_to, rank, rate_limit), and over how many workers its server is spread.

    So URLs meet ranges by an equal key, and a server of a thousand ranges costs its URLs nothing. A batch in several ranges is the smallest rank's.
    Batches outnumber the ranges that Spark judges sizes by, so neither this join nor one with what it returns (which callers hint, too) may be a broadcast.
    """
    slots = assignments.groupBy("server_name").agg(F.count_distinct("rank").alias("slots"))
    ids = F.explode(F.sequence("partition_id_from", F.col("partition_id_to") - 1)).alias("partition_id")
    one = assignments.where("partition_id_from < partition_id_to").select("server_name", ids, "rank", "rate_limit").groupBy("server_name", "partition_id").agg(F.min(F.struct("rank", "rate_limit")).alias("x"))
    return one.join(slots.hint("merge"), "server_name").select("server_name", F.col("partition_id").cast("int").alias("partition_id"), "x.rank", "x.rate_limit", "slots")


def unfinished(urls: DataFrame, results: DataFrame) -> DataFrame:
    """The ``urls`` (server_name, partition_id, uuid, ...) that have no row in ``results`` yet, of whatever run."""
    keys = ["server_name", "partition_id", "uuid"]
    return urls.join(results.select(*keys), keys, "left_anti")


def line_loads(todo: DataFrame) -> DataFrame:
    """``(server_name, rank, load)``: seconds that each line of ``todo`` (server_name, rank, start_rate per line) takes at the rate that it starts with."""
    return todo.groupBy("server_name", "rank").agg((F.count(F.lit(1)) / F.greatest(F.first("start_rate"), F.lit(1.0))).alias("load"))


def fetch(
    urls: DataFrame,
    assignments: DataFrame,
    image_size: int,
    header: dict[str, str] | None = None,
    rate_multiplier: float = 0.5,
    seconds: float | None = None,
    write_seconds: float = 0,
    getter: Callable[[dict, int], Callable[[str], bytes]] = http_get,
    rows_at_once: int = 64,
    results: DataFrame | None = None,
    rates: DataFrame | None = None,
    codecs: Codecs | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Fetch the assigned batches: rows of :data:`RESULT`, their ``kind`` telling success, error and undecided apart.

    ``assignments``: (server_name, partition_id_from, partition_id_to, rate_limit, main_rank, rank). A task owns whole (server, slot) lines and fetches their batches in order, so no server is asked by two tasks beyond its
    slots, and the rate is divided by those. Lines are dealt to tasks by the time they take. ``rates`` (server_name, rate), what servers were last asked at, come before the assignment's rate; after each batch the bounds are
    drawn around the rate reached. URLs with a row in ``results`` (server_name, partition_id, uuid) aren't asked for again. Results leave in small pieces; nothing holds a batch. A retried task fetches again: write the
    result, then enter it in the ledger. Run with speculation off. With ``seconds``, counted from this call for all tasks alike, a task starts no piece that it can't fetch and write in the time left, and stops when time is
    up; :func:`finished_batches` tells which batches are whole.
    """
    items, batches = as_items(urls), assigned_batches(assignments)
    if results is not None:
        items = unfinished(items, results)
    known = batches.join(rates.select("server_name", "rate"), "server_name", "left") if rates is not None else batches.withColumn("rate", F.lit(None).cast("double"))
    known = known.select("server_name", "partition_id", "rank", (F.greatest(F.coalesce("rate", "rate_limit"), F.lit(1.0)) / F.col("slots")).alias("start_rate"))
    todo = items.join(known.hint("merge"), ["server_name", "partition_id"])
    n = tasks or max(1, urls.sparkSession.sparkContext.defaultParallelism)
    placed = place_lines(line_loads(todo), n, "server_name", "rank")
    lines = todo.join(placed, ["server_name", "rank"]).repartitionById(n, F.col("task")).sortWithinPartitions("server_name", "rank", "partition_id", "uuid").drop("task")
    header = header or {}
    until = None if seconds is None else time.time() + seconds

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        line = at = rate = get = None
        place, pool = 0, 0
        deadline = None if until is None else time.monotonic() + until - time.time()
        for frame in frames:
            for (server, rank, batch), part in frame.groupby(["server_name", "rank", "partition_id"], sort=False, dropna=False):
                if line != (server, rank):
                    line, at, place = (server, rank), batch, 0
                    rate, get, pool = Rate.around(max(1.0, part["start_rate"].iloc[0]), rate_multiplier), None, 0
                elif at != batch:
                    at, rate = batch, Rate.around(rate.value, rate_multiplier)
                if get is None or int(rate.high) > pool:
                    pool = int(rate.high)
                    get = getter(header, pool)
                rows = part.to_dict("records")
                if deadline is not None and not enough_time(rate.value, deadline - time.monotonic(), len(rows), write_seconds):
                    continue
                kept = []
                try:
                    for i, result in fetch_all([r["identifier"] for r in rows], get, rate, image_size, deadline, codecs=codecs):
                        kept.append(rows[i] | result | {"rate": rate.value, "slot": rank, "place": place})
                        place += 1
                        if len(kept) == rows_at_once:
                            yield _frame(kept)
                            kept = []
                except PastDeadline:
                    pass
                if kept:
                    yield _frame(kept)

    return lines.mapInPandas(run, RESULT)


_COLUMNS = [x.strip().split(" ")[0] for x in RESULT.split(", ")]


def _frame(rows: list[dict]) -> pd.DataFrame:
    """Rows as Arrow-ready columns; what a row lacks is None."""
    return pd.DataFrame({c: pd.Series([r.get(c) for r in rows], dtype="Int32" if c in ("error_code", "retry_count") else object) for c in _COLUMNS})


def decode_kept(kept: DataFrame, image_size: int, codecs: Codecs | None = None) -> DataFrame:
    """Results for those images kept as undecided (:data:`RESULT`) that some decoder knows by now. Nothing is fetched."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                result, _ = _settled(row["encoded"], image_size, codecs)
                if result:
                    out.append(row | {"format": None, "encoded": None, "error_msg": None} | result)
            if out:
                yield _frame(out)

    return kept.where(F.col("kind") == UNDECIDED).select(*_COLUMNS).mapInPandas(run, RESULT)


def _settled(data: bytes, image_size: int, codecs: Codecs | None) -> tuple[dict | None, str | None]:
    try:
        return process(data, image_size, codecs) | {"kind": SUCCESS}, None
    except Undecided as error:
        return None, error.kind
    except Exception as error:
        return {"kind": ERROR, "error_code": UNDECODABLE, "error_msg": str(error) or type(error).__name__}, format_of(data)


# What a table of each kind shows of a result.
SHOWN = {
    SUCCESS: ["uuid", "source_id", "identifier", "is_license_full", "license", "source", "title", "original_size", "resized_size", "hashsum_original", "hashsum_resized", "image", "server_name", "partition_id"],
    ERROR: ["uuid", "identifier", "retry_count", "error_code", "error_msg", "server_name", "partition_id"],
    UNDECIDED: ["uuid", "identifier", "format", "encoded", "server_name", "partition_id"],
}


def finished_batches(urls: DataFrame, results: DataFrame) -> DataFrame:
    """``(server_name, partition_id)`` of those batches of ``urls`` of which every URL ended as a success or an error, in whichever runs. One with an undecided image isn't finished."""
    wanted = urls.select("server_name", F.col("partition_id").cast("int").alias("partition_id"), "uuid")
    left = unfinished(wanted, results.where(F.col("kind").isin(SUCCESS, ERROR)))
    return wanted.select("server_name", "partition_id").distinct().join(left, ["server_name", "partition_id"], "left_anti")


def last_rates(results: DataFrame) -> DataFrame:
    """``(server_name, rate)``: the sum over a server's lines of the rate at which each asked last."""
    last = results.groupBy("server_name", "slot").agg(F.max_by("rate", "place").alias("rate"))
    return last.groupBy("server_name").agg(F.sum("rate").alias("rate"))


def newest_rates(rates: DataFrame) -> DataFrame:
    """``(server_name, rate)`` of the last run of each server in (server_name, rate, run_id)."""
    return rates.groupBy("server_name").agg(F.max_by("rate", "run_id").alias("rate"))
