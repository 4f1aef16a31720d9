"""Decoding, scaling and the fetch and tool pipelines over a local server."""

import hashlib
import struct
import threading
import zlib
from fractions import Fraction
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnlake.functions.rates import Rate
from tarnlake.operators import codecs, fetch, imaging, placement, tools
from tarnlake.plans import stages
from tarnlake.plans.config import Config


def png(pixels, colour=2, filters=None, palette=None):
    h, w = pixels.shape[:2]
    channels = pixels.shape[2] if pixels.ndim == 3 else 1
    flat = pixels.reshape(h, w * channels).astype(int)
    lines = b""
    for y in range(h):
        kind = (filters or [0] * h)[y]
        up = flat[y - 1] if y else np.zeros(w * channels, int)
        left = np.concatenate([np.zeros(channels, int), flat[y][:-channels]])
        corner = np.concatenate([np.zeros(channels, int), up[:-channels]])
        p = left + up - corner
        d = [abs(p - left), abs(p - up), abs(p - corner)]
        paeth = np.where((d[0] <= d[1]) & (d[0] <= d[2]), left, np.where(d[1] <= d[2], up, corner))
        guess = [0 * up, left, up, (left + up) // 2, paeth][kind]
        lines += bytes([kind]) + ((flat[y] - guess) % 256).astype(np.uint8).tobytes()
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0))
    return b"\x89PNG\r\n\x1a\n" + head + (chunk(b"PLTE", palette.tobytes()) if palette is not None else b"") + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


RGB = np.random.default_rng(0).integers(0, 256, (9, 7, 3)).astype(np.uint8)


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    assert np.array_equal(imaging.decode(png(RGB, filters=[kind] * 9)), RGB[:, :, ::-1])


def test_other_formats():
    grey, alpha = RGB[:, :, 0], np.concatenate([RGB, RGB[:, :, :1]], axis=2)
    assert np.array_equal(imaging.decode(png(grey, 0)), np.repeat(grey[:, :, None], 3, axis=2))
    assert np.array_equal(imaging.decode(png(alpha, 6)), RGB[:, :, ::-1])
    palette = RGB.reshape(-1, 3)[:8]
    assert np.array_equal(imaging.decode(png(grey % 8, 3, palette=palette)), palette[grey % 8][:, :, ::-1])
    assert np.array_equal(imaging.decode(b"P6 7 9 255\n" + RGB.tobytes()), RGB[:, :, ::-1])
    rows = np.zeros((9, 24), np.uint8)
    rows[:, :21] = RGB[::-1, :, ::-1].reshape(9, 21)
    bmp = b"BM" + bytes(8) + struct.pack("<IIiiHH", 54, 40, 7, 9, 1, 24) + bytes(24) + rows.tobytes()
    assert np.array_equal(imaging.decode(bmp), RGB[:, :, ::-1])
    for bad in (b"", b"<html>", png(RGB)[:60], b"P6 9 9 255\n12"):
        with pytest.raises(ValueError):
            imaging.decode(bad)


JPEG, GIF, TIFF = b"\xff\xd8\xff\xe0" + b"j" * 40, b"GIF89a" + b"g" * 40, b"II*\x00" + b"t" * 40


def stand_in():
    """A codec of a library that isn't here: any JPEG, GIF or TIFF is a picture of its bytes; one that ends in ``!`` is broken, one that ends in ``?`` a variant that it doesn't know."""

    def read(data):
        if data.endswith(b"!"):
            raise OSError("truncated")
        if data.endswith(b"?"):
            raise codecs.Unsupported("progressive")
        return np.frombuffer(data.ljust(60, b"."), np.uint8)[:60].reshape(4, 5, 3)

    return read


def test_codecs():
    assert [codecs.format_of(x) for x in (JPEG, GIF, TIFF, png(RGB), b"RIFF1234WEBPVP8 ", b"<html>", b"")] == ["jpeg", "gif", "tiff", "png", "webp", None, None]
    own = codecs.Codecs({"jpeg": stand_in, "gif": "tests.test_images:stand_in", "tiff": ["no_such_library:decoder", "tests.test_images:stand_in"]})
    for data in (JPEG, GIF, TIFF):
        assert np.array_equal(own.decode(data), stand_in()(data))
    with pytest.raises(codecs.Undecided, match="progressive"):
        own.decode(JPEG + b"?")
    with pytest.raises(ValueError, match="truncated"):
        own.decode(GIF + b"!")
    with pytest.raises(ValueError):
        codecs.Codecs({"jpg": stand_in})
    with pytest.raises(ValueError):
        codecs.Codecs({"tiff": lambda: lambda data: np.zeros((2, 2), np.uint8)}).decode(TIFF)
    import pickle

    assert codecs.Codecs().knows("png") and pickle.loads(pickle.dumps(codecs.Codecs({"gif": "tests.test_images:stand_in"}))).knows("gif")


@pytest.mark.parametrize("kind", ["jpeg", "gif", "tiff", "webp", "avif", "heif", "jpeg2000", "jpegxl", "exr", "hdr", "pnm"])
def test_a_format_that_nobody_decodes_is_undecided(kind, monkeypatch):
    for name in ("with_pillow", "with_opencv"):
        monkeypatch.setattr(codecs, name, lambda: (_ for _ in ()).throw(ImportError()))
    at, mark = codecs.MAGIC[kind][0]
    with pytest.raises(codecs.Undecided, match=kind):
        codecs.Codecs().decode(b"\0" * at + mark + b"x" * 30)
    lossless = struct.pack(">IIBBBBB", 4, 4, 16, 2, 0, 0, 0)
    with pytest.raises(codecs.Undecided, match="8 bits"):
        codecs.Codecs().decode(b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + lossless + b"1234" + struct.pack(">I", 0) + b"IEND1234")


def test_area_resize():
    image = np.arange(4 * 6 * 3, dtype=np.uint8).reshape(4, 6, 3)
    half = imaging.area_resize(image, 2, 3)
    assert np.array_equal(half, np.floor(image.reshape(2, 2, 3, 2, 3).mean(axis=(1, 3)) + 0.5))
    assert np.array_equal(imaging.area_resize(image, 4, 6), image)
    flat = np.full((7, 5, 3), 93, np.uint8)
    assert (imaging.area_resize(flat, 3, 2) == 93).all()
    assert imaging.fit_within(image, 6) is image and imaging.fit_within(image, 3).shape == (2, 3, 3) and imaging.fit_within(image.transpose(1, 0, 2), 3).shape == (3, 2, 3)
    with pytest.raises(ValueError):
        imaging.fit_within(np.zeros((1, 100, 3), np.uint8), 10)


@given(st.tuples(*[st.integers(1, 17)] * 4), st.integers(0, 1 << 30), st.sampled_from([1, 3, 64]))
@settings(max_examples=60, deadline=None)
def test_area_resize_is_exact(sides, seed, strip):
    """Against sums of fractions, whatever the strips; halves round up."""
    old_h, old_w, h, w = sides
    image = np.random.default_rng(seed).integers(0, 256, (old_h, old_w, 3)).astype(np.uint8)
    share = lambda old, new: [[max(Fraction(0), min(Fraction((i + 1) * old, new), c + 1) - max(Fraction(i * old, new), c)) for c in range(old)] for i in range(new)]
    rows, columns = share(old_h, h), share(old_w, w)
    before, imaging.STRIP_ROWS = imaging.STRIP_ROWS, strip
    try:
        got = imaging.area_resize(image, h, w)
    finally:
        imaging.STRIP_ROWS = before
    for y in range(h):
        for x in range(w):
            for k in range(3):
                mean = sum(a * b * int(image[r, c, k]) for r, a in enumerate(rows[y]) if a for c, b in enumerate(columns[x]) if b) / (Fraction(old_h, h) * Fraction(old_w, w))
                assert got[y, x, k] == (2 * mean + 1) // 2


@pytest.mark.parametrize("stack", [1, 5_000, 1 << 18])
def test_images_of_one_size_are_scaled_together(monkeypatch, stack):
    """Each as by itself, in as few passes as the stack's bytes allow."""
    rng, passes, one = np.random.default_rng(0), [], imaging.area_resize
    images = [rng.integers(0, 256, (37, 21, 3), dtype=np.uint8) for _ in range(50)]
    want = [imaging.fit_within(x, 16) for x in images]
    monkeypatch.setattr(imaging, "STACK_BYTES", stack)
    monkeypatch.setattr(imaging, "area_resize", lambda *a: passes.append(a) or one(*a))
    got = imaging.fit_alike([x.tobytes() for x in images], 37, 21, 16)
    assert got == [(x.shape[:2], x.tobytes()) for x in want] and len(passes) == -(-50 // max(1, stack // (37 * 21 * 3)))
    for h, w in ((0, 40), (1, 40)):
        with pytest.raises(ValueError, match="vanish"):
            imaging.fit_alike([b"x" * h * w * 3] * 2, h, w, 16)


def test_stored_images_of_many_sizes(spark):
    """Rows of several sizes in one batch, in any order, each as by itself; rows that can't be scaled stay."""
    rng = np.random.default_rng(1)
    rows = [(i, [int(h), int(w)], rng.integers(0, 256, h * w * 3, dtype=np.uint8).tobytes(), "old") for i, (h, w) in enumerate([(20, 30), (30, 20), (20, 30), (4, 4), (1, 40), (0, 40), (30, 20), (20, 30)])]
    rows += [(8, [20, 30], b"short", "old"), (9, None, b"x", "old"), (10, [20, 30], None, "old")]
    df = spark.createDataFrame(rows, "id int, resized_size array<long>, image binary, hashsum_resized string").coalesce(1)
    got = {r["id"]: (r["resized_size"], r["image"] and bytes(r["image"]), r["hashsum_resized"]) for r in imaging.resize_stored(df, 16).collect()}
    for i, size, image, _ in rows:
        if i in (0, 1, 2, 6, 7):
            small = imaging.fit_within(np.frombuffer(image, np.uint8).reshape(*size, 3), 16)
            assert got[i] == (list(small.shape[:2]), small.tobytes(), hashlib.md5(small.tobytes()).hexdigest())
        else:
            assert got[i] == (size, image, "old")


def test_area_resize_of_a_large_image():
    """100 megapixels: beside the image and the result, memory for a strip."""
    import tracemalloc

    image = np.random.default_rng(0).integers(0, 256, (10_000, 10_000, 3), dtype=np.uint8)
    tracemalloc.start()
    small = imaging.area_resize(image, 1000, 1000)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100e6 and np.array_equal(small[:9, :9], (image[:90, :90].reshape(9, 10, 9, 10, 3).sum(axis=(1, 3), dtype=np.int64) * 2 + 100) // 200)


def test_process():
    out = imaging.process(png(RGB), 5)
    assert out["original_size"] == [9, 7] and out["resized_size"] == [5, 3] and len(out["image"]) == 45
    assert out["hashsum_original"] == hashlib.md5(png(RGB)).hexdigest() and out["hashsum_resized"] == hashlib.md5(out["image"]).hexdigest()


class _Handler(BaseHTTPRequestHandler):
    calls: dict = {}

    def do_GET(self):  # noqa: N802
        name = self.path.strip("/").split("/")[0]
        n = self.calls[self.path] = self.calls.get(self.path, 0) + 1
        code, body = 200, png(RGB)
        if name == "missing" or name == "once429" and n == 1 or name == "busy":
            code = {"missing": 404}.get(name, 429)
        elif name == "text":
            body = b"no image"
        elif name in ("jpeg", "gif", "tiff"):
            body = {"jpeg": JPEG, "gif": GIF, "tiff": TIFF}[name]
        elif name == "moved":
            self.send_response(302)
            self.send_header("Location", "/ok/moved")
            self.end_headers()
            return
        self.send_response(code)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def server():
    _Handler.calls = {}
    httpd = ThreadingHTTPServer(("127.0.0.1", 0), _Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}"
    httpd.shutdown()


def test_fetch_all(server):
    kinds = ["ok", "missing", "once429", "busy", "text", "moved"]
    urls = [f"{server}/{k}/a" for k in kinds] + ["http://127.0.0.1:1/refused"]
    rate = Rate.around(200, 0.5)
    got = dict(fetch.fetch_all(urls[:6], fetch.http_get({}), rate, 100))
    assert {k: got[i]["kind"] == "success" for i, k in enumerate(kinds)} == {"ok": True, "missing": False, "once429": True, "busy": False, "text": False, "moved": True}
    assert [got[i].get("error_code") for i in range(6)] == [None, 404, None, 429, -2, None]
    assert [got[i]["retry_count"] for i in range(6)] == [0, 0, 1, 5, 0, 0]
    assert rate.low <= rate.value <= rate.high

    def refused(url):
        raise fetch.FetchFailed(-1, "refused")

    assert dict(fetch.fetch_all(urls[6:], refused, Rate.around(200, 0.5), 100))[0] == {"kind": "error", "retry_count": 5, "error_code": -1, "error_msg": "refused"}


def test_any_other_error_is_the_rows(monkeypatch):
    """A decoder that breaks in a way of its own costs one row, not the task."""

    def odd(data, limit, codecs):
        raise KeyError if data == b"x" else RuntimeError("odd")

    monkeypatch.setattr(fetch, "process", odd)
    got = dict(fetch.fetch_all(["x", "y"], str.encode, Rate.around(50, 0.5), 100))
    assert [(got[i]["kind"], got[i]["error_code"], got[i]["error_msg"]) for i in (0, 1)] == [("error", -2, "KeyError"), ("error", -2, "odd")]


def test_deadline(server):
    with pytest.raises(fetch.PastDeadline):
        list(fetch.fetch_all([f"{server}/ok/b"], fetch.http_get({}), Rate.around(10, 0.5), 100, deadline=0))


def _config(tmp_path, server, **more):
    return Config.from_dict(
        {
            "path_to_input": str(tmp_path / "raw.csv"),
            "path_to_output_folder": f"file://{tmp_path}/out",
            "initializer_type": "gbif",
            "downloader_parameters": {"num_downloads": 2, "workers_per_node": 2, "max_nodes": 2, "batch_size": 3, "image_size": 6, "default_rate_limit": 100, "header": "User-Agent: test"} | more,
            "tools_parameters": {"threshold_size": 8, "new_resize_size": 4},
        }
    )


def _raw(tmp_path, server):
    kinds = ["ok"] * 7 + ["missing", "text", "moved"]
    lines = [f"{i},{server}/{k}/{i},StillImage,image/png,HUMAN_OBSERVATION" for i, k in enumerate(kinds)]
    (tmp_path / "raw.csv").write_text("gbifID,identifier,type,format,basisOfRecord\n" + "\n".join(lines) + "\n99,nowhere,StillImage,,X\n")


def test_download_then_tools(spark, tmp_path, server):
    _raw(tmp_path, server)
    config = _config(tmp_path, server)
    assert stages.download_images(config, spark)
    job = stages.Downloader(spark, config)
    good, bad = job.results("success"), job.results("error")
    assert job.results("undecided").isEmpty()
    assert good.count() == 8 and sorted(r["error_code"] for r in bad.collect()) == [-2, 404]
    assert {tuple(r["resized_size"]) for r in good.collect()} == {(6, 4)}
    before = dict(_Handler.calls)
    assert stages.download_images(config, spark) and _Handler.calls == before  # nothing is left to fetch
    status = sorted(map(tuple, job.status().collect()))
    job.recheck()
    assert sorted(map(tuple, job.status().collect())) == status and len(status) == 3
    assert [r["stage"] for r in spark.read.parquet(f"{config.path('schedules_folder')}/runs").orderBy("finished_at").collect()][:3] == ["batched", "profiled", "schedules_created"]
    assert stages.download_images(config, spark, reset=("batched",)) and _Handler.calls == before
    assert stages.apply_tools(config, "image_verification", spark) == 2
    table = stages.sinks.VersionedTable(spark, f"{config.path('tools_folder')}/images")
    written = lambda: [x for x in (tmp_path / "out/tools/images/data").rglob("*.parquet")]
    assert not written() and table.read().count() == 8  # taken over as they are: nothing was corrupted, so nothing is written
    assert stages.apply_tools(config, "duplication_based", spark) == 3
    assert table.read().count() == 1
    assert stages.apply_tools(config, "resize", spark) == 4 and list(table.read().first()["resized_size"]) == [4, 2]
    assert tools.corrupted(table.read()).isEmpty()
    assert stages.apply_tools(config, "size_based", spark) == 5 and table.read().isEmpty()
    assert stages.apply_tools(config, "size_based", spark) == 5  # done, so not run again
    assert job.results("success").count() == 8


def _failing_after(limit):
    calls = {"n": 0}

    def getter(header, pool):
        def get(url):
            calls["n"] += 1
            if calls["n"] > limit:
                raise RuntimeError("the executor is gone")
            return png(RGB)

        return get

    return getter


def test_resume_after_a_crash(spark, tmp_path, server):
    """A layer that dies leaves no ledger row and no result that readers see; the next run fetches what is left and ends like an undisturbed one."""
    _raw(tmp_path, server)
    config = _config(tmp_path, server)
    with pytest.raises(Exception):  # noqa: B017
        stages.download_images(config, spark, getter=_failing_after(1))
    job = stages.Downloader(spark, config)
    assert job.status().isEmpty() and job.results("success").isEmpty() and job.results("error").isEmpty()
    assert stages.download_images(config, spark)
    rows = job.results("success")
    assert rows.count() == rows.select("uuid").distinct().count() == 8


def test_a_crash_before_the_ledger_row(spark, tmp_path, server, monkeypatch):
    """Results are committed and the ledger isn't: the next run asks no server again, and completes the batches."""
    _raw(tmp_path, server)
    config = _config(tmp_path, server)
    job = stages.Downloader(spark, config)
    monkeypatch.setattr(fetch, "last_rates", lambda _: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        job.run()
    monkeypatch.undo()
    assert job.status().isEmpty() and job.results("success").count() == 8
    before = dict(_Handler.calls)
    assert stages.download_images(config, spark) and _Handler.calls == before
    assert job.results("success").count() == 8 and {r["status"] for r in job.status().collect()} == {"Completed"}


def test_a_batch_goes_on_where_time_ran_out(spark, tmp_path, server):
    """Only what has no result yet is asked for by the next layer, down to single URLs of a batch."""
    _raw(tmp_path, server)
    config = _config(tmp_path, server, batch_size=100)
    job = stages.Downloader(spark, config)
    job.batch()
    job.profile()
    urls = stages.tables.url_batches(spark, config.path("urls_folder"))
    plan = spark.createDataFrame([(r["server_name"], 0, 1, 100, 0, 0) for r in urls.select("server_name").distinct().collect()], "server_name string, partition_id_from int, partition_id_to int, rate_limit int, main_rank int, rank int")
    some = fetch.fetch(urls.where(F.col("identifier").rlike("/ok/[0-3]$")), plan, 6)
    job.store.commit(job.store.write(some, 1), 1)
    before = dict(_Handler.calls)
    assert fetch.finished_batches(urls, job.store.read()).isEmpty()
    assert stages.download_images(config, spark)
    again = {k for k, n in _Handler.calls.items() if n > before.get(k, 0)}
    assert {f"/ok/{i}" for i in range(4)}.isdisjoint(again) and {"/ok/4", "/missing/7"} <= again
    rows = job.results("success")
    assert rows.count() == rows.select("uuid").distinct().count() == 8 and job.results("error").count() == 2


def test_undecided_images(spark, tmp_path, server):
    """Formats without a decoder are kept and complete no batch; with one, they are settled without a request, and the batches complete."""
    kinds = ["ok", "jpeg", "gif", "ok", "tiff", "ok", "missing"]
    lines = [f"{i},{server}/{k}/u{i},StillImage,image/png,HUMAN_OBSERVATION" for i, k in enumerate(kinds)]
    (tmp_path / "raw.csv").write_text("gbifID,identifier,type,format,basisOfRecord\n" + "\n".join(lines) + "\n")
    none = {k: "no_such_library:decoder" for k in ("jpeg", "gif", "tiff")}
    config = _config(tmp_path, server, codecs=none, batch_size=100)
    config.suppress_unchanged_error = True
    assert not stages.download_images(config, spark)
    job = stages.Downloader(spark, config)
    assert job.results("success").count() == 3 and job.results("error").count() == 1
    assert sorted(r["format"] for r in job.results("undecided").collect()) == ["gif", "jpeg", "tiff"]
    assert {r["status"] for r in job.status().collect()} == {"Failed"}
    before = dict(_Handler.calls)
    assert not stages.download_images(config, spark) and _Handler.calls == before
    better = _config(tmp_path, server, codecs={k: "tests.test_images:stand_in" for k in none}, batch_size=100)
    assert stages.download_images(better, spark) and _Handler.calls == before
    assert job.results("undecided").isEmpty() and {r["status"] for r in job.status().collect()} == {"Completed"}
    rows = {r["identifier"].split("/")[-2]: r for r in job.results("success").collect()}
    assert job.results("success").count() == 6 and rows["jpeg"]["hashsum_original"] == hashlib.md5(JPEG).hexdigest() and list(rows["tiff"]["original_size"]) == [4, 5]


def test_rates_go_on_from_layer_to_layer(spark):
    """The second layer starts at what the first one reached, not at the profile's rate, and bounds follow after each batch."""
    urls = spark.createDataFrame([("s", b, f"{b}-{i}", f"u{i}") for b in range(4) for i in range(5)] + [("t", 0, "t", "u")], "server_name string, partition_id int, uuid string, identifier string")
    plan = spark.createDataFrame([("s", 0, 2, 40, 0, 0), ("s", 2, 4, 40, 0, 1), ("t", 0, 1, 30, 2, 2)], "server_name string, partition_id_from int, partition_id_to int, rate_limit int, main_rank int, rank int")

    def busy(header, pool):
        def get(url):
            raise fetch.FetchFailed(429, "slow down")

        return get

    first = spark.createDataFrame(fetch.fetch(urls, plan, 6, getter=busy, rate_multiplier=0.5).collect(), fetch.RESULT)
    rates = {r["server_name"]: r["rate"] for r in fetch.last_rates(first).collect()}
    # Each of two lines starts at 20 and is retried 20 times a batch: down to 10 in the first, and in the second, with bounds around 10, to 5.
    assert rates["s"] == 10 and rates["t"] == 26
    by = {(r["slot"], r["partition_id"]): r["rate"] for r in first.orderBy("place").collect()}
    assert by[0, 0] == 10 and by[0, 1] == 5
    calm = lambda header, pool: lambda url: png(RGB)
    second = fetch.fetch(urls, plan, 6, getter=calm, rates=spark.createDataFrame(list(rates.items()), "server_name string, rate double")).collect()
    start = {r["server_name"]: r["rate"] for r in second if r["place"] == 0}
    assert start["s"] < 7.6 and 25 < start["t"] < 40
    kept = spark.createDataFrame([("s", 5.0, 1), ("s", 9.0, 3), ("t", 2.0, 2)], "server_name string, rate double, run_id long")
    assert sorted(map(tuple, fetch.newest_rates(kept).collect())) == [("s", 9.0), ("t", 2.0)]


def test_pool_follows_the_rate(spark):
    urls = spark.createDataFrame([("s", 0, "a", "u")], "server_name string, partition_id int, uuid string, identifier string")
    plan = spark.createDataFrame([("s", 0, 1, 40, 0, 0)], "server_name string, partition_id_from int, partition_id_to int, rate_limit int, main_rank int, rank int")

    def told(header, pool):
        def get(url):
            raise fetch.FetchFailed(404, str(pool))

        return get

    assert fetch.fetch(urls, plan, 6, getter=told, rate_multiplier=0.5).first()["error_msg"] == "60"


def test_a_thousand_ranges_of_one_server(spark):
    """URLs meet ranges by an equal key: as many rows come out as URLs are assigned, whatever the number of ranges; the plan has no range condition."""
    urls = spark.createDataFrame([("s", b, f"{b}-{i}", "u") for b in range(3_000) for i in range(2)] + [("other", 0, "o", "u")], "server_name string, partition_id int, uuid string, identifier string")
    plan = spark.createDataFrame([("s", 3 * i, 3 * i + 2, 10, 0, i % 4) for i in range(1_000)] + [("s", 9, 9, 10, 0, 0)], "server_name string, partition_id_from int, partition_id_to int, rate_limit int, main_rank int, rank int")
    batches = fetch.assigned_batches(plan)
    got = batches.collect()
    assert len(got) == 2_000 and {r["partition_id"]: r["rank"] for r in got} == {b: b // 3 % 4 for b in range(3_000) if b % 3 < 2} and {r["slots"] for r in got} == {4}
    met = urls.join(batches, ["server_name", "partition_id"])
    assert met.count() == 4_000 and "NestedLoop" not in met._jdf.queryExecution().toString()


def test_placement_by_load(spark):
    """No two heavy lines share a task while another has less, however the lines hash; small lines fill up."""
    loads = [(100.0, "a", 0), (90.0, "a", 1), (80.0, "b", 0), (70.0, None, 0), *[(1.0, f"s{i}", i % 3) for i in range(200)]]
    frame = spark.createDataFrame([(n, r, x) for x, n, r in loads], "server_name string, rank int, load double")
    for single in (10_000, 4, 2):
        got = placement.place_lines(frame, 4, "server_name", "rank", single=single, buckets=64).collect()
        task = {(r["server_name"], r["rank"]): r["task"] for r in got}
        assert len(got) == len(loads) and (single == 2 or len({task[n, r] for _, n, r in loads[:4]}) == 4)
        total = [sum(x for x, n, r in loads if task[n, r] == t) for t in range(4)]
        assert max(total) <= min(total) + (8 if single == 10_000 else 30)
    assert placement.place_lines(frame.where("false"), 4, "server_name", "rank").count() == 0
    best = placement.longest_first([(7.0, 1), (5.0, 2), (5.0, 0), (3.0, 3)], 2)
    assert sorted(best) == [(0, 1), (0, 3), (1, 0), (1, 2)]


def test_fetch_follows_the_placement(spark):
    urls = spark.createDataFrame([(s, 0, f"{s}-{i}", "u") for s, n in (("big1", 40), ("big2", 38), ("big3", 36), ("big4", 34)) for i in range(n)] + [(f"s{i}", 0, f"s{i}", "u") for i in range(30)], "server_name string, partition_id int, uuid string, identifier string")
    plan = urls.select("server_name").distinct().select("server_name", F.lit(0).alias("partition_id_from"), F.lit(1).alias("partition_id_to"), F.lit(1000).alias("rate_limit"), F.lit(0).alias("main_rank"), F.lit(0).alias("rank"))

    def where(header, pool):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()

        def get(url):
            raise fetch.FetchFailed(404, str(task))

        return get

    got = fetch.fetch(urls, plan, 6, getter=where, tasks=4).collect()
    tasks = {r["server_name"]: r["error_msg"] for r in got}
    assert len(got) == 178 and len({tasks[f"big{i}"] for i in range(1, 5)}) == 4
    assert max(sum(r["error_msg"] == str(t) for r in got) for t in range(4)) <= 46


def test_config_is_checked(tmp_path):
    good = {"path_to_output_folder": "o"}
    assert Config.from_dict(good).workers == 1
    for bad in ({}, {"path_to_output_folder": 3}, good | {"schedule_rules": {}}, good | {"output_structure": {"x": "y"}}, good | {"downloader_parameters": {"header": True}}, good | {"downloader_parameters": {"batch_size": 0}}, good | {"downloader_parameters": {"rate_multiplier": -1}}):
        with pytest.raises(ValueError):
            Config.from_dict(bad)
    path = tmp_path / "c.yaml"
    path.write_text("path_to_output_folder: o\nschedule_rules: {1: 1, 50: 4}\nincluded_sources: [a]\n")
    c = Config.from_path(str(path))
    assert c.schedule_rules == {1: 1, 50: 4} and c.extra == {"included_sources": ["a"]} and c.path("urls_folder") == "o/servers_batched"


def test_a_layer_without_time(spark, tmp_path, server):
    """Past the deadline nothing enters the ledger; with time again, everything is fetched."""
    _raw(tmp_path, server)
    with pytest.raises(stages.Unchanged):
        stages.download_images(_config(tmp_path, server, layer_seconds=0), spark)
    quiet = _config(tmp_path, server, layer_seconds=0)
    quiet.suppress_unchanged_error = True
    assert not stages.download_images(quiet, spark)
    assert stages.download_images(_config(tmp_path, server), spark)


def test_finished_batches(spark):
    urls = spark.createDataFrame([("a", 0, "1"), ("a", 0, "2"), ("a", 1, "3"), ("b", 0, "4"), ("c", 0, "5"), ("c", 0, "5")], "server_name string, partition_id int, uuid string")
    got = spark.createDataFrame([("a", 0, "1", "success"), ("a", 1, "3", "error"), ("b", 0, "4", "undecided"), ("c", 0, "5", "success")], "server_name string, partition_id int, uuid string, kind string")
    assert sorted(map(tuple, fetch.finished_batches(urls, got).collect())) == [("a", 1), ("c", 0)]
