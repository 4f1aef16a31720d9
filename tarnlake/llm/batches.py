"""Documents in files of a few megabytes that tasks open by name.

Operators that ask about a document's words twice write the texts once, exchange packed arrays keyed by hash bucket and by file, and open each file again
for the answer; the texts themselves are never shuffled. A file counts only once the task that wrote it has succeeded, for then its row is in the manifest.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import shared_dir, stage, text_buffer

BATCH_BYTES = 5 << 20
#: Packed entries that one bucket should have, by bytes of text.
BUCKET_TEXT, LEAST_BUCKETS = 24 << 20, 64
MANIFEST = "batch string, docs long, bytes long"
#: Order of a null id: after all others.
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _writer(folder: str, limit: int):
    def write(batches):
        import pyarrow as pa
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        kept, size = [], 0

        def flush():
            name = uuid.uuid4().hex
            with store.open_output_stream(f"{root}/{name}") as out, pa.ipc.new_stream(out, kept[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as sink:
                for x in kept:
                    sink.write_batch(x)
            return pa.RecordBatch.from_pydict({"batch": [name], "docs": [sum(x.num_rows for x in kept)], "bytes": [size]})

        for batch in batches:
            ends, done = text_buffer(batch.column(1))[1], 0
            while done < batch.num_rows:
                upto = max(done + 1, int(np.searchsorted(ends, ends[done] + limit - size, side="right")) - 1)
                kept.append(batch.slice(done, upto - done))
                size += int(ends[upto] - ends[done])
                done = upto
                if size >= limit or done < batch.num_rows:
                    yield flush()
                    kept, size = [], 0
        if kept:
            yield flush()

    return write


def write_batches(docs: DataFrame, batch_bytes: int = BATCH_BYTES, folder: str | None = None) -> tuple[str, DataFrame]:
    """The folder of the files (a new one, if none is given), and the manifest of those written now. Files hold doc_id (as long) and text (as string) of every row."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/texts-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return folder, stage(rows.mapInArrow(_writer(folder, batch_bytes), MANIFEST), "text-files")


def buckets_for(text_bytes: int) -> int:
    return max(LEAST_BUCKETS, -(-text_bytes // BUCKET_TEXT))


class TextBatch:
    """One file: ``ids`` (with None), ``order`` (unsigned, null last), and the texts' bytes and offsets."""

    def __init__(self, folder: str, name: str):
        import pyarrow as pa
        from pyarrow import fs

        self.store, root = fs.FileSystem.from_uri(folder)
        self.path = f"{root}/{name}"
        with self.store.open_input_stream(self.path) as source, pa.ipc.open_stream(source) as reader:
            table = reader.read_all()
        ids = table.column("doc_id").combine_chunks()
        self.ids = ids.to_pylist()
        order = ids.fill_null(0).to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        self.order = np.where(ids.is_null().to_numpy(zero_copy_only=False), LAST, order)
        self.data, self.offsets = text_buffer(table.column("text"))


def to_planes(values: np.ndarray) -> bytes:
    """64-bit integers with equal bytes next to each other, so that high zero bytes compress away."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes | memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def bucket_cells(hashes: np.ndarray, buckets: int) -> list[tuple[int, slice]]:
    """The buckets that sorted, evenly spread hashes fall into, and which of them each has. Empty buckets cost nothing."""
    if not len(hashes):
        return []
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    head = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return [(int(bucket[i]), slice(i, j)) for i, j in zip(head.tolist(), [*head[1:].tolist(), len(hashes)], strict=True)]
