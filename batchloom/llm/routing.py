"""Questions and answers between chunks of documents and buckets of keys.

Documents are packed into chunks, a compressed row of about a megabyte of text each, and dealt out by chunk at most once. A chunk
asks each bucket about its keys, all keys of one bucket in one compressed row; a key that occurs often in a chunk is asked
about once, so the size of a group in a bucket follows the number of chunks and not the number of documents. A bucket
gathers what was asked and answers every chunk by itself. All rounds read the same exchange of chunks, and nothing passes
through the driver.

The input has to give the same rows in the same order when a task is run again, as stored tables do. The number of a chunk
depends on its content, so a task that is run again with other rows makes the query fail instead of mixing answers up.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm.texts import U64, mix, pieces

ASK = "bucket int, chunk bigint, data binary"
_CODEC = pa.Codec("zstd", compression_level=1)

Rows = Iterable[tuple[int, bytes]]


def dump(value) -> bytes:
    raw = pickle.dumps(value, protocol=5)
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def load(data: bytes):
    return pickle.loads(_CODEC.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True))


#: A bucket is gathered in memory and holds the keys of at most this much stored input.
BUCKET_BYTES = 32 << 20


def stored_bytes(docs: DataFrame) -> int:
    """Size of the input as Spark's statistics give it; 0 where it is not known."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def bucket_count(docs: DataFrame) -> int:
    """Buckets of bounded size whatever the number of shuffle partitions is, and a few for every task."""
    return max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stored_bytes(docs) // BUCKET_BYTES))


def chunk_size(docs: DataFrame) -> int:
    """Bytes of text in a chunk: one MB, and more for large inputs, so that rows between chunks and buckets stay large."""
    return min(max(1 << 20, stored_bytes(docs) >> 12), 32 << 20)


def chunked(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The documents as rows (chunk, data); ``columns`` are kept and must have ``doc_id`` and ``text``."""
    limit = chunk_size(docs)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal n
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as w:
                w.write_table(pa.Table.from_batches(held).combine_chunks())
            data = sink.getvalue().to_pybytes()
            number = xxhash.xxh64_intdigest(data, seed=(task << 24) + n)
            n += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([number - (1 << 63)], pa.int64()), pa.array([data], pa.binary())], ["chunk", "data"])

        for batch in batches:
            for part in pieces(batch, limit=limit):
                held.append(part)
                size += sum(x or 0 for x in pa.compute.binary_length(part.column("text")).to_pylist())
                if size >= limit // 2:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return docs.select(*columns).mapInArrow(write, "chunk bigint, data binary")


def opened(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def ask(chunks: DataFrame, question: Callable[[pa.Table, dict[int, bytes]], Rows]) -> DataFrame:
    """What every chunk asks: ``question`` gets its rows and the answers it has so far, and gives (bucket, data)."""
    answers = "answers" in chunks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                got = {a["bucket"]: a["data"] for a in row["answers"] or ()} if answers else {}
                asked = list(question(opened(row["data"]), got))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in asked], pa.int32()), pa.array([row["chunk"]] * len(asked), pa.int64()), pa.array([d for _, d in asked], pa.binary())],
                    ["bucket", "chunk", "data"],
                )

    return chunks.mapInArrow(run, ASK)


def answer(asked: DataFrame, respond: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """One row per chunk with the answers of all buckets; ``respond`` gets what was asked in one bucket, in order of chunks."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        return table.set_column(2, "data", pa.array(respond(table.column("data").to_pylist()), pa.binary()))

    said = asked.groupBy("bucket").applyInArrow(run, ASK)
    return said.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "data")).alias("answers"))


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    return chunks.join(answers.hint("shuffle_hash"), "chunk", "left")


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each key; an order by bucket; where each bucket begins in it (one more than buckets)."""
    at = (mix(keys ^ U64(0x5851F42D4C957F2D)) % U64(buckets)).astype(np.int32)
    order = np.argsort(at, kind="stable")
    return at, order, np.searchsorted(at[order], np.arange(buckets + 1))
