"""Helpers shared by the text operators: columns, batches of bytes, tables kept for reuse."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text worked on at once inside a task; one text may be longer.
PIECE_BYTES = 1 << 20
#: Documents whose share of a step's table one task writes, where that leaves each core a task.
WRITER_ROWS = 12_500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Place of a public tokenizer's file, in ``folder`` or where the installation has them."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the session's JVM ends.

    Where the setting is missing a local session gets a folder of its own; a cluster
    session gets an error, as its executors can't see the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="meterflow-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path)
    fs.deleteOnExit(jvm_path)
    return path


def writers(docs: DataFrame) -> int:
    """Tasks that tables made of some documents are written by at most: it grows with the documents."""
    return max(docs.sparkSession.sparkContext.defaultParallelism, docs.count() // WRITER_ROWS)


def kept(df: DataFrame, name: str, codec: str = "zstd", tasks: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: read again without the work behind it.

    It cuts lineage like a checkpoint, and its rows stay the same however often a lost
    executor makes Spark read them again. ``tasks`` bounds its files, whatever the number of
    shuffle partitions: on a local disk Hadoop starts processes for each file, and while one
    starts the executor's memory is held by two.
    """
    if tasks:
        df = df.coalesce(tasks)
    path = f"{shared_folder(df.sparkSession, name)}/table"
    df.write.option("compression", codec).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.kept_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Removes tables that ``kept`` has written, once all that is made of them is written."""
    for table in tables:
        place = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table.kept_at).getParent()
        place.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def released(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of steps whose tables are written.

    It removes them when the JVM collects what refers to them, which it otherwise does
    only when memory runs short.
    """
    spark.sparkContext._jvm.System.gc()


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of an Arrow column and where each begins; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = texts.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most so many bytes of text, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, offsets = bytes_of(batch.column(batch.schema.get_field_index(column)))
        start = 0
        while start < n:
            stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
            stop = min(n, max(stop, start + 1))
            yield batch.slice(start, stop - start)
            start = stop


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def filtered(docs: DataFrame, text_column: str, verdict) -> DataFrame:
    """Rows of docs, with all their columns, for which ``verdict(texts)`` is true."""
    at = [i for i, c in enumerate(docs.columns) if c == text_column][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = verdict(batch.column(at))
                yield batch.filter(pa.array(np.asarray(keep, dtype=bool)))

    return docs.mapInArrow(run, docs.schema)
