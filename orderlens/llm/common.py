"""Helpers shared by the operators: Arrow blocks of bounded size, fresh column
names, table readers and the folder for tables that cut lineage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import scratch_dir, ship

# Text bytes handled at once inside a task; bounds numpy temporaries whatever the batch size.
BLOCK_BYTES = 1 << 21


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names; other columns cannot clash."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def held_out(id_col: str = "doc_id"):
    """True for rows whose crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2,
                      F.lit(False))


def give_back() -> None:
    """Hand memory that the allocators of this process keep for later back to the system: Python workers are used
    again by tasks of other stages, beside the JVM."""
    pa.default_memory_pool().release_unused()
    if (trim := _malloc_trim()) is not None:
        trim(0)


@cache
def _malloc_trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):        # another C library
        return None


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text",
           max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` of text each (one row at least)."""
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            start = total = 0
            for i, n in enumerate(size.tolist()):
                if i > start and total + n > max_bytes:
                    yield batch.slice(start, i - start)
                    start, total = i, 0
                total += n
            yield batch.slice(start)
    finally:
        give_back()


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str]:
    """The texts of a block; null counts as the empty text."""
    return [t or "" for t in batch.column(text).to_pylist()]


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared checkpoint folder."""
    return scratch_dir(spark, f"{name}/{uuid.uuid4().hex}")


def filesystem(folder: str):
    """The ``pyarrow`` file system of a shared folder, and the folder's path in it."""
    from pyarrow import fs
    if folder.startswith("file:"):          # Hadoop writes local folders as file:/x, pyarrow wants file:///x
        folder = "file:///" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write as Parquet into the shared folder and read back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
