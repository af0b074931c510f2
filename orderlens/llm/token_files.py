"""Operator 4: token ids in binary files with a shared zstandard dictionary.

Layout of a dataset folder in shared storage (any scheme that ``pyarrow.fs`` knows):

``dict/<sha256>.zdict``   the dictionary, trained on id arrays of a bounded sample
``data/part-*.bin``       one file per range of ``doc_id``: the 8-byte magic, the 32-byte
                          SHA-256 of the dictionary, then one zstandard frame per document
``index``                 Parquet, one row per document: file, frame offset and size, number
                          of ids, dictionary hash, place of its ids in the file

A frame holds the ids as little-endian unsigned integers of ``id_bytes`` (2 when the
vocabulary allows, else 4).  A short document is read with one seek: look up the index,
read the frame, decompress with the dictionary of that hash.  Files carry a random part in
their name and the index is written by Spark's own committer, so files of failed or
duplicate attempts are never referred to.

Cases: null and empty texts hold the end id alone; rows sort by ``doc_id`` (null first),
equal ids by text, so repeated rows take neighbouring places; an empty table gives an
empty index; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import blocks, filesystem, id_and_text, new_folder, texts_of
from orderlens.llm.piece_cache import PieceCache, bare_cuts, learn_with, plain_runs

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"TOKBIN01"
# The dictionary is fitted on a sample bounded by these; it only affects file size, not content.
SAMPLE_DOCS = 600
SAMPLE_BYTES = 2 << 20
DICT_BYTES = 32 << 10
LEVEL = 3

_CACHES: dict[str, PieceCache] = {}


def cache_of(path: str) -> PieceCache:
    if path not in _CACHES:
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        # the last token of every plain run carries the word-end mark
        closes = np.zeros(model.get_vocab_size(), bool)
        closes[[i for t, i in model.get_vocab().items() if t.endswith("</w>")]] = True
        _CACHES[path] = PieceCache(
            learn_with(model, plain_runs, " ",
                       lambda ids, _: np.diff(np.flatnonzero(closes[ids]) + 1, prepend=0)),
            bare_cuts, lower=True)
    return _CACHES[path]


class TokenFiles(NamedTuple):
    folder: str
    dict_sha256: str
    id_bytes: int


def _put(folder: str, name: str, content: bytes) -> None:
    fs, base = filesystem(folder)
    fs.create_dir(f"{base}/{name.rpartition('/')[0]}", recursive=True)
    with fs.open_output_stream(f"{base}/{name}") as out:
        out.write(content)


def _get(folder: str, name: str) -> bytes:
    fs, base = filesystem(folder)
    with fs.open_input_stream(f"{base}/{name}") as f:
        return f.read()


def _dtype(id_bytes: int) -> str:
    return f"<u{id_bytes}"


def train_dictionary(docs: DataFrame, folder: str, vocabulary: str, id_bytes: int,
                     sample_docs: int = SAMPLE_DOCS) -> str:
    """Train the dictionary on the id arrays of a hash sample (``SAMPLE_DOCS`` documents and
    ``SAMPLE_BYTES`` of text at most) and return its SHA-256; the empty dictionary if too small."""
    n = docs.count()
    share = min(1.0, 1.5 * sample_docs / max(n, 1))
    limit = int(share * (1 << 31))
    sample = docs.filter((F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < limit)
                         & (F.length("text") < SAMPLE_BYTES // 20))
    texts = [r.text or "" for r in sample.select("text").limit(sample_docs).collect()]
    kept, total = [], 0
    for t in texts:
        if total + len(t) > SAMPLE_BYTES:
            break
        kept.append(t)
        total += len(t)
    ids, at = cache_of(vocabulary).encode(kept)
    samples = [ids[s:e].astype(_dtype(id_bytes)).tobytes() for s, e in zip(at, at[1:]) if e - s >= 8]
    try:
        content = zstandard.train_dictionary(DICT_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        content = b""                       # too few or too short samples
    sha = hashlib.sha256(content).hexdigest()
    _put(folder, f"dict/{sha}.zdict", content)
    return sha


def _codec(folder: str, sha: str, id_bytes: int):
    content = _get(folder, f"dict/{sha}.zdict")
    if hashlib.sha256(content).hexdigest() != sha:
        raise ValueError(f"dictionary {sha} of {folder} is damaged")
    if not content:
        return (zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor())
    d = zstandard.ZstdCompressionDict(content)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, level=LEVEL), zstandard.ZstdDecompressor(dict_data=d)


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int | None = END_ID,
          id_bytes: int = 2, partitions: int | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> TokenFiles:
    """Encode ``docs`` and write the dataset; runs Spark jobs when called."""
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    own = id_and_text(docs, id_col, text_col)
    sha = train_dictionary(own, folder, path, id_bytes)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor, _ = _codec(folder, sha, id_bytes)
        cache, dtype = cache_of(path), np.dtype(_dtype(id_bytes))
        part = TaskContext.get().partitionId()
        name = f"data/part-{part:06d}-{uuid.uuid4().hex}.bin"
        fs, base = filesystem(folder)
        fs.create_dir(f"{base}/data", recursive=True)
        out, at, before = None, 0, 0
        for b in blocks(batches):
            if out is None:
                out = fs.open_output_stream(f"{base}/{name}")
                out.write(MAGIC + bytes.fromhex(sha))
                at = len(MAGIC) + 32
            ids, bounds = cache.encode(texts_of(b))
            if len(ids) and int(ids.max()) >= 1 << (8 * id_bytes):
                raise ValueError(f"ids need more than {id_bytes} bytes")
            ids = ids.astype(dtype)
            tail = b"" if end_id is None else np.array([end_id], dtype).tobytes()
            rows = []
            for s, e in zip(bounds.tolist(), bounds.tolist()[1:]):
                frame = compressor.compress(ids[s:e].tobytes() + tail)
                count = e - s + (end_id is not None)
                rows.append((at, len(frame), before, count))
                out.write(frame)
                at, before = at + len(frame), before + count
            offset, size, start, count = map(list, zip(*rows))
            k = len(rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([part] * k, pa.int32()), pa.array([name] * k, pa.string()),
                 *(pa.array(x, pa.int64()) for x in (offset, size, start, count)),
                 pa.array([sha] * k, pa.string())],
                names=["doc_id", "part", "file", "offset", "size", "start_in_file", "n_tokens", "dict_sha256"])
        if out is not None:
            out.close()

    kind = dict(docs.dtypes)[id_col]
    # ranges of (id, hash) keep the order and split rows that share one id
    ranges = (own.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text"))
    (ranges.mapInArrow(run, f"doc_id {kind}, part int, file string, offset bigint, size bigint, "
                            "start_in_file bigint, n_tokens bigint, dict_sha256 string")
     .write.parquet(f"{folder}/index"))
    return TokenFiles(folder, sha, id_bytes)


def index(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """The offset index with ``start``: ids of all documents before, over the whole dataset."""
    rows = spark.read.parquet(f"{files.folder}/index")
    # one row per file: as many as there are partitions, a small table
    sums = rows.groupBy("file", "part").agg(F.sum("n_tokens").alias("in_file"))
    first = sums.select("file", (F.sum("in_file").over(
        Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, 0))
        - F.col("in_file")).alias("base"))
    return rows.join(F.broadcast(first), "file").withColumn("start", F.col("base") + F.col("start_in_file"))


def _ids(blob: bytes, decompressor, id_bytes: int) -> np.ndarray:
    return np.frombuffer(decompressor.decompress(blob), _dtype(id_bytes))


def read(spark: SparkSession, files: TokenFiles, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens`` with ``ids`` (array) or, with ``digest``, ``ids_crc32``.

    Each task reads the frames of its index rows; neighbours in one file share one open file.
    """
    folder, sha, id_bytes = files.folder, files.dict_sha256, files.id_bytes
    cols = ["doc_id", "start", "n_tokens", "file", "offset", "size", "dict_sha256"]
    rows = index(spark, files).select(*cols)
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decompressor = _codec(folder, sha, id_bytes)
        fs, base = filesystem(folder)
        name, f = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                out = []
                for file, offset, size, own in zip(*(b.column(c).to_pylist() for c in
                                                     ("file", "offset", "size", "dict_sha256"))):
                    if own != sha:
                        raise ValueError(f"{file} was written with another dictionary")
                    if file != name:
                        if f is not None:
                            f.close()
                        name, f = file, fs.open_input_file(f"{base}/{file}")
                        if f.read_at(len(MAGIC) + 32, 0) != MAGIC + bytes.fromhex(sha):
                            raise ValueError(f"{file} is not a token file of this dictionary")
                    ids = _ids(f.read_at(size, offset), decompressor, id_bytes)
                    out.append(zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids)
                last = (pa.array(out, pa.int64()) if digest
                        else pa.array([x.astype(np.int64) for x in out], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("start"), b.column("n_tokens"), last],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])
        if f is not None:
            f.close()

    return rows.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, "
                           + ("ids_crc32 bigint" if digest else "ids array<bigint>"))


def read_document(spark: SparkSession, files: TokenFiles, doc_id) -> list[int] | None:
    """The ids of one document: one index row, one seek; None if there is no such document."""
    row = (spark.read.parquet(f"{files.folder}/index").filter(F.col("doc_id") == F.lit(doc_id))
           .select("file", "offset", "size").first())
    if row is None:
        return None
    _, decompressor = _codec(files.folder, files.dict_sha256, files.id_bytes)
    fs, base = filesystem(files.folder)
    with fs.open_input_file(f"{base}/{row.file}") as f:
        return _ids(f.read_at(row.size, row.offset), decompressor, files.id_bytes).tolist()


def round_trip(docs: DataFrame, vocabulary: str | None = None, folder: str | None = None) -> DataFrame:
    """Write ``docs``, read the files back: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    files = write(docs, folder or new_folder(spark, "token_files"), vocabulary)
    return read(spark, files, digest=True)
