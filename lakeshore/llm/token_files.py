"""Token ids as Arrow files of equal-length sequences.

Documents in ascending ``doc_id`` order are encoded, an end id follows each, and
the ids are cut into sequences of fixed length. Each task writes one Arrow IPC
file whose record batches hold three fixed-size-list columns, ``ids`` (uint16 if the
vocabulary fits, else uint32), ``mask`` (bits: an id, not padding) and ``last``
(bits: last id of a document), and one small Arrow file with the document ids in
order. A file ends with padding, so files stand on
their own; the table of files (first token, counts) gives every file its place in
the whole stream. Batches are uncompressed and of equal size, so sequence ``i`` of
a mapped file is a view at a computed place: no copy, no scan.

File names are new for every task attempt and only those that a finished task
returned are listed, so lost executors leave at most unlisted files behind.

Defined cases: a null or empty text is one end id; rows with a null ``doc_id``
come first; rows that share ``doc_id`` are ordered by a hash of their text, then by
the text, and rows that repeat are written each; an empty table gives
an empty list of files; extra columns are ignored; very long texts span as many
sequences as they need.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeshore.llm.common import fresh_path, shuffle_partitions, table, written
from lakeshore.llm.pretokens import BatchEncoder, character_classes, visible_bytes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core

SEQUENCE = 2048  # ids in a sequence
BATCH = 256  # sequences in a record batch
END_ID = 0
_MEMO = 100_000  # pre-tokens whose ids a worker remembers, twice as many at most
_ENCODERS: dict[str, BatchEncoder] = {}


def encoder(path: str, classes: np.ndarray) -> BatchEncoder:
    """The library's ids for whole batches; a worker keeps those of frequent pre-tokens."""
    if path not in _ENCODERS:
        model = Tokenizer.from_file(path).model
        shown = dict(enumerate(visible_bytes()))

        def learn(pieces: list[bytes]) -> list[bytes]:
            seen = (p.decode("latin-1").translate(shown) for p in pieces)
            return [np.array([t.id for t in model.tokenize(p)], "<u4").tobytes() for p in seen]

        _ENCODERS[path] = BatchEncoder(path, classes, learn, _MEMO)
    return _ENCODERS[path]


def id_type(tokenizer: Tokenizer) -> pa.DataType:
    """The smallest type that holds every id."""
    return pa.uint16() if tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else pa.uint32()


def _schema(length: int, ids: pa.DataType) -> pa.Schema:
    bits = pa.list_(pa.bool_(), length)
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", bits), ("last", bits)])


class SequenceWriter:
    """Collects ids and writes a record batch whenever one is full."""

    def __init__(self, fs: pafs.FileSystem, path: str, length: int, ids: pa.DataType):
        self.length, self.tokens, self.sequences = length, 0, 0
        self.schema, self.dtype = _schema(length, ids), ids.to_pandas_dtype()
        self.out = fs.open_output_stream(path)
        self.file = ipc.new_file(self.out, self.schema)
        self.ids: list[np.ndarray] = []
        self.lasts: list[np.ndarray] = []
        self.held = 0

    def add(self, ids: np.ndarray) -> None:
        """The ids of one document, end id included."""
        last = np.zeros(len(ids), bool)
        last[-1] = True
        self.ids.append(ids.astype(self.dtype))
        self.lasts.append(last)
        self.held += len(ids)
        self.tokens += len(ids)
        step = BATCH * self.length
        if self.held >= step:
            flat, lasts = np.concatenate(self.ids), np.concatenate(self.lasts)
            full = len(flat) - len(flat) % step
            for a in range(0, full, step):
                self._batch(flat[a : a + step], lasts[a : a + step], step)
            self.ids, self.lasts, self.held = [flat[full:]], [lasts[full:]], len(flat) - full

    def _batch(self, ids: np.ndarray, lasts: np.ndarray, real: int) -> None:
        gap = -len(ids) % self.length
        columns = (np.pad(ids, (0, gap)), np.arange(len(ids) + gap) < real, np.pad(lasts, (0, gap)))
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in columns]
        self.file.write_batch(pa.record_batch(arrays, schema=self.schema))
        self.sequences += (len(ids) + gap) // self.length

    def close(self) -> None:
        if self.held:
            self._batch(np.concatenate(self.ids), np.concatenate(self.lasts), self.held)
        self.file.close()
        self.out.close()


def open_sequences(path: str) -> ipc.RecordBatchFileReader:
    """The file mapped into memory."""
    return ipc.open_file(pa.memory_map(path))


def sequence(reader: ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, pa.Array]:
    """Ids and mask of sequence ``i``, as views of the file."""
    batch = reader.get_batch(i // BATCH)
    length = batch.schema.field(0).type.list_size
    a = (i % BATCH) * length
    return np.asarray(batch.column(0).values)[a : a + length], batch.column(1).values.slice(a, length)


_FILES = "part int, path string, docs_path string, n_docs bigint, n_tokens bigint, n_sequences bigint"


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID
) -> DataFrame:
    """Write ``docs`` (doc_id, text); returns the files in order with ``first_token``."""
    spark = docs.sparkSession
    library = Tokenizer.from_file(tokenizer)
    classes = spark.sparkContext.broadcast(character_classes(library))  # a byte a code point
    ids_type = id_type(library)
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .repartitionByRange(shuffle_partitions(spark), F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, n_docs = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs, base = pafs.FileSystem.from_uri(folder)
                fs.create_dir(base, recursive=True)
                stem = f"part-{part:06d}-{uuid.uuid4().hex}"
                writer = SequenceWriter(fs, f"{base}/{stem}.arrow", length, ids_type)
                doc_schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
                doc_out = fs.open_output_stream(f"{base}/{stem}.docs.arrow")
                doc_file = ipc.new_file(doc_out, doc_schema)
            ids, first = encoder(tokenizer, classes.value).encode(batch.column("text"))
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                writer.add(np.append(ids[a:b], np.uint32(end_id)))
            counts = pa.array(np.diff(first) + 1, pa.int64())
            n_docs += len(counts)
            doc_file.write_batch(pa.record_batch([batch.column("doc_id"), counts], schema=doc_schema))
        if writer is not None:
            writer.close()
            doc_file.close()
            doc_out.close()
            stem = f"{folder.rstrip('/')}/{stem}"
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "path": [f"{stem}.arrow"],
                    "docs_path": [f"{stem}.docs.arrow"],
                    "n_docs": [n_docs],
                    "n_tokens": [writer.tokens],
                    "n_sequences": [writer.sequences],
                }
            )

    files = written(ordered.mapInArrow(write, _FILES), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    n = shuffle_partitions(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(row["path"], row["docs_path"], row["first_token"])

    wanted = files.select("path", "docs_path", "first_token").repartition(n)
    return wanted.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _documents(path: str, docs_path: str, start: int) -> Iterator[pa.RecordBatch]:
    fs, place = pafs.FileSystem.from_uri(docs_path)
    doc_ids = ipc.open_file(fs.open_input_file(place)).read_all()["doc_id"]
    fs, place = pafs.FileSystem.from_uri(path)
    reader, done, crc, count = ipc.open_file(fs.open_input_file(place)), 0, 0, 0
    for k in range(reader.num_record_batches):
        batch = reader.get_batch(k)
        ids = np.asarray(batch.column("ids").values)
        mask, last = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("mask", "last"))
        rows, a = [], 0
        for e in np.flatnonzero(last) + 1:
            crc, count = zlib.crc32(ids[a:e].astype("<u4").tobytes(), crc), count + int(e - a)
            rows.append((start, count, crc))
            start, count, crc, a = start + count, 0, 0, int(e)
        tail = ids[a:][mask[a:]]
        crc, count = zlib.crc32(tail.astype("<u4").tobytes(), crc), count + len(tail)
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [doc_ids.slice(done, len(rows)).combine_chunks(), *(pa.array(c, pa.int64()) for c in cols)],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )
            done += len(rows)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back from them."""
    files = write_token_files(
        table(spark, sf_dir, "documents"),
        fresh_path(spark, "tokens"),
        public_tokenizers.path("byte_bpe_50k.json"),
    )
    return read_token_files(written(files, "token-files-placed"))
