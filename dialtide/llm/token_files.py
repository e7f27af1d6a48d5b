"""Token ids as Arrow files of equal-length sequences, and reading them back.

Each task writes the ids of a range of documents, in order, as files of record
batches with two fixed-size-list columns: ``ids`` and ``mask`` (false where the
last sequence of a file is filled up). Files are in Arrow's random-access format
and not compressed, so a reader maps a file and reaches any sequence without
copying. An index file beside each holds where its documents start.

Files get their final name once complete; a task that runs again writes the
same bytes under the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_dir
from .common import running_total
from .tokens import default_path, documents_of, encoder, text_slices

SEQUENCE_TOKENS = 2048
BATCH_SEQUENCES = 64
FILE_TOKENS = 1 << 24
INDEX_ROWS = 1 << 16

INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, file int, tokens_path string, index_path string, n_documents long, n_tokens long"


def filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(folder)


class TokenWriter:
    """One tokens file and its index."""

    def __init__(self, fs, stem: str, attempt: int, dtype: str, sequence_tokens: int):
        self.fs, self.stem, self.attempt, self.length = fs, stem, attempt, sequence_tokens
        self.value = pa.uint16() if dtype == "<u2" else pa.uint32()
        self.schema = pa.schema(
            [("ids", pa.list_(self.value, sequence_tokens)), ("mask", pa.list_(pa.bool_(), sequence_tokens))]
        )
        self.dtype, self.pending, self.waiting = dtype, [], 0
        self.n_tokens = self.n_documents = 0
        self.index: list[tuple] = []
        self.tokens_out = fs.open_output_stream(self._draft("tokens"))
        self.index_out = fs.open_output_stream(self._draft("index"))
        self.tokens = pa.ipc.new_file(self.tokens_out, self.schema)
        self.documents = pa.ipc.new_file(self.index_out, INDEX)

    def _draft(self, kind: str) -> str:
        return f"{self.stem}.{kind}.{self.attempt}.draft"

    def add(self, doc_id: int | None, ids: bytes) -> None:
        array = np.frombuffer(ids, self.dtype)
        self.index.append((doc_id, self.n_tokens, len(array)))
        self.pending.append(array)
        self.waiting += len(array)
        self.n_tokens += len(array)
        self.n_documents += 1
        if self.waiting >= BATCH_SEQUENCES * self.length:
            self._flush_tokens(False)
        if len(self.index) >= INDEX_ROWS:
            self._flush_index()

    def _flush_tokens(self, last: bool) -> None:
        flat = np.concatenate(self.pending) if self.pending else np.empty(0, self.dtype)
        step = BATCH_SEQUENCES * self.length
        whole = len(flat) - len(flat) % step
        for at in range(0, whole, step):
            self._write(flat[at : at + step], step)
        if last and whole < len(flat):
            self._write(flat[whole:], -(-(len(flat) - whole) // self.length) * self.length)
            whole = len(flat)
        self.pending, self.waiting = [flat[whole:]], len(flat) - whole

    def _write(self, ids: np.ndarray, size: int) -> None:
        filled = np.zeros(size, self.dtype)
        filled[: len(ids)] = ids
        arrays = [pa.array(filled, self.value), pa.array(np.arange(size) < len(ids))]
        columns = [pa.FixedSizeListArray.from_arrays(a, self.length) for a in arrays]
        self.tokens.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def _flush_index(self) -> None:
        if self.index:
            columns = [pa.array(c, t) for c, t in zip(zip(*self.index), INDEX.types)]
            self.documents.write_batch(pa.RecordBatch.from_arrays(columns, schema=INDEX))
            self.index = []

    def close(self) -> tuple[str, str, int, int]:
        self._flush_tokens(True)
        self._flush_index()
        for writer, out, kind in ((self.tokens, self.tokens_out, "tokens"), (self.documents, self.index_out, "index")):
            writer.close()
            out.close()
            self.fs.move(self._draft(kind), f"{self.stem}.{kind}.arrow")
        return f"{self.stem}.tokens.arrow", f"{self.stem}.index.arrow", self.n_documents, self.n_tokens


class TokenFile:
    """Random access to a tokens file; arrays are views of the mapped file where nothing has to be joined."""

    def __init__(self, fs, path: str):
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        source = pa.memory_map(path) if local else pa.BufferReader(fs.open_input_file(path).read_buffer())
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size

    def _column(self, batch: int, name: str) -> np.ndarray:
        values = self.reader.get_batch(batch).column(name).flatten()
        return values.to_numpy(zero_copy_only=name == "ids")

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of one sequence."""
        batch, row = divmod(number, BATCH_SEQUENCES)
        part = slice(row * self.length, (row + 1) * self.length)
        return self._column(batch, "ids")[part], self._column(batch, "mask")[part]

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the file."""
        step, parts = BATCH_SEQUENCES * self.length, []
        while n > 0:
            batch, at = divmod(start, step)
            parts.append(self._column(batch, "ids")[at : at + n])
            if not len(parts[-1]):
                raise ValueError("past the end of the file")
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, np.uint16), *parts])


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    end_id: int = 2,
    sequence_tokens: int = SEQUENCE_TOKENS,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write all documents in ascending doc_id order and return the manifest, one row per file.

    Documents without an id come first; rows with the same id are ordered by a
    hash of their text. A null or empty text is only its end id. An empty table
    writes no file. Other columns are not read. Manifest: part, file (their
    order is the order of the ids), tokens_path, index_path, n_documents, n_tokens.
    """
    path = tokenizer or default_path("word_bpe_49k.json")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = encoder(path), TaskContext.get()
        end, part, rows, writer = own._pack([end_id]), task.partitionId(), [], None
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)

        def close():
            rows.append((part, len(rows), *writer.close()))

        for batch in text_slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if writer is None:
                    stem = f"{base}/{part:06d}-{len(rows):06d}"
                    writer = TokenWriter(fs, stem, task.taskAttemptId(), own.dtype, sequence_tokens)
                writer.add(doc_id, own.encode(text) + end)
                if writer.n_tokens >= file_tokens:
                    close()
                    writer = None
        if writer is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] * 2 + [pa.string()] * 2 + [pa.int64()] * 2)],
                names=["part", "file", "tokens_path", "index_path", "n_documents", "n_tokens"],
            )

    order = ["doc_id", "order"]
    ranged = documents_of(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ranged.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Every document from the files: doc_id, start (in all files together), n_tokens and ids (32-bit, little-endian)."""
    based = running_total(manifest, F.col("n_tokens"), F.col("part"), F.col("file"), "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                tokens = TokenFile(fs, row["tokens_path"])
                with pa.ipc.open_file(fs.open_input_file(row["index_path"])) as index:
                    for i in range(index.num_record_batches):
                        documents = index.get_batch(i)
                        for at in range(0, documents.num_rows, 512):
                            part = documents.slice(at, 512)
                            spans = list(zip(part.column("start").to_pylist(), part.column("n_tokens").to_pylist()))
                            ids = [tokens.ids(s, n).astype("<u4").tobytes() for s, n in spans]
                            yield pa.RecordBatch.from_arrays(
                                [
                                    part.column("doc_id"),
                                    pa.array([row["base"] + s for s, _ in spans], pa.int64()),
                                    part.column("n_tokens"),
                                    pa.array(ids, pa.binary()),
                                ],
                                names=["doc_id", "start", "n_tokens", "ids"],
                            )

    files = materialize(based, "token-files")
    spread = files.repartition(max(1, files.count()), "part", "file")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write all documents to a new folder of the shared scratch folder and read them back."""
    folder = scratch_dir(docs.sparkSession, "token-files")
    return read_documents(write_token_files(docs, folder, tokenizer, end_id), folder)


