"""Token ids and masks in Arrow IPC files with fixed-size-list batches.

The ids of all documents, in ascending doc_id order, form one stream. Each range of
documents writes its part of the stream as equal-length sequences to one Arrow file
(the stream format with a footer of batch positions): `ids` and `mask` are fixed-size
lists, so a sequence's values lie at a computed place of a memory-mapped buffer. Every
batch but the last has BATCH sequences. A second Arrow file lists the documents of the
range. Files are written under another name and then moved, and their names come from the
range's number, so a task that runs again replaces its own file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import columns_of
from orebed.llm.words import id_bytes, pieces
from orebed.session import durable, work_dir

#: Sequences in a batch of the files.
BATCH = 64


def open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a shared folder given as a path or URI."""
    if folder.startswith("file:"):
        folder = "file:///" + folder[5:].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder)


def schemas(size: int, kind: pa.DataType) -> tuple[pa.Schema, pa.Schema]:
    sequences = pa.schema([("ids", pa.list_(kind, size)), ("mask", pa.list_(pa.uint8(), size))])
    return sequences, pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def as_batch(ids: np.ndarray, filled: int, size: int, schema: pa.Schema) -> pa.RecordBatch:
    """Whole sequences: ids padded to a multiple of size, of which the first `filled` count."""
    lists = [pa.array(ids), pa.array((np.arange(len(ids)) < filled).view(np.uint8))]
    return pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(x, size) for x in lists], schema=schema)


def _write(folder: str, path: str, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, tail = pieces(path), end.to_bytes(4, "little")
        kind = np.uint16 if cache.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        sequences, documents = schemas(size, pa.from_numpy_dtype(kind))
        task = TaskContext.get()
        name, attempt = f"part-{task.partitionId():06d}", task.taskAttemptId()
        where, total, rows, sinks = None, 0, 0, None
        held: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            if sinks is None:
                where, base = open_folder(folder)
                where.create_dir(base, recursive=True)
                names = [f"{base}/{name}.{x}.arrow" for x in ("sequences", "documents")]
                files = [where.open_output_stream(f"{x}.{attempt}") for x in names]
                sinks = [pa.ipc.new_file(f, s) for f, s in zip(files, (sequences, documents), strict=True)]
            starts, counts = [], []
            for text in batch.column("text"):
                ids = np.frombuffer(id_bytes(cache, text.as_py()) + tail, "<u4").astype(kind)
                starts.append(total)
                counts.append(len(ids))
                total += len(ids)
                held.append(ids)
                waiting += len(ids)
                if waiting >= BATCH * size:
                    flat = np.concatenate(held)
                    whole = len(flat) // (BATCH * size) * BATCH * size
                    for at in range(0, whole, BATCH * size):
                        part = flat[at : at + BATCH * size]
                        sinks[0].write_batch(as_batch(part, len(part), size, sequences))
                    held, waiting = [flat[whole:]], len(flat) - whole
            rows += len(counts)
            index = [batch.column("doc_id"), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())]
            sinks[1].write_batch(pa.RecordBatch.from_arrays(index, schema=documents))
        if sinks is None:
            return
        if waiting:
            padded = np.zeros(-(-waiting // size) * size, dtype=kind)
            padded[:waiting] = np.concatenate(held)
            sinks[0].write_batch(as_batch(padded, waiting, size, sequences))
        for sink, file, final in zip(sinks, files, names, strict=True):
            sink.close()
            file.close()
            where.move(f"{final}.{attempt}", final)
        yield pa.RecordBatch.from_pydict(
            {"file": pa.array([name]), "tokens": pa.array([total], pa.int64()), "documents": pa.array([rows], pa.int64())}
        )

    return run


def write_files(docs: DataFrame, folder: str, path: str, size: int = 2048, end: int = 2) -> DataFrame:
    """Write the ids of all texts, each closed by `end`; one row per file: file, base, tokens, documents.

    base is the number of ids in the files before. Null texts count as empty (the end id
    alone); rows with a null doc_id come first, repeated doc_ids follow each other by a hash of
    their text; other columns are left out. An empty table writes nothing.
    """
    narrow = columns_of(docs, doc_id="long", text="string").withColumn("tie", F.xxhash64("text"))
    ranged = narrow.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    files = durable(ranged.mapInArrow(_write(folder, path, size, end), "file string, tokens long, documents long"))
    # One row per file: a small table, whatever the number of documents.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def open_arrow(folder: str, name: str) -> pa.ipc.RecordBatchFileReader:
    """An Arrow file of the folder; local files are memory-mapped and read without copies."""
    where, base = open_folder(folder)
    if isinstance(where, pyarrow.fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(f"{base}/{name}.arrow"))
    return pa.ipc.open_file(where.open_input_file(f"{base}/{name}.arrow"))


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of the i-th sequence of a file; both are views of the file's buffers."""
    batch = reader.get_batch(i // BATCH)
    ids, mask = (batch.column(k)[i % BATCH].values for k in (0, 1))
    return ids.to_numpy(), mask.to_numpy().view(np.bool_)


def _digests(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                reader = open_arrow(folder, f"{file}.sequences")
                documents = open_arrow(folder, f"{file}.documents")
                number, flat, offset = 0, np.zeros(0, "<u4"), 0
                for k in range(documents.num_record_batches):
                    index = documents.get_batch(k)
                    crcs = []
                    for length in index.column("n_tokens").to_pylist():
                        crc = 0
                        while length:
                            if offset == len(flat):
                                read = reader.get_batch(number)
                                mask = read.column(1).values.to_numpy()
                                flat = read.column(0).values.to_numpy().astype("<u4")[: int(mask.sum())]
                                number, offset = number + 1, 0
                            part = flat[offset : offset + length]
                            crc = zlib.crc32(part.tobytes(), crc)
                            offset, length = offset + len(part), length - len(part)
                        crcs.append(crc)
                    yield pa.RecordBatch.from_arrays(
                        [
                            index.column("doc_id"),
                            pa.array(index.column("start").to_numpy() + base),
                            index.column("n_tokens"),
                            pa.array(crcs, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return run


def read_digests(files: DataFrame, folder: str) -> DataFrame:
    """Per document, read from the files: doc_id, start in the whole stream, n_tokens, ids_crc32.

    Each file is a task: ranges of names, as many as files, which adaptive execution does not merge.
    """
    spread = files.select("file", "base").repartitionByRange(max(files.count(), 1), "file")
    return spread.mapInArrow(_digests(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str, size: int = 2048, end: int = 2) -> DataFrame:
    """Write all documents under the shared folder and read them back from the files."""
    folder = work_dir(docs.sparkSession, "token-ids")
    return read_digests(write_files(docs, folder, path, size, end), folder)
