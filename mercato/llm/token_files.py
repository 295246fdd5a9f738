"""Token ids as Arrow files of equal-length sequences with masks.

Documents are dealt by ranges of ``doc_id``; each task writes one shard, an Arrow IPC file whose batches hold two
fixed-size-list columns, ``ids`` and ``mask``. Within a shard the ids of its documents follow one another without a
gap, cut every ``length`` ids; only the last sequence of a shard is padded, which its mask shows. As all sequences
are equally long and the file is not compressed, any stretch of ids is a slice of a memory map.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from mercato.llm.common import driver_file
from mercato.session import materialise

LENGTH = 2048  # ids in a sequence
BATCH = 128  # sequences in a batch
KEPT_CHUNKS = 1 << 21  # chunks of up to 32 bytes whose ids a worker remembers; beyond that it starts afresh


# signs that no rule joins to an ASCII letter before them; an apostrophe may start a contraction
_ENDING = b"""!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"""


class _Chunks(dict):
    """Stretch between white space -> its ids as bytes."""

    def __init__(self, tokenizer, kind):
        super().__init__()
        self.tokenizer, self.model, self.kind, self.code = tokenizer, tokenizer.model, kind, np.dtype(kind).char

    def __missing__(self, chunk: bytes) -> bytes:
        packed = self._encoded(chunk)
        if len(self) >= KEPT_CHUNKS:
            self.clear()
        if len(chunk) <= 32:
            self[chunk] = packed
        return packed

    def _encoded(self, chunk: bytes) -> bytes:
        if b"<|" not in chunk:  # a special token's name is looked for as written
            body = chunk.rstrip(_ENDING)
            if body[-1:].isalpha() and len(body) < len(chunk):
                return self[body] + self[chunk[len(body):]]
            if chunk.isascii():
                lowered = chunk.lower()
                if lowered != chunk:
                    return self[lowered]
                if chunk.isalpha():  # nothing to normalise or split, so the model's turn
                    return self._packed([t.id for t in self.model.tokenize(chunk.decode())])
        return self._packed(self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)


@lru_cache(maxsize=2)
def _chunks(raw: bytes, names_as_text: bool) -> _Chunks:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(raw)
    tokenizer.encode_special_tokens = names_as_text
    tokenizer.no_truncation()
    return _Chunks(tokenizer, id_type(tokenizer.get_vocab_size()))


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encode_text(raw: bytes, text: str | None, names_as_text: bool = True) -> bytes:
    """Packed ids of a text. The tokenizer drops white space, and no token or rule spans ASCII white space, so the ids
    of a text are those of its stretches between white space, one after the other.

    The tokenizer composes letters (NFC) before it lower-cases them, so only ASCII stretches are lowered here, to remember
    fewer of them; nor such as may name a special token.
    """
    signs = (text or "").encode()
    if signs.isascii() and b"<|" not in signs:
        signs = signs.lower()
    return b"".join(map(_chunks(raw, names_as_text).__getitem__, signs.split()))


class _Shard:
    """Writes packed ids into one file; the file appears under its name only when whole."""

    def __init__(self, folder: str, name: str, kind: str, length: int):
        from pyarrow.fs import FileSystem

        self.fs, root = FileSystem.from_uri(folder)
        context = TaskContext.get()
        self.path = f"{root}/{name}"
        self.part = f"{root}/.{name}.{context.taskAttemptId() if context else 0}"
        self.length, self.kind = length, np.dtype(kind)
        self.schema = schema(length, self.kind)
        self.sink = self.fs.open_output_stream(self.part)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.waiting: list[bytes] = []
        self.size = 0

    def add(self, packed: bytes) -> None:
        self.waiting.append(packed)
        self.size += len(packed)
        if self.size >= self.length * BATCH * self.kind.itemsize:
            self._write(last=False)

    def _write(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), self.kind)
        step = self.length * BATCH
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            self._batch(ids[at:at + step], step)
        rest = ids[whole:]
        if last and len(rest):
            self._batch(rest, -(-len(rest) // self.length) * self.length)
            rest = rest[:0]
        self.waiting, self.size = [rest.tobytes()], rest.nbytes

    def _batch(self, ids: np.ndarray, room: int) -> None:
        mask = np.arange(room) < len(ids)
        padded = np.zeros(room, self.kind)
        padded[:len(ids)] = ids
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (padded, mask)]
        self.writer.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        self._write(last=True)
        self.writer.close()
        self.sink.close()
        self.fs.move(self.part, self.path)


def schema(length: int, kind: np.dtype) -> pa.Schema:
    return pa.schema([
        pa.field("ids", pa.list_(pa.from_numpy_dtype(kind), length)), pa.field("mask", pa.list_(pa.bool_(), length))])


def shard_name(number: int) -> str:
    return f"shard-{number:07d}.arrow"


class Reader:
    """Random access to one shard."""

    def __init__(self, folder: str, number: int):
        from pyarrow.fs import FileSystem, LocalFileSystem

        fs, root = FileSystem.from_uri(folder)
        path = f"{root}/{shard_name(number)}"
        source = pa.memory_map(path) if isinstance(fs, LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Views of the stored ids from ``start`` on, as far as the mask holds."""
        step = self.length * BATCH
        while count > 0:
            number, offset = divmod(start, step)
            if number != self.at:
                batch = self.file.get_batch(number)
                held = batch.column(1).values
                self.at = number
                self.batch = batch.column(0).values.to_numpy(zero_copy_only=True)[:held.true_count]
            piece = self.batch[offset:offset + count]
            if not len(piece):
                raise ValueError("the shard ends before the document does")
            yield piece
            start, count = start + len(piece), count - len(piece)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
    length: int = LENGTH, names_as_text: bool = True,
) -> DataFrame:
    """Write the ids of every text and ``end_id`` after each into ``folder`` (a URI all executors reach), in ascending
    ``id_col``; return the index: ``id_col``, start, n_tokens, shard, at.

    ``start`` counts the ids of all documents before it, ``at`` those before it in its shard. Null ids come first;
    equal ids in the order of their texts' XXH64; null texts count as empty; repeated rows are all written. An
    empty table writes no shard and gives an empty index. Other columns are not read, whatever their names. A shard
    is renamed into place when whole, so a task that runs again replaces it with the same bytes. A special token's name
    in a text is ordinary text, or with ``names_as_text`` off that token, as the tokenizers library does by default.
    """
    raw = docs.sparkSession.sparkContext.broadcast(driver_file(tokenizer_path))
    fields = [docs.schema[id_col], StructField("n_tokens", LongType()), StructField("shard", LongType()), StructField("at", LongType())]

    def write(batches):
        chunks = _chunks(raw.value, names_as_text)
        kind = np.dtype(chunks.kind)
        end = np.array([end_id], kind).tobytes()
        number = TaskContext.get().partitionId()
        shard, at = None, 0
        for batch in batches:
            counts, starts = [], []
            for text in batch.column(1):
                shard = shard or _Shard(folder, shard_name(number), kind.str, length)
                packed = encode_text(raw.value, text.as_py(), names_as_text) + end
                shard.add(packed)
                counts.append(len(packed) // kind.itemsize)
                starts.append(at)
                at += counts[-1]
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array([number] * len(counts), pa.int64()), pa.array(starts, pa.int64())],
                names=[f.name for f in fields])
        if shard:
            shard.close()

    _make_folder(docs.sparkSession, folder)
    # the hash keeps texts out of the sample that the ranges are drawn from
    order = [F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)]
    index = (
        docs.select(id_col, text_col).repartitionByRange(*order).sortWithinPartitions(*order, text_col)
        .mapInArrow(write, StructType(fields)))
    index = materialise(index, "token-index")
    sizes = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # one row a shard
    before, bases = 0, []
    for row in sizes:
        bases.append((row["shard"], before))
        before += row["n"]
    base = docs.sparkSession.createDataFrame(bases, "shard long, base long")
    return index.join(F.broadcast(base), "shard").select(
        id_col, (F.col("base") + F.col("at")).alias("start"), "n_tokens", "shard", "at")


def _make_folder(spark, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def read_checksums(index: DataFrame, folder: str) -> DataFrame:
    """``index`` with ``ids_crc32``: the CRC-32 of each document's ids as little-endian unsigned 32-bit integers, read
    from the files. Rows of a shard lie together in the index, so each task opens a file once."""
    out = StructType([*index.schema.fields, StructField("ids_crc32", LongType())])
    columns = index.columns

    def read(batches):
        number, reader = None, None
        for batch in batches:
            values = (batch.column(columns.index(c)).to_pylist() for c in ("shard", "at", "n_tokens"))
            sums = []
            for shard, at, count in zip(*values):
                if shard != number:
                    number, reader = shard, Reader(folder, shard)
                crc = 0
                for piece in reader.ids(at, count):
                    crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                sums.append(crc)
            yield pa.record_batch([*batch.columns, pa.array(sums, pa.int64())], names=out.names)

    return index.mapInArrow(read, out)
