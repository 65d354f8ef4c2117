"""Token-ID output: length-delimited binary records with masked checksums, and a separate offset index.

A shard file holds one record per text, in ascending id order (null ids first; texts of one id by their own order):
    uint64 length | uint32 masked CRC-32C of the length | payload | uint32 masked CRC-32C of the payload
all little endian, as in TFRecord files; mask(c) = rotate_right(c, 15) + 0xA282EAD8. The payload is the token ids as
little-endian unsigned integers of 2 bytes where the vocabulary fits, else 4. The index is a Parquet table with one row
per record (id, file, byte offset, tokens, tokens before it in the file), so a reader can go through records in any order.

Each writing task gives its file a new name, and only the files named in the committed index count: what a lost or
repeated task leaves behind is never read. Folders can be anything that pyarrow.fs opens (local or mounted paths, file://,
s3://, gs://, hdfs://).

Null texts are empty; an empty text is a record with the end id alone. An empty table gives an empty index.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import grid
from ledgerlens.llm.common import new_folder, saved
from ledgerlens.llm.store import Store, ragged

MASK = 0xA282EAD8
POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected
FRAME = 16


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


TABLE = _byte_table()


def _move(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """What zero bytes after it make of a checksum; tables: for each of its four bytes."""
    out = tables[0][crc & 255]
    for k in range(1, 4):
        out = out ^ tables[k][(crc >> np.uint32(8 * k)) & 255]
    return out


def _zeros() -> list[np.ndarray]:
    """Tables of _move for 1, 2, 4, ... zero bytes."""
    one = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    steps = [np.stack([TABLE[x & 255] ^ (x >> np.uint32(8)) for x in one])]
    while len(steps) < 40:
        steps.append(np.stack([_move(steps[-1], x) for x in steps[-1]]))
    return steps


ZEROS = _zeros()
# For eight bytes at once: the j-th of them, with 7 - j bytes after it.
EIGHT = [TABLE]
for _ in range(7):
    EIGHT.append(TABLE[EIGHT[-1] & 255] ^ (EIGHT[-1] >> np.uint32(8)))
PIECE = 1 << 8


def crc32c(data: bytes) -> int:
    """One byte after another: the plain form of crc32c_all."""
    c = 0xFFFFFFFF
    for b in data:
        c = int(TABLE[(c ^ b) & 255]) ^ (c >> 8)
    return c ^ 0xFFFFFFFF


def crc32c_all(rows: list[bytes]) -> np.ndarray:
    """CRC-32C of many byte strings.

    Zeros in front change nothing as long as the register is 0, so every string is filled up in front to pieces of one
    size. All pieces advance together, eight bytes at a time; then neighbours are joined, pairs, pairs of pairs and so on.
    The register starts at all ones: that is added at the end, moved by the string's length.
    """
    sizes = np.array([len(r) for r in rows], np.int64)
    count = np.maximum((sizes + PIECE - 1) // PIECE, 1)
    data = np.frombuffer(b"".join([r.rjust(int(c) * PIECE, b"\0") for r, c in zip(rows, count)]), "<u8").reshape(-1, PIECE // 8)
    crc = np.zeros(len(data), np.uint32)
    for step in range(PIECE // 8):
        x = data[:, step] ^ crc
        crc = EIGHT[7][x & np.uint64(255)]
        for j in range(1, 8):
            crc = crc ^ EIGHT[7 - j][(x >> np.uint64(8 * j)) & np.uint64(255)]
    level = PIECE.bit_length() - 1
    while count.max(initial=1) > 1:
        odd = np.flatnonzero(count % 2)
        crc = np.insert(crc, (np.cumsum(count) - count)[odd], 0)
        count = (count + 1) // 2
        crc = _move(ZEROS[level], crc[::2]) ^ crc[1::2]
        level += 1
    start = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for bit in range(int(sizes.max(initial=0)).bit_length()):
        has = (sizes >> bit) & 1 == 1
        start[has] = _move(ZEROS[bit], start[has])
    return crc ^ start ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    heads = masked(crc32c_all(lengths)).astype("<u4").tobytes()
    tails = masked(crc32c_all(payloads)).astype("<u4").tobytes()
    return [n + heads[4 * i:4 * i + 4] + p + tails[4 * i:4 * i + 4] for i, (n, p) in enumerate(zip(lengths, payloads))]


class WordEncoder:
    """Ids of a tokenizers model whose texts can be encoded word by word: white space only parts words and leaves no id.

    Words are runs between ASCII white space, so other white space stays inside a word and is left to the library. The new words
    of a chunk are encoded in one call, with SIGN between them, whose ids tell where each ends.
    """

    SIGN = "\u2042"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.store = Store(self.kind)
        both = [self.library.encode(t, add_special_tokens=False).ids for t in ("a b", "a", "b", " \n\t\r\x0b\x0c")]
        if both[0] != both[1] + both[2] or both[3]:
            raise ValueError("this tokenizer cannot be applied word by word")
        self.sign = self.library.encode(self.SIGN, add_special_tokens=False).ids

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        joined = f" {self.SIGN} ".join([w.decode() for w in words])
        ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        k = len(self.sign)
        hit = np.ones(max(len(ids) - k + 1, 0), bool)
        for j, i in enumerate(self.sign):
            hit &= ids[j:len(hit) + j] == i
        at = np.flatnonzero(hit)
        if len(at) != len(words) - 1 or (np.diff(at) < k).any():
            # A word holds the sign itself.
            each = [e.ids for e in self.library.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
            return np.array([i for e in each for i in e], self.kind), np.array([len(e) for e in each], np.int64)
        size = np.diff(np.concatenate([[-k], at, [len(ids)]])) - k
        keep = np.ones(len(ids), bool)
        for j in range(k):
            keep[at + j] = False
        return ids[keep].astype(self.kind), size

    def encode(self, chunk: grid.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk's texts, and the number of each text."""
        start, end, row = chunk.words()
        word, first, back = np.unique(chunk.span(chunk.prefix(), start, end, chunk.data), return_index=True, return_inverse=True)
        at, size = self.store.find(word, lambda new: self._learn([chunk.data[start[i]:end[i]].tobytes() for i in first[new]]))
        each = size[back]
        return self.store.values[ragged(at[back], each)], np.bincount(row, weights=each, minlength=chunk.rows).astype(np.int64)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write(df: DataFrame, tokenizer: str, folder: str | None = None, end_id: int | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Encode and write every text; the index: id_col, shard, file, offset, n_tokens, before (tokens before it in its shard).

    Shards follow the id order: a shard's ids are below the next shard's.
    """
    spark = df.sparkSession
    folder = folder or new_folder(spark, "records")
    text = F.coalesce(F.col(text_col), F.lit("")).alias("__text")
    # As many shards as the session shuffles to; each task takes one range of ids.
    ordered = df.select(F.col(id_col).alias("__id"), text).repartitionByRange("__id").sortWithinPartitions("__id", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        tokens = encoder(tokenizer)
        width = np.dtype(tokens.kind).itemsize
        end = b"" if end_id is None else np.array([end_id], tokens.kind).tobytes()
        system.create_dir(root, recursive=True)
        name = f"{root}/shard-{context.partitionId():06d}-{context.taskAttemptId()}.rec"
        place, before, out = 0, 0, None
        try:
            for batch in batches:
                for chunk in grid.chunks(batch.column(1), 1 << 21):
                    ids, number = tokens.encode(chunk)
                    flat, ends = ids.tobytes(), np.cumsum(number) * width
                    payloads = [flat[b - n * width:b] + end for b, n in zip(ends.tolist(), number.tolist())]
                    out = out or system.open_output_stream(name)
                    out.write(b"".join(frames(payloads)))
                    number = np.array([len(p) // width for p in payloads], np.int64)
                    size = number * width + FRAME
                    n = len(number)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(chunk.first, n), pa.array([context.partitionId()] * n, pa.int32()), pa.array([name] * n),
                         pa.array(place + np.cumsum(size) - size), pa.array(number), pa.array(before + np.cumsum(number) - number)],
                        [id_col, "shard", "file", "offset", "n_tokens", "before"])
                    place, before = place + int(size.sum()), before + int(number.sum())
        finally:
            if out:
                out.close()

    kind = ordered.schema[0].dataType.simpleString()
    return saved(ordered.mapInArrow(run, f"`{id_col}` {kind}, shard int, file string, offset long, n_tokens long, before long"), "index")


def read(index: DataFrame, folder_of: str, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """The records named by an index, checked: id_col, shard, before, n_tokens and payload (ids as unsigned 32-bit, little endian).

    Each file is read from front to back by one task; folder_of names the file system (any path on it).
    """
    by_file = index.repartition("file").sortWithinPartitions("file", "offset")
    kind = by_file.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder_of)
        tokens = encoder(tokenizer)
        width = np.dtype(tokens.kind).itemsize
        name, source = None, None
        try:
            for batch in batches:
                files, number = batch.column("file").to_pylist(), batch.column("n_tokens").to_pylist()
                offset = batch.column("offset").to_pylist()
                first = 0
                while first < batch.num_rows:
                    # About four MB of records at once, all from one file.
                    last, size = first, 0
                    while last < batch.num_rows and files[last] == files[first] and (last == first or size < 1 << 22):
                        size += number[last] * width + FRAME
                        last += 1
                    if files[first] != name:
                        source = source and source.close()
                        name = files[first]
                        source = system.open_input_file(name)
                    payloads = []
                    at, data = offset[first], b""
                    for k in range(first, last):
                        if offset[k] != at or not data:
                            # Records that follow each other are read in one go; others by their own offset.
                            run_on = k
                            while run_on + 1 < last and offset[run_on + 1] == offset[run_on] + number[run_on] * width + FRAME:
                                run_on += 1
                            data = source.read_at(offset[run_on] + number[run_on] * width + FRAME - offset[k], offset[k])
                            base = offset[k]
                        at = offset[k] + number[k] * width + FRAME
                        payloads.append(data[offset[k] - base:at - base])
                    bodies = [p[12:-4] for p in payloads]
                    if frames(bodies) != payloads or [len(b) for b in bodies] != [n * width for n in number[first:last]]:
                        raise ValueError(f"damaged records in {name}")
                    wide = [b if width == 4 else np.frombuffer(b, "<u2").astype("<u4").tobytes() for b in bodies]
                    part = batch.slice(first, last - first)
                    yield pa.RecordBatch.from_arrays([part.column(id_col), part.column("shard"), part.column("before"),
                                                      part.column("n_tokens"), pa.array(wide, pa.binary())],
                                                     [id_col, "shard", "before", "n_tokens", "payload"])
                    first = last
        finally:
            if source:
                source.close()

    return by_file.mapInArrow(run, f"`{id_col}` {kind}, shard int, before long, n_tokens long, payload binary")


def starts(records: DataFrame, index: DataFrame) -> DataFrame:
    """records with start, the tokens of all texts before; sums of whole shards, one row per shard, give each shard's base."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("__all"))
    # A window over shards: as many rows as there are files.
    base = totals.select("shard", F.coalesce(F.sum("__all").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    return records.join(F.broadcast(base), "shard").withColumn("start", F.col("__base") + F.col("before")).drop("__base")
