"""Suffix-array dedup: bytes covered by a string of LENGTH bytes that starts elsewhere too.

Prefix doubling names every position by the string of 2^k bytes at it, from pairs of names, until names are unique or the
threshold is passed. Done for all positions it sorts as many rows as the corpus has bytes in every round. Here the
rounds keep its names and its rule (a unique name ends a position), but only positions that can still matter take part:

1. GRAM bytes. Of the GRAM-byte strings inside a window of LENGTH bytes, the one with the least hash (the leftmost of equals)
   is the window's anchor. Equal windows have equal anchors at equal distances, so a window whose anchor's name is unique is
   unique. About one position in LENGTH - GRAM halves is an anchor; Spark counts their names.
2. Anchor and its surroundings: all windows of one anchor form a block, named by the bytes they cover. A block name
   found twice settles all its windows at once; that is all of a copied text but its edges.
3. LENGTH bytes, only in classes of one anchor name with different blocks, at least one of them unsettled: the names of
   their windows are counted inside the class.

Names are 64-bit hashes; blocks are told apart by anchor name and block name together. Classes with more than HOT blocks are counted window by
window by Spark, with sums in each task first; smaller ones are sorted together in NumPy, as many as fit MEMORY blocks. Bit maps
of bounded size (bloom.py) keep positions without partner out of the second and third round.

Texts are their UTF-8 bytes, null is empty; texts shorter than LENGTH bytes are never touched. Rows are told apart by id and
text; repeated rows are copies of each other and both lose their bytes. Matches never cross texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import bloom, grid
from ledgerlens.llm.common import saved

LENGTH = 200
GRAM = 50
HOT = 20_000
MEMORY = 40_000
_AT = 28  # bits for a place inside a chunk


class Blocks:
    """The anchors of a chunk: name, row, first window (in the row), number of windows; starts: first window in the chunk."""

    def __init__(self, chunk: grid.Chunk, length: int, gram: int):
        n, width = len(chunk.data), length - gram + 1
        self.prefix = chunk.prefix()
        self.name, self.row, self.first, self.count, self.starts = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64))
        if n < length:
            return
        grams = grid.mix((self.prefix[gram:] - self.prefix[:-gram]) * grid.powers(n, True)[:n - gram + 1])
        ranked = (grams >> np.uint64(_AT) << np.uint64(_AT)) | np.arange(len(grams), dtype=np.uint64)
        # Least of every `width` neighbours: from the ends of blocks of that width.
        rows = -(-len(ranked) // width)
        padded = np.full(rows * width, np.uint64(2 ** 64 - 1))
        padded[:len(ranked)] = ranked
        padded = padded.reshape(rows, width)
        left = np.minimum.accumulate(padded, axis=1).ravel()
        right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - length + 1
        place = (np.minimum(right[:windows], left[width - 1:width - 1 + windows]) & np.uint64((1 << _AT) - 1)).astype(np.int64)
        # Windows that lie in one text.
        fits = np.zeros(n + 1, np.int64)
        whole = chunk.sizes >= length
        np.add.at(fits, chunk.offsets[:-1][whole], 1)
        np.subtract.at(fits, chunk.offsets[1:][whole] - length + 1, 1)
        inside = np.flatnonzero(np.cumsum(fits[:windows]) > 0)
        if not len(inside):
            return
        anchor = place[inside]
        new = np.ones(len(inside), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1)
        at = np.flatnonzero(new)
        self.starts = inside[at]
        self.row = chunk.row_of(self.starts)
        # A window run over the end of a text starts a new block.
        self.name = grams[anchor[at]]
        self.count = np.diff(np.append(at, len(inside)))
        self.first = self.starts - chunk.offsets[self.row]

    def names(self, length: int, pick: np.ndarray) -> np.ndarray:
        s = self.starts[pick]
        return grid.mix(grid.Chunk.span(self.prefix, s, s + self.count[pick] - 1 + length) ^ self.count[pick].astype(np.uint64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _class_windows(rows: list[tuple[int, int, int, bytes]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For blocks (class, block, windows, bytes): each window's block (place in rows), offset and name, mixed with the class."""
    data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    sizes = np.array([len(r[3]) for r in rows])
    count = np.array([r[2] for r in rows])
    begins = np.cumsum(sizes) - sizes
    block = np.repeat(np.arange(len(rows)), count)
    offset = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    at = begins[block] + offset
    prefix = grid.Chunk(0, data, np.array([0, len(data)])).prefix()
    name = grid.Chunk.span(prefix, at, at + length)
    return block, offset, grid.mix(name ^ np.array([r[0] for r in rows], np.int64).view(np.uint64)[block])


def repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Spans of windows that occur elsewhere: __id, __h (hash of the text), spans (array of start, end; bytes; may overlap)."""
    rows = df.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__h"), F.col(text_col).alias("__text"))
    texts = rows.select("__text").where(F.octet_length("__text") >= length)

    def count_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in grid.chunks(batch.column(0)):
                name, number = np.unique(Blocks(chunk, length, gram).name, return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(name), pa.array(number)], ["name", "n"])

    names = texts.mapInArrow(count_names, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")).where("n > 1")
    names = saved(names.select("name"), "names")
    shared = bloom.build(names, "name", names.count())

    def list_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in grid.chunks(batch.column(2)):
                b = Blocks(chunk, length, gram)
                pick = np.flatnonzero(bloom.test(shared.value, b.name))
                row = pa.array(b.row[pick] + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), _signed(b.name[pick]), _signed(b.names(length, pick)),
                     pa.array(b.first[pick].astype(np.int32)), pa.array(b.count[pick].astype(np.int32))], ["__id", "__h", "name", "block", "first", "count"])

    kind = rows.schema[0].dataType.simpleString()
    long_rows = rows.where(F.octet_length("__text") >= length)
    blocks = saved(long_rows.mapInArrow(list_blocks, f"__id {kind}, __h long, name long, block long, first int, count int"), "blocks")
    seen = saved(blocks.groupBy("name", "block").agg(F.count(F.lit(1)).alias("n")), "seen")
    classes = seen.groupBy("name").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    classes = saved(classes.select("name", "kinds"), "classes")
    mixed = bloom.build(classes, "name", classes.count())

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in grid.chunks(batch.column(0)):
                b = Blocks(chunk, length, gram)
                pick = np.flatnonzero(bloom.test(mixed.value, b.name))
                block = b.names(length, pick)
                _, once = np.unique(block, return_index=True)
                pick, block = pick[once], block[once]
                data = [chunk.data[s:s + c - 1 + length].tobytes() for s, c in zip(b.starts[pick], b.count[pick])]
                yield pa.RecordBatch.from_arrays([_signed(b.name[pick]), _signed(block), pa.array(b.count[pick].astype(np.int32)), pa.array(data, pa.binary())],
                                                 ["name", "block", "count", "bytes"])

    around = texts.mapInArrow(contexts, "name long, block long, count int, bytes binary")
    large = saved(classes.where(F.col("kinds") > hot).select("name"), "large")
    if large.isEmpty():
        few, many = around, None
    else:
        around = saved(around, "contexts")
        few, many = around.join(large, "name", "left_anti"), around.join(large, "name", "left_semi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        last = None

        def settle() -> pa.RecordBatch:
            block, offset, name = _class_windows(held, length)
            _, back, number = np.unique(name, return_inverse=True, return_counts=True)
            twice = number[back] > 1
            block, offset = block[twice], offset[twice]
            sizes = np.bincount(block, minlength=len(held))
            offsets = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(offset.astype(np.int32)))
            return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()), offsets], ["name", "block", "offsets"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] == last:
                    continue
                if held and len(held) >= MEMORY and row[0] != held[-1][0]:
                    yield settle()
                    held = []
                held.append(row)
                last = row[:2]
        if held:
            yield settle()

    found = few.repartition("name").sortWithinPartitions("name", "block").mapInArrow(compare, "name long, block long, offsets array<int>")
    if many is not None:
        def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first in range(0, batch.num_rows, 2000):
                    part = list(zip(*(c.to_pylist() for c in batch.slice(first, 2000).columns)))
                    block, offset, name = _class_windows(part, length)
                    ids = np.array([[r[0], r[1]] for r in part], np.int64)[block]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(offset.astype(np.int32)), _signed(name)],
                                                     ["name", "block", "offset", "window"])

        windows = saved(many.dropDuplicates(["name", "block"]).mapInArrow(spell, "name long, block long, offset int, window long"), "windows")
        twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
        listed = windows.join(twice, "window").groupBy("name", "block").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))
        found = found.unionByName(listed)
    found = saved(found.where(F.size("offsets") > 0), "found")
    settled = seen.where("n > 1").select("name", "block", F.lit(None).cast("array<int>").alias("offsets"))
    verdict = settled.unionByName(found.join(seen.where("n = 1").select("name", "block"), ["name", "block"]))
    first = F.col("first")
    whole = F.array(F.struct(first.alias("start"), (first + F.col("count") - 1 + length).alias("end")))
    each = F.transform("offsets", lambda o: F.struct((first + o).alias("start"), (first + o + length).alias("end")))
    spans = blocks.join(verdict, ["name", "block"]).select("__id", "__h", F.when(F.col("offsets").isNull(), whole).otherwise(each).alias("s"))
    return spans.groupBy("__id", "__h").agg(F.flatten(F.collect_set("s")).alias("spans"))


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per row of df: id_col, n_bytes, kept (binary: the bytes left), spans (array of start, end: maximal removed runs)."""
    spans = repeated(df, id_col, text_col, length, gram, hot).select(F.col("__id").alias("__i"), F.col("__h").alias("__k"), "spans")
    rows = df.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__h"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    joined = rows.join(spans, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__h") == F.col("__k")), "left").select("__id", "__text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, marked = batch.columns
            texts = texts.cast(pa.large_binary())
            for first in range(0, batch.num_rows, 256):
                kept, runs, sizes = [], [], []
                for k in range(first, min(first + 256, batch.num_rows)):
                    data, found = texts[k].as_buffer() if texts[k].is_valid else None, marked[k]
                    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
                    sizes.append(len(data))
                    if not found.is_valid:
                        kept.append(data.tobytes())
                        runs.append([])
                        continue
                    pairs = found.values
                    depth = np.zeros(len(data) + 1, np.int64)
                    np.add.at(depth, pairs.field("start").to_numpy(), 1)
                    np.subtract.at(depth, pairs.field("end").to_numpy(), 1)
                    gone = np.cumsum(depth)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                    kept.append(data[~gone].tobytes())
                    runs.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(kept)), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()),
                     pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], [id_col, "n_bytes", "kept", "spans"])

    kind = rows.schema[0].dataType.simpleString()
    return joined.mapInArrow(cut, f"`{id_col}` {kind}, n_bytes long, kept binary, spans array<struct<start:int,end:int>>")
