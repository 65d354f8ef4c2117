"""Packing token pieces into sequences: best fit, then a local search by swaps.

Texts become token ids with an end id; what is longer than a sequence is cut. Pieces shorter than a sequence are dealt at random to shards of
about SHARD pieces, and each shard is packed by one task: best fit in falling order of length, then a local search over the bins that
are not full. It moves one piece to another bin, or exchanges one for one or two for one, whenever the sum of squared fills grows, best
exchange first, emptiest bin first. That empties bins, since a full and an empty bin have a larger sum than two half-full ones. Bins still
not full then meet those of other shards for the same search again, in turn by their free space (the emptiest ones together) and at
random, until two rounds running save no sequence. Only row numbers and lengths go through the shards; tokens do not.

Rows are told apart by a number given when pieces are written, so null or repeated ids and repeated rows are packed like any others and a hot
id fills as many shards as its pieces ask for. Null texts are empty; an empty text is a piece of the end id alone. Ties in length go
by row number. An empty table gives empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import grid
from ledgerlens.llm.common import Scratch, saved
from ledgerlens.llm.records import encoder
from ledgerlens.llm.store import ragged

SEQUENCE = 2048
SHARD = 4096
ROUNDS = 6
# A shard's search ends after so many exchanges a piece; it has never been seen to come near.
STEPS = 20
_PLAN = "row long, length int, sequence_id long, offset long, free int"


def pieces(df: DataFrame, tokenizer: str, end_id: int = 0, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (unique), id_col, piece, start, length, ids (unsigned 32-bit, little endian) of every piece of every text, saved."""
    source = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    kind = source.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, row = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            for chunk in grid.chunks(batch.column(1), 1 << 21):
                ids, number = tokens.encode(chunk)
                flat = np.insert(ids.astype("<u4"), np.cumsum(number), end_id)
                length = number + 1
                count = -(-length // size)
                piece = ragged(np.zeros(len(count), np.int64), count)
                text = np.repeat(np.arange(chunk.rows), count)
                start = piece * size
                long = np.minimum(length[text] - start, size)
                ends = np.concatenate([[0], np.cumsum(long)])
                for at in range(0, len(text), 1 << 14):  # at most 128 MB of ids at once
                    cut = slice(at, min(at + (1 << 14), len(text)))
                    place = ends[cut.start:cut.stop + 1]
                    body = flat[place[0]:place[-1]].tobytes()
                    data = pa.BinaryArray.from_buffers(pa.binary(), len(place) - 1, [None, pa.py_buffer(((place - place[0]) * 4).astype(np.int32)), pa.py_buffer(body)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row + np.arange(cut.start, cut.stop)), batch.column(0).take(pa.array(chunk.first + text[cut])), pa.array(piece[cut], pa.int32()),
                         pa.array(start[cut]), pa.array(long[cut], pa.int32()), data], ["row", id_col, "piece", "start", "length", "ids"])
                row += len(text)

    return saved(source.mapInArrow(run, f"row long, `{id_col}` {kind}, piece int, start long, length int, ids binary"), "pieces")


def best_fit(lengths: np.ndarray, size: int) -> np.ndarray:
    """The bin of each piece, pieces taken as given: of the bins that have room the fullest, else a new one."""
    with_free: list[list[int]] = [[] for _ in range(size + 1)]
    some, bins, out = 0, 0, []  # some: bit f is set where a bin has f free
    for length in lengths.tolist():
        if room := some >> length:
            free = length + (room & -room).bit_length() - 1
            found = with_free[free].pop()
            if not with_free[free]:
                some ^= 1 << free
        else:
            free, found, bins = size, bins, bins + 1
        with_free[free - length].append(found)
        some |= 1 << (free - length)
        out.append(found)
    return np.array(out, np.int64)


def _gives(own: np.ndarray, lengths: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """What a bin can give: each different amount of one or two of its pieces, and these."""
    amounts: dict[int, tuple[int, ...]] = {}
    length = lengths[own].tolist()
    by_length: dict[int, list[int]] = {}
    for place, n in zip(own.tolist(), length):
        by_length.setdefault(n, []).append(place)
    for n, places in by_length.items():
        amounts.setdefault(n, (places[0],))
    kinds = sorted(by_length)
    for i, n in enumerate(kinds):
        if len(by_length[n]) > 1:
            amounts.setdefault(2 * n, tuple(by_length[n][:2]))
        for m in kinds[i + 1:]:
            amounts.setdefault(n + m, (by_length[n][0], by_length[m][0]))
    return list(amounts.items())


def search(lengths: np.ndarray, bins: np.ndarray, size: int, steps: int) -> np.ndarray:
    """The bins after moves and exchanges, until none makes the sum of squared fills grow."""
    bins = bins.copy()
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    left, changed = steps, True
    while changed and left > 0:
        changed = False
        open_ = np.flatnonzero((fill > 0) & (fill < size))
        inside = np.flatnonzero(fill[bins] < size)
        if len(open_) < 2:
            break
        members = {b: set() for b in open_.tolist()}
        for place, b in zip(inside.tolist(), bins[inside].tolist()):
            members[b].add(place)
        length = lengths[inside]
        for c in open_[np.argsort(fill[open_], kind="stable")].tolist():
            while 0 < fill[c] < size and left > 0:
                gives = _gives(np.array(sorted(members[c]), np.int64), lengths)
                g = np.array([amount for amount, _ in gives])[:, None]
                home = bins[inside]
                there = fill[home]
                # d goes from c to the other bin, net; against a piece of it, or against nothing.
                swap = g - length
                gain = 2 * swap * (there - fill[c] + swap)
                gain[(swap > size - there) | (-swap > size - fill[c]) | (home == c)] = 0
                others = open_[(open_ != c) & (fill[open_] > 0)]
                move = 2 * g * (fill[others] - fill[c] + g)
                move[g > size - fill[others]] = 0
                best_swap, best_move = gain.max(initial=0), move.max(initial=0)
                if max(best_swap, best_move) <= 0:
                    break
                if best_move >= best_swap:
                    i, j = np.unravel_index(move.argmax(), move.shape)
                    other, back = int(others[j]), ()
                else:
                    i, j = np.unravel_index(gain.argmax(), gain.shape)
                    other, back = int(home[j]), (int(inside[j]),)
                for places, a, b in ((gives[i][1], c, other), (back, other, c)):
                    for place in places:
                        bins[place] = b
                        members[a].discard(place)
                        members[b].add(place)
                        fill[a] -= lengths[place]
                        fill[b] += lengths[place]
                changed, left = True, left - 1
    return bins


def _placed(row: np.ndarray, length: np.ndarray, bins: np.ndarray, size: int) -> pd.DataFrame:
    """Pieces of one bin in order of their row numbers; the least of these names the sequence."""
    order = np.lexsort((row, bins))
    row, length, bins = row[order], length[order], bins[order]
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]])) if len(bins) else np.zeros(0, np.int64)
    each = np.diff(np.append(first, len(bins)))
    before = np.cumsum(length) - length
    total = np.add.reduceat(length, first) if len(first) else np.zeros(0, np.int64)
    return pd.DataFrame({"row": row, "length": length, "sequence_id": np.repeat(row[first], each), "offset": before - np.repeat(before[first], each), "free": np.repeat(size - total, each)})


def pack(cut: DataFrame, size: int = SEQUENCE, shard: int = SHARD, rounds: int = ROUNDS) -> DataFrame:
    """row, sequence_id, offset of every piece (row, length), saved: sequences are gapless and hold at most `size` tokens."""
    scratch = Scratch(cut.sparkSession)
    short = cut.select("row", "length").where(F.col("length") < size)
    number = short.count()

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "row"], ascending=[False, True])
        length = rows["length"].to_numpy(np.int64)
        return _placed(rows["row"].to_numpy(np.int64), length, search(length, best_fit(length, size), size, STEPS * len(length)), size)

    dealt = short.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-number // shard)))))
    state = scratch.save(dealt.groupBy("shard").applyInPandas(fill, _PLAN), "packed")

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"row": [], "length": [], "sequence_id": []}, dtype=np.int64), *batches]).sort_values(["length", "row"], ascending=[False, True])
        length = rows["length"].to_numpy(np.int64)
        bins = np.unique(rows["sequence_id"].to_numpy(np.int64), return_inverse=True)[1]
        yield _placed(rows["row"].to_numpy(np.int64), length, search(length, bins, size, STEPS * len(length)), size)

    done = state.where("free = 0")
    # Bins that are not full, one row per piece; a bin's pieces have the same key and stay together.
    state = state.where("free > 0")
    least, idle = None, 0
    for k in range(rounds):
        open_, bins = state.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
        idle = 0 if least is None or bins < least else idle + 1
        if not open_ or idle == 2:
            break
        least = bins
        # New neighbours in every round; the ranges are as many as the open pieces ask for.
        near = F.desc("free") if k % 2 == 0 else F.xxhash64("sequence_id", F.lit(k))
        state = scratch.save(state.repartitionByRange(max(1, -(-open_ // shard)), near, "sequence_id").mapInPandas(again, _PLAN), "packed")
    whole = cut.where(F.col("length") == size).select("row", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    plan = whole.unionByName(done.select("row", "sequence_id", "offset")).unionByName(state.select("row", "sequence_id", "offset"))
    plan = saved(plan, "plan")
    scratch.drop_all_but(0)
    return plan


def place(cut: DataFrame, plan: DataFrame) -> DataFrame:
    """Pieces with their sequence and offset; whatever other columns cut has stay."""
    return cut.join(plan, "row").drop("row")


def sequences(placed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """sequence_id, n_tokens, ids (at most a sequence's) and parts: which text's tokens begin where, for masks between texts."""
    part = F.struct("offset", "length", F.col(id_col).alias("id"), "piece", "ids")
    rows = placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(part)).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return rows.select("sequence_id", "n_tokens", joined.alias("ids"),
                       F.transform("p", lambda x: F.struct(x["offset"].alias("offset"), x["length"].alias("length"), x["id"].alias("id"), x["piece"].alias("piece"))).alias("parts"))
