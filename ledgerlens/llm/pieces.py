"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is a run of symbols, one for each character, blanks written as U+2581 and one put in front. Encoding merges the
adjacent pair whose joined piece has the highest score, the leftmost of equals, until no pair is a piece. `merge` does so
with an agenda, a heap of pairs ordered by score and place. `_merge_all` runs the same agenda over many words in step:
each round takes from every word the pair that its heap would give. Characters without a piece become byte pieces.

Where no piece holds a blank after another character, merges never cross a word's end, so a text is encoded word by word
and each distinct word of a chunk once; a bounded number of words is kept between chunks (store.py). All words new to a worker are also
encoded by the sentencepiece library, in one call for each chunk of an Arrow batch, and a difference ends the job. Other
vocabularies are taken text by text by the same agenda, each text checked.

Null texts are empty; an empty text has no ids and decodes to the empty text. U+2581 in a text counts as a blank, as in
the library, and decodes to one. Vocabularies must leave characters as they are (no normalization).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import grid
from ledgerlens.llm.common import map_arrow
from ledgerlens.llm.store import Store, ragged

BLANK = "▁"
# Bytes of text that are encoded together; a worker holds up to 70 times as much meanwhile.
CHUNK = 1 << 19
# Longer words go through `merge` one at a time.
WIDTHS = (6, 10, 16, 28)
_NONE = np.int32(2 ** 31 - 1)


class Vocabulary:
    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.vocab_size()
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        byte = [self.library.is_byte(i) for i in range(n)]
        skip = [self.library.is_control(i) or self.library.is_unknown(i) for i in range(n)]
        if any(self.library.is_unused(i) for i in range(n)) or not any(byte):
            raise ValueError("vocabularies with unused pieces or without byte pieces are not supported")
        self.ids = {p: i for i, p in enumerate(pieces) if not byte[i] and not skip[i]}
        self.scores = [self.library.get_score(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int32)
        for i, p in enumerate(pieces):
            if byte[i]:
                self.byte_ids[int(p[3:5], 16)] = i
        self.by_word = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        surface = [bytes([int(p[3:5], 16)]) if byte[i] else b"" if self.library.is_control(i) else b" \xe2\x81\x87 " if skip[i]
                   else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.surface, self.surface_bytes = surface, np.frombuffer(b"".join(surface), np.uint8)
        self.surface_size = np.array([len(s) for s in surface])
        self.surface_start = np.cumsum(self.surface_size) - self.surface_size
        # Symbols: the pieces, then characters that are part of pieces but no pieces themselves.
        chars = sorted({c for p in self.ids for c in p} - set(self.ids))
        self.symbol = np.full(0x110000, -1, np.int32)
        for c, i in [(c, i) for c, i in self.ids.items() if len(c) == 1] + [(c, n + k) for k, c in enumerate(chars)]:
            self.symbol[ord(c)] = i
        number = self.ids | {c: n + k for k, c in enumerate(chars)}
        self.no_piece = {n + k: c for k, c in enumerate(chars)}
        # Pieces by falling score; a pair's rank is its joined piece's.
        order = sorted(self.ids.values(), key=lambda i: -self.scores[i])
        rank, last = {}, None
        for place, i in enumerate(order):
            last = place if not place or self.scores[i] != self.scores[order[place - 1]] else last
            rank[i] = last
        pairs = [(number[p[:k]], number[p[k:]], rank[i], i) for p, i in self.ids.items() for k in range(1, len(p))
                 if p[:k] in number and p[k:] in number]
        self._table(np.array(pairs, np.int64).reshape(-1, 4))
        self.store = Store("<i4")

    def _table(self, pairs: np.ndarray) -> None:
        """A hash table of pairs, open addressing, as arrays."""
        self.bits = max(10, int(np.ceil(np.log2(max(len(pairs), 1) * 4))))
        key = pairs[:, 0] << 32 | pairs[:, 1]
        self.t_key = np.full(1 << self.bits, -1, np.int64)
        self.t_rank = np.full(1 << self.bits, _NONE, np.int32)
        self.t_piece = np.zeros(1 << self.bits, np.int32)
        at, left, self.probes = self._slot(key), np.arange(len(key)), 0
        while len(left):
            self.probes += 1
            free = self.t_key[at[left]] < 0
            tried = left[free]
            self.t_key[at[tried]] = key[tried]  # of several for one slot the last stays
            done = self.t_key[at[left]] == key[left]
            won = left[done]
            self.t_rank[at[won]], self.t_piece[at[won]] = pairs[won, 2], pairs[won, 3]
            left = left[~done]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of joined pairs; rank _NONE where there is none."""
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        rank, piece = np.full(len(key), _NONE, np.int32), np.zeros(len(key), np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        for _ in range(self.probes):
            here = self.t_key[at[todo]]
            hit = here == key[todo]
            rank[todo[hit]], piece[todo[hit]] = self.t_rank[at[todo[hit]]], self.t_piece[at[todo[hit]]]
            todo = todo[~hit & (here >= 0)]
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
        return rank, piece

    def merge(self, text: str) -> list[int]:
        """Ids of a text whose blanks are written as U+2581."""
        ids, scores = self.ids, self.scores
        parts, n = list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            joined = parts[left] + parts[right]
            if joined in ids:
                heapq.heappush(agenda, (-scores[ids[joined]], left, right, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, joined = heapq.heappop(agenda)
            # Out of date if either side has been merged since.
            if not parts[left] or not parts[right] or after[left] != right or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        out: list[int] = []
        for part in filter(None, parts):
            out.extend([ids[part]] if part in ids else self.byte_ids[list(part.encode())].tolist())
        return out

    def _merge_all(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words, given as spans of code points, one after another, and the number of ids of each."""
        count = np.zeros(len(starts), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # word, symbols, symbols' number
        narrow = 0
        for width in WIDTHS:
            words = np.flatnonzero((sizes > narrow) & (sizes <= width))
            narrow = width
            if not len(words):
                continue
            column = np.arange(width)
            inside = column < sizes[words, None]
            place = np.minimum(starts[words, None] + column, len(points) - 1)
            symbols = np.where(inside, self.symbol[points[place]], -1)
            # Characters outside the vocabulary keep their code point, as -2 - code point; -1 is no symbol.
            symbols = np.where(inside & (symbols < 0), -2 - points[place].astype(np.int32), symbols).astype(np.int32)
            rank, piece = (x.reshape(len(words), width - 1) for x in self._lookup(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()))
            length = sizes[words].copy()
            while len(words):
                at = rank.argmin(axis=1)
                row = np.arange(len(words))
                on = rank[row, at] != _NONE
                if not on.all():
                    off = ~on
                    found.append((words[off], symbols[off], length[off]))
                    words, symbols, rank, piece, length, at = words[on], symbols[on], rank[on], piece[on], length[on], at[on]
                    row = row[:len(words)]
                    if not len(words):
                        break
                symbols[row, at] = piece[row, at]
                shift = np.minimum(column + (column > at[:, None]), width - 1)
                symbols = np.take_along_axis(symbols, shift, 1)
                symbols[:, -1] = -1
                shift = np.minimum(column[:-1] + (column[:-1] > at[:, None]), width - 2)
                rank, piece = np.take_along_axis(rank, shift, 1), np.take_along_axis(piece, shift, 1)
                rank[:, -1] = _NONE
                length -= 1
                for beside in (at - 1, at):
                    fits = np.flatnonzero((beside >= 0) & (beside < width - 1))
                    rank[fits, beside[fits]], piece[fits, beside[fits]] = self._lookup(symbols[fits, beside[fits]], symbols[fits, beside[fits] + 1])
        flat, flat_word = [], []
        for words, symbols, length in found:
            inside = np.arange(symbols.shape[1]) < length[:, None]
            flat.append(symbols[inside])
            flat_word.append(np.repeat(words, length))
        for word in np.flatnonzero(sizes > narrow):
            ids = self.merge(points[starts[word]:starts[word] + sizes[word]].astype("<u4").tobytes().decode("utf-32-le"))
            flat.append(np.array(ids, np.int32))
            flat_word.append(np.full(len(ids), word))
        if not flat:
            return np.zeros(0, np.int32), count
        flat, flat_word = np.concatenate(flat), np.concatenate(flat_word)
        order = np.argsort(flat_word, kind="stable")
        flat, flat_word = flat[order], flat_word[order]
        # Symbols that are no pieces become the bytes of their characters.
        odd = np.flatnonzero((flat < 0) | (flat >= len(self.surface)))
        if len(odd):
            kinds, which = np.unique(flat[odd], return_inverse=True)
            spelled = [(self.no_piece[k] if k >= 0 else chr(-2 - k)).encode("utf-8", "surrogatepass") for k in kinds.tolist()]
            spelled_size = np.array([len(s) for s in spelled])
            all_bytes = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
            each = np.ones(len(flat), np.int64)
            each[odd] = spelled_size[which]
            ends = np.cumsum(each)
            out = np.repeat(flat, each)
            out[ragged((ends - each)[odd], each[odd])] = all_bytes[ragged((np.cumsum(spelled_size) - spelled_size)[which], each[odd])]
            flat, flat_word = out, np.repeat(flat_word, each)
        np.add.at(count, flat_word, 1) if len(flat_word) < 64 else np.copyto(count, np.bincount(flat_word, minlength=len(count)))
        return flat, count

    def _check(self, points: np.ndarray, ids: np.ndarray) -> None:
        # The library puts the first blank in front itself.
        text = points[1:].astype("<u4").tobytes().decode("utf-32-le")
        if self.library.encode([text], num_threads=1)[0] != ids.tolist():
            raise ValueError("agenda and library give different ids")

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each chunk of an Arrow column: its first row, all ids, and the number of ids of each row."""
        for chunk in grid.chunks(texts, CHUNK):
            points = np.frombuffer(chunk.data.tobytes().decode().encode("utf-32-le"), "<u4").copy()
            points[points == 32] = ord(BLANK)
            size = chunk.per_row((chunk.data & 0xC0) != 0x80)
            full = size > 0
            begins = np.cumsum(size) - size
            points = np.insert(points, begins[full], ord(BLANK))
            size = size + full
            begins = np.cumsum(size) - size
            if not self.by_word:
                rows = [self.merge(points[b:b + s].astype("<u4").tobytes().decode("utf-32-le")) for b, s in zip(begins, size)]
                for ids, b, s in zip(rows, begins, size):
                    self._check(points[b:b + s], np.array(ids)) if s else None
                yield chunk.first, np.array([i for ids in rows for i in ids], np.int32), np.array([len(ids) for ids in rows], np.int64)
                continue
            # A word begins at the first of a run of blanks, or with the row.
            blank = points == ord(BLANK)
            head = blank.copy()
            head[1:] &= ~blank[:-1]
            head[begins[full]] = True
            start = np.flatnonzero(head)
            end = np.append(start[1:], len(points))
            prefix = np.zeros(len(points) + 1, np.uint64)
            np.cumsum((points.astype(np.uint64) + np.uint64(1)) * grid.powers(len(points)), out=prefix[1:])
            word, first, back = np.unique(grid.Chunk.span(prefix, start, end, points), return_index=True, return_inverse=True)
            at, number = self.store.find(word, lambda new: self._learn(points, start[first[new]], (end - start)[first[new]]))
            each = number[back]
            row = np.searchsorted(begins[full], start, side="right") - 1
            per_row = np.zeros(chunk.rows, np.int64)
            per_row[full] = np.bincount(row, weights=each, minlength=int(full.sum())).astype(np.int64)
            yield chunk.first, self.store.values[ragged(at[back], each)], per_row

    def _learn(self, points: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words, checked against the library."""
        ids, number = self._merge_all(points, start, size)
        # A word of blanks only would grow together with the next one: those are checked one by one.
        alone = points[start + size - 1] == ord(BLANK)
        if not alone.all():
            self._check(points[ragged(start[~alone], size[~alone])], ids[np.repeat(~alone, number)])
        for k in np.flatnonzero(alone & (size > 1)):
            self._check(points[start[k]:][:size[k]], ids[number[:k].sum():][:number[k]])
        return ids, number

    def decode_all(self, ids: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the ids of many rows decode to, and the bytes of each row, without the blank put in front."""
        size = self.surface_size[ids]
        data = self.surface_bytes[ragged(self.surface_start[ids], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(number)])]
        each = np.diff(ends)
        begins = ends[:-1][each > 0]
        begins = begins[data[begins] == 32]
        keep = np.ones(len(data), bool)
        keep[begins] = False
        each[np.searchsorted(ends, begins, side="right") - 1] -= 1
        return data[keep], each

    def decode(self, ids: list[int]) -> str:
        """As the library decodes a list of ids; bytes that are no UTF-8 become U+FFFD."""
        data = b"".join(self.surface[i] for i in ids)
        return (data[1:] if data[:1] == b" " else data).decode(errors="replace")


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One for each worker process and file."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def encode(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: id_col, ids (array of int) and decoded (string). The model file must be on every machine."""
    narrow = df.select(F.col(id_col), F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            for first, ids, number in pieces.encode(batch.column(1)):
                data, size = pieces.decode_all(ids, number)
                decoded = pa.Array.from_buffers(pa.string(), len(size), [None, _offsets(size).buffers()[1], pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(number)),
                                                  pa.ListArray.from_arrays(_offsets(number), pa.array(ids)), decoded], [id_col, "ids", "decoded"])

    kind = narrow.schema[0].dataType.simpleString()
    return map_arrow(narrow, run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def digests(ids: Column, decoded: Column) -> list[Column]:
    joined = F.array_join(ids.cast("array<string>"), ",")
    return [F.size(ids).cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2(decoded, 256).alias("decoded_sha256")]
