"""SentencePiece encoding and decoding by suffix-array matching.

Encoding a batch: the texts are cut where no piece can span (before each run of
word marks) on their byte buffer, Arrow makes the units distinct, and those not
met before are concatenated and indexed by a suffix array.  Every piece of the vocabulary is binary-searched for its
range of suffixes; the ranges give the edges (place, length, piece), which are
sorted by place.  The edges are then relaxed in the order the model asks for: a
byte-pair model joins, unit by unit, the adjacent pair whose edge has the best
score, leftmost first, until no edge joins two neighbours.  Characters without
a piece become byte pieces.  The ids equal the reference library's.

A worker remembers the ids of up to ``MEMO_UNITS`` units, and when these are
full those met in two or more batches since; this only saves work.

Defined results: a null or empty text has no ids and decodes to ""; a word mark
in the text decodes to a space, as in the library; repeated rows are encoded
alike; an empty table gives no rows."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctpulse.llm.common import append_columns, text_chunks

MARK = "▁"
MEMO_UNITS = 300_000
BATCH_CHARS = 1 << 20
LONG_UNIT = 256  # characters from which a unit is relaxed by a heap of its own
_NEVER = np.int64(1 << 30)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceModel:
    """A byte-pair piece vocabulary with byte fallback, indexed for matching."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.ids = np.array([i for i in range(n) if not special[i] and self.pieces[i]])
        own = [self.pieces[i] for i in self.ids]
        score = np.array([sp.get_score(int(i)) for i in self.ids])
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
        self.length = np.array([len(p) for p in own])
        self.flat = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32)
        self.first = np.cumsum(self.length) - self.length
        self.longest = int(self.length.max())
        #: a unit may start at each run of marks if no piece has a mark after another character
        self.split = not any(re.search(f"[^{MARK}]{MARK}", p) for p in own)
        self._forget()
        byte = {int(i): b for b, i in enumerate(self.byte_ids)}
        self.spelled = [bytes([byte[i]]) if i in byte else b"" if special[i] else self.pieces[i].replace(MARK, " ").encode() for i in range(n)]

    def _forget(self) -> None:
        """An empty memo: each unit's number, the numbered units' ids end to end, and in how many batches they were met."""
        self.number: dict[str, int] = {}
        self.known, self.ends, self.met = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int32)

    # -- matching

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, lengths and piece numbers of all occurrences of all pieces, by place."""
        alphabet = np.unique(text)
        bits = int(len(alphabet)).bit_length()
        per_key = 63 // bits
        n_keys = -(-self.longest // per_key)
        code = np.searchsorted(alphabet, text).astype(np.uint64) + np.uint64(1)
        padded = np.concatenate([code, np.zeros(per_key * n_keys, np.uint64)])
        packed = np.zeros(len(padded) - per_key + 1, np.uint64)
        for j in range(per_key):
            packed = (packed << np.uint64(bits)) | padded[j : j + len(packed)]
        keys = [packed[k * per_key : k * per_key + len(text)] for k in range(n_keys)]
        order = np.argsort(keys[0])  # the suffix array, as deep as a piece can reach
        new = np.concatenate(([True], np.diff(keys[0][order]) != 0))
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if len(tied) and n_keys > 1:  # only equal beginnings are ordered by what follows
            own = order[tied]
            order[tied] = own[np.lexsort([*(k[own] for k in keys[:0:-1]), np.cumsum(new)[tied]])]
        keys = [k[order] for k in keys]

        # pieces of the text's own characters; others cannot occur
        at = np.minimum(np.searchsorted(alphabet, self.flat), len(alphabet) - 1)
        can = np.logical_and.reduceat(alphabet[at] == self.flat, self.first)
        own, size = np.flatnonzero(can), self.length[can]
        flat = (at[np.repeat(can, self.length)] + 1).astype(np.uint64)
        who = np.repeat(np.arange(len(own)), size)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        grid = np.zeros((len(own), n_keys * per_key), np.uint64)
        grid[who, place] = flat
        top = np.where(np.arange(n_keys * per_key)[None] < size[:, None], grid, np.uint64((1 << bits) - 1))
        low = np.zeros((n_keys, len(own)), np.uint64)
        high = np.zeros((n_keys, len(own)), np.uint64)
        for k in range(n_keys):
            for j in range(per_key):
                low[k] = (low[k] << np.uint64(bits)) | grid[:, k * per_key + j]
                high[k] = (high[k] << np.uint64(bits)) | top[:, k * per_key + j]
        first, last = self._search(keys, low, False), self._search(keys, high, True)
        count = last - first
        piece = np.repeat(own, count)
        at = order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]
        by_place = np.lexsort((self.length[piece], at))
        return at[by_place], self.length[piece][by_place], piece[by_place]

    @staticmethod
    def _search(keys: list[np.ndarray], wanted: np.ndarray, after: bool) -> np.ndarray:
        """For each wanted key tuple, the first suffix that is not below it (or is above it)."""
        n = len(keys[0])
        lo, hi = np.zeros(wanted.shape[1], np.int64), np.full(wanted.shape[1], n)
        while (open_ := lo < hi).any():
            mid = np.minimum((lo + hi) >> 1, n - 1)
            below, equal = np.zeros(len(mid), bool), np.ones(len(mid), bool)
            for k, w in zip(keys, wanted):
                v = k[mid]
                below |= equal & (v < w)
                equal &= v == w
            below |= equal & after
            lo, hi = np.where(open_ & below, mid + 1, lo), np.where(open_ & ~below, mid, hi)
        return lo

    # -- relaxing

    def _encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units end to end, and how many each has."""
        text = np.frombuffer("\0".join([*units, ""]).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, units), np.int64, len(units))
        start = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
        place, length, piece = self.edges(text)
        width = self.longest + 1
        edge = np.full(len(text) * width, -1, np.int32)  # piece of each (place, length)
        edge[place * width + length] = piece
        rank = np.append(self.rank, _NEVER)

        unit = np.repeat(np.arange(len(units)), size)
        token = np.arange(len(unit)) + unit  # one token per character; units are one separator apart
        end = token + 1
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        long = size[unit] > LONG_UNIT
        for u in np.flatnonzero(size > LONG_UNIT):
            own = self._relax_long(int(start[u]), int(size[u]), edge, width)
            done.append((np.full(len(own) - 1, u), own[:-1], own[1:]))
        unit, token, end = unit[~long], token[~long], end[~long]

        def price(at: np.ndarray) -> np.ndarray:
            """Cost of joining each of these tokens with the next one of its unit."""
            after = np.minimum(at + 1, len(unit) - 1)
            span = end[after] - token[at]
            fits = (unit[after] == unit[at]) & (after > at) & (span < width)
            return np.where(fits, rank[edge[token[at] * width + np.where(fits, span, 0)]], _NEVER)

        cost, count = price(np.arange(len(unit))), size[size <= LONG_UNIT]
        while len(unit):
            best = np.minimum.reduceat((cost << 32) | np.arange(len(unit)), np.cumsum(count) - count)
            joins = (best >> 32) < _NEVER
            going = np.repeat(joins, count)
            done.append((unit[~going], token[~going], end[~going]))
            left = (best & 0xFFFFFFFF)[joins]
            end[left] = end[left + 1]
            going[left + 1] = False
            at = (np.cumsum(going) - 1)[left]
            unit, token, end, cost, count = unit[going], token[going], end[going], cost[going], count[joins] - 1
            at = np.concatenate((at, at[at > 0] - 1))  # only the joined tokens and those before them have new neighbours
            cost[at] = price(at)
        unit, token, end = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, np.int64),) * 3
        order = np.argsort(token)
        unit, token, end = unit[order], token[order], end[order]
        found = edge[token * width + (end - token)]
        ids, unknown = self.ids[found], found < 0
        if unknown.any():  # a character without a piece becomes its UTF-8 bytes
            char = text[token].astype(np.int64)
            n = np.where(unknown, 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000), 1)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ids, unit, char, unknown, n = (np.repeat(x, n) for x in (ids, unit, char, unknown, n))
            head = np.where(n == 1, 0, (0xFF00 >> n) & 0xFF) | (char >> (6 * (n - 1)))
            byte = np.where(nth == 0, head, 0x80 | ((char >> (6 * (n - 1 - nth))) & 0x3F))
            ids = np.where(unknown, self.byte_ids[np.where(unknown, byte, 0)], ids)
        return ids.astype(np.int32), np.bincount(unit, minlength=len(units))

    def _relax_long(self, start: int, size: int, edge: np.ndarray, width: int) -> np.ndarray:
        """Token boundaries of one unit: the same joins, with neighbours in a heap."""
        after = list(range(1, size + 2))
        before = list(range(-1, size))
        live = [True] * size + [False]
        heap: list[tuple[int, int, int]] = []

        def offer(a: int) -> None:
            b = after[a]
            if b < size and (span := after[b] - a) < width and (p := edge[(start + a) * width + span]) >= 0:
                heapq.heappush(heap, (int(self.rank[p]), a, after[b]))

        for a in range(size):
            offer(a)
        while heap:
            _, a, e = heapq.heappop(heap)
            b = after[a]
            if not live[a] or b >= size or after[b] != e:
                continue
            live[b] = False
            after[a] = e
            if e < size:
                before[e] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return np.array([start + a for a in range(size) if live[a]] + [start + size])

    # -- whole texts

    def _lists(self, units: list[str]) -> tuple[pa.LargeListArray, np.ndarray]:
        """Lists of ids, and the number of each distinct unit's list among them."""
        number = np.fromiter(map(self.number.get, units, repeat(-1)), np.int64, len(units))
        unknown = np.flatnonzero(number < 0)
        self.met[number[number >= 0]] += 1
        ids, ends = self.known, self.ends
        if len(unknown):
            new = [units[i] for i in unknown.tolist()]
            found, count = self._encode_units(new)
            ids, ends = np.concatenate([ids, found]), np.concatenate([ends, ends[-1] + np.cumsum(count)])
            number[unknown] = len(self.number) + np.arange(len(new))
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(ids, pa.int32()))
        if len(unknown) and len(ends) - 1 <= MEMO_UNITS:
            self.number.update(zip(new, range(len(self.number), len(ends) - 1)))
            self.known, self.ends, self.met = ids, ends, np.concatenate([self.met, np.zeros(len(new), np.int32)])
        elif len(unknown):
            self._renew(lists)
        return lists, number

    def _renew(self, lists: pa.LargeListArray) -> None:
        """Keeps the remembered units that came again, if they leave half of the room."""
        keep = np.flatnonzero(self.met > 1)
        names = list(self.number)
        self._forget()
        if len(keep) <= MEMO_UNITS // 2:
            own = lists.take(pa.array(keep))
            self.number = {names[i]: n for n, i in enumerate(keep.tolist())}
            self.known = own.flatten().to_numpy().copy()
            self.ends = np.concatenate(([0], np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            self.met = np.zeros(len(keep), np.int32)

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a column's texts end to end, and where each text's ids begin and end."""
        column = column.cast(pa.large_string()).fill_null("")
        mark = pa.scalar(MARK, pa.large_string())
        marked = pc.binary_join_element_wise(mark, pc.replace_substring(column, " ", MARK), pa.scalar("", pa.large_string()))
        marked = pc.if_else(pc.equal(pc.binary_length(column), 0), pa.scalar("", pa.large_string()), marked)
        parts, upto = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for _, data, offsets in text_chunks(marked, 1 << 62):
            cut = np.zeros(len(data) + 1, bool)
            if self.split and len(data) > 2:
                is_mark = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
                cut[: len(is_mark)] = is_mark
                cut[3 : len(is_mark)] &= ~is_mark[:-3]
            cut[offsets] = True
            cuts = np.flatnonzero(cut)
            if len(cuts) > 1:
                units = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
                lists, number = self._lists(units.dictionary.to_pylist())
                own = lists.take(pa.array(number[units.indices.to_numpy(zero_copy_only=False)]))
                parts.append(own.flatten().to_numpy())
                before = np.concatenate(([0], np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False))))
            else:
                before = np.zeros(1, np.int64)
            upto.append(upto[-1][-1] + before[np.searchsorted(cuts, offsets[1:])])
        return np.concatenate(parts), np.concatenate(upto)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, upto = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def _by_chars(column: pa.Array) -> Iterator[pa.Array]:
    """The texts of a column in slices of about BATCH_CHARS bytes."""
    n, first = len(column), 0
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)) if n else []
    while first < n:
        done = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, done + BATCH_CHARS, "right")))
        yield column.slice(first, last - first)
        first = last


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the piece ids of the whole text as an array column."""
    path = path or default_model()

    def run(column: pa.Array) -> list[pa.Array]:
        found = [load(path).encode_column(own) for own in _by_chars(column)]
        counts = np.concatenate([np.zeros(1, np.int64), *(np.diff(upto) for _, upto in found)])
        flat = np.concatenate([np.zeros(0, np.int32), *(own for own, _ in found)])
        return [pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.array(flat, pa.int32()))]

    return append_columns(docs, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], run, keep)


def _ids(column: pa.Array) -> list[np.ndarray]:
    column = column.fill_null([]) if column.null_count else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def decode(docs: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the text of an array column of piece ids."""
    path = path or default_model()

    def run(column: pa.Array) -> list[pa.Array]:
        return [pa.array([load(path).decode(x) for x in _ids(column)], pa.string())]

    return append_columns(docs, ids, [T.StructField(text, T.StringType())], run, keep)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_ids, ids_crc32, and whether its ids decode to its text."""
    path = path or default_model()
    fields = [T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType())]

    def run(column: pa.Array) -> list[pa.Array]:
        model, rows = load(path), []
        for own in _by_chars(column):
            found, upto = model.encode_column(own)
            for text, a, b in zip(own.to_pylist(), upto[:-1].tolist(), upto[1:].tolist()):
                ids = found[a:b]
                rows.append((len(ids), crc(ids), model.decode(ids) == (text or "").replace(MARK, " ")))
        n, checks, same = zip(*rows) if rows else ((), (), ())
        return [pa.array(n, pa.int64()), pa.array(checks, pa.int64()), pa.array(same, pa.bool_())]

    return append_columns(docs.select("doc_id", "text"), "text", fields, run, ["doc_id"])


def encode_documents(docs: DataFrame) -> DataFrame:
    """The documents' ids in place of their texts, with n_ids."""
    return encode(docs, keep=[c for c in docs.columns if c.lower() not in ("text", "ids", "n_ids")]).withColumn("n_ids", F.size("ids").cast("long"))
