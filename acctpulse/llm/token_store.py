"""Token-ID files coded by an adaptive context-mixing range coder.

Whole texts are encoded with a byte-level vocabulary, an end id is appended to
each, and the ids of all documents in ascending doc_id order are cut into
blocks of ``BLOCK`` ids.  A block starts from fresh models and carries a crc32,
so any block can be decoded, checked and lost on its own.

Coding an id mixes three predictions.  The order-2 and order-1 contexts (hashed
tables) each name one likely id with a confidence; the order-0 model gives every
id a share from adaptive counts, renewed after 16, 32, 64, 128, 256 ids and then
whenever about half as many again are met.  How much weight each order gets is learned, separately
for every pair of confidences.  Tables and weights learn after 16, 32 and 64 ids, then every 64
and from 512 on every 128, and whenever the shares are renewed (a block of fewer streams: sooner).  The
mixed interval of the id drives a range coder whose window of 62 bits leaves one
for the carry.

A block is cut into ``STREAMS`` runs of consecutive ids (fewer in a short block),
each with a range coder of its own, which share the block's models.  All streams of
at most ``TOGETHER`` blocks are coded in step, one numpy lane per stream; the models
of the blocks in hand stay within a few MB.  A payload is the numbers of 16-bit
digits of its streams and then the digits.

The file format is a Parquet table, written by range of doc_id, whose rows are
segments: shard and seq (their order), the documents' ids and id counts, and the
blocks (n, crc32, payload).  A segment ends with a document.

Defined results: a null or empty text has only the end id; documents of equal
doc_id are ordered by text; identical rows are stored as often as they occur; a
null doc_id comes first; an empty table gives an empty table.  A very long text
is tokenised in slices of about ``SLICE`` bytes and coded ``TOGETHER`` blocks at a
time, so beside the text only its ids (4 bytes each) and its payloads are held.  Rows of one doc_id are
one range of the order and thus one task.  Columns besides doc_id and text are
not read, whatever their names."""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from acctpulse.llm.common import text_chunks, written

END_ID = 2
BLOCK = 4096  # most ids of a block
STREAMS = 16  # of a block
LEAST_STREAM = 64  # ids that each of several streams has at least
TOGETHER = 256  # most blocks that are coded in step
SEGMENT = 2048 * BLOCK  # ids from which a segment ends
SLICE = 8 << 20  # bytes of text tokenised at once
MEMO_UNITS = 1_000_000
JOINED = 64  # units that the library encodes as one text

_SLOTS = 2048  # of a context table
_NO_ID = 0xFFFFF
_FIXED = 1 << 12  # the three weights add up to this
_LEAVES = 1024
_LEARN = 64  # ids after which the models learn, twice as many later in a block
_RENEW = 256  # ids up to which the distance between renewals of the order-0 shares doubles
_COUNTED = 1 << 14  # the order-0 shares of all leaves add up to this
_WINDOW = 62  # bits of the coder's window
_DIGIT = _WINDOW - 16
_LEAST = 1 << _DIGIT  # a smaller interval moves one digit of 16 bits out
_HASH = np.array([[0x1E3779B1], [0x05EBCA77]], np.int32)
_UPTO = np.array([(2 << k) - 1 for k in range(64)], np.uint64)  # the bits of a word up to each


def _leaf_tables(vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Order-0 leaves: 512 single ids, 224 groups of 16, and equal groups for the
    rest.  Leaf of each id, first id of each leaf, how much of a leaf's share one
    id has, and into how many parts each share is cut."""
    rest = max(1, vocabulary - 4096)
    size = 256
    while size * (_LEAVES - 736) < rest:
        size *= 2
    sizes = np.concatenate([np.ones(512, np.int64), np.full(224, 16), np.full(_LEAVES - 736, size)])
    return np.repeat(np.arange(_LEAVES), sizes), np.cumsum(sizes) - sizes, size // sizes, size


def _streams(n: int) -> tuple[int, int]:
    """How many streams a block of n ids has, and of how many ids each; zeros fill the last."""
    streams = max(1, min(STREAMS, n // LEAST_STREAM))
    return streams, -(-n // streams)


def _parts(steps: int, streams: int):
    """(first step, end, whether the order-0 shares are renewed before it) of the parts of a block."""
    renewed, growth = [0, 1], 1
    while renewed[-1] < steps:
        growth = max(growth, min(renewed[-1], renewed[-1] // 2 if renewed[-1] * streams >= _RENEW else renewed[-1]))
        renewed.append(renewed[-1] + growth)
    learn = max(1, _LEARN // streams)
    edges = sorted({*renewed, 2, *range(0, min(steps, 8 * learn), learn), *range(8 * learn, steps, 2 * learn)})
    edges = [e for e in edges if e < steps] + [steps]
    for a, b in zip(edges, edges[1:]):
        yield a, b, a in renewed


class _Mixer:
    """The models of all blocks, each shared by the block's streams (lanes).  They learn after
    each part of a block, from all lanes and steps at once; where two meet in one slot, the
    later step and then the later lane stays."""

    def __init__(self, blocks: int, streams: int, vocabulary: int):
        self.leaf_of, first, unit, self.scale = _leaf_tables(vocabulary)
        self.bits = (_COUNTED * self.scale).bit_length() - 1  # of an order-0 interval
        self.kind = np.int32 if self.bits < 31 else np.int64
        self.first, self.unit = first.astype(self.kind), unit.astype(self.kind)
        self.shift = self.bits + _FIXED.bit_length() - 1  # of a mixed interval
        self.blocks = blocks
        self.block = np.repeat(np.arange(blocks, dtype=np.int64), streams)  # of each lane
        self.base, self.row32 = self.block * _SLOTS, self.block * 32
        # id << 5, and the confidence where a context's number has it
        self.guess2, self.guess1 = (np.full(blocks * _SLOTS, _NO_ID << 5, np.int32) for _ in range(2))
        self.hits = np.zeros((3, blocks * 32), np.int32)  # of neither, of order 2, of order 1 alone
        self.counts = np.zeros((blocks, _LEAVES), np.int32)
        self.share = np.empty((blocks, _LEAVES + 1), self.kind)  # running sums of the shares
        self.row = self.block * (_LEAVES + 1)
        self.marks = np.empty(blocks * _COUNTED, bool)
        self.ranges = np.arange(blocks)[:, None] * _COUNTED
        self.ramp = np.arange(_LEAVES + 1, dtype=np.int32)
        self.seen = 0
        self._weigh()

    def _weigh(self) -> None:
        """Ends of the order-2 and order-1 intervals by context, from how often each was right."""
        missed, hits2, hits1 = self.hits * 4.0
        missed += hits1 + 8
        w2, w1 = (hits2 + 2) * _FIXED / (missed + hits2), (hits1 + 2) * _FIXED / missed
        w2, w1 = (np.minimum(np.maximum(w.astype(np.int32), 32), _FIXED - 32) for w in (w2, w1))
        w1 = np.maximum(((_FIXED - w2) * w1) >> 12, 1)
        self.after2, self.after1 = w2.astype(np.int64) << self.bits, (w2 + w1).astype(np.int64) << self.bits
        self.weight0 = _FIXED - (w2 + w1).astype(np.int64)

    def renew(self, ids: np.ndarray) -> None:
        """Order-0 shares with the ids met since the last renewal (steps x lanes)."""
        share = self.share
        if len(ids):
            leaves = self.leaf_of.take(ids, mode="clip")
            self.counts += np.bincount((leaves + self.block * _LEAVES).ravel(), minlength=self.counts.size).reshape(self.counts.shape)
            self.seen += ids.size // self.blocks
        if self.seen:
            sums = np.zeros((self.blocks, _LEAVES + 1), np.int32)
            np.cumsum(self.counts, axis=1, dtype=np.int32, out=sums[:, 1:])
            sums *= _COUNTED - _LEAVES
            sums //= self.seen
            np.add(sums, self.ramp, out=share)
        else:
            share[:] = self.ramp * (_COUNTED // _LEAVES)

    def finder(self) -> tuple[np.ndarray, np.ndarray]:
        """The starts of the leaves as bits of the blocks' order-0 ranges, end to end in words of 64,
        and how many lie before each word."""
        self.marks.fill(False)
        self.marks[(self.share[:, :-1] + self.ranges).reshape(-1)] = True
        words = np.packbits(self.marks, bitorder="little").view("<u8")
        counts = np.bitwise_count(words)
        return words, np.cumsum(counts, dtype=np.int64) - counts

    def slots(self, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the order-2 and order-1 contexts: the id before, and the one before that."""
        mixed = near * _HASH[0]
        mixed += far * _HASH[1]
        mixed >>= 9
        mixed &= _SLOTS - 1
        return mixed + self.base, (near & (_SLOTS - 1)) + self.base

    def contexts(self, g2: np.ndarray, g1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The two named ids, and the pair of confidences with whether the two agree."""
        id2, id1 = g2 >> 5, g1 >> 5
        pair = g2 & 24
        pair |= g1 & 6
        pair |= id2 == id1
        return id2, id1, pair + self.row32

    def learn(self, x: np.ndarray, slots2: np.ndarray, slots1: np.ndarray, g2: np.ndarray, g1: np.ndarray, contexts: np.ndarray) -> None:
        hit2, right1 = (g2 >> 5) == x, (g1 >> 5) == x
        for table, slots, g, right, one in ((self.guess2, slots2, g2, hit2, np.int32(8)), (self.guess1, slots1, g1, right1, np.int32(2))):
            sure = g & (3 * one)
            table[slots] = np.where(right, g + (sure < 3 * one) * one, np.where(sure > one, g - one, (x << 5) | one))
        which = np.where(hit2, np.int64(1), right1 * np.int64(2)) * self.hits.shape[1]
        which += contexts
        self.hits += np.bincount(which.ravel(), minlength=self.hits.size).reshape(self.hits.shape)
        self._weigh()

    def share0(self, x: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the ids' order-0 intervals."""
        at, flat = self.row + leaf, self.share.reshape(-1)
        start = flat.take(at)
        size = (flat[1:].take(at) - start) * self.unit.take(leaf)
        return start * self.scale + (x - self.first.take(leaf)) * size, size


def block_sizes(n: int) -> list[int]:
    """How many ids the blocks of a segment of n ids have."""
    return [min(BLOCK, n - i) for i in range(0, n, BLOCK)]


def _groups(sizes: list[int]) -> list[tuple[int, int]]:
    """(blocks, their size) of groups of successive blocks of one size, at most TOGETHER in each."""
    groups = []
    for size, run in groupby(sizes):
        blocks = len(list(run))
        n = -(-blocks // TOGETHER)
        groups += [((k + 1) * blocks // n - k * blocks // n, size) for k in range(n)]
    return groups


def encode_blocks(ids: np.ndarray, vocabulary: int) -> list[bytes]:
    """The payloads of the blocks of an id array."""
    payloads, at = [], 0
    for blocks, size in _groups(block_sizes(len(ids))):
        payloads += _encode_lanes(ids[at : at + blocks * size].reshape(blocks, size), vocabulary)
        at += blocks * size
    return payloads


def _encode_lanes(ids: np.ndarray, vocabulary: int) -> list[bytes]:
    """Codes blocks of one size (blocks x ids)."""
    blocks, n = ids.shape
    streams, steps = _streams(n)
    lanes = blocks * streams
    x = np.zeros((blocks, streams * steps), np.int32)
    x[:, :n] = ids
    x = np.ascontiguousarray(x.reshape(lanes, steps).T)
    mixer = _Mixer(blocks, streams, vocabulary)
    bits, shift = mixer.bits, mixer.shift
    low, size = np.zeros(lanes, np.int64), np.full(lanes, (1 << _WINDOW) - 1, np.int64)
    out = np.zeros((steps * 3 + 8, lanes), np.int32)  # digits by place and lane, a carry still in bit 16
    flat, place = out.reshape(-1), np.arange(lanes)
    kept = np.array([-1, _LEAST - 1])  # bits of the lower end that stay when no digit or one moves out
    before, renewed = np.zeros((2, lanes), np.int32), 0
    for a, b, renew in _parts(steps, streams):
        if renew:
            mixer.renew(x[renewed:a])
            renewed = a
        before = np.concatenate([before, x[a:b]])
        slots2, slots1 = mixer.slots(before[1:-1], before[:-2])
        before = before[-2:]
        g2, g1 = mixer.guess2.take(slots2), mixer.guess1.take(slots1)
        id2, id1, contexts = mixer.contexts(g2, g1)
        after2, after1, weight0 = mixer.after2.take(contexts), mixer.after1.take(contexts), mixer.weight0.take(contexts)
        own = x[a:b]
        start0, part0 = mixer.share0(own, mixer.leaf_of.take(own))
        hit2, right1 = id2 == own, id1 == own
        starts = np.where(hit2, 0, np.where(right1, after2, after1 + weight0 * start0))
        parts = np.where(hit2, after2, np.where(right1, after1 - after2, weight0 * part0))
        for t in range(b - a):
            r = size >> shift
            low += r * starts[t]
            size = r * parts[t]
            flat[place] = low >> _DIGIT  # counts only where the place moves on
            short = (size < _LEAST).astype(np.int64)
            place += short * lanes
            low &= kept.take(short)
            short <<= 4
            low <<= short
            size <<= short
            move = np.flatnonzero(size < _LEAST)
            while len(move):
                held, at = low[move], place[move]
                flat[at] = held >> _DIGIT
                place[move] = at + lanes
                low[move] = (held & (_LEAST - 1)) << 16
                grown = size[move] << 16
                size[move] = grown
                move = move[grown < _LEAST]
        mixer.learn(own, slots2, slots1, g2, g1, contexts)
    flat[place] = (low + _LEAST - 1) >> _DIGIT
    place //= lanes
    longest = int(place.max()) + 1
    own = np.where(np.arange(longest)[:, None] <= place, out[:longest], 0)  # older values lie behind the last digit
    for k in range(longest - 1, 0, -1):
        own[k - 1] += own[k] >> 16
    rows = np.ascontiguousarray(own.astype(np.uint16).T)
    digits = ((rows != 0) * np.arange(1, longest + 1)).max(axis=1)  # a reader goes on with zeros
    data = rows[np.arange(longest) < digits[:, None]].astype(">u2")
    counts = digits.astype(">u2").reshape(blocks, streams)
    ends = np.cumsum(digits.reshape(blocks, streams).sum(axis=1))
    return [c.tobytes() + d.tobytes() for c, d in zip(counts, np.split(data, ends[:-1]))]


def decode_blocks(payloads: list[bytes], sizes: list[int], vocabulary: int) -> np.ndarray:
    """The ids of blocks, in order; a block's size is its number of ids."""
    parts, at = [], 0
    for blocks, size in _groups(sizes):
        parts.append(_decode_lanes(payloads[at : at + blocks], size, vocabulary))
        at += blocks
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a // b of positive numbers, of 64 or both of 32 bits."""
    unsigned = f"u{a.itemsize}"
    return (a.view(unsigned) // b.view(unsigned)).view(a.dtype)


def _digits(payload: bytes, streams: int) -> tuple[np.ndarray, np.ndarray]:
    """How many digits each stream of a payload has, and the digits; none if these do not fit, so that the block's crc32 fails."""
    words = np.frombuffer(payload[: len(payload) & ~1], ">u2")
    counts, data = words[:streams].astype(np.int64), words[streams:]
    return (counts, data) if len(counts) == streams and counts.sum() == len(data) else (np.zeros(streams, np.int64), data[:0])


@np.errstate(divide="ignore")  # of a damaged block
def _decode_lanes(payloads: list[bytes], n: int, vocabulary: int) -> np.ndarray:
    """The ids of blocks of one size n."""
    streams, steps = _streams(n)
    blocks = len(payloads)
    lanes = blocks * streams
    mixer = _Mixer(blocks, streams, vocabulary)
    digits, data = (np.concatenate(own) for own in zip(*(_digits(p, streams) for p in payloads)))
    held = np.zeros((lanes, int(digits.max()) + 8), np.uint16)
    held[np.arange(held.shape[1]) < digits[:, None]] = data
    # the window has 62 bits: all digits move two bits down, so that it starts with four whole words
    words = held >> 2
    words[:, 1:] |= (held[:, :-1] & 3) << 14
    words = np.ascontiguousarray(words.T)
    code = np.zeros(lanes, np.int64)
    for k in range(4):
        code = (code << 16) | words[k]
    pairs = words[4:].astype(np.uint32) << 16  # each digit with the next
    pairs[:-1] |= words[5:]
    flat, place = pairs.reshape(-1), np.arange(lanes)
    size = np.full(lanes, (1 << _WINDOW) - 1, np.int64)
    out = np.zeros((steps, lanes), np.int32)
    shift, depth = mixer.shift, mixer.scale.bit_length() - 1
    near, far = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    parts = list(_parts(steps, streams))
    most = max(b - a for a, b, _ in parts)
    slots2, slots1, contexts = (np.empty((most, lanes), np.int64) for _ in range(3))
    guesses2, guesses1 = (np.empty((most, lanes), np.int32) for _ in range(2))
    share, renewed = mixer.share.reshape(-1), 0
    share_after = share[1:]
    found, to_row = mixer.block * (_COUNTED // 64), mixer.block - 1
    for a, b, renew in parts:
        if renew:
            mixer.renew(out[renewed:a])
            renewed = a
            marks, earlier = mixer.finder()
        for t in range(b - a):
            slots2[t], slots1[t] = slot2, slot1 = mixer.slots(near, far)
            guesses2[t], guesses1[t] = g2, g1 = mixer.guess2.take(slot2), mixer.guess1.take(slot1)
            id2, id1, context = mixer.contexts(g2, g1)
            contexts[t] = context
            after2, after1, weight = mixer.after2.take(context), mixer.after1.take(context), mixer.weight0.take(context)
            r = size >> shift
            target = _divided(code, r)
            # all as if of order 0; what a damaged block looks up may lie anywhere, so that places are clipped
            inner = _divided(np.maximum(target - after1, 0), weight).astype(mixer.kind)
            nth = inner >> depth
            word = (nth >> 6) + found
            at = np.bitwise_count(marks.take(word, mode="clip") & _UPTO.take(nth & 63)) + earlier.take(word, mode="clip")
            at += to_row
            leaf = at - mixer.row
            start0 = share.take(at, mode="clip")
            size0 = share_after.take(at, mode="clip")
            size0 -= start0
            size0 *= mixer.unit.take(leaf, mode="clip")
            start0 <<= depth
            inner -= start0
            nth = _divided(inner, size0)
            far = near
            near = mixer.first.take(leaf, mode="clip").astype(np.int32, copy=False)
            near += nth
            nth *= size0
            nth += start0
            start, part = weight * nth, weight * size0
            start += after1
            named = np.flatnonzero(target < after1)
            if len(named):
                upto = after2[named]
                by1 = target[named] >= upto
                start[named] = upto * by1
                part[named] = np.where(by1, after1[named] - upto, upto)
                near[named] = np.where(by1, id1[named], id2[named])
            start *= r
            code -= start
            size = r * part
            digits = ((size < _LEAST).view(np.int8) + (size < _LEAST >> 16).view(np.int8)).astype(np.int64)
            word = flat.take(place, mode="clip").astype(np.int64)
            place += digits * lanes
            digits <<= 4
            word >>= 32 - digits
            code <<= digits
            code |= word
            size <<= digits
            if size.min() < _LEAST:
                move = np.flatnonzero(size < _LEAST)
                code[move] = (code[move] << 16) | (flat.take(place[move], mode="clip") >> 16)
                place[move] += lanes
                size[move] <<= 16
            out[a + t] = near
        n_own = b - a
        mixer.learn(out[a:b], slots2[:n_own], slots1[:n_own], guesses2[:n_own], guesses1[:n_own], contexts[:n_own])
    return np.ascontiguousarray(out.T).reshape(blocks, streams * steps)[:, :n].reshape(-1)


def crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


_BYTES = np.arange(256)
#: bytes before which a space begins a unit: all but white space and the first bytes of white space beyond ASCII
_AFTER_CUT = (_BYTES > 32) & ~np.isin(_BYTES, [0xC2, 0xE1, 0xE2, 0xE3])
_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122)
_MARK = np.isin(_BYTES, list(b",.;:!?)"))
_END = np.array([END_ID], np.int32)


class TextEncoder:
    """Ids of whole texts by the tokenizers library, which encodes each distinct
    unit once: the pattern of the byte-level vocabularies always ends a word before a
    space that precedes a character that is not white space, and between an ASCII
    letter and one of ``,.;:!?)``.  Units are found on the byte buffer of a column and
    made distinct by Arrow; the first ``MEMO_UNITS`` distinct units are kept, and their
    ids end to end in one array, from which the ids of all texts are gathered.  New units
    that begin with such a space can follow any text, so the library gets ``JOINED`` of
    them as one text, whose ids are dealt to the units by the bytes that each id stands for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.vocabulary = self.library.get_vocab_size()
        self.width = np.zeros(1 + max(self.library.get_vocab().values(), default=0), np.int64)  # bytes of each id
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.width[i] = len(token)  # byte-level: one character per byte
        self.number = pa.array([], pa.large_string())
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int32)

    def _library_ids(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids end to end, and how many each has."""
        found = [e.ids for e in self.library.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())), counts

    def _joined_ids(self, units: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The same of units that can follow any text."""
        (_, data, offsets), = text_chunks(units, 1 << 62)
        some = np.unique(np.append(np.arange(0, len(units), JOINED), len(units)))
        joined = pa.LargeStringArray.from_buffers(len(some) - 1, pa.py_buffer(offsets[some]), pa.py_buffer(data))
        ids, _ = self._library_ids(joined)
        upto = np.cumsum(self.width[ids])
        ends = np.searchsorted(upto, offsets[1:]) + 1
        if len(upto) != ends[-1] or not (upto[ends - 1] == offsets[1:]).all():
            return self._library_ids(units)  # ids that do not stand for their characters' bytes
        return ids, np.diff(ends, prepend=0)

    def _free(self, units: pa.LargeStringArray) -> np.ndarray:
        """Which units can follow any text."""
        (_, data, offsets), = text_chunks(units, 1 << 62)
        free = np.diff(offsets) > 1
        first = offsets[:-1][free]
        free[free] = (data[first] == 32) & _AFTER_CUT[data[first + 1]]
        return free

    def _lists(self, units: pa.LargeStringArray, indices: np.ndarray) -> pa.ListArray:
        """The list of ids of each unit that the indices name."""
        number = pc.index_in(units, value_set=self.number).fill_null(-1).to_numpy().astype(np.int64)
        ids, ends = self.ids, self.ends
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            free = self._free(units.take(pa.array(unknown)))
            first = len(self.number)
            for which, found in ((unknown[free], self._joined_ids), (unknown[~free], self._library_ids)):
                if len(which):
                    own, counts = found(units.take(pa.array(which)))
                    number[which] = len(ends) - 1 + np.arange(len(which))
                    ids, ends = np.concatenate([ids, own]), np.concatenate([ends, ends[-1] + np.cumsum(counts, dtype=np.int32)])
                    kept = which[: max(0, MEMO_UNITS - len(self.number))]
                    if len(kept):
                        self.number = pa.concat_arrays([self.number, units.take(pa.array(kept))])
            if len(self.number) > first:
                self.ends = ends[: len(self.number) + 1].copy()
                self.ids = ids[: self.ends[-1]].copy()
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)).take(pa.array(number[indices]))

    def _slice(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units between the cuts, and how many lie before each cut."""
        own = np.ascontiguousarray(data[cuts[0] : cuts[-1]])
        units = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts - cuts[0]), pa.py_buffer(own)).dictionary_encode()
        found = self._lists(units.dictionary, units.indices.to_numpy(zero_copy_only=False))
        return found.flatten().to_numpy(), np.concatenate(([0], np.cumsum(found.value_lengths().to_numpy(zero_copy_only=False))))

    def encode_column(self, column: pa.Array):
        """Arrays of ids, one for each text of a column, in order."""
        for _, data, offsets in text_chunks(column, SLICE):
            yield from self._chunk(data, offsets)

    def _chunk(self, data: np.ndarray, offsets: np.ndarray):
        held, text, first, step = [], 0, 0, SLICE
        while text < len(offsets) - 1:
            bound = min(first + step, len(data))
            space = first + np.flatnonzero(data[first:bound] == 32)
            space = space[space + 1 < len(data)]
            cut = np.zeros(bound - first + 1, bool)
            cut[0] = True
            cut[space[_AFTER_CUT[data[space + 1]]] - first] = True
            cut[1:-1] |= _LETTER[data[first : bound - 1]] & _MARK[data[first + 1 : bound]]
            cut[offsets[np.searchsorted(offsets, first) : np.searchsorted(offsets, bound, "right")] - first] = True
            cuts = first + np.flatnonzero(cut)
            if len(cuts) < 2 and bound < len(data):  # one unit reaches over the whole slice
                step *= 2
                continue
            ids, upto = self._slice(data, cuts)
            done, last = 0, int(np.searchsorted(offsets, cuts[-1], "right")) - 1
            for end in upto[np.searchsorted(cuts, offsets[text + 1 : last + 1])].tolist():
                yield np.concatenate([*held, ids[done:end], _END])
                held, done = [], end
            held.append(ids[done:])
            text, first, step = max(text, last), int(cuts[-1]), SLICE

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return list(self.encode_column(pa.array(texts, pa.string())))


@lru_cache(2)
def _encoder(path: str) -> TextEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return TextEncoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


STORE_SCHEMA = "shard int, seq int, vocabulary int, doc_ids array<long>, counts array<long>, blocks array<struct<n: int, crc: long, payload: binary>>"


def store(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The token files of the documents: rows of STORE_SCHEMA in ascending doc_id order."""
    path = tokenizer or default_tokenizer()
    schema = pa.schema([
        ("shard", pa.int32()), ("seq", pa.int32()), ("vocabulary", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
        ("blocks", pa.list_(pa.struct([("n", pa.int32()), ("crc", pa.int64()), ("payload", pa.binary())])))])

    def segment(seq: int, doc_ids: list, parts: list[np.ndarray]) -> pa.RecordBatch:
        ids, vocabulary = np.concatenate(parts), _encoder(path).vocabulary
        pieces = np.split(ids, np.cumsum(block_sizes(len(ids)))[:-1])
        blocks = [{"n": len(p), "crc": crc(p), "payload": b} for p, b in zip(pieces, encode_blocks(ids, vocabulary))]
        row = {"shard": TaskContext.get().partitionId(), "seq": seq, "vocabulary": vocabulary, "doc_ids": doc_ids, "counts": [len(p) for p in parts], "blocks": blocks}
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches):
        encoder, seq, doc_ids, parts, held = _encoder(path), 0, [], [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_column(batch.column(1))):
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids)
                if held >= SEGMENT:
                    yield segment(seq, doc_ids, parts)
                    seq, doc_ids, parts, held = seq + 1, [], [], 0
        if parts:
            yield segment(seq, doc_ids, parts)

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, STORE_SCHEMA)


def _segments(batches):
    for batch in batches:
        for row in batch.to_pylist():
            sizes = [b["n"] for b in row["blocks"]]
            ids = decode_blocks([b["payload"] for b in row["blocks"]], sizes, row["vocabulary"])
            for k, (end, block) in enumerate(zip(np.cumsum(sizes), row["blocks"])):
                if crc(ids[end - block["n"] : end]) != block["crc"]:
                    raise ValueError(f"block {k} of segment {row['seq']} in shard {row['shard']} is damaged")
            yield row, ids


def read_ids(files: DataFrame) -> DataFrame:
    """(shard, seq, place, doc_id, ids) of the stored documents, checked block by block."""

    def run(batches):
        for row, ids in _segments(batches):
            ends = np.cumsum(row["counts"])
            parts = np.split(ids, ends[:-1])
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()), pa.array(ends - row["counts"], pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(parts, pa.list_(pa.int32()))],
                names=["shard", "seq", "place", "doc_id", "ids"])

    return files.mapInArrow(run, "shard int, seq int, place long, doc_id long, ids array<int>")


def read_digest(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each stored document."""

    def run(batches):
        for row, ids in _segments(batches):
            ends, n = np.cumsum(row["counts"]), len(row["counts"])
            starts = ends - row["counts"]
            checks = [crc(ids[a:b]) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["seq"]] * n, pa.int32()), pa.array(starts, pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["counts"], pa.int64()), pa.array(checks, pa.int64())],
                names=["shard", "seq", "place", "doc_id", "n_tokens", "ids_crc32"])

    docs = files.mapInArrow(run, "shard int, seq int, place long, doc_id long, n_tokens long, ids_crc32 long")
    held = files.select("shard", "seq", F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c).alias("held"))
    inside = held.withColumn("base", F.coalesce(F.sum("held").over(W.partitionBy("shard").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    shards = held.groupBy("shard").agg(F.sum("held").alias("held"))  # as many rows as files
    shards = shards.select(F.col("shard"), F.coalesce(F.sum("held").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("shard_base"))
    bases = inside.join(shards, "shard").select("shard", "seq", (F.col("base") + F.col("shard_base")).alias("base"))
    return docs.join(bases, ["shard", "seq"]).select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def report(docs: DataFrame) -> DataFrame:
    """Writes the documents' token files and reads them back."""
    return read_digest(written(store(docs), "token-files"))
