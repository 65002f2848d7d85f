"""Helpers shared by the operators: written intermediate tables and batch-wise
hashing of words and word shingles.

A word is a maximal run of ASCII letters, digits or non-ASCII characters, with
A-Z lower-cased.  A text's shingle set holds the hash of every five consecutive
words; a text of one to four words has one shingle of all its words, and a null
text or one without words has the empty set."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctpulse.session import cut_lineage

SHINGLE_WORDS = 5
CHUNK_BYTES = 2 << 20  # text hashed at once; one longer text is still hashed whole


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read back lazily."""
    return cut_lineage(df, f"llm-{name}")


def text_chunks(column: pa.ChunkedArray | pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) pieces of a string column; nulls count as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


_BYTE = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
IS_WORD = (_BYTE >= 0x80) | ((_BYTE >= 48) & (_BYTE <= 57)) | ((LOWER >= 97) & (LOWER <= 122))

_ODD = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = pow(_ODD, -1, 1 << 64)
        for name, base in (("up", _ODD), ("down", inverse)):
            p = np.full(size, np.uint64(base), np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the concatenated texts, and each word's text.
    ``table`` tells for each byte whether it belongs to a word."""
    word = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1])) & ~edge[:-1]
    after = np.concatenate((word[1:], [False])) & ~edge[1:]
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words, and each word's text."""
    starts, ends, doc = word_spans(data, offsets)
    return span_hashes(LOWER[data], starts, ends), doc


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(0x2545F4914F6CDD1D) + words[j : j + n]
    return mix(h)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, doc = word_hashes(data, offsets)
    n_docs = len(offsets) - 1
    at = np.searchsorted(doc, np.arange(n_docs + 1))
    grams = window_hashes(words, k)
    out = []
    for d in range(n_docs):
        a, b = at[d], at[d + 1]
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(window_hashes(words[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def list_column(parts: list[np.ndarray], dtype=np.int64) -> pa.Array:
    """An Arrow list column from arrays; uint64 values keep their bits."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view(dtype) if flat.dtype.itemsize == np.dtype(dtype).itemsize else flat.astype(dtype)))


def constant_rows(spark: SparkSession, rows: list[tuple], **columns: str) -> DataFrame:
    """A few fixed rows as a frame, made of literals; ``columns`` are names and types."""
    made = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, columns.items())]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*made)))


def fresh(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def append_columns(df: DataFrame, text: str, fields: list[T.StructField], fn: Callable[[pa.Array], list[pa.Array]], keep: list[str] | None = None) -> DataFrame:
    """``df``'s columns (or those in ``keep``) and the new ``fields`` that ``fn``
    makes from each Arrow batch of the text column."""
    keep = df.columns if keep is None else keep
    at, picked = df.columns.index(text), [df.columns.index(c) for c in keep]
    schema = T.StructType([df.schema.fields[i] for i in picked] + fields)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in picked] + fn(batch.column(at)), names=schema.names)

    return df.mapInArrow(run, schema)
