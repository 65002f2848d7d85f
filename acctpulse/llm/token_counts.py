"""Token counts of whole texts by overlap resynchronisation.

A text of up to ``2 * chunk`` characters is encoded by the library at once.  A
longer one is cut into chunks that are encoded apart, each with ``overlap``
characters of its neighbours on both sides.  Two neighbours are spliced at a
boundary where both encodings have the same token before and the same token
after it; the count is taken from the left chunk up to there and from the right
one beyond.

Why that is exact: byte-pair encoding joins the best-scored neighbours first, so
a row of tokens is the encoding of its text if, and only if, every two
neighbouring tokens are the encoding of their own two texts (until a join
crosses a boundary, the sides of it are joined independently of each other and
of what lies beyond).  Left of the splice all neighbours stand side by side in
the left chunk's encoding, right of it in the right chunk's, and the two at the
splice in both.  The mark that the library puts before each chunk is part of its
first token, which is never the token before a splice.

Where no common boundary is found, as in a long run of one character, the
overlap widens to ``wide`` characters; where that fails too, it widens to the
whole neighbours: the chunks become one.  A text that never aligns thus ends up
encoded whole.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings
in a text are ordinary text, as the library takes them; rows are counted one by
one, so repeated rows and ids and null ids are kept; an empty table gives no
rows; there is no order to tie; other columns are not read, so their names
cannot clash."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acctpulse.llm.common import written

CHUNK = 1 << 15  # characters
OVERLAP = 128
WIDE = 1 << 12
LIMIT = 4096
SLICE_BYTES = 1 << 20  # of short texts encoded at once
MARK = "▁"

_EDGE = "array<struct<at: long, before: int, after: int>>"
_SPLIT = "doc_id {id}, n_bytes long, n_tokens long, row string, lo long, hi long, size long, left_at long, text string"
_ENCODED = f"row string, lo long, hi long, n long, head {_EDGE}, head_n array<long>, tail {_EDGE}, tail_n array<long>"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Encoder:
    """The library, with the number of characters of each token."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        own = self.library
        # a character without a piece is spelled in bytes, of which the first stands for it
        byte = {own.piece_to_id(f"<0x{b:02X}>"): b for b in range(256)}
        self.width = np.array([(0 if 0x80 <= byte[i] < 0xC0 else 1) if i in byte else len(own.id_to_piece(i)) for i in range(own.get_piece_size())], np.int64)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids, and the place in the text at which each ends (the mark put before the text is not counted)."""
        ids = np.array(self.library.encode(text), np.int32)
        return ids, np.cumsum(self.width[ids]) - 1


@lru_cache(2)
def load(path: str) -> Encoder:
    return Encoder(path)


def _edge(ids: np.ndarray, ends: np.ndarray, low: int, high: int) -> tuple[list[dict], list[int]]:
    """The boundaries from low to high, with the tokens around them and the number of tokens before."""
    # not after the first token, nor before the further bytes of a character
    k = np.flatnonzero((ends[:-1] >= low) & (ends[:-1] <= high) & (ends[1:] > ends[:-1])) if len(ids) > 1 else np.zeros(0, np.int64)
    k = k[k > 0]
    return [{"at": int(ends[i]), "before": int(ids[i]), "after": int(ids[i + 1])} for i in k], (k + 1).tolist()


def _slices(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Parts of a column of about SLICE_BYTES."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)) if len(column) else []
    first = 0
    while first < len(column):
        done = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, done + SLICE_BYTES, "right")))
        yield first, column.slice(first, last - first)
        first = last


def _split(docs: DataFrame, path: str, chunk: int, wide: int) -> DataFrame:
    """Short texts with their counts, long ones in chunks of ``lo`` to ``hi``, whose text has ``wide``
    characters of its neighbours on both sides and starts at ``left_at``."""
    schema = _SPLIT.format(id=dict(docs.dtypes)["doc_id"])
    names = [field.strip().split(" ")[0] for field in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for first, part in _slices(column):
                texts = [t or "" for t in part.to_pylist()]
                own = ids.slice(first, len(part))
                sizes = pc.fill_null(pc.binary_length(part), 0).cast(pa.int64())
                short = [i for i, t in enumerate(texts) if len(t) <= 2 * chunk]
                n, none = len(short), [None] * len(short)
                at = pa.array(short, pa.int64())
                counts = pa.array(encoder.counts([texts[i] for i in short]), pa.int64())
                yield pa.RecordBatch.from_arrays([own.take(at), sizes.take(at), counts, pa.array(none, pa.string()), *[pa.array(none, pa.int64())] * 4, pa.array(none, pa.string())], names=names)
                for i, text in enumerate(texts):
                    if len(text) > 2 * chunk:
                        row, n = uuid.uuid4().hex, len(text)
                        for lo in range(0, n, chunk):
                            hi, left = min(n, lo + chunk), max(0, lo - wide)
                            cells = [sizes[i].as_py(), None, row, lo, hi, n, left, text[left : hi + wide]]
                            yield pa.RecordBatch.from_arrays([own.slice(i, 1), *[pa.array([c], pa.string() if isinstance(c, str) else pa.int64()) for c in cells]], names=names)

    return docs.mapInArrow(run, schema)


def _encode(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """Each chunk's number of tokens, and its boundaries around ``lo`` and ``hi``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path)
        for batch in batches:
            for i in range(batch.num_rows):
                row, lo, hi, size, left, text = (batch.column(c)[i].as_py() for c in ("row", "lo", "hi", "size", "left_at", "text"))
                start, end = max(0, lo - overlap), min(size, hi + overlap)
                ids, ends = encoder.boundaries(text[start - left : end - left])
                ends = ends + start
                head, head_n = _edge(ids, ends, start, min(hi, lo + overlap)) if lo else ([], [])
                tail, tail_n = _edge(ids, ends, max(lo, hi - overlap), end) if hi < size else ([], [])
                edge = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int32()), ("after", pa.int32())]))
                cells = [([row], pa.string()), ([lo], pa.int64()), ([hi], pa.int64()), ([len(ids)], pa.int64()), ([head], edge), ([head_n], pa.list_(pa.int64())), ([tail], edge), ([tail_n], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in cells], names=["row", "lo", "hi", "n", "head", "head_n", "tail", "tail_n"])

    return chunks.select("row", "lo", "hi", "size", "left_at", "text").repartition("row", "lo").mapInArrow(run, _ENCODED)


def _seams(encoded: DataFrame) -> DataFrame:
    """(row, at, gain): for each two neighbours, what their splice adds to the right one's count; null if they do not align."""
    left = encoded.select("row", F.col("hi").alias("at"), "tail", "tail_n")
    right = encoded.filter(F.col("lo") > 0).select("row", F.col("lo").alias("at"), "head", "head_n")
    both = left.join(right, ["row", "at"]).withColumn("both", F.get(F.array_intersect("tail", "head"), 0))
    place = lambda edge, n: F.expr(f"{n}[cast(array_position({edge}, both) - 1 AS int)]")
    return both.select("row", "at", F.when(F.col("both").isNotNull(), place("tail", "tail_n") - place("head", "head_n")).alias("gain"))


def _joined(chunks: DataFrame, seams: DataFrame) -> DataFrame:
    """The chunks with those that share a failed seam made one."""
    light = chunks.select("row", "lo").join(seams.select("row", F.col("at").alias("lo"), F.col("gain").isNull().alias("failed")), ["row", "lo"], "left")
    starts = F.when(~F.coalesce("failed", F.lit(False)), F.col("lo"))
    grouped = light.select("row", "lo", F.max(starts).over(W.partitionBy("row").orderBy("lo")).alias("first"))
    own = F.expr("substring(text, cast(lo - left_at + 1 AS int), cast(hi - lo AS int))")
    before = F.expr("substring(text, 1, cast(lo - left_at AS int))")
    after = F.expr("substring(text, cast(hi - left_at + 1 AS int))")
    parts = chunks.join(grouped, ["row", "lo"]).select("row", "first", F.struct("lo", own.alias("own"), before.alias("before"), after.alias("after"), "hi", "left_at", "size").alias("p"))
    runs = parts.groupBy("row", "first").agg(F.sort_array(F.collect_list("p")).alias("p"))
    text = F.concat(F.expr("p[0].before"), F.array_join(F.col("p.own"), ""), F.element_at("p", -1)["after"])
    return runs.select("row", F.expr("p[0].lo").alias("lo"), F.element_at("p", -1)["hi"].alias("hi"), F.expr("p[0].size").alias("size"), F.expr("p[0].left_at").alias("left_at"), text.alias("text"))


def _long_counts(chunks: DataFrame, path: str, overlap: int, wide: int) -> DataFrame:
    """(row, n_tokens) of the texts in chunks; texts whose chunks fail to align are tried again with wider overlaps."""
    done, reach = None, overlap
    while True:
        encoded = written(_encode(chunks, path, reach), "encoded-chunks")
        seams = written(_seams(encoded), "chunk-seams")
        failed = seams.filter("gain IS NULL").select("row").distinct()
        last = encoded.groupBy("row").agg(F.max_by("n", "lo").alias("n"))
        gains = seams.groupBy("row").agg(F.sum("gain").alias("gain"))
        some = last.join(failed, "row", "left_anti").join(gains, "row", "left").select("row", (F.col("n") + F.coalesce("gain", F.lit(0))).alias("n_tokens"))
        done = some if done is None else done.unionByName(some)
        if failed.isEmpty():
            return done
        chunks = chunks.join(failed, "row", "left_semi")
        if reach < wide:
            reach = wide
        else:
            chunks = written(_joined(chunks, seams.join(failed, "row", "left_semi")), "joined-chunks")


def count(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP, wide: int = WIDE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    if not 0 < overlap <= wide <= chunk // 2:
        raise ValueError("the overlaps of a chunk must not meet: overlap <= wide <= chunk / 2")
    path = path or default_model()
    parts = written(_split(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), path, chunk, wide), "token-counts")
    short = parts.filter("row IS NULL").select("doc_id", "n_bytes", "n_tokens")
    chunks = parts.filter("row IS NOT NULL")
    if not chunks.isEmpty():
        found = _long_counts(chunks, path, overlap, wide)
        short = short.unionByName(chunks.filter("lo = 0").select("doc_id", "n_bytes", "row").join(found, "row").select("doc_id", "n_bytes", "n_tokens"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)
