"""Language ID: a byte convolutional network trained in numpy.

A text is cut into windows of ``WINDOW`` bytes (the last one zero-filled).
Filters of two, three and four bytes run over a window, each is max-pooled, and
a softmax layer gives the window's language probabilities; a text's are the
mean over its windows, weighted by their bytes.  Training takes one window from
each of about ``TRAIN_DOCS`` documents per language, chosen by a hash of the id
among those whose crc32(doc_id) mod 5 is not 0; prediction reads whole texts.

Defined results: a null text or one without a letter is ``und`` with score 0,
and so is everything if no language was learned; a null doc_id counts as
training side (its remainder is null, held_out is null-safe false); repeated
rows are judged alike; an empty table gives no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctpulse.llm.common import LOWER, append_columns, fresh, text_chunks, written

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
TRAIN_DOCS = 1200  # expected number per language
MAX_WINDOWS = 400_000  # bound on what the driver gathers: the first of every language, in a random order
BROADCAST_LABELS = 500_000
NONE = "und"
CHUNK = 1 << 19

_IS_LETTER = (LOWER >= 97) & (LOWER <= 122)


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Zero-filled windows of all texts, each one's text and its bytes."""
    size = np.diff(offsets)
    count = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][doc] + number * WINDOW
    used = np.minimum(WINDOW, offsets[1:][doc] - start)
    at = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < used[:, None]
    return np.where(inside, data[np.where(inside, at, 0)], 0).astype(np.uint8) if len(doc) else np.zeros((0, WINDOW), np.uint8), doc, used


class ByteConvNet:
    """kernels[w]: (w, 256, FILTERS), what each byte at each filter place adds."""

    def __init__(self, languages: list[str], seed: int = 5):
        self._tables = None
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.kernels = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """The kernels regrouped by byte pair: what bytes t, t+1 add to all
        filters at t, and what bytes t+2, t+3 add to the wider ones."""
        k2, k3, k4 = self.kernels
        first = np.concatenate([(k[0][:, None] + k[1][None]).reshape(65536, FILTERS) for k in (k2, k3, k4)], axis=1)
        second = np.concatenate([np.repeat(k3[2], 256, axis=0), (k4[2][:, None] + k4[3][None]).reshape(65536, FILTERS)], axis=1)
        return first, second

    def responses(self, x: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Filter outputs at all places of each window, (windows, places, filters)."""
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        r = tables[0][pair[:, :-2]]
        r[:, :, FILTERS:] += tables[1][pair[:, 2:]]
        return r

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.out + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.01, seed: int = 6) -> "ByteConvNet":
        """Cross entropy by Adam; a pooled filter's gradient goes to its best place."""
        params = [*self.kernels, self.out, self.bias]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                own = order[i : i + batch]
                r = np.concatenate([sum(k[j][x[own, j : WINDOW - 3 + j]] for j in range(len(k))) for k in self.kernels], axis=2)
                place, pooled = r.argmax(axis=1), r.max(axis=1)
                p = self.probabilities(pooled)
                p[np.arange(len(own)), y[own]] -= 1
                p /= len(own)
                grads = [np.zeros_like(k) for k in self.kernels] + [np.maximum(pooled, 0).T @ p, p.sum(axis=0)]
                back = (p @ self.out.T) * (pooled > 0)
                for k, width in enumerate(WIDTHS):
                    own_filters = slice(k * FILTERS, (k + 1) * FILTERS)
                    for j in range(width):
                        byte = np.take_along_axis(x[own], place[:, own_filters] + j, axis=1)
                        np.add.at(grads[k][j], (byte, np.arange(FILTERS)[None].repeat(len(own), 0)), back[:, own_filters])
                step += 1
                for q, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        return self

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each whole text."""
        if self._tables is None:  # once for a worker's batches
            self._tables = self.tables()
        tables, names, scores = self._tables, [], []
        for first, data, offsets in text_chunks(column, CHUNK):
            n = len(offsets) - 1
            x, doc, used = windows(data, offsets)
            p = np.zeros((len(x), len(self.languages)))
            for i in range(0, len(x), CHUNK // WINDOW):  # bounds memory for a very long text
                p[i : i + CHUNK // WINDOW] = self.probabilities(self.responses(x[i : i + CHUNK // WINDOW], tables).max(axis=1))
            total = np.zeros((n, len(self.languages)))
            np.add.at(total, doc, p * used[:, None])
            total /= np.maximum(np.diff(offsets), 1)[:, None]
            letters = np.concatenate(([0], np.cumsum(_IS_LETTER[data])))
            plain = letters[offsets[1:]] > letters[offsets[:-1]]
            for d in range(n):
                known = plain[d] or any(c.isalpha() for c in bytes(data[offsets[d] : offsets[d + 1]]).decode("utf-8", "replace"))
                best = int(total[d].argmax()) if known else 0
                names.append(self.languages[best] if known else NONE)
                scores.append(min(1.0, float(total[d][best])) if known else 0.0)
        return names, np.array(scores)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> ByteConvNet | None:
    """Trains on one window of each sampled document; None if nothing is labelled."""
    side = docs.select("doc_id", "text", "lang").filter(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = written(side.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    if counts.count() <= BROADCAST_LABELS:
        counts = F.broadcast(counts)
    # a row's place among its language's rows, about: sampled by id and text, so that a repeated id is not taken whole
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1 << 53)) / F.lit(float(1 << 53)) * F.col("n")
    room = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    piece = F.substring("text", (F.pmod(F.xxhash64("doc_id", "text", F.lit(12)), room) + 1).cast("int"), F.lit(WINDOW))
    picked = side.join(counts, "lang").withColumn("place", place).filter(F.col("place") < train_docs).select("doc_id", "lang", "place", piece.alias("piece")).distinct()
    bounded = picked.orderBy("place", "lang", "piece", "doc_id").limit(MAX_WINDOWS)
    rows = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["lang"], r["piece"]) for r in bounded.collect())
    if not rows:
        return None
    languages = sorted({lang for _, lang, _ in rows})
    data = [piece.encode()[:WINDOW].ljust(WINDOW, b"\0") for _, _, piece in rows]
    x = np.frombuffer(b"".join(data), np.uint8).reshape(len(rows), WINDOW)
    number = {lang: i for i, lang in enumerate(languages)}
    return ByteConvNet(languages).train(x, np.array([number[lang] for _, lang, _ in rows]))


def with_language(docs: DataFrame, model: ByteConvNet | None, lang: str, score: str, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the predicted language and its score, from the whole text."""
    fields = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]

    def predict(column: pa.Array) -> list[pa.Array]:
        names, scores = model.predict(column) if model else ([NONE] * len(column), np.zeros(len(column)))
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return append_columns(docs, "text", fields, predict, keep)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    out = with_language(docs.select("doc_id", "text"), fit(docs), "lang_pred", "score", ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """The documents whose language is known, with their own columns; ``lang`` has the
    language predicted from the whole text, so that what follows does not go by a missing
    or wrong label.  A ``min_score`` above 0 also drops clean texts in several languages:
    the score is a mean over windows."""
    lang, score = fresh("lang_pred", docs), fresh("lang_score", docs)
    out = with_language(docs, fit(docs), lang, score)
    known = out.filter((F.col(lang) != NONE) & (F.col(score) >= min_score))
    return known.select(*[F.col(lang).alias(c) if c.lower() == "lang" else F.col(c) for c in docs.columns])
