"""Language ID by a mixture of languages within each document.

Byte trigrams of a bounded sample of labelled documents give each language a smoothed
distribution. A document is cut into segments of SEGMENT bytes; expectation-maximisation over
the segments' trigram likelihoods estimates the proportions of all languages, then of the sets
of the 1, 2, ... most likely ones up to all, and the set of the best penalised likelihood is kept. Its
largest language is the prediction; the score is that language's share of the segments, with
one segment's weight of prior spread over all languages.

Defined cases: null, empty and letterless texts are `und` with score 0; a null label is no
training row; a null id never trains and is not held out; without any training row everything
is `und`; ties go to the language first in alphabetical order; rows that repeat an id each
get a row; other columns are ignored by `predict` and kept by `drop_unknown`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, slices

#: Training documents taken of each language, on average; the only bounded part.
TRAIN_DOCS = 2000
BUCKETS = 1 << 16
SEGMENT = 32
ROUNDS = 12
#: Neighbouring trigrams share bytes: their log-likelihoods count this much.
TEMPER = 0.5
#: Cost of a further language in the set, times log of the number of segments.
PENALTY = 3.0
UNKNOWN = "und"

_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)], np.uint8)
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    return _ASCII_LETTER.search(text) is not None or (not text.isascii() and any(c.isalpha() for c in text.decode()))


def trigrams(text: np.ndarray) -> np.ndarray:
    """A bucket for every byte position: the byte and the two behind it, spaces past the end."""
    folded = np.full(len(text) + 2, 32, np.uint32)
    folded[:-2] = _FOLD[text]
    key = folded[:-2] | folded[1:-1] << np.uint32(8) | folded[2:] << np.uint32(16)
    return (key * np.uint32(2654435761)) >> np.uint32(16)


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = 0.1):
        """counts: (languages, BUCKETS)."""
        self.languages = languages
        weights = counts + smoothing
        self.table = np.ascontiguousarray((TEMPER * np.log(weights / weights.sum(axis=1, keepdims=True))).T.astype(np.float32)) if languages else None

    def segments(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihood of every segment in every language, segments of each text)."""
        parts, counts = [], []
        for text in texts:
            n = len(text)
            counts.append(-(-n // SEGMENT))
            raw = np.frombuffer(text, np.uint8)
            for a in range(0, n, 1 << 18):
                piece = raw[a : a + (1 << 18) + 2]
                own = min(1 << 18, n - a)
                values = self.table[trigrams(piece)[:own]]
                parts.append(np.add.reduceat(values, np.arange(0, own, SEGMENT), axis=0))
        return np.concatenate(parts).astype(np.float64), np.array(counts)

    def mixture(self, likely: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log-likelihood of each document with the languages that `allowed` marks."""
        top = likely.max(axis=1, keepdims=True)
        odds = np.exp(likely - top)
        of = np.repeat(np.arange(len(sizes)), sizes)
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            weighted = odds * share[of]
            weighted /= np.maximum(weighted.sum(axis=1, keepdims=True), 1e-300)
            share = np.add.reduceat(weighted, starts) / sizes[:, None]
            share = np.where(allowed, np.maximum(share, 1e-9), 0)
            share /= share.sum(axis=1, keepdims=True)
        seen = np.maximum((odds * share[of]).sum(axis=1), 1e-300)
        return share, np.add.reduceat(np.log(seen) + top[:, 0], starts)

    def infer(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of non-empty texts: proportions within the chosen set, and the number of segments."""
        likely, sizes = self.segments(texts)
        starts = np.cumsum(sizes) - sizes
        n, m = len(texts), len(self.languages)
        alone = np.add.reduceat(likely, starts)
        best_share = np.zeros((n, m))
        best_share[np.arange(n), alone.argmax(axis=1)] = 1
        best = alone.max(axis=1)
        if m > 1:
            full, _ = self.mixture(likely, starts, sizes, np.ones((n, m), bool))
            order = np.argsort(-full, axis=1, kind="stable")
            # A document all of whose segments one language claims needs no larger set.
            mixed = np.flatnonzero(full.max(axis=1) < 1 - 1e-3)
            if len(mixed):
                rows = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in mixed])
                own, own_sizes = likely[rows], sizes[mixed]
                own_starts = np.cumsum(own_sizes) - own_sizes
                for k in range(2, m + 1):
                    allowed = np.zeros((len(mixed), m), bool)
                    np.put_along_axis(allowed, order[mixed, :k], True, axis=1)
                    share, seen = self.mixture(own, own_starts, own_sizes, allowed)
                    gain = seen - (k - 1) * PENALTY * np.log(own_sizes + 1)
                    better = gain > best[mixed]
                    best[mixed[better]], best_share[mixed[better]] = gain[better], share[better]
        return best_share, sizes


def _count(id_col: str, text_col: str, lang_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for table in slices(batches, text_col):
            for lang, text in zip(table.column(lang_col).to_pylist(), column_bytes(table, text_col), strict=True):
                if text:
                    total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    np.add(total, np.bincount(trigrams(np.frombuffer(text, np.uint8)), minlength=BUCKETS), out=total)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(total[used])], names=["lang", "bucket", "n"])

    return run


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train: Column | None = None, most: int = TRAIN_DOCS) -> Model:
    """The model of a sample of about `most` documents a language among those that `train` allows, chosen by the hash of their ids."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows if train is None else rows.where(train)
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not counts:
        return Model([], np.zeros((0, BUCKETS)))
    scale = 1 << 20
    threshold = F.element_at(F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(scale, -(-most * scale // n)))]), F.col(lang_col))
    sample = rows.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(scale)) < threshold).select(id_col, F.col(text_col).alias("text_x"), F.col(lang_col).alias("lang_x"))
    grams = sample.mapInArrow(_count(id_col, "text_x", "lang_x"), "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most BUCKETS rows a language, whatever the input.
    got = grams.toPandas()
    languages = sorted(set(got["lang"]))
    table = np.zeros((len(languages), BUCKETS))
    place = {x: i for i, x in enumerate(languages)}
    table[got["lang"].map(place).to_numpy(dtype=np.int64), got["bucket"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.float64)
    return Model(languages, table)


def _judge(model: Model, texts: list[bytes]) -> tuple[list[str], np.ndarray, list[list[str]]]:
    """Prediction, score and chosen set of each text."""
    lang, score, sets = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
    known = [i for i, x in enumerate(texts) if model.languages and has_letter(x)]
    if known:
        share, sizes = model.infer([texts[i] for i in known])
        best = share.argmax(axis=1)
        score[known] = (share[np.arange(len(known)), best] * sizes + 1 / len(model.languages)) / (sizes + 1)
        for i, b, row in zip(known, best, share, strict=True):
            lang[i] = model.languages[b]
            sets[i] = [model.languages[k] for k in np.argsort(-row, kind="stable") if row[k] > 0]
    return lang, score, sets


def _predict(shared, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches, text_col, 2 << 20):
            lang, score, sets = _judge(shared.value, column_bytes(table, text_col))
            yield pa.RecordBatch.from_arrays(
                [table.column(id_col).combine_chunks(), pa.array(lang, pa.string()), pa.array(score), pa.array(sets, pa.list_(pa.string()))],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score, languages (the chosen set, largest share first)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col)
    return rows.mapInArrow(_predict(shared, id_col, text_col), "doc_id bigint, lang_pred string, score double, languages array<string>")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def drop_unknown(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs without those that are `und`, all columns kept.

    Those are the null, empty and letterless texts: a text with letters always has a most likely language among those learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches, text_col, 2 << 20):
            lang, _, _ = _judge(shared.value, column_bytes(table, text_col))
            yield from table.filter(pa.array([x != UNKNOWN for x in lang])).combine_chunks().to_batches()

    return docs.mapInArrow(run, docs.schema)
