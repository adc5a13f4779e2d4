"""Benchmark decontamination by an FM-index of every training shard.

A shard is a run of documents in a map task. Its words become symbols: each benchmark word
has its own, any other word is a separator. Runs of benchmark words too short to hold a
phrase cannot match and are left out of the index. The phrases (10 consecutive words of an
item, or a shorter item whole) are searched backward through wavelet ranks, their
occurrences located by sampled suffix positions, and the spans merged per document.

The benchmark is searched in blocks of at most BLOCK_BYTES of item text, so what is
broadcast has that bound whatever the benchmark's size.

Defined cases: null and empty texts have no words and match nothing; items without words or
with a null id match nothing; items that repeat an id are one item; rows that repeat a
doc_id each get a row; empty tables give no rows or no matches; other columns are ignored by
`matches` and kept by `drop_contaminated`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_bytes, slices
from .fm_index import FMIndex

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 8 << 20
#: A-Z to a-z; word characters are 0-9, a-z and every byte above 127; the rest parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Phrases:
    """The windows of some items: vocabulary, windows by length, items by window."""

    def __init__(self, items: list[tuple[object, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            if item is None:
                continue
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                found.setdefault(tuple(ids[i : i + size]), set()).add(str(item))
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for size in sorted({len(x) for x in found}):
            own = [x for x in found if len(x) == size]
            self.by_length[size] = np.array(own, np.int64), [sorted(found[x]) for x in own]


def search_shard(texts: list[bytes], phrases: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
    """Per text: words, merged spans [first word, past the last word), items found."""
    known, counts, ids = phrases.vocabulary.get, [], []
    for text in texts:
        tokens = words(text)
        counts.append(len(tokens))
        ids += map(known, tokens, repeat(0))
        ids.append(0)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[list[str]] = [[] for _ in texts]
    if not phrases.by_length or not ids:
        return counts, spans, items
    whole = np.array(ids, np.int64)
    starts = np.concatenate([[0], np.cumsum(np.array(counts) + 1)])
    # Runs of benchmark words that a phrase fits in, each with the separator behind it.
    gaps = np.flatnonzero(whole == 0)
    before = np.concatenate([[-1], gaps[:-1]])
    lengths = gaps - before - 1
    keep = lengths >= min(phrases.by_length)
    if not keep.any():
        return counts, spans, items
    first, lengths = before[keep] + 1, lengths[keep] + 1
    offset = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(offset - first, lengths)
    index = FMIndex(whole[place], len(phrases.vocabulary) + 1)
    at, size, which = [], [], []
    for n, (patterns, _) in phrases.by_length.items():
        low, high = index.search(patterns)
        hit = np.flatnonzero(high > low)
        many = high[hit] - low[hit]
        rows = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many - low[hit], many)
        at.append(place[index.locate(rows)])
        size.append(np.full(len(rows), n))
        which.append(np.repeat(hit, many))
    found = [(n, at[i], which[i]) for i, n in enumerate(phrases.by_length)]
    begin, end = np.concatenate(at), np.concatenate(at) + np.concatenate(size)
    if not len(begin):
        return counts, spans, items
    # Spans that overlap or touch are one.
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    opens = begin[new]
    closes = end[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(end) - 1]])]
    for doc, a, b in zip((np.searchsorted(starts, opens, "right") - 1).tolist(), opens.tolist(), closes.tolist(), strict=True):
        spans[doc].append((a - int(starts[doc]), b - int(starts[doc])))
    seen: list[set[str]] = [set() for _ in texts]
    for n, places, kinds in found:
        docs = np.searchsorted(starts, places, "right") - 1
        pairs = np.unique(np.stack([docs, kinds]), axis=1) if len(docs) else np.zeros((2, 0), np.int64)
        of = phrases.by_length[n][1]
        for doc, kind in zip(*pairs.tolist(), strict=True):
            seen[doc].update(of[kind])
    return counts, spans, [sorted(x) for x in seen]


_FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("th", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("past", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))


def _search(shared, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches, text_col, SHARD_BYTES):
            counts, spans, items = search_shard(column_bytes(table, text_col), shared.value)
            rows = [[{"first": a, "past": b} for a, b in x] for x in spans]
            yield pa.RecordBatch.from_arrays(
                [table.column(id_col).combine_chunks(), table.column("th").combine_chunks(), pa.array(counts, pa.int64()), pa.array(rows, _SPANS), pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "th", "n_words", "spans", "items"],
            )

    return run


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[list[tuple[object, bytes]]]:
    """The items in blocks of about `most` bytes, each collected to the driver by itself."""
    size = benchmark.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, -(-int(size) // most))
    for i in range(blocks):
        part = benchmark if blocks == 1 else benchmark.where(F.pmod(F.xxhash64(item_col), F.lit(blocks)) == i)
        yield [(r[0], (r[1] or "").encode()) for r in part.where(F.col(item_col).isNotNull()).select(item_col, text_col).collect()]


def _merged(spans) -> Column:
    """Spans that overlap or touch as one."""

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["past"], x["past"]).alias("past"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["past"] >= x["first"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast(_FOUND["spans"].dataType), add)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of docs: doc_id, n_words, spans (word positions, merged), items (ids as strings, sorted)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"))
    parts = []
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = spark.sparkContext.broadcast(Phrases(block, window))
        parts.append(rows.mapInArrow(_search(shared, id_col, text_col), _FOUND))
    if len(parts) == 1:
        return parts[0].drop("th")
    # Rows that repeat an id are told apart by their texts; those that repeat both have the same matches, whichever is taken.
    whole = parts[0].withColumn("block", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        whole = whole.unionByName(part.withColumn("block", F.lit(i)))
    nth = "row_number() OVER (PARTITION BY doc_id, th, block ORDER BY n_words)"
    grouped = whole.withColumn("nth", F.expr(nth)).groupBy("doc_id", "th", "nth").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return grouped.select("doc_id", "n_words", _merged("spans").alias("spans"), "items")


def digests(found: DataFrame) -> DataFrame:
    """The columns of the query, from `matches`."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["past"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the rows that hold a phrase of the benchmark, all columns kept; one pass for each block of items."""
    spark = docs.sparkSession

    def clean(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in slices(batches, text_col, SHARD_BYTES):
                _, spans, _ = search_shard(column_bytes(table, text_col), shared.value)
                yield from table.filter(pa.array([not x for x in spans])).combine_chunks().to_batches()

        return run

    left = docs
    for block in item_blocks(benchmark, item_col, item_text_col, block_bytes):
        left = left.mapInArrow(clean(spark.sparkContext.broadcast(Phrases(block, window))), docs.schema)
    return left


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without the words of these spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    out, at = [], 0
    for first, past in spans:
        out.append(text[at : places[first][0]])
        at = places[past - 1][1]
    return b"".join(out) + text[at:]


def item_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
