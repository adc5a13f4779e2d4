"""Removal of every byte that a 100-byte string repeated from earlier covers.

1. Each map task finds the anchors of its texts (see suffix_core) and keeps, of anchors whose contexts (the bytes
   that the anchor's strings cover) are equal, the earliest; the others' strings are repeats at once. Contexts are equal if their
   BLAKE2b digests of 128 bits are: exact copies are told by this cryptographic digest of their bytes, not by a
   polynomial hash, and never reach the sort.
2. Anchors meet by gram hash. Of equal contexts the
   earliest stays; a gram with several contexts sends those on as representatives.
3. Representatives fetch their context bytes from the texts and meet by gram again: their
   suffixes are sorted with prefix-hash comparisons, neighbours' extensions verified byte by
   byte, and for every offset of a string the equal ones found by suffix run and left hash,
   which is verified too.
4. Repeated ranges meet their texts and are cut.

A string repeated by a third of all documents leaves every map task once. Nothing is capped.

Defined cases: null and empty texts have no bytes and keep the digest of nothing; texts under
100 bytes never change; ids that are null come before all others; rows that repeat an id are
ordered by their texts' hashes, and rows that repeat id and text are one document whose result
each of them gets; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import suffix_core as core
from .common import column_bytes, slices, written
from .packed import BUCKET_BYTES, SCHEMA, batches_of, dump, joined, load, meet, split_by, unzip

ANCHOR, FLAG, REP, TEXT, CONTEXT = range(5)
_ANCHOR = ("<u8", "<u8", "<u8", "<i8", "<u4", "u1", "u1")
_FLAG = ("<i8", "<u4", "<u4")
_REP = ("<u8", "<i8", "<u4", "u1", "u1")
_CONTEXT = ("<u8", "<i8", "<u4", "u1", "u1", "u1")
#: Bytes of text whose anchors are combined before they leave a map task.
COMBINE_BYTES = 8 << 20
#: Contexts that are sorted and compared at a time; a gram with more is one lot of its own.
LOT_CONTEXTS = 4096


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (core.mixed(key.astype(np.int64).view(np.uint64) if key.dtype != np.uint64 else key) % np.uint64(buckets)).astype(np.int64)


def merged_ranges(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges in order, those of a document that overlap or touch as one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), end[order].astype(np.int64)
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    # A running maximum that starts anew with every document: documents lifted above each other.
    lift = np.cumsum(first) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new = first.copy()
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], start[at], reach[np.concatenate([at[1:] - 1, [len(doc) - 1]])]


def _flags(doc: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    doc, start, end = merged_ranges(doc, start, end)
    for b, part in split_by(_bucket(doc, buckets), [doc, start.astype("<u4"), end.astype("<u4")]):
        yield FLAG, b, dump(part)


def _earliest(gram, context, more, doc, first) -> tuple[np.ndarray, np.ndarray]:
    """(order by gram, context, document, start; whether each there is the first of its gram and context)."""
    order = np.lexsort((first, doc, more, context, gram))
    g, c, d = gram[order], context[order], more[order]
    return order, np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (d[1:] != d[:-1])]) if len(order) else np.zeros(0, bool)


def _find(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[int, int, bytes]]:
    held: list[list[np.ndarray]] = []
    size = 0

    def flush():
        gram, context, more, doc, first, back, span = (np.concatenate(x) for x in zip(*held, strict=True))
        order, lead = _earliest(gram, context, more, doc, first)
        late = order[~lead]
        yield from _flags(doc[late], first[late], first[late].astype(np.int64) + span[late] + core.LENGTH, buckets)
        kept = np.sort(order[lead])
        own = [x[kept] for x in (gram, context, more, doc, first, back, span)]
        for b, part in split_by(_bucket(own[0], buckets), own):
            yield ANCHOR, b, dump(part)

    for table in slices(batches, "text", core.CHUNK):
        ids, offsets, texts = [], [], []
        for doc, text in zip(table.column("key").to_pylist(), column_bytes(table, "text"), strict=True):
            # A long text in pieces that overlap, so each string starts in one of them.
            for at in range(0, max(1, len(text) - core.LENGTH + 1), core.CHUNK):
                ids.append(doc)
                offsets.append(at)
                texts.append(text[at : at + core.CHUNK + core.LENGTH - 1])
        for lot in _lots(texts, core.CHUNK):
            starts = np.concatenate([[0], np.cumsum([len(x) for x in texts[lot]])])
            gram, context, more, anchor, first, last = core.anchors(np.frombuffer(b"".join(texts[lot]), np.uint8), starts)
            which = np.searchsorted(starts, first, "right") - 1
            docs = np.array(ids[lot], np.int64)[which]
            own = first - starts[which] + np.array(offsets[lot], np.int64)[which]
            held.append([gram, context, more, docs, own.astype(np.uint32), (anchor - first).astype(np.uint8), (last - first).astype(np.uint8)])
            size += int(starts[-1])
            if size >= COMBINE_BYTES:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


def _lots(texts: list[bytes], most: int) -> Iterator[slice]:
    a, size = 0, 0
    for i, x in enumerate(texts):
        if size and size + len(x) > most:
            yield slice(a, i)
            a, size = i, 0
        size += len(x)
    if a < len(texts):
        yield slice(a, len(texts))


def _resolve_anchors(buckets: int):
    def work(bucket: int, held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        def rows():
            for payload in held.get(FLAG, []):
                yield FLAG, bucket, payload
            if ANCHOR not in held:
                return
            gram, context, more, doc, first, back, span = joined(held.pop(ANCHOR), _ANCHOR)
            order, lead = _earliest(gram, context, more, doc, first)
            late = order[~lead]
            yield from _flags(doc[late], first[late], first[late].astype(np.int64) + span[late] + core.LENGTH, buckets)
            leads = order[lead]
            g = gram[leads]
            several = np.zeros(len(g), bool)
            several[1:] = g[1:] == g[:-1]
            several[:-1] |= several[1:].copy()
            some = leads[several]
            for b, part in split_by(_bucket(doc[some], buckets), [gram[some], doc[some], first[some], back[some], span[some]]):
                yield REP, b, dump(part)

        yield from batches_of(rows())

    return work


def _pack_texts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[int, int, bytes]]:
    for table in slices(batches, "text", COMBINE_BYTES):
        texts = column_bytes(table, "text")
        ids = table.column("key").to_numpy().astype(np.int64)
        place = np.arange(len(ids))
        for b, (rows, own) in split_by(_bucket(ids, buckets), [place, ids]):
            yield TEXT, b, dump([own, np.array([len(texts[i]) for i in rows], "<u8")], b"".join(texts[i] for i in rows))


class _Texts:
    """The texts of a bucket end to end, by id."""

    def __init__(self, payloads: list[bytes]):
        loaded = [load(p, ("<i8", "<u8")) for p in payloads]
        self.ids = np.concatenate([x[0][0] for x in loaded])
        sizes = np.concatenate([x[0][1] for x in loaded]).astype(np.int64)
        self.raw = b"".join(unzip(x[1]) for x in loaded)
        ends = np.cumsum(sizes)
        order = np.argsort(self.ids, kind="stable")
        self.ids, self.starts, self.ends = self.ids[order], (ends - sizes)[order], ends[order]

    def at(self, doc: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, doc)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


def _fetch_contexts(buckets: int):
    def work(bucket: int, held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        if REP not in held:
            return
        texts = _Texts(held[TEXT])
        gram, doc, first, back, span = joined(held[REP], _REP)
        which = texts.at(doc)
        start = texts.starts[which] + first
        # The whole 100 bytes from the anchor on, so that no suffix ends before its text does.
        end = np.minimum(texts.ends[which], start + back + core.LENGTH)
        length = (end - start).astype(np.int64)
        raw = np.frombuffer(texts.raw, np.uint8)

        def rows():
            order = np.arange(len(gram))
            for b, (some,) in split_by(_bucket(gram, buckets), [order]):
                tail = raw[_spread(start[some], length[some])].tobytes()
                yield CONTEXT, b, dump([gram[some], doc[some], first[some], back[some], span[some], length[some].astype(np.uint8)], tail)

        yield from batches_of(rows())

    return work


def repeated_strings(raw: np.ndarray, begin: np.ndarray, length: np.ndarray, gram: np.ndarray, doc: np.ndarray, first: np.ndarray, back: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of contexts in raw: (row, start in its document) of every string that also starts earlier."""
    order = np.argsort(gram, kind="stable")
    begin, length, gram, doc, first, back, span = (x[order].astype(np.int64) if x.dtype != np.uint64 else x[order] for x in (begin, length, gram, doc, first, back, span))
    hashes = core.prefix_hashes(raw)
    ranked, shared = core.suffix_sort(hashes, raw, gram, begin + back, length - back)
    at, g = (begin + back)[ranked], gram[ranked]
    d, f, high, low = doc[ranked], first[ranked], back[ranked], (back - span)[ranked]
    rows, sources, offsets = [], [], []
    for j in range(int(high.max(initial=-1)) + 1):
        own = np.flatnonzero((low <= j) & (j <= high))
        run = np.cumsum(shared < core.LENGTH - j)[own]
        mates = np.zeros(len(own), bool)
        mates[1:] = run[1:] == run[:-1]
        mates[:-1] |= mates[1:].copy()
        own, run = own[mates], run[mates]
        if not len(own):
            continue
        left = (hashes[at[own]] - hashes[at[own] - j]) * core._BACK[at[own] - j]
        start = f[own] + high[own] - j
        by = np.lexsort((start, d[own], left, run))
        fresh = np.concatenate([[True], (run[by][1:] != run[by][:-1]) | (left[by][1:] != left[by][:-1])])
        lead = by[np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))]
        rows.append(own[by[~fresh]].astype(np.int32))
        sources.append(own[lead[~fresh]].astype(np.int32))
        offsets.append(np.full(len(rows[-1]), j, np.uint8))
    if not any(map(len, rows)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, source, j = np.concatenate(rows), np.concatenate(sources), np.concatenate(offsets)
    del rows, sources, offsets
    # What is left of the anchor was compared by hash: verify the longest of each pair.
    pair = np.lexsort((j, source, row))
    last = np.concatenate([(row[pair][1:] != row[pair][:-1]) | (source[pair][1:] != source[pair][:-1]), [True]])
    far = pair[last]
    most = j[far].astype(np.int64)
    wrong = core.verified(raw, at[row[far]] - most, at[source[far]] - most, most) < most
    if wrong.any():
        clash = np.unique(g[row[far[wrong]]])
        keep = ~np.isin(g[row], clash)
        row, j = row[keep], j[keep]
        for key in clash:
            seen: dict[bytes, tuple[int, int]] = {}
            members = np.flatnonzero(g == key)
            strings = sorted((int(d[m]), int(f[m] + high[m] - k), int(m), k) for m in members for k in range(int(low[m]), int(high[m]) + 1))
            for doc_m, p, m, k in strings:
                text = raw[at[m] - k : at[m] - k + core.LENGTH].tobytes()
                if text in seen:
                    row, j = np.append(row, m), np.append(j, k)
                else:
                    seen[text] = doc_m, p
    return order[ranked[row]], f[row] + high[row] - j


def _resolve_contexts(buckets: int):
    def work(bucket: int, held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        loaded = [load(p, _CONTEXT) for p in held[CONTEXT]]
        columns = [np.concatenate([x[0][i] for x in loaded]) for i in range(6)]
        raw = np.frombuffer(b"".join(unzip(x[1]) for x in loaded), np.uint8)
        del loaded
        held.clear()
        gram, size = columns[0], columns[5].astype(np.int64)
        begin = np.cumsum(size) - size
        order = np.argsort(gram, kind="stable")
        own = gram[order]
        ends = np.append(np.flatnonzero(own[1:] != own[:-1]) + 1, len(own))

        def rows():
            a = 0
            while a < len(order):
                # Whole grams, as many as fit.
                b = int(ends[max(np.searchsorted(ends, a + LOT_CONTEXTS, "right") - 1, np.searchsorted(ends, a, "right"))])
                some = order[a:b]
                tail = raw[_spread(begin[some], size[some])]
                key, doc, first, back, span, length = (x[some] for x in columns)
                row, start = repeated_strings(tail, np.cumsum(size[some]) - size[some], length, key, doc, first, back, span)
                yield from _flags(doc[row], start, start + core.LENGTH, buckets)
                a = b

        yield from batches_of(rows())

    return work


def _cut(with_text: bool):
    def work(bucket: int, held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        if TEXT not in held:
            return
        texts = _Texts(held[TEXT])
        doc, start, end = merged_ranges(*joined(held.get(FLAG, []), _FLAG))
        cuts = np.searchsorted(doc, texts.ids), np.searchsorted(doc, texts.ids, "right")
        sizes, removed, spans, sha, kept_texts = [], [], [], [], []
        for i, (a, b) in enumerate(zip(*cuts, strict=True)):
            text = texts.raw[texts.starts[i] : texts.ends[i]]
            at, parts = 0, []
            for s, e in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True):
                parts.append(text[at:s])
                at = e
            kept = b"".join(parts) + text[at:]
            sizes.append(len(text))
            removed.append(len(text) - len(kept))
            spans.append(int(b - a))
            sha.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_texts.append(kept)
        columns = [pa.array(texts.ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(sha, pa.string())]
        names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_text:
            columns.append(pa.array(kept_texts, pa.binary()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return work


def _rows(work, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(work(batches, buckets))

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(key, text) with keys in the order of the documents; where ids repeat or are null, also (doc_id, th, key)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    odd = rows.groupBy("key").count().where("count > 1 OR key IS NULL").limit(1)
    if odd.isEmpty():
        return rows, None
    hashed = rows.withColumn("th", F.xxhash64("text"))
    # Ids and hashes alone are numbered in one order, and only where ids repeat or are null.
    names = written(hashed.select("key", "th").distinct().withColumn("nx", F.row_number().over(Window.orderBy(F.col("key").asc_nulls_first(), "th")).cast("bigint")), "suffix-keys")
    names = names.select(F.col("key").alias("doc_id"), "th", F.col("nx").alias("key"))
    one = hashed.withColumnRenamed("key", "id_x").withColumnRenamed("th", "th_x").join(names, F.col("id_x").eqNullSafe(F.col("doc_id")) & (F.col("th_x") == F.col("th")))
    return written(one.select("key", "text").dropDuplicates(["key"]), "suffix-texts"), names


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with_text the bytes kept."""
    spark = docs.sparkSession
    rows, names = _keyed(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-int(total) // bucket_bytes))

    def scan(work) -> DataFrame:
        return rows.mapInArrow(_rows(work, buckets), SCHEMA)

    found = written(meet(scan(_find), _resolve_anchors(buckets), SCHEMA), "suffix-anchors")
    contexts = meet(scan(_pack_texts).unionByName(found.where(f"kind = {REP}")), _fetch_contexts(buckets), SCHEMA)
    more = written(meet(contexts, _resolve_contexts(buckets), SCHEMA), "suffix-contexts")
    schema = "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text
    done = meet(scan(_pack_texts).unionByName(found.where(f"kind = {FLAG}")).unionByName(more), _cut(with_text), schema)
    if names is None:
        return done.withColumnRenamed("key", "doc_id")
    each = docs.select(F.col(id_col).cast("bigint").alias("id_x"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("th_x"))
    keyed = each.join(names, F.col("id_x").eqNullSafe(F.col("doc_id")) & (F.col("th_x") == F.col("th"))).select("doc_id", "key")
    return keyed.join(done, "key").drop("key")
