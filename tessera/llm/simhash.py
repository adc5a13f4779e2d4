"""SimHash near-dedup with bit-sliced comparison.

A fingerprint bit is set if it is set in over half of the XXH64 hashes of the document's
3-word shingles. Distinct fingerprints meet wherever two of their four 16-bit blocks agree,
which any two at distance 2 or less do. Inside those buckets bit planes are stored
vertically: one 64-bit word holds one bit of 64 fingerprints. For each lag, the planes of the
positions and of the positions that far ahead are compared 64 pairs at a time by carry-save
counters that start so high that their carry-out marks distances beyond the radius; words
whose pairs have all exceeded it are abandoned. A bucket has no cap.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero, which
links like any other; fewer than three words are one shingle; rows that repeat an id each get
a row; a null id gets a row and names no component unless its whole group is null; an empty
table gives no rows; other columns are ignored by `near_copies` and kept by `drop_near_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, slices, written
from .components import components

WORDS = 3
SEED = 42
RADIUS = 2
BLOCKS = 4
#: Fingerprints compared in one go; a larger bucket is still one go.
CHUNK = 1 << 19


def shingles(text: bytes, words: int) -> list[bytes]:
    """Every run of `words` words, repeats included; fewer words are one shingle, none are none."""
    tokens = text.lower().split()
    if len(tokens) <= words:
        return [b" ".join(tokens)] if tokens else []
    return list(map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)))


def hashes(of: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, of, repeat(SEED)), np.uint64, len(of))


def fingerprint(text: bytes, words: int = WORDS) -> int:
    return majority(hashes(shingles(text, words)))


def majority(own: np.ndarray) -> int:
    """The bits that over half of the hashes have; of no hashes zero."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(own), 1 << 16):
        part = own[a : a + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(own), bitorder="little").view("<u8")[0])


def text_hash(text_col: str):
    """With the id, what tells rows apart that repeat an id."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Per row: doc_id, th (hash of the text), fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches, text_col):
            fp = np.array([fingerprint(x, words) for x in column_bytes(table, text_col)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([table.column(id_col).combine_chunks(), table.column("th").combine_chunks(), pa.array(fp)], names=["doc_id", "th", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col, text_hash(text_col).alias("th"))
    return rows.mapInArrow(run, "doc_id bigint, th bigint, fp bigint")


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """(64, words + 2) of uint64: bit i of word w of plane b is bit b of fingerprint 64 w + i."""
    words = -(-len(fp) // 64)
    padded = np.zeros((words + 2) * 64, np.uint64)
    padded[: len(fp)] = fp
    out = np.empty((64, words + 2), np.uint64)
    for a in range(0, len(padded), 1 << 16):
        part = padded[a : a + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64)
        out[:, a // 64 : (a + len(part)) // 64] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    return out


def close_at(planes: np.ndarray, lag: int, words: np.ndarray, mask: np.ndarray, order: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (i, i + lag) that mask marks in these words: the words and bits of those within the radius."""
    skip, shift = divmod(lag, 64)
    bits = max(1, radius.bit_length())
    bias = (1 << bits) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counter = [np.full(len(words), full if bias >> k & 1 else 0, np.uint64) for k in range(bits)]
    alive = mask
    for step, b in enumerate(order):
        plane = planes[b]
        ahead = plane[words + skip]
        if shift:
            ahead = ahead >> np.uint64(shift) | plane[words + skip + 1] << np.uint64(64 - shift)
        carry = plane[words] ^ ahead
        for k in range(bits):
            counter[k], carry = counter[k] ^ carry, counter[k] & carry
        alive = alive & ~carry
        if step % 6 == 5:
            left = alive != 0
            n = int(np.count_nonzero(left))
            if n == 0:
                return words[:0], alive[:0]
            if n < 0.7 * len(words):
                words, alive, counter = words[left], alive[left], [c[left] for c in counter]
    return words, alive


def close_pairs(bucket: np.ndarray, fp: np.ndarray, order: list[int], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For fingerprints sorted by bucket: the pairs (i, j), i < j, of a bucket that are within the radius, by ascending j - i."""
    n = len(fp)
    if n < 2:
        return
    ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, n)
    ahead = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - 1 - np.arange(n)
    planes = bit_planes(fp)
    words = planes.shape[1] - 2
    padded = np.zeros(words * 64, np.int64)
    padded[:n] = ahead
    padded = padded.reshape(words, 64)
    furthest = padded.max(axis=1)
    # Planes for every lag: words + skip + 1 must exist.
    planes = np.pad(planes, ((0, 0), (0, int(furthest.max()) // 64 + 1)))
    for lag in range(1, int(furthest.max()) + 1):
        at = np.flatnonzero(furthest >= lag)
        mask = np.packbits(padded[at] >= lag, axis=1, bitorder="little").view("<u8")[:, 0]
        at, alive = close_at(planes, lag, at, mask, order, radius)
        if len(at):
            row, bit = np.nonzero(np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            i = at[row] * 64 + bit
            yield i, i + lag


def linked(bucket: np.ndarray, fp: np.ndarray, order: list[int], radius: int = RADIUS) -> np.ndarray:
    """For fingerprints sorted by bucket: a label each, equal within a bucket if a chain of pairs within the radius joins them."""
    n = len(fp)
    label = np.arange(n)
    for i, j in close_pairs(bucket, fp, order, radius):
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            parent = np.arange(n)
            np.minimum.at(parent, high, low)
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            label = parent[label]
    return label


def _pairs_within(radius: int, blocks: int):
    width = 64 // blocks
    keys = list(combinations(range(blocks), blocks - radius))

    def compare(table_no: np.ndarray, key: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        for t in np.unique(table_no).tolist():
            own = table_no == t
            bits = fp[own].view(np.uint64)
            equal = {x * width + i for x in keys[t] for i in range(width)}
            label = linked(key[own], bits, [i for i in range(64) if i not in equal], radius)
            moved = np.flatnonzero(label != np.arange(len(label)))
            a.append(rep[own][moved])
            b.append(rep[own][label[moved]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], names=["a", "b"])

    return by_bucket(4, 2, compare)


def by_bucket(width: int, key: int, work, most_bytes: int | None = None):
    """Runs `work` over batches of `width` columns sorted by their first `key` columns, CHUNK rows or `most_bytes` or so at a time, no bucket in two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)])
            size += batch.nbytes if most_bytes else batch.num_rows
            if size < (most_bytes or CHUNK):
                continue
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            # The last bucket may go on in the next batch.
            new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols[:key]]))
            cut = int(new[-1]) + 1 if len(new) else 0
            if cut:
                yield work(*(c[:cut] for c in cols))
            held, size = [[c[cut:] for c in cols]], len(cols[0]) - cut if cut and not most_bytes else 0
        if held:
            yield work(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return run


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Edges (a, b) between `rep`s of distinct fingerprints `fp` that span every group joined by distances within the radius."""
    if not 0 < radius < blocks or 64 % blocks:
        raise ValueError("blocks must divide 64 and be more than the radius")
    width = 64 // blocks
    block = [F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1)) for i in range(blocks)]
    tables = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(0).cast("bigint")
        for i in chosen:
            key = F.shiftleft(key, width).bitwiseOR(block[i])
        tables.append(F.struct(F.lit(t).alias("t"), key.alias("key")))
    rows = distinct.select("fp", "rep", F.explode(F.array(*tables)).alias("x")).select("x.t", "x.key", "fp", "rep")
    sorted_rows = rows.repartition("t", "key").sortWithinPartitions("t", "key", "fp")
    return sorted_rows.mapInArrow(_pairs_within(radius, blocks), "a bigint, b bigint")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Per row of docs: doc_id, th, fp, component_id."""
    prints = written(fingerprints(docs, id_col, text_col, words), "fingerprints", codec="none")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints", codec="none")
    joined = components(links(distinct, radius, blocks))
    of = distinct.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(of, "fp")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    return groups(docs, id_col, text_col, **how).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with the smallest id of each group, all columns kept; rows without an id stay."""
    late = groups(docs, id_col, text_col, **how).where("doc_id <> component_id")
    gone = written(late.select(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th")).distinct(), "near-gone", codec="none")
    return docs.join(gone, (docs[id_col] == gone["gone_id"]) & (text_hash(text_col) == gone["gone_th"]), "left_anti")
