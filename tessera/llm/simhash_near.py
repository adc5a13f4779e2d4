"""SimHash near-dedup for texts that differ by more than op8's 2 bits: five-word shingles, Jaccard similarity of 0.8 or more.

At that similarity the fingerprints of two texts differ in about 10 bits of 64, too many for blocks of
their bits. So texts meet by the shingles that vote in their fingerprints: two sets of similarity s or more share one of the
n - ceil(s n) + 1 first shingles of each, in any order of all shingles (pigeonhole). The order puts shingles that are frequent
in a bounded sample last, which changes the work and not the result: a passage that very many texts have
is hardly ever among the first. Where texts meet, their fingerprints are compared bit-sliced (see `simhash`)
within a radius of 18 bits, three standard deviations beyond the bound's 10, and those that are close have their shingles compared.

Each text is first compared with one leader: of the smallest texts of its parts the one it shares
most with; then texts that meet others of another group with a few leaders drawn anew. Only pairs that are still in
different groups are then compared bit-sliced. Of those no pair leaves its task: a first pass gives out the texts that have one
that may be similar, a second gets these with their whole text, compares the shingles and gives out no more links than join the
groups of a key. So rows grow with the texts that share a key and not with their pairs, and no link is lost.

Defined cases: null and empty texts, and texts of white space, have one empty shingle; fewer than
five words are one shingle; ASCII case is ignored; rows without an id link others and stay; rows
that repeat an id stay or go together with their group each; an empty table gives no rows;
other columns are kept, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, column_bytes, free_name, scratch, slices, written
from .components import components
from .simhash import by_bucket, close_pairs, hashes, majority, shingles, text_hash

WORDS = 5
SIMILARITY = 0.8
RADIUS = 18
#: Texts whose shingles are counted for the order, about; and the count from which one is frequent.
SAMPLE_DOCS = 10_000
FREQUENT = 5

#: Turns in which texts still apart meet leaders drawn anew (each moves texts once more), and how many each; they save work and change no result.
LEADERS = 3
NEAREST = 2
#: Of a text's first shingles so many go with it to where pairs are found.
HEAD = 32
#: Bits of a text, each the parity of those shingles whose hash names it.
PARITY = 512


def distinct_shingles(text: bytes, words: int = WORDS) -> set[bytes]:
    return set(shingles(text, words)) or {b""}


def _sampled(text_col: str, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches, text_col):
            for text in column_bytes(table, text_col):
                yield pa.RecordBatch.from_arrays([pa.array(hashes(list(distinct_shingles(text, words))).view(np.int64))], names=["h"])

    return run


def frequent(docs: DataFrame, text_col: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in ascending order, and counts, of the shingles that are frequent in a sample of about SAMPLE_DOCS texts."""
    scale = 1 << 30
    most = min(scale, scale * SAMPLE_DOCS // max(1, docs.count()))
    sample = docs.where(F.pmod(text_hash(text_col), F.lit(scale)) < most).select(text_col)
    found = sample.mapInArrow(_sampled(text_col, words), "h bigint").groupBy("h").count().where(F.col("count") >= FREQUENT).toPandas().sort_values("h")
    return found["h"].to_numpy(np.int64), found["count"].to_numpy(np.int64)


def first_shingles(own: np.ndarray, known: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """Codes of those distinct hashes of which a text at least so similar has one, too. A code is the count in 15 bits and 48 bits of the hash, and the order is that of the codes."""
    h = own.view(np.int64)
    many = np.zeros(len(h), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        many = np.where(known[at] == h, np.minimum(counts[at], (1 << 15) - 1), 0)
    codes = np.sort(many << 48 | (own >> np.uint64(16)).view(np.int64))
    return codes[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1]


def parity(own: np.ndarray) -> bytes:
    """PARITY bits. What two texts share cancels out, so they differ in no more bits than there are shingles that only one has."""
    return np.packbits(np.bincount((own % np.uint64(PARITY)).astype(np.int64), minlength=PARITY).astype(np.uint8) & 1).tobytes()


def _printed(shared, id_col: str, text_col: str, words: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in slices(batches, text_col):
            prints, sizes, parities, keys = [], [], [], []
            for text in column_bytes(table, text_col):
                own = hashes(list(distinct_shingles(text, words)))
                sizes.append(len(own))
                prints.append(majority(own))
                parities.append(parity(own))
                keys.append(first_shingles(own, *shared.value, similarity))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))
            fp = pa.array(np.array(prints, np.uint64).view(np.int64))
            columns = [table.column(id_col).combine_chunks(), table.column("th").combine_chunks(), fp, pa.array(sizes, pa.int64()), pa.array(parities, pa.binary()), lists]
            whole = pc.fill_null(table.column(text_col).combine_chunks(), "").cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, whole], names=["doc_id", "th", "fp", "size", "parity", "keys", "tx"])

    return run


def ranked(heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For `possible`: codes as their places in the order of all codes here, which take half the room, and each row's last."""
    filled = heads != np.iinfo(np.int64).max
    places = np.unique(heads, return_inverse=True)[1].reshape(heads.shape).astype(np.int32)
    return places, np.where(filled, places, -1).max(axis=1)


def possible(heads: np.ndarray, last: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether texts i and j can be so similar by the shingles that come first in each.

    heads, last: `ranked` first codes in order, filled up with the largest integer. A code of one text that is below the last
    known code of the other and not among the other's is not in the other at all.
    """
    out = np.zeros(len(i), bool)
    for a in range(0, len(i), 4096):
        x, y = heads[i[a : a + 4096]], heads[j[a : a + 4096]]
        nx, ny = sizes[i[a : a + 4096]], sizes[j[a : a + 4096]]
        same = x[:, :, None] == y[:, None, :]
        lack_x = ((x < last[j[a : a + 4096], None]) & ~same.any(axis=2)).sum(axis=1)
        lack_y = ((y < last[i[a : a + 4096], None]) & ~same.any(axis=1)).sum(axis=1)
        shared = np.minimum(nx - lack_x, ny - lack_y)
        out[a : a + 4096] = shared >= (nx + ny) * (similarity / (1 + similarity)) - 1e-9
    return out


def first_met(heads: np.ndarray, key: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether texts i and j, in one bucket, share none of their first codes below its key; else they have met where that code is the key."""
    out = np.ones(len(i), bool)
    for a in range(0, len(i), 4096):
        x, y = heads[i[a : a + 4096]], heads[j[a : a + 4096]]
        out[a : a + 4096] = ~((x[:, :, None] == y[:, None, :]).any(axis=2) & (x < key[i[a : a + 4096], None])).any(axis=1)
    return out


def _words(parities: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(parities), np.uint64).reshape(len(parities), PARITY // 64)


def few_differ(parities: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Whether texts i and j can be so similar by the shingles that only one has: at least as many as parity bits that differ, and as their sizes do."""
    out = np.zeros(len(i), bool)
    for a in range(0, len(i), 1 << 16):
        x, y = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
        least = np.maximum(np.bitwise_count(parities[x] ^ parities[y]).sum(axis=1, dtype=np.int64), np.abs(sizes[x] - sizes[y]))
        out[a : a + (1 << 16)] = least <= (sizes[x] + sizes[y]) * ((1 - similarity) / (1 + similarity)) + 1e-9
    return out


def _apart(radius: int, similarity: float):
    """Of a bucket, sorted by key and group, the texts that may be similar to one of another group: within the radius and possible."""

    def work(key: np.ndarray, group: np.ndarray, fp: np.ndarray, nid: np.ndarray, size: np.ndarray, parities: np.ndarray, head: np.ndarray) -> pa.RecordBatch:
        heads = np.full((len(key), HEAD), np.iinfo(np.int64).max)
        for row, own in zip(heads, head, strict=True):
            row[: len(own)] = own
        places, last = ranked(heads)
        bits, found = _words(parities), np.zeros(len(key), bool)
        for i, j in close_pairs(key, fp.view(np.uint64), list(range(64)), radius):
            for wanted in (
                lambda i, j: group[i] != group[j],
                lambda i, j: few_differ(bits, size, i, j, similarity),
                lambda i, j: ~(found[i] & found[j]),
                lambda i, j: possible(places, last, size, i, j, similarity),
                lambda i, j: first_met(heads, key, i, j),
            ):
                kept = wanted(i, j)
                i, j = i[kept], j[kept]
            found[i] = found[j] = True
        return pa.RecordBatch.from_arrays([pa.array(x[found]) for x in (key, group, fp, nid, size)] + [pa.array(parities[found], pa.binary())], names=["key", "g", "fp", "nid", "size", "parity"])

    return work


def _joined(words: int, radius: int, similarity: float):
    """Of a bucket, sorted by key and group, links that join all groups that a similar pair joins, none twice."""

    def work(key: np.ndarray, group: np.ndarray, fp: np.ndarray, nid: np.ndarray, size: np.ndarray, parities: np.ndarray, text: np.ndarray) -> pa.RecordBatch:
        ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
        links: list[tuple[int, int]] = []
        for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
            own: dict[int, np.ndarray] = {}

            def hashed(i: int) -> np.ndarray:
                if i not in own:
                    own[i] = np.unique(hashes(list(distinct_shingles(texts[i].encode(), words))))
                return own[i]

            label, sizes, texts, bits = group[a:b].copy(), size[a:b], text[a:b], _words(parities[a:b])
            for i, j in close_pairs(key[a:b], fp[a:b].view(np.uint64), list(range(64)), radius):
                differ = label[i] != label[j]
                i, j = i[differ], j[differ]
                fits = few_differ(bits, sizes, i, j, similarity)
                for x, y in zip(i[fits].tolist(), j[fits].tolist(), strict=True):
                    if label[x] == label[y]:
                        continue
                    least, p, q = (sizes[x] + sizes[y]) * (similarity / (1 + similarity)) - 1e-9, hashed(x), hashed(y)
                    # Where no two shingles of a text have one hash, hashes in common are shingles in common or more.
                    if len(p) == sizes[x] and len(q) == sizes[y] and len(np.intersect1d(p, q, assume_unique=True)) < least:
                        continue
                    if len(distinct_shingles(texts[x].encode(), words) & distinct_shingles(texts[y].encode(), words)) >= least:
                        links.append((nid[a + x], nid[a + y]))
                        label[label == label[y]] = label[x]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return work


def _verify(words: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for table in slices(batches, "tb"):
            links: list[tuple[int, int]] = []
            for a, b, x, y in zip(table.column("a").to_pylist(), table.column("b").to_pylist(), column_bytes(table, "ta"), column_bytes(table, "tb"), strict=True):
                if a != last:
                    last, own = a, distinct_shingles(x, words)
                other = distinct_shingles(y, words)
                common = len(own & other)
                if common >= similarity * (len(own) + len(other) - common) - 1e-9:
                    links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Per row of docs that some link joins: doc_id, th (hash of the text), component_id (smallest id of its group)."""
    with scratch():
        rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col, text_hash(text_col).alias("th"))
        order = docs.sparkSession.sparkContext.broadcast(frequent(docs, text_col, words))
        prints = rows.mapInArrow(_printed(order, id_col, text_col, words, similarity), "doc_id bigint, th bigint, fp bigint, size bigint, parity binary, keys array<bigint>, tx string")
        # The texts lie beside their fingerprints, so that only those of pairs that may be similar move.
        prints = written(prints.withColumn("nid", F.monotonically_increasing_id()), "near-prints")
        keyed = prints.select(F.explode("keys").alias("key"), "nid")
        met = keyed.selectExpr("key", "nid", "count(*) OVER (PARTITION BY key) AS n", "min(nid) OVER (PARTITION BY key) AS lead").where("n > 1")
        shared = written(met.select("key", "nid", "lead"), "near-keys", codec="none")
        fa, fb = (prints.select(F.col("nid").alias(x), F.col("fp").alias(f"f{x}"), F.col("size").alias(f"n{x}")) for x in "ab")

        def similar(pairs: DataFrame, name: str) -> DataFrame:
            may = (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= radius) & (F.abs(F.col("na") - F.col("nb")) <= (F.col("na") + F.col("nb")) * ((1 - similarity) / (1 + similarity)) + 1e-9)
            close = written(pairs.join(fb, "b").join(fa, "a").where(may).select("a", "b"), "near-pairs", codec="none")
            needed = prints.select("nid", "tx").join(close.select(F.explode(F.array("a", "b")).alias("nid")).distinct(), "nid", "left_semi")
            ta, tb = (needed.select(F.col("nid").alias(x), F.col("tx").alias(f"t{x}")) for x in "ab")
            both = close.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")
            return written(both.mapInArrow(_verify(words, similarity), "a bigint, b bigint"), name, codec="none")

        tried = shared.where("nid <> lead").groupBy("nid", "lead").count()
        best = tried.groupBy("nid").agg(F.max_by("lead", F.struct("count", -F.col("lead"))).alias("a")).select("a", F.col("nid").alias("b"))
        links = similar(best, "near-links")
        for turn in range(1, LEADERS + 2):
            of = prints.select("nid", "fp").join(components(links).withColumnRenamed("node", "nid"), "nid", "left")
            of = shared.select("key", "nid").join(of, "nid").select("key", F.coalesce("component", "nid").alias("g"), "fp", "nid")
            # Keys whose texts all lie in one group have nothing left to compare.
            mixed = of.selectExpr("*", "min(g) OVER (PARTITION BY key) AS low", "max(g) OVER (PARTITION BY key) AS high").where("low <> high").select("key", "g", "fp", "nid")
            mixed = written(mixed, "near-mixed", codec="none")
            if turn <= LEADERS:
                lead = mixed.groupBy("key").agg(F.min_by(F.struct("nid", "g", "fp"), F.xxhash64(F.lit(turn), F.col("nid"))).alias("lead"))
                met = mixed.join(lead, "key").where(F.col("g") != F.col("lead.g"))
                met = met.select(F.col("nid").alias("b"), F.col("lead.nid").alias("a"), F.bit_count(F.col("fp").bitwiseXOR(F.col("lead.fp"))).alias("bits")).where(F.col("bits") <= radius).distinct()
                # Of a text's leaders the nearest few, so that a turn costs in proportion to the texts.
                pairs = met.groupBy("b").agg(F.slice(F.array_sort(F.collect_list(F.struct("bits", "a"))), 1, NEAREST).alias("x")).select(F.explode("x.a").alias("a"), "b")
                more = similar(pairs, "near-more-links")
            else:
                heads = prints.select("nid", "size", "parity", F.slice("keys", 1, HEAD).alias("head"))
                apart = mixed.join(heads, "nid").select("key", "g", "fp", "nid", "size", "parity", "head").repartition("key").sortWithinPartitions("key", "g")
                apart = apart.mapInArrow(by_bucket(7, 1, _apart(radius, similarity)), "key bigint, g bigint, fp bigint, nid bigint, size bigint, parity binary")
                whole = written(apart, "near-apart", codec="none").join(prints.select("nid", "tx"), "nid")
                whole = whole.select("key", "g", "fp", "nid", "size", "parity", "tx").repartition("key").sortWithinPartitions("key", "g")
                more = written(whole.mapInArrow(by_bucket(7, 1, _joined(words, radius, similarity), 2 * SLICE_BYTES), "a bigint, b bigint"), "near-last-links", codec="none")
            links = links.unionByName(more)
        of = prints.select("nid", "doc_id", "th").join(components(links).withColumnRenamed("node", "nid"), "nid").select("doc_id", "th", "component")
        least = of.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        return written(of.join(least, "component").select("doc_id", "th", "component_id"), "near-groups", codec="none", keep=True)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with the smallest id of each group, all columns kept; rows without an id stay."""
    gid, gth = (free_name(x, docs.columns) for x in ("gone_id", "gone_th"))
    gone = groups(docs, id_col, text_col, **how).where("doc_id <> component_id").select(F.col("doc_id").alias(gid), F.col("th").alias(gth)).distinct()
    return docs.join(gone, (docs[id_col].cast("bigint") == gone[gid]) & (text_hash(text_col) == gone[gth]), "left_anti")
