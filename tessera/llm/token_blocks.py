"""Token ids in patched frame-of-reference blocks.

A file holds the ids of consecutive documents in blocks of 128. Of each block the minimum is
subtracted and the rest packed at the width that its 90th percentile needs; values that do
not fit stand in the block's exception list. Layout, little-endian:

    "PFOR2\\0\\0\\0" | n_docs u64 | n_ids u64 | n_blocks u64
    doc_id i64 [n_docs] | whether the id is null u8 [n_docs] | n_tokens u64 [n_docs]
    block start in the body u64 [n_blocks] | minimum u32 [n_blocks] | width u8 [n_blocks] | exceptions u8 [n_blocks]
    body: per block 16 * width bytes of packed bits, then exception places u8, then exception values u32

A file is the `body` of a row in a table that Spark's writer commits, so executors need no
file system of their own and a lost task leaves nothing behind.

Defined cases: null and empty texts have the end id alone; a null id sorts first; rows that
repeat an id follow each other, ordered by their texts' hash; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column_bytes, slices, written

BLOCK = 128
MAGIC = b"PFOR2\0\0\0"
#: Share of a block's values that fit its width.
FIT = 0.9
#: Ids in a file, give or take a document.
FILE_IDS = 1 << 20


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(block starts, minima, widths, exception counts, body)."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint8), np.zeros(0, np.uint8), b""
    grid = np.empty(blocks * BLOCK, np.uint32)
    grid[:n] = ids
    grid[n:] = ids[-1]
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1)
    grid = grid - low[:, None]
    rank = int(np.ceil(FIT * BLOCK)) - 1
    width = np.ceil(np.log2(np.partition(grid, rank, axis=1)[:, rank].astype(np.float64) + 1)).astype(np.uint8)
    odd = grid >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    n_odd = odd.sum(axis=1).astype(np.int64)
    sizes = 16 * width.astype(np.int64) + 5 * n_odd
    ends = np.cumsum(sizes)
    starts = ends - sizes
    body = np.zeros(int(ends[-1]), np.uint8)
    row, place = np.nonzero(odd)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        at = starts[row] + 16 * width[row].astype(np.int64)
        body[at + nth] = place
        at += n_odd[row] + 4 * nth
        body[at[:, None] + np.arange(4)] = grid[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        grid[row, place] = 0
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        for some in np.array_split(rows, -(-len(rows) // 4096)):
            bits = (grid[some][:, :, None] >> np.arange(w, dtype=np.uint32)).astype(np.uint8) & 1
            packed = np.packbits(bits.reshape(len(some), BLOCK * w), axis=1, bitorder="little")
            body[starts[some][:, None] + np.arange(16 * w)] = packed
    return starts.astype(np.uint64), low, width, n_odd.astype(np.uint8), body.tobytes()


def unpack(starts, low, width, n_odd, body: bytes, n: int) -> np.ndarray:
    """The first n ids of these blocks."""
    raw = np.frombuffer(body, np.uint8)
    starts, n_odd = starts.astype(np.int64), n_odd.astype(np.int64)
    grid = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        for some in np.array_split(rows, -(-len(rows) // 4096)):
            packed = raw[starts[some][:, None] + np.arange(16 * w)]
            bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(some), BLOCK, w)
            whole = np.zeros((len(some), BLOCK), np.uint32)
            for b in range(w):
                whole |= bits[:, :, b].astype(np.uint32) << np.uint32(b)
            grid[some] = whole
    row = np.repeat(np.arange(len(starts)), n_odd)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        at = starts[row] + 16 * width[row].astype(np.int64)
        place = raw[at + nth]
        at += n_odd[row] + 4 * nth
        grid[row, place] = raw[at[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
    grid += low[:, None]
    return grid.reshape(-1)[:n]


def dump(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    starts, low, width, n_odd, body = pack(ids)
    head = np.array([len(doc_ids), len(ids), len(starts)], "<u8").tobytes()
    docs = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes() + np.array(counts, "<u8").tobytes()
    return b"".join([MAGIC, head, docs, starts.astype("<u8").tobytes(), low.astype("<u4").tobytes(), width.tobytes(), n_odd.tobytes(), body])


class Reader:
    """A file's documents and ids; `ids(start, count)` touches the blocks it needs only."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token block file")
        n_docs, self.n_ids, n_blocks = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
        at = 32
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        self.null = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        self.counts = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        at += 17 * n_docs
        self.starts = np.frombuffer(data, "<u8", n_blocks, at)
        self.low = np.frombuffer(data, "<u4", n_blocks, at + 8 * n_blocks)
        self.width = np.frombuffer(data, np.uint8, n_blocks, at + 12 * n_blocks)
        self.n_odd = np.frombuffer(data, np.uint8, n_blocks, at + 13 * n_blocks)
        self.body = memoryview(data)[at + 14 * n_blocks :]

    def ids(self, start: int = 0, count: int | None = None) -> np.ndarray:
        count = self.n_ids - start if count is None else count
        if count <= 0:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, -(-(start + count) // BLOCK)
        whole = unpack(self.starts[a:b], self.low[a:b], self.width[a:b], self.n_odd[a:b], self.body, (b - a) * BLOCK)
        return whole[start - a * BLOCK :][:count]


_MARK = rb"[!-&(-/:-@\[-`{-~]"
#: Marks behind a letter or digit and before white space; apostrophes stay, as the splitter has contractions. It begins
#: with the mark itself, which the matcher finds much faster than what stands before.
_TRAILING = re.compile(rb"(" + _MARK + rb"(?<=[A-Za-z0-9]" + _MARK + rb")" + _MARK + rb"*)(?=[ \t-\r]|\Z)")


class Words:
    """Ids of a text by the tokenizers library, remembered for each run between ASCII white space.

    The vocabulary's normaliser and splitter treat white space as a separator only, so the
    ids of a text are those of its runs in order; marks that end a run behind a letter or
    digit are a run of their own, as the splitter parts them there too.
    """

    def __init__(self, path: str, memory: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: The same for lower-case ASCII letters, which the normaliser and the splitter leave as they are.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer, self.plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        #: A text that has one of these, in any case of ASCII, is encoded whole by the library.
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = self.tokenizer.model.end_of_word_suffix or ""
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for piece, i in vocabulary.items() if suffix and piece.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        #: Runs known before the last turnover; those still in use come back from here.
        self.older: dict[bytes, bytes] = {}
        self.memory = memory

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers; a run is looked up once for all of them."""
        # The normaliser lower-cases everything; doing so for ASCII first makes fewer runs differ.
        lower = [x.lower() for x in texts]
        whole = [i for i, x in enumerate(lower) if any(y in x for y in self.added)]
        for i in whole:
            lower[i] = b""
        parts = pc.ascii_split_whitespace(pa.array([_TRAILING.sub(rb" \1", x) for x in lower], pa.large_string()))
        # White space at an end leaves an empty run, which has no ids.
        coded = parts.flatten().cast(pa.large_binary()).dictionary_encode()
        runs, places = self._found(coded.dictionary.to_pylist()), coded.indices.to_numpy()
        sizes = np.fromiter(map(len, runs), np.int64, len(runs)) // 4
        counts = sizes[places]
        ends = np.concatenate([[0], np.cumsum(counts)])
        # Where in the runs' ids each id of the texts stands.
        at = np.repeat((np.cumsum(sizes) - sizes)[places] - ends[:-1], counts) + np.arange(ends[-1])
        raw = np.frombuffer(b"".join(runs), "<u4")[at].tobytes()
        bounds = (4 * ends[parts.offsets.to_numpy()]).tolist()
        out = [raw[a:b] for a, b in pairwise(bounds)]
        for i in whole:
            own = self._ids([texts[i].decode()])[0]
            out[i] = struct.pack(f"<{len(own)}I", *own)
        return out

    def _found(self, runs: list[bytes]) -> list[bytes]:
        """The ids of different runs."""
        found = list(map(self.known.get, runs))
        gaps = [i for i, x in enumerate(found) if x is None]
        if len(self.known) + len(gaps) > self.memory:
            self.older, self.known = self.known, {}
        known, older, new = self.known, self.older, []
        for i in gaps:
            own = older.get(runs[i])
            if own is None:
                new.append(runs[i])
            else:
                known[runs[i]] = own
        for a in range(0, len(new), 4096):
            self._learn(new[a : a + 4096])
        for i in gaps:
            found[i] = known[runs[i]]
        return found

    def _learn(self, new: list[bytes]) -> None:
        letters = [x for x in new if x.isalpha()]
        other = [x for x in new if not x.isalpha()]
        wide = [x for x in other if x.decode().isalpha()]
        # Runs of letters are one word each: encoded as one text and cut where words end.
        cut = self._cut(self.plain, letters) and self._cut(self.tokenizer, wide)
        rest = [x for x in other if x not in self.known] if cut else new
        for x, own in zip(rest, self._ids([x.decode() for x in rest]), strict=True):
            self.known[x] = struct.pack(f"<{len(own)}I", *own)

    def _cut(self, tokenizer, runs: list[bytes]) -> bool:
        """Whether the text of these runs has as many words; their ids are then known."""
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(runs).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(runs):
            raw, bounds = ids.tobytes(), (4 * ends).tolist()
            self.known.update(zip(runs, map(raw.__getitem__, map(slice, [0, *bounds], bounds))))
        return len(ends) == len(runs)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=1)
def worker_words(path: str) -> Words:
    """The words that this worker process knows, kept from task to task."""
    return Words(path)


def _to_files(path: str, end_id: int, id_col: str, text_col: str, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, task, part = worker_words(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        docs: list = []
        counts: list[int] = []
        held: list[bytes] = []
        size = 0

        def flush():
            body = dump(docs, counts, np.frombuffer(b"".join(held), "<u4"))
            return pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([part], pa.int32()), pa.array([len(docs)], pa.int64()), pa.array([size], pa.int64()), pa.array([body], pa.binary())],
                names=["task", "part", "n_docs", "n_ids", "body"],
            )

        for table in slices(batches, text_col):
            for doc, ids in zip(table.column(id_col).to_pylist(), words.encode_all(column_bytes(table, text_col)), strict=True):
                docs.append(doc)
                counts.append(len(ids) // 4 + 1)
                held += [ids, end]
                size += len(ids) // 4 + 1
                if size >= file_ids:
                    yield flush()
                    docs, counts, held, size, part = [], [], [], 0, part + 1
        if docs:
            yield flush()

    return run


def write_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """The files as rows (task, part, n_docs, n_ids, body) of a written table, in ascending id order by (task, part)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col)
    ordered = rows.repartitionByRange(id_col).sortWithinPartitions(F.col(id_col).asc_nulls_first(), F.xxhash64(text_col))
    files = ordered.mapInArrow(_to_files(tokenizer_path, end_id, id_col, text_col, file_ids), "task int, part int, n_docs bigint, n_ids bigint, body binary")
    return written(files, "token-files", codec="none")


def _from_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for task, part, body in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("task", "part", "body")), strict=True):
            file = Reader(body.as_py())
            raw = file.ids().astype("<u4").tobytes()
            ends = np.cumsum(file.counts)
            starts = ends - file.counts
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(crc)
            yield pa.RecordBatch.from_arrays(
                [pa.array([task.as_py()] * n, pa.int32()), pa.array([part.as_py()] * n, pa.int32()), pa.array(file.doc_ids, pa.int64(), mask=file.null), pa.array(starts, pa.int64()), pa.array(file.counts, pa.int64()), pa.array(crc, pa.int64())],
                names=["task", "part", "doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_files(files: DataFrame) -> DataFrame:
    """Per document, from the files' bytes: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    docs = files.select("task", "part", "body").mapInArrow(_from_files, "task int, part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    # What stands before a file within its task, and before its task: the one unpartitioned window sees a row a task.
    sizes = files.groupBy("task").agg(F.sum("n_ids").alias("n"))
    tasks = sizes.select("task", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    before = Window.partitionBy("task").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = files.select("task", "part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("own"))
    offsets = within.join(tasks, "task").select("task", "part", (F.col("own") + F.col("base")).alias("offset"))
    return docs.join(offsets, ["task", "part"]).select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
