"""Byte-level BPE through a sentencepiece model written straight from a rank file.

Every vocabulary entry becomes a piece: its bytes are mapped one to one onto characters
U+0100..U+01FF and it is scored by its negative rank, so the best-scored merge is the lowest
rank. The normaliser is the identity. The text is split by the pattern first and each
pre-token is encoded by itself; a pre-token that is itself an entry is that entry, as in
the rank-file library. Decoding maps ids back to pieces and pieces back to bytes.

Defined cases: null and empty texts have no tokens; a null id is carried; repeated rows are
encoded each by itself; other columns are ignored by `digests` and kept by `encode`.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column_text, slices

#: Pre-tokens whose ids a worker remembers.
MEMORY = 500_000
_SHIFT = {b: chr(0x100 + b) for b in range(256)}
_BACK = {0x100 + b: chr(b) for b in range(256)}
_LATER = regex.compile(r"[^\x00-ɏ]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes length-delimited, int as varint, float as fixed 32 bits."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def to_chars(piece: bytes) -> str:
    return piece.decode("latin-1").translate(_SHIFT)


def to_bytes(piece: str) -> bytes:
    return piece.translate(_BACK).encode("latin-1")


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model: piece id = rank, the unknown piece after the last rank."""
    by_rank = sorted(ranks.items(), key=lambda kv: kv[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    normal, unknown, bpe = 1, 2, 2
    model = bytearray()
    for piece, rank in by_rank:
        model += _field(1, _field(1, to_chars(piece).encode()) + _field(2, -float(rank)) + _field(3, normal))
    model += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    model += _field(2, _field(3, bpe) + _field(4, len(by_rank) + 1) + _field(40, len(by_rank)))
    model += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(model)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import sentencepiece

        self.ranks, self.split = ranks, regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self.pieces = [to_bytes(self.model.id_to_piece(i)) for i in range(len(ranks))]
        self.known: dict[str, bytes] = {}
        self.masked = None

    def pre_tokens(self, text: str) -> list[str]:
        if _LATER.search(text) is None:
            return self.split.findall(text)
        if self.masked is None:
            self.masked = newer_letters()
        if self.masked is False or self.masked.search(text) is None:
            return self.split.findall(text)
        # Letters that the rank-file library's Unicode tables do not have yet are symbols to it.
        same_length = self.masked.sub("¤", text)
        return [text[m.start() : m.end()] for m in self.split.finditer(same_length)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts, known = self.pre_tokens(text), self.known
        new = list(set(parts).difference(known))
        if new:
            if len(known) + len(new) > MEMORY:
                known.clear()
                new = list(set(parts))
            hard = []
            for p in new:
                raw = p.encode()
                rank = self.ranks.get(raw)
                if rank is None:
                    hard.append((p, to_chars(raw)))
                else:
                    known[p] = struct.pack("<I", rank)
            for (p, _), ids in zip(hard, self.model.encode([c for _, c in hard], num_threads=1), strict=True):
                known[p] = struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(known.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=1)
def worker_codec(ranks_path: str, pattern: str) -> Codec:
    """The codec of this worker process, kept from task to task."""
    return Codec(read_ranks(ranks_path), pattern)


def newer_letters():
    """A pattern of what `regex` calls a letter or number and tiktoken doesn't; False if there is nothing."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    late: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        late |= set(regex.findall(kind, every)) - set(probe.decode_bytes(probe.encode_ordinary(every)).decode())
    return regex.compile("[" + "".join(map(regex.escape, sorted(late))) + "]") if late else False


def _digest_rows(ranks_path: str, pattern: str, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(ranks_path, pattern)
        for table in slices(batches, text_col):
            counts, ids_sha, back_sha = [], [], []
            for text in column_text(table, text_col):
                ids = codec.encode(text)
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                back_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [table.column(id_col).combine_chunks(), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the text decoded from the ids)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(_digest_rows(ranks_path, pattern, id_col, text_col), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", into: str = "token_ids", checked: bool = False) -> DataFrame:
    """docs with the ids as array<int> in column `into`; if checked, also n_tokens, ids_sha256 and decoded_sha256."""
    more = ["n_tokens", "ids_sha256", "decoded_sha256"] if checked else []
    kept = [f for f in docs.schema if f.name not in {into, *more}]
    schema = T.StructType(kept + [T.StructField(into, T.ArrayType(T.IntegerType()))] + [T.StructField(x, T.LongType() if x == "n_tokens" else T.StringType()) for x in more])
    rows = docs.select(*[f.name for f in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(ranks_path, pattern)
        for table in slices(batches, text_col):
            packed = [codec.encode(x) for x in column_text(table, text_col)]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int32)
            out = table.append_column(into, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4"))))
            if checked:
                out = out.append_column("n_tokens", pa.array(np.diff(ends).astype(np.int64)))
                out = out.append_column("ids_sha256", pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()))
                out = out.append_column("decoded_sha256", pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in packed], pa.string()))
            yield from out.combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, ids_col: str = "token_ids", into: str = "decoded") -> DataFrame:
    """tokens with the decoded bytes in column `into`."""
    schema = T.StructType([f for f in tokens.schema if f.name != into] + [T.StructField(into, T.BinaryType())])
    rows = tokens.select(*[f.name for f in schema if f.name != into])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(ranks_path, pattern)
        for batch in batches:
            out = [codec.decode(np.asarray(x or [], "<u4").tobytes()) for x in batch.column(batch.schema.get_field_index(ids_col)).to_pylist()]
            yield from pa.Table.from_batches([batch]).append_column(into, pa.array(out, pa.binary())).combine_chunks().to_batches()

    return rows.mapInArrow(run, schema)
