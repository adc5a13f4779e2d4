"""op5's comparison of contexts takes memory by the lot, whatever a bucket holds."""

import tracemalloc

import numpy as np
import pytest

from tessera.llm import suffix_core, suffix_dedup
from tessera.llm.packed import dump, load

N, SIZE = 24_000, 140


def contexts(seed=3):
    """A bucket's payloads, grams and bytes: six contexts of each gram, equal but for a byte each."""
    rng = np.random.default_rng(seed)
    base = rng.integers(97, 123, (N // 6, SIZE), np.uint8)
    raw = np.repeat(base, 6, axis=0)
    at = rng.integers(0, SIZE, N)
    raw[np.arange(N), np.where((at >= 40) & (at < 64), 0, at)] = 65
    gram = np.repeat(np.arange(N // 6, dtype="<u8"), 6)
    mixed = rng.permutation(N)
    own = [gram[mixed], np.arange(N, dtype="<i8"), np.zeros(N, "<u4"), np.full(N, 40, "u1"), np.full(N, 40, "u1"), np.full(N, SIZE, "u1")]
    return {suffix_dedup.CONTEXT: [dump(own, raw[mixed].tobytes())]}, gram[mixed], raw[mixed]


def found(held):
    """Bytes in repeated ranges: (document, position)."""
    out = set()
    for batch in suffix_dedup._resolve_contexts(4)(0, held):
        for payload in batch.column(2).to_pylist():
            doc, start, end = load(payload, suffix_dedup._FLAG)[0]
            out |= {(int(d), p) for d, s, e in zip(doc, start, end, strict=True) for p in range(s, e)}
    return out


def test_contexts_take_memory_by_the_lot(monkeypatch):
    monkeypatch.setattr(suffix_core, "_FORTH", suffix_core._FORTH[: 1 << 12].copy())
    monkeypatch.setattr(suffix_core, "_BACK", suffix_core._BACK[: 1 << 12].copy())
    held, gram, raw = contexts()
    tracemalloc.start()
    try:
        got = suffix_dedup._resolve_contexts(4)(0, held)
        rows = sum(batch.num_rows for batch in got)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows
    assert peak < 60e6


@pytest.mark.parametrize("lot", [1, 7, 10**6])
def test_lots_change_no_result(monkeypatch, lot):
    monkeypatch.setattr(suffix_dedup, "LOT_CONTEXTS", lot)
    _, gram, raw = contexts()
    few = np.flatnonzero(gram < 60)
    n = len(few)
    own = [gram[few], few.astype("<i8"), np.zeros(n, "<u4"), np.full(n, 40, "u1"), np.full(n, 40, "u1"), np.full(n, SIZE, "u1")]
    seen, covered = set(), set()
    for d in few.tolist():
        for p in range(41):
            string = int(gram[d]), p, raw[d, p : p + suffix_core.LENGTH].tobytes()
            if string in seen:
                covered |= {(d, q) for q in range(p, p + suffix_core.LENGTH)}
            seen.add(string)
    assert covered
    assert found({suffix_dedup.CONTEXT: [dump(own, raw[few].tobytes())]}) == covered
