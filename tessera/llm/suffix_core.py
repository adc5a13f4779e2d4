"""Anchored suffixes of texts: polynomial prefix hashes, anchors, hash-compared suffix sort.

Any two equal 100-byte strings choose the same anchor: the leftmost position among their
starts of 24-byte grams whose gram hash is least. So only anchors and what stands around them
need to meet: the string at offset j before an anchor a is T[a-j : a-j+100].
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

LENGTH = 100
GRAM = 24
CHUNK = 1 << 18

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1 << 40, 1 << 60)) * 8 + 5
_UNDO = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_FORTH, _BACK = _powers(_BASE, 1 << 12), _powers(_UNDO, 1 << 12)


def _extend(n: int) -> None:
    global _FORTH, _BACK
    if len(_FORTH) < n:
        n = 1 << (n - 1).bit_length()
        _FORTH, _BACK = _powers(_BASE, n), _powers(_UNDO, n)


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """H with H[b] - H[a], times base**-a, the hash of raw[a:b], modulo 2**64."""
    _extend(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _FORTH[: len(raw)], out=out[1:])
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(32)
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ x >> np.uint64(29)


def anchors(raw: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end (doc_starts, with the end last): gram hash, both halves of the context's digest, anchor, first and last string start.

    The context is what the anchor's strings cover; its digest (BLAKE2b, 128 bits) also holds where in it the anchor is.
    """
    n = len(raw)
    starts = n - LENGTH + 1
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if starts <= 0:
        return none
    hashes = prefix_hashes(raw)
    grams = (hashes[GRAM:] - hashes[:-GRAM]) * _BACK[: n - GRAM + 1]
    least = mixed(grams) & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    span, have = LENGTH - GRAM + 1, 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: len(least) - (span - have)], least[span - have :])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Strings that cross the end of a text don't count.
    valid = np.ones(starts, bool)
    for end in doc_starts[1:-1]:
        valid[max(0, end - LENGTH + 1) : end] = False
    kept = np.flatnonzero(valid)
    if not len(kept):
        return none
    anchor = anchor[kept]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (kept[1:] != kept[:-1] + 1)]))
    a = anchor[new]
    first, last = kept[new], kept[np.concatenate([new[1:] - 1, [len(kept) - 1]])]
    whole = raw.tobytes()
    own = zip(first.tolist(), (last + LENGTH).tolist(), (a - first).tolist(), strict=True)
    digests = b"".join([blake2b(whole[i:j], digest_size=16, salt=b"%d" % back).digest() for i, j, back in own])
    context = np.frombuffer(digests, "<u8").reshape(-1, 2)
    return grams[a], context[:, 0].copy(), context[:, 1].copy(), a, first, last


def common_lengths(hashes: np.ndarray, raw: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Bytes in which the suffixes at x and y agree, up to `most`: binary search over prefix hashes."""
    low, high = np.zeros_like(most), most.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        mid = (low[open_] + high[open_] + 1) >> 1
        p, q = x[open_], y[open_]
        same = (hashes[p + mid] - hashes[p]) * _BACK[p] == (hashes[q + mid] - hashes[q]) * _BACK[q]
        low[open_] = np.where(same, mid, low[open_])
        high[open_] = np.where(same, high[open_], mid - 1)
    return low


def verified(raw: np.ndarray, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
    """How many of the first `length` bytes at x and y really agree."""
    out = length.copy()
    for a in range(0, len(x), 1 << 13):
        n = length[a : a + (1 << 13)]
        width = int(n.max(initial=0))
        if not width:
            continue
        step = np.arange(width)
        p = np.minimum(x[a : a + (1 << 13), None] + step, len(raw) - 1)
        q = np.minimum(y[a : a + (1 << 13), None] + step, len(raw) - 1)
        differ = (raw[p] != raw[q]) & (step < n[:, None])
        at = differ.argmax(axis=1)
        out[a : a + (1 << 13)] = np.where(differ.any(axis=1), at, n)
    return out


def suffix_sort(hashes: np.ndarray, raw: np.ndarray, group: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at `at` (each `length` bytes long) within runs of equal `group`, and how many bytes each shares with the one before.

    Bottom-up mergesort of all groups at once; two suffixes are compared by the byte behind
    their common extension. What neighbours share is verified byte by byte: if a hash collision
    is found, that group is sorted again by its bytes.
    """
    n = len(at)
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, n)
    begin = np.repeat(np.concatenate([[0], ends[:-1]]), np.diff(np.concatenate([[0], ends])))
    finish = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    order = np.arange(n)

    def before(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i comes before suffix j; -1, 0 or 1."""
        shared = common_lengths(hashes, raw, at[i], at[j], np.minimum(length[i], length[j]))
        ci = np.where(shared < length[i], raw[np.minimum(at[i] + shared, len(raw) - 1)].astype(np.int64), -1)
        cj = np.where(shared < length[j], raw[np.minimum(at[j] + shared, len(raw) - 1)].astype(np.int64), -1)
        return np.sign(ci - cj)

    size = 1
    place = np.arange(n)
    longest = int(np.diff(np.concatenate([[0], ends])).max(initial=1))
    while size < longest:
        run = begin + (place - begin) // (2 * size) * (2 * size)
        middle = np.minimum(run + size, finish)
        end = np.minimum(run + 2 * size, finish)
        moving = np.flatnonzero(middle < end)
        # Each element's rank in the other run, by binary search; ties keep the left run first.
        left = moving < middle[moving]
        low = np.where(left, middle[moving], run[moving])
        high = np.where(left, end[moving], middle[moving])
        base = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            sign = before(order[mid], order[moving[open_]])
            less = np.where(left[open_], sign < 0, sign <= 0)
            low[open_] = np.where(less, mid + 1, low[open_])
            high[open_] = np.where(less, high[open_], mid)
        own = np.where(left, moving - run[moving], moving - middle[moving])
        merged = order.copy()
        merged[run[moving] + own + low - base] = order[moving]
        order = merged
        size *= 2
    shared = np.zeros(n, np.int64)
    if n > 1:
        same = np.flatnonzero(group[1:] == group[:-1]) + 1
        x, y = order[same - 1], order[same]
        claimed = common_lengths(hashes, raw, at[x], at[y], np.minimum(length[x], length[y]))
        real = verified(raw, at[x], at[y], claimed)
        shared[same] = real
        for g in np.unique(begin[same[real != claimed]]):
            rows = np.sort(order[g : finish[g]])
            texts = {int(r): raw[at[r] : at[r] + length[r]].tobytes() for r in rows}
            own = sorted(texts, key=lambda r: texts[r])
            order[g : finish[g]] = own
            for k in range(1, len(own)):
                p, q = texts[own[k - 1]], texts[own[k]]
                m = min(len(p), len(q))
                differ = np.flatnonzero(np.frombuffer(p[:m], np.uint8) != np.frombuffer(q[:m], np.uint8))
                shared[g + k] = int(differ[0]) if len(differ) else m
    return order, shared
