"""String similarities from their public definitions; used inside Arrow UDFs.

ratio: 2 LCS / (len a + len b). token_sort: ratio of sorted words. token_set: best ratio among
the shared words and the shared words with each side's rest; 1 if a side has nothing of its own.
partial: best ratio of the shorter string against equally long windows of the longer. All are
0 if a side is empty.
"""

from __future__ import annotations


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and not (only_x and only_y):
        return 1.0
    base = " ".join(both)
    left, right = " ".join(both + only_x), " ".join(both + only_y)
    return max(ratio(left, right), ratio(base, left), ratio(base, right))


def partial(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    best = 0.0
    # Windows that hang over either end are shorter than the short string.
    for i in range(1 - n, len(long)):
        best = max(best, ratio(short, long[max(0, i) : i + n]))
        if best == 1.0:
            break
    return best


def jaro(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    matched = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                matched.append(c)
                break
    m = len(matched)
    if not m:
        return 0.0
    other = [c for j, c in enumerate(b) if taken[j]]
    swaps = sum(x != y for x, y in zip(matched, other, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Boosted by up to four common leading characters where Jaro is above 0.7."""
    base = jaro(a, b)
    if base <= 0.7:
        return base
    same = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        same += 1
    return base + 0.1 * same * (1 - base)


def alignment(a: list[str], b: list[str]) -> tuple[float, float]:
    """(best ratio of any two words, least of the best ratios of a's words)."""
    if not a or not b:
        return 0.0, 0.0
    best = [max(ratio(x, y) for y in b) for x in a]
    return max(best), min(best)
