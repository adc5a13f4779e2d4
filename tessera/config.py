"""Frozen settings with the engine's defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Channel:
    """A retrieval channel: token namespaces, caps on document frequency, and what a query keeps."""

    name: str
    namespaces: tuple[str, ...]
    df_cap: int
    caps: dict[str, int]
    top_k: int
    min_score: float
    bit: int


# --- fixed values: channels, weights and shingle sizes ------------------------------------
NAME_CHANNEL = Channel("name", ("n", "k", "w", "S"), 8000, {"k": 2500, "w": 400, "S": 400}, 45, 0.03, 1)
ADDRESS_CHANNEL = Channel("addr", ("a", "d", "H", "D"), 12000, {"H": 400, "D": 400}, 40, 0.055, 2)
WEIGHTS = {"n": 1.0, "k": 0.45, "w": 1.6, "S": 1.2, "c": 0.35, "a": 0.85, "d": 1.0, "H": 1.3, "D": 1.5}


@dataclass(frozen=True)
class Blocking:
    channels: tuple[Channel, ...] = (NAME_CHANNEL, ADDRESS_CHANNEL)
    weights: dict[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    shingle: int = 6
    max_shingles: int = 16
    char_ngram: int = 4
    max_char_ngrams: int = 16
    min_df: int = 1
    max_candidates: int = 72


#: Settings compared by `operators.blocking.sweep`: (top_k, min_score) by channel and the cap on candidates.
PRESETS = {
    "fast": {"name": (15, 0.05), "addr": (15, 0.08), "cap": 24},
    "wide": {"name": (60, 0.02), "addr": (60, 0.04), "cap": 96},
    "final": {"name": (30, 0.03), "addr": (26, 0.055), "cap": 48},
    "recall": {"name": (45, 0.03), "addr": (40, 0.055), "cap": 72},
}


@dataclass(frozen=True)
class Graph:
    tau: float = 0.6
    null_logit: float = 0.0


@dataclass(frozen=True)
class Decision:
    """rule: expected_f, global_threshold, top1 or topk."""

    rule: str = "expected_f"
    beta: float = 0.5
    epsilon: float = 0.01
    max_emit: int = 25
    threshold: float = 0.5
    fixed_k: int = 3
    power: float = 1.0
    missing_mass: float = 0.0
    #: Candidates that the exact rule looks at; the rest is missing mass.
    longest: int = 64
    #: True lets missing mass above 1 through, as a probability it is not.
    unclamped_mass: bool = False


@dataclass(frozen=True)
class Mining:
    max_unmatched: int = 3
    min_count: int = 15
    min_score: float = 0.12
