"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(bias + sum w_i x_i + 1/2 sum_f [(sum v_if x_i)^2 - sum v_if^2 x_i^2]), so a
document costs time linear in its features. Words are hashed and weighted by log term
frequency, scaled to length one; structure statistics come as values and as bins; the metadata
is the stated number of characters. The machine is fitted on the driver on a bounded sample.

Defined cases: null and empty texts get a score from their statistics alone; labels that are
null, or whose id is null or has no document, are no training rows; with no labels the score
is 0.5, with one class it is that class's smoothed rate; a null id is not held out; rows that
repeat an id each get a row; of several labels of one id the largest counts; the rows to fit on are put in the order of their
ids and texts first, so the machine does not depend on partitions; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, slices
from .decontaminate import words

#: Labelled rows to fit on, on average; the only bounded part.
TRAIN_DOCS = 6000
WORD_BUCKETS = 1 << 14
FACTORS = 8
BINS = 8
THRESHOLD = 0.3
#: Statistics in [0, 1], in the order of `statistics`.
NAMES = ("upper", "digit", "bang", "pipe", "symbol", "other_mark", "beyond_ascii", "line_end", "space", "repeat_next", "top_word", "distinct", "line_repeat", "word_length", "length", "words", "stated_length")
WIDTH = WORD_BUCKETS + len(NAMES) * (BINS + 1)

_CLASS = np.zeros(256, np.int64)
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = 0 if _c.islower() else 1 if _c.isupper() else 2 if _c.isdigit() else 3 if _c == "!" else 4 if _c == "|" else 5 if _c in "#$%&*@^~<>{}[]=+\\/_" else 7 if _c == "\n" else 8 if _c.isspace() else 6
_CLASS[128:] = 9


def statistics(text: bytes, tokens: list[bytes], counts: Counter, stated: int | None) -> np.ndarray:
    n, m = max(1, len(text)), max(1, len(tokens))
    kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=10)
    letters = max(1, int(kinds[0] + kinds[1]))
    lines = text.split(b"\n")
    return np.array(
        [
            kinds[1] / letters,
            kinds[2] / n,
            kinds[3] / n,
            kinds[4] / n,
            kinds[5] / n,
            kinds[6] / n,
            kinds[9] / n,
            kinds[7] / n,
            kinds[8] / n,
            sum(map(eq, tokens, tokens[1:])) / m,
            max(counts.values(), default=0) / m,
            len(counts) / m,
            1 - len(set(lines)) / len(lines),
            min(1.0, n / m / 20),
            min(1.0, np.log1p(len(text)) / 14),
            min(1.0, np.log1p(len(tokens)) / 12),
            min(1.0, np.log1p(max(0, stated or 0)) / 14),
        ],
        np.float64,
    )


class Features:
    """Feature rows of documents in one flat layout."""

    def __init__(self):
        self.bucket: dict[bytes, int] = {}

    def rows(self, texts: list[bytes], stated: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature ids, values, features of each text)."""
        ids, values, sizes = [], [], []
        for text, n in zip(texts, stated, strict=True):
            tokens = words(text)
            counts = Counter(tokens)
            stats = statistics(text, tokens, counts, n)
            known = self.bucket
            if len(known) > 300_000:
                known.clear()
            own = np.empty(len(counts), np.int64)
            for i, w in enumerate(counts):
                b = known.get(w)
                if b is None:
                    b = known[w] = zlib.crc32(w) % WORD_BUCKETS
                own[i] = b
            x = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
            x /= max(1e-9, float(np.sqrt(x @ x)))
            base = WORD_BUCKETS + np.arange(len(stats)) * (BINS + 1)
            # Bins by square root: small shares of junk differ more than large ones.
            bins = np.minimum(BINS - 1, (np.sqrt(np.clip(stats, 0, 1)) * BINS).astype(np.int64))
            ids.append(np.concatenate([own, base, base + 1 + bins]))
            values.append(np.concatenate([x, stats, np.full(len(stats), 0.5)]))
            sizes.append(len(own) + 2 * len(stats))
        return np.concatenate(ids), np.concatenate(values), np.array(sizes)


class Machine:
    def __init__(self, bias: float, linear: np.ndarray | None = None, factors: np.ndarray | None = None):
        self.bias, self.linear, self.factors = bias, linear, factors

    def margin(self, ids: np.ndarray, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.linear is None:
            return np.full(len(sizes), self.bias)
        starts = np.cumsum(sizes) - sizes
        out = self.bias + np.add.reduceat(self.linear[ids] * x, starts)
        for f in range(self.factors.shape[1]):
            vx = self.factors[ids, f] * x
            out += 0.5 * (np.add.reduceat(vx, starts) ** 2 - np.add.reduceat(vx * vx, starts))
        return out

    def score(self, ids: np.ndarray, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(ids, x, sizes), -30, 30)))


def train(ids: np.ndarray, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Minibatch Adam on the logistic loss."""
    n = len(labels)
    positive = int(labels.sum())
    if n == 0:
        return Machine(0.0)
    bias = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    if positive in (0, n):
        return Machine(bias)
    rng = np.random.default_rng(seed)
    starts = np.cumsum(sizes) - sizes
    linear, factors = np.zeros(WIDTH), rng.normal(0, 0.01, (WIDTH, FACTORS))
    params = np.concatenate([linear[:, None], factors], axis=1)
    first, second, step = np.zeros_like(params), np.zeros_like(params), 0
    bias_first = bias_second = 0.0
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, batch):
            some = order[a : a + batch]
            take = np.repeat(starts[some] - np.concatenate([[0], np.cumsum(sizes[some])[:-1]]), sizes[some]) + np.arange(int(sizes[some].sum()))
            i, v, s = ids[take], x[take], sizes[some]
            own = np.cumsum(s) - s
            of = np.repeat(np.arange(len(some)), s)
            machine = Machine(bias, params[:, 0], params[:, 1:])
            error = machine.score(i, v, s) - labels[some]
            spread = error[of] / len(some)
            grad = np.empty_like(params)
            grad[:, 0] = np.bincount(i, spread * v, minlength=WIDTH)
            for f in range(FACTORS):
                w = params[i, f + 1]
                total = np.add.reduceat(w * v, own)[of]
                grad[:, f + 1] = np.bincount(i, spread * v * (total - w * v), minlength=WIDTH)
            grad += decay * params
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad * grad
            params = params - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            g = float(error.mean())
            bias_first, bias_second = 0.9 * bias_first + 0.1 * g, 0.999 * bias_second + 0.001 * g * g
            bias -= rate * (bias_first / (1 - 0.9**step)) / (np.sqrt(bias_second / (1 - 0.999**step)) + 1e-8)
    return Machine(bias, params[:, 0].copy(), params[:, 1:].copy())


def _feature_rows(text_col: str, stated_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for table in slices(batches, text_col, 2 << 20):
            ids, x, sizes = features.rows(column_bytes(table, text_col), table.column(stated_col).to_pylist())
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [table.column("order_x").combine_chunks(), table.column("label_x").combine_chunks(), pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(x.astype(np.float32)))],
                names=["place", "label", "ids", "x"],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stated_col: str = "n_chars", label_col: str = "quality", train_rows: Column | None = None, most: int = TRAIN_DOCS) -> Machine:
    """The machine of about `most` labelled rows among those that `train_rows` allows, chosen by the hash of their ids."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    rows = (rows if train_rows is None else rows.where(train_rows)).groupBy(F.col(id_col).alias("id_x")).agg(F.max(F.col(label_col).cast("int")).alias("label_x"))
    n = rows.count()
    if n == 0:
        return Machine(0.0)
    scale = 1 << 20
    # About `most` ids: small enough to send to every task.
    chosen = F.broadcast(rows.where(F.pmod(F.xxhash64("id_x"), F.lit(scale)) < min(scale, -(-most * scale // n))))
    # Only what is needed, by names of its own: docs may have columns named like those of chosen.
    needed = docs.select(F.col(id_col).alias("own_x"), F.col(text_col).alias("text_x"), F.col(stated_col).cast("bigint").alias("stated_x"))
    sample = needed.join(chosen, F.col("own_x") == F.col("id_x")).select(F.struct("id_x", F.xxhash64("text_x"), "stated_x").cast("string").alias("order_x"), "label_x", "text_x", "stated_x")
    got = sample.mapInArrow(_feature_rows("text_x", "stated_x"), "place string, label int, ids array<int>, x array<float>").toArrow().sort_by("place")
    if got.num_rows == 0:
        return Machine(0.0)
    got = got.combine_chunks()
    ids, x = got.column("ids").combine_chunks(), got.column("x").combine_chunks()
    sizes = np.diff(ids.offsets.to_numpy()).astype(np.int64)
    return train(ids.flatten().to_numpy().astype(np.int64), x.flatten().to_numpy().astype(np.float64), sizes, got.column("label").to_numpy().astype(np.float64))


def _score(shared, id_col: str, text_col: str, stated_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, machine = Features(), shared.value
        for table in slices(batches, text_col, 2 << 20):
            rows = features.rows(column_bytes(table, text_col), table.column(stated_col).to_pylist())
            yield pa.RecordBatch.from_arrays([table.column(id_col).combine_chunks(), pa.array(machine.score(*rows))], names=["doc_id", "score"])

    return run


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", stated_col: str = "n_chars") -> DataFrame:
    """Per row: doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col, F.col(stated_col).cast("bigint").alias(stated_col))
    return rows.mapInArrow(_score(shared, id_col, text_col, stated_col), "doc_id bigint, score double")
