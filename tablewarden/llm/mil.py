"""Document quality by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewarden.llm.common import as_before, bounded_batches, packed

PASSAGE = 64
# Labelled rows that the driver fits on: a documented bound, taken by the smallest hashes of the keys.
TRAIN_ROWS = 4000
THRESHOLD = 0.7
STEPS, RATE, HIDDEN, ATTENTION, DECAY = 300, 0.03, 16, 8, 1e-4

# Byte classes: lower, upper, digit, line feed, other white space, sentence marks, exclamation, bars, symbols, rest of ASCII, not ASCII.
_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"\n", b" \t\r\x0b\x0c", b".,;:?'\"-()", b"!", b"|", b"#*$%&<>~^_=+@/\\[]{}"]
_CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _members in enumerate(_CLASSES):
    _CLASS[list(_members)] = _i
_CLASS[128:] = len(_CLASSES) + 1
N_CLASSES = len(_CLASSES) + 2
N_FEATURES = N_CLASSES + 6


def passages(text: bytes | None) -> np.ndarray:
    """Features of each passage of ``PASSAGE`` words; a null, empty or wordless text is one passage of zeros.

    Shares of byte classes, mean and spread of word lengths, the share of distinct words, of distinct word pairs, of
    words seen in earlier passages, and the passage's fill.
    """
    words = (text or b"").split()
    if not words:
        return np.zeros((1, N_FEATURES), np.float32)
    n = -(-len(words) // PASSAGE)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.arange(len(words)) // PASSAGE
    data = np.frombuffer(text, np.uint8)
    # A byte belongs to the passage of the last word that began at or before it.
    solid = (_CLASS[data] != 3) & (_CLASS[data] != 4)
    starts = solid & ~np.concatenate(([False], solid[:-1]))
    of_byte = np.maximum(np.cumsum(starts) - 1, 0) // PASSAGE
    shares = np.bincount(of_byte * N_CLASSES + _CLASS[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES)[:n]
    count = np.bincount(owner, minlength=n)
    mean = np.bincount(owner, lengths, n) / count
    spread = np.sqrt(np.maximum(np.bincount(owner, lengths * lengths, n) / count - mean * mean, 0))
    distinct, pairs, again = np.empty(n), np.empty(n), np.empty(n)
    seen: set[bytes] = set()
    for i in range(n):
        own = words[i * PASSAGE : (i + 1) * PASSAGE]
        kinds = set(own)
        distinct[i] = len(kinds) / len(own)
        pairs[i] = (len(set(zip(own, own[1:]))) + 1) / len(own)
        again[i] = len(kinds & seen) / len(kinds)
        seen |= kinds
    rest = np.stack([mean / 10, spread / 10, distinct, pairs, again, count / PASSAGE], axis=1)
    return np.concatenate([shares / np.maximum(shares.sum(axis=1, keepdims=True), 1), rest], axis=1).astype(np.float32)


@dataclass
class Model:
    """Encoder, gated attention and classifier. ``constant`` stands in where labels are missing or of one kind."""

    constant: float | None = None
    shift: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def forward(self, x: np.ndarray, starts: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        energy = (t * g) @ w["attend"]
        raised = np.exp(energy - np.maximum.reduceat(energy, starts)[bag])
        a = raised / np.add.reduceat(raised, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-(z @ w["classify"] + w["classify0"])))}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        if self.constant is not None:
            return np.full(len(bags), self.constant)
        sizes = np.array([len(b) for b in bags])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        x = (np.concatenate(bags) - self.shift) / self.scale
        return self.forward(x, starts, np.repeat(np.arange(len(bags)), sizes))["p"].astype(np.float64)


def fit(bags: list[np.ndarray], labels: list[int]) -> Model:
    """Full-batch Adam on the log loss. No labels: every score is 1. Labels of one kind: their smoothed mean."""
    y = np.array(labels, np.float32)
    if not len(y):
        return Model(constant=1.0)
    if y.min() == y.max():
        return Model(constant=float((y.sum() + 1) / (len(y) + 2)))
    sizes = np.array([len(b) for b in bags])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    bag = np.repeat(np.arange(len(bags)), sizes)
    x = np.concatenate(bags)
    model = Model(shift=x.mean(axis=0), scale=x.std(axis=0) + 1e-3)
    x = (x - model.shift) / model.scale
    rng = np.random.default_rng(9)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = model.weights = {
        "encode": draw(x.shape[1], HIDDEN), "encode0": np.zeros(HIDDEN, np.float32), "tanh": draw(HIDDEN, ATTENTION), "gate": draw(HIDDEN, ATTENTION),
        "attend": draw(ATTENTION), "classify": draw(HIDDEN), "classify0": np.zeros((), np.float32),
    }
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        f = model.forward(x, starts, bag)
        d_out = (f["p"] - y) / len(y)
        d_z = d_out[:, None] * w["classify"]
        d_a = (d_z[bag] * f["h"]).sum(axis=1)
        d_energy = f["a"] * (d_a - np.add.reduceat(f["a"] * d_a, starts)[bag])
        d_t = d_energy[:, None] * w["attend"] * f["g"] * (1 - f["t"] ** 2)
        d_g = d_energy[:, None] * w["attend"] * f["t"] * f["g"] * (1 - f["g"])
        d_h = f["a"][:, None] * d_z[bag] + d_t @ w["tanh"].T + d_g @ w["gate"].T
        d_x = d_h * (1 - f["h"] ** 2)
        slopes = {
            "encode": x.T @ d_x, "encode0": d_x.sum(axis=0), "tanh": f["h"].T @ d_t, "gate": f["h"].T @ d_g,
            "attend": (f["t"] * f["g"]).T @ d_energy, "classify": f["z"].T @ d_out, "classify0": d_out.sum(),
        }
        for k, slope in slopes.items():
            slope = slope + DECAY * w[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope * slope
            w[k] = (w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """A model fitted on at most ``rows`` labelled documents outside the held-out part.

    Rows without a key or label are not used; a key that is labelled more than once counts once, with its largest label.
    """
    chosen = (
        labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [passages(t).ravel() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(made, pa.list_(pa.float32()))], ["_id", "_label", "_bag"])

    found = bounded_batches(docs).select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text")).join(F.broadcast(chosen), "_id")
    kind = docs.schema[key].dataType.simpleString()
    # Repeated rows of a chosen key are fitted once.
    got = found.mapInArrow(bags, f"_id {kind}, _label INT, _bag ARRAY<FLOAT>").dropDuplicates(["_id"]).orderBy("_id").toPandas()
    return fit([np.asarray(b, np.float32).reshape(-1, N_FEATURES) for b in got["_bag"]], got["_label"].tolist())


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", least: float | None = None) -> DataFrame:
    """``keep`` and ``_score`` for every row; with ``least`` only rows that score as much."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["_score DOUBLE"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            got = np.concatenate([model.scores([passages(t.as_py()) for t in texts[at : at + 256]]) for at in range(0, len(texts), 256)] or [np.zeros(0)])
            arrays = [*(batch.column(i) for i in range(len(keep))), pa.array(got, pa.float64())]
            out = pa.RecordBatch.from_arrays(arrays, [*keep, "_score"])
            yield out if least is None else out.filter(pa.array(got >= least))

    return bounded_batches(docs).select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key``, held_out, score and predicted for every row.

    Scores depend on the text alone. A null or empty text is scored as one passage of zeros. Null and repeated keys are
    scored like any other row (a null key is not held out); other columns are ignored; an empty table gives an empty result.
    """
    model = train(docs, labels, key, text)
    scored = score(docs.select(F.col(key).alias("_id"), F.col(text).alias("_t")), model, ["_id"], "_t")
    return scored.select(
        F.col("_id").alias(key), held_out("_id").alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, in place: no row is shuffled."""
    model = train(docs, labels, key, text)
    whole = packed(docs, _t=text)
    return as_before(score(whole, model, ["_doc"], "_t", threshold), docs)
