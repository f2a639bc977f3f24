"""Quality by attention over passages (multiple-instance learning).

A document is a bag of passages of 64 words. Each passage is encoded by hashed word counts and shape measures;
a gated attention, learned together with the encoder from document labels only, weighs the passages, and the
weighted passage representation is scored. The fit runs on a bounded sample of labelled rows; scoring is a pass
over all texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASSAGE_WORDS = 64
BUCKETS = 256
#: Labelled rows the model is fitted on at most: those with the least hash of their id.
FIT_ROWS = 4_000
HIDDEN, GATE = 32, 16
EPOCHS, DOCS_PER_STEP, RATE, DECAY = 12, 64, 0.005, 1e-4
#: Score from which a document counts as good.
THRESHOLD = 0.3
#: Bytes encoded at a time; longer texts are cut there at white space, and all their passages still form one bag.
SEGMENT = 1 << 20

_WHITE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_CLASSES = np.zeros((5, 256), np.int32)
for _row, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?;:")):
    _CLASSES[_row, list(_chars)] = 1
_CLASSES[4, 128:] = 1
SHAPES = 3 + len(_CLASSES)
WIDTH = BUCKETS + SHAPES
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _segments(raw: bytes) -> list[bytes]:
    """``raw`` cut at white space about every SEGMENT bytes."""
    out, at = [], 0
    while len(raw) - at > SEGMENT:
        cut = max(raw.rfind(w, at, at + SEGMENT) for w in (b" ", b"\n"))
        cut = cut if cut > at else at + SEGMENT
        out.append(raw[at:cut])
        at = cut
    out.append(raw[at:])
    return out


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, first): a row for each passage, and the first row of each text; a text without words has one row of zeros."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data)
    white = _WHITE[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = white[:-1], white[1:]
    begins = (ends - sizes)[sizes > 0]
    before[begins], after[ends[sizes > 0] - 1] = True, True
    start, end = np.flatnonzero(~white & before), np.flatnonzero(~white & after) + 1
    doc = np.searchsorted(ends, start, side="right")
    counts = np.bincount(doc, minlength=len(texts))
    passages = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.cumsum(passages) - passages
    place = first[doc] + (np.arange(len(start)) - (np.cumsum(counts) - counts)[doc]) // PASSAGE_WORDS
    total = int(passages.sum())
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_BASE, n), dtype=np.uint64)])
    hashed = (sums[end] - sums[start]) * _powers(_INVERSE, n)[start] if n else np.zeros(0, np.uint64)
    bucket = ((hashed ^ hashed >> np.uint64(29)) * _BASE >> np.uint64(56)).astype(np.int64)
    table = np.bincount(place * BUCKETS + bucket, minlength=total * BUCKETS).reshape(total, BUCKETS)
    words = np.maximum(1, np.bincount(place, minlength=total)).astype(np.float64)
    length = np.bincount(place, weights=end - start, minlength=total)
    shape = np.empty((total, SHAPES), np.float32)
    shape[:, 0] = length / words / 10
    length = np.maximum(1, length)
    same = np.zeros(len(start))
    same[1:] = (hashed[1:] == hashed[:-1]) & (place[1:] == place[:-1])
    shape[:, 1] = np.bincount(place, weights=same, minlength=total) / words
    shape[:, 2] = (table > 0).sum(axis=1) / words
    for i, members in enumerate(_CLASSES):
        inside = np.concatenate([[0], np.cumsum(members[data], dtype=np.int64)])
        shape[:, 3 + i] = np.bincount(place, weights=inside[end] - inside[start], minlength=total) / length
    return np.hstack([np.sqrt(table / words[:, None]).astype(np.float32), shape]), first


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features and first row of each text, however long it is."""
    parts, owner, held, size = [], [], [], 0
    cut = [(i, s) for i, t in enumerate(texts) for s in _segments(t)]
    for k, (i, segment) in enumerate(cut):
        held.append(segment)
        owner.append(i)
        size += len(segment)
        if size >= SEGMENT or k == len(cut) - 1:
            parts.append(encode(held))
            held, size = [], 0
    rows = np.concatenate([np.diff(np.r_[f, len(x)]) for x, f in parts])
    per_text = np.bincount(owner, weights=rows, minlength=len(texts)).astype(np.int64)
    return np.concatenate([x for x, _ in parts]), np.cumsum(per_text) - per_text


@dataclass
class Model:
    """Encoder w, b; gated attention v, u, a; score c, d; mean and scale of the shape measures."""

    p: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def scaled(self, x: np.ndarray) -> np.ndarray:
        out = x.astype(np.float32)
        out[:, BUCKETS:] = (out[:, BUCKETS:] - self.mean) / self.scale
        return out

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        e = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(e @ p["v"]), 1 / (1 + np.exp(-(e @ p["u"])))
        s = (t * g) @ p["a"]
        bag = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(x)]))
        weight = np.exp(s - np.maximum.reduceat(s, first)[bag])
        weight /= np.add.reduceat(weight, first)[bag]
        z = np.add.reduceat(weight[:, None] * e, first, axis=0)
        return {"e": e, "t": t, "g": g, "bag": bag, "weight": weight, "z": z, "logit": z @ p["c"] + p["d"]}

    def score(self, texts: list[bytes]) -> np.ndarray:
        x, first = bags(texts)
        return 1 / (1 + np.exp(-np.clip(self.forward(self.scaled(x), first)["logit"].astype(np.float64), -30, 30)))

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, f = self.p, self.forward(x, first)
        miss = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
        dz = miss[:, None] * p["c"]
        de = f["weight"][:, None] * dz[f["bag"]]
        dweight = (f["e"] * dz[f["bag"]]).sum(axis=1)
        ds = f["weight"] * (dweight - np.add.reduceat(f["weight"] * dweight, first)[f["bag"]])
        dgate = ds[:, None] * p["a"]
        dv, du = dgate * f["g"] * (1 - f["t"] ** 2), dgate * f["t"] * f["g"] * (1 - f["g"])
        de = (de + dv @ p["v"].T + du @ p["u"].T) * (1 - f["e"] ** 2)
        return {"w": x.T @ de, "b": de.sum(axis=0), "v": f["e"].T @ dv, "u": f["e"].T @ du, "a": (f["t"] * f["g"]).T @ ds,
                "c": f["z"].T @ miss, "d": miss.sum()}


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int = 5) -> Model:
    """Adam on the log loss of document labels; equal inputs give an equal model."""
    rng = np.random.default_rng(seed)
    near = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"w": near(WIDTH, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "v": near(HIDDEN, GATE), "u": near(HIDDEN, GATE), "a": near(GATE),
         "c": near(HIDDEN), "d": np.float32(0)}
    shape = x[:, BUCKETS:]
    model = Model(p, shape.mean(axis=0) if len(x) else np.zeros(SHAPES, np.float32), shape.std(axis=0) + 1e-3 if len(x) else np.ones(SHAPES, np.float32))
    if not len(y):
        return model
    x = model.scaled(x)
    last = np.r_[first[1:], len(x)]
    m, v = {k: np.zeros_like(w) for k, w in p.items()}, {k: np.zeros_like(w) for k, w in p.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), DOCS_PER_STEP):
            some = order[at:at + DOCS_PER_STEP]
            rows = np.concatenate([np.arange(first[i], last[i]) for i in some])
            sizes = last[some] - first[some]
            step += 1
            for k, g in model.gradients(x[rows], np.cumsum(sizes) - sizes, y[some]).items():
                g = g + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = (p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out(doc_id):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """The model fitted on at most ``rows`` labelled rows that are not held out.

    NULL labels and ids are left out; contradictory labels of one id count as 1. Without labels every weight is as it starts.
    """
    known = (labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
             .groupBy(F.col(doc_id).cast("long").alias("_id")).agg((F.max(label) > 0).cast("double").alias("_y"))
             .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    sample = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, first = bags(batch.column("raw").to_pylist())
                found = [v.tobytes() for v in np.split(x, first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_y"), pa.array(found, pa.binary())], ["_id", "_y", "x"])

    # ``known`` has at most ``rows`` rows of two numbers, so it is broadcast; so few encoded bags fit the driver.
    got = sample.join(F.broadcast(known), "_id").select("_id", "_y", "raw").mapInArrow(features, "_id long, _y double, x binary").toPandas()
    got = got.sort_values(["_id", "x"], kind="stable").drop_duplicates("_id")
    each = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in got["x"]]
    sizes = np.array([len(v) for v in each], np.int64)
    x = np.concatenate(each) if each else np.zeros((0, WIDTH), np.float32)
    return fit(x, np.cumsum(sizes) - sizes, got["_y"].to_numpy())


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted of each row; NULL and empty texts are scored as a bag
    of one empty passage, repeated rows alike. Other columns are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(batch.column("raw").to_pylist()))], ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    return (rows.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))
