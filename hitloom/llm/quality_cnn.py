"""Quality classifier: a convolutional network over bytes, trained and run in numpy.

A text is its UTF-8 bytes, in chunks of `CHUNK` starting positions; a window of
`WIDTH` bytes starts at each, so neighbouring chunks overlap and together cover
the whole text. Learned filters are max-pooled within a chunk, a hidden layer
turns them into the chunk's features, and a text's probability combines the
largest and the mean features of all its chunks.

A filter's response is the sum of one table row per byte of the window, so
scoring is lookups and sums. The model is fitted on all chunks of at most
`PER_CLASS` texts of each label and travels to the tasks; scoring is a narrow
map of all rows.

Defined cases: null or empty text is one window of padding and gets the score of
that; without texts of both labels every score is 0.5; repeated rows and null
ids are scored as they are; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import whole_text
from hitloom.llm.labelled import training_texts

PAD = 256
WIDTH = 6
CHUNK = 192
FILTERS = 24
EMBEDDING = 8
HIDDEN = 16

#: Texts of each label in a training sample, whole.
PER_CLASS = 1200
EPOCHS = 8

#: Bytes scored at a time.
BLOCK = 1 << 17


@dataclass
class ByteCNN:
    tables: np.ndarray  # WIDTH x 257 x FILTERS
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        made, at, size = np.empty(len(texts)), 0, 0
        low = 0
        for k, t in enumerate(texts):
            size += len(t)
            if size >= BLOCK or k == len(texts) - 1:
                made[low : k + 1] = self._block(texts[low : k + 1])
                low, size = k + 1, 0
        return made

    def _pool(self, symbols: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Max-pooled filter responses of the windows that start in [edges[k], edges[k + 1])."""
        n = edges[-1]
        sums = self.tables[0][symbols[:n]]
        for w in range(1, WIDTH):
            sums += self.tables[w][symbols[w : n + w]]
        return np.maximum.reduceat(sums, edges[:-1], axis=0) + self.bias

    def _block(self, texts: list[bytes]) -> np.ndarray:
        parts, edges, owner, at = [], [], [], 0
        gap = np.full(WIDTH - 1, PAD, dtype=np.int16)
        pooled = []
        for k, t in enumerate(texts):
            own = np.frombuffer(t or b" ", dtype=np.uint8).astype(np.int16) if t else np.array([PAD], dtype=np.int16)
            if len(own) > BLOCK:  # a long text, piece by piece
                padded = np.r_[own, gap]
                step = BLOCK - BLOCK % CHUNK
                for low in range(0, len(own), step):
                    n = min(step, len(own) - low)
                    pooled.append((k, self._pool(padded[low : low + n + WIDTH - 1], np.r_[np.arange(0, n, CHUNK), n])))
                continue
            parts += [own, gap]
            starts = np.arange(0, len(own), CHUNK)
            edges += [at + starts, [at + len(own)]]
            owner += [np.full(len(starts), k), [-1]]  # windows that start in the gap belong to no text
            at += len(own) + WIDTH - 1
        features, owners = [], []
        if parts:
            symbols = np.concatenate([*parts, gap])
            cuts = np.concatenate([*edges, [at]])
            features.append(self._pool(symbols, cuts))
            owners.append(np.concatenate(owner))
        for k, f in pooled:
            features.append(f)
            owners.append(np.full(len(f), k))
        owners = np.concatenate(owners)
        h = np.maximum(np.concatenate(features)[owners >= 0] @ self.hidden + self.hidden_bias, 0)
        owners = owners[owners >= 0]
        order = np.argsort(owners, kind="stable")
        h, starts = h[order], np.searchsorted(owners[order], np.arange(len(texts)))
        largest = np.maximum.reduceat(h, starts, axis=0)
        mean = np.add.reduceat(h, starts, axis=0) / np.bincount(owners, minlength=len(texts))[:, None]
        return _sigmoid(np.hstack([largest, mean]) @ self.out + self.out_bias)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All chunks of these texts: symbols (chunks x CHUNK + WIDTH - 1), windows that start in each, chunks of each text."""
    parts, inside = [], []
    for t in texts:
        own = np.frombuffer(t, dtype=np.uint8) if t else np.array([PAD])
        starts = np.arange(0, len(own), CHUNK)
        x = np.full(len(starts) * CHUNK + WIDTH - 1, PAD, dtype=np.int16)
        x[: len(own)] = own
        parts.append(np.lib.stride_tricks.sliding_window_view(x, CHUNK + WIDTH - 1)[::CHUNK])
        inside.append(np.minimum(CHUNK, len(own) - starts))
    return np.concatenate(parts), np.concatenate(inside), np.array([len(p) for p in parts])


def _strongest(tables: np.ndarray, x: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and value of each filter's largest response in each chunk, `BLOCK` windows at a time."""
    at = np.empty((len(x), tables.shape[2]), dtype=np.int64)
    best = np.empty(at.shape)
    step = BLOCK // CHUNK
    for low in range(0, len(x), step):
        part = x[low : low + step]
        sums = tables[0][part[:, :CHUNK]]
        for w in range(1, WIDTH):
            sums += tables[w][part[:, w : CHUNK + w]]
        sums[np.arange(CHUNK) >= inside[low : low + step, None]] = -np.inf
        own = sums.argmax(axis=1)
        at[low : low + step] = own
        best[low : low + step] = np.take_along_axis(sums, own[:, None], axis=1)[:, 0]
    return at, best


def loss_and_gradient(p: dict, texts: list[bytes], y: np.ndarray, weight: np.ndarray, kind=np.float32) -> tuple[float, dict]:
    """Weighted mean cross-entropy of whole texts, and its derivatives by each parameter."""
    x, inside, counts = _chunks(texts)
    first = np.cumsum(counts) - counts
    at, best = _strongest((p["e"] @ p["f"]).astype(kind), x, inside)
    a = best + p["b"]
    z = a @ p["v"] + p["c"]
    h = np.maximum(z, 0)
    top = np.stack([h[s : s + n].argmax(axis=0) + s for s, n in zip(first, counts)])
    hidden = np.arange(HIDDEN)
    feats = np.hstack([h[top, hidden], np.add.reduceat(h, first, axis=0) / counts[:, None]])
    score = _sigmoid(feats @ p["u"] + p["d"])
    loss = -(weight * np.log(np.where(y == 1, score, 1 - score))).mean()
    g = (score - y) * weight / len(y)
    grad = {"u": feats.T @ g, "d": np.array([g.sum()])}
    df = g[:, None] * p["u"]
    dh = np.repeat(df[:, HIDDEN:] / counts[:, None], counts, axis=0)
    dh[top, hidden] += df[:, :HIDDEN]
    dz = dh * (z > 0)
    da = dz @ p["v"].T
    grad |= {"v": a.T @ dz, "c": dz.sum(axis=0), "b": da.sum(axis=0)}
    ge, gf = np.zeros_like(p["e"]), np.zeros_like(p["f"])
    columns = np.broadcast_to(np.arange(at.shape[1]), at.shape)
    for w in range(WIDTH):
        seen = np.take_along_axis(x, at + w, axis=1)
        dt = np.zeros((PAD + 1, at.shape[1]))
        np.add.at(dt, (seen, columns), da)
        gf[w] = p["e"].T @ dt
        ge += dt @ p["f"][w].T
    return loss, grad | {"e": ge, "f": gf}


def start(rng) -> dict[str, np.ndarray]:
    return {
        "e": rng.normal(0, 0.5, (PAD + 1, EMBEDDING)),
        "f": rng.normal(0, 0.4, (WIDTH, EMBEDDING, FILTERS)),
        "b": np.zeros(FILTERS),
        "v": rng.normal(0, 0.3, (FILTERS, HIDDEN)),
        "c": np.zeros(HIDDEN),
        "u": rng.normal(0, 0.3, 2 * HIDDEN),
        "d": np.zeros(1),
    }


def train(texts: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 1) -> ByteCNN | None:
    """Fit the network by Adam on cross-entropy, every epoch on all chunks; None without texts of both labels."""
    y = np.array([label for _, label in texts], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    data = [t.encode() for t, _ in texts]
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    p = start(rng)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 48)):
            step += 1
            _, grad = loss_and_gradient(p, [data[k] for k in rows], y[rows], weight[rows])
            for k, dk in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * dk
                second[k] = 0.99 * second[k] + 0.01 * dk * dk
                p[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return ByteCNN((p["e"] @ p["f"]).astype(np.float32), p["b"], p["v"], p["c"], p["u"], float(p["d"][0]))


def score_texts(docs: DataFrame, model: ByteCNN | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row."""
    id_type = dict(docs.dtypes)[key]
    if model is None:
        return docs.select(key, F.lit(0.5).alias("score"))

    def run(batches):
        for batch in batches:
            parts = [
                model.scores([x.as_py() for x in batch.column(1).slice(low, 256)]) for low in range(0, batch.num_rows, 256)
            ]
            values = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=[key, "score"])

    return docs.select(F.col(key), whole_text(text).cast("binary").alias("text")).mapInArrow(run, f"{key} {id_type}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, may_train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the labelled rows that ``may_train`` allows, and score every row."""
    sample = training_texts(docs, labels, "quality", may_train, PER_CLASS, key, text)
    return score_texts(docs, train(sample), key, text)
