"""Document quality by attention-based multiple-instance learning: a document is a bag of passages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sliced, word_hashes, word_tokens

#: Words of a passage, hashed dimensions of its words, units of the encoder and of the attention.
PASSAGE, HASHED, HIDDEN, GATES = 64, 32, 16, 8
#: Text encoded at once, in bytes.
PIECE = 1 << 20
LOWER = b"abcdefghijklmnopqrstuvwxyz"
SYMBOLS = b"#$%&*+/<=>@\\^_`{|}~"
SHAPES = 14


def _classes() -> np.ndarray:
    """Class of each byte: 0 lower case, 1 upper case, 2 digit, 3 symbol, 4 point, 5 exclamation, 6 other."""
    out = np.full(256, 6, np.int64)
    for number, members in enumerate((LOWER, LOWER.upper(), b"0123456789", SYMBOLS, b"?.,;:", b"!")):
        out[list(members)] = number
    return out


def word_features(words: list[bytes]) -> np.ndarray:
    """Per distinct word: shape counts, then a random sign per hashed dimension."""
    out = np.zeros((len(words), SHAPES + HASHED), np.float32)
    n = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)) * 7, n)
    kinds = np.bincount(owner + _classes()[np.frombuffer(b"".join(words), np.uint8)], minlength=7 * len(words))
    lower, upper, digit, symbol, point, cry, other = kinds.reshape(-1, 7).T
    shape = (np.log1p(n), lower, upper, digit, symbol, point + cry, other, cry, upper > lower, n == 1, n > 16, symbol == n, digit * 2 > n, n)
    out[:, :SHAPES] = np.stack(shape, 1)
    bits = word_hashes(words).view(np.uint8).reshape(-1, 8)[:, : HASHED // 8]
    out[:, SHAPES:] = np.unpackbits(bits, axis=1).astype(np.float32) * 2 - 1
    return out


def encode(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of a batch of texts, and the row each belongs to; empty texts have none."""
    offsets, codes, words = word_tokens(text, lower=False)
    if not len(codes):
        return np.zeros((0, SHAPES + HASHED + 3), np.float32), np.zeros(0, np.int64)
    lens = np.diff(offsets)
    parts = -(-lens // PASSAGE)
    row = np.repeat(np.arange(len(lens)), parts)
    start = offsets[row] + PASSAGE * (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts))
    sums = np.add.reduceat(word_features(words)[codes], start, axis=0)
    size = np.diff(np.append(start, len(codes))).astype(np.float32)
    chars = np.maximum(sums[:, 13], 1)
    sums[:, 1:8] /= chars[:, None]  # shares of bytes
    sums[:, [0, 8, 9, 10, 11, 12, 13]] /= size[:, None]  # shares and means of words
    sums[:, SHAPES:] /= np.sqrt(size)[:, None]
    passage = np.repeat(np.arange(len(start)), size.astype(np.int64))
    distinct = np.bincount(np.unique(passage * len(words) + codes) // len(words), minlength=len(start))
    again = np.zeros(len(codes))
    again[1:] = (codes[1:] == codes[:-1]) & (passage[1:] == passage[:-1])
    extra = np.stack((distinct / size, np.bincount(passage, again, len(start)) / size, np.log(size)), 1)
    return np.hstack((sums, extra)).astype(np.float32), row


@dataclass
class Model:
    """Encoder, gated attention and output weights; small and of fixed size."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, row: np.ndarray, count: int, keep: bool = False):
        """Score per document (rows sorted); with ``keep`` also what a gradient needs."""
        w = self.weights
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["enc"] + w["enc0"])
        v, u = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        e = (v * u) @ w["a"]
        top = np.full(count, -np.inf)
        np.maximum.at(top, row, e)
        a = np.exp(e - top[row])
        a /= np.bincount(row, a, count)[row]
        z = np.zeros((count, h.shape[1]))
        np.add.at(z, row, a[:, None] * h)
        p = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -30, 30)))
        return (p, z, a, h, v, u, x) if keep else p


def train(x: np.ndarray, row: np.ndarray, y: np.ndarray, epochs: int = 60, rate: float = 0.01, decay: float = 1e-3, seed: int = 0) -> Model:
    """Fits document labels by Adam over mini-batches of documents; passages have no labels."""
    random = np.random.default_rng(seed)
    width = x.shape[1]
    mean = x.mean(0) if len(x) else np.zeros(width)
    scale = x.std(0) + 1e-3 if len(x) else np.ones(width)
    share = (y.sum() + 1) / (len(y) + 2)
    shapes = {"enc": (width, HIDDEN), "enc0": (HIDDEN,), "v": (HIDDEN, GATES), "u": (HIDDEN, GATES), "a": (GATES,), "out": (HIDDEN,), "out0": ()}
    weights = {k: random.normal(size=s) / np.sqrt(max(s[0] if s else 1, 1)) * (not k.endswith("0") and k != "out") for k, s in shapes.items()}
    weights["out0"] = np.array(np.log(share / (1 - share)))
    model = Model(mean.astype(np.float64), scale.astype(np.float64), weights)
    first = np.searchsorted(row, np.arange(len(y) + 1))
    m, s = {k: np.zeros_like(v) for k, v in weights.items()}, {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(epochs if len(x) else 0):
        order = random.permutation(len(y))
        for at in range(0, len(y), 256):
            docs = np.sort(order[at : at + 256])
            take = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            own = np.repeat(np.arange(len(docs)), first[docs + 1] - first[docs])
            p, z, a, h, v, u, xs = model.forward(x[take], own, len(docs), keep=True)
            g = (p - y[docs]) / len(docs)
            dz = g[:, None] * weights["out"]
            dh = a[:, None] * dz[own]
            da = (dz[own] * h).sum(1)
            de = a * (da - np.bincount(own, a * da, len(docs))[own])
            dvu = de[:, None] * weights["a"]
            dv, du = dvu * u * (1 - v * v), dvu * v * u * (1 - u)
            dh += dv @ weights["v"].T + du @ weights["u"].T
            dpre = dh * (1 - h * h)
            grad = {"out": z.T @ g, "out0": g.sum(), "a": (v * u).T @ de, "v": h.T @ dv, "u": h.T @ du, "enc": xs.T @ dpre, "enc0": dpre.sum(0)}
            step += 1
            for k, d in grad.items():
                d = d + decay * weights[k] * (not k.endswith("0"))
                m[k], s[k] = 0.9 * m[k] + 0.1 * d, 0.999 * s[k] + 0.001 * d * d
                weights[k] = weights[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", most_docs: int = 5_000) -> Model:
    """Learns from at most about ``most_docs`` labelled documents, chosen by a hash of their id.

    Passages of the chosen documents are encoded on the executors; only their vectors come to the
    driver. Null labels are passed over, of several labels of one id the largest counts, and labels
    without a document are unused. Without labels the model scores every text alike.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("double").alias("y"))
    total = marked.count()
    chosen = marked.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < F.lit(1_000_003.0 * most_docs / max(total, 1)))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("text")).join(chosen, "_id").select("_id", "text", "y")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in sliced(whole, "text", PIECE):
                x, row = encode(b.column("text"))
                cut = np.searchsorted(row, np.arange(b.num_rows + 1))
                packed = [x[a:e].tobytes() for a, e in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("y"), pa.array(packed, pa.binary())], ["_id", "y", "x"])

    id_type = rows.schema["_id"].dataType.simpleString()
    got = rows.mapInArrow(vectors, f"_id {id_type}, y double, x binary").toArrow().to_pandas()
    got = got.assign(size=got["x"].map(len)).sort_values(["_id", "size"]).reset_index(drop=True)
    width = SHAPES + HASHED + 3
    bags = [np.frombuffer(v, np.float32).reshape(-1, width) for v in got["x"]]
    x = np.concatenate(bags) if bags else np.zeros((0, width), np.float32)
    return train(x.astype(np.float64), np.repeat(np.arange(len(bags)), [len(b) for b in bags]), got["y"].to_numpy(float))


def score(text: Column, model: Model) -> Column:
    """Chance in (0, 1) that a whole text bears label 1, from the text alone.

    Null and empty texts have no passage; the model's bias scores them. Texts of any length are read
    whole, a bounded number of bytes at a time or one text if it is longer.
    """

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out = []
        for b in sliced(pa.RecordBatch.from_arrays([texts], ["text"]), "text", PIECE):
            x, row = encode(b.column("text"))
            out.append(model.forward(x.astype(np.float64), row, b.num_rows))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return scored(text.cast("string"))
