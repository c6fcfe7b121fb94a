"""Quality by attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded from its form (letter classes, signs,
word lengths, repeats, line breaks) by a learned layer; gated attention weights, learned from
the labels of whole documents, say how much each passage counts; the weighted sum of the
passages is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.llm.labels import sample, score_rows
from voxlens.llm.shingles import byte_runs, word_hashes, word_spans

#: Bound of the labelled sample that is learned from, and of the passages of one of its
#: documents (evenly spaced over the document). Scoring has no such bound.
TRAIN_DOCS, TRAIN_PASSAGES = 4096, 256
#: Words of a passage.
PASSAGE = 48
HIDDEN, ATTENTION, ROUNDS, RATE, DECAY, SEED = 24, 12, 150, 0.03, 1e-4, 7

# Classes of bytes that passages are described by.
_CLASSES = [
    range(65, 91), range(97, 123), range(48, 58), b"!?", b"*&%$#@=+~^_<>{}[]\\/", b"|", b".,;:", range(128, 256),
]
_SIGNS = (3, 4, 5, 6)


def passage_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the text it is in. A text without words is one passage
    of zeros."""
    starts, ends = word_spans(data, bounds)
    words, owner = word_hashes(data, bounds)
    texts = len(bounds) - 1
    count = np.bincount(owner, minlength=texts)
    passages = np.maximum(1, -(-count // PASSAGE))
    first = np.cumsum(passages) - passages
    at = first[owner] + (np.arange(len(owner)) - (np.cumsum(count) - count)[owner]) // PASSAGE
    total = int(passages.sum())

    def per(values) -> np.ndarray:
        return np.bincount(at, values, total)

    size = (ends - starts).astype(np.float64)
    n = np.maximum(1, np.bincount(at, minlength=total))
    mean, length = per(size) / n, np.maximum(1, per(size))
    out = [np.log1p(np.bincount(at, minlength=total)) / 4, mean / 8,
           np.sqrt(np.maximum(0, per(size * size) / n - mean * mean)) / 8]
    for k, members in enumerate(_CLASSES):
        of_class = np.zeros(256, np.int32)
        of_class[list(members)] = 1
        sums = np.concatenate([[0], np.cumsum(of_class[data])])
        held = sums[ends] - sums[starts]
        out.append(per(held) / length)
        if k == 0:
            out.append(per(held == size) / n)
        if k in _SIGNS:
            out.append(per(held > 0) / n)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (at[1:] == at[:-1])
    order = np.lexsort((words, at))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (at[order][1:] != at[order][:-1])
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    gaps = np.append(breaks[starts[1:]] - breaks[ends[:-1]], 0)[: len(starts)]
    out += [per(again) / n, np.bincount(at[order], fresh, total) / n, per(size <= 3) / n, per(size >= 12) / n,
            per(np.minimum(gaps, 2)) / n, per((data[starts] >= 65) & (data[starts] < 91)) / n]
    return np.stack(out, 1).astype(np.float32), np.repeat(np.arange(texts), passages)


def _forward(m: dict, x: np.ndarray, owner: np.ndarray, first: np.ndarray) -> dict:
    """``first``: the first passage of each text; every text has one."""
    hidden = np.maximum(x @ m["W"] + m["b"], 0)
    tanh, gate = np.tanh(hidden @ m["V"]), 1 / (1 + np.exp(-(hidden @ m["U"])))
    level = (tanh * gate) @ m["w"]
    weight = np.exp(level - np.maximum.reduceat(level, first)[owner])
    weight /= np.add.reduceat(weight, first)[owner]
    bag = np.add.reduceat(weight[:, None] * hidden, first)
    return {"hidden": hidden, "tanh": tanh, "gate": gate, "weight": weight, "bag": bag,
            "score": 1 / (1 + np.exp(-np.clip(bag @ m["c"] + m["c0"], -30, 30)))}


def _gradients(m: dict, x: np.ndarray, owner: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(m, x, owner, first)
    slope = (f["score"] - y) / len(y)
    of_bag = (slope[:, None] * m["c"])[owner]
    of_weight = (of_bag * f["hidden"]).sum(1)
    of_level = f["weight"] * (of_weight - np.add.reduceat(f["weight"] * of_weight, first)[owner])
    of_gated = of_level[:, None] * m["w"]
    of_tanh = of_gated * f["gate"] * (1 - f["tanh"] ** 2)
    of_gate = of_gated * f["tanh"] * f["gate"] * (1 - f["gate"])
    of_hidden = f["weight"][:, None] * of_bag + of_tanh @ m["V"].T + of_gate @ m["U"].T
    of_hidden *= f["hidden"] > 0
    return {"W": x.T @ of_hidden, "b": of_hidden.sum(0), "V": f["hidden"].T @ of_tanh, "U": f["hidden"].T @ of_gate,
            "w": (f["tanh"] * f["gate"]).T @ of_level, "c": f["bag"].T @ slope, "c0": slope.sum(keepdims=True)}


def fit(x: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict:
    """Weights of the encoder, the gated attention and the classifier, by Adam on all texts."""
    random = np.random.default_rng(SEED)

    def drawn(*shape):
        return (random.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

    mean, spread = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / spread
    m = {"W": drawn(x.shape[1], HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": drawn(HIDDEN, ATTENTION),
         "U": drawn(HIDDEN, ATTENTION), "w": drawn(ATTENTION), "c": drawn(HIDDEN), "c0": np.zeros(1, np.float32)}
    first = np.searchsorted(owner, np.arange(len(y)))
    moved, spread2 = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    y = y.astype(np.float32)
    for t in range(1, ROUNDS + 1):
        for k, g in _gradients(m, x, owner, first, y).items():
            g = g + DECAY * m[k]
            moved[k] = 0.9 * moved[k] + 0.1 * g
            spread2[k] = 0.999 * spread2[k] + 0.001 * g * g
            m[k] = m[k] - RATE * (moved[k] / (1 - 0.9**t)) / (np.sqrt(spread2[k] / (1 - 0.999**t)) + 1e-8)
    return {**m, "mean": mean, "spread": spread}


def predict(m: dict, x: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    if "constant" in m:
        return np.full(texts, m["constant"])
    first = np.searchsorted(owner, np.arange(texts))
    return _forward(m, (x - m["mean"]) / m["spread"], owner, first)["score"].astype(np.float64)


def _bags(batches):
    """Per sampled text its label and at most TRAIN_PASSAGES passages."""
    for batch in batches:
        for at, data, bounds in byte_runs(batch.column("text")):
            x, owner = passage_features(data, bounds)
            n = len(bounds) - 1
            edge = np.searchsorted(owner, np.arange(n + 1))
            kept = [x[a:b][np.unique(np.linspace(0, b - a - 1, min(b - a, TRAIN_PASSAGES)).astype(int))]
                    for a, b in zip(edge, edge[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(at, n).cast(pa.string()), batch.column("label").slice(at, n),
                 pa.array([k.tobytes() for k in kept], pa.binary())],
                names=["id", "label", "features"])


def learn(docs: DataFrame, labels: DataFrame, held, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", bound: int = TRAIN_DOCS) -> dict:
    """The model, from at most ``bound`` labelled texts outside ``held`` (a condition on
    ``id``). Their passages, at most ``bound * TRAIN_PASSAGES``, come to the driver. Without
    labels of both kinds every score is the mean label, without any 0.5."""
    rows = sample(docs, labels, label_col, held, bound, id_col, text_col)
    bags = rows.select("id", "label", "text").mapInArrow(_bags, "id string, label int, features binary").collect()
    bags.sort(key=lambda r: (r.id, r.label, bytes(r.features)))
    y = np.array([r.label for r in bags], float)
    if len(set(y)) < 2:
        return {"constant": float(y.mean()) if len(y) else 0.5}
    width = passage_features(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0].shape[1]
    x = [np.frombuffer(r.features, np.float32).reshape(-1, width) for r in bags]
    return fit(np.concatenate(x), np.repeat(np.arange(len(x)), [len(b) for b in x]), y)


def scorer(data):
    """A function from an Arrow column of texts to scores, for tasks; ``data`` is a broadcast
    model."""
    model = data.value

    def of(column) -> np.ndarray:
        parts = [predict(model, *passage_features(text, bounds), len(bounds) - 1) for _, text, bounds in byte_runs(column)]
        return np.concatenate(parts) if parts else np.zeros(0)
    return of


def score(spark: SparkSession, docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``score``) per row, from all passages of the text. Null, empty and blank texts are
    one empty passage; repeated rows and null ids are rows like any other; other columns are
    not read. No rows give no rows."""
    return score_rows(docs, scorer, spark.sparkContext.broadcast(model), id_col, text_col)
