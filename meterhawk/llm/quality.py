"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from its bytes and words and embedded; a gated attention
(a tanh branch times a sigmoid branch) weighs the embeddings, and the weighted sum is scored. The
embedding, the attention and the scorer are learned together from document labels alone.

The fit sees a bounded sample: ``TRAIN_DOCS`` labelled documents of each class with all
their passages; classes are weighted back to their shares among all labels. Scoring
reads all passages of all documents, in the tasks that read them.

Defined cases: a null or empty text, or one of white space only, is an empty bag and gets the score of an empty bag,
which the fit learns like any other; repeated rows get equal scores; with labels of one class or none every score
is the smoothed share of label 1 (0.5 without labels); an empty table gives an empty result; other columns are
ignored by ``score_documents`` and carried by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterhawk.llm.common import giving_back, held_out, labelled_sample, text_of
from meterhawk.llm.near_dedup import word_hashes

PASSAGE_WORDS = 64
TRAIN_DOCS = 2_000
TRIGRAM_BUCKETS = 96
EMBEDDING = 24
ATTENTION = 12
EPOCHS = 24
BATCH_DOCS = 64
RATE = 0.004
DECAY = 1e-4
SEED = 11
GOOD = 0.7

# The byte classes of the passage encoding.
BYTE_CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,", ";:", "!?", "'\"()[]{}", "|", "-_", "#$%&*@^~`", "+=<>/\\"]
_OTHER, _HIGH = len(BYTE_CLASSES), len(BYTE_CLASSES) + 1
_CLASSES = len(BYTE_CLASSES) + 2
WORD_FEATURES = 6
FEATURES = _CLASSES + TRIGRAM_BUCKETS + WORD_FEATURES
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, np.int64)
    table[128:] = _HIGH
    for number, members in enumerate(BYTE_CLASSES):
        table[list(members.encode())] = number
    return table


_CLASS_OF = _class_table()


def encode_passages(text: str) -> np.ndarray:
    """One row of features for each passage of a whole text."""
    data = text.encode("utf-8")
    words = data.lower().split()
    if not words:
        return np.empty((0, FEATURES), np.float32)
    codes = np.frombuffer(data, np.uint8)
    inside = ~_SPACE[codes]
    starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])))
    cuts = starts[::PASSAGE_WORDS]
    passages = len(cuts)
    lengths = np.diff(np.append(cuts, len(codes)))
    of_byte = np.repeat(np.arange(passages), lengths)
    codes = codes[cuts[0] :]
    size = lengths[:, None].astype(np.float32)
    classes = np.bincount(of_byte * _CLASSES + _CLASS_OF[codes], minlength=passages * _CLASSES).reshape(passages, -1)
    wide = codes.astype(np.uint32)
    mixed = (wide[:-2] * 40503 + wide[1:-1] * 30011 + wide[2:] * 20021) * np.uint32(2654435761)
    bucket = (mixed >> np.uint32(16)).astype(np.int64) % TRIGRAM_BUCKETS
    grams = np.bincount(of_byte[: len(bucket)] * TRIGRAM_BUCKETS + bucket, minlength=passages * TRIGRAM_BUCKETS)
    hashes = word_hashes(words)
    of_word = np.arange(len(words)) // PASSAGE_WORDS
    count = np.bincount(of_word)
    again = np.concatenate(([False], hashes[1:] == hashes[:-1]))
    new = np.zeros(len(words), bool)
    new[np.unique(hashes, return_index=True)[1]] = True
    _, first = np.unique(hashes + of_word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)
    own = np.bincount(of_word[first], minlength=passages)
    shares = [np.bincount(of_word, w, passages) / count for w in (again, new)]
    by_words = np.stack([np.log1p(count), lengths / count / 8, own / count, *shares, np.full(passages, np.log1p(len(words)) / 4)], axis=1)
    return np.concatenate(
        [np.sqrt(classes / size), np.sqrt(grams.reshape(passages, -1) / size), by_words], axis=1
    ).astype(np.float32)


def _softmax(values: np.ndarray, cuts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    shifted = np.exp(values - np.repeat(np.maximum.reduceat(values, cuts), sizes))
    return shifted / np.repeat(np.add.reduceat(shifted, cuts), sizes)


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


@dataclass
class BagModel:
    """Weights of the embedding (w, b), the gated attention (v, u, a) and the scorer (c, c0)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    share: float | None = None

    @classmethod
    def constant(cls, share: float) -> BagModel:
        return cls(np.zeros(FEATURES), np.ones(FEATURES), {}, share)

    def _forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags whose passages are the consecutive rows of ``x``; empty bags are the zero vector."""
        p = self.weights
        h = np.tanh(x @ p["w"] + p["b"])
        tanh, gate = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        z = np.zeros((len(sizes), h.shape[1]), h.dtype)
        some = sizes > 0
        full = sizes[some]
        cuts = np.concatenate(([0], np.cumsum(full)[:-1])).astype(np.int64)
        weight = np.empty(0, h.dtype)
        if len(full):
            weight = _softmax((tanh * gate) @ p["a"], cuts, full)
            z[some] = np.add.reduceat(h * weight[:, None], cuts)
        return {"h": h, "tanh": tanh, "gate": gate, "weight": weight, "z": z, "cuts": cuts, "score": _sigmoid(z @ p["c"] + p["c0"])}

    def attention(self, text: str) -> np.ndarray:
        """The weight of each passage of a text."""
        x = (encode_passages(text) - self.mean) / self.scale
        return self._forward(x.astype(np.float32), np.array([len(x)]))["weight"]

    def score(self, texts: list[str]) -> np.ndarray:
        if self.share is not None:
            return np.full(len(texts), self.share)
        bags = [encode_passages(text) for text in texts]
        sizes = np.array([len(b) for b in bags], np.int64)
        x = (np.concatenate([np.empty((0, FEATURES), np.float32), *bags]) - self.mean) / self.scale
        return self._forward(x.astype(np.float32), sizes)["score"].astype(float)

    def gradients(self, x, sizes, labels, weights) -> dict[str, np.ndarray]:
        p, f = self.weights, self._forward(x, sizes)
        off = (f["score"] - labels) * weights
        out = {"c": f["z"].T @ off, "c0": off.sum(keepdims=True)}
        of_bag = np.repeat(np.arange(len(sizes)), sizes)
        to_z = off[of_bag, None] * p["c"]
        gain = (f["h"] * to_z).sum(axis=1)
        mean_gain = np.bincount(of_bag, gain * f["weight"], len(sizes))[of_bag]
        to_logit = f["weight"] * (gain - mean_gain)
        out["a"] = (f["tanh"] * f["gate"]).T @ to_logit
        to_both = to_logit[:, None] * p["a"]
        to_tanh = to_both * f["gate"] * (1 - f["tanh"] ** 2)
        to_gate = to_both * f["tanh"] * f["gate"] * (1 - f["gate"])
        out["v"], out["u"] = f["h"].T @ to_tanh, f["h"].T @ to_gate
        to_h = f["weight"][:, None] * to_z + to_tanh @ p["v"].T + to_gate @ p["u"].T
        to_in = to_h * (1 - f["h"] ** 2)
        out["w"], out["b"] = x.T @ to_in, to_in.sum(axis=0)
        return out


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> BagModel:
    """Adam on the weighted log loss of the document labels."""
    rng = np.random.default_rng(seed)
    every = np.concatenate([np.empty((0, FEATURES), np.float32), *bags])
    mean = every.mean(axis=0) if len(every) else np.zeros(FEATURES)
    scale = every.std(axis=0) + 1e-3 if len(every) else np.ones(FEATURES)
    bags = [((b - mean) / scale).astype(np.float32) for b in bags]
    shapes = {"w": (FEATURES, EMBEDDING), "b": (EMBEDDING,), "v": (EMBEDDING, ATTENTION), "u": (EMBEDDING, ATTENTION), "a": (ATTENTION,), "c": (EMBEDDING,), "c0": (1,)}
    start = {k: (rng.normal(size=s) / np.sqrt(s[0]) if k not in ("b", "c0") else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}
    model = BagModel(mean, scale, start)
    first, second = ({k: np.zeros_like(w) for k, w in start.items()} for _ in range(2))
    steps = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH_DOCS):
            chosen = order[at : at + BATCH_DOCS]
            x = np.concatenate([np.empty((0, FEATURES), np.float32), *[bags[i] for i in chosen]])
            sizes = np.array([len(bags[i]) for i in chosen], np.int64)
            grads = model.gradients(x, sizes, labels[chosen], weights[chosen] / weights[chosen].sum())
            steps += 1
            for k, g in grads.items():
                g = g + DECAY * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**steps) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)
                model.weights[k] = (model.weights[k] - rate * move).astype(np.float32)
    return model


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [encode_passages(text).tobytes() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"]
        )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> BagModel:
    """Learn ``labels.quality`` outside the held-out fold. The driver gets at most 2 * per_class encoded bags."""
    sample, totals = labelled_sample(docs, labels, "quality", per_class)
    if min(totals.get(0, 0), totals.get(1, 0)) == 0:
        return BagModel.constant((totals.get(1, 0) + 1) / (sum(totals.values()) + 2))
    rows = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "label").mapInArrow(
        giving_back(_encoded), "doc_id long, label int, bag binary"
    )
    taken = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["label"]))
    if len({r["label"] for r in taken}) < 2:
        return BagModel.constant((totals[1] + 1) / (sum(totals.values()) + 2))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in taken]
    given = np.array([r["label"] for r in taken])
    held = np.bincount(given, minlength=2)
    return fit_bags(bags, given.astype(np.float32), np.array([totals[0] / held[0], totals[1] / held[1]])[given])


def _score_task(model: BagModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                scores = pa.array(model.score(part.column(at).to_pylist()), pa.float64())
                yield part.set_column(at, pa.field("score", pa.float64()), scores)

    return run


def score_documents(docs: DataFrame, model: BagModel, good: float = GOOD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    scored = rows.mapInArrow(giving_back(_score_task(model)), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= good).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: BagModel, good: float = GOOD) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns as they were."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, text_of("text").alias("text"))
    returned = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(giving_back(_score_task(model)), returned)
    return scored.where(F.col("score") >= good).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
