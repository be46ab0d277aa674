"""Quality classifier: attention-based multiple-instance learning over passages.

A text is a bag of passages. Every passage is encoded, a gated attention layer learned
from the labels of whole documents weighs the passages, and the weighted sum is scored.
All of it is numpy; training runs on a bounded sample, scoring in Spark tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_bytes, word_codes

PASSAGE_WORDS = 48
#: Labelled documents that the model is fitted on, at most, in the order of a hash of
#: their ids, and the largest text among them.
SAMPLE_ROWS = 3000
SAMPLE_TEXT_BYTES = 1 << 20
THRESHOLD = 0.7
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 24, 64, 0.01, 1e-4

_WORD = np.array([0 if b == 0x20 or 0x09 <= b <= 0x0D else max(b, 1) for b in range(256)], np.uint8)


def _byte_classes() -> tuple[np.ndarray, int]:
    """A class for each byte: every ASCII mark alone, letters and digits together."""
    out, count = np.zeros(256, np.uint8), 6
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            out[b] = 1
        elif c.islower():
            out[b] = 2
        elif c.isupper():
            out[b] = 3
        elif c.isdigit():
            out[b] = 4
        elif 0x20 < b < 0x7F:
            out[b] = count
            count += 1
        elif b == 0x20:
            out[b] = 5
    return out, count


# Texts are read in slices of about so many bytes, as each byte takes many times that.
SLICE_BYTES = 1 << 20

_CLASS, _CLASSES = _byte_classes()
_PAIRS = 5
FEATURES = _CLASSES + _PAIRS * _PAIRS + 8


def passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages before each text (n + 1).

    A passage has ``PASSAGE_WORDS`` words, the last of a text maybe fewer. A text
    without words is one passage of its own.
    """
    codes, counts = word_codes(raw, offsets, _WORD)
    words = np.diff(counts)
    sizes = np.maximum(1, -(-words // PASSAGE_WORDS))
    before = np.concatenate([[0], np.cumsum(sizes)])
    total = int(before[-1])
    out = np.zeros((total, FEATURES), np.float32)
    if not len(raw):
        return out, before
    text_of_word = np.repeat(np.arange(len(words)), words)
    nth = np.arange(len(codes)) - counts[:-1][text_of_word]
    of_word = before[:-1][text_of_word] + nth // PASSAGE_WORDS
    # A byte belongs to the passage of the last word that began at or before it.
    inside = _WORD[raw] != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    first[edges] = inside[edges]
    last = np.cumsum(first) - 1
    text_of_byte = np.repeat(np.arange(len(words)), np.diff(offsets))
    of_byte = before[:-1][text_of_byte]
    begun = last >= counts[:-1][text_of_byte]
    of_byte[begun] = of_word[last[begun]]
    kind = _CLASS[raw]
    at = _CLASSES
    out[:, :at] = np.bincount(
        of_byte * _CLASSES + kind, minlength=total * _CLASSES
    ).reshape(total, _CLASSES)
    coarse = np.minimum(np.where(kind >= 6, 0, kind), _PAIRS - 1).astype(np.int64)
    pair = of_byte[1:] * _PAIRS**2 + coarse[:-1] * _PAIRS + coarse[1:]
    out[:, at : at + _PAIRS**2] = np.bincount(pair, minlength=total * _PAIRS**2).reshape(total, -1)
    n_bytes = np.maximum(1, np.bincount(of_byte, minlength=total))
    out[:, : at + _PAIRS**2] /= n_bytes[:, None]
    at += _PAIRS**2
    n_words = np.bincount(of_word, minlength=total)
    share = lambda mask: np.bincount(of_word[mask], minlength=total) / np.maximum(1, n_words)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (of_word[1:] == of_word[:-1])
    two = np.zeros(len(codes), bool)
    two[2:] = (codes[2:] == codes[:-2]) & (of_word[2:] == of_word[:-2])
    begins = np.flatnonzero(first)
    upper = kind[begins] == 3
    order = np.lexsort((codes, of_word))
    again = np.zeros(len(codes), bool)
    again[order[1:]] = (codes[order[1:]] == codes[order[:-1]]) & (
        of_word[order[1:]] == of_word[order[:-1]]
    )
    out[:, at] = share(same)
    out[:, at + 1] = share(two)
    out[:, at + 2] = share(again)
    out[:, at + 3] = share(upper)
    out[:, at + 4] = share(kind[begins] >= 6)
    out[:, at + 5] = n_words / PASSAGE_WORDS
    out[:, at + 6] = np.log1p(n_bytes / np.maximum(1, n_words))
    out[:, at + 7] = n_words == 0
    return out, before


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    """Encoder, gated attention and output layer; a constant where nothing was learned."""

    constant: float | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: dict[str, np.ndarray] = field(default_factory=dict)

    def _forward(self, x, starts, bag, bags):
        p = self.layers
        h = np.tanh(x @ p["encode"] + p["encode_bias"])
        a, b = np.tanh(h @ p["value"]), _sigmoid(h @ p["gate"])
        e = (a * b) @ p["weigh"]
        e -= np.maximum.reduceat(e, starts)[bag]
        e = np.exp(e)
        w = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(h * w[:, None], starts, axis=0)
        y = _sigmoid(z @ p["out"] + p["out_bias"])
        return h, a, b, w, z, y

    def scores(self, features: np.ndarray, before: np.ndarray) -> np.ndarray:
        count = len(before) - 1
        if self.constant is not None or not count:
            return np.full(count, self.constant if self.constant is not None else 0.5)
        bag = np.repeat(np.arange(count), np.diff(before))
        x = (features - self.mean) * self.scale
        return self._forward(x, before[:-1], bag, count)[-1].astype(float)


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> AttentionModel:
    """Train on bags of passage features; one class alone gives a constant score."""
    if not len(labels) or labels.min() == labels.max():
        return AttentionModel(constant=float(labels.mean()) if len(labels) else 0.5)
    draw = np.random.default_rng(seed)
    everything = np.concatenate(bags)
    mean, spread = everything.mean(0), everything.std(0)
    model = AttentionModel(mean=mean, scale=1 / np.maximum(spread, 1e-3))
    start = lambda *shape: draw.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
    p = model.layers = {
        "encode": start(FEATURES, HIDDEN),
        "encode_bias": np.zeros(HIDDEN, np.float32),
        "value": start(HIDDEN, GATE),
        "gate": start(HIDDEN, GATE),
        "weigh": start(GATE),
        "out": start(HIDDEN),
        "out_bias": np.array(np.log(labels.mean() / (1 - labels.mean())), np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    scaled = [(b - mean) * model.scale for b in bags]
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(bags))
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = np.array([len(scaled[i]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            bag = np.repeat(np.arange(len(chosen)), sizes)
            x = np.concatenate([scaled[i] for i in chosen])
            h, a, b, w, z, y = model._forward(x, starts, bag, len(chosen))
            dy = ((y - labels[chosen]) / len(chosen)).astype(np.float32)
            dz = dy[:, None] * p["out"]
            dw = (h * dz[bag]).sum(1)
            de = w * (dw - np.add.reduceat(w * dw, starts)[bag])
            dab = de[:, None] * p["weigh"]
            da, db = dab * b * (1 - a * a), dab * a * b * (1 - b)
            dh = dz[bag] * w[:, None] + da @ p["value"].T + db @ p["gate"].T
            dx = dh * (1 - h * h)
            gradients = {
                "encode": x.T @ dx,
                "encode_bias": dx.sum(0),
                "value": h.T @ da,
                "gate": h.T @ db,
                "weigh": (a * b).T @ de,
                "out": z.T @ dy,
                "out_bias": dy.sum(),
            }
            step += 1
            for k, g in gradients.items():  # Adam
                g = g + DECAY * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                up = first[k] / (1 - 0.9**step)
                p[k] = (p[k] - rate * up / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(
                    np.float32
                )
    return model


def held_out(key: Column) -> Column:
    """True for the rows whose labels are for testing only."""
    number = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return number % 4 == 2


def train(docs: DataFrame, labels: DataFrame) -> AttentionModel:
    """Fit on at most ``SAMPLE_ROWS`` labelled documents that are not held out.

    A document with several labels counts by their majority, ties as 1; null labels and
    ids are left out. The sample takes the first documents in the order of a hash of
    their ids, texts up to ``SAMPLE_TEXT_BYTES``; what is collected is bounded by both.
    """
    known = (
        labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
        .filter("doc_id is not null and quality is not null")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_TEXT_BYTES)
    fields = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("quality", T.DoubleType()),
            T.StructField("features", T.BinaryType()),
        ]
    )
    rows = rows.select(F.col("doc_id").cast("long"), "quality", "text")
    found = rows.mapInArrow(_bags, fields).collect()
    # A repeated document is one example.
    unique = {row["doc_id"]: row for row in sorted(found, key=lambda r: (r["doc_id"], r["features"]))}
    bags = [
        np.frombuffer(row["features"], np.float32).reshape(-1, FEATURES) for row in unique.values()
    ]
    return fit(bags, np.array([row["quality"] >= 0.5 for row in unique.values()], np.float32))


def _bags(batches):
    for batch in slices(batches, size=SLICE_BYTES):
        raw, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
        features, before = passages(raw, offsets)
        bags = [features[a:b].tobytes() for a, b in zip(before, before[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("doc_id")),
                batch.column(batch.schema.get_field_index("quality")),
                pa.array(bags, pa.binary()),
            ],
            names=["doc_id", "quality", "features"],
        )


def score(docs: DataFrame, model: AttentionModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: 0 to 1, the likelihood of label 1 for each text.

    Null and empty texts are one empty passage. A column named ``out`` is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches, text, SLICE_BYTES):
            raw, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
            values = sent.value.scores(*passages(raw, offsets))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.float64())], names=schema.names
            )

    return docs.select(*[f.name for f in kept]).mapInArrow(run, schema)


def predicted(score_: str = "score") -> Column:
    return F.when(F.col(score_) >= THRESHOLD, 1).otherwise(0).cast("int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = train(docs, labels)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted().alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted as good, with the columns of ``docs``."""
    name = "__score"
    return (
        score(docs, train(docs, labels), out=name).filter(predicted(name) == 1).select(*docs.columns)
    )
