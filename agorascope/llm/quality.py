"""Quality by a byte-level convolutional network in numpy.

Each byte has an embedding of `EMBED` numbers; `FILTERS` learned filters of `WIDTH` bytes move over the text by `STRIDE`
bytes. A text is cut into chunks of `CHUNK` bytes, each overlapping the next by half, the last filled up with zero
bytes; together they cover the whole text. The filters are max-pooled over each chunk, one hidden layer turns them into
a logit, and the mean of the logits of all chunks is the text's. It is set to the share of label 1 among all learnable
labels.

Trained on at most `EXAMPLES` labelled documents of each class, from `TRAIN_CHUNKS` chunks spread evenly over each, by
Adam with a fixed seed, in one task; its parameters are some kilobytes. Texts are scored whole, a block of chunks at a
time. Null and empty texts are one chunk of zero bytes. Repeated rows are scored each. Without labels of both classes
every score is the prior.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from agorascope.llm import labelled as L
from agorascope.llm import words as W
from agorascope.llm.exchange import free_name
from agorascope.llm.ship import ship

EXAMPLES = 1000
TRAIN_CHUNKS = 6
EPOCHS = 8
EMBED, FILTERS, HIDDEN = 8, 24, 16
WIDTH, STRIDE, CHUNK = 8, 2, 512
_HALF = CHUNK // 2
_STEPS = _HALF // STRIDE
#: Half-chunks worked on at once, which bounds a task's memory.
_BLOCK = 2048


def _new(seed: int) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    return {
        "embed": r.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        "filters": r.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "hidden": r.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": r.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32),
        "constant": np.zeros(1, np.float32),
    }


def _windows(halves: np.ndarray, model: dict) -> np.ndarray:
    """(rows, steps, WIDTH * EMBED): the embedded bytes under each filter position; rows hold _HALF + WIDTH - STRIDE bytes."""
    e = model["embed"][halves]
    flat = e.reshape(len(halves), -1)
    view = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]
    return view[:, :_STEPS]


def _half_rows(text: np.ndarray) -> np.ndarray:
    """The text's halves of chunks, each with the bytes that follow as far as a filter reaches; at least two."""
    n = max(2, -(-len(text) // _HALF))
    padded = np.zeros(n * _HALF + WIDTH, np.uint8)
    padded[: len(text)] = text
    return np.lib.stride_tricks.sliding_window_view(padded, _HALF + WIDTH - STRIDE)[:: _HALF][:n]


def _pooled(halves: np.ndarray, model: dict) -> np.ndarray:
    out = np.empty((len(halves), FILTERS), np.float32)
    for at in range(0, len(halves), 256):
        part = halves[at : at + 256]
        x = _windows(part, model).reshape(-1, WIDTH * EMBED)
        out[at : at + 256] = (x @ model["filters"]).reshape(len(part), _STEPS, FILTERS).max(axis=1)
    return out


def _logits(pooled: np.ndarray, model: dict) -> np.ndarray:
    h = np.maximum(np.maximum(pooled + model["bias"], 0) @ model["hidden"] + model["hidden_bias"], 0)
    return h @ model["out"] + model["constant"][0]


def text_logits(data: np.ndarray, offsets: np.ndarray, model: dict) -> np.ndarray:
    """The mean logit of all chunks of each text; texts are gone through in blocks of half-chunks."""
    n = len(offsets) - 1
    total, count = np.zeros(n), np.zeros(n)
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        if not held:
            return
        halves = np.concatenate([h for _, h in held])
        owner = np.repeat([d for d, _ in held], [len(h) for _, h in held])
        pooled = _pooled(halves, model)
        both = owner[1:] == owner[:-1]
        z = _logits(np.maximum(pooled[1:], pooled[:-1])[both], model)
        np.add.at(total, owner[1:][both], z)
        np.add.at(count, owner[1:][both], 1)
        held.clear()

    for d in range(n):
        rows = _half_rows(data[offsets[d] : offsets[d + 1]])
        for at in range(0, len(rows) - 1, _BLOCK):  # blocks share a half, so no chunk is left out or counted twice
            part = rows[at : at + _BLOCK + 1]
            held.append((d, part))
            size += len(part)
            if size >= _BLOCK:
                flush()
                size = 0
    flush()
    return total / np.maximum(count, 1)


def train(texts: list[np.ndarray], y: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """A network fitted to chunks spread over these texts."""
    model = _new(seed)
    r = np.random.default_rng(seed)
    chunks, labels = [], []
    for text, label in zip(texts, y, strict=True):
        rows = _half_rows(text)
        at = np.unique(np.linspace(0, len(rows) - 2, TRAIN_CHUNKS).astype(int))
        chunks += [rows[a : a + 2] for a in at]
        labels += [label] * len(at)
    chunks, labels = np.array(chunks), np.array(labels, np.float32)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = r.permutation(len(chunks))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            step += 1
            for k, g in _gradients(chunks[some], labels[some], model).items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                model[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def _gradients(chunks: np.ndarray, y: np.ndarray, model: dict) -> dict[str, np.ndarray]:
    n = len(chunks)
    halves = chunks.reshape(2 * n, -1)
    x = _windows(halves, model)
    act = (x.reshape(-1, WIDTH * EMBED) @ model["filters"]).reshape(n, 2 * _STEPS, FILTERS)
    best = act.argmax(axis=1)
    pooled = np.take_along_axis(act, best[:, None], axis=1)[:, 0] + model["bias"]
    a = np.maximum(pooled, 0)
    h0 = a @ model["hidden"] + model["hidden_bias"]
    h = np.maximum(h0, 0)
    z = h @ model["out"] + model["constant"][0]
    dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y) / n
    dh = np.outer(dz, model["out"]) * (h0 > 0)
    da = (dh @ model["hidden"].T) * (pooled > 0)
    grads = {"out": h.T @ dz, "constant": np.array([dz.sum()], np.float32), "hidden": a.T @ dh, "hidden_bias": dh.sum(0), "bias": da.sum(0)}
    rows = 2 * np.arange(n)[:, None] + best // _STEPS
    at = best % _STEPS
    under = x[rows, at]  # (n, FILTERS, WIDTH * EMBED)
    grads["filters"] = np.einsum("nfw,nf->wf", under, da)
    back = (da[:, :, None] * model["filters"].T[None]).reshape(n, FILTERS, WIDTH, EMBED)
    used = halves[rows[:, :, None], (at * STRIDE)[:, :, None] + np.arange(WIDTH)]
    grads["embed"] = np.zeros_like(model["embed"])
    np.add.at(grads["embed"], used.reshape(-1), back.reshape(-1, EMBED))
    return grads


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> dict[str, np.ndarray]:
    """The network, with the constant set to the share of label 1."""
    ship(docs.sparkSession)
    share = L.prior(labels, id_column, label_column)

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((i, y, t) for b in batches for i, y, t in zip(*(c.to_pylist() for c in b.columns), strict=True))
        y = np.array([r[1] for r in rows], float)
        model = _new(7)
        if len(y) and 0 < y.sum() < len(y):
            model = train([np.frombuffer(r[2].encode(), np.uint8) for r in rows], y)
            shift = np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
        else:
            model["out"][:] = 0
            shift = np.log(share / (1 - share))
        model["constant"] = model["constant"] + np.float32(shift)
        out = io.BytesIO()
        np.savez(out, **model)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])

    sample = L.examples(docs, L.sample_ids(labels, id_column, label_column, EXAMPLES), id_column, text_column)
    raw = sample.repartition(1).mapInArrow(one, "model binary").first()
    return dict(np.load(io.BytesIO(bytes(raw.model))))


def scored(docs: DataFrame, model: dict[str, np.ndarray], text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """All columns of `docs`, with `score` (likelihood of label 1) and `predicted`; columns of these names are replaced."""
    spark = ship(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("score", "predicted") and c != text_column])
    shared = spark.sparkContext.broadcast(model)
    name = free_name(docs, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, text_column):
                data, offsets = W.text_buffers(piece.column(piece.schema.get_field_index(text_column)))
                score = 1 / (1 + np.exp(-np.clip(text_logits(data, offsets, shared.value), -30, 30)))
                piece = piece.append_column(name, pa.array(score))
                yield piece.append_column("predicted", pa.array((score >= threshold).astype(np.int32)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, {name} double, predicted int")
