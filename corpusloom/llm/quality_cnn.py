"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks that cover all of its bytes.  Learned
filters run over the embedded bytes of a chunk, each filter's largest response
in the chunk is kept, and the chunks' logits are averaged into one probability.

Training sees a bounded sample of labelled rows inside one task; scoring is a
map over all rows with the finished weights (about 20 kB).
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import giving_back, text_slices

CHUNK = 256
STEP = 192              # chunks overlap by 64 bytes
STRIDE = 4
WIDTH = 8               # bytes a filter sees: two strides
EMBED = 8
FILTERS = 48
TRAIN_ROWS = 4000       # labelled documents, half of each class where there are enough
TRAIN_BYTES = 1 << 17   # longest text of the training sample
TRAIN_CHUNKS = 24       # chunks of one document in one epoch, drawn anew each time
EPOCHS = 12
BATCH_DOCS = 64
RATE = 0.01
SEED = 5
THRESHOLD = 0.3
BLOCK = 1024            # chunks convolved at once
PIECE = 1_000_000       # bytes of text cut into chunks at once


def cut_chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``chunks (n, CHUNK) uint8`` and the number of chunks of each text.

    The last chunk is filled up with zeros; an empty text is one chunk of zeros.
    """
    counts = np.array([max(0, -(-(len(t) - CHUNK) // STEP)) + 1 for t in texts], np.int64)
    sizes = np.array([len(t) + CHUNK + STEP for t in texts], np.int64)
    buffer = np.frombuffer(b"".join(t + bytes(CHUNK + STEP) for t in texts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(begins, counts) + inside * STEP
    return np.lib.stride_tricks.sliding_window_view(buffer, CHUNK)[starts], counts


def new_weights(rng) -> dict[str, np.ndarray]:
    scale = 1.0 / np.sqrt(WIDTH * EMBED)
    weights = {
        "embed": rng.normal(0, 0.5, (256, EMBED)),
        "filters": rng.normal(0, 2 * scale, (WIDTH * EMBED, FILTERS)),
        "bias": np.zeros(FILTERS),
        "out": rng.normal(0, 0.1, FILTERS),
        "offset": np.zeros(1),
    }
    weights["embed"][0] = 0
    return {k: v.astype(np.float32) for k, v in weights.items()}


def convolve(weights, chunks: np.ndarray) -> np.ndarray:
    """Filter responses ``(chunk, place, filter)``; a filter spans two strides."""
    half = STRIDE * EMBED
    blocks = weights["embed"][chunks].reshape(len(chunks), CHUNK // STRIDE, half)
    first = blocks[:, :-1].reshape(-1, half) @ weights["filters"][:half]
    first += blocks[:, 1:].reshape(-1, half) @ weights["filters"][half:]
    return first.reshape(len(chunks), CHUNK // STRIDE - 1, FILTERS) + weights["bias"]


def probability(weights, texts: list[bytes]) -> np.ndarray:
    """One probability per text, from all of its chunks."""
    chunks, counts = cut_chunks(texts)
    logits = np.empty(len(chunks), np.float32)
    for at in range(0, len(chunks), BLOCK):
        pooled = np.maximum(convolve(weights, chunks[at : at + BLOCK]).max(1), 0)
        logits[at : at + BLOCK] = pooled @ weights["out"]
    mean = np.add.reduceat(logits.astype(np.float64), np.cumsum(counts) - counts) / counts
    return 1 / (1 + np.exp(-np.clip(mean + float(weights["offset"][0]), -60, 60)))


def gradients(weights, chunks, counts, labels, importance):
    """Loss gradients of one batch of documents."""
    owner = np.repeat(np.arange(len(counts)), counts)
    response = convolve(weights, chunks)
    place = response.argmax(1)
    top = np.take_along_axis(response, place[:, None, :], 1)[:, 0, :]
    pooled = np.maximum(top, 0)
    begins = np.cumsum(counts) - counts
    mean = np.add.reduceat(pooled, begins, axis=0) / counts[:, None]
    logit = mean @ weights["out"] + weights["offset"][0]
    error = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - labels) * importance / len(counts)
    down = (error / counts)[owner][:, None] * weights["out"] * (top > 0)
    # only the winning window of each chunk and filter has a share
    seen = np.lib.stride_tricks.sliding_window_view(chunks, WIDTH, axis=1)[:, ::STRIDE]
    windows = seen[np.arange(len(chunks))[:, None], place]
    embedded = weights["embed"][windows].reshape(*windows.shape[:2], WIDTH * EMBED)
    to_bytes = (down[:, :, None] * weights["filters"].T[None]).reshape(-1, EMBED)
    flat = windows.reshape(-1)
    embed = np.stack(
        [np.bincount(flat, to_bytes[:, j], 256) for j in range(EMBED)], axis=1
    )
    embed[0] = 0
    return {
        "embed": embed,
        "filters": np.einsum("cf,cfw->wf", down, embedded, optimize=True),
        "bias": down.sum(0),
        "out": mean.T @ error,
        "offset": np.array([error.sum()]),
    }


def train(texts: list[bytes], labels: np.ndarray, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on the logistic loss, both classes with equal weight."""
    rng = np.random.default_rng(seed)
    weights = new_weights(rng)
    share = labels.mean() if len(labels) else 0.5
    importance = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH_DOCS):
            batch = order[at : at + BATCH_DOCS]
            drawn, counts = [], []
            for i in batch:
                chunks, _ = cut_chunks([texts[i]])
                if len(chunks) > TRAIN_CHUNKS:
                    chunks = chunks[rng.choice(len(chunks), TRAIN_CHUNKS, replace=False)]
                drawn.append(chunks)
                counts.append(len(chunks))
            found = gradients(
                weights, np.concatenate(drawn), np.array(counts), labels[batch], importance[batch]
            )
            step += 1
            for name, gradient in found.items():
                first, second = moment[name]
                first += 0.1 * (gradient - first)
                second += 0.001 * (gradient**2 - second)
                move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
                weights[name] -= (rate * move).astype(np.float32)
    return weights


def fit_quality_model(
    docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, seed: int = SEED,
    train_bytes: int = TRAIN_BYTES,
) -> dict[str, np.ndarray]:
    """Weights learned from ``docs (doc_id, text)`` and ``labels (doc_id, quality)``.

    At most about ``train_rows`` labelled rows are used, chosen by a hash of the
    id, half of each class where there are enough, and none with a text of more than
    ``train_bytes``: one task holds the sample.  Null ids, texts and labels are left
    out, an id with both labels counts as 0; without any labelled row, or any
    document, all scores are one half.
    """
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    smaller = min(sizes.get(0, 0), sizes.get(1, 0))
    shares = {}
    for value in (0, 1):
        most = max(train_rows // 2, train_rows - smaller)
        shares[value] = min(1.0, most / sizes[value]) if sizes.get(value) else 0.0
    limit = F.when(F.col("quality") == 1, shares[1]).otherwise(shares[0])
    drawn = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_003)) / F.lit(1_000_003)
    # bounded by train_rows, so it may be broadcast
    chosen = known.filter(drawn < limit)
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id"
    ).filter(F.octet_length("text") <= train_bytes)

    def learn(batches):
        rows = []
        for batch in batches:
            rows += zip(
                batch.column("doc_id").to_pylist(),
                batch.column("text").to_pylist(),
                batch.column("quality").to_pylist(),
                strict=True,
            )
        if not rows:
            return
        rows.sort(key=lambda r: (r[0], r[1]))
        texts = [r[1].encode("utf-8") for r in rows]
        weights = train(texts, np.array([r[2] for r in rows], np.float64), seed)
        yield pa.RecordBatch.from_pydict({"weights": [pickle.dumps(weights)]})

    found = sample.repartition(1).mapInArrow(giving_back(learn), "weights binary").collect()
    if not found:
        neutral = new_weights(np.random.default_rng(seed))
        return neutral | {"out": np.zeros_like(neutral["out"]), "offset": np.zeros_like(neutral["offset"])}
    return pickle.loads(found[0][0])


def piecewise(weights, texts: pa.Array) -> np.ndarray:
    """Probabilities of the texts of a batch, about a megabyte at a time."""
    found = [np.empty(0)]
    for here in text_slices(texts, PIECE):
        found.append(probability(weights, [(t or "").encode("utf-8") for t in texts[here].to_pylist()]))
    return np.concatenate(found)


def keep_quality(
    docs: DataFrame, weights, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns.

    Null texts are scored like empty ones; rows with null or repeated ids are rows
    like others; column names do not matter; an empty table stays empty.
    """

    def keep(batches):
        for batch in batches:
            scores = piecewise(weights, batch.column(text_col))
            yield batch.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(giving_back(keep), docs.schema)


def score_quality(
    docs: DataFrame, weights, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, score``: probability of label 1, one row per row.

    Null texts are scored like empty ones.  Repeated rows get equal scores; an
    empty table gives no rows; other columns, whatever their names, are not read.
    """

    def score(batches):
        for batch in batches:
            scores = piecewise(weights, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())],
                names=["doc_id", "score"],
            )

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(giving_back(score), f"doc_id {kind}, score double")
