"""Quality of texts by a small convolutional network over bytes, in numpy.

Each byte is a learned vector and one more channel, which tells that the four bytes from here stood within the last
REACH bytes before. Learned filters of WIDTH bytes run over the whole text. Overlapping chunks of two blocks pool their
outputs; the text pools its chunks: the greatest output anywhere, the greatest chunk mean, and the mean. One logistic
unit makes a probability of them. The net is fitted on the driver to a bounded sample of labelled texts and scores all
texts in tasks, in pieces of bounded size.
"""

import dataclasses
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bucket, small_batches, table, utf8

WIDTH, STRIDE, BLOCK, FILTERS, VECTOR, REACH = 8, 4, 256, 16, 4, 24
SAMPLE_PER_CLASS, SAMPLE_BYTES = 1000, 16_384   # labelled texts fitted to: so many of a class, up to this length
EPOCHS, BATCH, RATE = 8, 64, 0.01
PIECE = 1 << 19                                 # bytes scored at once
THRESHOLD, FOLDS = 0.3, 5
_PAD = 256


@dataclasses.dataclass
class Net:
    vectors: np.ndarray     # (257, VECTOR); row 256 stands after a text and is zero
    filters: np.ndarray     # (WIDTH * (VECTOR + 1), FILTERS)
    offsets: np.ndarray     # (FILTERS,)
    weights: np.ndarray     # (3 * FILTERS,)
    bias: np.ndarray        # (1,)

    def parameters(self):
        return [self.vectors, self.filters, self.offsets, self.weights, self.bias]


def _laid_out(texts):
    """Bytes of texts, each from the start of a block; first block of each text, and valid positions of each block. At least
    REACH bytes are left free between texts, so that none sees the one before or after it."""
    blocks = np.array([-(-(len(t) + REACH) // BLOCK) for t in texts])
    first = np.concatenate(([0], np.cumsum(blocks)))
    codes = np.full(first[-1] * BLOCK + WIDTH, _PAD, np.int16)
    valid = np.zeros(first[-1], np.int64)
    for text, a, b in zip(texts, first[:-1], first[1:]):
        if text:
            codes[a * BLOCK:a * BLOCK + len(text)] = np.frombuffer(text, np.uint8)
            per = BLOCK // STRIDE
            valid[a:b] = np.clip(-(-len(text) // STRIDE) - per * np.arange(b - a), 0, per)
    return codes, first, valid


def _recent(codes):
    """1 where the four bytes from here stood REACH bytes before, or less."""
    c = codes.astype(np.uint32)
    four = c[:-3] | c[1:-2] << 8 | c[2:-1] << 16 | c[3:] << 24
    found = np.zeros(len(codes), bool)
    for lag in range(2, REACH + 1):
        found[lag:-3] |= four[lag:] == four[:-lag]
    found[codes == _PAD] = False
    return found


def _inputs(codes, recent, net):
    x = np.empty((len(codes), VECTOR + 1), np.float32)
    x[:, :VECTOR] = net.vectors[codes]
    x[:, VECTOR] = recent
    halves = x[:len(codes) // STRIDE * STRIDE].reshape(-1, STRIDE * (VECTOR + 1))
    steps = (len(codes) - WIDTH) // STRIDE
    return np.concatenate((halves[:steps], halves[1:steps + 1]), axis=1)


def _forward(codes, first, valid, net, recent=None):
    """Pooled features (texts, 3 * FILTERS), and what the backward pass needs."""
    recent = _recent(codes) if recent is None else recent
    inputs = _inputs(codes, recent, net)
    out = inputs @ net.filters
    out += net.offsets
    np.maximum(out, 0, out=out)
    per = BLOCK // STRIDE
    out = out.reshape(-1, per, FILTERS)
    for block in np.flatnonzero(valid < per):
        out[block, valid[block]:] = 0
    most, total = out.max(1), out.sum(1)
    # a chunk is a block and the next one of the same text
    joined, count = total.copy(), valid.astype(np.float32)
    inner = np.ones(len(valid), bool)
    inner[first[1:] - 1] = False
    inner = np.flatnonzero(inner)
    joined[inner] += total[inner + 1]
    count[inner] += valid[inner + 1]
    chunk = joined / np.maximum(count, 1)[:, None]
    starts = first[:-1]
    size = np.maximum(np.add.reduceat(valid, starts), 1)[:, None]
    pooled = np.concatenate((np.maximum.reduceat(most, starts), np.maximum.reduceat(chunk, starts),
                             np.add.reduceat(total, starts) / size), axis=1)
    return pooled, (inputs, out, most, chunk, count, size, inner)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(texts, net) -> np.ndarray:
    """Probability of label 1 for each text; a text longer than PIECE is pooled piece by piece."""
    result, group, size = np.zeros(len(texts)), [], 0

    def flush():
        if group:
            codes, first, valid = _laid_out([texts[i] for i in group])
            pooled, _ = _forward(codes, first, valid, net)
            result[group] = _sigmoid(pooled @ net.weights + net.bias)
    for i, text in enumerate(texts):
        if len(text) > PIECE:
            result[i] = _long_score(text, net)
            continue
        if size + len(text) > PIECE:
            flush()
            group, size = [], 0
        group.append(i)
        size += BLOCK + len(text)
    flush()
    return result


def _long_score(text, net):
    """Pieces overlap by a chunk, so that each chunk is whole in one of them."""
    parts, sizes = [], []
    for a in range(0, len(text), PIECE - 2 * BLOCK):
        codes, first, valid = _laid_out([text[a:a + PIECE]])
        parts.append(_forward(codes, first, valid, net)[0][0])
        sizes.append(len(text[a:a + PIECE]))
        if a + PIECE >= len(text):
            break
    parts = np.array(parts)
    pooled = np.concatenate((parts[:, :2 * FILTERS].max(0), np.average(parts[:, 2 * FILTERS:], axis=0, weights=sizes)))
    return _sigmoid(pooled @ net.weights + net.bias)[0]


def fit(texts, labels, share: float, seed: int = 5) -> Net:
    """Fits to texts with labels 0 and 1. ``share`` is how many labels are 1 where the sample was taken: classes are
    weighted so that probabilities hold there. With one class only, or none, every score is its share."""
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.5, (257, VECTOR)).astype(np.float32),
              rng.normal(0, (WIDTH * (VECTOR + 1)) ** -0.5, (WIDTH * (VECTOR + 1), FILTERS)).astype(np.float32),
              np.zeros(FILTERS, np.float32), np.zeros(3 * FILTERS, np.float32), np.zeros(1, np.float32))
    net.vectors[_PAD] = 0
    labels = np.array(labels, np.float32)
    share = min(max(share, 1e-3), 1 - 1e-3)
    net.bias[:] = np.log(share / (1 - share))
    if not len(labels) or labels.min() == labels.max():
        return net
    mean = labels.mean()
    loads = np.where(labels > 0, share / mean, (1 - share) / (1 - mean)).astype(np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    step, laid = 0, {}
    total = EPOCHS * -(-len(texts) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            rows = order[begin:begin + BATCH]
            codes, first, valid = _laid_out([texts[i] for i in rows])
            grads = _gradients(codes, first, valid, labels[rows], loads[rows], net)
            step += 1
            rate = RATE * (1 - 0.9 * step / total)
            for p, g, (m, v) in zip(net.parameters(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            net.vectors[_PAD] = 0
    return net


def _gradients(codes, first, valid, labels, loads, net):
    pooled, (inputs, out, most, chunk, count, size, inner) = _forward(codes, first, valid, net)
    error = (loads * (_sigmoid(pooled @ net.weights + net.bias) - labels) / len(labels)).astype(np.float32)
    d_pooled = error[:, None] * net.weights
    d_most, d_chunk, d_mean = d_pooled[:, :FILTERS], d_pooled[:, FILTERS:2 * FILTERS], d_pooled[:, 2 * FILTERS:]
    text_of = np.repeat(np.arange(len(labels)), np.diff(first))
    d_total = (d_mean / size)[text_of]
    # the gradient of a maximum goes to the first place that has it
    lanes = np.arange(FILTERS)
    d_chunks = np.zeros_like(chunk)
    d_block = np.zeros_like(most)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        d_chunks[a + chunk[a:b].argmax(0), lanes] = d_chunk[i]
        d_block[a + most[a:b].argmax(0), lanes] = d_most[i]
    d_chunks /= np.maximum(count, 1)[:, None]
    d_total = d_total + d_chunks
    d_total[inner + 1] += d_chunks[inner]
    d_out = np.repeat(d_total[:, None, :], BLOCK // STRIDE, axis=1).astype(np.float32)
    block, lane = np.nonzero(d_block)
    d_out[block, out.argmax(1)[block, lane], lane] += d_block[block, lane]
    d_out[out <= 0] = 0
    d_out = d_out.reshape(-1, FILTERS)
    d_inputs = (d_out @ net.filters.T).reshape(-1, 2, STRIDE, VECTOR + 1)
    d_bytes = np.zeros((len(d_inputs) + 1, STRIDE, VECTOR + 1), np.float32)
    d_bytes[:-1] += d_inputs[:, 0]
    d_bytes[1:] += d_inputs[:, 1]
    flat = d_bytes.reshape(-1, VECTOR + 1)
    used = codes[:len(flat)]
    d_vectors = np.stack([np.bincount(used, weights=flat[:, j], minlength=257) for j in range(VECTOR)], axis=1)
    return [d_vectors, inputs.T @ d_out, d_out.sum(0), pooled.T @ error, np.array([error.sum()])]


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS,
                    max_bytes: int = SAMPLE_BYTES, folds: int = FOLDS):
    """(texts, labels, share of label 1): of each class the texts with the smallest hashes of their ids, out of the
    folds to learn from and no longer than ``max_bytes``. At most ``2 * per_class`` ids and texts reach the driver.

    Labels without a text that short are passed over before the smallest are taken. A doc_id with both labels counts as 0, of
    several texts with one doc_id the smallest is taken. Where one class has no text, a warning says so, and all texts get
    the share of label 1 among the labels as their score (a half without labels).
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")
                          ).where(F.col("quality").isin(0, 1) & (bucket("doc_id", folds) > 0))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], [], 0.5
    short = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("t")).where(
        F.octet_length("t") <= max_bytes)
    usable = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).join(short.select("doc_id"), "doc_id", "left_semi")
    chosen = {}
    for quality in (0, 1):
        for row in usable.where(F.col("quality") == quality).select("doc_id").orderBy(
                F.xxhash64("doc_id"), "doc_id").limit(per_class).collect():
            chosen[row["doc_id"]] = quality
    if len(set(chosen.values())) < 2:
        warnings.warn("labels of both qualities need texts to learn from: all texts get one score", stacklevel=2)
        return [], [], counts.get(1, 0) / sum(counts.values())
    ids = docs.sparkSession.createDataFrame([(i,) for i in chosen], "doc_id bigint")
    rows = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("t").alias("t")).orderBy("doc_id").collect()
    return ([bytes(r["t"]) for r in rows], [chosen[r["doc_id"]] for r in rows],
            counts.get(1, 0) / sum(counts.values()))


def score_of(text, net: Net):
    """The score of a text as a column. Null and empty texts have one score, that of no bytes."""
    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        return pa.array(scores(batch.to_pylist(), net))
    return score(utf8(text))


def learn(docs: DataFrame, labels: DataFrame) -> Net:
    return fit(*labelled_sample(docs, labels))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold."""
    small_batches(docs.sparkSession)
    return docs.where(score_of(docs["text"], learn(docs, labels)) >= threshold)


def op6_quality(spark, sf_dir):
    """One row per row of documents, repeated ones too; a null doc_id isn't held out."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = learn(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", (bucket("doc_id", FOLDS) == 0).alias("held_out"), score_of("text", net).alias("score")
                       ).select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
