"""Quality by a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Bytes are embedded, filters of WIDTH bytes
slide over a chunk in steps of STRIDE, and each filter's largest answer in the chunk is its feature. Over the chunks of a
document the features' maxima and means go through one hidden layer to a probability. The network is fitted by Adam
on a bounded sample of labelled texts; executors score every whole text with it.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .shared import kept, stored

#: Bounds of the fit: labelled texts of each class (those of the smallest hashes), and chunks of each text (evenly over it).
EXAMPLES, CHUNKS = 1536, 24
#: Bytes of a chunk, and those by which the next one starts later.
CHUNK, STEP = 512, 448
EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 8, 8, 4, 32, 16
EPOCHS, MINI, RATE, DECAY = 22, 32, 0.004, 1e-4
#: Share of the examples of a step that are cut to a short piece, so that short texts are known as well, and its bytes.
CUT, PIECE = 0.15, (8, 160)
#: Chunks that go through the network at once, and bytes of text that are scored together.
GROUP, SLICE = 256, 1 << 20
ACCEPT = 0.5


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def chunks_of(data: bytes) -> np.ndarray:
    """(chunks, CHUNK) bytes; consecutive chunks overlap, the last one is filled up with zeros."""
    n = max(1, -(-(len(data) - CHUNK + STEP) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def piece(chunks: np.ndarray, r: np.random.Generator) -> np.ndarray:
    """A short run of bytes of one of the chunks, as the chunk of a text of its own."""
    chunk, n = chunks[r.integers(len(chunks))], int(r.integers(*PIECE))
    end = max(1, int(np.count_nonzero(chunk)))
    start = int(r.integers(max(1, end - n + 1)))
    out = np.zeros((1, CHUNK), np.uint8)
    out[0, : min(n, end - start)] = chunk[start : min(start + n, end)]
    return out


@dataclass
class Net:
    embed: np.ndarray  # (256, EMBED)
    filters: np.ndarray  # (STRIDE * EMBED, 2 * FILTERS): the filters' first and second halves
    bias: np.ndarray
    hidden: np.ndarray  # (2 * FILTERS, HIDDEN)
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def start(seed: int = 7) -> "Net":
        r = np.random.default_rng(seed)
        draw = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        embed = draw(256, EMBED, scale=0.5)
        embed[0] = 0
        zeros = lambda n: np.zeros(n, np.float32)
        return Net(embed, draw(STRIDE * EMBED, 2 * FILTERS, scale=(WIDTH * EMBED) ** -0.5), zeros(FILTERS), draw(2 * FILTERS, HIDDEN, scale=(2 * FILTERS) ** -0.5), zeros(HIDDEN), draw(HIDDEN, scale=HIDDEN**-0.5), zeros(1))

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def answers(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded blocks of STRIDE bytes, and every filter's answer at every place of the chunks."""
        blocks = self.embed[chunks].reshape(len(chunks), CHUNK // STRIDE, STRIDE * EMBED)
        halves = blocks @ self.filters
        return blocks, halves[:, :-1, :FILTERS] + halves[:, 1:, FILTERS:]

    def features(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, FILTERS): the largest answer of each filter, above zero."""
        found = [self.answers(chunks[i : i + GROUP])[1].max(1) for i in range(0, len(chunks), GROUP)]
        return np.maximum(np.concatenate(found) + self.bias, 0)

    def combine(self, features: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pooled features, hidden values and logit of each document, whose chunks begin at first."""
        sizes = np.diff(np.append(first, len(features)))[:, None]
        pooled = np.concatenate([np.maximum.reduceat(features, first), np.add.reduceat(features, first) / sizes], 1)
        hidden = np.tanh(pooled @ self.hidden + self.hidden_bias)
        return pooled, hidden, hidden @ self.out + self.out_bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        each = [chunks_of(t) for t in texts]
        first = np.cumsum([0, *map(len, each[:-1])])
        logit = self.combine(self.features(np.concatenate(each)), first)[2].astype(np.float64)
        return 1 / (1 + np.exp(-logit))

    def gradients(self, chunks: np.ndarray, first: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
        """Of the weighted logistic loss, in the order of parts."""
        blocks, answers = self.answers(chunks)
        at = answers.argmax(1)  # (chunks, FILTERS)
        features = np.maximum(np.take_along_axis(answers, at[:, None], 1)[:, 0] + self.bias, 0)
        pooled, hidden, logit = self.combine(features, first)
        d = (w * (1 / (1 + np.exp(-logit)) - y)).astype(np.float32)
        d_hidden = d[:, None] * self.out * (1 - hidden**2)
        d_pooled = d_hidden @ self.hidden.T
        sizes = np.diff(np.append(first, len(chunks)))
        doc = np.repeat(np.arange(len(first)), sizes)
        top = features == pooled[doc, :FILTERS]
        shares = np.add.reduceat(top.astype(np.float32), first)
        g = top * (d_pooled[:, :FILTERS] / shares)[doc] + (d_pooled[:, FILTERS:] / sizes[:, None])[doc]
        g *= features > 0
        row = np.arange(len(chunks))[:, None]
        halves = [np.einsum("cf,cfe->ef", g, blocks[row, at + k]) for k in (0, 1)]
        place = (at * STRIDE)[:, :, None] + np.arange(WIDTH)
        byte = chunks[row[:, :, None], place].ravel()
        taps = self.filters.reshape(STRIDE, EMBED, 2, FILTERS).transpose(2, 0, 1, 3).reshape(WIDTH, EMBED, FILTERS)
        d_embed = np.stack([np.bincount(byte, (g[:, :, None] * taps[:, e].T).ravel(), 256) for e in range(EMBED)], 1)
        d_embed[0] = 0
        return [d_embed, np.concatenate(halves, 1), g.sum(0), pooled.T @ d_hidden, d_hidden.sum(0), hidden.T @ d, d.sum(keepdims=True)]

    @staticmethod
    def fit(chunks: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> "Net":
        """chunks, label and weight of each text; the same net for the same texts."""
        net, r = Net.start(), np.random.default_rng(11)
        if not len(y):
            return net
        means, squares, step = [0.0] * 7, [0.0] * 7, 0
        weight = weight / max(weight.mean(), 1e-9)
        share = np.clip((weight * y).sum() / weight.sum(), 0.01, 0.99)
        net.out_bias[:] = np.log(share / (1 - share))
        total = EPOCHS * -(-len(y) // MINI)
        for _ in range(EPOCHS):
            order = r.permutation(len(y))
            for i in range(0, len(y), MINI):
                own = order[i : i + MINI]
                each = [piece(chunks[j], r) if r.random() < CUT else chunks[j] for j in own]
                first = np.cumsum([0, *map(len, each[:-1])])
                grads = net.gradients(np.concatenate(each), first, y[own], weight[own] / len(own))
                step += 1
                rate = RATE * (1 - step / (total + 1))
                for k, (p, g) in enumerate(zip(net.parts, grads)):
                    means[k] = 0.9 * means[k] + 0.1 * g
                    squares[k] = 0.999 * squares[k] + 0.001 * g**2
                    p -= (rate * (means[k] / (1 - 0.9**step) / (np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-7) + DECAY * p)).astype(np.float32)
        return net


def labelled_chunks(docs: DataFrame, labels: DataFrame, examples: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Chunks, label and weight of at most examples texts of each class; at most CHUNKS chunks a text reach the driver."""
    train = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    sizes = {r["quality"]: r["n"] for r in train.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [train.filter(F.col("quality") == c).orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(examples) for c in (0, 1)]
    chosen = stored(few[0].unionByName(few[1]))

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text"):
                each = chunks_of(text.as_py().encode())
                out.append(each[np.unique(np.linspace(0, len(each) - 1, CHUNKS).astype(np.int64))].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(out, pa.binary())], ["doc_id", "quality", "chunks"])

    texts = docs.join(F.broadcast(chosen), "doc_id").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
    rows = texts.mapInArrow(run, "doc_id long, quality int, chunks binary").toArrow().sort_by("doc_id")
    y = rows.column("quality").to_numpy().astype(np.int64)
    n = {c: max(1, (y == c).sum()) for c in (0, 1)}
    chunks = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, CHUNK) for x in rows.column("chunks")]
    return chunks, y, np.array([sizes.get(c, 0) / n[c] for c in y.tolist()], np.float64)


def quality(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, held_out, score, predicted for every row: how likely the text is of quality 1, and whether by ACCEPT or more.

    doc_id is an integer. The fit sees labels only of rows that are not held out, and of rows that share a doc_id the
    smallest text; conflicting labels of a document count as 0, null labels not at all. Null texts are empty ones and are
    scored like any, texts are whole however long, repeated rows score alike. Without labels the net is unfitted and
    every score lies near a half. Other columns are not read. No rows give no rows.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    net = docs.sparkSession.sparkContext.broadcast(Net.fit(*labelled_chunks(texts, labels, examples)))

    def run(batches):
        kept("quality", dict)
        own = net.value
        for batch in batches:
            score, held, size = [], [], 0
            for text in batch.column("text"):
                held.append(text.as_py().encode())
                size += len(held[-1])
                if size >= SLICE:
                    score += own.scores(held).tolist()
                    held, size = [], 0
            if held:
                score += own.scores(held).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    scored = texts.mapInArrow(run, StructType([texts.schema["doc_id"], StructField("score", DoubleType())]))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
