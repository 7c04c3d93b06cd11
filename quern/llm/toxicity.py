"""Toxicity by nearest labelled examples.

Documents are vectors over all words of a bounded sample of labelled texts: TF-IDF, where words that mark toxic texts
weigh more and no word weighs nothing; document frequencies are counted over all documents. Words that no example has are
in no index, but they count in a text's length like the rarest word, so a text that shares a few words out of many with
an example is not near it. The marks are part of the weights, so a similarity is the cosine of these vectors, no plain
TF-IDF cosine. Labelled examples lie in a
block-max inverted index: similar examples share a block, and every word has, beside its postings, its largest weight in
each block. A text's bounds for all blocks are cheap sums of these; the most promising block is scored first, and a block
whose bound is below the k-th best cosine so far is skipped, so the nearest are exact. Words of many examples are rows of
a matrix instead of postings, for bounds and blocks alike. The nearest vote by similarity; the votes are calibrated on
the examples themselves, each scored without itself. Neighbours are the evidence.
"""

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from xxhash import xxh32_intdigest

from .shared import kept, partitions, stored

#: Bounds of the fit: labelled examples of each class (those of the smallest hashes), and bytes of their texts in all.
EXAMPLES, FIT_BYTES = 4096, 1 << 26
#: Minimum hashes that tell near copies of an example from other texts.
KINDS = 4
NEIGHBOURS = 15
#: Weight of the vote for the rate of all examples; a neighbour of cosine 0.34 has about as much.
BASE_VOTE = 0.5
#: Examples of a block; a word of at least one in WIDE examples is a row of the matrix.
BLOCK, WIDE = 64, 16
#: Texts that are searched together, and bytes of text whose words are looked up together.
BATCH, SLICE = 128, 1 << 21
#: Votes that the calibration can't tell apart still rank by this much of a score.
TILT = 1e-6
#: Score from which a document counts as toxic.
REJECT = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs of letters, digits and _ of all texts end to end, and how many each text has."""
    lists = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\pL\pN_]+")
    return lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)


def _tally(text: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word number, count) of pairs, in this order."""
    key = text * words + word
    key.sort()
    head = np.flatnonzero(np.diff(key, prepend=-1))
    return *np.divmod(key[head], max(words, 1)), np.diff(np.append(head, len(key)))


def counted(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, word number, count) of the known words of whole texts, in this order; of each text the squared length of the others.

    This is the sum of (1 + log count) squared, for words of unit weight.
    """
    words, sizes = words_of(texts)
    at = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy().astype(np.int64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    text, word, count = _tally(of[at >= 0], at[at >= 0], len(vocabulary))
    strange = (at < 0) & (pc.binary_length(words).to_numpy() > 0)
    coded = words.filter(pa.array(strange)).dictionary_encode()
    where, _, times = _tally(of[strange], coded.indices.to_numpy().astype(np.int64), len(coded.dictionary))
    return text, word.astype(np.int32), count, np.bincount(where, (1 + np.log(times)) ** 2, len(sizes))


def counted_slices(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As counted, for many texts: slice by slice, so that only one slice's words are in memory."""
    done, out = 0, [[np.zeros(0, np.int32)] for _ in range(3)]
    for part in text_slices(texts):
        text, word, count, _ = counted(part, vocabulary)
        for kept_, x in zip(out, (text + done, word, count)):
            kept_.append(x.astype(np.int32))
        done += len(part)
    return tuple(map(np.concatenate, out))


def text_slices(texts: pa.Array):
    """Parts of an array of about SLICE bytes; a text is never cut."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy()) // SLICE
    edges = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
    for a, b in zip(edges[:-1], edges[1:]):
        if a < b:
            yield texts.slice(a, b - a)


def sample_labels(labels: DataFrame, n: int = EXAMPLES) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, toxic) of at most n documents of each class, and the labelled documents that one of them stands for."""
    train = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64(F.lit("example"), "doc_id")
    few = [train.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(n) for c in (0, 1)]
    return stored(few[0].unionByName(few[1])), {c: sizes.get(c, 0) / max(1, min(n, sizes.get(c, 0))) for c in (0, 1)}


def within_bytes(fit: DataFrame, share: dict[int, float], most: int) -> tuple[DataFrame, dict[int, float]]:
    """The examples, in the order of their hashes, that fill half of so many bytes in each class; and what they stand for."""
    size = F.octet_length("text")
    total = {r["toxic"]: (r["n"], r["bytes"]) for r in fit.groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).collect()}
    if all(b <= most // 2 for _, b in total.values()):
        return fit, share
    upto = F.sum(size).over(Window.partitionBy("toxic").orderBy(F.xxhash64(F.lit("example"), "doc_id"), "doc_id"))
    few = stored(fit.withColumn("_upto", upto).filter(F.col("_upto") <= most // 2).drop("_upto"))
    left = {r["toxic"]: r["n"] for r in few.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    return few, {c: share[c] * total[c][0] / max(1, left.get(c, 0)) if c in total else share[c] for c in share}


def kinds(text: str) -> list[int]:
    """KINDS minimum hashes of three-word shingles; near copies share most of them."""
    words = text.lower().split()
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    return [min(xxh32_intdigest(g, seed) for g in grams) for seed in range(KINDS)]


def mark_weights(texts: pa.Array, toxic: np.ndarray, text: np.ndarray, word: np.ndarray, n: int) -> np.ndarray:
    """1 for each of n words, and for those more frequent in toxic texts 1 + the square root of their G statistic.

    (text, word): which words the texts hold. Toxic texts count by their kinds, so that what a group of near copies
    shares doesn't pass for a mark.
    """
    each = np.zeros((len(texts), KINDS), np.int64)
    for i in np.flatnonzero(toxic == 1):
        each[i] = kinds(texts[i].as_py())
    of_toxic = toxic[text] == 1
    pairs = [np.unique(word[of_toxic].astype(np.int64) << 32 | each[text[of_toxic], k]) >> 32 for k in range(KINDS)]
    b1 = np.min([np.bincount(p, minlength=n) for p in pairs], axis=0).astype(float)
    b0 = np.bincount(word[~of_toxic], minlength=n).astype(float)
    a1, a0 = float((toxic == 1).sum()), float((toxic == 0).sum())
    share = (b1 + b0) / max(a1 + a0, 1)
    part = lambda x, p: np.where(x > 0, x * np.log(np.maximum(x, 1e-300) / np.maximum(p, 1e-300)), 0.0)
    g = part(b1, share * a1) + part(b0, share * a0) + part(a1 - b1, (1 - share) * a1) + part(a0 - b0, (1 - share) * a0)
    return 1 + np.where(b1 > share * a1, np.sqrt(np.maximum(2 * g, 0)), 0)


def document_counts(docs: DataFrame, vocabulary) -> tuple[int, np.ndarray]:
    """Rows of docs, and those that hold each word of the broadcast vocabulary."""

    def run(batches):
        kept("toxicity", dict)
        known, rows = vocabulary.value, 0
        n = np.zeros(len(known), np.int64)
        for batch in batches:
            rows += len(batch)
            for part in text_slices(batch.column(0)):
                n += np.bincount(counted(part, known)[1], minlength=len(known))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(n[some], rows))], ["t", "n"])

    total = docs.select("text").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    t, n = total.column("t").to_numpy(), total.column("n").to_numpy()
    out = np.zeros(len(vocabulary.value), np.int64)
    out[t[t >= 0]] = n[t >= 0]
    return int(n[t < 0].sum()), out


@dataclass
class Vectors:
    """Unit vectors end to end: those of text i are ptr[i] to ptr[i + 1]."""

    ptr: np.ndarray
    word: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(n: int, text: np.ndarray, word: np.ndarray, count: np.ndarray, idf: np.ndarray, others: np.ndarray | float = 0.0) -> "Vectors":
        """others: what words without a number add to the squared length of each text."""
        w = (1 + np.log(count)) * idf[word]
        norm = np.sqrt(np.bincount(text, w * w, n) + others)
        return Vectors(np.searchsorted(text, np.arange(n + 1)), word, w / norm[text])

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def take(self, rows: np.ndarray) -> "Vectors":
        sizes = self.ptr[rows + 1] - self.ptr[rows]
        at = ranges(self.ptr[rows], sizes)
        return Vectors(np.concatenate([[0], np.cumsum(sizes)]), self.word[at], self.weight[at])


def ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers lo to lo + n of every pair, end to end."""
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())


def alike_order(v: Vectors, leaf: int) -> np.ndarray:
    """Places such that similar vectors stand together: halved again and again along their main direction."""
    out, todo = [np.zeros(0, np.int64)], [np.arange(len(v))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        own = v.take(rows)
        of = np.repeat(np.arange(len(rows)), np.diff(own.ptr))
        y = np.random.default_rng(1).standard_normal(len(rows))
        for _ in range(4):
            y -= y.mean()
            y = np.bincount(of, own.weight * np.bincount(own.word, own.weight * y[of])[own.word], len(rows))
        order = rows[np.argsort(y, kind="stable")]
        half = -(-(len(rows) // 2) // leaf) * leaf
        todo += [order[half:], order[:half]]
    return np.concatenate(out)


@dataclass
class BlockMaxIndex:
    ids: np.ndarray  # of the examples, by place; places of a block follow one another
    labels: np.ndarray
    stands_for: np.ndarray  # documents an example stands for
    column: np.ndarray  # by word: its row of the matrix, or -1
    wide: tuple[np.ndarray, np.ndarray, np.ndarray]  # cells of the matrix: row, place, weight
    ptr: np.ndarray  # by word: where its blocks begin
    block: np.ndarray  # entries of (word, block): the block, the largest weight, first posting and their number
    top: np.ndarray
    first: np.ndarray
    size: np.ndarray
    place: np.ndarray  # postings: place of the example, and weight
    value: np.ndarray

    @staticmethod
    def build(ids, labels, stands_for, vectors: Vectors, words: int) -> tuple["BlockMaxIndex", np.ndarray]:
        """The index, and the order in which it holds the examples."""
        n = len(vectors)
        order = alike_order(vectors, BLOCK)
        at = np.empty(n, np.int64)
        at[order] = np.arange(n)
        place, word, value = np.repeat(at, np.diff(vectors.ptr)), vectors.word, vectors.weight
        blocks = -(-n // BLOCK)
        wide = np.flatnonzero(np.bincount(word, minlength=words) * WIDE >= max(n, 1))
        column = np.full(words, -1)
        column[wide] = np.arange(len(wide))
        dense = column[word] >= 0
        cells = column[word[dense]].astype(np.int32), place[dense].astype(np.int32), value[dense]
        place, word, value = place[~dense], word[~dense], value[~dense]
        sort = np.lexsort((place, word))
        place, word, value = place[sort], word[sort], value[sort]
        first = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(place // BLOCK, prepend=-1) != 0))
        top = np.maximum.reduceat(value, first) if len(first) else value
        return BlockMaxIndex(
            np.asarray(ids, np.int64)[order], np.asarray(labels, np.int64)[order], np.asarray(stands_for, np.float64)[order],
            column, cells, np.searchsorted(word[first], np.arange(words + 1)),
            (place[first] // BLOCK).astype(np.int32), top, first.astype(np.int32), np.diff(np.append(first, len(place))).astype(np.int32), place.astype(np.int32), value,
        ), order

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)

    @cached_property
    def matrix(self) -> np.ndarray:
        """(wide words, places); a worker makes its own from the cells."""
        out = np.zeros((int(self.column.max(initial=-1)) + 1, self.blocks * BLOCK))
        row, place, weight = self.wide
        out[row, place] = weight
        return out

    @cached_property
    def most(self) -> np.ndarray:
        """(wide words, blocks): the largest weight."""
        return self.matrix.reshape(len(self.matrix), self.blocks, BLOCK).max(2)

    def nearest(self, vectors: Vectors, k: int, without: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and cosines of the k nearest examples of each vector, with a cosine above 0; ties go to the smaller id.

        without: for each vector a place that doesn't count.
        """
        out = []
        for start in range(0, len(vectors), BATCH):
            rows = np.arange(start, min(start + BATCH, len(vectors)))
            out += self._nearest(vectors.take(rows), k, None if without is None else without[rows])
        return out

    def _nearest(self, v: Vectors, k: int, without) -> list[tuple[np.ndarray, np.ndarray]]:
        n, blocks = len(v), self.blocks
        if not blocks:
            return [(np.zeros(0, np.int64), np.zeros(0))] * n
        left = np.zeros((n, len(self.matrix)))
        column, of = self.column[v.word], np.repeat(np.arange(n), np.diff(v.ptr))
        left[of[column >= 0], column[column >= 0]] = v.weight[column >= 0]
        bounds = left @ self.most
        held = []
        for row in range(n):
            word, w = v.word[v.ptr[row] : v.ptr[row + 1]], v.weight[v.ptr[row] : v.ptr[row + 1]]
            size = self.ptr[word + 1] - self.ptr[word]
            entry, w = ranges(self.ptr[word], size), np.repeat(w, size)
            held.append((entry, w, self.block[entry]))
            bounds[row] += np.bincount(held[-1][2], w * self.top[entry], blocks)
        scores = np.zeros((n, blocks * BLOCK))

        def score(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(0)):
                rows, own = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                scores[rows, own] = left[rows] @ self.matrix[:, own]
            for row in np.flatnonzero(wanted.any(1)):
                entry, w, block = held[row]
                live = wanted[row][block]
                entry, w = entry[live], w[live]
                size = self.size[entry]
                posting = ranges(self.first[entry], size)
                scores[row] += np.bincount(self.place[posting], np.repeat(w, size) * self.value[posting], scores.shape[1])
            if without is not None:
                scores[np.arange(n), without] = 0

        promising = np.zeros((n, blocks), bool)
        best = bounds.argmax(1)
        promising[np.arange(n), best] = True
        score(promising)
        of_best = np.take_along_axis(scores.reshape(n, blocks, BLOCK), best[:, None, None], 1)[:, 0]
        kth = np.partition(of_best, -k, axis=1)[:, -k] if k <= BLOCK else np.zeros(n)
        score((bounds >= np.maximum(kth - 1e-9, 1e-12)[:, None]) & ~promising)
        out = []
        for row in range(n):
            near = np.flatnonzero(scores[row] >= max(kth[row] - 1e-9, 1e-12))
            if len(near) > k:
                near = near[scores[row, near] >= np.partition(scores[row, near], -k)[-k] - 1e-11]
            sims = np.round(scores[row, near], 12)  # sums of equal vectors may differ in their last digits
            best = np.lexsort((self.ids[near], -sims))[:k]
            out.append((near[best], sims[best]))
        return out

    def vote(self, found: np.ndarray, sims: np.ndarray, base: float) -> float:
        """Share of toxic votes; a vote falls with the distance 1 - cosine. base has a vote of its own, the only one where no example is near."""
        if not len(found):
            return base
        v = self.stands_for[found] * sims / (1.02 - sims)
        own = BASE_VOTE * self.stands_for.mean()
        return float(((v * self.labels[found]).sum() + own * base) / (v.sum() + own))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the weighted non-decreasing fit of y to x: the first and last x of every pool of equal fit."""
    values, at = np.unique(x, return_inverse=True)
    weight = np.bincount(at, w)
    pools: list[list[float]] = []  # weight, weighted sum of y, first and last x
    for pool in zip(weight, np.bincount(at, w * y), values, values):
        pools.append(list(pool))
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    ends = [(p[k], p[1] / p[0]) for p in pools for k in ((2, 3) if p[2] < p[3] else (2,))]
    return np.array([e[0] for e in ends]), np.array([e[1] for e in ends])


@dataclass
class Model:
    index: BlockMaxIndex
    idf: np.ndarray
    base: float
    rarest: float  # idf of a word that no document has

    @staticmethod
    def fit(ids, texts: pa.Array, toxic: np.ndarray, stands_for: list[float], vocabulary: pa.Array, rows: int, df: np.ndarray) -> "Model":
        """rows, df: documents in all, and those that hold each word."""
        text, word, count = counted_slices(texts, vocabulary)
        idf = (np.log((rows + 1) / (df + 1)) + 1) * mark_weights(texts, toxic, text, word, len(vocabulary))
        vectors = Vectors.of(len(texts), text, word, count, idf)
        index, order = BlockMaxIndex.build(ids, toxic, stands_for, vectors, len(vocabulary))
        none = np.diff(vectors.ptr)[order] == 0
        w, y = index.stands_for, index.labels
        base = float((w * y)[none].sum() + (w * y).sum() / max(w.sum(), 1)) / float(w[none].sum() + 1) if len(w) else 0.0
        return Model(index, idf, base, float(np.log(rows + 1) + 1))

    def votes(self, texts: pa.Array, vocabulary: pa.Array, without: np.ndarray | None = None) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Share of toxic votes, places and cosines of the nearest examples, of every text."""
        *known, others = counted(texts, vocabulary)
        near = self.index.nearest(Vectors.of(len(texts), *known, self.idf, others * self.rarest**2), NEIGHBOURS, without)
        return [(self.index.vote(*x, self.base), *x) for x in near]


def calibration(examples: DataFrame, model, vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Knots that turn votes into rates: of the examples, each voted on without itself, on the executors."""

    def run(batches):
        kept("toxicity", dict)
        m = model.value
        order = np.argsort(m.index.ids)
        for batch in batches:
            at = order[np.searchsorted(m.index.ids[order], batch.column("doc_id").to_numpy())]
            done = 0
            for part in text_slices(batch.column("text")):
                own = at[done : done + len(part)]
                votes = [x[0] for x in m.votes(part, vocabulary.value, own)]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(votes, pa.float64())], ["place", "vote"])
                done += len(part)

    got = examples.select("doc_id", "text").repartition(partitions(examples.sparkSession)).mapInArrow(run, "place long, vote double").toArrow()
    if not len(got):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    at, index = got.column("place").to_numpy(), model.value.index
    return isotonic(got.column("vote").to_numpy(), index.labels[at].astype(float), index.stands_for[at])


def fitted(fit: DataFrame, share: dict[int, float], docs: DataFrame) -> tuple:
    """Broadcast vocabulary and model of the examples (doc_id, text, toxic); share: documents one of each class stands for."""
    sc, rows = docs.sparkSession.sparkContext, fit.toArrow()
    texts = rows.column("text").combine_chunks() if len(rows) else pa.array([], pa.string())
    slices = [pc.unique(words_of(part)[0]) for part in text_slices(texts)] if len(texts) else [pa.array([], pa.string())]
    words = pc.unique(pa.concat_arrays(slices))
    vocabulary = sc.broadcast(words.filter(pc.not_equal(words, "")))
    toxic = rows.column("toxic").to_numpy().astype(np.int64)
    counts = document_counts(docs, vocabulary)
    return vocabulary, sc.broadcast(Model.fit(rows.column("doc_id").to_numpy(), texts, toxic, [share[y] for y in toxic.tolist()], vocabulary.value, *counts))


def toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (doc_id, toxic, similarity of the three nearest) for every row.

    carry: further columns of docs that come along as they are.

    doc_id is an integer. The fit sees labels only of rows that are not held out, and of rows that share a doc_id the
    smallest text. Null and empty texts, and texts without any word of the examples, get the rate of labelled texts like
    them; texts are scored whole however long. Conflicting labels of a document count as toxic, null labels not at all;
    without labels every score is 0. Examples of equal similarity count by the smaller doc_id. Repeated rows score alike;
    other columns are not read. No rows give no rows.
    """
    # A carried text isn't sent to the workers twice.
    along = docs.select("doc_id", *carry) if "text" in carry else docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"), *carry)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chosen, share = sample_labels(labels, examples)
    fit = stored(docs.join(F.broadcast(chosen), "doc_id").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))
    fit, share = within_bytes(fit, share, FIT_BYTES)
    vocabulary, model = fitted(fit, share, docs)
    knots = calibration(fit, model, vocabulary)

    def run(batches):
        kept("toxicity", dict)
        m, known_words = model.value, vocabulary.value
        ids, labels_ = m.index.ids, m.index.labels
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("similarity", pa.float64())]))
        for batch in batches:
            done = 0
            for part in text_slices(pc.fill_null(batch.column(read), "")):
                coded = part.dictionary_encode()  # equal texts are looked up once
                each = m.votes(coded.dictionary, known_words)
                shown = [[{"doc_id": int(ids[i]), "toxic": int(labels_[i]), "similarity": float(s)} for i, s in zip(found[:3], sims)] for _, found, sims in each]
                votes = np.array([x[0] for x in each])
                score = pa.array((np.interp(votes, *knots) + TILT * votes).clip(0, 1), pa.float64()).take(coded.indices)
                own = batch.slice(done, len(part))
                columns = [*(own.column(n) for n in names), score, pa.array(shown, kind).take(coded.indices)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "score", "evidence"])
                done += len(part)

    names, read = ["doc_id", *carry], "text" if "text" in carry else "_text"
    more = StructType.fromDDL("score double, evidence array<struct<doc_id:bigint,toxic:int,similarity:double>>")
    schema = StructType(along.select(*names).schema.fields + more.fields)
    out = along.mapInArrow(run, schema)
    predicted = (F.col("score") >= REJECT).cast("int").alias("predicted")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted, "evidence", *carry)
