"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A word's input is its own vector (words of the vocabulary) beside the mean of its byte-trigram vectors (all words,
so that changed spellings are seen). Texts are read whole, in windows of WINDOW words that overlap by OVERLAP; each
window is read in both directions, pooled by attention into one logit, and a text's score is that of its most toxic
window. Training is in numpy, on the driver, over at most TRAIN_TOXIC toxic and TRAIN_CLEAN other labelled rows of at most TRAIN_CHARS
characters, taken in the order of a hash, for STEPS batches of BATCH windows however many they are: clean texts give windows that are all
clean, a toxic text its window that is most toxic so far.

Cases: null, empty texts and texts without a letter or digit have one empty window and get its score. Labels other than
0 and 1 and null ones are left out; without labels of both kinds the score is the share of toxic ones (0 without any).
Repeated rows give repeated rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, crc_mod, cut
from .gru import Adam, backward, forward, init, sigmoid
from .words import _VALUE, ALNUM, Lookup, buffers, mix, pieces, spans

WINDOW, OVERLAP, HIDDEN, WORD_DIM, CHAR_DIM, TRIGRAMS = 32, 8, 8, 8, 8, 2048
VOCABULARY, TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS, STEPS, BATCH = 20_000, 1200, 2400, 20_000, 600, 256


def read_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, their byte trigrams and where each word's begin; then the words of all texts as
    numbers of distinct ones, and where each text's begin."""
    data, where = buffers(texts)
    hs, begins, keys, grams, sizes = [], [], [], [], []
    for at, to, starts_in in pieces(data, where, ALNUM):
        begin, end, h = spans(data, at, to, starts_in, ALNUM)
        hs.append(h)
        begins.append(begin + at)
        key, first = np.unique(h, return_index=True)
        b = np.where(ALNUM[data[at:to]], _VALUE[data[at:to]], 0)
        n = (end - begin)[first]
        place = np.repeat(begin[first], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        left = np.where(place == np.repeat(begin[first], n), 0, b[np.maximum(place - 1, 0)])
        right = np.where(place == np.repeat(end[first] - 1, n), 0, b[np.minimum(place + 1, len(b) - 1)])
        gram = mix((left << np.uint64(20)) + (b[place] << np.uint64(10)) + right) % np.uint64(TRIGRAMS)
        keys.append(key)
        grams.append(gram.astype(np.int16))
        sizes.append(n)
    if not hs:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, np.zeros(1, dtype=np.int64), none, np.zeros(len(where), dtype=np.int64)
    h, at = np.concatenate(hs), np.searchsorted(np.concatenate(begins), where, "left")
    all_keys, all_sizes, all_grams = np.concatenate(keys), np.concatenate(sizes), np.concatenate(grams)
    key, first, back = np.unique(all_keys, return_index=True, return_inverse=True)
    starts = np.cumsum(all_sizes) - all_sizes
    n = all_sizes[first]
    place = np.repeat(starts[first], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    number, done = np.empty(len(h), dtype=np.int32), 0
    for part, own in zip(hs, np.split(back, np.cumsum([len(k) for k in keys])[:-1])):
        number[done : done + len(part)] = own[np.searchsorted(key[own], part)]
        done += len(part)
    return key, all_grams[place], np.concatenate(([0], np.cumsum(n))), number, at


def windows(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and length of all windows; the last window of a text ends where it ends."""
    n = np.diff(at)
    step = WINDOW - OVERLAP
    count = np.maximum(1, -(-(n - OVERLAP) // step))
    text = np.repeat(np.arange(len(n)), count)
    first = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * step
    first = np.minimum(first, np.maximum(0, n[text] - WINDOW))
    return text, at[text] + first, np.minimum(WINDOW, n[text])


class Network:
    def __init__(self, keys: np.ndarray, leaning: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        size = WORD_DIM + CHAR_DIM
        self.lookup = Lookup(keys)
        self.share: float | None = None
        self.p = {"word": init(rng, len(keys) + 1, WORD_DIM, scale=0.05), "char": init(rng, TRIGRAMS, CHAR_DIM, scale=0.3), "v": init(rng, 2 * HIDDEN, 2 * HIDDEN), "a": init(rng, 2 * HIDDEN, 1), "o": init(rng, 2 * HIDDEN, 1), "ob": np.array([-1.0], dtype=np.float32)}
        self.p["word"][:-1, 0] = leaning
        for d in "fb":
            self.p |= {f"x{d}": init(rng, size, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, dtype=np.float32), f"u{d}": init(rng, HIDDEN, 3 * HIDDEN)}

    def inputs(self, place: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Input vectors of distinct words, given as numbers in the vocabulary and trigrams; a zero one last."""
        x = np.zeros((len(place) + 1, WORD_DIM + CHAR_DIM), dtype=np.float32)
        x[:-1, :WORD_DIM] = self.p["word"][place]
        for lo in range(0, len(place), 20_000):
            hi = min(len(place), lo + 20_000)
            part = self.p["char"][grams[starts[lo] : starts[hi]]]
            x[lo:hi, WORD_DIM:] = np.add.reduceat(part, starts[lo:hi] - starts[lo], axis=0) / np.diff(starts[lo : hi + 1])[:, None]
        return x

    def logits(self, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows: ids and mask (WINDOW, B)."""
        p = self.p
        h, tapes = [], {}
        zero = np.zeros((ids.shape[1], HIDDEN), dtype=np.float32)
        for d, way in (("f", slice(None)), ("b", slice(None, None, -1))):
            table = x @ p[f"x{d}"] + p[f"b{d}"] if not isinstance(x, dict) else x[d]
            got = forward(table[ids[way]], p[f"u{d}"], zero, mask[way], keep)
            if keep:
                got, tapes[d] = got
            h.append(got[way])
        h = np.concatenate(h, axis=2)
        t = np.tanh(h @ p["v"])
        s = np.where(mask, (t @ p["a"])[:, :, 0], -30.0)
        w = np.exp(s - s.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", w, h)
        z = pooled @ p["o"][:, 0] + p["ob"][0]
        return (z, h, t, w, pooled, tapes) if keep else z

    def gradients(self, place, grams, starts, ids, mask, y, weight):
        """Of the mean cross-entropy of these windows, whose words are numbers of distinct ones (len(place): none)."""
        used, ids = np.unique(ids, return_inverse=True)
        ids = ids.reshape(mask.shape)
        words = used[used < len(place)]
        n = np.diff(starts)[words]
        gram = grams[np.repeat(starts[words], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        x = self.inputs(place[words], gram, np.concatenate(([0], np.cumsum(n))))
        p = self.p
        z, h, t, w, pooled, tapes = self.logits(x, ids, mask, keep=True)
        dz = ((sigmoid(z) - y) * weight / len(y)).astype(np.float32)
        g = {"o": (pooled * dz[:, None]).sum(axis=0)[:, None], "ob": dz.sum(keepdims=True)}
        dpool = dz[:, None] * p["o"][:, 0]
        dh = w[:, :, None] * dpool
        dw = np.einsum("tbh,bh->tb", h, dpool)
        ds = w * (dw - (w * dw).sum(axis=0)) * mask
        g["a"] = np.einsum("tb,tbh->h", ds, t)[:, None]
        dt = ds[:, :, None] * p["a"][:, 0] * (1 - t * t)
        g["v"] = np.einsum("tbh,tbk->hk", h, dt)
        dh = (dh + dt @ p["v"].T).astype(np.float32)
        dx = np.zeros_like(x)
        for d, way, cols in (("f", slice(None), slice(0, HIDDEN)), ("b", slice(None, None, -1), slice(HIDDEN, None))):
            dproj, g[f"u{d}"] = backward(np.ascontiguousarray(dh[way][:, :, cols]), tapes[d], p[f"u{d}"], mask[way])
            dproj *= mask[way][:, :, None]
            g[f"b{d}"] = dproj.sum(axis=(0, 1))
            flat, to = dproj.reshape(-1, 3 * HIDDEN), ids[way].ravel()
            g[f"x{d}"] = x[to].T @ flat
            np.add.at(dx, to, flat @ p[f"x{d}"].T)
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], place[words], dx[: len(words), :WORD_DIM])
        np.add.at(g["char"], gram, np.repeat(dx[: len(words), WORD_DIM:] / n[:, None], n, axis=0))
        g["word"][-1] = 0
        return {k: g[k] for k in p}

    def best(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The greatest logit of each text's windows, and how many windows it has."""
        key, grams, starts, number, at = read_words(texts)
        x = self.inputs(self.lookup(key), grams, starts)
        tables = {d: x @ self.p[f"x{d}"] + self.p[f"b{d}"] for d in "fb"}
        text, first, length = windows(at)
        out = np.full(len(at) - 1, -np.inf)
        for lo in range(0, len(text), 2048):
            some = slice(lo, lo + 2048)
            ids, mask = self.slots(number, first[some], length[some], len(key))
            np.maximum.at(out, text[some], self.logits(tables, ids, mask))
        return out, np.bincount(text, minlength=len(out))

    @staticmethod
    def slots(number: np.ndarray, first: np.ndarray, length: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
        place = np.arange(WINDOW)[:, None]
        mask = place < length
        padded = number if len(number) else np.zeros(1, dtype=np.int32)
        return np.where(mask, padded[np.minimum(first + place, len(padded) - 1)], none), mask


def train(texts: pa.Array, y: np.ndarray) -> Network:
    """Of labelled texts."""
    key, grams, starts, number, at = read_words(texts)
    own = np.repeat(np.arange(len(y)), np.diff(at))
    pairs = np.unique(own.astype(np.int64) * max(1, len(key)) + number)
    seen = [np.bincount((pairs % max(1, len(key)))[y[pairs // max(1, len(key))] == k], minlength=len(key)) for k in (0, 1)]
    n = [(y == 0).sum(), (y == 1).sum()]
    lean = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    known = np.flatnonzero(seen[0] + seen[1] > 4)
    known = known[np.argsort(-np.abs(lean[known]) * np.sqrt((seen[0] + seen[1])[known]), kind="stable")][:VOCABULARY]
    net = Network(key[known], np.clip(lean[known] * np.minimum(1, (seen[0] + seen[1])[known] / 20) / 2, -2, 2).astype(np.float32))
    if not n[0] or not n[1]:
        net.share = float(n[1] / len(y)) if len(y) else 0.0
        return net
    text, first, length = windows(at)
    place = net.lookup(key)
    adam, rng = Adam(net.p, 0.01), np.random.default_rng(11)
    hint = np.zeros(len(key) + 1)
    hint[known] = lean[known]
    sums = np.concatenate(([0.0], np.cumsum(np.maximum(0, hint[number] - 1))))
    value = sums[first + length] - sums[first]
    done = 0
    while done < STEPS:
        order = np.lexsort((-value, text))
        rank = np.arange(len(text)) - np.searchsorted(text, text)  # windows stand in the order of texts
        clean = np.flatnonzero(y[text] == 0)
        some = rng.permutation(np.concatenate((order[rank < 1 + (y[text] == 0)], rng.permutation(clean)[: 3 * len(y)])))
        for lo in range(0, len(some), BATCH):
            if done == STEPS:
                break
            own = some[lo : lo + BATCH]
            ids, mask = net.slots(number, first[own], length[own], len(key))
            goal = y[text[own]].astype(np.float32)
            adam.rate = 0.01 * (1 - done / (STEPS + 1))
            done += 1
            adam.step(net.gradients(place, grams, starts, ids, mask, goal, np.where(goal > 0, 2.0, 1.0)))
        x = net.inputs(place, grams, starts)
        tables = {d: x @ net.p[f"x{d}"] + net.p[f"b{d}"] for d in "fb"}
        value = np.concatenate([net.logits(tables, *net.slots(number, first[lo : lo + 4096], length[lo : lo + 4096], len(key))) for lo in range(0, len(text), 4096)])
    return net


def sample(docs: DataFrame, labels: DataFrame, label: str) -> tuple[pa.Array, np.ndarray]:
    """At most TRAIN_TOXIC and TRAIN_CLEAN labelled texts of at most TRAIN_CHARS characters, the first in the order of a hash of the id."""
    known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y")).distinct()
    short = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= TRAIN_CHARS)
    ids = cut(short.select("doc_id").join(known, "doc_id").withColumn("o", F.xxhash64("doc_id")), "toxicity-ids")  # texts are read for the chosen ids only, never dealt
    parts = []
    for y, n in ((0, TRAIN_CLEAN), (1, TRAIN_TOXIC)):
        first = cut(ids.where(F.col("y") == y).orderBy("o", "doc_id").limit(n).distinct(), "toxicity-chosen")
        parts.append(short.select("doc_id", "text").join(F.broadcast(first), "doc_id").select("text", "y", "o", "doc_id").orderBy("o", "doc_id", "text").limit(n).toArrow())
    rows = pa.concat_tables(parts).sort_by([(c, "ascending") for c in ("y", "o", "doc_id", "text")])
    return rows.column("text").combine_chunks(), rows.column("y").to_numpy().astype(np.int64)


def held_out_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, fold: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted, n_windows; learns from labels of rows whose crc32(doc_id as text) mod ``fold`` is not 0."""
    arrow_limits(docs.sparkSession)
    net = train(*sample(docs, labels.where(crc_mod("doc_id", fold) != 0), label))
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            z, n = net.best(batch.column(1))
            score = np.full(len(z), net.share) if net.share is not None else sigmoid(z)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(np.round(score.astype(float), 6)), pa.array(n)], names=["doc_id", "score", "n_windows"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, n_windows long")
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", fold) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_windows")
