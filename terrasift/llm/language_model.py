"""Gated recurrent language model with a class-factored softmax, beside corpus counts of every token.

Counts: one pass over the training texts gives the count of every distinct token, so what is gathered
grows with the corpus. Model: the commonest MODEL_WORDS tokens, ranked, class k holding the ranks from k * k on (common words
stand in small classes), and one more class for all rarer ones; within that class a token has probability
(c+1) / (N_rare + V_rare + 1), so unseen tokens have their share. It is trained in numpy by backpropagation through WINDOW
tokens at a time, with the state carried on from window to window: first over pieces of START_CHARS characters from hashed
positions of START_DOCS texts, for a start, then once over every training text. For that, texts are dealt to ROUNDS rounds by hash;
in a round each task trains a copy on all of its texts, and the copies are averaged by their tokens for the next. Scoring reads
whole texts in windows, the state carried over. Results depend on how the texts are split into tasks.

About COUNTED of the commonest tokens' counts travel to the tasks (a fixed size); every other token of a text is joined
with the counts table. Hashes of 64 bits stand for tokens.

Cases: null, empty and blank texts are the end token alone. Repeated rows give repeated rows. No training texts:
N and V are 0, base_score is 0 for each, and the model is its starting one. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, crc_mod, cut
from .gru import Adam, backward, forward, init
from .words import Lookup, hashes

MODEL_WORDS, COUNTED, HELD = 4095, 1 << 19, 1 << 20
HIDDEN, WINDOW, STREAMS, START_DOCS, START_CHARS, EPOCHS = 24, 16, 48, 1200, 2400, 3
ROUNDS, SHARD_STREAMS, SHARD_RATE, PIECES, ROWS, SOME, MOST = 2, 384, 0.003, 64, 1 << 15, 2048, np.float32(60)
END = np.uint64(0x5851F42D4C957F2D)
LOG10 = float(np.log(10.0))


def token_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, n) of all texts: hashes of words, and END once a text. A task adds up to about HELD tokens before it sends them on."""
    arrow_limits(texts.sparkSession)

    def packed(token: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            h, at = hashes(batch.column(0))
            token, n = np.unique(h, return_counts=True)
            held.append((np.append(token, END), np.append(n, len(at) - 1)))
            count += len(token) + 1
            if count > HELD:
                held = [_added(held)]
                count = len(held[0][0])
            if count > HELD:
                yield packed(*held.pop())
                count = 0
        if held:
            yield packed(*_added(held))

    return texts.select(text_col).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens of (tokens, counts) and their sums."""
    token, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(token)
    token, n = token[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    return token[first], np.add.reduceat(n, first)


class Model:
    """Embeddings, recurrent layer and output classes; ids: 0 is END, 1.. the words by rank, the last is any rarer one."""

    def __init__(self, words: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.words = words  # with END
        ids = np.arange(words + 1)
        self.cls = np.floor(np.sqrt(ids)).astype(np.int16)
        self.classes = int(self.cls[words - 1]) + 2
        self.cls[words] = self.classes - 1
        self.ones = np.ones(ROWS, dtype=np.float32)
        self.p = {
            "x": init(rng, words + 1, 3 * HIDDEN, scale=0.1), "u": init(rng, HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, dtype=np.float32),
            "c": init(rng, HIDDEN, self.classes, scale=0.05), "cb": np.zeros(self.classes, dtype=np.float32),
            "w": init(rng, words, HIDDEN, scale=0.05), "wb": np.zeros(words, dtype=np.float32),
        }

    def start(self, n: np.ndarray, rare: float) -> None:
        """Biases from the counts of the words, END first, and of all rarer tokens."""
        n = n.astype(np.float64) + 1
        self.p["wb"][:] = np.log(n)
        by_class = np.add.reduceat(n, np.arange(self.classes - 1) ** 2)
        self.p["cb"][:] = np.log(np.append(by_class, rare + 1) / (n.sum() + rare + 1))

    def output(self, h: np.ndarray, y: np.ndarray, grads: dict | None = None):
        """Natural log probabilities of ids y after states h; with grads: adds to them and gives the states' gradient."""
        out, dh = np.empty(len(y)), np.empty_like(h) if grads is not None else None
        for lo in range(0, len(y), ROWS):
            some = slice(lo, lo + ROWS)
            order = np.argsort(self.cls[y[some]], kind="stable")
            got, back = self._sorted(h[some][order], y[some][order], grads)
            out[lo + order] = got
            if grads is not None:
                dh[lo + order] = back
        return (out, dh) if grads is not None else out

    def _sorted(self, h: np.ndarray, y: np.ndarray, grads: dict | None):
        """output() for rows in the order of their classes."""
        p, cls, rows = self.p, self.cls[y], np.arange(len(y))
        out, dh = np.empty(len(y)), np.empty_like(h) if grads is not None else None
        for lo in range(0, len(y), SOME):  # a part at a time, which a core's cache holds
            some = slice(lo, lo + SOME)
            e = h[some] @ p["c"]
            e += p["cb"]
            np.minimum(e, MOST, out=e)
            out[some] = e[rows[: len(e)], cls[some]]
            np.exp(e, out=e)
            total = e @ self.ones[: self.classes]
            out[some] -= np.log(total)
            if grads is not None:
                inverse = 1 / total
                dh[some] = p["c"].T[cls[some]] - (e @ p["c"].T) * inverse[:, None]
                grads["c"] -= (h[some] * inverse[:, None]).T @ e
                grads["cb"] -= inverse @ e
        bound = np.searchsorted(cls, np.arange(self.classes + 1))
        if grads is not None:
            there = np.flatnonzero(np.diff(bound))
            grads["cb"] += np.diff(bound)
            grads["c"][:, there] += np.add.reduceat(h, bound[there], axis=0).T
        for k in range(1, self.classes - 1):  # the first class is END alone, the last is told apart by counts
            a, b = bound[k], bound[k + 1]
            lo, hi = k * k, min((k + 1) * (k + 1), self.words)
            if a == b or hi - lo < 2:
                continue
            w, own, at = p["w"][lo:hi], h[a:b], (rows[: b - a], y[a:b] - lo)
            e = own @ w.T
            e += p["wb"][lo:hi]
            np.minimum(e, MOST, out=e)
            chosen = e[at]
            np.exp(e, out=e)
            total = e @ self.ones[: hi - lo]
            out[a:b] += chosen - np.log(total)
            if grads is not None:
                e *= (-1 / total)[:, None]
                e[at] += 1
                grads["w"][lo:hi] += e.T @ own
                grads["wb"][lo:hi] += self.ones[: b - a] @ e
                dh[a:b] += e @ w
        return out, dh

    def train(self, ids: np.ndarray) -> None:
        """Over one long sequence of texts, each closed by END, dealt to STREAMS readers."""
        steps = (len(ids) - 1) // STREAMS
        if steps < 1:
            return
        ids = np.concatenate(([0], ids))[: steps * STREAMS + 1]
        x, y = ids[:-1].reshape(STREAMS, steps).T, ids[1:].reshape(STREAMS, steps).T
        adam = Adam(self.p, 0.004)
        for epoch in range(EPOCHS):
            adam.rate = 0.004 * (1 - epoch / EPOCHS)
            self._pass(x, y, adam)

    def learn(self, ids: np.ndarray, adam: Adam, streams: int) -> int:
        """Once over the ids, dealt to ``streams`` readers; gives how many were read: all but a rest of less than ``streams``."""
        steps = len(ids) // streams
        x, y = np.concatenate(([0], ids))[: steps * streams], ids[: steps * streams]
        self._pass(x.reshape(streams, steps).T, y.reshape(streams, steps).T, adam)
        return steps * streams

    def _pass(self, x: np.ndarray, y: np.ndarray, adam: Adam) -> None:
        h = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
        for t in range(0, len(x), WINDOW):
            xs, ys = x[t : t + WINDOW], y[t : t + WINDOW]
            grads = {k: np.zeros_like(v) for k, v in self.p.items()}
            h[xs[0] == 0] = 0  # a new text starts from nothing
            states, tape = forward(self.p["x"][xs] + self.p["b"], self.p["u"], h, keep=True)
            _, dh = self.output(states.reshape(-1, HIDDEN), ys.ravel(), grads)
            dx, grads["u"] = backward(dh.reshape(states.shape).astype(np.float32), tape, self.p["u"])
            flat, order = dx.reshape(-1, dx.shape[2]), np.argsort(xs, axis=None, kind="stable")
            ids = xs.ravel()[order]
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            grads["x"][ids[first]] = np.add.reduceat(flat[order], first, axis=0)
            grads["b"] += dx.sum(axis=(0, 1))
            scale = -1.0 / xs.size
            adam.step({k: g * np.float32(scale) for k, g in grads.items()})
            h = states[-1].copy()

    def score(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Natural log probability of each text's ids (END last), texts side by side in windows, states carried over."""
        n = np.diff(at)
        order = np.argsort(-n, kind="stable")
        length, first = n[order], at[:-1][order]
        total = np.zeros(len(n))
        h = np.zeros((len(n), HIDDEN), dtype=np.float32)
        table = self.p["x"] + self.p["b"]
        held: list = []
        count = 0
        for t in range(0, int(length.max(initial=0)), WINDOW):
            live = int(np.searchsorted(-length, -t, "left"))
            for lo in range(0, live, 2048):
                hi = min(live, lo + 2048)
                place = np.arange(t, t + WINDOW)[:, None]
                inside = place < length[lo:hi]
                where = np.minimum(first[lo:hi] + place, len(ids) - 1)
                x = np.where(place > 0, ids[np.maximum(where - 1, 0)], 0)
                states = forward(table[x], self.p["u"], h[lo:hi])
                h[lo:hi] = states[-1]
                held.append((states[inside], ids[where[inside]], np.broadcast_to(order[lo:hi], inside.shape)[inside]))
                count += len(held[-1][1])
                if count > 16384:
                    total += self._sum(held, len(n))
                    held, count = [], 0
        return total + self._sum(held, len(n))

    def _sum(self, held: list, n: int) -> np.ndarray:
        if not held:
            return np.zeros(n)
        states, y, own = (np.concatenate(x) for x in zip(*held))
        return np.bincount(own, weights=self.output(states, y), minlength=n)


def _ids(texts: pa.Array, rank: Lookup, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ranks (-1: not counted), hashes, model ids with END after each text, and where the texts' ids start."""
    h, at = hashes(texts)
    place = rank(h)
    n = np.diff(at)
    ends = np.cumsum(n + 1) - 1
    ids = np.zeros(len(h) + len(n), dtype=np.int64)
    inside = np.ones(len(ids), dtype=bool)
    inside[ends] = False
    ids[inside] = np.where((place >= 0) & (place < words - 1), place + 1, words)
    return place, h, ids, np.concatenate(([0], ends + 1))


def trained(texts: DataFrame, model: Model, keys: np.ndarray) -> int:
    """Train model, whose words are keys, once on every text of texts (text); gives the number of tokens that were read."""
    sent, words = texts.sparkSession.sparkContext.broadcast((model, keys)), model.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, keys = sent.value
        model = Model(words)
        model.p = {k: v.copy() for k, v in start.p.items()}
        adam, rank, left, read = Adam(model.p, SHARD_RATE), Lookup(keys), np.zeros(0, dtype=np.int64), 0
        for batch in batches:
            left = np.concatenate((left, _ids(batch.column(0), rank, words)[2]))
            done = model.learn(left, adam, min(SHARD_STREAMS, max(1, len(left) // (8 * WINDOW))))
            left, read = left[done:], read + done
        if len(left):
            read += model.learn(left, adam, 1)
        if read:
            flat = np.concatenate([v.ravel() for v in model.p.values()])
            parts = [x.tobytes() for x in np.array_split(flat, PIECES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array([read] * PIECES, pa.int64()), pa.array(parts, pa.binary())], names=["piece", "n", "p"])

    def add(table: pa.Table) -> pa.Table:
        n, total = table.column("n").to_pylist(), 0.0
        for k, part in zip(n, table.column("p")):
            total = total + k * np.frombuffer(part.as_py(), dtype=np.float32).astype(np.float64)
        mean = (total / sum(n)).astype(np.float32).tobytes()
        return pa.table({"piece": pa.array([table.column("piece")[0].as_py()], pa.int32()), "n": pa.array([sum(n)], pa.int64()), "p": pa.array([mean], pa.binary())})

    schema = "piece int, n long, p binary"
    rows = sorted(texts.select("text").mapInArrow(run, schema).groupBy("piece").applyInArrow(add, schema).collect(), key=lambda r: r.piece)
    sent.unpersist()
    if not rows:
        return 0
    flat, at = np.concatenate([np.frombuffer(r.p, dtype=np.float32) for r in rows]), 0
    for v in model.p.values():
        v[...] = flat[at : at + v.size].reshape(v.shape)
        at += v.size
    return rows[0].n


def _commonest(counts: DataFrame) -> DataFrame:
    """The tokens of the greatest counts, COUNTED of them at most; of the count that isn't reached whole, a share by hash."""
    have = 0
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("v")).orderBy(F.desc("n")).toLocalIterator():  # there are few unlike counts
        if have + r.v > COUNTED:
            share = (COUNTED - have) / r.v
            return counts.where((F.col("n") > r.n) | ((F.col("n") == r.n) & (F.pmod(F.xxhash64("token"), F.lit(1 << 20)) < int(share * (1 << 20)))))
        have += r.v
    return counts


def _pieces(training: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text): START_CHARS characters, or a few less so that words are whole, from a hashed position of each of START_DOCS texts."""
    n, text = F.length(text_col), F.col(text_col)
    at = F.pmod(F.xxhash64(id_col, text_col, F.lit(2)), F.greatest(n - START_CHARS + 1, F.lit(1))).cast("int") + 1
    some = training.where(n > 0).select(F.xxhash64(id_col, text_col).alias("_o"), (n > START_CHARS).alias("_cut"), F.substring(text, at, F.lit(START_CHARS)).alias("text"))
    white = "\\x20\\x09-\\x0D"
    return some.orderBy("_o", "text").limit(START_DOCS).select(F.when(F.col("_cut"), F.regexp_replace("text", f"^[^{white}]*[{white}]|[{white}][^{white}]*$", "")).otherwise(F.col("text")).alias("text"))


def score(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score, a row a text of docs, learning from ``training``."""
    spark = docs.sparkSession
    arrow_limits(spark)
    counts = cut(token_counts(training, text_col), "counts")
    end = F.col("token") == int(END.view(np.int64))
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), F.coalesce(F.sum(F.when(end, F.col("n"))), F.lit(0)).alias("end")).first()
    head = _commonest(counts.where(~end)).toArrow()  # about COUNTED tokens
    keys, c = head.column("token").to_numpy().astype(np.int64).view(np.uint64), head.column("n").to_numpy().astype(np.int64)
    order = np.lexsort((keys.view(np.int64), -c))
    keys, c = keys[order], c[order]
    words = min(MODEL_WORDS, len(keys)) + 1
    n_rare, v_rare = int(whole.n) - int(whole.end) - int(c[: words - 1].sum()), max(0, int(whole.v) - words)

    model = Model(words)
    model.start(np.concatenate(([int(whole.end)], c[: words - 1])), n_rare)
    _, _, ids, _ = _ids(_pieces(training, id_col, text_col).toArrow().column(0), Lookup(keys[: words - 1]), words)
    model.train(ids)  # a start for the rounds over all texts
    for k in range(ROUNDS):
        trained(training.where(F.pmod(F.xxhash64(id_col, text_col, F.lit(1)), F.lit(ROUNDS)) == k).select(F.col(text_col).alias("text")), model, keys[: words - 1])

    sent = spark.sparkContext.broadcast((keys, np.log10(c + 1.0).astype(np.float64), model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs, model = sent.value
        rank, key = Lookup(keys), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = batch.num_rows
            place, h, ids, at = _ids(batch.column(1), rank, words)
            own = np.repeat(np.arange(rows), np.diff(at) - 1)
            known = place >= 0
            log = np.where(known, logs[place] if len(logs) else 0.0, 0.0)
            rare = place >= words - 1
            pairs = own[~known], h[~known]
            order = np.lexsort((pairs[1], pairs[0]))
            d, t = pairs[0][order], pairs[1][order]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(d)), dtype=bool), (d[1:] != d[:-1]) | (t[1:] != t[:-1]))))
            times = np.diff(np.append(first, len(d))).astype(np.int32)
            sizes = np.concatenate(([0], np.cumsum(np.bincount(d[first], minlength=rows))))
            total = lambda keep: np.bincount(own[keep], minlength=rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(key, key + rows)), batch.column(0).cast(pa.int64()), pa.array(np.diff(at)), pa.array(total(known)), pa.array(np.bincount(own, weights=log, minlength=rows).astype(float)),
                pa.array(model.score(ids, at) / LOG10), pa.array(total(~(known & ~rare))), pa.array(np.bincount(own[rare], weights=log[rare], minlength=rows).astype(float)),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(t[first].view(np.int64))), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(times)),
            ], names=["key", "doc_id", "n_tokens", "seen", "log_seen", "log_model", "n_rare", "log_rare", "tokens", "times"])
            key += rows

    kept = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "key long, doc_id long, n_tokens long, seen long, log_seen double, log_model double, n_rare long, log_rare double, tokens array<long>, times array<int>"), "scored")
    others = kept.select("key", F.explode(F.arrays_zip("tokens", "times")).alias("z")).select("key", F.col("z.tokens").alias("token"), F.col("z.times").alias("times"))
    others = others.join(counts, "token").groupBy("key").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_more"))
    more, log_more = F.coalesce("more", F.lit(0)), F.coalesce("log_more", F.lit(0.0))
    n, v = int(whole.n), int(whole.v)
    rounded = lambda x: F.round(x, 6)
    return kept.drop("tokens", "times").join(others, "key", "left").select(
        "doc_id", "n_tokens", (F.col("seen") + more + (1 if n else 0)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        rounded(F.col("log_seen") + log_more + float(np.log10(int(whole.end) + 1)) - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"),
        rounded(F.col("log_model") + F.col("log_rare") + log_more - F.col("n_rare") * float(np.log10(n_rare + v_rare + 1))).alias("score"),
    )


def held_out_scores(docs: DataFrame) -> DataFrame:
    """score() of all docs, learning from those whose crc32(doc_id as text) mod 7 is not 2, with held_out (it is 2)."""
    training = docs.where((crc_mod("doc_id", 7) != 2) | F.col("doc_id").isNull())
    return score(docs, training).withColumn("held_out", F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False)))
