"""Document scores of a gated recurrent language model with a class-factored softmax.

The corpus is counted first: every token of every training document, by Spark.
The most frequent words (``shortlist`` less two) are the model's outputs, with
one output for the end of a document and one for all other words; these share
its probability in proportion to their counts plus one, with room for words
never seen, so every text has a probability.

Outputs are ordered by count and cut into classes of equal size.  The
probability of an output is that of its class times its own within the class,
so a token costs two small softmaxes.  The recurrent unit is a GRU whose input
side is a table by token.  Training is truncated back-propagation in NumPy with
Adam: tokens run in parallel streams of whole documents, windows of ``steps``
tokens are unrolled, and the state is carried from window to window and
cleared at document ends.  A warm start comes from a documented, bounded
number of tokens in one task; then every task continues from it over all the
training documents it holds, and Spark averages the weights by tokens seen.
Biases start from the counts.

Scoring runs the documents of a batch side by side, longest first, window by
window with the state carried, so whole documents get their likelihood and a
batch needs memory for its states and one window.

Counts of words outside the shortlist are looked up where the texts are cut if
they are among the most frequent (``listed`` at most, a bounded table in the
tasks' closures), and by a join on the word if they are not, so the join has
the long tail of the words only.  Which way a count is found changes no result.

Edge cases: a null text is the empty text (one token, its end); a null id is
not held out; repeated rows are scored each; without training documents every
count is 0 and the biases are even; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T

OTHER, END = 0, 1                # outputs that are no words
BOUND = 60.0                     # of a logit, either way
SLICE = 8 << 20                  # bytes of text cut at once; the arrays for it take some 15 times as much


@dataclass(frozen=True)
class Settings:
    shortlist: int = 1024        # outputs
    classes: int = 32
    hidden: int = 24
    streams: int = 512           # documents side by side in training
    steps: int = 16              # tokens unrolled
    warm_tokens: int = 1_500_000
    warm_rate: float = 0.01
    rate: float = 0.003
    listed: int = 1 << 17        # words whose counts every task has


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _word_codes(part: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(offsets, codes, distinct words)`` with A-Z in lower case."""
    offs, codes, distinct = T.word_parts(part, marks=False)
    lowered = pc.ascii_lower(distinct).dictionary_encode()
    return offs, lowered.indices.to_numpy(zero_copy_only=False)[codes], lowered.dictionary


# ----------------------------------------------------------------- the counts

def word_counts(texts: DataFrame) -> DataFrame:
    """word, c: how often each word occurs in the column ``text``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(T.filled(batch.column(0)), SLICE):
                _, codes, words = _word_codes(part)
                yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)))], ["word", "c"])

    return texts.select("text").mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def listed_counts(counts: DataFrame, limit: int) -> pa.Table:
    """word, c: at most ``limit`` of the most frequent words, all those from some count on."""
    step = F.floor(F.log2("c") * 16)  # a step is some 4 % more
    words, steps = 0, []
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).toLocalIterator():
        words += r["count"]
        if words > limit:
            break
        steps.append(r["step"])
    return counts.where(step >= steps[-1] if steps else F.lit(False)).toArrow()


@dataclass
class Vocabulary:
    """The shortlist and the corpus totals; outputs are other, end, then the words."""

    words: list[str]
    counts: np.ndarray           # by output
    n_train: int                 # tokens, ends included
    n_types: int                 # distinct tokens, the end included
    other_mass: int              # counts plus one of all other words, and one for words never seen
    listed: pa.Table             # word, c of the words whose counts need no join


# -------------------------------------------------------------------- the net

class Net:
    """The recurrent unit and its outputs; parameters are views into one vector."""

    def __init__(self, settings: Settings, weights: np.ndarray | None = None):
        h, v, c = settings.hidden, settings.shortlist, settings.classes
        self.settings, self.per_class = settings, -(-v // c)
        shapes = {"table": (v, 3 * h), "U": (h, 3 * h), "Wc": (h, c), "bc": (c,),
                  "Wo": (c, h, self.per_class), "bo": (c, self.per_class)}
        size = sum(int(np.prod(s)) for s in shapes.values())
        self.weights = np.zeros(size, np.float32) if weights is None else weights.astype(np.float32)
        at = 0
        self.parts = {}
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            self.parts[name] = slice(at, at + n), shape
            at += n

    def views(self, vector: np.ndarray) -> dict[str, np.ndarray]:
        return {k: vector[s].reshape(shape) for k, (s, shape) in self.parts.items()}

    def start(self, counts: np.ndarray, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        p = self.views(self.weights)
        for name, scale in (("table", 0.1), ("U", 0.2), ("Wc", 0.05), ("Wo", 0.05)):
            p[name][:] = rng.standard_normal(p[name].shape) * scale
        padded = np.full(self.settings.classes * self.per_class, 1e-6)
        padded[:len(counts)] = counts + 0.5
        by_class = padded.reshape(self.settings.classes, -1)
        p["bc"][:] = np.log(by_class.sum(1) / by_class.sum())
        p["bo"][:] = np.log(by_class / by_class.sum(1, keepdims=True))

    def step(self, p: dict[str, np.ndarray], h: np.ndarray, tokens: np.ndarray):
        """The next states, and what back-propagation needs."""
        n = h.shape[1]
        x, g = np.take(p["table"], tokens, axis=0, mode="clip"), h @ p["U"]
        gates = x[:, :2 * n] + g[:, :2 * n]
        np.negative(gates, out=gates)
        np.minimum(gates, 30, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r, gn = gates[:, :n], gates[:, n:], g[:, 2 * n:]
        new = r * gn
        new += x[:, 2 * n:]
        np.tanh(new, out=new)
        after = h - new
        after *= z
        after += new
        return after, (z, r, gn, new)

    def outputs(self, p: dict[str, np.ndarray], h: np.ndarray, tokens: np.ndarray, grad: dict | None = None,
                weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probabilities of ``tokens`` after states ``h``; with ``grad``, also the states' gradient."""
        classes, place = tokens // self.per_class, tokens % self.per_class
        order = np.argsort(classes.astype(np.uint16), kind="stable")
        h, classes, place = h[order], classes[order], place[order]
        rows = np.arange(len(h))
        logits = h @ p["Wc"]
        logits += p["bc"]
        np.clip(logits, -BOUND, BOUND, out=logits)
        e = np.exp(logits)
        total = e @ np.ones(e.shape[1], np.float32)
        logp = logits[rows, classes] - np.log(total)
        dh = None
        if grad is not None:
            weight = weight[order]
            d = e
            d *= (weight / total)[:, None]
            d[rows, classes] -= weight
            grad["Wc"] += h.T @ d
            grad["bc"] += d.sum(0)
            dh = d @ p["Wc"].T
        cuts = np.searchsorted(classes, np.arange(self.settings.classes + 1)).tolist()
        spans = [(c, slice(a, b)) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        own = np.empty((len(h), self.per_class), h.dtype)
        for c, at in spans:
            np.matmul(h[at], p["Wo"][c], out=own[at])
            own[at] += p["bo"][c]
        np.clip(own, -BOUND, BOUND, out=own)
        logp += own[rows, place]
        e = np.exp(own, out=own)
        total = e @ np.ones(e.shape[1], np.float32)
        logp -= np.log(total)
        if grad is not None:
            e *= (weight / total)[:, None]
            e[rows, place] -= weight
            one = np.ones(len(h), np.float32)
            for c, at in spans:
                d = e[at]
                grad["Wo"][c] += h[at].T @ d
                grad["bo"][c] += one[at] @ d
                dh[at] += d @ p["Wo"][c].T
        back = np.empty_like(order)
        back[order] = rows
        return logp[back], None if dh is None else dh[back]

    def train(self, tokens: np.ndarray, rate: float) -> None:
        """One pass over tokens (documents one after another, each with its end) in parallel streams."""
        s = self.settings
        streams = int(max(1, min(s.streams, len(tokens) // (8 * s.steps))))
        length = -(-len(tokens) // (streams * s.steps)) * s.steps
        padded = np.full(streams * length, END, np.int64)
        padded[:len(tokens)] = tokens
        real = (np.arange(streams * length) < len(tokens)).astype(np.float32)
        padded, real = padded.reshape(streams, length), real.reshape(streams, length)
        p, vector = self.views(self.weights), np.zeros_like(self.weights)
        grad = self.views(vector)
        m, v = np.zeros_like(vector), np.zeros_like(vector)
        h = np.zeros((streams, s.hidden), np.float32)
        n_windows, n = length // s.steps, s.hidden
        changes = np.empty((s.steps, streams, 4 * n), np.float32)  # by the state's part of the new state, then by the input
        for k in range(n_windows):
            own = np.ascontiguousarray(padded[:, k * s.steps:(k + 1) * s.steps].T)
            weight = real[:, k * s.steps:(k + 1) * s.steps].T.ravel()
            on = (own != END).astype(np.float32)[:, :, None]
            vector[:] = 0
            before, kept = [], []
            for t in range(s.steps):
                before.append(h)
                h, saved = self.step(p, h, own[t])
                kept.append(saved)
                h *= on[t]
            flat = np.concatenate(before)
            scale = 1.0 / max(1.0, float(weight.sum()))
            ids = own.ravel()
            _, dh_out = self.outputs(p, flat, ids, grad, weight * np.float32(scale))
            dh_out = dh_out.reshape(s.steps, streams, n)
            dh = np.zeros_like(h)
            turned = np.concatenate([p["U"][:, 2 * n:], p["U"][:, :2 * n]], axis=1).T
            for t in reversed(range(s.steps)):
                z, r, gn, new = kept[t]
                d = changes[t]
                dh *= on[t]
                left = 1 - z
                dn = np.multiply(dh * left, 1 - new * new, out=d[:, 3 * n:])
                np.multiply(dh * (before[t] - new), z * left, out=d[:, n:2 * n])
                dr = np.multiply(dn, r, out=d[:, :n])
                np.multiply(dr * gn, 1 - r, out=d[:, 2 * n:3 * n])
                dh *= z
                dh += d[:, :3 * n] @ turned
                dh += dh_out[t]
            every = changes.reshape(-1, 4 * n)
            states = flat.T @ every[:, :3 * n]
            grad["U"][:, :2 * n] += states[:, n:]
            grad["U"][:, 2 * n:] += states[:, :n]
            inputs, listed = every[:, n:], ids != OTHER  # the other words are most of all tokens
            grad["table"][OTHER] += (~listed).astype(np.float32) @ inputs
            at = np.flatnonzero(listed)
            at = at[np.argsort(ids[at].astype(np.uint16), kind="stable")]
            cut = np.flatnonzero(np.diff(ids[at], prepend=-1))
            if len(cut):
                grad["table"][ids[at[cut]]] += np.add.reduceat(inputs[at], cut)
            size = float(np.sqrt(vector @ vector))
            if size > 1.0:
                vector /= size
            m += 0.1 * (vector - m)
            v += 0.01 * (vector * vector - v)
            now = rate * (1 - 0.9 * k / n_windows)
            corrected = np.sqrt(v / (1 - 0.99 ** (k + 1))) + 1e-6
            self.weights -= np.float32(now / (1 - 0.9 ** (k + 1))) * m / corrected

    def score(self, tokens: np.ndarray, starts: np.ndarray, window: int = 16384) -> np.ndarray:
        """The natural log-likelihood of each document, ``tokens[starts[i]:starts[i + 1]]``."""
        p = self.views(self.weights)
        sizes = np.diff(starts)
        order = np.argsort(-sizes, kind="stable")
        sizes, begin = sizes[order], starts[:-1][order]
        total = np.zeros(len(sizes))
        h = np.zeros((len(sizes), self.settings.hidden), np.float32)
        active, held = len(sizes), ([], [], [])

        def flush():
            if held[0]:
                logp, _ = self.outputs(p, np.concatenate(held[0]), np.concatenate(held[1]))
                total[:] += np.bincount(np.concatenate(held[2]), logp, len(total))
                for x in held:
                    x.clear()

        waiting = 0
        for t in range(int(sizes[0]) if len(sizes) else 0):
            while sizes[active - 1] <= t:
                active -= 1
            h = h[:active]
            now = tokens[begin[:active] + t]
            for x, y in zip(held, (h, now, np.arange(active))):
                x.append(y)
            waiting += active
            if waiting >= window:
                flush()
                waiting = 0
            h, _ = self.step(p, h, now)
        flush()
        out = np.empty(len(sizes))
        out[order] = total
        return out


# ------------------------------------------------------------------ in Spark

def _encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, held_out, n_tokens, outputs (16-bit, one per token), and what is known of a text's other words.

    That is their number, how many are listed, the sum of log10(count + 1) of these, and the rest: rare and times of each.
    """
    place = pa.array(vocabulary.words, pa.string())
    listed = vocabulary.listed.column("word").combine_chunks()
    listed_log = np.append(np.log10(vocabulary.listed.column("c").to_numpy() + 1.0), 0.0)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in T.slices(T.filled(batch.column(2)), SLICE):
                offs, codes, words = _word_codes(part)
                known = pc.fill_null(pc.index_in(words, place), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = np.where(known >= 0, known + 2, OTHER)[codes]
                starts = offs + np.arange(len(offs))
                tokens = np.insert(ids, offs[1:], END).astype("<u2")
                entry = pc.fill_null(pc.index_in(words, listed), -1).to_numpy(zero_copy_only=False)  # the last is 0
                other = ids == OTHER
                n_other = T.per_text(offs, other)
                other_log = np.concatenate([[0.0], np.cumsum(np.where(other, listed_log[entry][codes], 0.0))])
                rare = np.flatnonzero(other & (entry < 0)[codes])
                owner = np.searchsorted(offs, rare, side="right") - 1
                other_listed = n_other - np.bincount(owner, minlength=len(part))
                pair = np.sort(owner * np.int64(len(words) + 1) + codes[rare])
                first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])[:len(pair)])
                times = np.diff(np.append(first, len(pair)))
                pair = pair[first]
                ends = np.searchsorted(pair, np.arange(len(part) + 1) * np.int64(len(words) + 1))
                data = pa.py_buffer(tokens.tobytes())
                blob = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer((2 * starts).astype(np.int32)), data])
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)),
                     pa.array(np.diff(starts)), blob, pa.array(n_other), pa.array(other_listed),
                     pa.array(np.diff(other_log[offs])),
                     pa.ListArray.from_arrays(offsets, words.take(pa.array(pair % (len(words) + 1)))),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                    ["doc_id", "held_out", "n_tokens", "outputs", "n_other", "other_listed", "other_log", "rare", "times"])
                at += len(part)

    return docs.mapInArrow(encode, "doc_id long, held_out boolean, n_tokens long, outputs binary, n_other long, "
                                   "other_listed long, other_log double, rare array<string>, times array<long>")


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(tokens, starts)`` of a batch's outputs."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").astype(np.int64), np.concatenate([[0], np.cumsum(lengths)])


def _trained(rows: DataFrame, settings: Settings, weights: np.ndarray, rate: float) -> np.ndarray:
    """The weights after each task's pass over its rows, averaged by tokens."""
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen = Net(settings, weights), 0
        for batch in batches:
            tokens, _ = _tokens(batch.column(0))
            if len(tokens):
                net.train(tokens, rate if not seen else rate / 3)
                seen += len(tokens)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(weights) + 1, dtype=np.int32)),
                 pa.array(np.append(net.weights.astype(np.float64) * seen, seen))], ["at", "x"])

    sums = rows.select("outputs").mapInArrow(train, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas()
    if not len(sums):
        return weights
    out = np.zeros(len(weights) + 1)
    out[sums["at"]] = sums["x"]
    return (out[:-1] / out[-1]).astype(np.float32)


def warm_rows(learned: DataFrame, share: int) -> DataFrame:
    """One of about ``share`` rows, in row order in one task; all tasks scan, and only these rows move."""
    return learned.where(F.pmod(F.xxhash64("row"), F.lit(share)) == 0).repartition(1).sortWithinPartitions("row")


def score_documents(docs: DataFrame, folder: str, settings: Settings = Settings(), held: Column | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``.

    ``held`` says which rows are not learned from.  Intermediate tables are
    written below ``folder``, which all machines share.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (held_out(F.col(id_col)) if held is None else held).alias("held_out"), F.col(text_col).alias("text"))
    word_counts(rows.where("not held_out")).write.parquet(f"{folder}/counts")
    counts = spark.read.schema("word string, c long").parquet(f"{folder}/counts")
    n_docs = rows.where("not held_out").select("doc_id").count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.orderBy(F.desc("c"), "word").limit(settings.shortlist - 2).collect()
    known = sum(r["c"] for r in top)
    rest = total["n"] - known
    vocabulary = Vocabulary([r["word"] for r in top], np.array([rest, n_docs, *[r["c"] for r in top]]),
                            total["n"] + n_docs, total["v"] + (n_docs > 0), rest + total["v"] - len(top) + 1,
                            listed_counts(counts, settings.listed))
    encoded = _encode(rows, vocabulary).withColumn("row", F.monotonically_increasing_id())
    encoded.write.parquet(f"{folder}/encoded")
    encoded = spark.read.parquet(f"{folder}/encoded")
    learned = encoded.where("not held_out")
    net = Net(settings)
    net.start(vocabulary.counts)
    if vocabulary.n_train:
        share = max(1, round(vocabulary.n_train / settings.warm_tokens))
        net = Net(settings, _trained(warm_rows(learned, share), settings, net.weights, settings.warm_rate))
        net = Net(settings, _trained(learned, settings, net.weights, settings.rate))
    denominator = float(vocabulary.n_train + vocabulary.n_types + 1)
    weights, counted, base = net.weights, vocabulary.counts > 0, np.log10((vocabulary.counts + 1) / denominator)
    other = float(np.log10(vocabulary.other_mass))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Net(settings, weights)
        for batch in batches:
            tokens, starts = _tokens(batch.column(batch.schema.get_field_index("outputs")))
            logp = net.score(tokens, starts) / np.log(10)
            listed = tokens != OTHER
            total = np.concatenate([[0], np.cumsum(np.where(listed, base[tokens], 0.0))])
            n_listed = np.concatenate([[0], np.cumsum(listed & counted[tokens])])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(7)], pa.array(np.diff(n_listed[starts])),
                 pa.array(np.diff(total[starts])), pa.array(logp)],
                ["row", "doc_id", "held_out", "n_tokens", "n_other", "other_listed", "other_log", "n_listed", "base_listed", "model"])

    scored = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_other", "other_listed", "other_log", "outputs").mapInArrow(
        score, "row long, doc_id long, held_out boolean, n_tokens long, n_other long, other_listed long, other_log double, "
               "n_listed long, base_listed double, model double")
    rare = (encoded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
            .select("row", F.col("w.rare").alias("word"), F.col("w.times").alias("times")).join(counts, "word"))
    sums = rare.groupBy(F.col("row").alias("r")).agg(  # of words met in training; the others add nothing
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare_log"))
    n_known = F.col("n_listed") + F.col("other_listed") + F.coalesce("rare_known", F.lit(0).cast("long"))
    rare_log = F.col("other_log") + F.coalesce("rare_log", F.lit(0.0))
    return scored.join(sums, F.col("row") == F.col("r"), "left").select(
        "doc_id", "held_out", "n_tokens", n_known.alias("n_known"), F.lit(vocabulary.n_train).cast("long").alias("train_tokens"),
        (F.col("base_listed") + rare_log - F.col("n_other") * F.lit(float(np.log10(denominator)))).alias("base_score"),
        (F.col("model") + rare_log - F.col("n_other") * F.lit(other)).alias("score"))
