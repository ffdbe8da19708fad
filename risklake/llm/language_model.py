"""Documents scored by masked pseudo-likelihood.

A small network sees three words on each side of a masked word and predicts its
class: one of the corpus's most frequent words, or for the others one of the
endings that words share. Tasks train it on the masked words of their documents
and the job averages their weights, over a few rounds. A word's probability is that
of its class, given both sides, times its share of the class in the whole corpus;
the counts of all words stay a table. Shares of the most frequent words, of a bounded
number, are sent to the tasks; those of all others are joined to the words of the documents.
A document's score is the sum of the log probabilities of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risklake.llm.scratch import dropped, kept
from risklake.llm.words import Texts, by_arrow, mixed, text_chunks

FREQUENT, ENDINGS = 192, 64
CLASSES = FREQUENT + ENDINGS
OUTSIDE = CLASSES
SIDES = (-3, -2, -1, 1, 2, 3)
EMBEDDED, HIDDEN = 16, 32
ROUNDS, MASK_EVERY = 2, 8
BATCH, RATE = 256, 0.01
#: Words scored at once: their logits stay in a core's cache.
BLOCK = 512
#: Words whose windows are laid out at once.
SCORED = 1 << 14
#: Words outside the network's own whose shares are sent to all tasks, 16 bytes each.
COMMON = 1 << 16
UNITS = float(1 << 32)
SEED = 4


@dataclass
class Network:
    """Embeddings, one hidden layer, and a softmax over the classes."""

    parts: list[np.ndarray]

    @classmethod
    def fresh(cls, class_counts: np.ndarray) -> Network:
        """Small random weights; the output starts at the class frequencies."""
        rng = np.random.default_rng(SEED)
        inside = len(SIDES) * EMBEDDED
        share = (class_counts + 1.0) / (class_counts.sum() + CLASSES)
        return cls(
            [
                rng.normal(0, 0.3, (CLASSES + 1, EMBEDDED)), rng.normal(0, inside**-0.5, (inside, HIDDEN)),
                np.zeros(HIDDEN), rng.normal(0, 0.1, (HIDDEN, CLASSES)), np.log(share),
            ]
        ).as_single()

    def as_single(self) -> Network:
        return Network([p.astype(np.float32) for p in self.parts])

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def over(self, values: np.ndarray) -> Network:
        """A network of this shape whose weights are views of ``values``."""
        ends = np.cumsum([p.size for p in self.parts])
        pieces = np.split(values, ends[:-1])
        return Network([v.reshape(p.shape) for v, p in zip(pieces, self.parts, strict=True)])

    def filled(self, values: np.ndarray) -> Network:
        return self.over(values).as_single()

    def _hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        embedded, inner, inner_bias = self.parts[:3]
        x = embedded.take(context, axis=0).reshape(len(context), -1)
        h = x @ inner
        h += inner_bias
        return x, np.tanh(h, out=h)

    def log_chances(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probability of each target.

        Hidden values lie in [-1, 1], which bounds the logits: within the bound no
        maximum is taken off, and the biases are factors of the sum.
        """
        outer, outer_bias = self.parts[-2:]
        safe = max(np.abs(outer_bias).max(), np.abs(outer).sum(0).max()) < 40
        factors = np.exp(outer_bias) if safe else np.ones_like(outer_bias)
        out = np.zeros(len(target))
        room = np.empty((min(BLOCK, len(target)), CLASSES), outer.dtype)
        for a in range(0, len(target), BLOCK):
            _, h = self._hidden(context[a : a + BLOCK])
            own = target[a : a + BLOCK]
            z = np.matmul(h, outer, out=room[: len(h)])
            base = outer_bias[own]
            if not safe:
                z += outer_bias
                z -= z.max(1, keepdims=True)
                base = 0.0
            base = base + z[np.arange(len(z)), own]
            out[a : a + BLOCK] = base - np.log(np.exp(z, out=z) @ factors)
        return out

    def gradients(self, context: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        embedded, inner, _, outer, outer_bias = self.parts
        x, h = self._hidden(context)
        z = h @ outer
        z += outer_bias
        z -= z.max(1, keepdims=True)
        np.exp(z, out=z)
        z *= (1 / (len(z) * (z @ np.ones(CLASSES, z.dtype))))[:, None]
        z[np.arange(len(z)), target] -= 1 / len(z)
        back = z @ outer.T
        back *= 1 - h * h
        dx = back @ inner.T
        # Sums of the rows of equal context words.
        cells = context.reshape(-1, 1) * EMBEDDED + np.arange(EMBEDDED)
        sums = np.bincount(cells.ravel(), dx.ravel(), embedded.size).reshape(embedded.shape)
        return [sums.astype(embedded.dtype), x.T @ back, back.sum(0), h.T @ z, z.sum(0)]


class Trainer:
    """Adam steps on a copy of the network."""

    def __init__(self, network: Network):
        self.weights = network.flat()
        self.network = network.over(self.weights)
        self.mean, self.square = np.zeros_like(self.weights), np.zeros_like(self.weights)
        self.steps = 0

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        self.steps += 1
        scale = RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        slope = np.concatenate([g.ravel() for g in self.network.gradients(context, target)])
        self.mean += np.float32(0.1) * (slope - self.mean)
        slope *= slope
        slope -= self.square
        slope *= np.float32(0.001)
        self.square += slope
        np.sqrt(self.square, out=slope)
        slope += np.float32(1e-6)
        np.divide(self.mean, slope, out=slope)
        slope *= np.float32(scale)
        self.weights -= slope


def classes(texts: Texts, frequent: np.ndarray) -> np.ndarray:
    """Class of every word; ``frequent`` holds the sorted hashes of frequent words."""
    data = np.frombuffer(texts.data, np.uint8)
    last = data[texts.ends - 1].astype(np.int64)
    before = np.where(texts.ends - texts.starts > 1, data[np.maximum(texts.ends - 2, 0)], 0)
    found = FREQUENT + (last * 31 + before) % ENDINGS
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, texts.hashes), len(frequent) - 1)
        found = np.where(frequent[at] == texts.hashes, at, found)
    return found


class Windows:
    """Classes of the words around each place; OUTSIDE beyond the text."""

    def __init__(self, texts: Texts, found: np.ndarray):
        gap = max(SIDES)
        owner = np.repeat(np.arange(len(texts.first) - 1), texts.counts())
        self.places = np.arange(len(found)) + gap * (owner + 1)
        self.row = np.full(len(found) + gap * len(texts.first), OUTSIDE, np.int64)
        self.row[self.places] = found

    def around(self, at: np.ndarray | slice) -> np.ndarray:
        return self.row[self.places[at][:, None] + np.array(SIDES)]


def contexts(texts: Texts, found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Classes of the words on both sides of the given places, OUTSIDE beyond the text."""
    return Windows(texts, found).around(at)


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Hashes of the most frequent words of the whole corpus, the counts of all classes, and all words' counts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        for _, texts in text_chunks(batches, "text", lower=True):
            words, first, n = np.unique(texts.hashes, return_index=True, return_counts=True)
            ending = classes(texts, none)[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(ending.astype(np.int32)), pa.array(n.astype(np.int64))],
                names=["word", "ending", "n"],
            )

    rows = by_arrow(docs.select("text"), task, "word long, ending int, n long")
    counts = kept(rows.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n")), "word-counts")
    top = counts.orderBy(F.col("n").desc(), "word").limit(FREQUENT).toArrow()
    by_ending = counts.groupBy("ending").agg(F.sum("n").alias("n")).toArrow()
    hashes, n = top["word"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(hashes)
    class_counts = np.zeros(CLASSES)
    class_counts[: len(n)] = n[order]
    class_counts[by_ending["ending"].to_numpy()] += by_ending["n"].to_numpy()
    taken = dict(zip(top["ending"].to_pylist(), np.zeros(len(n)), strict=True))
    for ending, count in zip(top["ending"].to_pylist(), n.tolist(), strict=True):
        taken[ending] += count
    for ending, count in taken.items():
        class_counts[ending] -= count
    return hashes[order], class_counts, counts


def _round(docs: DataFrame, network: Network, frequent: np.ndarray, number: int) -> Network:
    """One round: every task trains on its documents; the weights are averaged by words trained on."""
    shared = docs.sparkSession.sparkContext.broadcast((network, frequent))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, frequent = shared.value
        trainer, seen = Trainer(network), 0
        for _, texts in text_chunks(batches, "text", lower=True):
            found = classes(texts, frequent)
            drawn = mixed(texts.hashes + np.arange(len(found)).astype(np.uint64) * np.uint64(ROUNDS) + np.uint64(number))
            masked = np.flatnonzero(drawn % np.uint64(MASK_EVERY) == 0)
            masked = masked[np.argsort(drawn[masked], kind="stable")]
            around = Windows(texts, found).around(masked)
            for a in range(0, len(masked), BATCH):
                trainer.step(around[a : a + BATCH], found[masked[a : a + BATCH]])
            seen += len(masked)
        if seen:
            values = trainer.weights.astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [np.arange(len(values), dtype=np.int32), values * seen, np.full(len(values), seen, np.int64)],
                names=["place", "value", "n"],
            )

    rows = by_arrow(docs.select("text"), task, "place int, value double, n long")
    mean = rows.groupBy("place").agg((F.sum("value") / F.sum("n")).alias("value")).toArrow().sort_by("place")
    shared.destroy()
    return network.filled(mean["value"].to_numpy()) if len(mean) else network


def fitted(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Network, np.ndarray, DataFrame]:
    """The network trained over all documents (a binary column ``text``), the frequent words and all words' counts."""
    frequent, class_counts, counts = _frequent(docs)
    network = Network.fresh(class_counts)
    for number in range(rounds):
        network = _round(docs, network, frequent, number)
    return network, frequent, counts


def _within_class(counts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Log share of each word in its class, in units of 1 / ``UNITS``: (word, log_share).

    Frequent words are classes of their own and have no row. The documents scored are
    those counted, so that no word is unseen.
    """
    own = [int(x) for x in frequent.view(np.int64)]
    rare = counts.filter(~F.col("word").isin(own)) if own else counts
    sizes = F.broadcast(rare.groupBy("ending").agg(F.sum("n").alias("every")))  # a row per ending
    log_share = F.round(F.log(F.col("n") / F.col("every")) * UNITS).cast("long")
    return rare.join(sizes, "ending").select("word", "n", log_share.alias("log_share"))


def _common(shares: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and log shares of up to ``most`` words: all whose count exceeds a cut.

    The cut comes from the numbers of words by eighths of a power of two of their
    counts, a few hundred rows.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = shares.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.col("step").desc()).collect()
    cut, held = None, 0
    for r in sizes:
        held += r.words
        if held > most:
            break
        cut = r.step
    if cut is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found = shares.filter(step >= cut).select("word", "log_share").toArrow()
    words = found["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    return words[order], found["log_share"].to_numpy()[order]


def scored(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, common: int = COMMON) -> DataFrame:
    """``docs`` with n_tokens, pseudo_log_likelihood and its mean, without the text.

    Words are compared with A-Z in lower case. All words of whole texts are scored.
    NULL and empty texts have no words, the sum 0 and a NULL mean. Columns named
    like a result are replaced. Repeated rows and ids stay rows of their own; an empty
    table has an empty result. ``common`` bounds the word shares sent to the tasks and
    does not change a score.
    """
    results = ("n_tokens", "pseudo_log_likelihood", "mean_log_likelihood")
    others = [c for c in docs.columns if c not in (text, *results)]
    given = docs.select(*others, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_lm_text"))
    network, frequent, counts = fitted(given.select(F.col("_lm_text").alias("text")), rounds)
    shares = kept(_within_class(counts, frequent), "lm-shares")
    shared = docs.sparkSession.sparkContext.broadcast((network, frequent, *_common(shares, common)))
    names = [*others, "_lm_n", "_lm_units", "_lm_words", "_lm_times"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, frequent, common_words, common_shares = shared.value
        for part, texts in text_chunks(batches, "_lm_text", lower=True):
            found = classes(texts, frequent)
            windows, logs = Windows(texts, found), np.zeros(len(found))
            for a in range(0, len(found), SCORED):
                at = slice(a, a + SCORED)
                logs[at] = network.log_chances(windows.around(at), found[at])
            units = np.rint(logs * UNITS).astype(np.int64)
            rare = found >= FREQUENT
            if len(common_words):
                place = np.minimum(np.searchsorted(common_words, texts.hashes), len(common_words) - 1)
                known = rare & (common_words[place] == texts.hashes)
                units[known] += common_shares[place[known]]
                rare &= ~known
            sums = np.diff(np.append(0, np.cumsum(units))[texts.first])
            ends = np.append(0, np.cumsum(rare))[texts.first]
            left, words, times = texts.hashes[rare], [], []
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                kinds, n = np.unique(left[a:b], return_counts=True)
                words.append(kinds.view(np.int64))
                times.append(n.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in others), pa.array(texts.counts(), pa.int64()), pa.array(sums, pa.int64()),
                 pa.array(words, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32()))],
                names=names,
            )

    schema = docs.select(*others).schema.add("_lm_n", "long").add("_lm_units", "long")
    rows = by_arrow(given, task, schema.add("_lm_words", T.ArrayType(T.LongType())).add("_lm_times", T.ArrayType(T.IntegerType())))
    rows = kept(rows.withColumn("_lm_row", F.monotonically_increasing_id()), "lm-rows")
    shared.destroy()
    dropped(counts)
    pairs = rows.select("_lm_row", F.explode(F.arrays_zip("_lm_words", "_lm_times")).alias("w")).select(
        "_lm_row", F.col("w._lm_words").alias("word"), F.col("w._lm_times").alias("times")
    )
    # Whole units add up to the same sum in any order.
    within = pairs.join(shares, "word").groupBy("_lm_row").agg(F.sum(F.col("log_share") * F.col("times")).alias("_lm_within"))
    total = (F.col("_lm_units") + F.coalesce("_lm_within", F.lit(0))) / UNITS
    return rows.drop("_lm_words", "_lm_times").join(within, "_lm_row", "left").select(
        *others, F.col("_lm_n").alias(results[0]), total.alias(results[1]),
        F.when(F.col("_lm_n") > 0, total / F.col("_lm_n")).alias(results[2]),
    )


def op4_pseudo_likelihood(spark, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
