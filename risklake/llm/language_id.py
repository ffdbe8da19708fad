"""Language identification by word-first backoff.

A word that the model knows has the log frequency of that word in each language. For
an unseen word, every position takes the longest character n-gram that the model
knows to end there, from LONGEST characters down to one. A text's log likelihood in a
language is the sum over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.llm.scratch import dropped, kept
from risklake.llm.words import by_arrow, chunks

FOLDS, HELD_OUT = 4, 2
#: Labelled documents to learn from, and log frequencies that the model may hold.
SAMPLE_ROWS, MODEL_CELLS = 8_000, 2_000_000
LONGEST = 5
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
#: Unseen words kept by a task with their scores, and how long they may be.
KEPT_WORDS, LONGEST_KEPT = 300_000, 64
SMOOTHING = 0.5
EDGE = " "


def words_of(text: str | None) -> list[str]:
    """Runs of letters, and of number signs that are no digits, in small letters."""
    return WORD.findall((text or "").lower())


def grams(word: str, most: int = LONGEST) -> Iterator[tuple[int, int]]:
    """Character ranges of the n-grams of a word with its two edges."""
    size = len(word) + 2
    for end in range(1, size + 1):
        for start in range(max(0, end - most), end):
            yield start, end


def _rows(keys: list[tuple], n: list[int]) -> pa.RecordBatch:
    order, key, lang = zip(*keys, strict=True) if keys else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(order, pa.int32()), pa.array(key, pa.string()), pa.array(lang, pa.string()), pa.array(n, pa.int64())],
        names=["order", "key", "lang", "n"],
    )


_COUNTS = "order int, key string, lang string, n long"


def _words_counted(taught: DataFrame) -> DataFrame:
    """Occurrences of every word in every language, at order 0."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts.update((0, word, lang) for word in words_of(text))
            yield _rows(list(counts), list(counts.values()))

    rows = by_arrow(taught.select("lang", "text"), task, _COUNTS)
    return rows.groupBy("order", "key", "lang").agg(F.sum("n").alias("n"))


def _grams_counted(words: DataFrame) -> DataFrame:
    """Occurrences of the n-grams of counted words, at order n."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for word, lang, n in zip(*(batch.column(c).to_pylist() for c in ("key", "lang", "n")), strict=True):
                edged = EDGE + word + EDGE
                for a, b in grams(word):
                    counts[b - a, edged[a:b], lang] += n
            yield _rows(list(counts), list(counts.values()))

    rows = words.mapInArrow(task, _COUNTS)
    return rows.groupBy("order", "key", "lang").agg(F.sum("n").alias("n"))


@dataclass
class Languages:
    """Log frequencies by language (columns) of words and n-grams (rows), and of anything else."""

    names: list[str]
    prior: np.ndarray
    rows: list[dict[str, int]]
    table: np.ndarray
    unknown: np.ndarray
    cache: dict[str, int] = field(default_factory=dict)

    def _of_unseen(self, word: str) -> np.ndarray:
        """Sum over the positions of the longest known n-gram, each by its share of a character."""
        edged, total = EDGE + word + EDGE, np.zeros(len(self.names))
        for end in range(2, len(edged) + 1):
            for start in range(max(0, end - LONGEST), end):
                row = self.rows[end - start].get(edged[start:end])
                if row is not None:
                    total += self.table[row] / (end - start)
                    break
            else:
                total += self.unknown[1]
        return total

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood by language of each text, and whether it holds a letter."""
        known = self.rows[0]
        if len(self.cache) > KEPT_WORDS:
            self.cache = {}
        if not self.cache:
            self.seen = np.zeros((1 << 12, len(self.names)), np.float64)
        words = [words_of(t) for t in texts]
        flat = [w for per_text in words for w in per_text]
        extra: list[np.ndarray] = []
        place: dict[str, int] = {}
        offset = len(self.table)
        for w in dict.fromkeys(flat):
            if w in known or w in self.cache:
                continue
            value = self._of_unseen(w)
            if len(w) <= LONGEST_KEPT:
                k = len(self.cache)
                if k == len(self.seen):
                    self.seen = np.concatenate([self.seen, np.zeros_like(self.seen)])
                self.seen[k] = value
                self.cache[w] = k
            else:
                place[w] = len(extra)
                extra.append(value)
        cached = len(self.cache)
        rows = np.fromiter(
            (
                known[w] if w in known else offset + self.cache[w] if w in self.cache else offset + cached + place[w]
                for w in flat
            ),
            np.int64,
            len(flat),
        )
        counts = np.fromiter(map(len, words), np.int64, len(words))
        values = np.zeros((len(rows), len(self.names)))
        for low, high, source in (
            (0, offset, self.table), (offset, offset + cached, self.seen),
            (offset + cached, offset + cached + len(extra), np.array(extra).reshape(-1, len(self.names))),
        ):
            at = (rows >= low) & (rows < high)
            values[at] = source[rows[at] - low]
        sums = np.concatenate([np.zeros((1, len(self.names))), np.cumsum(values, 0)])
        lettered = np.array([any(c.isalpha() for w in per_text for c in w) for per_text in words], bool)
        return np.diff(sums[np.append(0, np.cumsum(counts))], axis=0), lettered

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and its probability; undetermined, at 0, without a letter."""
        found, lettered = self.scores(texts)
        found = found + self.prior
        best = found.argmax(1)
        chance = 1 / np.exp(found - found[np.arange(len(best)), best][:, None]).sum(1)
        named = [self.names[k] if known else UNDETERMINED for k, known in zip(best, lettered, strict=True)]
        return named, np.where(lettered, np.minimum(chance, 1.0), 0.0)


def _most(counts: DataFrame, order: Column, most: int) -> DataFrame:
    """Keys of each order seen at least 2**k times, for the least k that leaves at most ``most``."""
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    keys = counts.groupBy("order", "key").agg(F.sum("n").alias("n"))
    sizes = keys.groupBy("order", level.alias("k")).count().collect()  # at most 63 rows an order
    least = F.lit(64)
    for o in range(LONGEST + 1):
        total, at = 0, 64
        for k, size in sorted(((r["k"], r["count"]) for r in sizes if r["order"] == o), reverse=True):
            total += size
            if total > most:
                break
            at = k
        least = F.when(order == o, at).otherwise(least)
    return keys.filter(level >= least).select("order", "key")


def fitted(taught: DataFrame, model_cells: int = MODEL_CELLS) -> Languages | None:
    """The model of (text, lang) rows; None without a word.

    Holds at most ``model_cells`` log frequencies: of each order the most frequent
    keys. Words beyond them are scored like unseen ones.
    """
    words = kept(_words_counted(taught), "language-words")
    grams_of = kept(_grams_counted(words), "language-grams")
    counts = words.unionByName(grams_of)
    totals = counts.groupBy("order", "lang").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()
    names = sorted({r["lang"] for r in totals})
    if not names:
        dropped(words, grams_of)
        return None
    at = {name: k for k, name in enumerate(names)}
    total = np.zeros((LONGEST + 1, len(names)))
    for r in totals:
        total[r["order"], at[r["lang"]]] = r["n"]
    kinds = dict(counts.groupBy("order").agg(F.countDistinct("key")).collect())
    most = max(1, model_cells // (len(names) * (LONGEST + 1)))
    chosen = _most(counts, F.col("order"), most)
    table = counts.join(chosen, ["order", "key"]).select("order", "key", "lang", "n").orderBy("order", "key").toArrow()
    dropped(words, grams_of)
    rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    order, keys = table["order"].to_pylist(), table["key"].to_pylist()
    row = np.zeros(len(keys), np.int64)
    size = 0
    for i, (o, key) in enumerate(zip(order, keys, strict=True)):
        held = rows[o].setdefault(key, size)
        size += held == size
        row[i] = held
    n = np.zeros((size, len(names)))
    n[row, [at[x] for x in table["lang"].to_pylist()]] = table["n"].to_numpy()
    of_order = np.zeros(size, np.int64)
    of_order[row] = order
    room = np.array([SMOOTHING * (kinds.get(o, 0) + 1) for o in range(LONGEST + 1)])[:, None]
    floor = np.log(SMOOTHING) - np.log(total + room)
    logs = np.log(n + SMOOTHING) - np.log(total + room)[of_order]
    prior = np.log((total[0] + 1) / (total[0] + 1).sum())
    return Languages(names, prior, rows, logs, floor)


def _sampled(docs: DataFrame, sample_rows: int) -> DataFrame:
    """Up to about ``sample_rows`` labelled documents, the same number of every language where there are enough."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold != HELD_OUT))
    # Rows repeated in id, language and text teach once.
    known = known.select("doc_id", "lang", F.xxhash64("doc_id", "lang", "text").alias("_h"), "text")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    languages = sizes.count()
    share = F.shiftrightunsigned(F.xxhash64("_h", F.lit("language")), 11).cast("double") * 2.0**-53
    rate = F.lit(sample_rows / max(languages, 1)) / F.col("n")
    picked = known.join(F.broadcast(sizes), "lang").filter(share < rate)
    return picked.dropDuplicates(["_h"]).select("lang", "text")


def language(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, model_cells: int = MODEL_CELLS, text: str = "text"
) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score, the probability of the prediction.

    Learns from text and non-NULL lang of documents whose crc32(doc_id) modulo 4 is
    not 2, from about ``sample_rows`` of them, by hash, as many of each language where
    there are enough. Every whole text is judged, by its text alone. Texts that are
    NULL or hold no letter are `und` with score 0, as are all where nothing was
    learned. Documents with a NULL id do not teach and are not held out; every row
    of a repeated id has its own result. Empty tables give no rows. Needs doc_id,
    ``text`` and lang; other columns are ignored.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), "lang")
    taught = kept(_sampled(given, sample_rows), "language-sample")
    model = fitted(taught, model_cells)
    dropped(taught)
    whole = given.select(
        "doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    if model is None:
        return whole.select("doc_id", "held_out", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in chunks(map(len, texts)):
                named, chance = shared.value.predict(texts[a:b])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(named, pa.string()), pa.array(chance)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return by_arrow(whole, task, "doc_id long, held_out boolean, lang_pred string, score double")


def op11_language(spark, sf_dir: str) -> DataFrame:
    return language(spark.read.parquet(f"{sf_dir}/documents.parquet"))
