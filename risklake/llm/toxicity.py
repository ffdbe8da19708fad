"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated bigram models, one of toxic and one of ordinary documents, share
their lowest order, the words of both classes together. Counts are continuation
counts: a word or bigram counts once for each different pair of words around it, of
which every document gives one, so neither a text that repeats itself nor copies of
a text pass for evidence. Each class keeps
of a count what is left after discounts: that of Kneser and Ney for counts of 1, 2
and more, estimated from counts of counts, what the shared order explains, and of the
rest a share that falls with the standard errors it amounts to (half at MARGIN). All
discounted mass goes to the order below, so that words which both classes use alike,
or which one class happens to hold once, move little.
A document's score is the mean log ratio over its words, calibrated by a logistic
curve on labelled documents that the counts have not seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from risklake.llm.scratch import dropped, kept, shuffles_dropped
from risklake.llm.words import NOT_PLAIN, Texts, by_arrow, mixed, text_chunks

FOLDS = 5
HELD_OUT, CALIBRATION = 0, 4
#: Labelled ids that are sent to all tasks at most; beyond, the planner picks the join.
SENT_IDS = 1_000_000
#: Words, contexts and bigrams with evidence that a task holds at once, of each kind; beyond, they are broadcast in parts.
MODEL_ENTRIES = 1_000_000
#: Words that a task looks up together while it loads the parts of a model one after the other.
LOOKED_UP = 1 << 21
#: Standard errors at which half is kept, how steeply that falls, and the counts that the order below has in every context.
MARGIN, STEEP, STRENGTH = 4.0, 8, 200.0
#: What is less than this part of a double leaves it as it is when added.
UNFELT = 2.0**-54
START = np.uint64(1)
#: Sorted keys and their values.
Table = tuple[np.ndarray, np.ndarray]
CLASSES = ("ordinary", "toxic")
WORDS, PAIRS = 0, 1
#: Leading bits of keys that tell the passes of the count, and its buckets at most; text for each bucket.
PASS_BITS, MOST_BITS, BUCKET_BYTES = 2, 14, 1 << 20
#: Surroundings that a task gathers before it sends them.
BUFFER_ROWS = 1 << 20


def bigrams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Previous word and word, for every word of the texts."""
    words = texts.hashes
    before = np.append(START, words[:-1])[: len(words)]
    before[texts.first[:-1][texts.counts() > 0]] = START
    return before, words


def _pair_key(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + words)


def _surroundings(part: pa.RecordBatch, texts: Texts) -> Iterator[tuple[int, np.ndarray, ...]]:
    """Of words and bigrams: kind, key, owner, before, word, around with the class in its lowest bit."""
    before, words = bigrams(texts)
    owner = np.repeat(np.arange(len(part)), texts.counts())
    label = np.array(part.column("label").to_pylist(), np.int64)
    last = np.append(owner[1:] != owner[:-1], True)[: len(words)]
    behind = np.where(last, START, np.append(words[1:], START)[: len(words)])
    earlier = np.where(before == START, START, np.append(START, before[:-1])[: len(words)])
    toxic = (label[owner] > 0).astype(np.uint64)
    for kind, keys, ahead in ((WORDS, words, before), (PAIRS, _pair_key(before, words), earlier)):
        around = (_pair_key(ahead, behind) & ~np.uint64(1)) | toxic
        yield kind, keys, owner, before if kind == PAIRS else np.zeros_like(words), words, around


def _packed(kind: int, bits: int, rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One row for each bucket, the leading bits of the keys: each key once, and all its surroundings."""
    keys, before, words, around = (np.concatenate(c) for c in zip(*rows, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, around = keys[order], around[order]
    new = np.append(True, keys[1:] != keys[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(keys))).astype(np.uint32)
    bucket = (keys[first] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(first), np.int64)
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    row_cuts = np.append(first, len(keys))[cuts]
    columns = [before[order][first] if kind == PAIRS else None, words[order][first], n]
    blobs = [[None if c is None else c[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)] for c in columns]
    blobs.append([around[i:j].tobytes() for i, j in zip(row_cuts[:-1], row_cuts[1:], strict=True)])
    arrays = [pa.array(2 * bucket[cuts[:-1]] + kind), *(pa.array(c, pa.binary()) for c in blobs)]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "before", "word", "n", "around"])


def _counts_of_bucket(table: pa.Table) -> pa.Table:
    """Different surroundings of each key of a bucket in each class."""
    def joined(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(table[name].to_pylist()), kind)

    kind = table["bucket"][0].as_py() % 2
    words, n, around = joined("word", np.uint64), joined("n", np.uint32), joined("around", np.uint64)
    before = joined("before", np.uint64) if kind == PAIRS else np.zeros(len(words), np.uint64)
    at = np.repeat(np.arange(len(words)), n)
    keys = (_pair_key(before, words) if kind == PAIRS else words)[at]
    order = np.lexsort((around, keys))
    keys, around, at = keys[order], around[order], at[order]
    once = np.append(True, (keys[1:] != keys[:-1]) | (around[1:] != around[:-1]))
    keys, around, at = keys[once], around[once], at[once]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    toxic = np.add.reduceat((around & np.uint64(1)).astype(np.int64), first)
    counts = np.diff(np.append(first, len(keys))) - toxic
    found = [before[at[first]].view(np.int64), words[at[first]].view(np.int64), counts, toxic]
    names = ["kind", "before", "word", "ordinary", "toxic"]
    return pa.Table.from_arrays([pa.array(np.full(len(first), kind, np.int32)), *map(pa.array, found)], names=names)


def _counted(labelled: DataFrame) -> DataFrame:
    """Surroundings of each word and bigram in each class: (kind, before, word, ordinary, toxic), written.

    Every document gives the surroundings of its first occurrence. Keys are counted in
    PASSES by their leading bits, so that only a part of all surroundings is on disk at a
    time; tasks send each key of a bucket once, and the bucket's numbers with it.
    """
    size = labelled.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(max(math.ceil(math.log2(max(size / BUCKET_BYTES, 1))), PASS_BITS), MOST_BITS)

    def pass_rows(wanted: int):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = {WORDS: [], PAIRS: []}, 0
            for part, texts in text_chunks(batches, "text", lower=True, blank=NOT_PLAIN):
                for kind, keys, owner, *values in _surroundings(part, texts):
                    mine = np.flatnonzero(keys >> np.uint64(64 - PASS_BITS) == np.uint64(wanted))
                    order = mine[np.lexsort((keys[mine], owner[mine]))]
                    new = np.append(True, (np.diff(owner[order]) != 0) | (keys[order][1:] != keys[order][:-1]))
                    once = order[new[: len(order)]]
                    if len(once):
                        held[kind].append((keys[once], *(v[once] for v in values)))
                        size += len(once)
                if size >= BUFFER_ROWS:
                    yield from (_packed(kind, bits, rows) for kind, rows in held.items() if rows)
                    held, size = {WORDS: [], PAIRS: []}, 0
            yield from (_packed(kind, bits, rows) for kind, rows in held.items() if rows)

        return task

    sent = "bucket long, before binary, word binary, n binary, around binary"
    schema = "kind int, before long, word long, ordinary long, toxic long"
    passes = []
    for k in range(1 << PASS_BITS):
        rows = by_arrow(labelled.select("text", "label"), pass_rows(k), sent)
        with shuffles_dropped(labelled.sparkSession):
            passes.append(kept(rows.groupBy("bucket").applyInArrow(_counts_of_bucket, schema), "kn-counts"))
    return reduce(DataFrame.unionByName, passes)


def discounts(n1: float, n2: float, n3: float, n4: float) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from how many keys have each count."""
    if min(n1, n2, n3, n4) <= 0:
        return 0.5, 0.75, 0.9
    share = n1 / (n1 + 2 * n2)
    found = (1 - 2 * share * n2 / n1, 2 - 3 * share * n3 / n2, 3 - 4 * share * n4 / n3)
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))


def _values(table: Table | Broadcast[Table], asked: np.ndarray, default: float, stays: bool = True) -> np.ndarray:
    """Values of the keys; a broadcast table that does not stay is read from the executor's disk and given up."""
    if not isinstance(table, Broadcast):
        keys, values = table
    elif stays or not hasattr(table, "_path"):
        keys, values = table.value
    else:
        keys, values = table.load_from_path(table._path)
    if not len(keys):
        return np.full(len(asked), default)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], default)


@dataclass
class KneserNey:
    """Log ratios of toxic to ordinary probability, of all that differs from the shared order.

    ``tables`` holds sorted keys and values of words, contexts and bigrams, of each kind one for every
    value of its ``bits`` leading bits of the keys; ``other`` is the log ratio of every other word.
    """

    tables: list[Table | Broadcast[Table]]
    other: float
    slope: float = 1.0
    intercept: float = 0.0
    bits: tuple[int, ...] = (0, 0, 0)

    def log_ratio(self, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        """log P(word | before, toxic) - log P(word | before, ordinary)."""
        total = np.zeros(len(words))
        wanted = (words, before, _pair_key(before, words))
        tables = iter(self.tables)
        for asked, bits, default in zip(wanted, self.bits, (self.other, 0.0, 0.0), strict=True):
            if not bits:
                total += _values(next(tables), asked, default)
                continue
            part = (asked >> np.uint64(64 - bits)).astype(np.uint32)
            for k in range(1 << bits):
                table, mine = next(tables), np.flatnonzero(part == k)
                if len(mine):
                    total[mine] += _values(table, asked[mine], default, stays=False)
        return total

    def evidence(self, texts: Texts) -> np.ndarray:
        """Mean log ratio of each text; that of an unknown word without words."""
        return self.means(texts.counts(), *bigrams(texts))

    def means(self, n: np.ndarray, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Mean log ratio of texts of ``n`` words each."""
        # Added up text by text, so that equal texts have equal sums.
        sums = np.bincount(np.repeat(np.arange(len(n)), n), self.log_ratio(before, words), len(n))
        return np.where(n > 0, sums / np.maximum(n, 1), self.other)

    def chance(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.intercept + self.slope * evidence, -500, 500)))


def _excess(counts: DataFrame) -> tuple[DataFrame, dict[tuple[int, str], float], dict[int, float]]:
    """Counts with what each class keeps after its discount; totals by kind and class; keys by kind."""
    of_counts = [F.count_if(F.col(c) == k).alias(f"{c}{k}") for c in CLASSES for k in (1, 2, 3, 4)]
    summary = counts.groupBy("kind").agg(*(F.sum(c).alias(c) for c in CLASSES), F.count("*").alias("keys"), *of_counts).collect()
    total = {(r["kind"], c): float(r[c]) for r in summary for c in CLASSES}
    kept_part = {}
    for c in CLASSES:
        value = F.lit(0.0)
        for r in summary:
            n, share = F.col(c).cast("double"), r[c] / (r["ordinary"] + r["toxic"])
            expected = (F.col("ordinary") + F.col("toxic")) * F.lit(share)
            d = discounts(*(r[f"{c}{k}"] for k in (1, 2, 3, 4)))
            least = F.when(n == 1, d[0]).when(n == 2, d[1]).when(n > 2, d[2]).otherwise(0.0)
            over = F.greatest(n - expected - least, F.lit(0.0))
            # The share that is kept grows smoothly with the standard errors above what is expected.
            errors = over / F.sqrt(expected)
            left = over * F.coalesce(F.pow(errors / MARGIN, STEEP) / (F.pow(errors / MARGIN, STEEP) + 1), F.lit(0.0))
            value = F.when(F.col("kind") == r["kind"], left).otherwise(value)
        kept_part[f"{c}_left"] = value
    return counts.withColumns(kept_part), total, {r["kind"]: float(r["keys"]) for r in summary}


def _collected(rows: DataFrame) -> Table:
    """Sorted keys and values of (key, value)."""
    table = rows.toArrow()
    found = table["key"].to_numpy().view(np.uint64)
    order = np.argsort(found)
    return found[order], table["value"].to_numpy()[order]


def _parts(rows: DataFrame, entries: int) -> tuple[int, list[Table | Broadcast[Table]]]:
    """All of (key, value): one table, or, beyond ``entries``, one for each value of so many leading bits.

    The driver holds one part at a time, which it broadcasts; tasks find the parts on their executor's disk.
    """
    size = rows.count()
    if size <= entries:
        return 0, [_collected(rows)]
    bits = math.ceil(math.log2(size / entries))
    # Files hold ranges of keys, so that a part is not looked for in all of them.
    with shuffles_dropped(rows.sparkSession):
        ranges = kept(rows.repartitionByRange(1 << bits, "key"), "kn-parts")
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    ends = starts + np.uint64((1 << 64 - bits) - 1)
    context, limits = rows.sparkSession.sparkContext, zip(starts.view(np.int64), ends.view(np.int64), strict=True)
    parts = [context.broadcast(_collected(ranges.filter(F.col("key").between(int(a), int(b))))) for a, b in limits]
    dropped(ranges)
    return bits, parts


def _by_pair_key(rows: DataFrame) -> DataFrame:
    """(before, word, value) as (key, value)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            before, words = (part.column(c).to_numpy().view(np.uint64) for c in ("before", "word"))
            key = pa.array(_pair_key(before, words).view(np.int64))
            yield pa.RecordBatch.from_arrays([key, part.column("value")], names=["key", "value"])

    return by_arrow(rows, task, "key long, value double")


def fitted(counts: DataFrame, entries: int = MODEL_ENTRIES) -> KneserNey:
    """The models of the counts of words and bigrams.

    Counts that occur once lie all on one side of their discount; as a corpus grows they pass it together, first
    by next to nothing. A bigram is an entry, and is joined with its context and word, if what either class
    keeps of it can change a probability of that class in double precision at all.
    """
    rows, total, kinds = _excess(counts)
    words, pairs = rows.filter(F.col("kind") == WORDS), rows.filter(F.col("kind") == PAIRS)
    left = words.agg(*(F.sum(f"{c}_left") for c in CLASSES)).first()
    rest = {c: 1 - (x or 0.0) / max(total.get((WORDS, c), 0.0), 1.0) for c, x in zip(CLASSES, left, strict=True)}
    both = F.col("ordinary") + F.col("toxic")
    everything = sum(total.get((WORDS, c), 0.0) for c in CLASSES)
    shared = (both + 1) / F.lit(everything + kinds.get(WORDS, 0.0) + 1)
    chance = {c: F.col(f"{c}_left") / F.lit(max(total.get((WORDS, c), 0.0), 1.0)) + F.lit(rest[c]) * shared for c in CLASSES}
    chances = words.select("word", *(e.alias(f"{c}_p") for c, e in chance.items()))
    told = F.greatest(*(f"{c}_left" for c in CLASSES)) > 0
    # No word's chance is below that of one seen once, no context leaves the order below less than STRENGTH.
    least = {c: rest[c] * 2 / (everything + kinds.get(WORDS, 0.0) + 1) for c in CLASSES}
    felt = reduce(lambda a, b: a | b, (F.col(f"{c}_left") > UNFELT * STRENGTH * least[c] for c in CLASSES))
    ratio = F.ln(chance["toxic"]) - F.ln(chance["ordinary"])
    of_words = kept(words.filter(told).select(F.col("word").alias("key"), ratio.alias("value")), "kn-words")
    sums = [F.sum(x).alias(x) for c in CLASSES for x in (c, f"{c}_left")]
    contexts = pairs.groupBy("before").agg(*sums, F.max(felt).alias("felt"))
    # The share of a context that the order below gets.
    below = {c: (F.col(c) - F.col(f"{c}_left") + STRENGTH) / (F.col(c) + STRENGTH) for c in CLASSES}
    contexts = contexts.filter("felt").select(
        "before", *(e.alias(f"{c}_below") for c, e in below.items()), *(F.col(c).cast("double").alias(f"{c}_n") for c in CLASSES)
    )
    contexts = kept(contexts, "kn-contexts")
    lower = F.ln("toxic_below") - F.ln("ordinary_below")
    of_contexts = contexts.select(F.col("before").alias("key"), lower.alias("value"))
    # The table of contexts has one row for each that holds a telling bigram.
    p = {c: F.col(f"{c}_left") / (F.col(f"{c}_n") + STRENGTH) + F.col(f"{c}_below") * F.col(f"{c}_p") for c in CLASSES}
    more = F.ln(p["toxic"]) - F.ln(p["ordinary"]) - lower - (F.ln("toxic_p") - F.ln("ordinary_p"))
    of_pairs = (
        pairs.filter(felt).join(contexts, "before").join(chances, "word")
        .select("before", "word", more.alias("value"))
    )
    # Counted, parted and sent: each bigram meets its one context and its one word once.
    of_pairs = kept(_by_pair_key(of_pairs), "kn-pairs")
    bits, tables = zip(*(_parts(t, entries) for t in (of_words, of_contexts, of_pairs)), strict=True)
    dropped(of_words, contexts, of_pairs)
    return KneserNey(sum(tables, []), float(np.log(rest["toxic"]) - np.log(rest["ordinary"])), bits=bits)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Intercept and slope by Newton's method, lightly held towards zero."""
    scale = float(x.std()) or 1.0
    design = np.stack([np.ones_like(x), (x - x.mean()) / scale], 1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        w += np.linalg.solve(curve, design.T @ (y - p) - 1e-3 * w)
    return float(w[0] - w[1] * x.mean() / scale), float(w[1] / scale)


def logistic_of_rows(seen: DataFrame, steps: int = 50) -> tuple[float, float]:
    """`logistic` of the label on the evidence of any number of rows.

    Each step adds up over the rows where they are. Twelve digits are kept, so that the
    order of the sums does not show.
    """
    mean, spread = seen.agg(F.avg("evidence"), F.stddev_pop("evidence")).first()
    scale = spread or 1.0
    x = (F.col("evidence") - F.lit(mean)) / F.lit(scale)
    w = np.zeros(2)
    for _ in range(steps):
        at = F.greatest(F.least(F.lit(float(w[0])) + F.lit(float(w[1])) * x, F.lit(500.0)), F.lit(-500.0))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-at))
        off, bend = F.col("label") - p, p * (F.lit(1.0) - p)
        c0, c1, c2, g0, g1 = seen.agg(*(F.sum(e) for e in (bend, bend * x, bend * x * x, off, off * x))).first()
        curve = np.array([[c0, c1], [c1, c2]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, np.array([g0, g1]) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-13:
            break
    return tuple(float(f"{v:.12g}") for v in (w[0] - w[1] * mean / scale, w[1] / scale))


def _evidence(docs: DataFrame, model: KneserNey, column: str) -> DataFrame:
    """``docs`` with the mean log ratio, or with the calibrated chance, in place of the text."""
    context = docs.sparkSession.sparkContext
    sent = replace(model, tables=[t if isinstance(t, Broadcast) else context.broadcast(t) for t in model.tables])
    others = [c for c in docs.columns if c != "text"]
    # A model in parts is loaded anew for every so many words, a whole one stays.
    most = LOOKED_UP if any(model.bits) else 0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part, texts in text_chunks(batches, "text", lower=True, blank=NOT_PLAIN):
            held.append((part.select(others), texts.counts(), *bigrams(texts)))
            size += len(texts.hashes)
            if size >= most:
                yield from judged(held)
                held, size = [], 0
        if held:
            yield from judged(held)

    def judged(held: list[tuple[pa.RecordBatch, np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        parts, *rest = zip(*held, strict=True)
        found = sent.means(*map(np.concatenate, rest))
        found = sent.chance(found) if column == "score" else found
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        for part, own in zip(parts, np.split(found, cuts), strict=True):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own)], names=[*others, column])

    return by_arrow(docs, task, docs.select(*others).schema.add(column, "double"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score (the chance of label 1), predicted.

    Folds are crc32 of the id modulo 5. Fold 0 is held out, 1 to 3 are counted and
    4 calibrates, with all their labelled texts. Every whole text is scored. Texts
    without words have the chance of a text of unknown words. Of several rows of one id one teaches, and each is scored. Documents that are
    labelled several times count as toxic if any label says so; NULL labels and ids
    do not teach; a NULL id is not held out. If only one class is labelled, its
    label is the score of all; without labels it is 0. An empty table gives no rows.
    Needs doc_id and text, and doc_id and toxic; other columns are ignored.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = kept(
        known.select("doc_id", F.col("label").cast("long").alias("label"), fold.alias("fold")).filter(f"fold <> {HELD_OUT}"),
        "toxic-labels",
    )
    n, n_toxic = known.agg(F.count("*"), F.coalesce(F.count_if(F.col("label") != 0), F.lit(0))).first()
    bytes_of = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    held_out = F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of, held_out)
    if n_toxic in (0, n):
        scored = whole.withColumn("score", F.lit(float(n_toxic > 0))).drop("text")
    else:
        # Of an id's texts the one of least hash, of equal texts the least id.
        given = docs.select("doc_id", bytes_of, F.xxhash64("text").alias("_h"))
        times = given.join(known, "doc_id").select("doc_id", "label", "fold", "_h").repartition("doc_id")
        times = times.groupBy("doc_id", "label", "fold", "_h").agg(F.count("*").alias("n"))
        least = times.groupBy("doc_id", "label", "fold").agg(F.min(F.struct("_h", "n")).alias("s")).select("*", "s._h", "s.n")
        of_text = least.groupBy("label", "fold", "_h").agg(F.min(F.struct("doc_id", "n")).alias("s"))
        chosen = kept(of_text.select("label", "fold", "_h", "s.doc_id", "s.n"), "toxic-chosen")
        # While ids and hashes are small enough to send around, no text moves but that of repeated rows.
        few = F.broadcast(chosen) if n <= SENT_IDS else chosen
        met = given.join(few, ["doc_id", "_h"])
        taught = met.filter("n = 1")
        if not chosen.filter("n > 1").isEmpty():
            taught = taught.unionByName(met.filter("n > 1").dropDuplicates(["doc_id"]))
        taught = kept(taught.select("label", "fold", "text"), "toxic-taught")
        counted = taught.filter(f"fold <> {CALIBRATION}")
        counts = _counted(counted)
        model = fitted(counts, MODEL_ENTRIES)
        seen = _evidence(taught.filter(f"fold = {CALIBRATION}").select("text", "label"), model, "evidence")
        seen = kept(seen, "toxic-calibration")
        share = seen.agg(F.avg("label")).first()[0]
        if share is not None and 0 < share < 1:
            model.intercept, model.slope = logistic_of_rows(seen)
        scored = _evidence(whole, model, "score")
        dropped(counts, taught, chosen, seen)
    dropped(known)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
