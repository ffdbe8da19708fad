"""Quality by co-training: a text-content and a page-metadata classifier teach each other.

Both start from the labelled documents. In every round each view judges all
unlabelled documents and names those it is surest of, and the other view learns
them as well. The surest are found by counts of their log odds in steps, so only the
named documents, a bounded number, leave the tasks. At
the end the log odds of both views are weighed and calibrated on labelled
documents that neither has seen, and all documents are scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.llm.scratch import dropped, kept
from risklake.llm.words import Texts, by_arrow, text_chunks

SAMPLE_ROWS = 15_000
ROUNDS = 4
TAUGHT_SHARE = 0.1
SURE = 0.95
#: Steps per unit of log odds in which the surest documents are counted.
STEPS = 64
_SIGNS = "!$%&*#|<>{}[]@=+~^_\\/"


def _byte_kinds() -> np.ndarray:
    """Kind of each byte: blank, line end, small, capital, digit, high, common marks, other signs one by one."""
    kinds = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        kinds[b] = (
            1 if c == "\n" else 0 if c.isspace() or b < 32 else 5 if b > 127 else 2 if c.islower() else 3 if c.isupper()
            else 4 if c.isdigit() else 6 if c in ".,;:?" else 7 if c in "'\"()-" else 8
        )
    for k, c in enumerate(_SIGNS[:6]):
        kinds[ord(c)] = 9 + k // 2
    kinds[ord("|")] = 12
    return kinds


KINDS = _byte_kinds()
N_KINDS = 13
N_CONTENT = N_KINDS * N_KINDS + 5
N_HASHED = 64
N_METADATA = 2 * N_HASHED + 8

#: Rows held as doubles at once on the driver.
FIT_ROWS = 2048


def content_view(texts: Texts) -> np.ndarray:
    """Shares of the byte-kind transitions, and figures of the words, one row per text."""
    n = len(texts.first) - 1
    kinds = KINDS[np.frombuffer(texts.data, np.uint8)]
    ends = texts.text_ends
    owner = np.repeat(np.arange(n), np.diff(np.append(0, ends)))[: len(kinds)]
    inside = np.ones(len(kinds), bool)
    inside[np.minimum(ends, len(kinds)) - 1] = False
    moves = np.flatnonzero(inside[:-1] & inside[1:])
    codes = owner[moves] * N_KINDS**2 + kinds[moves] * N_KINDS + kinds[moves + 1]
    table = np.bincount(codes, minlength=n * N_KINDS**2).reshape(n, -1)
    shares = np.sqrt(table / np.maximum(table.sum(1, keepdims=True), 1))
    lengths = np.append(0, np.cumsum(texts.ends - texts.starts))
    counts = np.maximum(texts.counts(), 1)
    figures = np.zeros((n, 5))
    figures[:, 0] = np.diff(lengths[texts.first]) / counts
    for i in range(n):
        words = texts.of(i)
        if len(words):
            _, again = np.unique(words, return_counts=True)
            pairs = np.unique(words[:-1] ^ (words[1:] >> np.uint64(1)))
            figures[i, 1:] = (
                len(again) / np.sqrt(len(words)), again.max() / len(words),
                len(pairs) / max(len(words) - 1, 1), np.log1p(len(words)),
            )
    return np.concatenate([shares, figures], 1).astype(np.float32)


def metadata_view(part: pa.RecordBatch, bodies: list[bytes]) -> np.ndarray:
    """Source, language, stated length and layout of each document."""
    out = np.zeros((len(bodies), N_METADATA), np.float32)
    for i, (source, lang, stated, body) in enumerate(
        zip(*(part.column(c).to_pylist() for c in ("source", "lang", "n_chars")), bodies, strict=True)
    ):
        out[i, zlib.crc32(str(source).encode("utf-8", "replace")) % N_HASHED] = 1
        out[i, N_HASHED + zlib.crc32(str(lang).encode("utf-8", "replace")) % N_HASHED] = 1
        lines = body.split(b"\n")
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        out[i, 2 * N_HASHED :] = (
            np.log1p(max(stated or 0, 0)), np.log1p(len(body)), np.log1p(len(lines)), np.log1p(sizes.mean()),
            len(set(lines)) / len(lines), (sizes < 40).mean(), sizes.max() / max(len(body), 1), source is None,
        )
    return out


@dataclass
class Logistic:
    """Regularised logistic regression on standardised features."""

    penalty: float = 1.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x.astype(np.float64) - self.mean) / self.scale, -8, 8)
        return np.concatenate([z, np.ones((len(x), 1))], 1)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 15) -> Logistic:
        """Newton's method; rows pass in blocks, so that no second copy of them is held."""
        self.mean, self.scale = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64)
        self.scale = np.where(self.scale > 1e-6, self.scale, 1.0)
        size = x.shape[1] + 1
        self.weights = np.zeros(size)
        hold = np.append(np.full(x.shape[1], self.penalty), 1e-6)
        for _ in range(steps):
            curve, slope = np.diag(hold), -hold * self.weights
            for at in range(0, len(x), FIT_ROWS):
                design = self._design(x[at : at + FIT_ROWS])
                p = 1 / (1 + np.exp(-np.clip(design @ self.weights, -30, 30)))
                curve += (design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design
                slope += design.T @ (y[at : at + FIT_ROWS] - p)
            step = np.linalg.solve(curve, slope)
            self.weights += step
            if np.abs(step).max() < 1e-6:
                break
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        found = np.zeros(len(x))
        for at in range(0, len(x), FIT_ROWS):
            found[at : at + FIT_ROWS] = self._design(x[at : at + FIT_ROWS]) @ self.weights
        return np.clip(found, -30, 30)


@dataclass
class CoTrained:
    """Both views and the weights that combine and calibrate their log odds."""

    content: Logistic
    metadata: Logistic
    joint: Logistic

    def chance(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        both = np.stack([self.content.log_odds(content), self.metadata.log_odds(metadata)], 1)
        return 1 / (1 + np.exp(-self.joint.log_odds(both)))


Named = tuple[np.ndarray, np.ndarray]


class RowPool:
    """Unlabelled rows at hand."""

    def __init__(self, views: list[np.ndarray]):
        self.views = views
        self.taught = [np.zeros(len(views[0]), bool) for _ in views]

    def surest(self, models: list[Logistic], shares: dict[int, int]) -> list[Named]:
        """For each view that learns: its rows that the other view is surest of, and their labels."""
        odds, out = [m.log_odds(v) for m, v in zip(models, self.views, strict=True)], []
        for taker, giver in ((0, 1), (1, 0)):
            named = []
            for value, sign in ((1, 1), (0, -1)):
                free = np.flatnonzero(~self.taught[taker] & (sign * odds[giver] > np.log(SURE / (1 - SURE))))
                named.append(free[np.argsort(-sign * odds[giver][free], kind="stable")[: shares[value]]])
            chosen = np.concatenate(named)
            self.taught[taker][chosen] = True
            out.append((self.views[taker][chosen], np.repeat([1, 0], [len(n) for n in named])))
        return out


def co_trained(views: list[np.ndarray], label: np.ndarray, rounds: int = ROUNDS, pool=None) -> CoTrained:
    """Fit both views. ``label`` is 1, 0, or -1 where unknown; every fourth labelled row calibrates.

    Pseudo-labels come from ``pool``, by default the rows without label.
    """
    known = np.flatnonzero(label >= 0)
    calibration, seed = known[::4], np.setdiff1d(known, known[::4])
    if len(np.unique(label[seed])) < 2 or len(np.unique(label[calibration])) < 2:
        calibration = seed = known
    pool = pool or RowPool([v[label < 0] for v in views])
    rows, told = [v[seed] for v in views], [label[seed] for _ in views]
    shares = {value: max(int(TAUGHT_SHARE * (label[seed] == value).sum()), 1) for value in (0, 1)}
    models = [Logistic(penalty=3.0).fit(x, y) for x, y in zip(rows, told, strict=True)]
    for _ in range(rounds):
        for taker, (more, values) in enumerate(pool.surest(models, shares)):
            rows[taker] = np.concatenate([rows[taker], more])
            told[taker] = np.concatenate([told[taker], values])
        models = [Logistic(penalty=3.0).fit(x, y) for x, y in zip(rows, told, strict=True)]
    both = np.stack([m.log_odds(v[calibration]) for m, v in zip(models, views, strict=True)], 1)
    return CoTrained(*models, Logistic(penalty=0.1).fit(both, label[calibration]))


def _given(docs: DataFrame) -> DataFrame:
    """The columns the views read, as binary text, NULL where a table lacks one."""
    has = lambda c, kind: (F.col(c) if c in docs.columns else F.lit(None)).cast(kind).alias(f"_q_{c}")
    return docs.select(
        "*", has("source", "string"), has("lang", "string"), has("n_chars", "long"),
        F.coalesce("text", F.lit("")).cast("binary").alias("_q_text"),
    )


def _views(batches: Iterator[pa.RecordBatch]):
    for part, texts in text_chunks(batches, "_q_text"):
        named = pa.RecordBatch.from_arrays(
            [part.column(f"_q_{c}") for c in ("source", "lang", "n_chars")], names=["source", "lang", "n_chars"]
        )
        bodies = [t or b"" for t in part.column("_q_text").to_pylist()]
        yield part, texts, content_view(texts), metadata_view(named, bodies)


def _fraction(*columns: str) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit("quality")), 11).cast("double") * 2.0**-53


def _judged(docs: DataFrame) -> DataFrame:
    """What the views read of each document, and a hash that tells its texts apart."""
    has = [c for c in ("text", "source", "lang", "n_chars") if c in docs.columns]
    given = _given(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *has)).drop(*has)
    return given.withColumn("_q_hash", F.xxhash64("_q_text"))


def _fetched(given: DataFrame, wanted: DataFrame) -> pa.Table:
    """Both views of the wanted texts (doc_id, _q_hash, _q_code), a few thousand, one row each.

    Copies are folded before they leave their tasks; of differing metadata the least counts.
    """
    w = F.broadcast(wanted.select(F.col("doc_id").alias("_w_id"), F.col("_q_hash").alias("_w_hash"), "_q_code"))
    found = given.join(w, given.doc_id.eqNullSafe(F.col("_w_id")) & (given["_q_hash"] == F.col("_w_hash")))
    one = found.groupBy("doc_id", "_q_hash", "_q_code").agg(
        F.min(F.struct("_q_source", "_q_lang", "_q_n_chars")).alias("about"), F.first("_q_text").alias("_q_text")
    ).select("doc_id", "_q_hash", "_q_code", "about.*", "_q_text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, content, metadata in _views(batches):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("doc_id", "_q_hash", "_q_code")),
                 pa.array(list(content), pa.list_(pa.float32())), pa.array(list(metadata), pa.list_(pa.float32()))],
                names=["doc_id", "hash", "code", "content", "metadata"],
            )

    table = by_arrow(one, task, "doc_id long, hash long, code int, content array<float>, metadata array<float>").toArrow()
    return table.sort_by([("doc_id", "ascending"), ("hash", "ascending"), ("code", "ascending")])


def _both_views(table: pa.Table) -> list[np.ndarray]:
    wide = lambda c, n: table[c].combine_chunks().flatten().to_numpy().reshape(-1, n)
    return [wide("content", N_CONTENT), wide("metadata", N_METADATA)]


class CorpusPool:
    """All documents whose id has no label, judged in Spark every round by views written once."""

    def __init__(self, given: DataFrame, known: DataFrame):
        self.given, self.known = given, known
        self.views: DataFrame | None = None
        self.taught: list[tuple[int | None, int, int]] = []

    def _written(self) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, _, *views in _views(batches):
                rows = [pa.array([r.tobytes() for r in v], pa.binary()) for v in views]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_q_hash"), *rows], names=["doc_id", "_q_hash", "content", "metadata"]
                )

        return kept(by_arrow(self.given, task, "doc_id long, _q_hash long, content binary, metadata binary"), "quality-views")

    def close(self) -> None:
        if self.views is not None:
            dropped(self.views)

    def _sure(self, models: list[Logistic]) -> DataFrame:
        """Texts that a view (giver) is sure of and has not named before, with the label and the step of the log odds."""
        shared = self.given.sparkSession.sparkContext.broadcast(models)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                rows = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.float32) for c in ("content", "metadata")]
                odds = [m.log_odds(v.reshape(len(part), -1)) for m, v in zip(shared.value, rows, strict=True) if len(part)]
                if not odds:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_q_hash"), *map(pa.array, odds)],
                    names=["doc_id", "_q_hash", "content", "metadata"],
                )

        if self.views is None:
            self.views = self._written()
        odds = kept(by_arrow(self.views, task, "doc_id long, _q_hash long, content double, metadata double"), "quality-odds")
        shared.destroy()
        one = odds.groupBy("doc_id", "_q_hash").agg(F.min("content").alias("content"), F.min("metadata").alias("metadata"))
        free = one.join(self.known.select("doc_id"), "doc_id", "left_anti")
        givers = F.array(*(F.struct(F.lit(k).alias("giver"), F.col(c).alias("odds")) for k, c in enumerate(("content", "metadata"))))
        sure = free.select("doc_id", "_q_hash", F.explode(givers).alias("g")).select(
            "doc_id", "_q_hash", "g.giver", (F.col("g.odds") > 0).cast("int").alias("value"),
            F.floor(F.abs("g.odds") * STEPS).cast("int").alias("step"), F.abs("g.odds").alias("odds"),
        ).filter(F.col("odds") > float(np.log(SURE / (1 - SURE))))
        if self.taught:
            before = self.given.sparkSession.createDataFrame(self.taught, "t_id long, t_hash long, t_giver int")
            same = sure.doc_id.eqNullSafe(before.t_id) & (sure["_q_hash"] == before.t_hash) & (sure.giver == before.t_giver)
            sure = sure.join(F.broadcast(before), same, "left_anti")
        sure = kept(sure.drop("odds"), "quality-sure")
        dropped(odds)
        return sure

    def surest(self, models: list[Logistic], shares: dict[int, int]) -> list[Named]:
        """As ``RowPool.surest``; of equally sure documents in the last step a share is drawn by hash."""
        sure = self._sure(models)
        held, chosen = {}, F.lit(False)
        counts = sure.groupBy("giver", "value", "step").count().orderBy(F.col("step").desc()).collect()  # a few thousand rows
        for r in counts:
            have = held.get((r.giver, r.value), 0)
            part = min((shares[r.value] - have) / r["count"], 1.0)
            if part > 0:
                at = (F.col("giver") == r.giver) & (F.col("value") == r.value)
                if part < 1 or have + r["count"] == shares[r.value]:
                    last = (F.col("step") == r.step) & (_fraction("doc_id", "_q_hash") < part)
                    chosen = chosen | (at & ((F.col("step") > r.step) | last))
                held[r.giver, r.value] = have + r["count"]
        for (giver, value), have in held.items():
            if have < shares[value]:
                chosen = chosen | ((F.col("giver") == giver) & (F.col("value") == value))
        code = (F.col("giver") * 2 + F.col("value")).cast("int")
        named = kept(sure.filter(chosen).select("doc_id", "_q_hash", code.alias("_q_code")), "quality-named")
        table = _fetched(self.given, named)
        dropped(sure, named)
        codes, views = table["code"].to_numpy(), _both_views(table)
        self.taught += list(zip(table["doc_id"].to_pylist(), table["hash"].to_pylist(), (codes // 2).tolist(), strict=True))
        return [(views[taker][codes // 2 == 1 - taker], codes[codes // 2 == 1 - taker] % 2) for taker in (0, 1)]


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> CoTrained | float:
    """The classifier; the share of good labels where the sample has labels of one kind only.

    About ``sample_rows`` labelled ids are drawn by hash, one text of each; all
    documents without label take part in the rounds.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("_q_code")
    )
    known = kept(known, "quality-labels")
    share = min(sample_rows / max(known.count(), 1), 1.0)
    drawn = F.broadcast(known.filter(_fraction("doc_id") < share))
    given = _judged(docs)
    least = given.join(drawn, "doc_id").groupBy("doc_id").agg(
        F.min("_q_hash").alias("_q_hash"), F.first("_q_code").alias("_q_code")
    )
    wanted = kept(least, "quality-sample")
    table = _fetched(given, wanted)
    label = table["code"].to_numpy()
    if len(np.unique(label)) < 2:
        found = float(label.mean()) if len(label) else 1.0
    else:
        free = not given.join(known, "doc_id", "left_anti").isEmpty()
        pool = CorpusPool(given, known)
        found = co_trained(_both_views(table), label, ROUNDS if free else 0, pool)
        pool.close()
    dropped(known, wanted)
    return found


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``quality_score``, the chance of label 1, replacing a column of that name.

    The models start from about ``sample_rows`` labelled documents; all documents
    without label are judged in every round, and all documents are scored, by their
    whole texts. Texts without words have the score 0. Without labels every other
    document has the score 1. Of a repeated id one text is sampled, of repeated labels
    the least counts; rows without id are documents without label, labels without id
    are none. An empty table has an empty result. Needs doc_id and text; source, lang
    and n_chars count as NULL where missing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, sample_rows))
    others = [c for c in docs.columns if c != "quality_score"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts, content, metadata in _views(batches):
            model = shared.value
            chance = np.full(len(part), model) if isinstance(model, float) else model.chance(content, metadata)
            chance = np.where(texts.counts() > 0, chance, 0.0)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(chance)], names=[*others, "quality_score"])

    schema = docs.select(*others).schema.add("quality_score", "double")
    return by_arrow(_given(docs), task, schema)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).alias("keep"))
