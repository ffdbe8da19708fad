"""Ranked lexical search by pipelined term partitioning.

The terms of the items are owned by a few term owners, rare terms first. Documents
lie in shards. A bundle of items visits the owners of a shard one after the other:
every stage cogroups the bundle, which carries sparse accumulators (document: score),
with the owner's postings of that shard, adds the integer contributions and hands
the bundle on. The last owner holds the frequent terms and selects, so that the
accumulators handed on are those of rarer terms only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from risklake.llm.scratch import dropped, kept
from risklake.llm.words import by_arrow

#: Letters and digits of ASCII and every byte of other characters.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
BEST = 10
#: An owner takes the terms held by less than this share of the documents; the last one the rest.
OWNER_SHARES = (1 / 256, 1 / 16)

_SHARDS = "shard long, doc int, doc_id long, n long, terms array<int>, tfs array<long>"
_SLICES = "bundle int, shard long, doc int, doc_id long, terms array<int>, parts array<long>"
_BUNDLES = "bundle int, shard long, item int, docs array<int>, scores array<long>"
_FOUND = "item int, doc_id long, score long"


@dataclass(frozen=True)
class Sizes:
    """What is held together; none changes the result."""

    #: A shard ends at so many documents or postings.
    shard_documents: int = 4096
    shard_postings: int = 1 << 20
    #: Items that travel together.
    bundle_items: int = 256
    #: Distinct terms of items, one for each item that has it, searched in one pass over the documents.
    pass_terms: int = 1_000_000


def _terms(text: bytes | None) -> list[bytes]:
    return TERM.findall((text or b"").lower())


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def _flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row each belongs to."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), sizes)


def item_terms(items: DataFrame, id_: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, times); rows that share an id are one item."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(_terms(t)) for t in batch.column("text").to_pylist()]
            owner = np.repeat(np.arange(len(found)), [len(c) for c in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").take(pa.array(owner)),
                    pa.array([t for c in found for t in c], pa.binary()),
                    pa.array([n for c in found for n in c.values()], pa.int64()),
                ],
                names=["item_id", "term", "times"],
            )

    given = items.select(F.col(id_).alias("item_id"), F.col(text).cast("binary").alias("text"))
    kind = given.schema["item_id"].dataType.simpleString()
    rows = by_arrow(given, task, f"item_id {kind}, term binary, times long")
    return rows.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


@dataclass
class Queries:
    """Items of one pass: their terms, numbered, and (item, term, times), sorted by item."""

    ids: list
    terms: list[bytes]
    item: np.ndarray
    term: np.ndarray
    times: np.ndarray
    bundle_items: int

    @classmethod
    def of(cls, rows: pa.Table, bundle_items: int) -> Queries:
        ids, terms = rows["item_id"].to_pylist(), rows["term"].to_pylist()
        numbers = {i: k for k, i in enumerate(dict.fromkeys(ids))}
        known = {t: k for k, t in enumerate(sorted(set(terms)))}
        item = np.array([numbers[i] for i in ids], np.int64)
        order = np.argsort(item, kind="stable")
        term = np.array([known[t] for t in terms], np.int64)
        times = rows["times"].to_numpy().astype(np.int64)
        return cls(list(numbers), list(known), item[order], term[order], times[order], bundle_items)


def _sharded(docs: DataFrame, terms: list[bytes], sizes: Sizes) -> DataFrame:
    """Documents with at least one term, dealt into shards, and their postings of the asked terms."""
    shared = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        part, block, docs_in, held = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            rows = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                counts = Counter(_terms(text))
                if not counts:
                    continue
                hits = [t for t in counts if t in known]
                if docs_in and (docs_in == sizes.shard_documents or held + len(hits) > sizes.shard_postings):
                    block, docs_in, held = block + 1, 0, 0
                rows.append((
                    i, (part << 32) + block, docs_in, counts.total(),
                    np.array([known[t] for t in hits], np.int32), np.array([counts[t] for t in hits], np.int64),
                ))
                docs_in, held = docs_in + 1, held + len(hits)
            at, shard, doc, n, ids, tfs = ([r[k] for r in rows] for k in range(6))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard, pa.int64()), pa.array(doc, pa.int32()),
                    batch.column("doc_id").take(pa.array(at, pa.int32())), pa.array(n, pa.int64()),
                    _lists(ids, pa.int32()), _lists(tfs, pa.int64()),
                ],
                names=["shard", "doc", "doc_id", "n", "terms", "tfs"],
            )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return kept(by_arrow(given, task, _SHARDS), "lexical-shards")


@dataclass
class Owners:
    """Weight and owner of every asked term, the corpus totals, and the bundle of every item."""

    weight: np.ndarray
    owner: np.ndarray
    documents: int
    occurrences: int

    def slices(self, shards: DataFrame, queries: Queries, owner: int, every: bool = False) -> DataFrame:
        """One owner's postings, for every bundle that asks for some of its terms.

        ``every`` keeps the documents without such a posting, so that the scores that
        a bundle carries find the ids of their documents.
        """
        shared = shards.sparkSession.sparkContext.broadcast((self, _bundles(queries)))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            me, bundles = shared.value
            n_docs, n_terms = np.int64(me.documents), np.int64(me.occurrences)
            for batch in batches:
                term, row = _flat(batch.column("terms"))
                tf, _ = _flat(batch.column("tfs"))
                n = batch.column("n").to_numpy()
                m = 25 + (75 * n * n_docs) // n_terms
                part = me.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                for bundle, asked in enumerate(bundles):
                    mine = asked[term] & (me.owner[term] == owner) & (part > 0)
                    rows = np.arange(len(n)) if every else np.unique(row[mine])
                    if not len(rows):
                        continue
                    offsets = pa.array(np.append(np.searchsorted(row[mine], rows), mine.sum()).astype(np.int32))
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(rows), bundle, np.int32)),
                            *(batch.column(c).take(take) for c in ("shard", "doc", "doc_id")),
                            pa.ListArray.from_arrays(offsets, pa.array(term[mine], pa.int32())),
                            pa.ListArray.from_arrays(offsets, pa.array(part[mine], pa.int64())),
                        ],
                        names=["bundle", "shard", "doc", "doc_id", "terms", "parts"],
                    )

        return shards.mapInArrow(task, _SLICES)


def _bundles(queries: Queries) -> list[np.ndarray]:
    """For each bundle of items, which terms it asks for."""
    bundle = queries.item // queries.bundle_items
    out = np.zeros((-(-len(queries.ids) // queries.bundle_items), len(queries.terms)), bool)
    out[bundle, queries.term] = True
    return list(out)


def _added(bundle: int, carried: pa.Table, slices: pa.Table, queries: Queries) -> Iterator[tuple[int, np.ndarray]]:
    """(item, scores of the shard's documents by number) after this owner's contributions."""
    doc = slices["doc"].to_numpy()
    term, row = _flat(slices["terms"])
    part, _ = _flat(slices["parts"])
    order = np.argsort(term, kind="stable")
    term, at, part = term[order], doc[row[order]], part[order]
    scores, owner = _flat(carried["scores"])
    docs, _ = _flat(carried["docs"])
    size = 1 + int(max(doc.max(initial=-1), docs.max(initial=-1)))
    came = {int(i): k for k, i in enumerate(carried["item"].to_numpy())}
    starts = np.searchsorted(owner, np.arange(len(came) + 1))
    start = bundle * queries.bundle_items
    last = min(start + queries.bundle_items, len(queries.ids))
    bounds = np.searchsorted(queries.item, np.arange(start, last + 1))
    first, end = (np.searchsorted(term, queries.term, side=s) for s in ("left", "right"))
    for item, a, b in zip(range(start, last), bounds[:-1], bounds[1:], strict=True):
        total = np.zeros(size, np.int64)
        if item in came:
            lo, hi = starts[came[item]], starts[came[item] + 1]
            total[docs[lo:hi]] = scores[lo:hi]
        for q in range(a, b):
            # A document holds a term once in a slice, so no place is added to twice.
            total[at[first[q] : end[q]]] += queries.times[q] * part[first[q] : end[q]]
        yield item, total


def searched(docs: DataFrame, items: DataFrame, best: int = BEST, sizes: Sizes = Sizes()) -> DataFrame:
    """The ``best`` documents with a score above 0 of every item: item_id, rank, doc_id, score.

    Terms are maximal runs of ASCII letters and digits and of all characters beyond
    ASCII, with A to Z lower-cased. Every row of ``docs`` is a document of its own, also
    where ids repeat; a NULL id can be found and ranks behind equal scores. Rows of
    ``items`` that share an id (also NULL) are one item. NULL and empty texts have no
    terms: such documents do not count, such items have no rows. Empty tables give no
    rows. Needs doc_id and text, and item_id and text; other columns are ignored.

    Items are searched in passes of about ``sizes.pass_terms`` terms; terms and weights
    of a pass are broadcast, postings and accumulators shuffled.
    """
    spark = docs.sparkSession
    terms = kept(item_terms(items), "lexical-terms")
    kind = terms.schema["item_id"].dataType.simpleString()
    total = terms.count()
    passes = -(-total // sizes.pass_terms)
    found = spark.createDataFrame([], f"item_id {kind}, doc_id long, score long")
    written = []
    for k in range(passes):
        mine = terms.filter(F.pmod(F.xxhash64("item_id", F.lit("pass")), F.lit(passes)) == k)
        queries = Queries.of(mine.toArrow(), sizes.bundle_items)
        if queries.ids:
            written.append(_one_pass(docs, queries, best, kind, sizes))
            found = found.unionByName(written[-1])
    by_rank = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = kept(
        found.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= best)
        .select("item_id", "rank", "doc_id", "score"),
        "lexical-found",
    )
    dropped(terms, *written)
    return out


def _one_pass(docs: DataFrame, queries: Queries, best: int, kind: str, sizes: Sizes) -> DataFrame:
    spark = docs.sparkSession
    shards = _sharded(docs, queries.terms, sizes)
    corpus = shards.agg(F.count("*"), F.sum("n")).first()
    n_docs, n_terms = corpus[0], corpus[1] or 0
    held = shards.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    table = held.select("term", "df", weight.alias("weight")).toArrow()  # at most one row for each asked term
    weights, df = np.zeros(len(queries.terms), np.int64), np.zeros(len(queries.terms), np.int64)
    weights[table["term"].to_numpy()], df[table["term"].to_numpy()] = table["weight"].to_numpy(), table["df"].to_numpy()
    owner = np.searchsorted(np.array(OWNER_SHARES) * n_docs, df, side="right")
    owners = Owners(weights, owner, n_docs, n_terms)
    shared = spark.sparkContext.broadcast(queries)

    def added(key: tuple, carried: pa.Table, slices: pa.Table) -> pa.Table:
        bundle, shard = (k.as_py() for k in key)
        found = ((i, np.flatnonzero(total), total) for i, total in _added(bundle, carried, slices, shared.value))
        rows = [(i, at, total[at]) for i, at, total in found if len(at)]
        return pa.Table.from_arrays(
            [
                pa.array(np.full(len(rows), bundle, np.int32)), pa.array(np.full(len(rows), shard, np.int64)),
                pa.array([r[0] for r in rows], pa.int32()), _lists([r[1] for r in rows], pa.int32()),
                _lists([r[2] for r in rows], pa.int64()),
            ],
            names=["bundle", "shard", "item", "docs", "scores"],
        )

    def selected(key: tuple, carried: pa.Table, slices: pa.Table) -> pa.Table:
        """The best of each item in this shard."""
        order = np.argsort(slices["doc"].to_numpy())
        column = slices["doc_id"].take(pa.array(order))
        ids, missing = column.fill_null(0).to_numpy(), column.is_null().to_numpy()
        item, doc, score = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, total in _added(key[0].as_py(), carried, slices, shared.value):
            at = np.flatnonzero(total)
            if len(at) > best:
                at = at[total[at] >= np.partition(total[at], len(at) - best)[len(at) - best]]
            at = at[np.lexsort((ids[at], missing[at], -total[at]))[:best]]
            item.append(np.full(len(at), i, np.int32))
            doc.append(at)
            score.append(total[at])
        at = np.concatenate(doc)
        return pa.Table.from_arrays(
            [pa.array(np.concatenate(item)), pa.array(ids[at], mask=missing[at]), pa.array(np.concatenate(score))],
            names=["item", "doc_id", "score"],
        )

    keys = ("bundle", "shard")
    bundles = spark.createDataFrame([], _BUNDLES)
    last = len(OWNER_SHARES)
    for stage in range(last):
        slices = owners.slices(shards, queries, stage)
        bundles = bundles.groupBy(*keys).cogroup(slices.groupBy(*keys)).applyInArrow(added, _BUNDLES)
    frequent = owners.slices(shards, queries, last, every=True)
    rows = bundles.groupBy(*keys).cogroup(frequent.groupBy(*keys)).applyInArrow(selected, _FOUND)
    number = pa.table({"item": pa.array(range(len(queries.ids)), pa.int32()), "item_id": pa.array(queries.ids)})
    named = spark.createDataFrame(number).select(F.col("item").cast("int"), F.col("item_id").cast(kind))
    out = kept(rows.join(F.broadcast(named), "item").select("item_id", "doc_id", "score"), "lexical-best")
    dropped(shards)
    return out


def op12_search(spark, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return searched(docs, items)


OP12_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
d AS (SELECT r, doc_id, terms, len(terms) AS n FROM t WHERE len(terms) > 0),
c AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term, n_docs),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
s AS (
  SELECT item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
