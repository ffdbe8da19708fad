"""Mix sources to target weights by pivotal dependent rounding, in DataFrame operations.

Every item shall be taken ``ratio`` times, the target of its source over the
source's size. The whole part is certain. The fractions are rounded in pairs: a
pair moves words from one item to the other until one of the two is whole, with
chances that keep both expectations. What a block of pairs leaves over, one item
at most, is an item of a block one level up, so a source's sum of taken words
misses its target by less than the size of one item.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from risklake.llm.words import word_count
from risklake.session import written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
FAN_IN = 64
SEED = 8
#: Repeats of one row that a task writes out by itself.
REPEATS = 4096
#: Different rows of one id, source and size that are numbered together, about.
NUMBERED = 1024


def source_targets(
    items: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """Per source: source_size, target words, ratio, and the number of its items.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share
    all words; a target stops at ``max_repeat`` times the source's size and the
    excess goes to the others by weight. With sources ordered by size over
    weight, those that stop come first, so two running sums give the share. The
    unpartitioned windows run over one row per source.
    """
    sources = items.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).cast("decimal(38,0)").alias("s"),
        F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("n_items"),
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, weights)), (place % len(weights)).cast("int"))
    whole = F.lit(math.lcm(*weights)).cast("decimal(9,0)")
    everything = Window.partitionBy()
    ordered = Window.orderBy("by", "place")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    ranked = (
        sources.withColumn("place", place)
        .withColumn("w", weight.cast("decimal(9,0)"))
        .withColumn("by", F.col("s") * (whole / F.col("w")).cast("decimal(9,0)"))
        .withColumn("cap", (F.col("s") * max_repeat).cast("decimal(38,0)"))
        .withColumn("pos", F.row_number().over(ordered))
        .withColumn("left_s", F.sum("s").over(everything) - F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("left_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), zero))
        .withColumn("open", F.col("cap") * F.col("left_w") > F.col("left_s") * F.col("w"))
    )
    first = F.min(F.when(F.col("open"), F.struct("pos", "left_s", "left_w"))).over(everything)
    target = F.when(
        F.col("pos") >= F.col("first.pos"),
        F.col("first.left_s").cast("double") * F.col("w").cast("double") / F.col("first.left_w").cast("double"),
    ).otherwise(F.col("cap").cast("double"))
    return ranked.withColumn("first", first).select(
        "source",
        F.col("s").cast("long").alias("source_size"),
        target.alias("target"),
        F.when(F.col("s") > 0, target / F.col("s").cast("double")).otherwise(0.0).alias("ratio"),
        "n_items",
    )


def _chance(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * 2.0**-53


def _pair(state: Column, x: Column, seed: int) -> Column:
    """One pivotal step: the item carried so far meets x; one of them becomes whole."""
    c = state["carry"]
    gain = F.least(c["w"] * (1 - c["p"]), x["w"] * x["p"])
    loss = F.least(c["w"] * c["p"], x["w"] * (1 - x["p"]))
    up = _chance(c["h"], x["h"], F.lit(seed)) * (gain + loss) < loss

    def item(of: Column, p: Column) -> Column:
        return F.struct(
            of["w"].alias("w"), of["h"].alias("h"), of["doc_id"].alias("doc_id"),
            F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("p"),
        )

    fills, empties = c["w"] * (1 - c["p"]) <= x["w"] * x["p"], c["w"] * c["p"] <= x["w"] * (1 - x["p"])
    carry = (
        F.when(up & fills, item(x, x["p"] - gain / x["w"]))
        .when(up, item(c, c["p"] + gain / c["w"]))
        .when(empties, item(x, x["p"] + loss / x["w"]))
        .otherwise(item(c, c["p"] - loss / c["w"]))
    )
    mark = lambda of: F.array(F.struct(of["doc_id"].alias("doc_id"), of["w"].alias("w")))
    ups = (
        F.when(up & fills, F.concat(state["ups"], mark(c)))
        .when(~up & ~empties, F.concat(state["ups"], mark(x)))
        .otherwise(state["ups"])
    )
    return F.struct(carry.alias("carry"), ups.alias("ups"))


def _blocks(items: DataFrame, seed: int, name: str) -> DataFrame:
    """Per (source, block): the item left over and those rounded up.

    Large items come first: what is left over is then a small one as a rule.
    """
    one = F.sort_array(F.collect_list(F.struct("w", "h", "doc_id", "p")), asc=False)
    grouped = items.groupBy("source", "block").agg(one.alias("all"))
    none = F.array().cast("array<struct<doc_id:bigint,w:double>>")
    folded = F.aggregate(
        F.slice("all", 2, F.size("all")),
        F.struct(F.get("all", F.lit(0)).alias("carry"), none.alias("ups")),
        lambda s, x: _pair(s, x, seed),
    )
    return written(grouped.select("source", "block", folded.alias("r")).select("source", "block", "r.*"), name)


def mix(
    items: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    fan_in: int = FAN_IN,
    seed: int = SEED,
) -> DataFrame:
    """Copies to take of each item.

    ``items``: source, doc_id, size, and n, the number of equal rows. Returns
    them with source_size, target and copies, which is at most n * max_repeat and
    0 for items without words. Blocks are dealt by a hash of the item, about
    ``fan_in`` to a block, so a source of any share of the rows is many blocks.
    """
    whole = F.floor(F.col("n") * F.col("ratio"))
    targets = written(source_targets(items, weights, max_repeat), "mix-targets").withColumnRenamed("source", "src")
    base = (
        items.join(targets, items.source.eqNullSafe(F.col("src")))
        .drop("src")
        .withColumn("whole", F.when(F.col("size") > 0, whole).otherwise(F.lit(0)).cast("long"))
        .withColumn("p", F.when(F.col("size") > 0, F.col("n") * F.col("ratio") - F.col("whole")).otherwise(0.0))
    )
    level = base.filter("p > 0").select(
        "source", "doc_id", F.col("size").cast("double").alias("w"), "p",
        F.xxhash64("source", "doc_id", "size", F.lit(seed)).alias("h"),
        F.ceil(F.col("n_items") / fan_in).alias("blocks"),
    ).withColumn("block", F.pmod("h", "blocks"))
    blocks = targets.agg(F.max(F.ceil(F.col("n_items") / fan_in))).first()[0] or 0
    rounded, k = [], 0
    while True:
        done = _blocks(level, seed + k, "mix-blocks")
        rounded.append(done.select("source", F.explode("ups").alias("u")).select("source", "u.*"))
        if blocks <= 1:
            break
        blocks, k = math.ceil(blocks / fan_in), k + 1
        level = done.select("source", F.floor(F.col("block") / fan_in).alias("block"), "carry.*")
    last = done.filter(_chance(F.col("carry.h"), F.lit(seed), F.lit("last")) < F.col("carry.p"))
    up = last.select("source", F.col("carry.doc_id").alias("doc_id"), F.col("carry.w").alias("w"))
    for r in rounded:
        up = up.unionByName(r)
    up = up.select(
        F.col("source").alias("u_source"), F.col("doc_id").alias("u_doc"), F.col("w").cast("long").alias("u_size"),
        F.lit(1).alias("up"),
    )
    same = (
        base.doc_id.eqNullSafe(up.u_doc) & (base["size"] == up.u_size) & base.source.eqNullSafe(up.u_source)
    )
    return base.join(up, same, "left").select(
        *items.columns, "source_size", "target", (F.col("whole") + F.coalesce("up", F.lit(0))).alias("copies")
    )


def items_of(docs: DataFrame) -> DataFrame:
    """Distinct (source, doc_id, size) of documents with the number of their rows, written once."""
    rows = docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"))
    return written(rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")), "mix-items")


def _share(copies: Column, n: Column, k: Column) -> Column:
    """Copies of the k-th of n equal rows, k from 1."""
    return F.floor((copies + n - k) / n).cast("long")


def _unfolded(rows: DataFrame, times: str, number: str) -> DataFrame:
    """Each row ``times`` times, numbered from 1. Long runs are dealt over the tasks in pieces."""
    one = F.lit(1).cast("long")
    few = rows.filter(F.col(times).between(1, REPEATS)).withColumn(number, F.explode(F.sequence(one, F.col(times))))
    starts = F.sequence(one, F.col(times), F.lit(REPEATS).cast("long"))
    many = rows.filter(F.col(times) > REPEATS).withColumn("_mix_start", F.explode(starts))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = many.repartition(tasks, "doc_id", "source", "_mix_start")
    last = F.least(F.col(times), F.col("_mix_start") + (REPEATS - 1))
    spread = spread.withColumn(number, F.explode(F.sequence(F.col("_mix_start"), last))).drop("_mix_start")
    return few.unionByName(spread)


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """Per document: size, source_size, target of its source, and the words taken.

    NULL texts have no words and are never taken; NULL ids and repeated rows are
    items like others; an empty table has an empty result. Needs doc_id, source
    and text; other columns are ignored.
    """
    return _unfolded(mix(items_of(docs), **options), "n", "k").select(
        "doc_id", "size", "source_size", "target",
        (_share(F.col("copies"), F.col("n"), F.col("k")) * F.col("size")).alias("taken"),
    )


def _dealt(joined: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that share id, source and size, with the copies each takes (``_mix_take``).

    Rows equal in all columns are folded to one with their number. The others are
    numbered by a hash of all columns: pieces of a group by that hash, each shifted by
    the rows of the pieces before it. The result is the same in any order of the rows.
    """
    key = ["_mix_doc", "_mix_source", "_mix_size"]
    hashed = F.xxhash64(*columns)
    rows = joined.groupBy(*columns, *key, "_mix_n", "_mix_copies").agg(F.count("*").alias("_mix_equal"))
    rows = rows.withColumn("_mix_hash", hashed).withColumn(
        "_mix_piece", F.pmod("_mix_hash", F.ceil(F.col("_mix_n") / NUMBERED))
    )
    earlier = lambda w: F.coalesce(
        F.sum("_mix_equal").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    inside = Window.partitionBy(*key, "_mix_piece").orderBy("_mix_hash", F.xxhash64(F.lit(SEED), *columns))
    # A row per piece of a group.
    pieces = rows.groupBy(*key, "_mix_piece").agg(F.sum("_mix_equal").alias("_mix_equal"))
    shift = pieces.select(
        *[F.col(c).alias(f"{c}_of") for c in (*key, "_mix_piece")],
        earlier(Window.partitionBy(*key).orderBy("_mix_piece")).alias("_mix_shift"),
    )
    same = [rows[c].eqNullSafe(F.col(f"{c}_of")) for c in (*key, "_mix_piece")]
    placed = rows.withColumn("_mix_before", earlier(inside)).join(shift, same)
    extra = F.col("_mix_copies") % F.col("_mix_n") - F.col("_mix_before") - F.col("_mix_shift")
    whole = F.col("_mix_equal") * F.floor(F.col("_mix_copies") / F.col("_mix_n"))
    more = F.least(F.greatest(extra, F.lit(0)), F.col("_mix_equal"))
    return placed.select(*columns, (whole + more).cast("long").alias("_mix_take"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, in the columns of ``docs``.

    NULL texts and texts without words are never taken. Rows that share id (also
    NULL), source and size split their copies as evenly as whole copies allow, in
    the order of a hash of all columns. An empty table has an empty result. Columns
    must be of types that can be grouped (no maps).
    """
    taken = mix(items_of(docs), **options).select(
        F.col("source").alias("_mix_source"), F.col("doc_id").alias("_mix_doc"), F.col("size").alias("_mix_size"),
        F.col("n").alias("_mix_n"), F.col("copies").alias("_mix_copies"),
    ).filter("_mix_copies > 0")
    sized = docs.withColumn("_mix_words", word_count(F.col("text")))
    joined = sized.join(
        taken,
        sized["doc_id"].cast("long").eqNullSafe(F.col("_mix_doc"))
        & sized["source"].eqNullSafe(F.col("_mix_source"))
        & (sized["_mix_words"] == F.col("_mix_size")),
    )
    once = joined.filter("_mix_n = 1").withColumn(
        "_mix_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies")))
    )
    more = _unfolded(_dealt(joined.filter("_mix_n > 1"), docs.columns), "_mix_take", "_mix_k")
    return once.select(*docs.columns).unionByName(more.select(*docs.columns))


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mixed_sizes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
