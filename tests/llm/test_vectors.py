import numpy as np
from tests.conftest import MEDIUM
from tests.llm.brute import classes

from pyspark.sql import functions as F
from risklake.llm import neighbours
from risklake.llm.neighbours import nearest_neighbours, op1_nearest
from risklake.llm.vector_dedup import near_duplicates, op10_vector_dedup, passes_needed

ROW = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], ROW)


def plain(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


ODD = [
    (901, None), (902, []), (903, [0.0] * 8), (904, [1.0, None] + [0.0] * 6), (905, [float("nan")] + [1.0] * 7),
    (906, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (907, [1e30] * 8), (908, [1e-30] * 8), (909, [1.0, 2.0]), (910, [2.0, 4.1]),
]


def clusters(seed, groups, dim=8):
    rng = np.random.default_rng(seed)
    rows = []
    for size, spread in groups:
        centre = rng.normal(size=dim)
        rows += [centre + spread * rng.normal(size=dim) for _ in range(size)]
    order = rng.permutation(len(rows))
    return [(int(i), np.float32(r).tolist()) for i, r in zip(order, rows, strict=True)]


def brute_links(rows, least):
    unit = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and plain(v):
            x = np.array(v, np.float64)
            x = x / np.abs(x).max()
            unit[k] = x / np.sqrt((x * x).sum())
    return lambda a, b: a in unit and b in unit and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= least


def dedup_compared(spark, rows, **options):
    got = sorted(
        ((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows), **options).collect()),
        key=str,
    )
    linked = brute_links(rows, 0.9)
    of = classes(len(rows), linked)
    wanted = []
    for k, (i, _) in enumerate(rows):
        n = sum(linked(k, j) for j in range(len(rows)) if j != k)
        least = min((rows[j][0] for j in range(len(rows)) if of[j] == of[k] and rows[j][0] is not None), default=None)
        wanted.append((i is None, i or 0, n, least, i is None or i == least))
    assert got == sorted(wanted, key=str)


def test_dedup_against_brute_force(spark):
    rows = clusters(1, [(60, 0.02), (25, 0.15), (10, 0.3), *[(1, 0.0)] * 60]) + ODD
    rows += [(1000 + i, rows[0][1]) for i in range(5)]
    dedup_compared(spark, rows, window=8, block_rows=16)


def test_dedup_of_nothing(spark):
    dedup_compared(spark, [(1, None), (2, [0.0, 0.0])])
    assert near_duplicates(frame(spark, ODD).limit(0)).count() == 0


def test_dedup_finds_pairs_at_the_least_cosine(spark):
    """At a cosine just over the threshold nearly all planted pairs are found."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(300):
        a = rng.normal(size=32)
        a /= np.linalg.norm(a)
        b = rng.normal(size=32)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, np.float32(a).tolist()), (2 * k + 1, np.float32(0.905 * a + np.sqrt(1 - 0.905**2) * b).tolist())]
    got = {r.vec_id: r.component_id for r in near_duplicates(frame(spark, rows), window=8).collect()}
    assert np.mean([got[2 * k + 1] == 2 * k for k in range(300)]) >= 0.99
    assert passes_needed(10**9) > passes_needed(10**5) > passes_needed(100)


def test_dedup_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    got = op10_vector_dedup(spark, MEDIUM).collect()
    assert len(got) == len(rows)


def brute_nearest(rows, k):
    rows = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows if i is not None and plain(v)]
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            others = [(-float((v * w).cumsum()[-1]), i) for i, w in rows if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(others)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_nearest_of_few_vectors_are_all(spark):
    rng = np.random.default_rng(3)
    rows = [(i, np.float32(rng.normal(size=8) * rng.uniform(0.1, 9)).tolist()) for i in range(15)] + ODD[:-2]
    rows += [(40, [1.0] * 8), (41, [-1.0] * 8), (42, [1.0] * 8), (43, [1.0] * 8)]
    df = frame(spark, rows).withColumn("score", F.lit("clash"))
    assert found(nearest_neighbours(df, F.col("vec_id") % 20 == 0)) == brute_nearest(rows, 20)


def test_recall_and_ties(spark):
    """Vectors of different lengths, a crowd of near copies and one of equal vectors."""
    rng = np.random.default_rng(4)
    rows = clusters(6, [(1500, 1.0), (300, 0.01)], dim=16)
    rows += [(2000 + i, rows[3][1]) for i in range(60)]
    rows = [(i, (np.float32(v) * np.float32(rng.uniform(0.5, 2) if i < 2000 else 1)).tolist()) for i, v in rows]
    got, wanted = found(nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, part_rows=100)), brute_nearest(rows, 20)
    assert got.keys() == wanted.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) / 20 for q in wanted]
    assert np.mean(hits) >= 0.95
    exact = {q: dict(v) for q, v in brute_nearest(rows, 10**6).items()}
    assert all(s == exact[q][i] for q, v in got.items() for i, s in v)
    assert all([(-s, i) for i, s in v] == sorted((-s, i) for i, s in v) for v in got.values())


def test_nearest_of_nothing(spark):
    assert nearest_neighbours(frame(spark, ODD[:4]), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest_neighbours(frame(spark, ODD).limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_query_has_full_recall_here(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    got, wanted = found(op1_nearest(spark, MEDIUM)), brute_nearest(rows, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in wanted.items()}


def test_a_long_vector_does_not_take_neighbours_from_the_others(spark, monkeypatch):
    """Few candidates wanted, so that blocks are many and most of them empty."""
    monkeypatch.setattr(neighbours, "wanted_candidates", lambda n, trees, nearest: min(max(n // 10, 42 * trees), 200))
    rng = np.random.default_rng(12)
    unit = rng.normal(size=(2000, 16))
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    unit[7] *= 100
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(unit)]
    got = found(nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, trees=4, part_rows=100))
    wanted = brute_nearest(rows, 20)
    assert got.keys() == wanted.keys()
    assert {len(v) for v in got.values()} == {20}
    assert all(7 in dict(got[q]) for q in wanted if 7 in dict(wanted[q]))


def crowd(n, planted, seed=13, dim=64):
    """A third of the rows in one topic, unlinked among themselves but for planted pairs at a cosine of 0.905."""
    rng = np.random.default_rng(seed)
    length = lambda x: x / np.sqrt((x * x).sum(-1, keepdims=True))
    centre = length(rng.normal(size=dim))
    away = rng.normal(size=(n // 3, dim))
    away = length(away - (away @ centre)[:, None] * centre)
    topic = np.sqrt(0.78) * centre + np.sqrt(0.22) * away
    aside = rng.normal(size=(planted, dim))
    aside = length(aside - (aside * topic[:planted]).sum(1, keepdims=True) * topic[:planted])
    twins = 0.905 * topic[:planted] + np.sqrt(1 - 0.905**2) * aside
    return np.concatenate([topic, twins, length(rng.normal(size=(n - n // 3 - planted, dim)))])


def test_pairs_in_a_crowded_topic_are_found(spark):
    """Both the prefixes of one task and those dealt into blocks."""
    rows = [(i, np.float32(v).tolist()) for i, v in enumerate(crowd(6000, 300))]
    unit = np.array([v for _, v in rows])
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    wanted = (unit @ unit.T >= 0.9).sum(1) - 1
    for crowded_rows in (4096, 64):
        got = {r.vec_id: r.n_links for r in near_duplicates(frame(spark, rows), window=8, crowded_rows=crowded_rows).collect()}
        assert sum(got[i] != n for i, n in enumerate(wanted)) <= 0.002 * (wanted > 0).sum() + 1
