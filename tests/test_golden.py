"""Published result tables: finer ones re-aggregate to coarser ones."""

import pytest
from pyspark.sql import functions as F

from risklake.operators.metrics import kpi
from risklake.plans import analyses, panels

# --- fixed values: published segment x channel results ---
SEGMENT_CHANNEL = [
    ("High-Risk", "app", 1176, 162, 22917.10),
    ("High-Risk", "web", 860, 64, 9607.73),
    ("High-Risk", "atm", 273, 20, 4016.06),
    ("High-Risk", "pos", 606, 36, 5615.15),
    ("Standard", "app", 4296, 195, 27890.56),
    ("Standard", "atm", 1019, 23, 4822.87),
    ("Standard", "web", 3258, 60, 14740.54),
    ("Standard", "pos", 2072, 34, 3420.93),
    ("Premium", "app", 6549, 98, 13102.25),
    ("Premium", "web", 4886, 33, 7230.95),
    ("Premium", "atm", 1715, 11, 3556.37),
    ("Premium", "pos", 3290, 15, 2447.42),
]
BY_SEGMENT = {
    "High-Risk": (2915, 9.7, 282, 37.5, 9.67, 3.86, 42156.04),
    "Standard": (10645, 35.5, 312, 41.5, 2.93, 1.17, 50874.90),
    "Premium": (16440, 54.8, 157, 20.9, 0.95, 0.38, 26336.99),
}
BY_CHANNEL = {
    "app": (12021, 40.1, 455, 60.6, 3.79, 1.51, 63909.91),
    "atm": (3007, 10.0, 54, 7.2, 1.80, 0.72, 12395.30),
    "web": (9004, 30.0, 157, 20.9, 1.74, 0.70, 31579.22),
    "pos": (5968, 19.9, 85, 11.3, 1.42, 0.57, 11483.50),
}
HOURS = [
    (1288, 40), (1233, 55), (1259, 39), (1234, 41), (1277, 43), (1262, 29), (1192, 32), (1284, 39),
    (1231, 27), (1248, 22), (1291, 29), (1268, 23), (1238, 26), (1246, 29), (1249, 28), (1322, 31),
    (1171, 33), (1241, 15), (1169, 17), (1280, 26), (1194, 35), (1250, 39), (1301, 24), (1272, 29),
]
BY_PERIOD = {"madrugada": (7553, 247), "manha": (7514, 172), "tarde": (7467, 162), "noite": (7466, 170)}
# --- end of fixed values ---


@pytest.fixture(scope="module")
def cube(spark):
    return spark.createDataFrame(
        SEGMENT_CHANNEL,
        "segment string, channel string, transacoes long, fraudes long, valor_fraude double",
    )


@pytest.mark.parametrize("dim,expected", [("segment", BY_SEGMENT), ("channel", BY_CHANNEL)])
def test_rollup_matches_published(cube, dim, expected):
    got = {r[dim]: tuple(r)[1:] for r in kpi(cube, [dim], cube).collect()}
    assert got == expected


def test_hours_add_up_to_periods(spark):
    hourly = spark.createDataFrame(
        [(h, n, f) for h, (n, f) in enumerate(HOURS)], "hora int, n long, f long"
    )
    from risklake.config import PERIODS
    from risklake.functions.bands import band

    got = (
        hourly.groupBy(band(F.col("hora"), PERIODS).alias("p"))
        .agg(F.sum("n"), F.sum("f"))
        .collect()
    )
    assert {r[0]: (r[1], r[2]) for r in got} == BY_PERIOD


def test_known_segment_result(medium_lake):
    # --- fixed values: expected on the sf0.01 tables ---
    expected = {
        "High-Risk": (8740, 20.5, 1338, 56.1, 15.31, 2.74, 67060063.69),
        "Standard": (17208, 40.3, 764, 32.0, 4.44, 0.80, 38043063.84),
        "Premium": (16752, 39.2, 282, 11.8, 1.68, 0.30, 15003291.90),
    }
    got = {r.segment: tuple(r)[1:] for r in analyses.by_segment(medium_lake).collect()}
    assert got == expected


def test_invariants(lake):
    assert lake.bronze.count() + lake.quarantine.count() == lake.raw.count()
    for r in panels.curve(lake.cube, min_n=30).collect():
        assert 0 <= r.pct_volume_acum <= 100 and 0 <= r.pct_fraudes_acum <= 100
        last = r
    assert (last.pct_volume_acum, last.pct_fraudes_acum) == (100.0, 100.0)
    rates = lake.cube.select(F.expr("100.0 * fraudes / transacoes").alias("t"))
    assert rates.where("t < 0 OR t > 100").count() == 0
