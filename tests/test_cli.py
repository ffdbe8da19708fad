"""The command line over a small CSV file."""

import glob

import pytest

from risklake.__main__ import PANELS, REPORTS, main, parse_bounds
from risklake.plans.catalog import CATALOG
from tests.test_csv_load import clean_rows, write_csv


def test_bounds_are_typed():
    b = parse_bounds(["customer_max=20", "amount_max=5", "ts_from=2024-01-01 00:00:00"])
    assert (b.customer_max, b.amount_max, b.ts_from) == (20, 5.0, "2024-01-01 00:00:00")


def test_command_lists_name_known_queries():
    assert set(REPORTS) | set(PANELS) <= set(CATALOG)


@pytest.fixture(scope="module")
def cli_lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cli")
    write_csv(folder / "in.csv", clean_rows(50))
    main(["build", str(folder / "lake"), str(folder / "in.csv"), "--bounds", "customer_max=5"])
    return folder


def test_build_applies_bounds(spark, cli_lake):
    lake = str(cli_lake / "lake")
    silver = spark.read.parquet(f"{lake}/silver/transactions")
    quarantine = spark.read.parquet(f"{lake}/quarentena")
    assert silver.count() + quarantine.count() == 50
    assert {r.motivo for r in quarantine.collect()} == {"cliente_fora_faixa"}


def test_reports_write_one_csv_each(spark, cli_lake, monkeypatch):
    monkeypatch.setattr("risklake.__main__.REPORTS", ["a0", "a1a", "a5c"])
    main(["reports", str(cli_lake / "lake"), str(cli_lake / "out")])
    for name in ("a0", "a1a", "a5c"):
        assert glob.glob(f"{cli_lake}/out/{name}/part-*.csv")
    got = spark.read.option("header", True).csv(f"{cli_lake}/out/a5c")
    assert got.count() == 6


def test_panels_write_json(spark, cli_lake, monkeypatch):
    monkeypatch.setattr("risklake.__main__.PANELS", ["panel_kpis", "panel_heat_hour_dow"])
    main(["panels", str(cli_lake / "lake"), str(cli_lake / "json")])
    assert spark.read.json(f"{cli_lake}/json/panel_heat_hour_dow").count() == 168
