"""From dirty CSV to layers: the twelve injected rows and their outcomes."""

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import types as T

from risklake.config import RAW_SCHEMA, RuleBounds
from risklake.operators.quality import quality_rules
from risklake.plans.lakehouse import Lake
from risklake.sources import raw_files
from risklake.sources.raw_files import file_digests, file_signatures, land_copy, read_as_text, read_raw, reconcile, reconcile_bytes, write_raw_csv

COLUMNS = RAW_SCHEMA.names


def clean_rows(n=40):
    """Valid rows, all different, one per hour."""
    start = dt.datetime(2025, 1, 1)
    channels, kinds = ("app", "web", "pos", "atm"), ("varejo", "viagem", "saude")
    return [
        {
            "transaction_id": i,
            "customer_id": 1 + i % 7,
            "amount": f"{5 + i}.25",
            "transaction_type": "compra",
            "channel": channels[i % 4],
            "merchant_category": kinds[i % 3],
            "timestamp": str(start + dt.timedelta(hours=173 * i)),
            "status": "declined" if i % 9 == 0 else "approved",
            "risk_score": f"{(i * 7) % 100}.5",
            "segment": ("Premium", "Standard", "High-Risk")[i % 3],
            "credit_score": 300 + 5 * i,
            "is_fraud": "True" if i % 9 == 0 else "False",
        }
        for i in range(1, n + 1)
    ]


# --- fixed values: what is broken in each injected row, and its outcome ---
# None: accepted after clean-up. Scores differ so that no injected row repeats another.
INJECTED = (
    (900003, {"amount": "-150.00", "risk_score": "41.25"}, "valor_invalido"),
    (900004, {"amount": "0", "risk_score": "42.25"}, "valor_invalido"),
    (900005, {"risk_score": "150"}, "risk_score_invalido"),
    (900006, {"credit_score": "1000", "risk_score": "43.25"}, "credit_score_invalido"),
    (900007, {"timestamp": "2024-06-10 10:00:00", "risk_score": "44.25"}, "timestamp_invalido"),
    (900008, {"channel": "whatsapp", "risk_score": "45.25"}, "canal_fora_dominio"),
    (900009, {"is_fraud": "talvez", "risk_score": "46.25"}, "rotulo_invalido"),
    (900010, {"customer_id": "0", "risk_score": "47.25"}, "cliente_fora_faixa"),
    (900011, {"channel": " APP ", "merchant_category": "Viagem", "risk_score": "48.25"}, None),
    (900012, {"amount": "abc", "risk_score": "49.25"}, "reject"),
)
# --- end of fixed values ---


def dirty_rows(clean):
    copies = [
        (clean[10] | {}, "duplicata_id;duplicata_conteudo"),
        (clean[20] | {"transaction_id": 900002}, "duplicata_conteudo"),
    ]
    return copies + [
        (clean[0] | {"transaction_id": id_} | broken, outcome) for id_, broken, outcome in INJECTED
    ]


def write_csv(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=COLUMNS)
        w.writeheader()
        w.writerows(rows)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    clean = clean_rows()
    write_csv(folder / "in.csv", clean + [r for r, _ in dirty_rows(clean)])
    lake = Lake(spark, str(folder / "lake"), RuleBounds())
    proof = lake.build_from_csv(str(folder / "in.csv")).first()
    return clean, lake, proof


def test_landing_is_proven(loaded):
    clean, _, proof = loaded
    assert proof.asDict() == {
        "linhas_origem": len(clean) + 12,
        "linhas_destino": len(clean) + 12,
        "integro": True,
    }


def test_counts(loaded):
    clean, lake, _ = loaded
    assert lake.raw.count() == len(clean) + 11
    assert lake.bronze.count() == len(clean) + 1
    assert lake.quarantine.count() == 10
    assert lake.silver.count() == len(clean) + 1
    assert len(lake.silver.columns) == 22


def test_injected_outcomes(loaded):
    clean, lake, _ = loaded
    reasons = {r.transaction_id: r.motivo for r in lake.quarantine.collect()}
    for row, expected in dirty_rows(clean):
        if expected not in (None, "reject"):
            assert reasons[row["transaction_id"]] == expected
    assert set(reasons) == {clean[10]["transaction_id"], *range(900002, 900011)}
    normal = lake.bronze.where("transaction_id = 900011").first()
    assert (normal.channel, normal.merchant_category) == ("app", "viagem")


def test_one_copy_of_each_clean_row_stays(loaded):
    clean, lake, _ = loaded
    kept = [r.transaction_id for r in lake.bronze.collect()]
    assert sorted(kept) == sorted([r["transaction_id"] for r in clean] + [900011])


def test_schema_reject_is_recorded(loaded):
    _, lake, _ = loaded
    assert [tuple(r) for r in lake.layer("raw/rejeitadas").collect()] == [
        ("900012", "amount", "abc")
    ]


def test_marts_conserve_rows(loaded):
    _, lake, _ = loaded
    for mart in lake.marts().values():
        assert mart.groupBy().sum("transacoes").first()[0] == lake.silver.count()


def test_malformed_lines_and_several_bad_cells(spark, tmp_path):
    good = clean_rows(3)
    path = tmp_path / "x.csv"
    write_csv(path, good + [{**good[0], "transaction_id": 9, "amount": "x", "credit_score": "y"}])
    with open(path, "a", encoding="utf-8") as f:
        f.write("10,1,2.5\n")
        f.write(",".join(["11"] * 14) + "\n")
    kept, rejects = read_raw(spark, str(path))
    assert kept.count() == 3
    assert kept.select("transaction_id").count() == 3  # a pruned read sees the same rows
    found = sorted((r.transaction_id, r.coluna) for r in rejects.collect())
    assert found == [("10", "*"), ("11", "*"), ("9", "amount"), ("9", "credit_score")]


def test_reconcile_notices_changes(spark, tmp_path):
    rows = clean_rows(5)
    write_csv(tmp_path / "a.csv", rows)
    write_csv(tmp_path / "b.csv", rows[::-1])
    write_csv(tmp_path / "c.csv", rows[:-1] + [rows[0]])
    a, b, c = (str(tmp_path / f"{n}.csv") for n in "abc")
    assert reconcile(spark, a, b).first().integro
    assert not reconcile(spark, a, c).first().integro
    signatures = [r.md5 for r in file_signatures(spark, a).collect()]
    assert len(signatures) == 1 and len(signatures[0]) == 32


def test_split_files_lose_no_line(spark, tmp_path):
    """Large files land in several parts, of which only the first has the header."""
    rows = clean_rows(120)
    write_csv(tmp_path / "a.csv", rows)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    dst = str(tmp_path / "landing")
    land_copy(session, str(tmp_path / "a.csv"), dst)
    assert len(session.read.text(dst).inputFiles()) > 3
    assert reconcile(session, str(tmp_path / "a.csv"), dst).first().integro
    kept, rejects = read_raw(session, dst)
    assert kept.count() == 120 and rejects.count() == 0


def test_rule_order_and_count():
    assert len(quality_rules(RuleBounds())) == 14


NOTE = T.StructType([T.StructField("id", T.LongType()), T.StructField("nota", T.StringType()), T.StructField("n", T.IntegerType())])


@pytest.fixture()
def small_ranges(spark):
    """Files are read in ranges of 64 bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("64", "0"), strict=True):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def notes(n=200, seed=1):
    rng = random.Random(seed)
    pieces = ["a", "b", ",", '"', "\n", "x y", " ", '",\n"']
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))).strip() or "q", i) if i % 3 == 0 else (i, "plain", i) for i in range(n)]


def cells(df):
    return sorted((int(r.id), r.nota) for r in df.collect())


def test_line_breaks_in_cells_of_split_files(spark, small_ranges, tmp_path):
    rows, src, dst = notes(), str(tmp_path / "notas"), str(tmp_path / "copia")
    write_raw_csv(spark.createDataFrame(rows, NOTE).coalesce(2), src)
    assert spark.read.text(src).rdd.getNumPartitions() > 20
    want = [(i, t) for i, t, _ in rows]
    good, rejects = read_raw(spark, src, NOTE)
    assert cells(good) == want and rejects.count() == 0
    # A copy cut into parts within a cell still has whole records.
    land_copy(spark, src, dst)
    assert len(list((tmp_path / "copia").rglob("part-*"))) > 20
    good, rejects = read_raw(spark, dst, NOTE)
    assert cells(good) == want and rejects.count() == 0


def test_quoted_header_and_quotes_left_open(spark, small_ranges, tmp_path, monkeypatch):
    file = tmp_path / "aberto.csv"
    open_quote = "".join(f"{i},fine,{i}\n" for i in range(20, 30))
    file.write_text('"id","nota","n"\n1,"two\nlines",1\n2,inch 5" mark,2\n' + '3,"never closed,3\n' + open_quote)
    text = read_as_text(spark, str(file), NOTE).collect()
    found = {r.id: r.nota for r in text if r[raw_files.BAD_LINE] is None}
    assert found["1"] == "two\nlines" and found["2"] == 'inch 5" mark'
    assert {str(i) for i in range(20, 30)} <= found.keys() and "id" not in found
    monkeypatch.setattr(raw_files, "MOST_LINES", 1)
    assert "two\nlines" not in {r.nota for r in read_as_text(spark, str(file), NOTE).collect()}


def test_landing_is_true_to_the_byte(spark, small_ranges, tmp_path):
    src, dst = tmp_path / "origem", tmp_path / "destino"
    (src / "b").mkdir(parents=True)
    raw = b"id,nota,n\r\n" + b"".join(b"%d,caf\xe9 \xff,%d\r\n" % (i, i) for i in range(50)) + b"\n\nlast,\r,1\n"
    (src / "a.csv").write_bytes(raw)
    (src / "b" / "a.csv").write_bytes(raw[: len(raw) // 2] + b"\n")
    for name in ("a.csv", "b/a.csv"):
        land_copy(spark, str(src / name), str(dst / name))
        row = reconcile_bytes(spark, str(src / name), str(dst / name), NOTE).first()
        assert row.integro and row.linhas_origem == row.linhas_destino
        parts = sorted((dst / name).rglob("part-*"), key=lambda p: int(p.name.split("-")[1]))
        assert len(parts) > 3 and b"".join(p.read_bytes() for p in parts) == (src / name).read_bytes()
    assert file_digests(spark, str(src / "a.csv"), NOTE).first().bytes == len(raw)
    for change in (lambda b: b.replace(b"\r\n", b"\n", 1), lambda b: b.replace(b"\xff", b"\xfe", 1), lambda b: b + b"x\n"):
        part = next(p for p in sorted(dst.rglob("a.csv/arquivo=*/part-*")) if b"\xff" in p.read_bytes() and "/b/" not in str(p))
        before = part.read_bytes()
        part.write_bytes(change(before))
        for crc in part.parent.glob(f".{part.name}.crc"):
            crc.write_bytes(b"")
        assert not reconcile_bytes(spark, str(src / "a.csv"), str(dst / "a.csv"), NOTE).first().integro
        part.write_bytes(before)


def test_lines_in_another_order_are_not_the_same_file(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "a" / "x.csv").write_text("1,a,1\n2,b,2\n")
    (tmp_path / "b" / "x.csv").write_text("2,b,2\n1,a,1\n")
    digests = {file_digests(spark, str(tmp_path / d), NOTE).first().resumo for d in "ab"}
    assert len(digests) == 2


def test_records_over_many_ranges_of_a_file(spark, tmp_path):
    """Cells over two to four lines, some over the end of a range, and lines that only keep the state."""
    cells = {k: "x\n" * (k % 4) + f"y{k}" for k in range(400)}
    lines = [raw_files.header_line()]
    lines += [f'{k},1,2.0,compra,app,saude,2025-02-03 04:05:06,approved,1.0,"{v}",500,1' for k, v in cells.items()]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        good, bad = raw_files.read_raw(spark, str(tmp_path))
        assert {r.transaction_id: r.segment for r in good.collect()} == cells and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_record_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text(raw_files.header_line() + "\n")
    good, _ = raw_files.read_raw(spark, str(tmp_path))
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
