"""Scans, sinks and jobs on files."""

import pytest
from books import BANK_ROWS, LEDGER_ROWS, PURCHASE_ROWS, SALES_ROWS, rows_of, tuples
from pyspark.sql import functions as F

from daybook.operators.cleaning import clean
from daybook.plans import jobs
from daybook.plans.reports import monthly_trend
from daybook.schemas import BANK, ENTITIES, SALES, entity
from daybook.sources import files, jdbc, scratch, sinks

HEADERS = {
    "ledgers": "ledger_id,name,type",
    "sales": "date,invoice_no,party,amount,gst,mode",
    "purchases": "date,bill_no,supplier,amount,gst,mode",
    "bank": "date,txn_id,description,amount,type,mode",
}
ROWS = {"ledgers": LEDGER_ROWS, "sales": SALES_ROWS, "purchases": PURCHASE_ROWS, "bank": BANK_ROWS}


@pytest.fixture
def raw_files(tmp_path):
    paths = {}
    for name, header in HEADERS.items():
        extra = ",source" if name in ("sales", "purchases") else ""
        tail = ",ERP" if extra else ""
        lines = [header + extra, *[",".join(r) + tail for r in rows_of(ROWS[name])]]
        path = tmp_path / f"{name}.csv"
        path.write_text("\n".join(lines) + "\n")
        paths[name] = str(path)
    return paths


def test_columns_bind_by_name_not_by_position(spark, raw_files, sales):
    shuffled = SALES.schema
    df = files.scan_csv(spark, raw_files["sales"], shuffled)
    assert df.columns == SALES.columns and tuples(df) == tuples(sales)


def test_missing_header_column_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("txn_id,amount\nT1,1\n")
    with pytest.raises(ValueError, match="header lacks"):
        files.scan_csv(spark, str(tmp_path / "x.csv"), BANK.schema)


def test_corrupt_lines_are_kept(spark, tmp_path):
    (tmp_path / "b.csv").write_text(
        "txn_id,date,description,amount,type,mode\nT1,2024-01-05,x,12,credit,UPI\nT2,never,x,y,debit,UPI\n"
    )
    df = files.scan_csv(spark, str(tmp_path / "b.csv"), BANK.schema, keep_corrupt=True)
    good, bad = df.orderBy("txn_id").collect()
    assert good[files.CORRUPT] is None and bad[files.CORRUPT].startswith("T2,never")
    assert bad.date is None and bad.amount is None and bad.type == "debit"


def test_csv_round_trip_is_faithful(spark, tmp_path):
    rows = [(" padded ", None), ("", 'quo"te, comma'), (None, ""), ("\\N", "é₹")]
    df = spark.createDataFrame(rows, "a string, b string")
    sinks.sink_csv_overwrite(df, str(tmp_path / "out"))
    assert tuples(files.scan_csv(spark, str(tmp_path / "out"))) == sorted(rows, key=repr)


def test_every_part_is_read(spark, tmp_path):
    path = str(tmp_path / "parts")
    sinks.sink_csv_overwrite(spark.range(100).repartition(5).select(F.col("id").cast("string").alias("v")), path)
    assert len(files.part_files(spark, path)) == 5
    assert files.scan_part_dir(spark, path).count() == 100
    with pytest.raises(FileNotFoundError):
        files.scan_part_dir(spark, str(tmp_path / "nothing"))


def test_empty_frame_keeps_its_header(spark, tmp_path, sales):
    path = str(tmp_path / "none")
    sinks.sink_csv_overwrite(files.empty_relation(sales), path)
    back = files.scan_csv(spark, path, SALES.schema)
    assert back.columns == SALES.columns and back.count() == 0


def test_single_report_file(spark, tmp_path, sales, purchases):
    path = str(tmp_path / "trend")
    sinks.sink_single_csv(monthly_trend(sales, purchases), path)
    assert len(files.part_files(spark, path)) == 1


def test_append_and_replace(spark, tmp_path, sales):
    path = str(tmp_path / "t")
    sinks.sink_append(sales, path)
    sinks.sink_append(sales, path)
    assert files.scan_parquet(spark, path, SALES.schema).count() == 12
    sinks.sink_replace(sales.limit(3), path)
    assert files.scan_parquet(spark, path).count() == 3


def test_unknown_entity():
    assert entity("bank") is BANK
    with pytest.raises(ValueError):
        entity("stock")


def test_load_raw_reports_what_breaks_the_declaration(spark, tmp_path, raw_files):
    with open(raw_files["bank"], "a") as f:
        f.write("2023-06-30,K-90,x,5,refund,Wire\n2023-06-30,K-91,x,5,credit\n2023-06-30,K-92,x,5,credit,Wire,7\n")
    with open(raw_files["ledgers"], "a") as f:
        f.write("C-9,Harbour Bakery,Customer\n")
    stored = jobs.load_raw(spark, raw_files, str(tmp_path / "store"))
    found = [tuple(r) for n in ("bank", "ledgers") for r in files.scan_parquet(spark, stored[f"{n}_violations"]).drop("batch").collect()]
    assert sorted(found) == [("bank", "domain:type", "K-90", 1), ("ledgers", "unique:name", "Harbour Bakery", 2)]
    lines = {r.line for r in files.scan_parquet(spark, stored["bank_malformed"]).collect()}
    assert lines == {"2023-06-30,K-91,x,5,credit", "2023-06-30,K-92,x,5,credit,Wire,7"}
    assert files.scan_parquet(spark, stored["bank"]).count() == 8


def test_undeclared_and_missing_columns_are_errors(spark, tmp_path, raw_files):
    (tmp_path / "more.csv").write_text("ledger_id,name,type,colour\nL1,a,Customer,red\n")
    (tmp_path / "less.csv").write_text("ledger_id,name\nL1,a\n")
    for name, message in (("more", "declares no column"), ("less", "header lacks")):
        with pytest.raises(ValueError, match=message):
            jobs.clean_all(spark, {"ledgers": str(tmp_path / f"{name}.csv")}, str(tmp_path / "store"))


def test_nothing_is_lost_in_an_accepted_row(spark, tmp_path, raw_files):
    with open(raw_files["sales"], "a") as f:
        f.write('2023-05-09,A-90,Paper Lantern,1,"₹1,800",Wire,ERP\n2023-05-09,A-91,Paper Lantern,1,abc,Wire,ERP\n')
        f.write("2023-05-09,,Paper Lantern,1,1,Wire,ERP\n2023-05-09,A-93,Paper Lantern,1,1,Wire,ERP,9\n")
        f.write("2023-05-09,A-94,Paper Lantern,1\n2023-05-09,A-95,Paper Lantern,1,,Wire,ERP\n2023-05-09,A-96,,1,1,Wire,ERP\n")
    with open(raw_files["bank"], "a") as f:
        f.write("2023-06-30,K-90,Paper Lantern refund,5,refund,Wire\n")
    stored = jobs.etl_job(spark, raw_files, str(tmp_path / "store"), as_of="2023-12-31")
    refused = stored["sales_rejected"].read(spark).select("raw.*", "reasons").collect()
    assert {r.invoice_no: r.reasons for r in refused} == {
        "A-91": ["bad_gst"], None: ["null_key"], "A-93": ["malformed_line"], "A-94": ["malformed_line"], "A-96": ["null_party"],
    }
    assert {r.invoice_no: r.gst for r in refused}["A-91"] == "abc"
    assert {r[files.CORRUPT] for r in refused if r.reasons == ["malformed_line"]} == {
        "2023-05-09,A-93,Paper Lantern,1,1,Wire,ERP,9", "2023-05-09,A-94,Paper Lantern,1",
    }
    kept = {r.invoice_no: r.gst for r in stored["sales_cleaned"].read(spark).collect()}
    assert kept["A-90"] == 1800 and kept["A-95"] is None and len(kept) == 8
    assert [r.reasons for r in stored["bank_rejected"].read(spark).collect()] == [["domain_type"]]


def test_repeated_ledger_names_are_listed_and_count_once(spark, tmp_path, raw_files):
    with open(raw_files["ledgers"], "a") as f:
        f.write("Z-9,Harbour Bakery,Customer\n")
    stored = jobs.etl_job(spark, raw_files, str(tmp_path / "store"), as_of="2023-12-31")
    out = {name: side.read(spark) for name, side in stored.items()}
    assert tuples(out["ledgers_violations"]) == [("ledgers", "unique:name", "Harbour Bakery", 2)]
    assert out["valid_sales"].count() == 6 and out["sales_violations"].count() == 0
    balance = jobs.analysis({name: out[f"valid_{name}"] for name in ENTITIES})["party_outstanding"]
    assert {r.party_name: r.total_debit for r in balance.collect()}["Harbour Bakery"] == 1500.0


def test_a_single_file_is_bounded(spark, tmp_path):
    with pytest.raises(ValueError, match="at most 10 rows"):
        sinks.sink_single_csv(spark.range(11), str(tmp_path / "x"), max_rows=10)
    sinks.sink_single_csv(spark.range(10), str(tmp_path / "x"), max_rows=10)


def test_etl_job_on_the_small_books(spark, tmp_path, raw_files, sales, purchases):
    stored = jobs.etl_job(spark, raw_files, str(tmp_path / "store"), as_of="2024-12-31")
    out = {name: side.read(spark) for name, side in stored.items()}
    assert {n: df.count() for n, df in out.items() if n.startswith(("invalid", "valid"))} == {
        "valid_ledgers": 7, "valid_sales": 6, "valid_purchases": 4, "valid_bank": 7,
        "invalid_sales": 0, "invalid_purchases": 0, "invalid_bank": 0,
    }
    assert all(out[f"{name}_rejected"].count() == 0 for name in ENTITIES)
    assert out["valid_sales"].columns == [*SALES.columns, "ledger_id", "name", "type"]
    tables = {name: out[f"valid_{name}"] for name in ENTITIES}
    reports = jobs.analysis(tables)
    assert tuples(reports["monthly_trend"]) == tuples(monthly_trend(sales, purchases))
    balance = {r.party_name: r.outstanding for r in reports["party_outstanding"].collect()}
    assert balance["Olive & Vine"] == -500.0 and len(balance) == 7
    assert reports["cash_flow"].count() == 2


def test_etl_job_keeps_what_it_refuses(spark, tmp_path, raw_files):
    with open(raw_files["sales"], "a") as f:
        f.write("2024-13-45,INV900,Harbour Bakery,₹10,1,UPI,ERP\n")
        f.write('2024-01-09,INV901, Nobody Ltd ,"₹1,000",1,UPI,ERP\n')
    with open(raw_files["bank"], "a") as f:
        f.write("2024-01-09,TX900,wire from Harbour Bakery House,5,credit,UPI\n")
        f.write("2024-01-09,TX901,,5,credit,UPI\n")
    stored = jobs.etl_job(spark, raw_files, str(tmp_path / "store"), as_of="2024-12-31")
    refused = stored["sales_rejected"].read(spark).select("raw.*", "reasons").collect()
    assert [(r.invoice_no, r.amount, r.reasons) for r in refused] == [("INV900", "₹10", ["bad_date"])]
    invalid = stored["invalid_sales"].read(spark).collect()
    assert [(r.invoice_no, r.party, float(r.amount)) for r in invalid] == [("INV901", "Nobody Ltd", 1000.0)]
    assert [r.txn_id for r in stored["invalid_bank"].read(spark).collect()] == ["TX901"]
    assert stored["valid_bank"].read(spark).filter("txn_id = 'TX900'").count() == 1
    cleaned = clean(files.scan_csv(spark, raw_files["sales"]), "2024-12-31")
    assert stored["sales_cleaned"].read(spark).count() == cleaned.count() == 7


def test_scratch_folder_comes_from_the_session(spark):
    root = spark.conf.get(scratch.SETTING, None)
    first, second = scratch.scratch_dir(spark, "x"), scratch.scratch_dir(spark, "x")
    assert first != second and (root is None or first.startswith(root))


def test_jdbc_options_and_predicates():
    target = jdbc.JdbcTarget("jdbc:x:y", "some.Driver", {"user": "u", "password": "p"}, fetch_size=5)
    options = target.options(dbtable="sales", **jdbc.Ranges("date", "2020-01-01", "2024-12-31", 8).options())
    assert options["partitionColumn"] == "date" and options["numPartitions"] == "8" and options["fetchsize"] == "5"
    predicates = jdbc.hash_predicates("txn_id", 3)
    assert predicates[0].endswith("OR txn_id IS NULL") and len(predicates) == 3
    with pytest.raises(ValueError):
        jdbc.hash_predicates("txn_id", 0)
    with pytest.raises(ValueError):
        jdbc.scan_jdbc(None, target, "t", ranges=jdbc.Ranges("a", 0, 1, 2), predicates=["1=1"])


def test_jdbc_key_ranges_types_and_connections(spark):
    target = jdbc.JdbcTarget("jdbc:x:y", "some.Driver", connections=4)
    assert target.options(numPartitions=target.connections)["numPartitions"] == "4"
    assert "`amount` decimal(10,2)" in jdbc.typed_options(BANK)["customSchema"]
    assert "NTILE(8) OVER (ORDER BY txn_id)" in jdbc.quantiles_query("bank", "txn_id", 8)
    df = spark.createDataFrame([(f"T{i}",) for i in range(50)] + [(None,), ("it's",)], "txn_id string")
    for bounds in ([], ["T2"], ["T1", "T1", "T35", "it's"]):
        parts = [df.filter(p.replace("''", "\\'")) for p in jdbc.key_ranges("txn_id", bounds)]
        assert sum(p.count() for p in parts) == 52 and len(parts) == len(set(bounds)) + 1


def test_hash_predicates_cover_every_row_once(spark):
    df = spark.createDataFrame([(f"T{i}",) for i in range(50)] + [(None,)], "txn_id string")
    predicates = jdbc.hash_predicates("txn_id", 4, hash_expr="crc32(encode({key}, 'UTF-8')) % {n}")
    parts = [df.filter(p) for p in predicates]
    assert sum(p.count() for p in parts) == 51
