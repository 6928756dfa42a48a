"""Batches, buckets, incremental checks, reports from partial sums, pruned lookups."""

import hashlib
import io
from contextlib import redirect_stdout

import pytest
from books import tuples
from pyspark.sql import functions as F

from daybook.operators import documents as D
from daybook.operators.constraints import violations
from daybook.plans import jobs, stores
from daybook.plans.reports import entries, ledger_statement
from daybook.schemas import BANK, ENTITIES, LEDGERS, PURCHASES, SALES
from daybook.sources import batches, files, sinks

HEADERS = {e.name: ",".join(e.columns) for e in ENTITIES.values()}


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def buckets_shown(spark):
    """Plans tell the buckets they read only where Spark does not read them like plain files."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    yield
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def write(path, name, *lines):
    path.write_text("\n".join([HEADERS[name], *lines]) + "\n")
    return str(path)


@pytest.fixture
def parts(tmp_path):
    """Two deliveries; the second repeats keys of the first and refers to ledgers of both."""
    one = {
        "ledgers": write(tmp_path / "l1.csv", "ledgers", "L1,Ann,Customer", "L2,Bob,Supplier"),
        "sales": write(tmp_path / "s1.csv", "sales", "2024-01-01,A1,Ann,1,0,x,E", "2024-01-02,A2,Cid,2,0,x,E", "2024-01-02,A2,Ann,2,0,x,E"),
        "bank": write(tmp_path / "b1.csv", "bank", "2024-01-01,T1,Ann payment,5,credit,x", "2024-01-01,T2,only three"),
    }
    two = {
        "ledgers": write(tmp_path / "l2.csv", "ledgers", "L3,Cid,Customer", "L2,Ann,Customer"),
        "sales": write(tmp_path / "s2.csv", "sales", "2024-02-01,A1,Dan,1,0,x,E", "2024-02-01,A3,Cid,1,0,x,E", ",A4,Ann,1,0,x,E"),
    }
    return one, two


def whole(spark, store, name, ledgers=True):
    names = jobs.raw_rows(spark, store, "ledgers") if ledgers and ENTITIES[name].reference else None
    return tuples(violations(jobs.raw_rows(spark, store, name), ENTITIES[name], names))


def test_a_load_may_be_repeated(spark, tmp_path, parts):
    store = str(tmp_path / "store")
    for _ in range(3):
        done = jobs.load_raw(spark, parts[0], store, buckets=4)
    assert [jobs.raw_rows(spark, store, n).count() for n in ("ledgers", "sales", "bank")] == [2, 3, 1]
    assert files.scan_parquet(spark, done["bank_malformed"]).count() == 1
    jobs.load_raw(spark, parts[1], store, buckets=4)
    jobs.load_raw(spark, parts[0], store, buckets=4)
    assert [jobs.raw_rows(spark, store, n).count() for n in ("ledgers", "sales", "bank")] == [4, 6, 1]
    for name in ("ledgers", "sales"):
        assert tuples(stores.stored_violations(spark, store, name, buckets=4)) == whole(spark, store, name)
    listed = {(r.constraint, r.key, r.n_rows) for r in stores.stored_violations(spark, store, "sales", buckets=4).collect()}
    assert listed == {("primary_key", "A1", 2), ("primary_key", "A2", 2), ("not_null:date", "A4", 1), ("reference:party", "A1", 1)}


def test_a_batch_is_judged_with_what_is_stored(spark, tmp_path, parts):
    store = str(tmp_path / "store")
    jobs.load_raw(spark, parts[0], store, {"ledgers": "one", "sales": "one"}, buckets=4)
    first = files.scan_parquet(spark, f"{store}/sales_violations").drop("batch")
    assert tuples(first) == [("sales", "primary_key", "A2", 2), ("sales", "reference:party", "A2", 1)]
    jobs.load_raw(spark, parts[1], store, {"ledgers": "two", "sales": "two"}, buckets=4)
    second = files.scan_parquet(spark, f"{store}/sales_violations").filter("batch = 'two'").drop("batch")
    assert tuples(second) == [("sales", "not_null:date", "A4", 1), ("sales", "primary_key", "A1", 2), ("sales", "reference:party", "A1", 1)]


def test_a_corrected_batch_replaces_all_of_the_wrong_one(spark, tmp_path, parts):
    store = str(tmp_path / "store")
    jobs.load_raw(spark, parts[0], store, {"bank": "day-1", "sales": "day-1"}, buckets=4)
    mended = {"bank": write(tmp_path / "b.csv", "bank", "2024-01-01,T9,Ann payment,5,credit,x"), "sales": write(tmp_path / "s.csv", "sales")}
    done = jobs.load_raw(spark, mended, store, {"bank": "day-1", "sales": "day-1"}, buckets=4)
    assert [r.txn_id for r in jobs.raw_rows(spark, store, "bank").collect()] == ["T9"]
    # nothing is left of what the mended batch no longer has
    assert files.scan_parquet(spark, done["bank_malformed"]).count() == 0
    assert jobs.raw_rows(spark, store, "sales").count() == 0
    assert stores.stored_violations(spark, store, "sales", buckets=4).count() == 0


def test_a_failed_write_leaves_the_batch_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.sink_append(spark.range(5).withColumn("x", F.lit("a")), path, "one")
    broken = spark.range(100, numPartitions=4).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("stop"))).otherwise("b"))
    with pytest.raises(Exception, match="stop"):
        sinks.sink_append(broken, path, "one")
    assert {r.x for r in spark.read.parquet(path).collect()} == {"a"}
    with pytest.raises(Exception, match="stop"):
        sinks.sink_replace(broken, path)
    assert spark.read.parquet(path).count() == 5


def executed(spark):
    """Descriptions of the plans executed so far."""
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [done.apply(i).physicalPlanDescription() for i in range(done.size())]


def test_a_batch_is_not_sorted_by_its_name(spark, tmp_path):
    spark.range(0, 1000, 1, 4).selectExpr("id", "id % 7 as x").write.parquet(str(tmp_path / "rows"))
    before, writers = len(executed(spark)), "spark.sql.maxConcurrentOutputFileWriters"
    concurrent = spark.conf.get(writers)
    spark.conf.set(writers, "0")  # a session without daybook.session.SETTINGS
    try:
        assert batches.sink_batch(spark.read.parquet(str(tmp_path / "rows")).filter("x > 0"), str(tmp_path / "t"), "one") == 857
    finally:
        spark.conf.set(writers, concurrent)
    written = [p for p in executed(spark)[before:] if "WriteFiles" in p]
    assert written and not any("Sort" in p for p in written)


def test_lines_are_read_once_for_a_batch(spark, tmp_path, parts):
    """The name and the line breaks come from one pass; names stay what they were; malformed lines are looked for where there are any."""
    lines = spark.createDataFrame([(f"{i % 90},x",) for i in range(500)], "value string")
    lines.write.text(str(tmp_path / "many"))
    sums = [F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)")) for seed in (1, 2)]
    (tmp_path / "none").write_text("")
    for name in ("many", "none"):
        path = str(tmp_path / name)
        before = tuple(spark.read.text(path).agg(F.count("*"), *sums).first())
        assert batches.read_lines(spark, path) == ("b" + hashlib.sha256(repr(before).encode()).hexdigest()[:32], False)
    (tmp_path / "open").write_text('a,"b\nc",d\n')
    assert batches.read_lines(spark, str(tmp_path / "open"))[1]
    for name, scans in (("sales", 1), ("bank", 2)):  # one bank line is malformed
        before = len(executed(spark))
        jobs.load_raw(spark, {name: parts[0][name]}, str(tmp_path / "store"), buckets=2)
        new = executed(spark)[before:]
        assert ["xxhash64" in p for p in new if "replace(value" in p] == [True]
        assert sum("Scan csv" in p and "WriteFiles" in p for p in new) == scans
    assert files.scan_parquet(spark, str(tmp_path / "store/sales_malformed")).count() == 0


def test_buckets_grow_in_number(spark):
    assert [batches.buckets_for(n, 8) for n in (0, 10**6, 9 * 10**6, 270_000_001)] == [8, 8, 9, 271]


def test_batches_are_named_by_their_lines(spark, tmp_path):
    (tmp_path / "a").write_text("x\ny\ny\n")
    (tmp_path / "b").write_text("y\nx\ny\n")
    (tmp_path / "c").write_text("x\ny\n")
    names = [batches.batch_of(spark, str(tmp_path / n)) for n in "abc"]
    assert names[0] == names[1] != names[2] and names[0][0] == "b"
    for bad in ("2024-01-01", "", "a/b", "1e5"):
        with pytest.raises(ValueError, match="batch name"):
            batches.batch_name(bad)


def test_stored_values_are_not_shuffled(spark, tmp_path, purchases, ledgers):
    store = str(tmp_path / "store")
    stores.keep_values(ledgers, LEDGERS, store, "a", 8)
    for batch in ("a", "b"):
        stores.keep_values(purchases, PURCHASES, store, batch, 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for batch in (None, "b"):
            for found in (
                stores.repeated_values(spark, store, PURCHASES, "primary_key", batch, 8),
                stores.broken_references(spark, store, PURCHASES, batch, 8),
            ):
                assert "Exchange" not in plan(found) and "Bucketed: true" in plan(found)
        assert stores.repeated_values(spark, store, PURCHASES, "primary_key", "b", 8).count() == 4
        assert stores.broken_references(spark, store, PURCHASES, None, 8).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_reports_from_partial_sums(spark, tmp_path, sales, purchases, bank, ledgers):
    path = str(tmp_path / "state")
    tables = {"sales": sales, "purchases": purchases, "bank": bank}
    for name, test in (("may", F.col("date") < "2023-05-20"), ("rest", F.col("date") >= "2023-05-20"), ("may", F.col("date") < "2023-05-20")):
        stores.keep_sums({n: df.filter(test) for n, df in tables.items()}, path, name)
    kept = stores.analysis_of_state(spark, path, ledgers)
    for name, report in jobs.analysis({**tables, "ledgers": ledgers}).items():
        assert tuples(kept[name]) == tuples(report) and kept[name].schema == report.schema
    # nulls in any column
    rows = [(None, "A", None, None, None, None, None), (None, "B", "Olive & Vine", 5, None, None, None)]
    odd = spark.createDataFrame(rows, "date date, invoice_no string, party string, amount int, gst int, mode string, source string")
    odd = odd.select(*[F.col(f.name).cast(f.dataType) for f in SALES.schema])
    stores.keep_sums({"sales": odd}, path, "odd")
    kept = stores.analysis_of_state(spark, path, ledgers)
    for name, report in jobs.analysis({**tables, "sales": sales.union(odd), "ledgers": ledgers}).items():
        assert tuples(kept[name]) == tuples(report)


def test_lookups_read_one_bucket_of_few_months(spark, buckets_shown, tmp_path, sales, purchases, bank):
    path = str(tmp_path / "postings")
    postings = entries(sales, purchases, bank).unionByName(entries(sales, purchases, bank).limit(1).withColumn("date", F.lit(None).cast("date")))
    stores.keep_postings(postings, path, 4)
    found = stores.stored_statement(spark, path, "Harbour Bakery", "2023-05-03", "2023-05-31", 4)
    assert tuples(found) == tuples(ledger_statement(postings, "Harbour Bakery", "2023-05-03", "2023-05-31")) and found.count() == 2
    text = plan(found)
    assert "SelectedBucketsCount: 1 out of 4" in text and "PartitionFilters" in text and "m2023-05" in text
    # months that come again are replaced, others stay
    stores.keep_postings(postings.filter("date >= '2023-06-01'"), path, 4)
    assert stores.postings_table(path, 4).read(spark).count() == postings.count()


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path):
    """A task sorts what it is advised to take, however few buckets there are."""
    path, days = str(tmp_path / "postings"), "date_add(date'2024-01-01', cast(id % 60 as int)) as date"
    rows = spark.range(20000).selectExpr("concat('P', id % 50) as party_name", days, "cast(id % 999 as decimal(10,2)) as amount", "'debit' as nature")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        stores.keep_postings(rows, path, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    stored = stores.postings_table(path, 2).read(spark)
    assert len({name.rsplit("/", 1)[1][:10] for name in stored.inputFiles()}) > 2
    assert tuples(stored.drop("month").select(rows.columns)) == tuples(rows)
    found = stores.stored_statement(spark, path, "P7", "2024-01-20", "2024-02-10", 2)
    assert tuples(found) == tuples(ledger_statement(rows, "P7", "2024-01-20", "2024-02-10")) and found.count()


def test_stored_documents_are_found_in_their_bucket(spark, buckets_shown, tmp_path):
    coll = spark.range(200).select(F.col("id").cast("string").alias("_id"), F.struct((F.col("id") * 2).alias("n"), F.array("id").alias("a")).alias("doc"))
    path = str(tmp_path / "docs")
    D.keep(coll, path, buckets=4)
    one = D.get_stored(spark, path, coll.schema, "77", 4)
    assert [(r._id, r.doc.n, r.doc.a) for r in one.collect()] == [("77", 154, [77])]
    assert "SelectedBucketsCount: 1 out of 4" in plan(one)
    assert D.get_stored(spark, path, coll.schema, "x", 4).count() == 0


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('date,txn_id,description,amount,type,mode\n2024-01-01,T1,"one\ntwo ""quoted""\n\nthree",5,credit,x\n2024-01-01,T2,few\n')
    (tmp_path / "b.csv").write_text("date,txn_id,description,amount,type,mode\n2024-01-01,T3,plain,5,credit,x\n2024-01-01,T4,x,5,credit,x,more\n")
    assert files.has_line_breaks(spark, str(tmp_path / "a.csv")) and not files.has_line_breaks(spark, str(tmp_path / "b.csv"))
    rows = files.scan_csv(spark, str(tmp_path), BANK.schema, keep_corrupt=True).collect()
    good = {r.txn_id: r.description for r in rows if r[files.CORRUPT] is None}
    assert good == {"T1": 'one\ntwo "quoted"\n\nthree', "T3": "plain"}
    assert {r[files.CORRUPT].split(",")[1] for r in rows if r[files.CORRUPT] is not None} == {"T2", "T4"}
    assert files.scan_csv(spark, str(tmp_path)).rdd.getNumPartitions() == 2
    done = jobs.load_raw(spark, {"bank": str(tmp_path)}, str(tmp_path / "store"), buckets=4)
    assert files.scan_parquet(spark, done["bank"]).count() == 2 and files.scan_parquet(spark, done["bank_malformed"]).count() == 2


def test_batches_through_the_whole_job(spark, tmp_path):
    """Reports after two batches are those over both; a batch that comes again replaces itself; nothing older is read."""
    store = str(tmp_path / "store")
    ledgers = write(tmp_path / "l.csv", "ledgers", "L1,Ann,Customer", "L2,Bob,Supplier")
    one = {
        "ledgers": ledgers,
        "sales": write(tmp_path / "s1.csv", "sales", "2024-01-01,A1,Ann,100,0,x,E", "2024-01-09,A2,Eve,50,0,x,E", "never,A3,Ann,1,0,x,E"),
        "bank": write(tmp_path / "b1.csv", "bank", "2024-01-05,T1,Ann payment,70,credit,x", "2024-01-06,T2,Bob purchase,30,debit,x"),
    }
    two = {
        "sales": write(tmp_path / "s2.csv", "sales", "2024-02-01,A4,Ann,10,0,x,E"),
        "purchases": write(tmp_path / "p2.csv", "purchases", "2024-02-03,B1,Bob,40,0,x,E"),
        "bank": write(tmp_path / "b2.csv", "bank", "2024-02-05,T3,Ann payment,5,credit,x"),
    }
    jobs.etl_batch(spark, one, store, as_of="2024-12-31")
    for path in (one["sales"], one["bank"], ledgers):
        (tmp_path / path).unlink()  # the second run needs none of the first one's files
    reports = jobs.etl_batch(spark, two, store, as_of="2024-12-31")
    for _ in range(2):
        assert tuples(reports["monthly_trend"]) == [("2024-01", 100.0, 0.0), ("2024-02", 10.0, 40.0)]
        assert tuples(reports["party_outstanding"]) == [("Ann", "Customer", 110.0, 75.0, 35.0), ("Bob", "Supplier", 30.0, 40.0, -10.0)]
        assert tuples(reports["cash_flow"]) == [("2024-01", 70.0, 30.0, 40.0), ("2024-02", 5.0, 0.0, 5.0)]
        reports = jobs.etl_batch(spark, two, store, as_of="2024-12-31")
    assert [r.invoice_no for r in jobs.stored_rows(spark, store, "sales", "invalid").collect()] == ["A2"]
    refused = files.scan_parquet(spark, f"{store}/sales_rejected").select("raw.invoice_no", "reasons").collect()
    assert [(r.invoice_no, r.reasons) for r in refused] == [("A3", ["bad_date"])]
    # a table corrected by itself: the other tables of its first load stay
    mended = {"sales": write(tmp_path / "s3.csv", "sales", "2024-02-01,A4,Ann,15,0,x,E")}
    jobs.etl_batch(spark, {"sales": write(tmp_path / "s4.csv", "sales", "2024-03-01,A5,Ann,1,0,x,E")}, store, {"sales": "march"}, "2024-12-31")
    reports = jobs.etl_batch(spark, mended, store, {"sales": "march"}, "2024-12-31")
    assert ("2024-02", 25.0, 40.0) in tuples(reports["monthly_trend"]) and reports["monthly_trend"].count() == 2
