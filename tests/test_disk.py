"""What the jobs leave on disk while they run: codecs, shuffle files, files that are not read any more."""

import os
import time

from books import tuples
from pyspark.sql import functions as F
from test_stores import write

from daybook.plans import jobs, stores
from daybook.schemas import PURCHASES
from daybook.sources import files, sinks
from daybook.sources.scratch import drop_dir, free_shuffles, scratch_dir
from daybook.suite import queries


def parts_of(path):
    return [f"{folder}/{name}" for folder, _, names in os.walk(path) for name in names if name.startswith("part-")]


def shuffled(spark):
    """Shuffle files that Spark keeps; those nothing refers to go within seconds."""
    manager, last = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), None
    for _ in range(40):
        found = manager.getAllFiles()
        kept = {found.apply(i).getName() for i in range(found.size())}
        if kept == last:
            return {name for name in kept if name.startswith("shuffle_")}
        last = kept
        time.sleep(0.25)
    raise AssertionError("files come and go")


def test_compressed_parts_are_read_as_they_were_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "PART_ROWS", 100)
    rows = spark.range(0, 1000, 1, 2).select(F.concat(F.lit(" a,\"b "), "id").alias("x"), F.when(F.col("id") % 3 > 0, F.lit("")).alias("y"))
    for codec, suffix in ((None, ".csv"), ("gzip", ".csv.gz")):
        path = str(tmp_path / str(codec))
        sinks.sink_csv_overwrite(rows, path, codec)
        assert all(p.endswith(suffix) for p in parts_of(path)) and tuples(files.scan_part_dir(spark, path)) == tuples(rows)
    assert len(parts_of(tmp_path / "None")) == 2 and len(parts_of(tmp_path / "gzip")) == 10


def test_values_are_shuffled_once(spark, tmp_path, purchases):
    store = str(tmp_path / "store")
    stores.keep_values(purchases.unionByName(purchases.limit(2)), PURCHASES, store, "a", 4)
    kept = stores.values_table(store, PURCHASES, "bill_no", 4)
    # a bucket is one sorted file, a value one row
    names = [os.path.basename(p) for p in parts_of(kept.path)]
    assert all(".zstd." in n for n in names) and len({n.rsplit("_", 1)[1] for n in names}) == len(names)
    assert sorted(r.n_rows for r in kept.read(spark).collect()) == [1, 1, 2, 2]
    assert [r.n_rows for r in stores.repeated_values(spark, store, PURCHASES, "primary_key", None, 4).collect()] == [2, 2]


def test_files_may_go_once_their_lines_are_stored(spark, tmp_path):
    table = {
        "bank": write(tmp_path / "b.csv", "bank", "2024-01-01,T1,Ann payment,5,credit,x", "2024-01-01,T2,only three"),
        "ledgers": write(tmp_path / "l.csv", "ledgers", "L1,Ann,Customer"),
        "sales": write(tmp_path / "s.csv", "sales", "2024-01-01,A1,Ann,1,0,x,E"),
    }
    gone = []

    def drop(name):
        os.remove(table[name])
        gone.append(name)

    store = str(tmp_path / "store")
    free_shuffles(spark)
    before = shuffled(spark)
    done = jobs.load_raw(spark, table, store, buckets=2, read=drop)
    assert shuffled(spark) <= before  # nor do shuffles stay
    assert sorted(gone) == ["bank", "ledgers", "sales"] and gone[-1] == "bank"  # the largest table when the others are done
    assert [files.scan_parquet(spark, done[n]).count() for n in ("bank", "bank_malformed", "ledgers", "sales")] == [1, 1, 1, 1]
    assert all(".zstd." in p for n in done for p in parts_of(done[n]))


def test_a_scratch_folder_can_be_dropped(spark):
    path = scratch_dir(spark, "some")
    spark.range(3).write.parquet(path)
    drop_dir(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def csv_folders(root):
    labels = ("ledgers-", "sales-", "purchases-", "bank-")
    return {os.path.join(folder, n) for folder, names, _ in os.walk(root) for n in names if n.startswith(labels)}


def test_load_raw_drops_its_csv_files(spark):
    root = os.path.dirname(scratch_dir(spark, "x").removeprefix("file:"))
    before = csv_folders(root)
    assert queries()["load_raw"](spark, "/root/testdata/sf0.001").count() > 1000
    assert csv_folders(root) == before


def test_load_batches_drops_its_csv_files(spark):
    root = os.path.dirname(scratch_dir(spark, "x").removeprefix("file:"))
    before = csv_folders(root)
    assert queries()["load_batches"](spark, "/root/testdata/sf0.001").count() > 1000
    assert csv_folders(root) == before


def books(tmp_path):
    return {
        "bank": write(tmp_path / "b.csv", "bank", "2024-01-01,T1,Ann payment,5,credit,x", "2024-01-01,T2,only three", "2024-01-03,T3,for Bob purchase,5,debit,x"),
        "ledgers": write(tmp_path / "l.csv", "ledgers", "L1,Ann,Customer", "L2,Bob,Supplier"),
        "sales": write(tmp_path / "s.csv", "sales", "2024-01-01,A1,Ann,1,0,x,E", "2024-01-01,A2,Eve,1,0,x,E"),
        "purchases": write(tmp_path / "p.csv", "purchases", "2024-01-01,B1,Bob,1,0,x,E"),
    }


def dropper(table):
    gone = []

    def drop(name):
        os.remove(table[name])
        gone.append(name)

    return gone, drop


def test_files_may_go_once_they_are_cleaned(spark, tmp_path):
    table, store = books(tmp_path), str(tmp_path / "store")
    gone, drop = dropper(table)
    free_shuffles(spark)
    before = shuffled(spark)
    stored = jobs.etl_job(spark, table, store, "2024-06-01", drop)
    assert sorted(gone) == sorted(table) and gone[-1] == "bank"  # the largest table when the others are done
    assert shuffled(spark) <= before
    sides = ("bank_rejected", "valid_bank", "invalid_bank", "valid_sales", "invalid_sales", "valid_purchases", "sales_violations")
    assert [stored[n].read(spark).count() for n in sides] == [1, 2, 0, 1, 1, 1, 1]
    written = parts_of(store)
    assert written and all(".zstd." in p for p in written)


def test_etl_rows_drops_its_csv_files(spark):
    root = os.path.dirname(scratch_dir(spark, "x").removeprefix("file:"))
    before = csv_folders(root)
    assert queries()["etl_rows"](spark, "/root/testdata/sf0.001").count() > 1000
    assert csv_folders(root) == before


def test_clean_all_drops_its_csv_files(spark):
    root = os.path.dirname(scratch_dir(spark, "x").removeprefix("file:"))
    before = csv_folders(root)
    assert queries()["clean_all"](spark, "/root/testdata/sf0.001").count() > 1000
    assert csv_folders(root) == before


def test_etl_job_drops_its_csv_files(spark):
    root = os.path.dirname(scratch_dir(spark, "x").removeprefix("file:"))
    before = csv_folders(root)
    assert queries()["etl_job"](spark, "/root/testdata/sf0.001").count() == 15
    assert csv_folders(root) == before


def test_etl_batches_drops_its_csv_files(spark):
    root = os.path.dirname(scratch_dir(spark, "x").removeprefix("file:"))
    before = csv_folders(root)
    assert queries()["etl_batches"](spark, "/root/testdata/sf0.001").count() > 100
    assert csv_folders(root) == before


def test_a_batch_is_cleaned_and_its_files_may_go(spark, tmp_path):
    table, store = books(tmp_path), str(tmp_path / "store")
    gone, drop = dropper(table)
    reports = jobs.etl_batch(spark, table, store, dict.fromkeys(table, "one"), "2024-06-01", drop)
    assert sorted(gone) == sorted(table) and gone[-1] == "bank"
    assert [r.month for r in reports["monthly_trend"].collect()] == ["2024-01"]
    assert [jobs.stored_rows(spark, store, n, s).count() for n, s in (("bank", "valid"), ("bank", "invalid"), ("sales", "invalid"))] == [2, 0, 1]
