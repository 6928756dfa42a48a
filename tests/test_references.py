"""Reference checks: edge rows, and equality with the literal definition."""

import random
from decimal import Decimal

import pytest
from books import tuples
from pyspark.sql import functions as F

from daybook.operators import references as R
from daybook.schemas import BANK, LEDGERS

DAY = None


def make_bank(spark, texts):
    return spark.createDataFrame(
        [(DAY, f"T{i}", text, Decimal(1), "credit", None) for i, text in enumerate(texts)], BANK.schema
    )


def make_ledgers(spark, names):
    return spark.createDataFrame([(f"L{i}", n, "Customer") for i, n in enumerate(names)], LEDGERS.schema)


def split(spark, texts, names):
    valid, invalid = R.match_bank(make_bank(spark, texts), make_ledgers(spark, names))
    return [r.description for r in valid.collect()], [r.description for r in invalid.collect()]


def literal(texts, names):
    valid = [t for t in texts if t is not None and any(n is not None and n in t for n in names)]
    return valid, [t for t in texts if t is None or t not in valid]


def test_substring_of_a_longer_name_matches_and_case_counts(spark):
    valid, invalid = split(spark, ["Harbour Bakery House payment", "harbour bakery payment"], ["Harbour Bakery"])
    assert valid == ["Harbour Bakery House payment"] and invalid == ["harbour bakery payment"]


def test_null_descriptions_are_invalid_unless_dropped(spark):
    bank, ledgers = make_bank(spark, [None, "Ann payment", "Cash"]), make_ledgers(spark, ["Ann", None])
    valid, invalid = R.validate_references(bank, ledgers, "description", "bank")
    assert valid.count() == 1 and {r.description for r in invalid.collect()} == {None, "Cash"}
    _, invalid = R.validate_references(bank, ledgers, "description", "bank", null_policy="drop")
    assert [r.description for r in invalid.collect()] == ["Cash"]


def test_empty_ledger_makes_all_rows_invalid(spark):
    valid, invalid = split(spark, ["a payment", None], [])
    assert valid == [] and set(invalid) == {"a payment", None}


def test_empty_name_is_contained_in_every_text(spark):
    valid, invalid = split(spark, ["a payment", "", None], [""])
    assert sorted(valid) == ["", "a payment"] and invalid == [None]


def test_repeated_names_do_not_multiply_bank_rows(spark):
    valid, invalid = split(spark, ["Ann payment", "to Ann"], ["Ann", "Ann"])
    assert sorted(valid) == ["Ann payment", "to Ann"] and invalid == []


def test_unknown_table_type(spark, ledgers, bank):
    with pytest.raises(ValueError):
        R.validate_references(bank, ledgers, "description", "stock")
    with pytest.raises(ValueError):
        R.flag_references(bank, ledgers, "description", "stock")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("seed", range(2))
def test_same_as_literal_containment(spark, seed, threshold):
    # at -1 nothing is broadcast at all
    rng = random.Random(seed)
    alphabet = "ab é₹𝄞"

    def word(longest):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest)))

    names = [word(rng.choice([2, 5, 9, 20])) for _ in range(25)] + [None]
    texts = [word(40) for _ in range(60)] + [f"{rng.choice(names[:-1])} payment" for _ in range(20)]
    texts += [f"{word(6)}{rng.choice(names[:-1])}{word(6)}" for _ in range(20)] + [None, "", "x"]
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = split(spark, texts, names)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
    want = literal(texts, names)
    assert [sorted(map(repr, side)) for side in got] == [sorted(map(repr, side)) for side in want]


def test_semi_and_anti_contains_split_the_input(spark):
    texts = ["see Bob's", None, "none", "Bobby", "bob"]
    bank, names = make_bank(spark, texts), make_ledgers(spark, ["Bob"])
    semi = R.semi_contains(bank, "description", names, "name")
    anti = R.anti_contains(bank, "description", names, "name")
    assert sorted(r.description for r in semi.collect()) == ["Bobby", "see Bob's"]
    assert {r.description for r in anti.collect()} == {None, "none", "bob"}


def test_plans_start_no_job_and_see_names_added_before_the_run(spark, tmp_path):
    path = str(tmp_path / "ledgers")
    make_ledgers(spark, ["Ann"]).write.parquet(path)
    ledgers = spark.read.schema(LEDGERS.schema).option("recursiveFileLookup", True)
    bank = make_bank(spark, ["to Ann", "to a much longer name", "x"])
    spark.sparkContext.setJobGroup("planning", "")
    try:
        flagged = R.flag_bank(bank, ledgers.parquet(path))
        semi = R.semi_contains(bank, "description", make_ledgers(spark, ["Ann"]), "name")
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert flagged.filter("valid").count() == 1 and semi.count() == 1
    make_ledgers(spark, ["much longer name"]).write.mode("append").parquet(path)
    assert R.flag_bank(bank, ledgers.parquet(path)).filter("valid").count() == 2


def test_repeated_names_do_not_multiply_postings(spark, sales, ledgers):
    twice = ledgers.unionByName(ledgers.withColumn("ledger_id", F.concat(F.lit("X"), "ledger_id")))
    valid, invalid = R.match_party(sales, twice, "party")
    assert valid.count() == sales.count() and invalid.count() == 0
    assert {r.ledger_id[0] for r in valid.collect()} == {"C"}
    assert R.flag_party(sales, twice, "party").count() == sales.count()


def test_no_nested_loop_in_any_plan(spark):
    bank, names = make_bank(spark, ["Ann payment"]), make_ledgers(spark, ["Ann"])
    for df in (*R.match_bank(bank, names), R.flag_bank(bank, names)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_flags_agree_with_the_split(spark, sales, ledgers):
    few = ledgers.filter("name <> 'Harbour Bakery'")
    valid, invalid = R.match_party(sales, few, "party")
    flagged = R.flag_party(sales, few, "party")
    assert tuples(flagged.filter("valid").drop("valid")) == tuples(valid)
    assert tuples(flagged.filter("not valid").select(sales.columns)) == tuples(invalid)

    bank = make_bank(spark, ["Ann payment", "to Ann", "x", None])
    valid, invalid = R.match_bank(bank, make_ledgers(spark, ["Ann"]))
    flagged = R.flag_bank(bank, make_ledgers(spark, ["Ann"]))
    assert tuples(flagged.filter("valid").drop("valid")) == tuples(valid)
    assert tuples(flagged.filter("not valid").drop("valid")) == tuples(invalid)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_one_party_with_most_rows(spark, threshold):
    """A party, and a text, holding two thirds of the rows give whole results."""
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        n = 30_000
        text = (
            F.when(F.col("id") % 3 == 0, F.lit("Hot Party payment"))
            .when(F.col("id") % 3 == 1, F.lit("via Hot Party today"))
            .otherwise(F.concat(F.lit("Stranger "), F.col("id"), F.lit(" payment")))
        )
        bank = spark.range(n).select(F.col("id").cast("string").alias("txn_id"), text.alias("description"))
        ledgers = make_ledgers(spark, ["Hot Party", *[f"Party {i}" for i in range(500)]])
        valid, invalid = R.match_bank(bank, ledgers)
        assert valid.count() == 2 * n // 3 and invalid.count() == n // 3
        assert valid.select("txn_id").distinct().count() == 2 * n // 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", default)
