"""Reference checks of postings against the ledger.

Sales and purchases name their party, so the check is an equi join.  A bank line
is valid when its description *contains* some ledger name, which read literally
is a nested loop over bank x ledger.  ``contains_any`` turns it into equi joins
only; ``match_bank`` sends just the rows an ordinary party match leaves over
through it.

Ledger joins carry no broadcast hint: Spark broadcasts the ledger when it finds it
under ``spark.sql.autoBroadcastJoinThreshold`` (from statistics, or measured at
run time by AQE) and shuffles it otherwise, with AQE splitting hot parties on the
posting side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import text

# Names are looked up by one of their grams of 1, 2, 4, 8 or 16 characters: the longest of these
# that fits.  A text emits one window per position for each length in use.
GRAM_LENGTHS = (1, 2, 4, 8, 16)


def _gram_length(name: Column) -> Column:
    return F.greatest(*[F.when(F.length(name) >= n, F.lit(n)) for n in GRAM_LENGTHS], F.lit(0))


def _anchors(names: DataFrame) -> DataFrame:
    """(_gram, _off, _len): where each name's rarest gram stands in it, and how long the name is.

    Rare is what few names have: a beginning that all share ("Customer#") anchors none of them.  Of equally
    rare grams the last is taken, since names that begin alike differ behind.
    """
    distinct = names.select("_name").distinct().withColumn("_n", _gram_length(F.col("_name")))
    last = F.when(F.col("_n") == 0, 1).otherwise(F.length("_name") - F.col("_n") + 1)
    grams = distinct.withColumn("_off", F.explode(F.sequence(F.lit(1), last)))
    grams = grams.withColumn("_gram", F.substring(F.col("_name"), F.col("_off"), F.col("_n")))
    known = grams.groupBy("_gram").agg(F.count_distinct("_name").alias("_names"))
    rarest = grams.join(known, "_gram").groupBy("_name").agg(F.min(F.struct("_names", (-F.col("_off")).alias("_back"), "_gram")).alias("_best"))
    return rarest.select("_best._gram", (-F.col("_best._back")).alias("_off"), F.length("_name").alias("_len")).distinct()


def contains_candidates(texts: DataFrame, text_col: str, names: DataFrame, name_col: str) -> DataFrame:
    """(_text, _name): the pieces of each text that may be a name, because a name's anchor stands there."""
    text_of = texts.filter(F.col(text_col).isNotNull()).select(F.col(text_col).alias("_text")).distinct()
    # texts that share a key share candidates, and each candidate is checked against its text
    text_of = text_of.withColumn("_key", F.xxhash64("_text"))
    anchors = _anchors(names.filter(F.col(name_col).isNotNull()).select(F.col(name_col).alias("_name")))
    in_use = anchors.select(F.length("_gram").alias("_n")).distinct()
    windows = (
        text_of.withColumn("_n", F.explode(F.lit([0, *GRAM_LENGTHS])))
        .filter(F.length("_text") >= F.col("_n"))
        .join(in_use, "_n", "left_semi")
        # an empty name needs one position only
        .withColumn("_last", F.when(F.col("_n") == 0, 1).otherwise(F.length("_text") - F.col("_n") + 1))
        .withColumn("_at", F.explode(F.sequence(F.lit(1), F.col("_last"))))
        .select("_key", "_at", F.substring(F.col("_text"), F.col("_at"), F.col("_n")).alias("_gram"))
    )
    starts = windows.join(anchors, "_gram").select("_key", (F.col("_at") - F.col("_off") + 1).alias("_at"), "_len").filter("_at >= 1")
    return (
        starts.join(text_of, "_key")
        .filter(F.col("_at") + F.col("_len") - 1 <= F.length("_text"))
        .select("_text", F.substring(F.col("_text"), F.col("_at"), F.col("_len")).alias("_name"))
    )


def contains_any(texts: DataFrame, text_col: str, names: DataFrame, name_col: str) -> DataFrame:
    """Distinct texts that contain at least one of the names (case-sensitive).

    1. every name is anchored at its rarest gram: the gram, its place in the name, the name's length;
    2. every text emits (key, position, gram) for the gram lengths in use, without
       the text itself, and an equi join keeps those that are some name's anchor - one row per
       anchor, however many names share it;
    3. the text is joined back by its key, and the full-length substring around that position
       is joined to the names by equality, which settles the match exactly.

    No pair of a text with a non-matching name is ever formed.  An empty name is
    contained in every text.  Nothing runs when this is called.
    """
    wanted = names.filter(F.col(name_col).isNotNull()).select(F.col(name_col).alias("_name"))
    hits = contains_candidates(texts, text_col, names, name_col).join(wanted, "_name", "left_semi")
    return hits.select(F.col("_text").alias(text_col)).distinct()


def semi_contains(df: DataFrame, text_col: str, names: DataFrame, name_col: str) -> DataFrame:
    """Rows whose text contains some name."""
    return df.join(contains_any(df, text_col, names, name_col), text_col, "left_semi").select(df.columns)


def anti_contains(df: DataFrame, text_col: str, names: DataFrame, name_col: str) -> DataFrame:
    """The complement, NULL texts included."""
    return df.join(contains_any(df, text_col, names, name_col), text_col, "left_anti").select(df.columns)


def one_per_name(ledgers: DataFrame) -> DataFrame:
    """One ledger row per name: the one with the smallest id, then the smallest other columns.

    Ledger names are declared unique; where they are not (``check_unique`` lists them), a posting
    must still count once.  Rows without a name reference nothing and stay out.
    """
    rest = [c for c in ledgers.columns if c not in ("ledger_id", "name")]
    order = F.struct(*[c for c in ("ledger_id", "name", *rest) if c in ledgers.columns])
    kept = ledgers.filter(F.col("name").isNotNull()).groupBy(F.col("name").alias("_by")).agg(F.min(order).alias("_row"))
    return kept.select(*[F.col("_row")[c].alias(c) for c in ledgers.columns])


def _settled_bank(bank: DataFrame, ledgers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bank rows whose parsed party is a ledger name, the rest, and the rest's descriptions that contain a name.

    A parsed party that equals a ledger name is contained in its description, so one equi
    join settles these rows; only the distinct texts of the rest are searched.
    """
    # the key is a column: a sort-merge join on the expression would work it out
    # again for every comparison of the sort
    names = ledgers.filter(F.col("name").isNotNull()).select(F.col("name").alias("_party")).distinct()
    keyed = bank.withColumn("_party", text.description_party(F.col("description")))
    keyed = keyed.join(names.withColumn("_direct", F.lit(True)), "_party", "left")
    direct, rest = (keyed.filter(c).select(bank.columns) for c in (F.col("_direct").isNotNull(), F.col("_direct").isNull()))
    return direct, rest, contains_any(rest, "description", ledgers, "name")


def flag_bank(bank: DataFrame, ledgers: DataFrame) -> DataFrame:
    """Every bank row with ``valid``; only rows that the parsed party does not settle meet the search's result."""
    direct, rest, hits = _settled_bank(bank, ledgers)
    judged = rest.join(hits.withColumn("_hit", F.lit(True)), "description", "left")
    judged = judged.select(*bank.columns, F.col("_hit").isNotNull().alias("valid"))
    return direct.withColumn("valid", F.lit(True)).unionByName(judged)


def match_bank(bank: DataFrame, ledgers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) bank rows; together they are the input, NULLs invalid.

    Each side is a plan of its own; where both are wanted, ``flag_bank`` has them in one.
    """
    direct, rest, hits = _settled_bank(bank, ledgers)
    valid = direct.unionByName(rest.join(hits, "description", "left_semi").select(bank.columns))
    return valid, rest.join(hits, "description", "left_anti").select(bank.columns)


def match_party(df: DataFrame, ledgers: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(valid with the ledger columns appended, invalid as they came); a name held twice counts once."""
    on = F.col(column) == F.col("name")
    return df.join(one_per_name(ledgers), on, "inner"), df.join(ledgers, on, "left_anti")


def flag_party(df: DataFrame, ledgers: DataFrame, column: str) -> DataFrame:
    """Every row with its ledger columns, NULL where there is no ledger, and ``valid``."""
    joined = df.join(one_per_name(ledgers), F.col(column) == F.col("name"), "left")
    return joined.withColumn("valid", F.col("name").isNotNull())


def flag_references(df: DataFrame, ledgers: DataFrame, column: str, table_type: str) -> DataFrame:
    """Both sides of ``validate_references`` in one frame, told apart by ``valid``."""
    if table_type in ("sales", "purchases"):
        return flag_party(df, ledgers, column)
    if table_type == "bank":
        return flag_bank(df, ledgers)
    raise ValueError(f"unknown table_type {table_type!r}; expected sales, purchases or bank")


def validate_references(
    df: DataFrame, ledgers: DataFrame, column: str, table_type: str, null_policy: str = "keep"
) -> tuple[DataFrame, DataFrame]:
    """Split postings into valid and invalid ones.

    ``null_policy="drop"`` leaves bank rows without a description out of both
    sides; by default they are invalid.
    """
    if table_type in ("sales", "purchases"):
        return match_party(df, ledgers, column)
    if table_type == "bank":
        valid, invalid = match_bank(df, ledgers)
        if null_policy == "drop":
            invalid = invalid.filter(F.col("description").isNotNull())
        return valid, invalid
    raise ValueError(f"unknown table_type {table_type!r}; expected sales, purchases or bank")
