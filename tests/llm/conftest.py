import pytest

#: Columns that operators use themselves; inputs may have them too.
CLASHING = "shard slot fp mark key range guest tree edited n text_hash anchor id spans best guess band score salt mix_kept mix_tokens id__ mark__ i__ m__".split()


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema="doc_id bigint, text string, lang string, source string, n_chars bigint", clashing=True):
        df = spark.createDataFrame(rows, schema)
        if clashing:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit("taken").alias(c) for c in CLASHING])
        return df

    return make


@pytest.fixture(scope="session")
def odd(frame):
    """Documents with nulls everywhere, empty, blank, very long and repeated texts, and clashing columns."""
    prose = "The quick brown fox jumps over the lazy dog near the old stone bridge. "
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \n\t ", "en", "a", 4),
        (4, prose * 3000, "en", "a", None),
        (5, prose, "en", None, 71),
        (6, "Der schnelle Fuchs springt über den faulen Hund.\nUnd noch eine Zeile, ganz ohne Sinn.", "de", "b", None),
        (7, "Der schnelle Fuchs springt über den faulen Hund.\nUnd noch eine Zeile, ganz ohne Sinn.", "de", "b", None),
        (8, "𝄞𝄞 12 !!", None, "b", 8),
        (None, prose, "en", "a", None),
        (None, None, None, None, None),
        (9, prose, "en", "a", 71),
        (9, prose, "en", "a", 71),
    ]
    return frame(rows)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])


@pytest.fixture(scope="session")
def sf(spark):
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
