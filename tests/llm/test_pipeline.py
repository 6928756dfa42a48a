"""The stages against brute force over the whole small table."""

import corpus_pipeline as P
from pyspark.sql import functions as F

from daybook.llm import decontam, langid, raking, rendezvous, simhash
from daybook.llm.common import stored, table
from daybook.llm.queries import QUERIES


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    given = {r.doc_id: tuple(r) for r in docs.collect()}
    steps = []
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf), name)
        assert docs.columns == columns
        rows = {r.doc_id: tuple(r) for r in docs.collect()}
        assert len(rows) == docs.count() and all(given[i] == row for i, row in rows.items())
        steps.append((set(r.doc_id for r in before.collect()), set(rows), before))
    (all_, accepted, first), (_, unique, second), (_, clean, third), (_, mixed, fourth) = steps
    assert accepted == all_ - {r.doc_id for r in langid.identified(first).where("rejected").collect()}
    assert unique == {r.component_id for r in simhash.near_duplicates(second).collect()}
    leaks = decontam.leaks(third, table(spark, sf, "benchmark"))
    assert clean == unique - {r.doc_id for r in leaks.collect()} and len(clean) < len(unique)
    assert mixed == {r.doc_id for r in raking.decisions(fourth).where("kept").collect()}
    got = P.run(spark, sf).collect()
    assert {r.doc_id for r in got} == mixed == {r.doc_id for r in rendezvous.shards(docs).collect()}


def test_odd_documents_pass_all_stages(spark, sf, odd, empty):
    for docs in (odd, empty):
        for name, stage in P.STAGES[:-1]:
            out = stored(stage(spark, docs, sf), name)
            assert out.columns == docs.columns
            docs = out
        assert P.STAGES[-1][1](spark, docs, sf).where(F.col("shard").isNull()).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_ties_are_settled_by_all_columns(spark, frame):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, topic string"
    rows = [(1, "one two three four", "en", s, 1, t) for s in "cab" for t in ("x", None)] + [(2, None, None, s, None, None) for s in ("p", "q", None)]
    rows += [(None, "one two three four", "en", s, 1, None) for s in "ab"] + [(3, "another text that stands alone", "en", "z", 1, "x")] * 3
    kept = {tuple(r) for n in (1, 3, 8) for r in simhash.unique(spark.createDataFrame(rows, schema).repartition(n, "source")).collect()}
    assert len(kept) == 3 and {r[0] for r in kept} == {1, 2, 3}


def test_a_column_called_topic_is_not_the_topic(spark, frame):
    docs = frame([(i, "plain words " * 9, "en", "s", None) for i in range(50)]).withColumn("topic", F.col("doc_id").cast("string"))
    assert raking.mixed(docs).select("mix_topic").distinct().count() == 1
    assert raking.mixed(docs, topic=F.col("topic")).select("mix_topic").distinct().count() == 50
