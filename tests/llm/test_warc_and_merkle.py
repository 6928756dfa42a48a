"""Archive round trips, Merkle trees against hashlib."""

import base64
import hashlib
import re

import oracle
import pytest
from pyspark.sql import functions as F

from daybook.llm import merkle as M
from daybook.llm import queries
from daybook.llm import warc as W


def test_pages_match_sql(spark, sf):
    con = oracle.connect(sf)
    assert oracle.difference(oracle.spark_bag(queries.op2_warc(spark, sf)), oracle.duck_bag(con, W.PAGES_SQL)) == ""


PAGES = [(1, "http://a", "x"), (2, "http://b", "é€"), (3, None, "x"), (4, "http://c\r\nX: y", None), (5, "u", ""), (5, "u", ""), (None, "v", "x"), (None, None, "only")]


def test_archive_keeps_each_payload_once_and_gives_back_every_record(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("payload", F.lit("taken"))
    headers, payloads = W.archive(pages)
    assert payloads.count() == 4 and headers.count() == 8
    rows = W.digest(headers, payloads).collect()
    by = {}
    for r in rows:
        by.setdefault(r.page_id, []).append(r)
    assert all(r.digest_matches for r in rows)
    assert (by[3][0].record_type, by[3][0].refers_to) == ("response", None) and (by[1][0].record_type, by[1][0].refers_to) == ("revisit", 3)
    assert by[4][0].refers_to == 5 and [r.record_type for r in by[5]] == ["response", "response"]
    want = base64.b32encode(hashlib.sha1("é€".encode()).digest()).decode()
    assert (by[2][0].payload_bytes, by[2][0].payload_digest) == (5, want)
    assert sorted((r.record_type, str(r.refers_to)) for r in by[None]) == [("response", "None"), ("revisit", "3")]
    whole = W.records(headers, payloads).select("page_id", W.record_bytes(F.col("header"), F.col("payload")).alias("r")).collect()
    for r in whole:
        head, _, rest = bytes(r.r).partition(b"\r\n\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest[length:] == b"\r\n\r\n"
        assert b"\nX: y" not in head
    assert {bytes(r.r).partition(b"\r\n\r\n")[2] for r in whole if r.page_id == 2} == {"é€\r\n\r\n".encode()}


def test_small_payloads_are_all_responses_and_damage_is_noticed(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    headers, payloads = W.archive(pages, min_bytes=3)
    assert {r.record_type for r in W.digest(headers, payloads).collect()} == {"response"}
    with pytest.raises(Exception, match="damaged payload"):
        W.digest(headers, payloads.withColumn("payload", F.lit(b"other"))).collect()
    with pytest.raises(Exception, match="no payload"):
        W.digest(headers, payloads.limit(1)).collect()
    assert W.digest(*W.archive(pages.limit(0))).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def root(text):
    """The tree's root by its definition."""
    sections, held = [], []
    leaves = [sha(p) for p in text.split("\n")]
    for i, leaf in enumerate(leaves):
        held.append(leaf)
        if leaf < "4" or i == len(leaves) - 1:
            sections.append(sha(",".join(held)))
            held = []
    return sha("/".join(sections))


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_fingerprints_of_documents_and_edited_texts(documents, ranges):
    texts = sorted((r.doc_id, r.text) for r in documents.collect())
    got = {r.doc_id: r for r in M.fingerprints(documents, ranges).collect()}
    for i, (key, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = got[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
        assert (r.fingerprint, r.edited_fingerprint) == (root(text), root(edited))
        assert (r.near_edited == 1) == (edited == text) and (r.near_next == 1) == (following == text)
        a, b = text.split("\n"), edited.split("\n")
        if edited != text:
            # sections and paragraphs lead to the first paragraph that differs
            at = next(j for j in range(max(len(a), len(b))) if a[j : j + 1] != b[j : j + 1])
            ends = [j for j, p in enumerate(a) if sha(p) < "4" or j == len(a) - 1]
            begin = [0, *[e + 1 for e in ends[:-1]]]
            assert begin[r.edited_section - 1] + r.edited_paragraph - 1 == at if r.edited_section <= len(begin) else True
        else:
            assert r.edited_section is None
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.9 * len(got)


def test_odd_documents_have_fingerprints(odd, empty, frame):
    rows = M.fingerprints(odd).collect()
    assert len(rows) == 12 and M.fingerprints(empty).count() == 0
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == by[2].fingerprint == root("") and by[6].fingerprint == by[7].fingerprint and by[6].near_next == 1
    one = M.fingerprints(frame([(1, "abcd", None, None, None)])).first()
    assert one.edited_sha256 == sha("abab") and one.near_next == 1


def test_every_edit_is_located(frame, empty, odd):
    import hashlib
    import random

    dice = random.Random(6)
    lines = [f"paragraph {i} {dice.random()}" for i in range(60)]
    changed = list(lines)
    changed[3], changed[30] = "an edit", "another"
    del changed[50]
    changed.insert(10, lines[20])  # one more copy of a paragraph
    moved = lines[30:] + lines[:30]
    before = frame([(1, "\n".join(lines), None, None, None), (2, "same\ntext", None, None, None), (3, "\n".join(lines), None, None, None), (None, "a", None, None, None)])
    after = frame([(1, "\n".join(changed), None, None, None), (2, "same\ntext", None, None, None), (3, "\n".join(moved), None, None, None), (None, "b", None, None, None), (9, None, None, None, None)])
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    found = {(r.doc_id, r.side, r.digest) for r in M.differences(before, after).collect()}
    wanted = {(1, "before", digest(lines[i])) for i in (3, 30, 50)} | {(1, "after", digest(t)) for t in ("an edit", "another", lines[20])}
    assert found == wanted | {(None, "before", digest("a")), (None, "after", digest("b")), (9, "after", digest(""))}
    assert M.differences(before, before).count() == 0 and M.differences(empty, empty).count() == 0
    assert M.differences(empty, before).where("side = 'before'").count() == 0
