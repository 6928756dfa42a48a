"""Which sources of a language differ most in their words: a joint walk over K-squared quadtrees.

For each language the counts of its kept terms make a matrix of groups (sources) by terms, cut
into blocks of SIDE groups by a strip of terms.  A block is a row of square quadtrees with K = 4: a quadrant of
64, 16 or 4 groups by as many terms is marked if any count in it is not zero.  Two blocks of one strip are
walked together from the roots down: where both quadrants are unmarked, all their pairs have the same price per
term, that of two zero counts, which is added analytically; marked ones are opened, and below them are the only
counts that are ever looked at.  Terms that no walk reached at all are priced in the same way at the end.

A block holds at most SIDE groups and about STRIP terms whatever the corpus, so no task holds more than two of them;
a source with a third of all rows is one row of its blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import stored

#: A term is kept in a language if at least so many of its documents have it.
LEAST_DOCS = 10
#: Ranks listed of a group's own terms.
TOP = 10
ONE = 1_000_000_000
#: Quadrant sides from the root down, each a K-th of the one above; the last is a leaf.
SIDES = (64, 16, 4)
SIDE, K = SIDES[0], 4
#: Terms a strip has on average.
STRIP = 2048
#: Leaves evaluated at once.
LEAVES = 1 << 14
#: Distinct (group, term) pairs a task gathers before it hands them on.
FLUSH = 500_000
#: Bytes of a text taken at once.
SLICE = 1 << 20


def _folding() -> bytes:
    """Byte -> itself, in lower case if A to Z, blank if no letter and below 0x80."""
    return bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def _words(text: bytes, folding: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text, a slice at a time; slices end between terms."""
    at = 0
    while at < len(text):
        part = text[at : at + SLICE].translate(folding)
        at += len(part)
        tail = []
        while at < len(text) and not part.endswith(b" "):  # to the end of the term that was cut
            more = text[at : at + 4096].translate(folding)
            end = more.find(b" ")
            tail.append(more if end < 0 else more[: end + 1])
            at += len(tail[-1])
            if end >= 0:
                break
        yield (part + b"".join(tail)).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    folding, size = _folding(), 0
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in held.items():
            terms = pa.array(list(counts), pa.binary()).cast(pa.string(), safe=False)
            n, d = pa.array(list(counts.values()), pa.int64()), pa.array([docs[t] for t in counts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), terms, n, d],
                ["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2)):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            size -= len(counts)
            for words in _words(text.as_py(), folding):
                counts.update(words)
                seen.update(words)
            docs.update(seen)
            size += len(counts)
            if size > FLUSH:
                yield from out()
                size = 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) summed within tasks only: partial counts of whole texts."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source", "text")]
    rows = docs.select(text[0].alias("lang"), text[1].alias("source"), text[2].cast("binary").alias("text"))
    return rows.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")


def share(count: Column, whole: Column) -> Column:
    """1 + floor(ONE * (count + 2) / whole) in whole numbers, three digits at a time so that nothing overflows."""
    out, rest = F.lit(1).cast("bigint"), count + 2
    for factor in (1_000_000, 1_000, 1):
        out = out + F.call_function("div", rest * 1000, whole) * factor
        rest = (rest * 1000) % whole
    return out


def price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _marks(rows: np.ndarray, cols: np.ndarray, width: int) -> list[np.ndarray]:
    """Per side, from the root down, which quadrants (columns, rows) hold a count."""
    marks = []
    for side in SIDES:
        level = np.zeros((width // side, SIDE // side), bool)
        level[cols // side, rows // side] = True
        marks.append(level)
    return marks


def _children(parts: int) -> np.ndarray:
    return np.stack(np.meshgrid(np.arange(parts), np.arange(K), np.arange(K), indexing="ij"), -1).reshape(-1, 3)


def joint_walk(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Price of the terms in the leaves reached, and how many terms those are, for each pair of rows of two blocks.

    A block is (zero, rows, cols, p): the share of a zero count per row, and of the counts that are not zero.  Both have ``terms``
    columns; what is not in a leaf reached has two zero counts and is left to the caller.
    """
    width = -(-terms // SIDE) * SIDE
    dense, marks = [], []
    for zero, rows, cols, p in (left, right):
        block = np.repeat(zero[:, None], width, axis=1)
        block[rows, cols] = p
        block[:, terms:] = 1  # no terms: equal on both sides, so without a price
        dense.append(block)
        marks.append(_marks(rows, cols, width))
    opened = np.zeros((width // SIDE, 3), np.int64)
    opened[:, 0] = np.arange(len(opened))
    for level, side in enumerate(SIDES):
        col, a, b = opened.T
        opened = opened[marks[0][level][col, a] | marks[1][level][col, b]]
        if side != SIDES[-1]:
            opened = (opened[:, None, :] * K + _children(K)).reshape(-1, 3)
    sums, reached = np.zeros((SIDE, SIDE), np.int64), np.zeros((SIDE, SIDE), np.int64)
    leaf = np.arange(SIDES[-1])
    for at in range(0, len(opened), LEAVES):
        col, a, b = (opened[at : at + LEAVES] * SIDES[-1]).T
        cols, rows_a, rows_b = col[:, None] + leaf, a[:, None] + leaf, b[:, None] + leaf
        p = dense[0][rows_a[:, :, None], cols[:, None, :]]
        q = dense[1][rows_b[:, :, None], cols[:, None, :]]
        where = rows_a[:, :, None], rows_b[:, None, :]
        np.add.at(sums, where, _prices(p[:, :, None, :], q[:, None, :, :]).sum(axis=3))
        np.add.at(reached, where, np.minimum(terms - col, SIDES[-1])[:, None, None])
    return sums, reached


def _walk(key: tuple, table: pa.Table) -> pa.Table:
    """One strip of two blocks; rows without a column carry the share of a zero count of their group."""
    lang, _, one, two = (k.as_py() for k in key)
    g, col, p = (table.column(c).to_numpy() for c in ("g", "col", "p"))
    blocks, there = [], []
    for block in (one, two):
        mine, base = g // SIDE == block, col < 0
        zero = np.ones(SIDE, np.int64)
        zero[g[mine & base] % SIDE] = p[mine & base]
        there.append(np.isin(np.arange(SIDE), g[mine & base] % SIDE))
        cell = mine & ~base
        blocks.append((zero, g[cell] % SIDE, col[cell], p[cell]))
    sums, reached = joint_walk(*blocks, table.column("width")[0].as_py())
    low, high = np.arange(SIDE)[:, None] + one * SIDE, np.arange(SIDE)[None, :] + two * SIDE
    a, b = np.nonzero((reached > 0) & (low < high) & there[0][:, None] & there[1][None, :])
    columns = [pa.array([lang] * len(a), pa.string()), *map(pa.array, (a + one * SIDE, b + two * SIDE, sums[a, b], reached[a, b]))]
    return pa.Table.from_arrays(columns, ["lang", "g", "h", "part", "terms"])


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) over all rows of ``docs`` (text, lang, source), as the module's docstring has it.

    Part ``pair``: every other source of the language, by the sum of prices over all kept terms.  Part ``term``: the group's terms
    that are more frequent than in its language, the first ``top``.  A term is a run of letters (any character
    from U+0080 counts as one), with A to Z in lower case; it is kept in a language if ``least_docs`` rows have it.  A null text, language
    or source is the empty string; groups without a term take part with zero counts; repeated rows count
    as often as they are there; equal values are ranked by the item's bytes; an empty table gives no rows.
    """
    by_term = Window.partitionBy("lang", "term")
    # dealt by term once: a term's groups meet, and its partial counts were summed in the tasks before
    counted = term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = counted.withColumns({"docs": F.sum("docs").over(by_term), "total": F.sum("n").over(by_term)}).where(F.col("docs") >= least_docs)
    cells = stored(kept.select("lang", "term", "source", "n", "total"), "divergence-cells")

    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    everyone = docs.select(*blank).distinct().withColumn("n", F.lit(0).cast("bigint"))
    groups = everyone.unionByName(sizes).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    terms = cells.select("lang", "term").distinct()
    widths = terms.groupBy("lang").agg(F.count("*").alias("v"))
    of_lang = groups.groupBy("lang").agg(F.sum("n").alias("lang_n")).join(widths, "lang", "left").na.fill(0, ["v"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = groups.withColumn("g", number).join(of_lang, "lang")
    whole, zero = F.col("n") + 2 * F.col("v"), F.lit(0).cast("bigint")
    groups = stored(
        groups.select(
            "lang", "source", F.col("g").cast("bigint").alias("g"), "v", whole.alias("whole"), (F.col("lang_n") + 2 * F.col("v")).alias("lang_whole"),
            F.when(whole > 0, share(zero, whole)).alias("zero"),
        ),
        "divergence-groups",
    )

    # strips of terms, by hash; a term's column is its place in its strip
    strips = F.greatest(F.lit(1), F.ceil(F.col("v") / STRIP))
    dealt = terms.join(widths, "lang").withColumn("strip", F.pmod(F.xxhash64("term"), strips))
    in_strip = Window.partitionBy("lang", "strip")
    placed = dealt.withColumns({"col": F.row_number().over(in_strip.orderBy("term")) - 1, "width": F.count("*").over(in_strip)}).drop("v")
    known = groups.select("lang", "source", "g", F.col("whole"), "lang_whole")
    shares = cells.join(known, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("whole")))
    shares = stored(shares.select("lang", "term", "source", "g", "p", share(F.col("total"), F.col("lang_whole")).alias("q")), "divergence-shares")

    members = shares.join(placed, ["lang", "term"]).select("lang", "strip", "g", "col", "p", "width")
    all_strips = placed.select("lang", "strip", "width").distinct()
    bases = groups.where("v > 0").join(all_strips, "lang").select("lang", "strip", "g", F.lit(-1).alias("col"), F.col("zero").alias("p"), "width")
    blocks = groups.groupBy("lang").agg((F.max("g") / SIDE).cast("bigint").alias("last"))
    mine = F.call_function("div", F.col("g"), F.lit(SIDE).cast("bigint"))
    rows = members.withColumn("col", F.col("col").cast("int")).unionByName(bases).join(blocks, "lang")
    rows = rows.withColumn("partner", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))))
    rows = rows.select("lang", "strip", F.least(mine, "partner").alias("one"), F.greatest(mine, "partner").alias("two"), "g", "col", "p", "width")
    parts = rows.groupBy("lang", "strip", "one", "two").applyInArrow(_walk, "lang string, g bigint, h bigint, part bigint, terms bigint")
    summed = stored(parts.groupBy("lang", "g", "h").agg(F.sum("part").alias("part"), F.sum("terms").alias("terms")), "divergence-pairs")

    # every other source of the language: the result itself, one row each
    left = groups.select("lang", "source", "g", "zero", "v")
    right = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("h"), F.col("zero").alias("other"))
    pairs = left.join(right, "lang").where("g <> h").withColumns({"low": F.least("g", "h"), "high": F.greatest("g", "h")})
    found = summed.select("lang", F.col("g").alias("low"), F.col("h").alias("high"), "part", "terms")
    priced = pairs.join(found, ["lang", "low", "high"], "left")
    missing = (F.col("v") - F.coalesce("terms", zero)) * price(F.col("zero"), F.col("other"))
    value = F.when(F.col("v") > 0, F.coalesce("part", zero) + missing).otherwise(zero)
    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_part = priced.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn("rank", F.row_number().over(best_first))
    own = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))
    term_part = own.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    return pair_part.unionByName(term_part)


_TERMS_SQL = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE_SQL = f"""
with d as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text from documents
), w as (
  select doc, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERMS_SQL}')) as term from d
), k as (
  select lang, term from w group by lang, term having count(distinct doc) >= {LEAST_DOCS}
), g as (
  select distinct lang, source from d
), c as (
  select g.lang, g.source, k.term, coalesce(x.n, 0)::hugeint as n
  from g join k on g.lang = k.lang
  left join (select lang, source, term, count(*) as n from w group by all) x on x.lang = g.lang and x.source = g.source and x.term = k.term
), p as (
  select lang, source, term, n,
    1 + ({ONE}::hugeint * (n + 2)) // (sum(n) over (partition by lang, source) + 2 * count(*) over (partition by lang, source))::hugeint as p
  from c
), t as (select lang, term, sum(n)::hugeint as n from c group by lang, term),
q as (
  select lang, term, 1 + ({ONE}::hugeint * (n + 2)) // (sum(n) over (partition by lang) + 2 * count(*) over (partition by lang))::hugeint as q from t
), f as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), r as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
  union all
  select p.lang, p.source, 'term', p.term, (((p.p - q.q) * (p.p - q.q)) // (p.p + q.q))::bigint
  from p join q on p.lang = q.lang and p.term = q.term where p.n > 0 and p.p > q.q
)
select lang, source, part, item, value,
  row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank
from r qualify part = 'pair' or rank <= {TOP}
"""
