"""Merkle trees over the paragraphs and sections of a text, with built-in functions only.

Leaves are the SHA-256 digests of paragraphs (lines).  A paragraph whose digest falls
below a quarter of the range closes its section, so sections are cut by content and an
edit leaves the sections around it alone.  A section's digest is that of its
paragraphs' digests, the root that of the sections' digests: equal roots mean equal texts.  Where roots
differ, only sections that differ need to be opened to find the paragraph.

``likeness`` compares all nodes of two trees, short phrases below the paragraphs included
(64-bit hashes: they measure, they don't decide equality).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A phrase: up to 24 characters without a sentence end, and the sentence end after them.
PHRASE = r"[^.!?\n]{1,24}+[.!?\n]*+|[.!?\n]++"
#: A paragraph's digest below this closes its section.
CLOSES = "4"
LOWEST = -(1 << 63)


def with_tree(df: DataFrame, text: str, tree: str) -> DataFrame:
    """Adds a struct (root, sections of (digest, paragraphs), nodes); ``text`` must not be null."""
    leaves, ends, sections, roots = (f"{tree}__{n}" for n in ("leaves", "ends", "sections", "roots"))
    n = F.size(leaves)
    df = df.withColumn(leaves, F.transform(F.split(text, "\n"), lambda p: F.sha2(p.cast("binary"), 256)))
    df = df.withColumn(
        ends, F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.element_at(F.col(leaves), i) < CLOSES))
    )

    def section(end: Column, k: Column) -> Column:
        before = F.when(k == 0, 0).otherwise(F.get(ends, k - 1))
        paragraphs = F.slice(leaves, before + 1, end - before)
        return F.struct(
            F.sha2(F.concat_ws(",", paragraphs).cast("binary"), 256).alias("digest"), paragraphs.alias("paragraphs")
        )

    df = df.withColumn(sections, F.transform(ends, section))
    df = df.withColumn(roots, F.sha2(F.concat_ws("/", F.col(sections)["digest"]).cast("binary"), 256))
    phrases = F.transform(F.regexp_extract_all(text, F.lit(PHRASE), F.lit(0)), lambda p: F.xxhash64(p))
    nodes = F.array_distinct(
        F.concat(
            phrases,
            F.transform(leaves, lambda d: F.xxhash64(F.lit("paragraph"), d)),
            F.transform(F.col(sections)["digest"], lambda d: F.xxhash64(F.lit("section"), d)),
            F.array(F.xxhash64(F.lit("root"), F.col(roots))),
        )
    )
    made = F.struct(F.col(roots).alias("root"), F.col(sections).alias("sections"), nodes.alias("nodes"))
    return df.withColumn(tree, made).drop(leaves, ends, sections, roots)


def likeness(left: Column, right: Column) -> Column:
    """Nodes in common, of the mean number of nodes: 1 for equal texts and only for them."""
    shared = F.size(F.array_intersect(left["nodes"], right["nodes"]))
    return F.when(left["root"] == right["root"], F.lit(1.0)).otherwise(
        2.0 * shared / (F.size(left["nodes"]) + F.size(right["nodes"]))
    )


def _first_difference(left: Column, right: Column) -> Column:
    """1-based index of the first element that differs or that one array lacks; 0 if equal."""
    at = F.sequence(F.lit(0), F.greatest(F.size(left), F.size(right)))
    return F.coalesce(
        F.array_position(F.transform(at, lambda i: F.get(left, i).eqNullSafe(F.get(right, i)) & (i < F.greatest(F.size(left), F.size(right)))), False), F.lit(0)
    ).cast("int")


def first_edit(left: Column, right: Column) -> Column:
    """(section, paragraph), counted from 1, where two trees first differ; null if equal.

    Goes down from the roots: section digests first, paragraphs of that section only.
    """
    section = _first_difference(left["sections"]["digest"], right["sections"]["digest"])
    inside = lambda tree: F.coalesce(F.get(tree["sections"], section - 1)["paragraphs"], F.array().cast("array<string>"))
    return F.when(
        left["root"] != right["root"],
        F.struct(section.alias("section"), _first_difference(inside(left), inside(right)).alias("paragraph")),
    )


def _numbered(rows: DataFrame, digest: str, *places: str) -> DataFrame:
    """Adds ``copy``: which of a document's equal digests a row is, in the order of the places."""
    same = Window.partitionBy("doc_id", digest).orderBy(*places)
    return rows.withColumn("copy", F.row_number().over(same))


def _only(left: DataFrame, right: DataFrame, digest: str) -> DataFrame:
    """Rows of ``left`` whose document, digest and copy are not in ``right``; null ids are equal."""
    other = right.select(F.col("doc_id").alias("o_id"), F.col(digest).alias("o_digest"), F.col("copy").alias("o_copy"))
    same = F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col(digest) == F.col("o_digest")) & (F.col("copy") == F.col("o_copy"))
    return left.join(other, same, "left_anti")


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """(doc_id, side, section, paragraph, digest): every paragraph of one version of a document that the other lacks.

    Goes down from the roots of both versions' trees (``doc_id``, ``text``): documents with equal roots are done, then sections with
    equal digests, and only paragraphs of the others are compared; all edits are listed, not the first alone.  ``side`` is
    ``before`` or ``after``; places count from 1.  A paragraph that only moved is in both versions; one that is there more often
    than before is listed as often as it is new.  doc_id names a document and is unique in each version (null is one
    document); one that only one version has differs as a whole; a null text is empty.  An empty table has no paragraphs.
    """

    def sections(docs: DataFrame) -> DataFrame:
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        return with_tree(rows, "text", "tree").select("doc_id", F.col("tree.root").alias("root"), F.col("tree.sections").alias("sections"))

    trees = [sections(before), sections(after)]
    changed = []
    for own, other in (trees, trees[::-1]):
        same = other.select(F.col("doc_id").alias("o_id"), F.col("root").alias("o_root"))
        open_ = own.join(same, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("root") == F.col("o_root")), "left_anti")
        listed = open_.select("doc_id", F.posexplode("sections").alias("section", "node")).select(
            "doc_id", (F.col("section") + 1).alias("section"), F.col("node.digest").alias("node"), F.col("node.paragraphs").alias("paragraphs")
        )
        changed.append(_numbered(listed, "node", "section"))
    opened = []
    for own, other in (changed, changed[::-1]):
        below = _only(own, other, "node").select("doc_id", "section", F.posexplode("paragraphs").alias("paragraph", "digest"))
        opened.append(_numbered(below.withColumn("paragraph", F.col("paragraph") + 1), "digest", "section", "paragraph"))
    columns = ["doc_id", "side", "section", "paragraph", "digest"]
    out = [
        _only(own, other, "digest").withColumn("side", F.lit(side)).select(columns)
        for side, own, other in (("before", opened[0], opened[1]), ("after", opened[1], opened[0]))
    ]
    return out[0].unionByName(out[1])


def _ranges(df: DataFrame, key: str, ranges: int) -> tuple[int | None, list[int]]:
    """The smallest key, and at most ``ranges`` larger keys that cut the rows evenly."""
    cuts = [i / ranges for i in range(1, ranges)] or [0.5]
    least, bounds = df.agg(
        F.min(key), F.percentile_approx(key, F.lit(cuts), F.lit(max(10_000, 20 * ranges)))
    ).first()
    return least, sorted({b for b in bounds or [] if b > least})


def _at_most(bounds: list[int], key: Column) -> Column:
    """How many of the sorted bounds are at most the key, in two short searches."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    coarse = F.size(F.filter(F.lit(bounds[::step]), lambda b: b <= key))
    fine = F.slice(F.lit(bounds), F.greatest(coarse - 1, F.lit(0)) * step + 1, step)
    return F.greatest(coarse - 1, F.lit(0)) * step + F.size(F.filter(fine, lambda b: b <= key))


def placed(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """Adds ``range`` and ``guest``: every row in its range of keys, and the first row(s) of each
    range once more, as guests, at the end of the range before (the very first: of the last one).

    With that, the row after any row is found within its range, whatever the number of
    rows; ``ranges`` bounds what the driver holds.
    """
    least, bounds = _ranges(df, key, ranges)
    if least is None:
        return df.withColumn("range", F.lit(0)).withColumn("guest", F.lit(False))
    at = F.col("range")
    none = F.array().cast("array<struct<range:int,guest:boolean>>")
    seat = lambda where, guest: F.array(F.struct(where.cast("int").alias("range"), F.lit(guest).alias("guest")))
    return (
        df.withColumn("range", _at_most(bounds, F.col(key)))
        .withColumn(
            "seat",
            F.explode(
                F.concat(
                    seat(at, False),
                    F.when(F.array_contains(F.lit(bounds or [LOWEST]), F.col(key)) & (at > 0), seat(at - 1, True)).otherwise(none),
                    F.when(F.col(key) == F.lit(least), seat(F.lit(len(bounds)), True)).otherwise(none),
                )
            ),
        )
        .withColumns({"range": F.col("seat")["range"], "guest": F.col("seat")["guest"]})
        .drop("seat")
    )


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how like their trees are.

    The edited text has the last floor(n / 2) code points replaced by the first as many (or
    all) of the next document by doc_id; after the last comes the first, which for a single document
    is itself.  Rows of the same doc_id follow each other by the text's hash.  A null text is empty; a null doc_id comes before all others; an
    empty table gives no rows; other columns are not looked at.  ``edited_section`` and
    ``edited_paragraph`` locate the first difference (null if the edit changed nothing).

    Texts are shuffled once, into ranges of ids; trees are made after that shuffle.
    """
    spark = docs.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)).alias("key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    seated = placed(rows, "key", ranges).repartition("range")
    order = Window.partitionBy("range").orderBy("guest", "key", F.xxhash64("text"))
    lined = (
        with_tree(seated, "text", "tree")
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_tree", F.lead("tree").over(order))
        .where(~F.col("guest"))
    )
    n = F.char_length("text")
    kept, half = F.ceil(n / 2).cast("int"), F.floor(n / 2).cast("int")
    edited = lined.withColumn("n", n).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), kept), F.substring("next_text", F.lit(1), half))
    )
    own, other, following = F.col("tree"), F.col("edited_tree"), F.col("next_tree")
    return (
        with_tree(edited, "edited", "edited_tree")
        .withColumn("edit", first_edit(own, other))
        .select(
            "doc_id",
            F.col("n").cast("bigint").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            own["root"].alias("fingerprint"),
            other["root"].alias("edited_fingerprint"),
            likeness(own, other).alias("near_edited"),
            likeness(own, following).alias("near_next"),
            F.col("edit")["section"].alias("edited_section"),
            F.col("edit")["paragraph"].alias("edited_paragraph"),
        )
    )
