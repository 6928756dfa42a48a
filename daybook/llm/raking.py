"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Tokens are summed per cell (source, language, topic).  Each round scales the cells so that one
marginal after the other meets its target; the fitted share of a cell over its tokens gives the
probability with which each of its documents is kept.  Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import fresh, stored

#: Rounds over all marginals; the fit is written to the scratch folder every STEP rounds.
ROUNDS, STEP = 24, 8
DRAW_BITS = 52
#: Default targets: the present shares to these powers (1: as they are, 0: all alike).
POWER = {"source": 0.7, "lang": 0.9, "topic": 1.0}
MISSING, OTHER = "(none)", "(other)"

#: Topics by the look of a text, first match counts.
TOPICS = (
    ("table", r"\|[^|\n]+\|[^|\n]+\|"),
    ("noise", r"(\*\*\*|%%%|&&&|\$\$\$|###).*(\*\*\*|%%%|&&&|\$\$\$|###)"),
    ("shouting", r"!! [^\n]*!! [^\n]*!!"),
    ("numbers", r"[0-9]{3}"),
)


def topic_of(text: Column) -> Column:
    """A topic for corpora without one: by patterns anywhere in the whole text, else ``prose``."""
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(F.regexp_like(text, F.lit(pattern)), name).otherwise(out)
    return F.coalesce(out, F.lit("prose"))


def tokens_of(text: Column) -> Column:
    """Words of a text: its blank-separated pieces; 0 for null, empty or blank."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("bigint")


def _category(column: Column, wanted: Mapping[str, float]) -> Column:
    known = F.coalesce(column.cast("string"), F.lit(MISSING))
    return F.when(known.isin(list(wanted)), known).otherwise(OTHER) if OTHER in wanted else known


def tempered(cells: DataFrame, dims: list[str], power: Mapping[str, float]) -> DataFrame:
    """Adds the target share of each cell's categories: their present shares to a power, made to sum to 1."""
    out = cells
    for dim in dims:
        shares = (
            cells.groupBy(dim).agg(F.sum("tokens").alias("n")).select(F.col(dim).alias("c"), F.pow(F.col("n").cast("double"), F.lit(power[dim])).alias("t"))
        )
        total = shares.agg(F.sum("t").alias("all"))
        shares = shares.join(F.broadcast(total)).select("c", (F.col("t") / F.col("all")).alias(f"target_{dim}"))
        out = out.join(shares, F.col(dim) == F.col("c")).drop("c")
    return out


def fitted(cells: DataFrame, dims: list[str], rounds: int = ROUNDS) -> DataFrame:
    """Adds ``share``: cell shares with the targets' marginals (columns ``target_<dim>``).

    ``cells`` has one row per combination of categories, so its size is bounded by the
    number of targets, not by the documents; it is put into one partition, where all rounds
    are windows without a shuffle.  Targets that no cells can meet together leave the last
    dimension exact and the others as near as the rounds came.
    """
    total = Window.partitionBy()
    now = cells.coalesce(1).withColumn("share", F.col("tokens") / F.sum("tokens").over(total))
    for i in range(rounds):
        for dim in dims:
            have = F.sum("share").over(Window.partitionBy(dim))
            now = now.withColumn("share", F.when(have > 0, F.col("share") * F.col(f"target_{dim}") / have).otherwise(0.0))
        if i % STEP == STEP - 1:
            now = stored(now, "raking").coalesce(1)
    return now


def draw_of(key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone; a null key counts as the empty text."""
    text = F.concat(F.lit("mix:"), F.coalesce(key.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("bigint")
    return (bits + F.lit(0.5)) / F.lit(2.0**DRAW_BITS)


def mixed(
    docs: DataFrame,
    power: Mapping[str, float] | None = None,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    rounds: int = ROUNDS,
    topic: Column | None = None,
) -> DataFrame:
    """``docs`` with cell, probability and decision of each document.

    ``targets``: for a dimension (source, lang, topic) its shares by category, with
    ``(other)`` for all categories not named and ``(none)`` for null; a category that is not named
    and has no ``(other)`` gets nothing.  Dimensions without targets are tempered: present shares to the
    power ``power[dim]``.  Shares are of tokens (words).  ``topic`` is an expression over ``docs``; without it topics
    are told by the look of the text, whatever columns ``docs`` has.

    Probabilities are as large as they can be: the cell that is most wanted for its tokens is kept
    whole, and the expected tokens of what is kept have the fitted marginals.  Documents without tokens weigh nothing
    and follow their cell.  The decision depends on doc_id alone within a cell, so
    repeated rows stay or go together.  Empty tables give empty results.  All columns of ``docs`` are kept;
    the columns added are ``mix_topic``, ``mix_tokens``, ``mix_probability`` and ``mix_kept``, underscores added
    where the input has such a name.
    """
    dims = ["source", "lang", "topic"]
    power = {**POWER, **(power or {})}
    inner = [f"{k}{i}" for k in "ck" for i in range(3)]
    names = {n: fresh(f"mix_{n}", docs) for n in ("topic", "tokens", "probability", "kept", *inner)}
    text = F.col("text").cast("string")
    topic = topic_of(text) if topic is None else topic.cast("string")
    targets = {d: {k: v / sum(t.values()) for k, v in t.items()} for d, t in (targets or {}).items()}
    read = docs.withColumns({names["topic"]: topic, names["tokens"]: tokens_of(text)})
    of = {"source": F.col("source"), "lang": F.col("lang"), "topic": F.col(names["topic"])}
    keyed = read.withColumns({names[f"c{i}"]: _category(of[d], targets.get(d, {})) for i, d in enumerate(dims)})
    cells = keyed.groupBy(*[F.col(names[f"c{i}"]).alias(d) for i, d in enumerate(dims)]).agg(
        F.sum(names["tokens"]).alias("tokens"), F.count("*").alias("documents")
    )
    cells = stored(cells, "raking-cells")
    free = [d for d in dims if d not in targets]
    aimed = tempered(cells, free, power)
    for dim in dims:
        if dim in targets:
            wanted = F.create_map(*[x for k, v in targets[dim].items() for x in (F.lit(k), F.lit(float(v)))])
            aimed = aimed.withColumn(f"target_{dim}", F.coalesce(wanted[F.col(dim)], F.lit(0.0)))
    fit = fitted(aimed, dims, rounds)
    ratio = F.when(F.col("tokens") > 0, F.col("share") / F.col("tokens")).otherwise(0.0)
    most = F.max("ratio").over(Window.partitionBy())
    chances = fit.withColumn("ratio", ratio).select(
        *[F.col(d).alias(names[f"k{i}"]) for i, d in enumerate(dims)],
        # documents without tokens change no marginal: a cell of nothing else is kept
        F.when(F.col("tokens") == 0, 1.0).otherwise(F.round(F.col("ratio") / most, 9)).alias(names["probability"]),
    )
    same = [F.col(names[f"c{i}"]) == F.col(names[f"k{i}"]) for i in range(3)]
    # one row per cell: bounded by the number of categories aimed at
    return (
        keyed.join(F.broadcast(chances), same)
        .withColumn(names["kept"], draw_of(F.col("doc_id")) < F.col(names["probability"]))
        .drop(*[names[n] for n in inner])
    )


def sample(docs: DataFrame, **options) -> DataFrame:
    """The documents kept, with the columns of ``docs``.

    Null and empty texts weigh nothing and follow their cell; null categories are one of their own; repeated rows
    stay or go together; an empty table gives no rows.
    """
    out = mixed(docs, **options)
    return out.where(F.col(fresh("mix_kept", docs))).select(*[F.col(f"`{c}`") for c in docs.columns])


def _oracle() -> str:
    """The same mix in SQL: one view per marginal and round."""
    topics = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{n}'" for n, p in TOPICS)
    parts = [
        f"d AS MATERIALIZED (SELECT doc_id, coalesce(source, '{MISSING}') AS source, coalesce(lang, '{MISSING}') AS lang, "
        f"CASE {topics} ELSE 'prose' END AS topic, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\r\\f\\x0B]+'))::BIGINT AS tokens FROM documents)",
        "c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM d GROUP BY ALL)",
    ]
    for dim, p in POWER.items():
        parts.append(
            f"t_{dim} AS MATERIALIZED (SELECT {dim}, pow(sum(tokens)::DOUBLE, {p}) / sum(pow(sum(tokens)::DOUBLE, {p})) OVER () AS t FROM c GROUP BY {dim})"
        )
    parts.append("r0 AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens / sum(tokens) OVER () AS share FROM c)")
    step = 0
    for _ in range(ROUNDS):
        for dim in POWER:
            parts.append(
                f"r{step + 1} AS MATERIALIZED (SELECT r.source, r.lang, r.topic, r.tokens, CASE WHEN sum(share) OVER (PARTITION BY r.{dim}) > 0 "
                f"THEN share * t / sum(share) OVER (PARTITION BY r.{dim}) ELSE 0 END AS share FROM r{step} r JOIN t_{dim} USING ({dim}))"
            )
            step += 1
    parts.append(
        f"p AS MATERIALIZED (SELECT source, lang, topic, CASE WHEN tokens = 0 THEN 1 ELSE round((share / tokens) / max(CASE WHEN tokens > 0 THEN share / tokens END) OVER (), 9) END AS probability FROM r{step})"
    )
    draw = f"(('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, {DRAW_BITS // 4}))::BIGINT + 0.5) / {2.0**DRAW_BITS:.1f}"
    return f"WITH {', '.join(parts)} SELECT doc_id, source, lang, topic, tokens, probability, {draw} < probability AS kept FROM d JOIN p USING (source, lang, topic)"


ORACLE_SQL = _oracle()


def decisions(docs: DataFrame, **options) -> DataFrame:
    """One row per document: its cell, its probability and whether it is kept."""
    rows = docs.select("doc_id", "text", "source", "lang")
    return mixed(rows, **options).select(
        "doc_id",
        F.coalesce("source", F.lit(MISSING)).alias("source"),
        F.coalesce("lang", F.lit(MISSING)).alias("lang"),
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("tokens"),
        F.col("mix_probability").alias("probability"),
        F.col("mix_kept").alias("kept"),
    )
