"""Table statements as DataFrame functions.

Conditions and expressions are Spark SQL text or Columns.  A change returns a new
DataFrame.  Statements limited to the first n rows order by the given keys and
then by the row key, so that they pick the same rows every time.  Up to ``IN_PLACE`` rows are
sorted into one task; beyond, the row at the boundary is found by counting (``boundaries``) and
every other row is compared with it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Expr = str | Column
_PICKED = "_picked"


def expression(value: Expr) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def sort_key(item: Expr) -> Column:
    """``"expr"``, ``"expr ASC"`` or ``"expr DESC"``; NULLs are the smallest values."""
    if not isinstance(item, str):
        return item
    head, _, tail = item.rpartition(" ")
    if head and tail.upper() in ("ASC", "DESC"):
        item = head
    else:
        tail = "ASC"
    key = F.expr(item)
    return key.desc_nulls_last() if tail.upper() == "DESC" else key.asc_nulls_first()


# Quoted texts and names, which hold no parameters, and the two kinds of parameters.
_MARKED = re.compile(r"""'(?:[^'\\\\]|\\\\.)*'|"(?:[^"\\\\]|\\\\.)*"|`[^`]*`|::|:([A-Za-z_]\w*)|(\?)""", re.DOTALL)


def literal(value: object) -> str:
    """A plain value as Spark SQL spells it."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return f"{value}" if -(2**31) < value < 2**31 else f"{value}L" if -(2**63) < value < 2**63 else f"{value}BD"
    if isinstance(value, float):
        return f"DOUBLE('{value!r}')"
    if isinstance(value, Decimal):
        return f"{value:f}BD"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, datetime):
        return f"TIMESTAMP{'_NTZ' if value.tzinfo is None else ''}'{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, bytes):
        return f"X'{value.hex()}'"
    if isinstance(value, (list, tuple)):
        return f"ARRAY({', '.join(map(literal, value))})"
    raise TypeError(f"no SQL literal for {type(value).__name__}")


def bind(text: str, params: Mapping[str, object] | Sequence[object]) -> str:
    """A condition or expression with its ``:name`` or ``?`` parameters filled in, for any statement that takes text.

    Values become literals, never SQL.  A parameter without a value and a value without a parameter are errors.
    """
    named = params if isinstance(params, Mapping) else None
    rest, used = [] if named is not None else list(params), set()

    def fill(found: re.Match) -> str:
        name, question = found.groups()
        if name is not None and named is not None:
            used.add(name)
            if name not in named:
                raise ValueError(f"no value for parameter :{name}")
            return literal(named[name])
        if question and named is None:
            if not rest:
                raise ValueError("fewer values than parameters")
            return literal(rest.pop(0))
        return found.group(0)

    out = _MARKED.sub(fill, text)
    if rest or (named is not None and set(named) - used):
        raise ValueError(f"values without a parameter: {rest or sorted(set(named) - used)}")
    return out


def select(df: DataFrame, *items: str) -> DataFrame:
    return df.selectExpr(*items)


def where(df: DataFrame, condition: Expr) -> DataFrame:
    return df.filter(expression(condition))


def group_having(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Expr], having: Expr | None = None
) -> DataFrame:
    grouped = df.groupBy(*keys).agg(*[expression(e).alias(name) for name, e in measures.items()])
    return grouped if having is None else grouped.filter(expression(having))


def order(df: DataFrame, *items: Expr) -> DataFrame:
    return df.orderBy(*[sort_key(i) for i in items])


#: Rows that a statement sorts into one task at most.
IN_PLACE = 10_000
#: Rows drawn as cuts in each round of counting.
CUTS = 63


def _split(item: str) -> tuple[Column, bool]:
    """Expression of a sort item and whether it is descending."""
    name, _, way = item.rpartition(" ")
    return F.expr(name if name and way.upper() in ("ASC", "DESC") else item), bool(name) and way.upper() == "DESC"


def behind(by: Sequence[str], values: Sequence[object]) -> Column:
    """Whether a row comes after the one with these sort keys; NULLs are the smallest values, as in ``order``."""
    past_any, same = F.lit(False), F.lit(True)
    for item, value in zip(by, values):
        key, down = _split(item)
        if value is None:
            past = F.lit(False) if down else key.isNotNull()
        else:
            past = (key < F.lit(value)) | key.isNull() if down else key > F.lit(value)
        past_any = past_any | (same & F.coalesce(past, F.lit(False)))
        same = same & key.eqNullSafe(F.lit(value))
    return past_any


def _range_of(cuts: Sequence[Sequence[object]], by: Sequence[str], low: int = 0) -> Column:
    """How many of the ordered cuts a row comes after, by halving."""
    if not cuts:
        return F.lit(low)
    middle = len(cuts) // 2
    after = _range_of(cuts[middle + 1 :], by, low + middle + 1)
    return F.when(behind(by, cuts[middle]), after).otherwise(_range_of(cuts[:middle], by, low))


def boundaries(df: DataFrame, by: Sequence[str], ranks: Sequence[int]) -> list[tuple | None]:
    """Sort keys of the rows with these ranks (from 1) in the given order; None behind the last row.

    Each round draws a few rows by hash as cuts, counts the rows of every range between them in one
    scan and goes on with the range that holds the rank, until it is small enough to be sorted in
    one task.  Only counts and cuts are shuffled; runs when called.
    """
    names = [f"_k{i}" for i in range(len(by))]
    keys = df.select(*[_split(item)[0].alias(n) for item, n in zip(by, names)])
    ways = [f"{n} DESC" if _split(item)[1] else n for item, n in zip(by, names)]

    def find(rank: int, n: int) -> tuple | None:
        rows, low, high, seed = keys, None, None, 0
        if rank > n:
            return None
        while n > IN_PLACE:
            seed += 1
            mixed = F.xxhash64(F.lit(seed), *names)
            # one row for each remainder of the hash: cuts that all differ, found without a sort
            drawn = rows.groupBy(F.pmod(mixed, F.lit(CUTS))).agg(F.min_by(F.struct(*names), mixed).alias("k")).select("k.*")
            cuts = [tuple(r) for r in order(drawn, *ways).collect()]
            counts = dict(rows.groupBy(_range_of(cuts, ways).alias("r")).count().collect())
            before = r = 0
            while before + counts.get(r, 0) < rank:
                before, r = before + counts.get(r, 0), r + 1
            if len(cuts) == 1 and counts.get(0) == n:
                same = reduce(and_, (F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(names, cuts[0])))
                if rows.filter(~same).isEmpty():
                    return cuts[0]
            low, high = cuts[r - 1] if r else low, cuts[r] if r < len(cuts) else high
            inside = F.lit(True) if low is None else behind(ways, low)
            if high is not None:
                inside = inside & ~behind(ways, high)
            rows, n, rank = keys.filter(inside), counts[r], rank - before
        return tuple(order(rows, *ways).offset(rank - 1).limit(1).first())

    whole = keys.count()
    return [find(rank, whole) if rank > 0 else None for rank in ranks]


def page(df: DataFrame, by: Sequence[Expr], limit: int, offset: int = 0) -> DataFrame:
    """Rows offset .. offset + limit of the given order; make the order total.

    Pages that end within ``IN_PLACE`` rows are sorted into one place.  Deeper ones are cut out between the
    rows at their two ends and sorted in parallel, if the order is given as text; rows that an order which is not
    total leaves equal stay on one page.
    """
    if offset + limit <= IN_PLACE or not all(isinstance(item, str) for item in by):
        ordered = order(df, *by)
        return (ordered.offset(offset) if offset else ordered).limit(limit)
    first, last = boundaries(df, by, [offset, offset + limit])
    if offset and first is None:  # fewer rows than the offset
        return df.limit(0)
    inside = behind(by, first) if offset else F.lit(True)
    if last is None:
        return order(df.filter(inside), *by)
    return order(df.filter(inside & ~behind(by, last)), *by)


def page_after(df: DataFrame, by: Sequence[str], limit: int, after: Sequence[object] | None = None) -> DataFrame:
    """The next ``limit`` rows behind the keys of the last row seen; None starts at the front.

    ``by`` are columns or ``"column DESC"``, together unique.  Whatever the page, only ``limit`` rows
    are ever sorted into one place.  NULLs are the smallest values, as in ``order``.
    """
    if after is None:
        return order(df, *by).limit(limit)
    if len(after) != len(by):
        raise ValueError("one value per sort key")
    return order(df.filter(behind(by, after)), *by).limit(limit)


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def insert(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows; columns they lack are NULL, columns the table lacks are an error."""
    unknown = [c for c in rows.columns if c not in df.columns]
    if unknown:
        raise ValueError(f"table has no column {unknown}")
    return df.unionByName(rows, allowMissingColumns=True)


def _holds(condition: Expr | None) -> Column:
    """The condition as a plain true/false; unknown counts as false."""
    if condition is None:
        return F.lit(True)
    return F.coalesce(expression(condition), F.lit(False))


def update(df: DataFrame, values: Mapping[str, Expr], condition: Expr | None = None) -> DataFrame:
    """Set columns where the condition holds; all values see the old row."""
    unknown = [c for c in values if c not in df.columns]
    if unknown:
        raise ValueError(f"table has no column {unknown}")
    hit = _holds(condition)
    return df.withColumns(
        {
            c: F.when(hit, expression(v).cast(df.schema[c].dataType)).otherwise(F.col(c))
            for c, v in values.items()
        }
    )


def first_keys(
    df: DataFrame, key: str, by: Sequence[Expr], n: int, condition: Expr | None = None
) -> DataFrame:
    """Keys of the first n matching rows; ``key`` must be unique."""
    if n > IN_PLACE:
        return df.filter(among_first(df, key, by, n, condition)).select(key)
    matching = df.filter(_holds(condition))
    return matching.orderBy(*[sort_key(i) for i in by], key).limit(n).select(key)


def among_first(
    df: DataFrame, key: str, by: Sequence[Expr], n: int, condition: Expr | None = None
) -> Column:
    """Whether a row is among the first n matching ones, by comparison with the n-th, which is looked for now."""
    if not all(isinstance(item, str) for item in by):
        raise ValueError(f"an order given as Columns picks at most {IN_PLACE} rows; give it as text")
    hit = _holds(condition)
    whole = [*by, f"`{key}`"]
    (last,) = boundaries(df.filter(hit), whole, [n])
    return hit if last is None else hit & ~behind(whole, last)


def flag_first(
    df: DataFrame, key: str, by: Sequence[Expr], n: int, condition: Expr | None = None
) -> DataFrame:
    if n > IN_PLACE:
        return df.withColumn(_PICKED, among_first(df, key, by, n, condition))
    picked = first_keys(df, key, by, n, condition).withColumn(_PICKED, F.lit(True))
    return df.join(picked, key, "left")


def update_topn(
    df: DataFrame,
    key: str,
    values: Mapping[str, Expr],
    by: Sequence[Expr],
    n: int,
    condition: Expr | None = None,
) -> DataFrame:
    flagged = flag_first(df, key, by, n, condition)
    return update(flagged, values, F.col(_PICKED)).select(df.columns)


def delete(df: DataFrame, condition: Expr | None = None) -> DataFrame:
    """Drop the rows for which the condition holds."""
    return df.filter(~_holds(condition))


def delete_topn(
    df: DataFrame, key: str, by: Sequence[Expr], n: int, condition: Expr | None = None
) -> DataFrame:
    if n > IN_PLACE:
        return df.filter(~among_first(df, key, by, n, condition))
    return df.join(first_keys(df, key, by, n, condition), key, "left_anti").select(df.columns)


def free_sql(
    spark: SparkSession,
    text: str,
    params: Mapping[str, object] | Sequence[object] | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """SQL text over DataFrames named in braces, with ``:name`` or ``?`` parameters."""
    bound = dict(params) if isinstance(params, Mapping) else list(params) if params else None
    return spark.sql(text, args=bound, **tables)


def list_tables(spark: SparkSession, pattern: str = "%") -> list[str]:
    """Names of tables and views matching a LIKE pattern: ``%`` any text, ``_`` one character, backslash escapes."""
    parts = re.findall(r"\\.|.", pattern, re.DOTALL)
    like = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c[-1]) for c in parts)
    return sorted(t.name for t in spark.catalog.listTables() if re.fullmatch(like, t.name, re.DOTALL | re.IGNORECASE))
