"""Names of the tests a row fails."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_failed(tests: Mapping[str, Column]) -> Column:
    """True where some test holds; unknown counts as not holding."""
    return F.coalesce(reduce(or_, tests.values(), F.lit(False)), F.lit(False))


def failed(tests: Mapping[str, Column]) -> Column:
    """Array of the labels whose test holds, in order; empty where none does.

    Built from expressions with generated code, and only for rows with a failure.
    """
    none = F.array().cast("array<string>")
    if not tests:
        return none
    found = F.array(*[F.when(test, F.lit(label)) for label, test in tests.items()])
    gaps = F.array(F.lit(None).cast("string"))
    return F.when(any_failed(tests), F.array_except(found, gaps)).otherwise(none)
