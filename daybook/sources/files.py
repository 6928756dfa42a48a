"""File scans with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.schemas import Entity

CORRUPT = "_corrupt_record"

# An empty cell is NULL and a quoted empty cell is an empty text, as the writer has
# them; the reader tells the two apart only when NULL is spelled unlike both.
_CSV = {"header": True, "escape": '"', "nullValue": "\u0000"}


def _header(spark: SparkSession, path: str, options: dict) -> list[str]:
    # without inference Spark reads only the first line of one file
    return spark.read.options(**options).csv(path).columns


def odd_quotes(line: Column) -> Column:
    """Whether a line has an odd number of quotes: some quoted value then goes over its end."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some quoted value goes over the end of its line.

    Lines are read in parallel, and only until the first such line is found.
    """
    return not spark.read.text(path).filter(odd_quotes(F.col("value"))).isEmpty()


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    keep_corrupt: bool = False,
    line_breaks: bool | None = None,
) -> DataFrame:
    """CSV with a header, one file or a directory of parts.

    Columns are bound by header name, whatever their order in the file; every
    part has to carry the same header.  Without a schema all columns are text,
    which is what cleaning wants.  Values that do not parse become NULL; with
    ``keep_corrupt`` the raw line is kept beside them, also of lines with missing or surplus
    cells, whichever columns are used.

    ``line_breaks`` says whether quoted values may hold line breaks; by default the lines are looked
    through first.  Files that have any are read by one task each, others in parallel by line as well.
    """
    broken = has_line_breaks(spark, path) if line_breaks is None else line_breaks
    options = {**_CSV, "multiLine": broken}
    declared = {f.name: f.dataType for f in schema} if schema else {}
    header = _header(spark, path, options)
    missing = [name for name in declared if name not in header]
    if missing:
        raise ValueError(f"{path}: header lacks {missing}")
    physical = T.StructType([T.StructField(name, declared.get(name, T.StringType())) for name in header])
    reader = spark.read.options(**options).option("enforceSchema", False).option("mode", "PERMISSIVE")
    if keep_corrupt:
        physical = physical.add(CORRUPT, T.StringType())
        # a pruned parser does not count the cells
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    df = reader.schema(physical).csv(path)
    if schema is None:
        return df
    return df.select(*schema.fieldNames(), *([CORRUPT] if keep_corrupt else []))


def scan_entity(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    return scan_csv(spark, path, entity.schema)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_part_dir(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """All part files of a written CSV directory; FileNotFoundError if there is none."""
    if not part_files(spark, folder):
        raise FileNotFoundError(f"no part-*.csv in {folder}")
    return scan_csv(spark, folder, schema)


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The CSV parts in a folder of any file system Spark can reach."""
    try:
        return sorted(spark.read.text(f"{folder}/part-*.csv*").inputFiles())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def empty_relation(df: DataFrame) -> DataFrame:
    """No rows, same schema."""
    return df.limit(0)
