"""Raw employee records from CSV or parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermart.functions.parsing import null_if_token
from rostermart.operators.nulls import require_columns
from rostermart.operators.ordering import positions

FILE_ORDER = "src_ordinal"
MALFORMED = "_malformed_line"


def _not_found(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def _read_csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    options = {"quote": '"', "escape": '"', "multiLine": multi_line}
    names = spark.read.csv(path, header=True, inferSchema=False, **options).columns
    schema = ", ".join(f"`{n}` string" for n in names)
    # enforceSchema=False: every file's header has to match these names. Whole lines are
    # parsed (columnPruning=False), or else extra cells would go unseen.
    table = spark.read.option("columnPruning", False).csv(
        path, schema=f"{schema}, `{MALFORMED}` string", header=True, enforceSchema=False, columnNameOfCorruptRecord=MALFORMED, **options)
    # The reader also marks lines with too few cells; one more column tells those with too many.
    cells = F.from_csv(F.col(MALFORMED), f"{schema}, `{MALFORMED}` string", {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()})
    beyond = F.col(MALFORMED).isNotNull() & cells[MALFORMED].isNotNull()
    message = F.concat(F.lit(f"More than {len(names)} cells in a line of {path}: "), F.left(F.col(MALFORMED), F.lit(200)), F.coalesce(F.left(F.col(f"`{names[0]}`"), F.lit(0)), F.lit("")))
    return table.where(F.when(beyond, F.raise_error(message)).otherwise(F.lit(True))).drop(MALFORMED)


def read_employees(spark: SparkSession, path: str, required: Sequence[str] = (),
                   file_order: bool = False, multi_line: bool = False, form: str | None = None) -> DataFrame:
    """Read a headered CSV as text columns, or parquet as it is.

    ``form`` is ``csv`` or ``parquet``; without it, the path's suffix says which.
    The header line alone gives the names; no pass infers types. Cells that
    hold a null token become null; a line with fewer cells than the header is
    filled with nulls, one with more fails the job that reads it. A missing path
    raises ``FileNotFoundError`` and an absent required column
    ``MissingColumnsError``, both before any scan of the data. ``file_order`` adds the sortable ``src_ordinal``. ``multi_line``
    allows line breaks inside quotes, at the price of one task per file.
    """
    try:
        if form not in (None, "csv", "parquet"):
            raise ValueError(f"Unknown form: {form}")
        if form == "parquet" or form is None and path.rstrip("/").endswith(".parquet"):
            table = spark.read.parquet(path)
        else:
            table = _read_csv(spark, path, multi_line)
    except AnalysisException as error:
        if _not_found(error):
            raise FileNotFoundError(path) from error
        raise
    require_columns(table, required)
    clean = [null_if_token(F.col(f"`{f.name}`")).alias(f.name)
             if f.dataType.typeName() == "string" else F.col(f"`{f.name}`")
             for f in table.schema.fields]
    if file_order:
        place = F.struct(F.col("_metadata.file_path").alias("path"),
                         F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("row"))
        clean.append(place.alias(FILE_ORDER))
    return table.select(*clean)


def with_row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """0-based line number in file order, from ``src_ordinal``."""
    return positions(df, [FILE_ORDER], name)
