"""CSV and text-line sources.

The injury table arrives as CSV with an explicit schema, with a header and
inferred types, without a header (``_c0`` ... ``_c6``), or as raw lines that
are split and parsed by hand.  Poker hands arrive as lines of 11 integers.
Malformed input never fails a job here: short/long lines and fields that do
not parse are dropped (or flagged with ``keep_rejects=True``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tablelearn.functions.columns import all_not_null

# Column names and types of the injury table, in file order.
INJURY_COLUMNS = (
    "Player_Age",
    "Player_Weight",
    "Player_Height",
    "Previous_Injuries",
    "Training_Intensity",
    "Recovery_Time",
    "Likelihood_of_Injury",
)
INJURY_SCHEMA = StructType([
    StructField("Player_Age", IntegerType(), True),
    StructField("Player_Weight", DoubleType(), True),
    StructField("Player_Height", DoubleType(), True),
    StructField("Previous_Injuries", IntegerType(), True),
    StructField("Training_Intensity", DoubleType(), True),
    StructField("Recovery_Time", IntegerType(), True),
    StructField("Likelihood_of_Injury", IntegerType(), True),
])
INJURY_FEATURES = INJURY_COLUMNS[:-1]
INJURY_LABEL = INJURY_COLUMNS[-1]


def read_csv_schema(spark: SparkSession, path: str, schema: StructType = INJURY_SCHEMA,
                    header: bool = False) -> DataFrame:
    """CSV with a fixed schema (no inference job, every field nullable)."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_csv_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line and inferred types (an extra pass over the
    file; prefer ``read_csv_schema`` on large inputs)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_positional(spark: SparkSession, path: str, names=None) -> DataFrame:
    """CSV without a header, inferred types, positional names renamed."""
    df = spark.read.option("header", False).option("inferSchema", True).csv(path)
    return rename_positional(df, names) if names else df


def rename_positional(df: DataFrame, names) -> DataFrame:
    """``_c0``..``_cN`` to the given names (extra columns keep their names)."""
    names = list(names)
    new = names + df.columns[len(names):]
    return df.toDF(*new[: len(df.columns)])


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files: one string column ``value``."""
    return spark.read.text(path)


def features_and_label(df: DataFrame):
    """Last column is the label, the rest are features."""
    return list(df.columns[:-1]), df.columns[-1]


def records_as_lines(df: DataFrame, cols, line_col: str = "value") -> DataFrame:
    """Render rows as comma-separated text lines (nulls are skipped, so a row
    with a null renders short and is later rejected by the arity check)."""
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in cols]).alias(line_col))


_CSV_OPTIONS = {"mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}


def _strip_trailing_commas(line: Column) -> Column:
    # "a,b,," has two fields, as with the JVM String.split the data came from
    return F.rtrim(line, F.lit(","))


def _keep_if(record: Column, predicate, keep_cols=()) -> DataFrame:
    """Rows of ``record`` (a struct) for which ``predicate`` holds, as a
    generator: ``inline(filter(array(record), predicate))``.

    A plain ``filter`` on the parsed fields would be pushed below the
    projection that parses the line and Catalyst would substitute the parse
    expression into every field reference (once per field, per row).  The
    lambda variable here binds the record once.
    """
    return F.inline(F.filter(F.array(record), predicate))


def parse_records(df: DataFrame, line_col: str = "value", names=INJURY_COLUMNS,
                  keep_cols=(), keep_rejects: bool = False) -> DataFrame:
    """Text lines -> one double column per name (native CSV field parser,
    whitespace around fields trimmed).

    Lines whose field count differs from ``len(names)`` or with a field that
    does not parse as a number are dropped; with ``keep_rejects=True`` they
    are kept with ``rejected = true``.
    """
    names = list(names)
    line = _strip_trailing_commas(F.col(line_col))
    arity = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) + 1
    schema = ", ".join(f"`{n}` DOUBLE" for n in names)
    rec = F.struct(*[F.col(k).alias(k) for k in keep_cols],
                   F.from_csv(line, schema, _CSV_OPTIONS).alias("_r"), arity.alias("_n"))

    def ok(r):
        return (r["_n"] == len(names)) & all_not_null([r["_r"][n] for n in names])

    if keep_rejects:
        out = df.select(F.inline(F.array(rec)))
        return out.select(*keep_cols, *[F.col("_r")[n].alias(n) for n in names],
                          (~F.coalesce(ok(F.struct("_r", "_n")), F.lit(False))).alias("rejected"))
    out = df.select(_keep_if(rec, ok))
    return out.select(*keep_cols, *[F.col("_r")[n].alias(n) for n in names])


HAND_COLUMNS = tuple(f"{k}{i + 1}" for i in range(5) for k in ("s", "r")) + ("class",)


def parse_hand_lines(df: DataFrame, line_col: str = "value", keep_cols=(),
                     keep_rejects: bool = False) -> DataFrame:
    """``s1,r1,...,s5,r5,class`` -> int columns s1, r1, ..., s5, r5, ``class``.

    Even positions are suits, odd positions ranks, position 10 the class;
    fields past the eleventh are ignored.  Lines with fewer than 11 fields or
    a non-integer among the first 11 are dropped (or flagged).
    """
    line = _strip_trailing_commas(F.col(line_col))
    schema = ", ".join(f"`{n}` INT" for n in HAND_COLUMNS)
    rec = F.struct(*[F.col(k).alias(k) for k in keep_cols], F.from_csv(line, schema, _CSV_OPTIONS).alias("_r"))

    def ok(r):
        return all_not_null([r["_r"][n] for n in HAND_COLUMNS])

    if keep_rejects:
        out = df.select(F.inline(F.array(rec)))
        return out.select(*keep_cols, *[F.col("_r")[n].alias(n) for n in HAND_COLUMNS],
                          (~F.coalesce(ok(F.struct("_r")), F.lit(False))).alias("rejected"))
    out = df.select(_keep_if(rec, ok))
    return out.select(*keep_cols, *[F.col("_r")[n].alias(n) for n in HAND_COLUMNS])
