"""Delimited-text and Parquet sources and sinks."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The readers take the columns by position, so a schema lists every column of
# its file, in file order.
PEOPLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("f3", T.StringType()),
    T.StructField("f4", T.DoubleType()),
    T.StructField("f5", T.StringType()),
])
STATUS_SCHEMA = T.StructType(
    PEOPLE_SCHEMA.fields + [T.StructField("status", T.StringType())]
)


def _required(name: str):
    message = F.concat(F.lit(f"missing value for {name}, id "), F.coalesce("id", F.lit("")))
    return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))


def read_people(
    spark: SparkSession,
    path: str,
    schema: T.StructType = PEOPLE_SCHEMA,
    header_substring: str | None = None,
) -> DataFrame:
    """Read unquoted comma-separated points, columns taken by position.

    A row of the wrong width, a number that does not parse and an empty
    coordinate all fail the job. The first line of each file is its header.
    With ``header_substring`` there is no header line; instead every line that
    contains the substring is left out, wherever it stands.
    """
    if header_substring is None:
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("quote", "")
            .csv(path)
        )
    else:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        rows = (
            spark.read.text(path)
            .where(~F.col("value").contains(header_substring))
            .select(F.from_csv("value", ddl, {"mode": "FAILFAST", "quote": ""}).alias("row"))
            .select("row.*")
        )
    # An empty id is a value like any other; the CSV reader turns it into NULL.
    return rows.withColumns({
        "id": F.coalesce("id", F.lit("")),
        "x": _required("x"),
        "y": _required("y"),
    })


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Read CSV whose quoted fields may hold commas, quotes and line breaks.

    Pass a schema where it is known: inferring one reads the files once more.
    A file with line breaks inside fields cannot be split, so at scale keep
    many files, or convert once with ``write_parquet``.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def as_reviews(raw: DataFrame) -> DataFrame:
    """The review columns under plain names; score and price as DOUBLE or NULL."""
    return raw.select(
        "Id",
        "Title",
        F.col("Price").try_cast("double").alias("Price"),
        "User_id",
        F.col("`review/score`").try_cast("double").alias("score"),
        F.col("`review/text`").alias("text"),
    )


def as_books(raw: DataFrame) -> DataFrame:
    return raw.select("Title", "categories")


def read_reviews(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Read a review CSV with the columns Id, Title, Price, User_id,
    ``review/score`` and ``review/text``."""
    return as_reviews(read_quoted_csv(spark, path, schema))


def read_books(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Read a book CSV with the columns Title and categories."""
    return as_books(read_quoted_csv(spark, path, schema))


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """Write CSV that ``read_quoted_csv`` reads back unchanged.

    Leading and trailing blanks are kept. An empty string comes back as NULL.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write Parquet over ``path`` and return the written table.

    Previews and later steps should use the returned table, so that the work
    behind ``df`` runs once.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
