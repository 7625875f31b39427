"""Labelled documents from Parquet or JSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields of a review record.
REVIEW_SCHEMA = T.StructType([
    T.StructField("reviewerID", T.StringType()),
    T.StructField("asin", T.StringType()),
    T.StructField("reviewerName", T.StringType()),
    T.StructField("helpful", T.ArrayType(T.IntegerType())),
    T.StructField("reviewText", T.StringType()),
    T.StructField("overall", T.DoubleType()),
    T.StructField("summary", T.StringType()),
    T.StructField("unixReviewTime", T.LongType()),
    T.StructField("reviewTime", T.StringType()),
    T.StructField("category", T.StringType()),
])


def review_schema(overall: T.DataType | None = None) -> T.StructType:
    """The review schema, with another type for ``overall`` if wanted (e.g. float)."""
    if overall is None:
        return REVIEW_SCHEMA
    return T.StructType([T.StructField(f.name, overall if f.name == "overall" else f.dataType)
                         for f in REVIEW_SCHEMA])


def read_table(spark: SparkSession, folder: str, name: str,
               columns: Sequence[str] = ()) -> DataFrame:
    """One Parquet table of a folder, reduced to the wanted columns."""
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table


def read_reviews(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 malformed: str = "drop") -> DataFrame:
    """JSON lines with a declared schema.

    ``malformed="drop"`` leaves broken lines out; ``"null"`` keeps them as all-null
    rows for a later null filter; ``"fail"`` stops the read.
    """
    modes = {"drop": "DROPMALFORMED", "null": "PERMISSIVE", "fail": "FAILFAST"}
    if malformed not in modes:
        raise ValueError(f"malformed must be one of {sorted(modes)}, got {malformed!r}")
    return (spark.read.schema(schema or REVIEW_SCHEMA)
            .option("mode", modes[malformed]).json(path))


CORRUPT = "_corrupt_record"


def read_reviews_marked(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Every line with its fields, a ``reject`` reason (null when valid) and, if rejected, the ``line``.

    ``not JSON`` is a line that does not parse as an object, ``field type`` one whose values
    do not have the declared types. Bytes that are not UTF-8 become replacement characters
    before parsing. Blank lines are no records.
    """
    fields = schema or REVIEW_SCHEMA
    marked = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).select(F.make_valid_utf8("value").alias("line")).where(F.trim("line") != "")
    # Exploding a one-element array keeps the parse from being repeated for every field.
    parsed = lines.select("line", F.explode(F.array(F.from_json(
        "line", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))).alias("r"))
    broken = F.col(f"r.{CORRUPT}").isNotNull() | F.col("r").isNull()
    objects = F.try_variant_get(F.try_parse_json("line"), "$", "map<string, variant>").isNotNull()
    reason = F.when(broken, F.when(objects, "field type").otherwise("not JSON"))
    return parsed.select("r.*", reason.alias("reject"), F.when(broken, F.col("line")).alias("line")).drop(CORRUPT)


def valid_reviews(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject").isNull()).drop("reject", "line")


def rejected_reviews(rows: DataFrame) -> DataFrame:
    """``(reject, line)`` of the lines that are no valid records."""
    return rows.filter(F.col("reject").isNotNull()).select("reject", "line")


def read_reviews_inferred(spark: SparkSession, path: str,
                          sampling_ratio: float = 1.0) -> DataFrame:
    """JSON lines with the schema taken from the data, at the price of one more pass."""
    return spark.read.option("samplingRatio", str(sampling_ratio)).json(path)


def compose_text(df: DataFrame, columns: Sequence[str], output: str = "text") -> DataFrame:
    """Join text columns with a blank, null counting as empty."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    return df.withColumn(output, F.concat_ws(" ", *parts))


def labelled_documents(df: DataFrame, text: str, category: str, keep: Sequence[str] = (),
                       null_category: str = "drop", null_text: str = "empty") -> DataFrame:
    """``(keep..., category, text)`` with the null policy made explicit.

    ``null_category``: ``drop`` the row, or count it under the ``empty`` name.
    ``null_text``: an ``empty`` document that still counts, or ``drop`` the row.
    Both filters sit below the later branches, so the branches share one scan.
    """
    for name, value in (("null_category", null_category), ("null_text", null_text)):
        if value not in ("drop", "empty"):
            raise ValueError(f"{name} must be 'drop' or 'empty', got {value!r}")
    if null_category == "drop":
        df = df.filter(F.col(category).isNotNull())
    if null_text == "drop":
        df = df.filter(F.col(text).isNotNull())
    return df.select(*keep, F.coalesce(F.col(category).cast("string"), F.lit("")).alias("category"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select and rename in one step, ``{source: target}``."""
    return df.selectExpr(*[f"`{old}` AS `{new}`" for old, new in names.items()])


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def present_columns(df: DataFrame, wanted: Sequence[str]) -> tuple[list[str], list[str]]:
    """Split the wanted names into (present, missing) without touching data."""
    return ([c for c in wanted if c in df.columns], [c for c in wanted if c not in df.columns])
