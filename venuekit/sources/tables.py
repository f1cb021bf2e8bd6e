"""JSON-lines and hand-off tables: strict, validated and lenient readers, and readers with a fallback."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType, StructField, StructType, VariantType

REASON = "_reason"
CORRUPT = "_corrupt"
# A text that stands for itself without quotes: a number, a flag, an array or an object.
BARE = r"^(?:-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|[\[{](?s:.*))$"


def read_json_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan JSON lines with a declared schema; only the referenced columns are converted."""
    return spark.read.schema(schema).json(path)


def _decodes(line: Column) -> Column:
    """Whether a line is one whole JSON object."""
    return F.json_object_keys(line).isNotNull()


def _untyped(kind: DataType) -> DataType:
    """The schema with every value as it is written, so that its JSON type can still be seen."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _untyped(f.dataType), True) for f in kind.fields])
    return VariantType()


def _typed(value: Column, kind: DataType) -> Column:
    """A value in its declared type, or null if it is of another one. Numbers may be written as text."""
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, StringType):
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
    if isinstance(kind, NumericType):
        is_number = F.schema_of_variant(value) != "BOOLEAN"
        return F.when(is_number, F.try_variant_get(value, "$", kind.simpleString()))
    return F.try_variant_get(value, "$", kind.simpleString())


def _strings(kind: StructType, path: str) -> list[str]:
    """Paths of the text values of a schema."""
    found = []
    for f in kind.fields:
        if isinstance(f.dataType, StructType):
            found += _strings(f.dataType, f"{path}.{f.name}")
        elif isinstance(f.dataType, StringType):
            found.append(f"{path}.{f.name}")
    return found


def _parsed(lines: DataFrame, schema: StructType, line: str) -> DataFrame:
    """(_line, _t, _odd, _v): each line parsed once by the declared types, and once more, value by value, if it is odd.

    A line is odd if the typed parse failed in part of it, if it is no object in braces, if a text reads like a number, a flag or
    a nested value, which the typed parse takes as text even without quotes, or if it has the letters of a number that JSON
    does not know. Only for odd lines is ``_v`` filled in.
    """
    typed = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    text = F.col("_line")
    once = lines.select(F.col(line).alias("_line")).withColumn(
        "_t", F.from_json(text, typed, {"columnNameOfCorruptRecord": CORRUPT})
    )
    odd = F.col(f"_t.{CORRUPT}").isNotNull() | F.col("_t").isNull() | ~text.rlike(r"^\s*\{(?s:.*)\}\s*$")
    for word in ("NaN", "Infinity"):
        odd = odd | text.contains(word)
    for path in _strings(schema, "_t"):
        odd = odd | F.coalesce(F.col(path).rlike(BARE), F.lit(False))
    marked = once.withColumn("_odd", F.coalesce(odd, F.lit(True)))
    return marked.withColumn("_v", F.when(F.col("_odd"), F.from_json(text, _untyped(schema))))


def read_lenient(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Scan JSON lines and skip those that cannot be decoded; a value of the wrong type is null.

    Bare NaN and Infinity are read as numbers. Which lines stay does not depend on the columns that are asked for.
    """
    parsed = _parsed(spark.read.text(path), schema, "value")
    strict = F.when(F.col("_odd"), _decodes(F.col("_line"))).otherwise(True)
    named = F.regexp_replace("_line", r"([:\[,]\s*)-?(?:NaN|Infinity)(?=\s*[,}\]])", "$1null")
    loose = F.when(strict, True).otherwise(_decodes(named))
    kept = parsed.withColumn("_strict", strict).filter(loose)
    typed = [F.when(F.col("_odd") & F.col("_strict"), _typed(F.col(f"_v.{f.name}"), f.dataType)).otherwise(F.col(f"_t.{f.name}"))
             .alias(f.name) for f in schema.fields]
    return kept.select(*typed)


def check_lines(
    lines: DataFrame, schema: StructType, required: Iterable[str], line: str = "value", typed: Iterable[str] = ()
) -> DataFrame:
    """Parse one JSON object per line and add ``_reason``: null when good, else why the record is corrupt.

    A required name may be a path into a struct (``location.city``). A line is corrupt when it is no JSON object, when a
    required value has the wrong type (text that is not quoted, a number that is neither one nor written as one), or when
    one is missing. ``typed`` names values that may be missing but must have their type; any others of the wrong type are
    null. Records and reasons come from the same pass over the text: store the result, and ``valid_records`` and
    ``corrupt_counts`` read that copy.
    """
    parsed = _parsed(lines, schema, line)
    wrong, missing = ~_decodes(F.col("_line")), []
    required = list(required)
    for name in dict.fromkeys([*required, *typed]):
        kind: DataType = schema
        for part in name.split("."):
            kind = kind[part].dataType
        raw = F.col(f"_v.{name}")
        given = raw.isNotNull() & ~F.coalesce(F.is_variant_null(raw), F.lit(True))
        wrong = wrong | (given & _typed(raw, kind).isNull())
        if name in required:
            missing.append((name, F.when(F.col("_odd"), ~given).otherwise(F.col(f"_t.{name}").isNull())))
    reason = F.when(F.col("_line").isNull() | F.when(F.col("_odd"), wrong).otherwise(False), F.lit("parse_error"))
    for name, absent in missing:
        reason = reason.when(absent, F.lit(f"missing_{name}"))
    values = [
        F.when(F.col("_odd"), _typed(F.col(f"_v.{f.name}"), f.dataType)).otherwise(F.col(f"_t.{f.name}")).alias(f.name)
        for f in schema.fields
    ]
    return parsed.select(*values, reason.alias(REASON))


def read_checked(spark: SparkSession, path: str, schema: StructType, required: Iterable[str]) -> DataFrame:
    """``check_lines`` over the lines of a file or folder."""
    return check_lines(spark.read.text(path), schema, required)


def valid_records(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def corrupt_counts(checked: DataFrame) -> DataFrame:
    """Corrupt records by reason."""
    return (
        checked.filter(F.col(REASON).isNotNull())
        .groupBy(F.col(REASON).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_build(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]) -> DataFrame:
    """The processed dataset when its path exists, else whatever ``fallback`` builds. Other errors are raised."""
    try:
        return primary()
    except AnalysisException as error:
        if not _path_missing(error):
            raise
        return fallback()


def first_available(
    spark: SparkSession, paths: Iterable[str], schema: StructType, fmt: str = "parquet"
) -> DataFrame:
    """The first of several candidate paths that exists, else an empty frame."""
    for path in paths:
        try:
            return spark.read.schema(schema).format(fmt).load(path)
        except AnalysisException as error:
            if not _path_missing(error):
                raise
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The dataset at ``path``, or an empty frame with the same schema when there is none."""
    return first_available(spark, [path], schema, fmt)


def optional_column(df: DataFrame, path: str, otherwise: Column | None = None) -> Column:
    """``df``'s column or struct field at ``path`` when the schema has it, else ``otherwise`` (null)."""
    kind = df.schema
    for part in path.split("."):
        if not isinstance(kind, StructType) or part not in kind.names:
            return F.lit(None).cast("string") if otherwise is None else otherwise
        kind = kind[part].dataType
    return F.col(path)
