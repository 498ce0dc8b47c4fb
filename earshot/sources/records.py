"""Events as JSON text."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.operators.cleaning import apply_schema
from earshot.operators.profiling import Counted, null_profile
from earshot.schemas import json_form
from earshot.session import stage

# Where the reader puts text it can't parse; parsing proper fails on that.
_CORRUPT = "_corrupt_record"

# Where the text of records with further columns is staged.
_MORE = "_more"

# What stands before a bare NaN: anything but quotes and the start of one, or whole strings.
_BARE_NAN = r'\G((?:[^"N]|"(?:[^"\\]|\\.)*+"|N(?!aN\b))*+)NaN\b'


def without_bare_nan(value: Column) -> Column:
    """JSON text in which a bare NaN, which some writers put for a missing value, is null. Text
    in quotes stays as it is."""
    return F.when(value.contains("NaN"), F.regexp_replace(value, _BARE_NAN, "$1null")).otherwise(
        value
    )


def further_columns(records: DataFrame, schema: T.StructType) -> T.StructType:
    """The columns the JSON in ``value`` has beyond ``schema``, with the types Spark finds in a
    pass over all records. Columns that are null throughout are text."""
    value = without_bare_nan(F.col("value").cast("string")).alias("value")
    text = records.select(value).where(F.trim("value") != "")
    spark = records.sparkSession
    # The reader infers from a Dataset of text, which only the JVM's interface takes.
    strings = getattr(text._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    found = T.StructType.fromJson(
        json.loads(spark._jsparkSession.read().json(strings).schema().json())
    )
    known = {_CORRUPT, *(name.lower() for name in schema.names)}
    return T.StructType([f for f in found.fields if f.name.lower() not in known])


def further_text(value: Column, schema: T.StructType) -> Column:
    """A record's text if it names a column beyond ``schema``, else null."""
    names = F.transform(F.json_object_keys(value), F.lower)
    known = F.array(*[F.lit(n.lower()) for n in schema.names])
    return F.when(F.size(F.array_except(names, known)) > 0, value)


def stage_records(
    records: DataFrame, schema: T.StructType, folder: str
) -> tuple[DataFrame, int, dict[str, int]]:
    """The JSON in ``value`` typed to ``schema`` and staged in ``folder``, with its rows and the
    missing values per column.

    The text is read once. Beside the typed columns the staged files hold the text of those
    records that name further columns, and these columns are found and parsed from there.
    """
    value = without_bare_nan(F.col("value").cast("string"))
    marked = records.withColumn(_MORE, further_text(value, schema))
    counted = Counted(parse_records(marked, schema, keep=[_MORE]))
    staged, missing = stage(counted.df, folder), dict(counted.missing)
    if missing.pop(_MORE) == counted.rows:
        return staged.drop(_MORE), counted.rows, missing
    text = staged.where(F.col(_MORE).isNotNull()).select(F.col(_MORE).alias("value"))
    further = further_columns(text, schema)
    event = F.from_json(_MORE, further, {"mode": "FAILFAST"}).alias(_MORE)
    parsed = staged.select(*schema.names, event).select(*schema.names, f"{_MORE}.*")
    found = dict(map(tuple, null_profile(parsed.select(
        *[F.col(f"`{c}`") for c in further.names])).collect()))
    return parsed, counted.rows, missing | found


def parse_records(
    records: DataFrame,
    schema: T.StructType,
    keep: Sequence[str] = (),
    further: T.StructType | None = None,
    array: bool = False,
) -> DataFrame:
    """The JSON in ``value`` as columns typed to ``schema``, beside the columns in ``keep``.

    Blank values are skipped, a bare NaN is read as missing, and a malformed value fails the
    query. ``further`` are columns to read beyond the schema (``further_columns`` finds them); a
    name they share with ``keep`` goes to the kept one. ``array``: a value is a list of objects.
    """
    value = without_bare_nan(F.col("value").cast("string"))
    more = [f for f in further.fields if f.name not in keep] if further else []
    loose = T.StructType([*json_form(schema).fields, *more])
    shape = T.ArrayType(loose) if array else loose
    event = F.from_json(value, shape, {"mode": "FAILFAST"})
    event = (F.explode(event) if array else event).alias("event")
    parsed = records.where(F.trim(F.col("value").cast("string")) != "").select(event, *keep)
    return apply_schema(parsed.select("event.*", *keep), schema)
