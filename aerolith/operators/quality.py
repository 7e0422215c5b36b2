"""Schema alignment, coercion and data-quality operators (PR1-PR9, DQ1-DQ17, SO1-SO4).

Every check is a column expression or one aggregation pass; counts of
rejected rows come from the same scan as the cleaned output (``observe`` or
a single ``agg``), never from collecting rows to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions.numeric import safe_double
from aerolith.operators.latest import latest_per_key

# Provider column names -> training-schema names (guarded rename).
STANDARD_RENAMES = {
    "co": "carbon_monoxide",
    "no": "nitrogen_monoxide",
    "no2": "nitrogen_dioxide",
    "o3": "ozone",
    "so2": "sulphur_dioxide",
    "nh3": "ammonia",
    "aqi": "openweather_aqi_index",
}
# Model columns a live source may lack, with their defaults.
MISSING_DEFAULTS = {"wind_direction": 0.0, "precipitation": 0.0}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


class DataQualityError(ValueError):
    """Raised by strict checks (missing columns, invalid values)."""


# ---------------------------------------------------------------- projection
def standardize_columns(df: DataFrame, renames: dict[str, str] = STANDARD_RENAMES) -> DataFrame:
    """PR1: rename only where the source exists and the target does not."""
    cols = set(df.columns)
    mapping = {s: t for s, t in renames.items() if s in cols and t not in cols}
    return df.withColumnsRenamed(mapping) if mapping else df


def add_missing_columns(df: DataFrame, defaults: dict[str, float] = MISSING_DEFAULTS) -> DataFrame:
    """PR2: add absent model columns with constant defaults."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def align_to_schema(df: DataFrame, schema: T.StructType, lenient_cast: bool = True) -> DataFrame:
    """PR3/PR4: case-insensitive alignment to ``schema``.

    Missing column -> ``DataQualityError``; extra columns dropped; names
    and order taken from the schema; values cast with ``try_cast`` (bad -> NULL)
    and infinities mapped to NULL for floating columns.
    """
    lookup = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in lookup]
    if missing:
        raise DataQualityError(f"missing required columns: {missing}")
    out = []
    for f in schema.fields:
        src = F.col(f"`{lookup[f.name.lower()]}`")
        c = src.try_cast(f.dataType) if lenient_cast else src.cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.abs(c) == F.lit(float("inf")), F.lit(None).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def strict_cast_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PR5: one row with, per column, how many non-NULL inputs fail the cast (0 = castable)."""
    lookup = {c.lower(): c for c in df.columns}
    aggs = []
    for f in schema.fields:
        src = F.col(f"`{lookup[f.name.lower()]}`")
        aggs.append(F.count_if(src.isNotNull() & src.try_cast(f.dataType).isNull()).alias(f"bad_{f.name}"))
    return df.agg(*aggs)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def strict_cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PR5: cast to the contract and fail the load on any missing or unparsable number.

    Numeric contract columns are parsed leniently first (bad text and NaN ->
    NULL). One aggregation pass then counts the NULLs per numeric column, so a
    single row reaches the driver. If any count is non-zero,
    ``DataQualityError`` names the columns. Integral columns take the parsed
    number truncated toward zero (decimal text such as "3.7" becomes 3), and
    other columns are cast as declared.
    """
    lookup = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in lookup]
    if missing:
        raise DataQualityError(f"missing required columns: {missing}")
    casts, checked = {}, []
    for f in schema.fields:
        src = F.col(f"`{lookup[f.name.lower()]}`")
        if isinstance(f.dataType, _INTEGRAL + _FRACTIONAL):
            number = safe_double(src).cast(f.dataType)
            # integers directly: a detour over double would change them above 2^53
            casts[f.name] = F.coalesce(src.cast("string").try_cast(f.dataType), number) if isinstance(f.dataType, _INTEGRAL) else number
            checked.append(f.name)
        else:
            casts[f.name] = src.cast(f.dataType)
    out = df.select(*[casts[f.name].alias(f.name) for f in schema.fields])
    if checked:
        counts = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in checked]).first().asDict()
        bad = {c: n for c, n in counts.items() if n}
        if bad:
            raise DataQualityError(f"invalid numeric values (rows per column): {bad}")
    return out


def require_valid_timestamps(df: DataFrame, ts: str = "timestamp", fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """DQ2: parse ``ts``; any missing or unparsable time fails the load (one aggregate row to the driver)."""
    out = df.withColumn(ts, parse_timestamp(ts, fmt))
    bad = out.agg(F.count_if(F.col(ts).isNull()).alias("n")).first()["n"]
    if bad:
        raise DataQualityError(f"invalid timestamp values found: {bad} rows")
    return out


def validate_contract(df: DataFrame, required: list[str]) -> DataFrame:
    """DQ1/DQ5/DQ7: required columns present, no missing value (NULL or NaN) in any of them, rows > 0.

    One aggregation pass (missing count per column and the row count), so a
    single row reaches the driver. ``DataQualityError`` lists the columns
    with missing values. Returns ``df`` unchanged when it passes.
    """
    require_columns(df, required)
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in required:
        col = F.col(f"`{c}`")
        miss = col.isNull() | F.isnan(col) if types[c] in ("double", "float") else col.isNull()
        aggs.append(F.count_if(miss).alias(c))
    counts = df.agg(*aggs).first().asDict()
    rows = counts.pop("__rows")
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise DataQualityError(f"missing values per column: {bad}")
    if rows == 0:
        raise DataQualityError("dataset contains zero rows")
    return df


def union_align(*dfs: DataFrame) -> DataFrame:
    """PR6/ST1: UNION ALL by name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """PR9: numeric column discovery minus exclusions."""
    num = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, t in df.dtypes if (t in num or t.startswith("decimal")) and c not in set(exclude)]


def require_columns(df: DataFrame, required) -> None:
    """DQ1: raise when required columns are absent (metadata only, no job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise DataQualityError(f"missing required columns: {missing}")


# ------------------------------------------------------------------ coercion
def parse_timestamp(c: Column | str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """A time from a timestamp column, text in ``fmt`` or ISO text (``T``, fractions, minutes only); NULL if none of these."""
    col = F.col(c) if isinstance(c, str) else c
    text = col.cast("string")
    return F.coalesce(F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz"), text.try_cast("timestamp_ntz"))


def coerce_lenient(df: DataFrame, ts: str = "timestamp", numeric=(), key: str | None = "city",
                   fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """DQ3/DQ4: parse the time (invalid rows dropped), coerce numbers (bad -> NULL), trim the key.

    Rows with a NULL key are dropped as well (semantics decision 9: never turn
    a missing key into the text "nan").
    """
    out = df.withColumn(ts, parse_timestamp(ts, fmt))
    out = out.withColumns({c: safe_double(c) for c in numeric})
    cond = F.col(ts).isNotNull()
    if key:
        out = out.withColumn(key, F.trim(F.col(key)))
        cond = cond & F.col(key).isNotNull() & (F.col(key) != "")
    return out.filter(cond)


def coercion_report(df: DataFrame, ts: str = "timestamp", numeric=(), key: str | None = "city",
                    fmt: str = TIMESTAMP_FORMAT) -> DataFrame:
    """DQ2/DQ3/DQ5: one-pass counts of rows, invalid times, NULL keys and bad numbers."""
    t = parse_timestamp(ts, fmt)
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(t.isNull()).alias("invalid_timestamps")]
    if key:
        aggs.append(F.count_if(F.col(key).isNull()).alias("null_keys"))
    for c in numeric:
        aggs.append(F.count_if(F.col(c).isNotNull() & safe_double(c).isNull()).alias(f"bad_{c}"))
    out = df.agg(*aggs)
    return out.withColumn("strict_ok", F.col("invalid_timestamps") == 0)


# ---------------------------------------------------------------- profiling
def null_profile(df: DataFrame) -> DataFrame:
    """DQ7/DQ8: (column, nulls, rows) for every column, from one aggregation pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c, t in df.dtypes:
        cond = F.col(f"`{c}`").isNull()
        if t in ("double", "float"):
            cond = cond | F.isnan(F.col(f"`{c}`"))
        aggs.append(F.count_if(cond).alias(c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return wide.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column_name, nulls)", "__rows AS rows")


def duplicate_count(df: DataFrame) -> DataFrame:
    """DQ8: rows, distinct rows and exact-duplicate count from one grouped pass."""
    per_row = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    return per_row.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows"),
                       F.count(F.lit(1)).alias("distinct_rows")) \
        .withColumn("duplicate_rows", F.col("rows") - F.col("distinct_rows"))


def feature_availability(df: DataFrame, features: list[str]) -> DataFrame:
    """DQ9: available / missing counts per feature via unpivot + count."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [], features, "feature", "value")
    return long.groupBy("feature").agg(
        F.count("value").alias("available"),
        F.count_if(F.col("value").isNull()).alias("missing"),
    ).withColumn("available_pct", F.round(F.col("available") / (F.col("available") + F.col("missing")) * 100, 2))


def target_check(df: DataFrame, target: str = "target_aqi") -> DataFrame:
    """DQ10: min / max / missing of the target."""
    return df.agg(
        F.min(target).alias("target_min"), F.max(target).alias("target_max"),
        F.count_if(F.col(target).isNull()).alias("target_missing"), F.count(F.lit(1)).alias("rows"))


def range_flags(lat: Column | str, lon: Column | str) -> Column:
    """DQ12: coordinates within +/-90 and +/-180."""
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(lon) if isinstance(lon, str) else lon
    return la.between(-90, 90) & lo.between(-180, 180)


def history_coverage(df: DataFrame, key: str = "city", ts: str = "timestamp", min_hours: float = 24.0) -> DataFrame:
    """DQ14: per-entity (max - min) time span in hours and whether it reaches ``min_hours``."""
    span = (F.unix_micros(F.max(F.col(ts).cast("timestamp"))) -
            F.unix_micros(F.min(F.col(ts).cast("timestamp")))) / F.lit(3.6e9)
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(span.alias("span_hours"), F.count(F.lit(1)).alias("rows"))
            .withColumn("sufficient", F.col("span_hours") >= F.lit(float(min_hours))))


# ------------------------------------------------------------- de-duplication
def dedup(df: DataFrame, keys=("city", "timestamp"), order=("ingest_seq",), keep: str = "last") -> DataFrame:
    """SO2/SO3: one row per key, keeping the last (or first) by ``order``.

    Hash aggregation with ``max_by``/``min_by`` (combined map-side), so a key
    with millions of copies never lands whole in one task.
    """
    return latest_per_key(df, list(keys), list(order), newest=(keep == "last"))


def dedup_exact(df: DataFrame) -> DataFrame:
    """SO4: exact-row de-duplication (hash aggregate on all columns)."""
    return df.dropDuplicates()
