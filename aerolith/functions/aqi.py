"""Air-quality scalar functions as Spark ``Column`` expressions (SC1-SC7, SC13, SC19).

Everything here compiles to plain Catalyst expressions (``CASE WHEN`` chains,
``bround``, ``greatest``), so it runs inside whole-stage codegen; there is no
Python UDF on this path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.numeric import clean_double

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results).
# US EPA breakpoint tables: (concentration low, concentration high,
# index low, index high). The tables have gaps (12.0-12.1, 54-55, ...):
# a concentration inside a gap has no sub-index.
# ---------------------------------------------------------------------------
PM25_BREAKPOINTS = [
    (0.0, 12.0, 0, 50),
    (12.1, 35.4, 51, 100),
    (35.5, 55.4, 101, 150),
    (55.5, 150.4, 151, 200),
    (150.5, 250.4, 201, 300),
    (250.5, 350.4, 301, 400),
    (350.5, 500.4, 401, 500),
]

PM10_BREAKPOINTS = [
    (0, 54, 0, 50),
    (55, 154, 51, 100),
    (155, 254, 101, 150),
    (255, 354, 151, 200),
    (355, 424, 201, 300),
    (425, 504, 301, 400),
    (505, 604, 401, 500),
]

# Upper bounds (inclusive) of the six AQI bands and their labels.
BAND_UPPER = [50, 100, 150, 200, 300]
CATEGORIES = [
    "Good",
    "Moderate",
    "Unhealthy for Sensitive Groups",
    "Unhealthy",
    "Very Unhealthy",
    "Hazardous",
]
UNKNOWN = "Unknown"

ALERT_UPPER = [100, 150, 200, 300]
ALERT_LEVELS = ["Normal", "Caution", "Warning", "High Alert", "Emergency"]

# Health guidance, three wordings (scoring module, forecast service, dashboard);
# index 0 is the text for a missing AQI, then one text per band.
GUIDANCE = {
    "scoring": [
        "Current AQI is unavailable.",
        "Air quality is satisfactory. Normal outdoor activities may continue.",
        "Air quality is acceptable for most people. Very sensitive individuals should monitor exposure.",
        "Sensitive groups should reduce prolonged or strenuous outdoor activity.",
        "Everyone may begin to experience health effects. Sensitive groups should avoid prolonged outdoor exposure.",
        "Health alert conditions are expected. Significantly reduce outdoor activity.",
        "Hazardous conditions. Avoid unnecessary outdoor activity and follow public-health guidance.",
    ],
    "forecast": [
        "AQI information is unavailable.",
        "Air quality is satisfactory. Normal outdoor activity may continue.",
        "Air quality is acceptable for most people. Very sensitive individuals should monitor exposure.",
        "Sensitive groups should reduce prolonged or strenuous outdoor activity.",
        "Everyone may experience health effects. Sensitive groups should avoid prolonged outdoor exposure.",
        "Health alert conditions are expected. Significantly reduce outdoor activity.",
        "Hazardous air quality. Avoid unnecessary outdoor activity and follow public-health guidance.",
    ],
    "dashboard": [
        "Current AQI information is unavailable.",
        "Air quality is good. Normal outdoor activities can continue.",
        "Air quality is acceptable for most people. Very sensitive individuals should monitor prolonged outdoor exposure.",
        "Sensitive groups may experience health effects. Children, older adults, and individuals with respiratory conditions should reduce prolonged outdoor activity.",
        "Unhealthy conditions are possible for everyone. Sensitive groups should avoid prolonged outdoor activity.",
        "Very unhealthy conditions are expected. Outdoor exposure should be reduced significantly.",
        "Hazardous air quality conditions are expected. Avoid unnecessary outdoor activity and follow public-health guidance.",
    ],
}

# Colour and card class per band (index 0 = missing AQI).
COLORS = ["#64748B", "#10B981", "#FACC15", "#FB923C", "#F43F5E", "#A855F7", "#881337"]
CARD_CLASSES = [
    "aqi-unknown",
    "aqi-good",
    "aqi-moderate",
    "aqi-sensitive",
    "aqi-unhealthy",
    "aqi-very-unhealthy",
    "aqi-hazardous",
]

# Activity recommendation (level, outdoor, exercise) per band (index 0 = missing AQI).
ACTIVITY = [
    ("Unknown", "Check air-quality data before planning outdoor activity.", "No recommendation available."),
    ("Excellent", "Good time for outdoor activities.", "Suitable for walking, running, cycling, and outdoor exercise."),
    ("Acceptable", "Outdoor activity is generally acceptable.", "Sensitive people may prefer lighter or shorter outdoor exercise."),
    ("Use Caution", "Reduce long outdoor activities if you are sensitive to air pollution.", "Prefer light exercise and avoid prolonged strenuous activity outdoors."),
    ("Limit Outdoor Activity", "Limit prolonged outdoor exposure.", "Prefer indoor exercise, especially for sensitive groups."),
    ("Avoid Outdoor Exercise", "Outdoor exposure should be kept to a minimum.", "Move exercise and recreation indoors."),
    ("Stay Indoors", "Avoid unnecessary outdoor activity.", "Avoid outdoor exercise and follow public-health guidance."),
]

AQI_MAX = 500
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _double_sql(x) -> str:
    """A DOUBLE literal in SQL text (a bare ``50.0`` would be a DECIMAL)."""
    return f"{float(x)!r}D"


def sub_index(concentration: str, breakpoints=PM25_BREAKPOINTS) -> Column:
    """SC1: linear interpolation inside the matching breakpoint bracket.

    NULL / NaN / negative -> NULL; above the top bracket -> 500; inside a
    table gap -> NULL. Rounded half-to-even to an integer (``bigint``).
    ``concentration`` is a column name. The CASE expression is written as one
    SQL text, so building it costs one call instead of one per operator.
    """
    c = f"nanvl(CAST(`{concentration}` AS DOUBLE), CAST(NULL AS DOUBLE))"
    branches = [f"WHEN {c} IS NULL OR {c} < 0.0D THEN NULL"]
    for c_lo, c_hi, i_lo, i_hi in breakpoints:
        lo, hi, ilo, ihi = (_double_sql(x) for x in (c_lo, c_hi, i_lo, i_hi))
        branches.append(f"WHEN {c} >= {lo} AND {c} <= {hi} "
                        f"THEN bround(({ihi} - {ilo}) / ({hi} - {lo}) * ({c} - {lo}) + {ilo}, 0)")
    branches.append(f"WHEN {c} > {_double_sql(breakpoints[-1][1])} THEN {_double_sql(AQI_MAX)}")
    return F.expr(f"CAST(CASE {' '.join(branches)} ELSE NULL END AS BIGINT)")


def us_aqi(pm2_5: Column | str, pm10: Column | str) -> Column:
    """SC2: maximum of the available sub-indices; NULL when none is available."""
    return F.greatest(sub_index(pm2_5, PM25_BREAKPOINTS), sub_index(pm10, PM10_BREAKPOINTS))


def _band_index(aqi: Column | str, uppers) -> Column:
    """0 for missing, else 1 + number of band upper bounds strictly below the value.

    The input appears once in the counting lambda (plus one NULL test), so a
    large input expression (e.g. an inlined AQI) is not copied per band.
    """
    a = clean_double(_col(aqi))
    bounds = F.array(*[F.lit(float(u)) for u in uppers])
    return F.when(a.isNull(), F.lit(0)).otherwise(F.size(F.filter(bounds, lambda u: u < a)) + 1)


def band_index(aqi: Column | str) -> Column:
    """SC19: 0 for a missing AQI, else the 1-based AQI band (1 = Good ... 6 = Hazardous)."""
    return _band_index(aqi, BAND_UPPER)


def _pick(index: Column, values) -> Column:
    """``values[index]`` (0-based) via one array lookup."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)


def aqi_category(aqi: Column | str) -> Column:
    """SC3 / SC19: six right-closed bands; missing -> ``Unknown``."""
    return _pick(_band_index(aqi, BAND_UPPER), [UNKNOWN] + CATEGORIES)


def alert_level(aqi: Column | str) -> Column:
    """SC4: operational alert level."""
    return _pick(_band_index(aqi, ALERT_UPPER), [UNKNOWN] + ALERT_LEVELS)


def health_guidance(aqi: Column | str, variant: str = "scoring") -> Column:
    """SC5: public-health text, one of three wordings."""
    return _pick(_band_index(aqi, BAND_UPPER), GUIDANCE[variant])


def aqi_color(aqi: Column | str) -> Column:
    """SC7: colour code per band."""
    return _pick(_band_index(aqi, BAND_UPPER), COLORS)


def aqi_card_class(aqi: Column | str) -> Column:
    """SC7: card class per band."""
    return _pick(_band_index(aqi, BAND_UPPER), CARD_CLASSES)


def activity_recommendation(aqi: Column | str) -> Column:
    """SC6: struct<level, outdoor, exercise>."""
    idx = _band_index(aqi, BAND_UPPER)
    return F.struct(
        _pick(idx, [a[0] for a in ACTIVITY]).alias("level"),
        _pick(idx, [a[1] for a in ACTIVITY]).alias("outdoor"),
        _pick(idx, [a[2] for a in ACTIVITY]).alias("exercise"),
    )


def clip_prediction(pred: Column | str, digits: int = 2) -> Column:
    """SC13: clamp a model output to [0, 500] and round half-to-even."""
    p = clean_double(_col(pred))
    return F.bround(F.least(F.greatest(p, F.lit(0.0)), F.lit(float(AQI_MAX))), digits)


def with_aqi(df, pm2_5: str = "pm2_5", pm10: str = "pm10"):
    """Add ``pm25_index``, ``pm10_index`` and ``us_aqi`` to an observation frame."""
    return df.withColumns({
        "pm25_index": sub_index(pm2_5, PM25_BREAKPOINTS),
        "pm10_index": sub_index(pm10, PM10_BREAKPOINTS),
    }).withColumn("us_aqi", F.greatest(F.col("pm25_index"), F.col("pm10_index")))


def with_labels(df, aqi: str = "us_aqi", variant: str = "scoring"):
    """Add category, alert level and guidance text for ``aqi``."""
    return df.withColumns({
        "aqi_category": aqi_category(aqi),
        "alert_level": alert_level(aqi),
        "health_guidance": health_guidance(aqi, variant),
    })
