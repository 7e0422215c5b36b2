"""Additive feature attributions (EX1-EX6, SC17, SO7).

For a linear model the exact additive attribution of feature j on row x is
``w_j * (x_j - mean_j)`` with base value ``b + sum_j w_j * mean_j``; base plus
the attributions equals the prediction (EX4). Attributions are produced in
long format (row, feature, value, phi) by ``posexplode`` of the feature
vector, so they are ordinary distributed rows; background means are one row
per feature slot (bounded by the model width) and broadcast.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_SEED = 42
SAMPLE_SIZE = 2000


def sample_rows(df: DataFrame, keys: list[str], n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """SO7: deterministic sample of ``n`` rows (all rows when fewer): smallest MD5 of the row key as text.

    A top-n by hash: each partition keeps its n best candidates, so the
    merge holds at most n x partitions rows.
    """
    return df.withColumn("_h", F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))).orderBy("_h", *keys).limit(n).drop("_h")


def slot_names(scored: DataFrame, features_col: str = "features") -> list[str]:
    """Names of the assembled vector slots from the ML attribute metadata (driver-side metadata only)."""
    meta = scored.schema[features_col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    names = [None] * int(meta.get("num_attrs", len(attrs)))
    for a in attrs:
        names[a["idx"]] = a.get("name", f"f{a['idx']}")
    return [n or f"f{i}" for i, n in enumerate(names)]


def raw_feature_of(slot: str, raw_features: list[str]) -> str:
    """SC17: longest raw feature name that prefixes the encoded slot name (one-hot slots fold back)."""
    best = None
    for r in raw_features:
        if slot == r or slot.startswith(r + "_"):
            if best is None or len(r) > len(best):
                best = r
    return best or slot


# Display labels of the reference.
FEATURE_LABELS = {
    "pm2_5": "PM2.5", "pm10": "PM10", "us_aqi": "Current AQI",
    "aqi_lag_1": "AQI Lag 1 Hour", "aqi_lag_3": "AQI Lag 3 Hours", "aqi_lag_6": "AQI Lag 6 Hours", "aqi_lag_24": "AQI Lag 24 Hours",
    "aqi_roll_3": "AQI Rolling 3 Hours", "aqi_roll_6": "AQI Rolling 6 Hours", "aqi_roll_24": "AQI Rolling 24 Hours",
    "nitrogen_dioxide": "Nitrogen Dioxide", "ozone": "Ozone", "sulphur_dioxide": "Sulphur Dioxide", "carbon_monoxide": "Carbon Monoxide",
    "temperature": "Temperature", "humidity": "Humidity", "pressure": "Pressure", "wind_speed": "Wind Speed", "cloud_cover": "Cloud Cover",
    "visibility": "Visibility", "day_of_week": "Day of Week", "is_weekend": "Weekend Indicator", "city": "City", "season": "Season",
}


def feature_label(name: Column | str) -> Column:
    """SC17: the label shown for a raw feature; names without one are put in title case."""
    c = F.col(name) if isinstance(name, str) else name
    labels = F.create_map(*[F.lit(x) for kv in FEATURE_LABELS.items() for x in kv])
    return F.coalesce(F.element_at(labels, c), F.initcap(F.replace(c, F.lit("_"), F.lit(" "))))


def raw_feature(slot: Column | str, raw_features: list[str]) -> Column:
    """SC17: an encoded slot name folded to the longest raw feature that it is or begins with, as a column."""
    c = F.col(slot) if isinstance(slot, str) else slot
    out = c
    for r in sorted(raw_features, key=len):   # the longest is looked at first
        out = F.when((c == r) | F.startswith(c, F.lit(r + "_")), F.lit(r)).otherwise(out)
    return out


def linear_attributions(model: PipelineModel, rows: DataFrame, background: DataFrame, keys: list[str],
                        raw_features: list[str], features_col: str = "features") -> DataFrame:
    """EX1/EX3/EX4: long table (keys, slot, raw_feature, value, phi, base_value, prediction)."""
    lr = model.stages[-1]
    weights = [float(x) for x in lr.coefficients]
    scored_bg = model.transform(background)
    names = slot_names(scored_bg, features_col)
    # background mean per slot: one row per slot (bounded by the model width)
    means = (scored_bg.select(F.posexplode(vector_to_array(features_col)).alias("slot_idx", "v"))
             .groupBy("slot_idx").agg(F.avg("v").alias("mean")))
    spark = rows.sparkSession
    slots = spark.createDataFrame([(i, names[i], raw_feature_of(names[i], raw_features), weights[i])
                                   for i in range(len(weights))], "slot_idx int, slot string, raw_feature string, weight double")
    slot_table = slots.join(means, "slot_idx", "left").fillna({"mean": 0.0})
    base = F.lit(float(lr.intercept)) + slot_table.agg(F.sum(F.col("weight") * F.col("mean"))).scalar()
    scored = model.transform(rows)
    long = scored.select(*keys, "prediction", F.posexplode(vector_to_array(features_col)).alias("slot_idx", "value"))
    out = long.join(F.broadcast(slot_table), "slot_idx")
    return out.select(*keys, "slot", "raw_feature", "value",
                      (F.col("weight") * (F.col("value") - F.col("mean"))).alias("phi"),
                      base.alias("base_value"), "prediction")


def fold_onehot(attr: DataFrame, keys: list[str]) -> DataFrame:
    """EX3: sum slot attributions per raw feature; sorted by |impact| within each row."""
    folded = attr.groupBy(*keys, "raw_feature").agg(F.sum("phi").alias("phi"))
    w = Window.partitionBy(*keys).orderBy(F.abs("phi").desc(), "raw_feature")
    return folded.withColumn("impact_rank", F.row_number().over(w).cast("bigint"))


def additivity(attr: DataFrame, keys: list[str], tolerance: float = 1e-6) -> DataFrame:
    """EX4: base + sum(phi) == prediction per row."""
    return attr.groupBy(*keys).agg(F.first("base_value").alias("base_value"), F.sum("phi").alias("sum_phi"),
                                   F.first("prediction").alias("prediction")) \
        .withColumn("additive", F.abs(F.col("base_value") + F.col("sum_phi") - F.col("prediction")) <= tolerance)


def global_importance(folded: DataFrame) -> DataFrame:
    """EX2: mean |phi| per raw feature over the explained rows, ranked (final ranking over #features rows)."""
    imp = folded.groupBy("raw_feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"))
    return imp.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs_phi").desc(), "raw_feature"))
                          .cast("bigint"))


def driver_text(folded: DataFrame, keys: list[str], top: int = 2) -> DataFrame:
    """EX5: 'Top drivers up: a, b; down: c, d' from the two largest positive and negative attributions."""
    wp = Window.partitionBy(*keys).orderBy(F.col("phi").desc(), "raw_feature")
    wn = Window.partitionBy(*keys).orderBy(F.col("phi").asc(), "raw_feature")
    r = folded.withColumn("_p", F.row_number().over(wp)).withColumn("_n", F.row_number().over(wn))
    agg = r.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when((F.col("_p") <= top) & (F.col("phi") > 0), F.struct("_p", "raw_feature")))).alias("up"),
        F.array_sort(F.collect_list(F.when((F.col("_n") <= top) & (F.col("phi") < 0), F.struct("_n", "raw_feature")))).alias("down"))
    up = F.array_join(F.transform("up", lambda s: s["raw_feature"]), ", ")
    down = F.array_join(F.transform("down", lambda s: s["raw_feature"]), ", ")
    return agg.select(*keys, F.concat(F.lit("Top drivers up: "), F.when(up == "", "none").otherwise(up),
                                      F.lit("; down: "), F.when(down == "", "none").otherwise(down)).alias("summary"))
