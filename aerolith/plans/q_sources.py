"""Registered queries: sources, sinks and payload decoding (IO1-IO14)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators import features as FE
from aerolith.operators import model_store as MS
from aerolith.operators import quality as Q
from aerolith.operators import registry as R
from aerolith.operators.latest import upsert_newer
from aerolith.plans import oracle as O
from aerolith.plans.q_registry import HIST_SQL, STATUS_SQL
from aerolith.session import cut_lineage
from aerolith.sources import fixtures as FX
from aerolith.sources import io as IO
from aerolith.sources import manifest as M
from aerolith.sources import payloads as P

QUERIES, SQL = {}, {}


#: further measures of the payload fixtures, the same expressions in both engines
AIR = {"pm10": "pm10", "pm2_5": "pm2_5", "carbon_monoxide": "pm10 * 8", "nitrogen_dioxide": "pm2_5 / 2", "sulphur_dioxide": "pm2_5 / 4",
       "ozone": "100 - temperature", "us_aqi": "us_aqi"}
WEATHER = {"temperature_2m": "temperature", "relative_humidity_2m": "100 - temperature", "surface_pressure": "1000 + temperature / 2",
           "cloud_cover": "temperature * 2", "wind_speed_10m": "pm10 / 8", "wind_direction_10m": "pm2_5 + 1", "precipitation": "temperature / 16"}


def _hourly_payloads(spark, sf, measures):
    s = FX.series(spark, sf).selectExpr("city", "timestamp", *[f"{e} AS {c}" for c, e in measures.items()])
    return s.groupBy("city", F.to_date("timestamp").alias("day")).agg(P.encode_hourly(s, ["city"], "timestamp", list(measures)).alias("payload"))


def payload_arrays(spark, sf):
    """IO5: per entity-day columnar payloads with all seven measures, decoded back to rows."""
    return P.decode_hourly(_hourly_payloads(spark, sf, AIR), "payload", P.HOURLY_AIR_FIELDS, keep=["city"])


SQL["payload_arrays"] = O.with_views(["series"], 'SELECT city, "timestamp", ' + ", ".join(f"({e})::DOUBLE AS {c}" for c, e in AIR.items()) + " FROM series")


def payload_weather(spark, sf):
    """IO6: weather columnar payloads with provider names, all seven measures, decoded and renamed."""
    return P.decode_hourly(_hourly_payloads(spark, sf, WEATHER), "payload", list(P.HOURLY_WEATHER_RENAMES), P.HOURLY_WEATHER_RENAMES, keep=["city"])


SQL["payload_weather"] = O.with_views(["series"], 'SELECT city, "timestamp", ' + ", ".join(
    f"({e})::DOUBLE AS {P.HOURLY_WEATHER_RENAMES[c]}" for c, e in WEATHER.items()) + " FROM series")


def payload_nested(spark, sf):
    """IO7/IO8/IO15: nested weather and pollution payloads per observation, the weather one with name and coordinates from the entity
    dimension; empty pollution lists drop the row."""
    dim = IO.entity_dimension(spark).withColumnRenamed("city", "name")
    o = FX.scored(spark, sf).join(F.broadcast(dim), F.pmod("station_id", F.lit(dim_size())) == F.col("entity_no"))
    item = F.struct(F.struct(F.col("pm25_index").cast("int").alias("aqi")).alias("main"),
                    F.struct(F.col("pm2_5"), F.col("pm10")).alias("components"),
                    F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("dt"))
    pol = F.to_json(F.struct(F.when(F.col("obs_id") % 50 == 0, F.array_remove(F.array(item), item))
                             .otherwise(F.array(item)).alias("list")))
    wea = F.to_json(F.struct(
        "name", F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).alias("coord"),
        F.struct((F.col("station_id") % 101).cast("double").alias("all")).alias("clouds"),
        F.when(F.col("obs_id") % 3 != 0, F.lit(10000.0)).alias("visibility"), F.array(F.struct(F.col("city").alias("description"))).alias("weather"),
        F.struct(F.col("temperature").alias("temp"), F.lit(1013.0).alias("pressure"), F.lit(40.0).alias("humidity")).alias("main"),
        F.struct((F.col("pm2_5") / 8).alias("speed")).alias("wind")))
    docs = o.select("obs_id", pol.alias("pollution_json"), wea.alias("weather_json"))
    w = P.decode_weather(docs, "weather_json", keep=["obs_id"])
    p = P.decode_pollution(docs, "pollution_json", keep=["obs_id"]).select("obs_id", "aqi", "pm2_5", "pm10", "api_timestamp")
    return w.join(p, "obs_id")


def dim_size():
    return len(IO.ENTITY_COORDINATES)


DIM_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}', {lat}::DOUBLE, {lon}::DOUBLE)" for i, (c, lat, lon) in enumerate(IO.ENTITY_COORDINATES)) + ") t(entity_no, name, latitude, longitude)"
SQL["payload_nested"] = O.with_views(["scored"], f"""
SELECT obs_id, d.name AS city, d.latitude, d.longitude, (station_id % 101)::DOUBLE AS cloud_cover, CASE WHEN obs_id % 3 <> 0 THEN 10000.0::DOUBLE END AS visibility,
  1013.0::DOUBLE AS pressure, 40.0::DOUBLE AS humidity, pm2_5 / 8 AS wind_speed, s.city AS weather, temperature, CAST(pm25_index AS INTEGER) AS aqi, pm2_5, pm10,
  CAST(floor(epoch_us("timestamp") / 1000000) AS BIGINT) AS api_timestamp
FROM scored s JOIN dim d ON d.entity_no = station_id % {dim_size()} WHERE obs_id % 50 <> 0""", [("dim", DIM_SQL)])


def entity_locations(spark, sf):
    """IO15/DQ12: observations per entity of the dimension, with coordinates; entities without any are listed."""
    dim = IO.entity_dimension(spark)
    n = FX.obs(spark, sf).groupBy(F.pmod("station_id", F.lit(dim_size() + 2)).alias("entity_no")).agg(F.count(F.lit(1)).alias("rows"))
    return F.broadcast(dim).join(n, "entity_no", "left").select(
        "city", "latitude", "longitude", F.coalesce("rows", F.lit(0)).alias("rows"),
        (F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)).alias("in_range"))


SQL["entity_locations"] = O.with_views(["obs"], f"""
SELECT d.name AS city, d.latitude, d.longitude, count(o.obs_id) AS rows, true AS in_range
FROM dim d LEFT JOIN obs o ON o.station_id % {dim_size() + 2} = d.entity_no GROUP BY ALL""", [("dim", DIM_SQL)])

ROUNDTRIP_SCHEMA = T.StructType([
    T.StructField("obs_id", T.LongType()), T.StructField("city", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("pm2_5", T.DoubleType()),
    T.StructField("us_aqi", T.LongType()),
])


def source_roundtrip(spark, sf):
    """IO1/IO9/IO14: write scored rows as CSV with header (overwrite), read back with a declared schema."""
    path = IO.scratch_dir(spark, "csv-roundtrip")
    IO.write_table(FX.scored(spark, sf).select(*ROUNDTRIP_SCHEMA.fieldNames()), path, "csv", "overwrite")
    return IO.read_csv(spark, path, ROUNDTRIP_SCHEMA, strict=True)


SQL["source_roundtrip"] = O.with_views(["scored"], 'SELECT obs_id, city, "timestamp", pm2_5, us_aqi FROM scored')


def cached_read(spark, sf):
    """IO2: read-through parquet cache of the 3-hour bucket table."""
    path = IO.scratch_dir(spark, "cache")
    compute = lambda: FE.bucket_mean(FX.scored(spark, sf), "city", "timestamp", 3,
                                     ["pm2_5", "us_aqi"], digits=6)
    IO.cached_read(spark, path, compute)          # miss: computes and writes
    return IO.cached_read(spark, path, compute)   # hit: reads the parquet cache


SQL["cached_read"] = O.with_views(["scored"], """
SELECT city, time_bucket(INTERVAL 3 HOUR, "timestamp") AS "timestamp", round(avg(pm2_5), 6) AS pm2_5,
  round_even(avg(us_aqi), 0) AS us_aqi, count(*) AS n_obs FROM scored WHERE city IS NOT NULL GROUP BY ALL""")


def upsert_latest(spark, sf):
    """IO13: latest row per entity kept current by newest-wins upserts of a second batch."""
    s = FX.scored(spark, sf).select("city", "timestamp", "obs_id", "us_aqi")
    from aerolith.operators.latest import latest_per_key
    current = latest_per_key(s.filter(F.col("obs_id") % 2 == 0), "city", ["timestamp", "obs_id"])
    return upsert_newer(current, s.filter(F.col("obs_id") % 2 == 1), "city", ["timestamp", "obs_id"])


SQL["upsert_latest"] = O.with_views(["scored"], """
SELECT city, "timestamp", obs_id, us_aqi FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY "timestamp" DESC, obs_id DESC) AS rn
  FROM scored WHERE city IS NOT NULL) WHERE rn = 1""")


def keyed_insert(spark, sf):
    """IO12: three overlapping inserts (first deliveries, all rows, re-deliveries); a plain read has one row per key."""
    path = IO.scratch_dir(spark, "keyed")
    keys, order = ("city", "timestamp"), ("ingest_seq", "obs_id")
    rows = FX.dup(spark, sf)
    for part in (rows.where("ingest_seq = 0"), rows, rows.where("ingest_seq = 1")):
        IO.keyed_insert(part, path, keys, order)
    return IO.read_keyed(spark, path, rows.schema)


SQL["keyed_insert"] = O.with_views(["dup"], """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, "timestamp" ORDER BY ingest_seq DESC, obs_id DESC) AS rn
  FROM dup WHERE city IS NOT NULL AND "timestamp" IS NOT NULL) WHERE rn = 1""")

REGISTRY_DOC_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField("RMSE", T.DoubleType())])),
])


def json_roundtrip(spark, sf):
    """IO4/IO11: registry entries written as JSON documents (nested metrics) and read back strictly."""
    st = R.registry_status(R.champion_history(FX.runs(spark, sf)))
    docs = st.select(F.col("model").alias("model_name"), F.concat(F.lit("v"), F.col("version_no")).alias("version"),
                     "status", F.struct(F.col("rmse").alias("RMSE")).alias("metrics"))
    path = IO.scratch_dir(spark, "registry-json")
    IO.write_table(docs, path, "json", "overwrite")
    back = IO.read_json_documents(spark, path, REGISTRY_DOC_SCHEMA)
    return back.select("model_name", "version", "status", F.col("metrics.RMSE").alias("rmse"))


SQL["json_roundtrip"] = O.with_views(["runs"], """
SELECT model AS model_name, 'v' || CAST(version_no AS VARCHAR) AS version, status, rmse FROM st""",
                                     [("hist", HIST_SQL), ("st", STATUS_SQL)])

QUERIES.update({
    "entity_locations": entity_locations, "payload_arrays": payload_arrays, "payload_weather": payload_weather, "payload_nested": payload_nested,
    "source_roundtrip": source_roundtrip, "cached_read": cached_read, "upsert_latest": upsert_latest,
    "keyed_insert": keyed_insert, "json_roundtrip": json_roundtrip,
})


def fallback_read(spark, sf):
    """IO3: first available source wins (a missing local extract, then the shared table)."""
    src = IO.read_first_available(spark, [f"{sf}/events_local_extract.parquet", f"{sf}/events.parquet"],
                                  lambda p: spark.read.parquet(p))
    return src.groupBy(F.col("event_type").alias("city")).agg(F.count(F.lit(1)).alias("rows"))


SQL["fallback_read"] = "SELECT event_type AS city, count(*) AS rows FROM events GROUP BY 1"


def monitoring_runs(spark, sf):
    """MO11: two monitoring runs over one registry, the second after a rollback to version 1; each appended once to the history
    (IO10) and written as a nested summary (IO11), though both are delivered twice. The folder of history and summaries."""
    from aerolith.plans import q_monitoring as QM

    t = QM.split_table(spark, sf)
    base = IO.scratch_dir(spark, "monitoring")
    registry = QM.build_registry(spark, f"{base}/registry", t.filter(F.col("split") == "reference"))
    last = t.agg(F.max("timestamp")).first()[0]
    for run in (1, 2):
        if run == 2:
            MS.roll_back(spark, registry, QM.MODEL, 1)
        row = QM.monitor_row(t, MS.production(spark, registry, QM.MODEL)).select(
            F.lit(f"run-{run}").alias("run_id"), (F.lit(last).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(run))).alias("monitored_at"), "*")
        row = cut_lineage(row)
        for _ in range(2):  # a retry of the run adds nothing
            M.append(row, f"{base}/history", run=run)
        IO.write_table(monitoring_summary_rows(row), f"{base}/summary/run={run}", "json", "overwrite")
    return base, row.schema


PERFORMANCE = ["samples", "mae", "rmse", "r2", "registered_rmse", "rmse_change", "rmse_change_percentage", "threshold", "performance_status"]
NUMERIC_DRIFT = ["numeric_features", "drift_features", "moderate_drift_features", "drift_percentage", "mean_psi"]
CATEGORICAL_DRIFT = ["features_checked", "categorical_drift_features", "categorical_moderate_drift_features"]
NESTED = {"performance": PERFORMANCE, "numeric_drift": NUMERIC_DRIFT, "categorical_drift": CATEGORICAL_DRIFT}


def monitoring_summary_rows(row):
    """IO11: the nested summary of a monitoring row."""
    return row.select("run_id", "monitored_at", F.struct(F.col("model").alias("name"), F.col("model_version").alias("version")).alias("model"),
                      *[F.struct(*cols).alias(name) for name, cols in NESTED.items()], "overall_status")


def monitoring_history(spark, sf):
    """IO10/MO11: the history of both runs, each once, with time, model and version."""
    base, schema = monitoring_runs(spark, sf)
    return M.read(spark, f"{base}/history", schema)


def monitoring_summary(spark, sf):
    """IO11: the nested summaries of both runs, read back strictly and flattened."""
    base, schema = monitoring_runs(spark, sf)
    kind = {f.name: f.dataType for f in schema.fields}
    nested = T.StructType(
        [T.StructField("run_id", T.StringType()), T.StructField("monitored_at", T.TimestampNTZType()),
         T.StructField("model", T.StructType([T.StructField("name", T.StringType()), T.StructField("version", T.StringType())]))]
        + [T.StructField(n, T.StructType([T.StructField(c, kind[c]) for c in cols])) for n, cols in NESTED.items()] + [T.StructField("overall_status", T.StringType())])
    docs = IO.read_json_documents(spark, f"{base}/summary/*/", nested)
    return docs.select("run_id", "monitored_at", F.col("model.name").alias("model"), F.col("model.version").alias("model_version"),
                       *[F.col(f"{n}.{c}") for n, cols in NESTED.items() for c in cols], "overall_status")


def _history_sql():
    from aerolith.plans import q_monitoring as QM
    run = lambda n, version: (f"""SELECT 'run-{n}' AS run_id, (SELECT max("timestamp") FROM split_t) + INTERVAL {n} HOUR AS monitored_at, *, {QM._OVERALL_SQL}
      FROM ({QM._mon_sql(version)})""")  # noqa: E731
    return QM._with_split(run(1, "(SELECT version_no FROM prod)") + " UNION ALL " + run(2, 1), QM.MONITOR_VIEWS)


SQL["monitoring_history"] = SQL["monitoring_summary"] = _history_sql()
QUERIES.update({"fallback_read": fallback_read, "monitoring_history": monitoring_history, "monitoring_summary": monitoring_summary})
