"""Structured Streaming operators (SM1-SM5).

Every sink is a published table (``sources.manifest``): a micro-batch is written by Spark, then published once under its
batch number, so a retried batch changes nothing and a reader never sees half of one.

* SM1 keep-first and keep-last de-dup, SM3 latest row per entity: a micro-batch is reduced per key and
  appended; every ``COMPACT_EVERY`` batches the live folders are reduced to one, so a read costs the keys, not
  the batches ever written;
* SM2 tumbling means: sums and counts per window and batch, added on read, so open windows and late rows are
  whole;
* SM4 rejects: one write per batch, by reason; rejected rows stay in a table of their own, and the counts of the
  query's progress are stored beside it;
* SM5 per-entity lags: rows, lags and the last values of each day are stored by day. A batch rewrites the
  days it touches and those whose carried-in values reach into them, and no other.

Bounded state in the stream itself, where the whole history is not wanted: ``dedup_keep_first`` (watermark) and
``windowed_means`` (closed windows only).

Every query uses ``trigger(availableNow=True)`` and a checkpoint location on
shared storage, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions.aqi import with_aqi
from aerolith.operators.latest import latest_per_key
from aerolith.operators.quality import parse_timestamp
from aerolith.sources import manifest as M
from aerolith.sources.io import scratch_dir

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
WATERMARK_DELAY = "6 hours"
#: live folders at which a table of batches is compacted
COMPACT_EVERY = 8


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """Observation stream from the ``events`` parquet file(s) (event time cast to ``timestamp``)."""
    ev = (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events*.parquet")
          .option("maxFilesPerTrigger", files_per_trigger).parquet(sf_dir))
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        F.col("event_id").alias("obs_id"), F.col("event_type").alias("city"), F.col("user_id").alias("station_id"),
        F.col("ts").alias("timestamp"), F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("pm2_5"), (F.lit(2) * F.col("value") + k / F.lit(10)).alias("pm10"),
        (F.lit(10) + F.lit(0.3) * k).alias("temperature"))


def run_available(writer):
    """Start a writer with ``availableNow`` and wait for it to drain the source; the query, for its progress."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()  # raises what ended the query
    return q


def dedup_keep_first(stream: DataFrame, keys=("city", "timestamp")) -> DataFrame:
    """SM1: first arrival per key within the watermark."""
    return stream.withWatermark("event_time", WATERMARK_DELAY).dropDuplicatesWithinWatermark(list(keys))


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def _order(order, arrival: bool) -> list[str]:
    return ["batch_id", *order] if arrival else [*order, "batch_id"]


def merge_batches(spark: SparkSession, path: str, schema: T.StructType, keys, order, arrival: bool = False, newest: bool = True) -> DataFrame:
    """One row per key of a table written by ``append_batches``.

    Newest (or oldest) by ``order``, the batch breaking ties: a late, older row never replaces a newer one. With
    ``arrival`` the batch counts first (keep the last, or first, arrival).
    """
    rows = M.read(spark, path, _with_batch(schema))
    return latest_per_key(rows, list(keys), _order(order, arrival), newest).drop("batch_id")


def append_batches(stream: DataFrame, path: str, checkpoint: str, keys, order, arrival: bool = False, newest: bool = True):
    """SM1, SM3: per micro-batch one row per key, published once; live folders are compacted to one row per key."""
    keys, schema = list(keys), _with_batch(stream.schema)
    by = _order(order, arrival)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        reduced = latest_per_key(batch, keys, list(order), newest).withColumn("batch_id", F.lit(batch_id).cast("long"))
        state = M.append_batch(reduced, path, batch_id)
        if len(state.folders) >= COMPACT_EVERY:
            M.compact(spark, path, schema, lambda rows: latest_per_key(rows, keys, by, newest))

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)


def windowed_means(stream: DataFrame, key: str = "city", hours: int = 3, columns=("pm2_5", "us_aqi")) -> DataFrame:
    """SM2 with bounded state: tumbling ``hours`` means per entity, emitted when the watermark closes the window."""
    aggs = [F.bround(F.avg(c), 0).alias(c) if c == "us_aqi" else F.round(F.avg(c), 6).alias(c) for c in columns]
    return (stream.withWatermark("event_time", WATERMARK_DELAY)
            .groupBy(F.col(key), F.window("event_time", f"{hours} hours").alias("w"))
            .agg(*aggs, F.count(F.lit(1)).alias("n_obs"))
            .select(key, F.col("w.start").cast("timestamp_ntz").alias("timestamp"), *columns, "n_obs"))


def partial_schema(key: str, columns) -> T.StructType:
    return T.StructType([T.StructField(key, T.StringType()), T.StructField("timestamp", T.TimestampNTZType())]
                        + [T.StructField(f"{c}_{p}", t) for c in columns for p, t in (("sum", T.DoubleType()), ("n", T.LongType()))]
                        + [T.StructField("n_obs", T.LongType())])


def _added(rows: DataFrame, key: str, columns) -> DataFrame:
    return rows.groupBy(key, "timestamp").agg(*[F.sum(f"{c}_{p}").alias(f"{c}_{p}") for c in columns for p in ("sum", "n")], F.sum("n_obs").alias("n_obs"))


def append_partials(stream: DataFrame, path: str, checkpoint: str, key: str = "city", hours: int = 3, columns=("pm2_5", "us_aqi")):
    """SM2: sums and counts per (entity, window) of each micro-batch; live folders are added up to one."""
    columns = list(columns)

    def sink(batch: DataFrame, batch_id: int) -> None:
        start = F.window(F.col("timestamp"), f"{hours} hours")["start"].cast("timestamp_ntz")
        parts = batch.where(F.col("timestamp").isNotNull()).groupBy(F.col(key), start.alias("timestamp")).agg(
            *[a for c in columns for a in (F.sum(F.col(c).cast("double")).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))], F.count(F.lit(1)).alias("n_obs"))
        state = M.append_batch(parts, path, batch_id)
        if len(state.folders) >= COMPACT_EVERY:
            M.compact(batch.sparkSession, path, partial_schema(key, columns), lambda rows: _added(rows, key, columns))

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)


def means_on_read(spark: SparkSession, path: str, key: str = "city", columns=("pm2_5", "us_aqi")) -> DataFrame:
    """SM2: means of all windows, open ones and those with late rows included."""
    total = _added(M.read(spark, path, partial_schema(key, columns)), key, columns)
    mean = lambda c: F.try_divide(F.col(f"{c}_sum"), F.col(f"{c}_n"))
    return total.select(key, "timestamp", *[F.bround(mean(c), 0).alias(c) if c == "us_aqi" else F.round(mean(c), 6).alias(c) for c in columns], "n_obs")


VALID = "valid"


def reject_reason() -> Column:
    """SM4: why a row is rejected, None if it is not; the time is looked at first."""
    return (F.when(F.col("raw_timestamp").isNull(), F.lit("missing_timestamp")).when(F.col("timestamp").isNull(), F.lit("invalid_timestamp"))
            .when(F.col("city").isNull(), F.lit("missing_key")))


def append_checked(stream: DataFrame, path: str, checkpoint: str, name: str = "ingest_quality"):
    """SM4: parse the (string) time; valid and rejected rows (with the reason and the time as it came) in one write per batch."""
    parsed = stream.withColumn("timestamp", parse_timestamp("raw_timestamp"))
    checked = parsed.withColumn("reason", F.coalesce(reject_reason(), F.lit(VALID)))
    reasons = ("missing_timestamp", "invalid_timestamp", "missing_key", VALID)
    observed = checked.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("reason") == r).alias(r) for r in reasons])

    def sink(batch: DataFrame, batch_id: int) -> None:
        M.append_batch(batch, path, batch_id)

    return observed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)


def observed_counts(query, name: str = "ingest_quality") -> list[tuple[int, str, int]]:
    """SM4: (batch, count, value) of ``observe`` and of the rows that a watermark dropped, from the query's progress."""
    out = []
    for p in query.recentProgress:
        row = (p.get("observedMetrics") if isinstance(p, dict) else p.observedMetrics or {}).get(name)
        if row is not None:
            values = row if isinstance(row, dict) else row.asDict()
            out += [(int(p["batchId"]), k, int(v)) for k, v in values.items()]
            late = sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in p["stateOperators"]) if p["stateOperators"] else 0
            out.append((int(p["batchId"]), "dropped_by_watermark", late))
    return out


LAGS = (1, 3, 24)


def lag_schemas(key: str, value: str) -> dict[str, T.StructType]:
    base = [T.StructField("obs_id", T.LongType()), T.StructField(key, T.StringType()), T.StructField("timestamp", T.TimestampNTZType())]
    held = T.StructType([T.StructField("v", T.DoubleType())])  # a struct, so that NULL values keep their place
    return {"rows": T.StructType([*base, T.StructField(value, T.DoubleType())]),
            "lags": T.StructType([*base, *[T.StructField(f"lag_{k}", T.DoubleType()) for k in LAGS]]),
            "tails": T.StructType([T.StructField(key, T.StringType()), T.StructField("day", T.StringType()),
                                   T.StructField("n", T.LongType()), T.StructField("tail", T.ArrayType(held))])}


def _day() -> Column:
    """The day of a row as text; rows without a time stand last."""
    return M.bucket_of_day()


def days_to_rewrite(tails: DataFrame, new: DataFrame, key: str) -> list[str]:
    """Days whose lags a batch can change: its own, and later ones with fewer than ``max(LAGS)`` rows of an entity in between.

    ``tails`` (key, day, n) is the state before, ``new`` (key, day, n) counts the batch's rows.
    """
    both = (tails.select(key, "day", "n", F.lit(False).alias("touched")).unionByName(new.select(key, "day", "n", F.lit(True).alias("touched")))
            .groupBy(key, "day").agg(F.sum("n").alias("n"), F.max("touched").alias("touched")))
    before = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    rows = F.coalesce(F.sum("n").over(before), F.lit(0))
    end = F.when(F.col("touched"), rows + F.col("n"))
    placed = both.select(key, "day", "touched", rows.alias("rows"), end.alias("end"))
    gap = F.col("rows") - F.max("end").over(before)  # rows between the last touched day and this one
    hit = placed.select("day", (F.col("touched") | (gap < max(LAGS))).alias("hit"))
    return sorted(r["day"] for r in hit.where("hit").select("day").distinct().collect())  # as many as days


def update_lags(spark: SparkSession, path: str, rows: DataFrame, batch: int, key: str = "city", value: str = "pm2_5") -> list[str]:
    """SM5: add a batch's rows and rewrite the lags of the days it can change; those days. A repeat of the batch changes nothing.

    Tables ``rows``, ``lags`` and ``tails`` (last values and number of rows per entity and day) are published together.
    """
    schemas = lag_schemas(key, value)
    base = M.snapshot(spark, path)
    if any(f.get("done", -1) >= batch for f in base.folders):
        return []
    fresh = rows.select("obs_id", key, "timestamp", F.col(value).cast("double").alias(value))
    counts = fresh.groupBy(key, _day().alias("day")).agg(F.count(F.lit(1)).alias("n"))
    tails = M.read(spark, path, schemas["tails"], base, kind="tails")
    days = days_to_rewrite(tails, counts, key)
    old = [f"{path}/{f['folder']}" for f in base.tagged(kind="rows") if f["bucket"] in days]
    both = fresh.unionByName(spark.read.schema(schemas["rows"]).parquet(*old)) if old else fresh
    # the rows of the days concerned, once; everything below reads them from there
    folder = M.write_folder(both.withColumn("_day", _day()).repartition("_day"), path, "rows", "_day")
    at = M._bucketed(spark, path, folder, "_day")
    state = [f for f in base.folders if f.get("kind") != "done" and not (f["kind"] == "rows" and f["bucket"] in at)]
    state += [{"folder": f, "bucket": b, "kind": "rows"} for b, f in sorted(at.items())]
    part = spark.read.schema(schemas["rows"]).parquet(*[f"{path}/{f}" for f in at.values()])
    lags, new_tails = _lags(part, tails.where(~F.col("day").isin(days)), key, value)
    for kind, df in (("lags", lags), ("tails", new_tails)):
        state = M.replace_buckets(df, path, M.Snapshot(base.version, state), "_day", kind=kind)
    state.append({"folder": "", "kind": "done", "done": batch})
    M.commit(spark, path, base, state)
    return days


def _lags(part: DataFrame, others: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Lags of the rows of some days and the days' tails, each with ``_day``; ``others``: tails of all other days.

    Windows run per (entity, day). The values carried into a day are the last ``max(LAGS)`` of the days
    before it, from the table of tails; as a day has a row at least, so many days are enough.
    """
    most = max(LAGS)
    src = part.select("obs_id", F.col(key), "timestamp", F.struct(F.col(value).alias("v")).alias("_v"), _day().alias("_day"),
                      F.date_trunc("hour", "timestamp").alias("_chunk"))
    hours = Window.partitionBy(key, "_day", "_chunk")
    order = hours.orderBy("timestamp", F.col("obs_id").asc_nulls_last(), "_v")
    placed = src.select("*", F.row_number().over(order).alias("_i"), F.count(F.lit(1)).over(hours).alias("_n"),
                        *[F.lag("_v", k).over(order).alias(f"_lag_{k}") for k in LAGS])
    # last values of each hour, then of each day: a day of a hot entity is never one window
    hourly = placed.groupBy(key, "_day", "_chunk").agg(
        F.count(F.lit(1)).alias("n"), F.transform(F.sort_array(F.collect_list(F.when(F.col("_i") > F.col("_n") - most, F.struct("_i", "_v")))), lambda x: x["_v"]).alias("tail"))
    merged = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce(F.unix_micros("_chunk"), F.lit(2**62)).alias("c"), "tail"))), lambda x: x["tail"]))
    daily = hourly.groupBy(key, F.col("_day").alias("day")).agg(F.sum("n").alias("n"), F.slice(F.concat(F.array_repeat(F.lit(None).cast("struct<v:double>"), most), merged), -most, most).alias("_t"))
    daily = daily.select(key, "day", "n", F.filter("_t", lambda x: x.isNotNull()).alias("tail"))
    # carried into each hour: of the hours before it on that day, then of the days before
    in_day = Window.partitionBy(key, "_day").orderBy(F.col("_chunk").asc_nulls_last()).rowsBetween(-most, -1)
    by_hour = hourly.select(F.col(key).alias("_key"), F.col("_day").alias("_of_day"), F.col("_chunk").alias("_of"),
                            F.reverse(F.flatten(F.collect_list("tail").over(in_day))).alias("_hours"))
    in_life = Window.partitionBy(key).orderBy("day").rowsBetween(-most, -1)
    by_day = (others.select(key, "day", "tail", F.lit(False).alias("_new")).unionByName(daily.select(key, "day", "tail", F.lit(True).alias("_new")))
              .select(F.col(key).alias("_dkey"), F.col("day").alias("_dday"), "_new", F.reverse(F.flatten(F.collect_list("tail").over(in_life))).alias("_days")).where("_new").drop("_new"))
    carry = by_hour.join(by_day, F.col("_key").eqNullSafe(F.col("_dkey")) & (F.col("_of_day") == F.col("_dday"))).select(
        "_key", "_of_day", "_of", F.concat("_hours", "_days").alias("_carry"))  # newest first
    j = placed.join(carry, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_day") == F.col("_of_day")) & F.col("_chunk").eqNullSafe(F.col("_of")), "left")
    lags = [F.when(F.col("_i") > k, F.col(f"_lag_{k}")["v"]).otherwise(F.get("_carry", F.lit(k) - F.col("_i"))["v"]).alias(f"lag_{k}") for k in LAGS]
    return j.select("obs_id", key, "timestamp", *lags, "_day"), daily.withColumn("_day", F.col("day"))


def append_lags(stream: DataFrame, path: str, checkpoint: str, key: str = "city", value: str = "pm2_5", seen: list | None = None):
    """SM5: keep the lags of all rows that arrived, in whatever order; ``seen`` gets the days that each batch rewrote."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        days = update_lags(batch.sparkSession, path, batch, batch_id, key, value)
        if seen is not None:
            seen.append(days)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)


def read_lags(spark: SparkSession, path: str, key: str = "city", value: str = "pm2_5") -> DataFrame:
    """SM5: the stored lags, a plain read."""
    return M.read(spark, path, lag_schemas(key, value)["lags"], kind="lags")


def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_aqi(event_stream(spark, sf_dir))


def sink_dirs(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_dir(spark, f"stream-{name}")
    return f"{base}/table", f"{base}/_checkpoint"
