"""Streamed lags, means and de-duplication over files that arrive out of order."""
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from aerolith.plans import q_streaming as Q
from aerolith.sources import manifest as M
from aerolith.streaming import ingest as S

SCHEMA = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()),
                    ("value", pa.float64()), ("props", pa.string())])


def events(n=120, step=25):
    return pd.DataFrame({"event_id": range(n), "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta([i // 2 * step for i in range(n)], "min"),
                         "user_id": 1, "event_type": ["a" if i % 3 else "b" for i in range(n)],
                         "value": [None if i == 30 else float(i * i) for i in range(n)], "props": '{"k": 1}'})


def write(folder, *files):
    for i, rows in enumerate(files):
        path = folder / f"events_{i}.parquet"
        pq.write_table(pa.Table.from_pandas(rows, SCHEMA, preserve_index=False), path)
        os.utime(path, (1_700_000_000 + 100 * i,) * 2)


def want_lags(ev):
    want = {}
    for _, g in ev.groupby("event_type"):
        g = g.sort_values(["ts", "event_id"])
        v = [None if pd.isna(x) else x for x in g.value]
        for i, k in enumerate(g.event_id):
            want[k] = tuple(v[i - lag] if i >= lag else None for lag in (1, 3, 24))
    return want


def test_late_file(spark, tmp_path):
    ev = events()
    late = (ev.event_id % 4 == 1) | (ev.event_id < 20)
    write(tmp_path, ev[~late], ev[late])   # the second file has earlier and interleaved rows
    got = {r["obs_id"]: (r["lag_1"], r["lag_3"], r["lag_24"]) for r in Q.stream_state_lag(spark, str(tmp_path)).collect()}
    assert got == want_lags(ev)


def test_only_touched_days_are_rewritten(spark, tmp_path):
    """Some 90 rows a day: a late row of a day changes that day and the next, and their folders alone."""
    ev = events(n=900, step=32)   # 10 days
    ev["event_type"] = "a"
    day = ev.ts.dt.strftime("%Y-%m-%d")
    late = (day == "2024-01-05") & (ev.event_id % 2 == 0)
    write(tmp_path, ev[~late], ev[late])
    path, ckpt = S.sink_dirs(spark, "lags")
    seen, states = [], []
    stream = S.event_stream(spark, str(tmp_path)).select("obs_id", "city", "timestamp", "pm2_5")

    def sink(batch, batch_id):
        seen.append(S.update_lags(spark, path, batch, batch_id))
        states.append(M.snapshot(spark, path))

    S.run_available(stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt))
    assert seen[1] == ["2024-01-05", "2024-01-06"] and len(seen[0]) == 10
    folders = [{(f["kind"], f["bucket"]): f["folder"] for f in s.folders if f["kind"] != "done"} for s in states]
    changed = {k[1] for k in folders[1] if folders[0].get(k) != folders[1][k]}
    assert changed == set(seen[1])
    got = {r["obs_id"]: (r["lag_1"], r["lag_3"], r["lag_24"]) for r in S.read_lags(spark, path).collect()}
    assert got == want_lags(ev)
    batch = spark.createDataFrame([(5, "a", ev.ts[5].to_pydatetime(), 1.0)], "obs_id long, city string, timestamp timestamp_ntz, pm2_5 double")
    assert S.update_lags(spark, path, batch, 1) == []   # a repeat of a batch changes nothing


def test_means_of_open_and_late_windows(spark, tmp_path):
    ev = events()
    late = ev.event_id % 4 == 1
    write(tmp_path, ev[~late], ev[late])
    got = {(r["city"], r["timestamp"]): (r["pm2_5"], r["n_obs"]) for r in Q.stream_bucket_3h(spark, str(tmp_path)).collect()}
    g = ev.assign(w=ev.ts.dt.floor("3h")).groupby(["event_type", "w"])
    want = {(c, w.to_pydatetime()): (round(x.value.mean(), 6), len(x)) for (c, w), x in g}
    assert got == {k: (pytest.approx(v), n) for k, (v, n) in want.items()}


def test_first_and_last_delivery_differ(spark, tmp_path):
    write(tmp_path, events(40))
    first = {r["obs_id"]: r["ingest_seq"] for r in Q.stream_dedup_first(spark, str(tmp_path)).collect()}
    last = {r["obs_id"]: r["ingest_seq"] for r in Q.stream_dedup_last(spark, str(tmp_path)).collect()}
    assert set(first.values()) == {0} and {k for k, v in last.items() if v == 1} == {0, 10, 20, 30}


def test_latest_view_is_compacted(spark, tmp_path):
    ev = events(120)
    write(tmp_path, *[ev[ev.event_id % 12 == i] for i in range(12)])
    path, ckpt = S.sink_dirs(spark, "latest")
    stream = S.scored_stream(spark, str(tmp_path)).select("city", "timestamp", "obs_id", "us_aqi")
    S.run_available(S.append_batches(stream, path, ckpt, ["city"], ["timestamp", "obs_id"]))
    state = M.snapshot(spark, path)
    assert len(state.folders) < S.COMPACT_EVERY and all(M.has_batch(state, b) for b in range(12))
    rows = M.read(spark, path, "city string, timestamp timestamp_ntz, obs_id long, us_aqi long").count()
    assert rows <= 2 * len(state.folders)
    got = {r["city"]: r["obs_id"] for r in S.merge_batches(spark, path, stream.schema, ["city"], ["timestamp", "obs_id"]).collect()}
    assert got == {"a": 119, "b": 117}


def test_rejects_add_up(spark, tmp_path):
    write(tmp_path, events(300))
    valid, dead = Q.stream_rejects(spark, str(tmp_path)).count(), Q.stream_dead_letters(spark, str(tmp_path)).collect()
    counts = {r["count"]: r["value"] for r in Q.stream_quality_counts(spark, str(tmp_path)).collect()}
    assert valid + len(dead) == 300 == counts["rows"] and counts["valid"] == valid
    assert {r["reason"] for r in dead} == {"invalid_timestamp", "missing_timestamp", "missing_key"}
    assert {r["obs_id"] for r in dead if r["reason"] == "invalid_timestamp"} == {0, 97, 194, 291}
    assert {r["raw_timestamp"] for r in dead if r["reason"] == "invalid_timestamp"} == {"not-a-time"}
