"""PR5 / DQ2 strict loading: any missing or unparsable value fails; clean inputs pass with contract types."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL


def test_strict_cast_rejects_and_accepts(spark):
    from aerolith.operators.quality import DataQualityError, strict_cast
    from aerolith.sources import fixtures as FX

    raw = FX.obs_raw(spark, SF_SMALL)          # pm2_5 holds 'n/a' where obs_id % 89 == 0
    bad_rows = raw.filter(F.col("obs_id") % 89 == 0).count()
    schema = T.StructType([T.StructField("pm2_5", T.DoubleType()), T.StructField("station_id", T.LongType())])
    with pytest.raises(DataQualityError, match=rf"'pm2_5': {bad_rows}\b"):
        strict_cast(raw, schema)
    ok = strict_cast(raw.filter(F.col("obs_id") % 89 != 0), schema)
    assert [f.dataType for f in ok.schema.fields] == [T.DoubleType(), T.LongType()]
    assert ok.count() == raw.count() - bad_rows
    one = spark.createDataFrame([("3.7", "x")], "n string, s string")
    row = strict_cast(one, T.StructType([T.StructField("N", T.LongType()), T.StructField("s", T.StringType())])).first()
    assert row["N"] == 3 and row["s"] == "x"     # case-insensitive lookup, truncation toward zero
    with pytest.raises(DataQualityError, match="missing required columns"):
        strict_cast(one, T.StructType([T.StructField("absent", T.DoubleType())]))


def test_require_valid_timestamps(spark):
    from aerolith.operators.quality import DataQualityError, require_valid_timestamps
    from aerolith.sources import fixtures as FX

    raw = FX.obs_raw(spark, SF_SMALL)          # 'not-a-time' where obs_id % 97 == 0
    with pytest.raises(DataQualityError, match="invalid timestamp"):
        require_valid_timestamps(raw)
    ok = require_valid_timestamps(raw.filter(F.col("obs_id") % 97 != 0))
    assert dict(ok.dtypes)["timestamp"] == "timestamp_ntz"


def test_validate_contract(spark):
    from aerolith.operators.features import HISTORY_FEATURES, drop_incomplete
    from aerolith.operators.quality import DataQualityError, validate_contract
    from aerolith.sources import fixtures as FX

    feats = FX.feats(spark, SF_SMALL)
    required = ["city", "timestamp", "us_aqi", *HISTORY_FEATURES, "target_aqi"]
    with pytest.raises(DataQualityError, match="aqi_lag_24"):
        validate_contract(feats, required)
    clean = drop_incomplete(feats)
    assert validate_contract(clean, required) is clean
    with pytest.raises(DataQualityError, match="zero rows"):
        validate_contract(clean.limit(0), required)
    with pytest.raises(DataQualityError, match="missing required columns"):
        validate_contract(clean, required + ["absent"])
