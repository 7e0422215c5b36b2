"""Plan-shape regressions: the forecast job reads the raw observations only through its one materialised series."""

import contextlib
import io

import __spark_entry__ as entry
from conftest import SF_SMALL


def _formatted_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")          # includes the "Subqueries" section
    return buf.getvalue()


def test_forecast_reads_no_raw_scan_after_materialising_the_series(spark):
    plan = _formatted_plan(entry.queries()["forecast_recursive"](spark, SF_SMALL))
    assert "Subqueries" in plan                     # the model coefficients are a scalar subquery
    assert "Scan parquet" not in plan               # main plan and subqueries read the checkpoint only


def test_band_distribution_has_no_join_and_one_scan(spark):
    df = entry.queries()["category_distribution"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()     # no subqueries in this query
    assert plan.count("FileScan parquet") == 1
    assert "Join" not in plan and "Subqueries" not in _formatted_plan(df)


def test_asof_probe_side_has_a_single_lookup_join(spark):
    df = entry.queries()["asof_lookup"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    # chunks x their ends (small), probes x carry; no join back on probe id, none on the entity alone
    assert len(joins) == 2, joins
