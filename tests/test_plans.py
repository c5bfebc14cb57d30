import re

import __spark_entry__ as E
from hourglass.plans import catalog

SF = "/root/testdata/sf0.01"


def _formatted(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + df._sc._jvm.java.lang.String.valueOf(
        df._jdf.queryExecution().toString())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_registry_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60 and len(sql) >= 50


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"ts_hour", "series", "value", "method"}
    assert df.count() >= 0


def test_scan_pruning_and_pushdown(spark):
    plan = _plan(E.queries()["clean_table"](spark, SF))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))
    assert schemas and all("l_returnflag" not in s and "l_shipdate" not in s for s in schemas)
    ev = spark.read.parquet(f"{SF}/events.parquet").where("value > 300").select("event_id")
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,300.0)]" in _plan(ev)


def _window_partition_specs(plan: str):
    # every physical Window node prints "Window [exprs], [partition spec], [order spec]"
    specs = []
    for line in plan.splitlines():
        m = re.search(r"\bWindow \[(.*)\], \[([^\[\]]*)\], \[", line)
        if m:
            specs.append(m.group(2))
    return specs


def test_feature_windows_are_partitioned_by_series_and_bucket(spark):
    for key in ("lag_features", "rolling_slope", "ema_features", "supplier_window_features", "seasonal_decompose"):
        plan = _plan(E.queries()[key](spark, SF))
        specs = _window_partition_specs(plan)
        assert specs, key
        for s in specs:
            assert s.strip(), f"{key}: window without partition keys"
    plan = _plan(E.queries()["lag_features"](spark, SF))
    assert any("__bk" in s for s in _window_partition_specs(plan))


def test_key_names_and_sql_text():
    # the package's own keys; op<N>_ and pipeline are reserved for the optional subpackage
    E.queries()
    qs, sql = catalog.QUERIES, catalog.ORACLE
    for k in qs:
        assert "pipeline" not in k and not re.match(r"op\d+_", k), k
    for k, text in sql.items():
        assert text.strip().upper().startswith(("SELECT", "WITH")), k
        assert "LIMIT" not in text.upper() or k == "top_correlations", k  # no row caps except the top-k feature
