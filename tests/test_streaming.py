import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from hourglass.streaming import jobs
from hourglass.streaming import messages as M

MESSAGES = [
    '{"CO": 0.4, "NOx": 5.0, "Target": NaN, "timestamp": "2024-01-01T00:00:00"}',  # a: scaled
    '{"CO": 2.6, "NOx": 166.0, "NO2": 113.0, "Benzene": 11.9, "timestamp": "2024-01-01T01:00:00"}',  # b
    '{"CO": 12.5, "Benzene": 9.0, "NOx": 80.0, "NO2": 50.0, "NMHC": 150.0, "Target": NaN}',  # c
    '{"CO": 1.0, "NOx": 20.0, "NO2": 30.0, "Benzene": 2.0, "hour": 5, "day": 2, "month": 3, "season": 2}',  # d
    '{"test": "in-container-produce"}',  # e: foreign
    'not json at all',  # f: undecodable
]


def _src(spark, tmp):
    d = os.path.join(tmp, "in")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        for i, m in enumerate(MESSAGES):
            f.write(json.dumps({"offset": i, "value": m}) + "\n")
    return d


def test_decode_variants(spark):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(MESSAGES)], "offset int, value string")
    out = {r.offset: r for r in M.decode(df, "value").collect()}
    assert out[0].Target is None and out[0].CO == 0.4 and out[0].raw is None  # bare NaN -> NULL
    assert out[3].season == 2 and out[2].NMHC == 150.0
    assert out[4].raw is None and out[4].CO is None  # foreign but valid JSON
    assert out[5].raw == "not json at all"


def test_ingest_is_exactly_once(spark):
    tmp = tempfile.mkdtemp(dir="/tmp")
    src = _src(spark, tmp)
    stream = spark.readStream.schema("offset int, value string").json(src)
    sink, ckpt = os.path.join(tmp, "out"), os.path.join(tmp, "ckpt")
    q = jobs.ingest(stream, "value", sink, ckpt)
    jobs.run_available(q)
    prog = q.lastProgress
    got = spark.read.parquet(sink)
    assert got.count() == 6 and got.where(F.col("raw").isNotNull()).count() == 1
    assert prog["observedMetrics"]["ingest"]["failed"] == 1
    q2 = jobs.ingest(spark.readStream.schema("offset int, value string").json(src), "value", sink, ckpt)
    jobs.run_available(q2)
    assert spark.read.parquet(sink).count() == 6  # restart from the checkpoint adds nothing


def test_alerts_and_drift(spark):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(MESSAGES)], "offset int, value string")
    d = M.decode(df, "value").withColumn("CO(GT)", F.lit(None).cast("string"))
    alerts = [r.offset for r in jobs.threshold_alerts(d).collect()]
    assert alerts == [2]
    st = {"CO": (2.0, 1.0), "NOx": (50.0, 0.0), "Target": (1.0, 1.0)}
    z = {r.offset: (r.max_abs_z, r.drift) for r in M.drift_columns(d, st).collect()}
    assert z[2] == (10.5, True) and z[0][1] is False and z[5] == (None, False)


def test_hourly_stream_matches_batch_up_to_watermark(spark):
    import datetime as dt
    tmp = tempfile.mkdtemp(dir="/tmp")
    base = dt.datetime(2024, 1, 1)
    rows = [(f"s{i % 2}", base + dt.timedelta(minutes=17 * i), float(i)) for i in range(200)]
    src = os.path.join(tmp, "in")
    for part in range(4):  # files arrive in time order, as a stream delivers them
        chunk = rows[part * 50:(part + 1) * 50]
        spark.createDataFrame(chunk, "s string, ts timestamp_ntz, v double").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema("s string, ts timestamp_ntz, v double").option("maxFilesPerTrigger", 1).parquet(src)
    out = jobs.hourly_stream(stream, ["s"], "ts", ["v"], "1 hour")
    sink = os.path.join(tmp, "out")
    q = (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", os.path.join(tmp, "c"))
         .outputMode("append").trigger(availableNow=True).start())
    jobs.run_available(q)
    got = {(r.s, r.ts_hour): r.v_mean for r in spark.read.parquet(sink).collect()}
    batch = spark.createDataFrame(rows, "s string, ts timestamp_ntz, v double").groupBy(
        "s", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).agg(F.avg("v").alias("m"))
    exp = {(r.s, r.h): r.m for r in batch.collect()}
    assert got and all(exp[k] == v for k, v in got.items())
    assert len(got) >= len(exp) - 4


def test_kafka_builders(spark):
    r = jobs.kafka_source(spark, "broker:9092", "sensors", group="g1", max_offsets=100)
    payload = M.payload(spark.createDataFrame([("sensor_1", 1.0, None)], "k string, CO double, NOx double"), "k", ["CO", "NOx"])
    assert payload.collect()[0].value == '{"CO":1.0}'


def test_feature_stream_matches_batch(spark):
    import datetime as dt

    import numpy as np

    from hourglass.operators import ema, windows
    from hourglass.streaming.features import feature_names, feature_stream

    tmp = tempfile.mkdtemp(dir="/tmp")
    base = dt.datetime(2024, 1, 1)
    rng = np.random.default_rng(2)
    rows = [(f"s{i % 2}", base + dt.timedelta(hours=i // 2), float(rng.normal())) for i in range(240)]
    src = os.path.join(tmp, "in")
    for part in range(4):
        spark.createDataFrame(rows[part * 60:(part + 1) * 60], "s string, ts timestamp_ntz, v double") \
            .coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema("s string, ts timestamp_ntz, v double").option("maxFilesPerTrigger", 1).parquet(src)
    sink = os.path.join(tmp, "out")
    q = feature_stream(stream, "s", "ts", "v", sink, os.path.join(tmp, "c"), bucket_rows=40)
    jobs.run_available(q)
    got = spark.read.parquet(sink).toPandas().sort_values(["s", "ts"]).reset_index(drop=True)
    b = spark.createDataFrame(rows, "s string, ts timestamp_ntz, v double")
    b = b.withColumn("idx", F.row_number().over(__import__("pyspark.sql").sql.Window.partitionBy("s").orderBy("ts")) - 1)
    b = windows.window_features(b, ["s"], "idx", ["v"], lags=(1, 2, 3, 24), roll_windows=(3, 6, 12, 24))
    b = ema.ema_features(b, ["s"], "idx", ["v"], (3, 6, 12, 24))
    exp = b.toPandas().sort_values(["s", "ts"]).reset_index(drop=True)
    assert len(got) == len(exp) == 240 and not got["late"].any()
    for c in feature_names("v", (1, 2, 3, 24), (3, 6, 12, 24), (3, 6, 12, 24)):
        np.testing.assert_allclose(got[c].astype(float), exp[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=c)


def test_feature_stream_does_not_depend_on_the_split(spark):
    import datetime as dt

    from hourglass.streaming.features import feature_stream

    base = dt.datetime(2024, 1, 1)
    rows = [("a", base + dt.timedelta(hours=i // 3), i, float(i * i % 7)) for i in range(20)]  # three rows share each hour
    late = ("a", base, -1, 1.0)
    ddl = "s string, ts timestamp_ntz, id long, v double"

    def run(parts):
        tmp = tempfile.mkdtemp(dir="/tmp")
        src = os.path.join(tmp, "in")
        for part in parts:
            spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(src)
            time.sleep(1.1)
        stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(src)
        q = feature_stream(stream, "s", "ts", "v", os.path.join(tmp, "out"), os.path.join(tmp, "c"), tie="id")
        jobs.run_available(q)
        return spark.read.parquet(os.path.join(tmp, "out")).drop("batch").orderBy("id").toPandas()

    one, two = run([rows]), run([rows[:10], rows[10:], [late]])
    assert len(one) == 20 and len(two) == 21 and two["late"].tolist() == [True] + [False] * 20
    kept = two[~two["late"]].reset_index(drop=True)
    for c in one.columns:
        if one[c].dtype == float:
            assert (one[c].isna() == kept[c].isna()).all() and ((one[c] - kept[c]).abs().fillna(0) < 1e-12).all(), c
    assert two.loc[0, "v"] == 1.0 and two.loc[0, [c for c in two.columns if c.startswith("v_")]].isna().all()


def test_score_stream_metrics(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    train = spark.createDataFrame([(float(i), float(2 * i)) for i in range(20)], "CO double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["CO"], outputCol="features"),
                             LinearRegression(labelCol="y")]).fit(train)
    tmp = tempfile.mkdtemp(dir="/tmp")
    src = _src(spark, tmp)
    half = Pipeline(stages=[VectorAssembler(inputCols=["CO"], outputCol="features"),
                            LinearRegression(labelCol="y", regParam=5.0)]).fit(train)
    lines = spark.readStream.schema("offset int, value string").json(src).select("*", "_metadata.file_modification_time")
    d = M.decode(lines, "value")
    scored = jobs.score(d, {"linear": model, "ridge": half}, {"CO": (2.0, 1.0)}, ["CO"], arrived="file_modification_time")
    log = jobs.prediction_log(scored, ["CO"], {"linear": "linear", "ridge": "ridge"})
    q = (log.writeStream.format("parquet").option("path", os.path.join(tmp, "o"))
         .option("checkpointLocation", os.path.join(tmp, "c")).trigger(availableNow=True).start())
    jobs.run_available(q)
    m = q.lastProgress["observedMetrics"]["scoring"]
    assert m["predictions"] == 6 and m["prediction_errors"] == 0 and m["drift"] == 1
    out = spark.read.parquet(os.path.join(tmp, "o"))
    assert out.count() == 6 and set(out.columns) >= {"offset", "data", "predictions", "latency_sec", "drift"}
    assert out.where("predictions.linear IS NULL OR predictions.ridge IS NULL OR NOT latency_sec > 0").count() == 0


def test_streams_keep_the_whole_input(spark, tmp_path):
    from hourglass.plans import q_stream

    rows = [(i, f"2024-01-{1 + i % 3:02d} {i % 24:02d}:{i % 60:02d}:00", "error" if i % 5 == 0 else f"t{i % 2}", float(i), f'{{"k": {i}}}') for i in range(200)]
    ev = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double, props string")
    ev = ev.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1)
    ev.write.parquet(str(tmp_path / "dir"))
    next((tmp_path / "dir").glob("part-*.parquet")).rename(tmp_path / "events.parquet")
    want = ev.groupBy("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).agg(F.avg("value"), F.count("*")).collect()
    assert sorted(map(tuple, q_stream.stream_hourly(spark, str(tmp_path)).collect())) == sorted((a, b, round(c, 6), d) for a, b, c, d in want)
    got = {r.event_id: (r.k, r.raw) for r in q_stream.stream_ingest(spark, str(tmp_path)).collect()}
    assert got == {i: (None, "{bad json " + p) if e == "error" else (float(i), None) for i, _, e, _, p in rows}


def test_arma_next_to_trees_in_the_prediction_log(spark):
    """Both predictions of every message, checked by value; topic, partition and offset carried."""
    import datetime as dt

    import numpy as np
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from hourglass.streaming.arma import score_stream

    rng = np.random.default_rng(4)
    base = dt.datetime(2024, 1, 1)
    y = {"a": np.cumsum(rng.normal(size=12)) + 5, "b": np.cumsum(rng.normal(size=9)) + 50}
    rows = [("t", i % 3, 100 * i + (k == "b"), k, base + dt.timedelta(hours=i), float(v), float(2 * v)) for k, x in y.items() for i, v in enumerate(x)]
    rows.sort(key=lambda r: (r[4], r[3]))
    rows[7] = (*rows[7][:6], None)  # a missing feature is filled, not lost
    ddl = "topic string, partition int, offset long, s string, ts timestamp_ntz, CO double, NOx double"
    coef = {"a": (0.5, -0.2, 0.3, 0.1), "b": (0.1, 0.2, -0.3, 0.2)}
    coefs = spark.createDataFrame([(k, *c) for k, c in coef.items()], "s string, ar_1 double, ar_2 double, ma_1 double, ma_2 double")
    train = spark.createDataFrame([(float(i), float(3 * i)) for i in range(20)], "NOx double, y double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["NOx"], outputCol="features"), LinearRegression(labelCol="y")]).fit(train)
    tmp = tempfile.mkdtemp(dir="/tmp")
    src = os.path.join(tmp, "in")
    late = ("t", 0, 9999, "a", base, 1.0, 1.0)
    for part in (rows[:5], rows[5:6], rows[6:], [late]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(src)
    q = score_stream(stream, {"linear": model}, coefs, "s", "ts", "CO", os.path.join(tmp, "o"), os.path.join(tmp, "c"),
                     {"CO": (2.0, 1.0)}, ["NOx"], ["s", "CO"])
    jobs.run_available(q)
    log = {(r.topic, r.partition, r.offset): r for r in spark.read.parquet(os.path.join(tmp, "o")).collect()}
    assert len(log) == len(rows) + 1 and log[("t", 0, 9999)].predictions.arma is None
    for k, x in y.items():
        ar, ma = coef[k][:2], coef[k][2:]
        dy = np.concatenate([[0.0, 0.0, 0.0], np.diff(x)])
        e = [0.0, 0.0]
        mine = [r for r in rows if r[3] == k]
        for t, r in enumerate(mine):
            d = dy[t + 2 :: -1][:3]
            e.append(d[0] - ar[0] * d[1] - ar[1] * d[2] - ma[0] * e[-1] - ma[1] * e[-2])
            got = log[r[:3]].predictions
            want = x[t] + ar[0] * d[0] + ar[1] * d[1] + ma[0] * e[-1] + ma[1] * e[-2]
            assert abs(got.arma - want) < 1e-9 and abs(got.linear - 3 * (r[6] if r[6] is not None else 0.0)) < 1e-6


def test_decoded_messages_raise_alerts(spark):
    """Decode and alert as they are: the field name of the messages, with its fallback."""
    lines = spark.createDataFrame([('{"CO": 2.5}',), ('{"CO(GT)": "3.5"}',), ('{"CO": "9"}',), ("broken",), ('{"CO": null}',)], "value string")
    got = jobs.threshold_alerts(M.decode(lines, "value"), threshold=3.0)
    assert sorted(r.alert_value for r in got.collect()) == [3.5, 9.0]


def test_bounded_consumption_sets_the_limit_per_trigger(spark):
    class Reader:
        def __init__(self):
            self.options = {}

        def option(self, key, value):
            self.options[key] = value
            return self

    assert jobs.bounded(Reader(), 250).options == {"maxOffsetsPerTrigger": "250"}
