import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom import schemas
from pairloom.operators import quality, tables
from pairloom.plans import marts, training
from pairloom.sources import bars as src
from pairloom.sources import files
from pairloom.streaming import incremental, predictions

D = dt.date
BARS = "symbol string, date date, close double"


def bars(spark, rows):
    return spark.createDataFrame(rows, BARS)


def test_append_is_idempotent_and_rejects_incomplete_rows(spark):
    stored = bars(spark, [("A", D(2020, 1, 1), 1.0)])
    batch = bars(spark, [("A", D(2020, 1, 1), 9.0), ("A", D(2020, 1, 2), 2.0), ("A", D(2020, 1, 3), None)])
    once = tables.guarded_append(batch, stored, ["close"], incomplete="skip")
    twice = tables.guarded_append(batch, once, ["close"], incomplete="skip")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted(r.close for r in once.collect()) == [1.0, 2.0]
    assert tables.guarded_append(batch, stored, ["close"]).collect() == stored.collect()  # rejected as a whole
    copies = bars(spark, [("B", D(2020, 1, 1), 5.0), ("B", D(2020, 1, 1), 4.0)])
    assert sorted(r.close for r in tables.guarded_append(copies, stored, ["close"]).collect()) == [1.0, 4.0]
    report = {r.status: r.n_rows for r in tables.rejection_report(batch, stored, ["close"]).collect()}
    assert report == {"stored": 1, "new": 1, "incomplete": 1}


def test_replace_day_only_for_the_newest_day(spark):
    stored = bars(spark, [("A", D(2020, 1, 1), 1.0), ("A", D(2020, 1, 2), 2.0)])
    fresh = bars(spark, [("A", D(2020, 1, 2), 5.0), ("A", D(2020, 1, 1), 7.0)])
    assert sorted(r.close for r in tables.replace_day(stored, fresh, "2020-01-02").collect()) == [1.0, 5.0]
    assert sorted(r.close for r in tables.replace_day(stored, fresh, "2020-01-01").collect()) == [1.0, 2.0]


def test_write_days_overwrites_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_days(bars(spark, [("A", D(2020, 1, 1), 1.0), ("A", D(2020, 1, 2), 2.0)]), path)
    for _ in range(2):
        tables.write_days(bars(spark, [("A", D(2020, 1, 2), 3.0)]), path)
    assert sorted(r.close for r in spark.read.parquet(path).collect()) == [1.0, 3.0]


def test_upsert(spark):
    schema = "date string, model_id string, prediction int, actual int"
    stored = spark.createDataFrame([("d1", "m", 0, 1), ("d2", "m", 1, 1)], schema)
    fresh = spark.createDataFrame([("d2", "m", 0, None), ("d3", "m", 1, None)], schema)
    out = {r.date: (r.prediction, r.actual) for r in tables.upsert(stored, fresh, ["date", "model_id"], ["prediction"]).collect()}
    assert out == {"d1": (0, 1), "d2": (0, 1), "d3": (1, None)}


def test_scd2_versions(spark):
    def load(rows):
        return spark.createDataFrame(rows, "k string, diff string")
    snap = tables.first_snapshot(load([("a", "1"), ("b", "1"), ("c", "1")]), "k", "diff", "2024-01-01 00:00:00")
    for day, rows in (("2024-01-02", [("a", "2"), ("b", "1"), ("d", "1")]), ("2024-01-02", [("a", "2"), ("b", "1"), ("d", "1")]),
                      ("2024-01-03", [("a", "3"), ("c", "9")])):
        snap = tables.scd2_merge(snap, load(rows), "k", "diff", f"{day} 00:00:00")
    out = snap.toPandas()
    assert out.groupby("k").size().to_dict() == {"a": 3, "b": 1, "c": 2, "d": 1}
    for _, x in out.groupby("k"):
        x = x.sort_values("valid_from")
        assert x.valid_to.isna().sum() == 1
        assert (x.valid_to.iloc[:-1].to_numpy() == x.valid_from.iloc[1:].to_numpy()).all()
    current = tables.current_versions(snap)
    assert {r.k: r.diff for r in current.collect()} == {"a": "3", "b": "1", "c": "9", "d": "1"}
    assert set(current.columns) == {"k", "diff", "snsh_load_ts_utc"}


def test_csv_copy_skips_bad_files(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('date,size,name\n2020-01-01,1.5,"a, b"\n2020-01-02,2,c\n')
    bad.write_text("date,size,name\n2020-01-03,3,d\nnot-a-date,4,e\n")
    schema = T.StructType.fromDDL("date date, size double, name string")
    assert sorted(r.name for r in files.copy_csv(spark, str(tmp_path), schema).collect()) == ["a, b", "c"]
    # also when a query reads none of the columns that hold the bad text
    assert sorted(r.name for r in files.copy_csv(spark, str(tmp_path), schema).select("name").collect()) == ["a, b", "c"]
    by_row = files.copy_csv(spark, str(tmp_path), schema, skip_file=False).collect()
    assert sorted(r.name for r in by_row) == ["a, b", "c", "d"]
    rejected = files.rejected_files(spark, str(tmp_path), schema).collect()
    assert [(r.file.rsplit("/", 1)[1], r.bad_rows) for r in rejected] == [("bad.csv", 1)]


def test_incremental_extract_and_repairs(spark):
    stored = bars(spark, [("A", D(2020, 1, 3), 1.0)])
    incoming = bars(spark, [("A", D(2020, 1, 2), 0.0), ("A", D(2020, 1, 3), 1.5), ("A", D(2020, 1, 4), 2.0), ("B", D(2020, 1, 1), 3.0)])
    assert sorted(r.close for r in src.after_high_water(incoming, stored, "2020-01-05").collect()) == [2.0, 3.0]
    assert sorted(r.close for r in src.after_high_water(incoming, stored, "2020-01-03").collect()) == [1.5, 2.0, 3.0]
    assert sorted(r.close for r in src.drop_open_bar(incoming).collect()) == [0.0, 1.5]
    gap = bars(spark, [("A", D(2020, 1, 1), 1.0), ("A", D(2020, 1, 2), 2.0), ("A", D(2020, 1, 4), 3.0), ("B", D(2020, 1, 1), 4.0)])
    assert {r.close: r.date for r in src.shift_last_on_gap(gap).collect()}[3.0] == D(2020, 1, 3)
    moved = {r.close: r.date for r in src.shift_last_if_missing(gap, "2020-01-04").collect()}
    assert moved[3.0] == D(2020, 1, 4) and moved[4.0] == D(2019, 12, 31)


def test_lookback_keeps_one_date_more(spark):
    dim = src.calendar(spark, "2020-01-01", "2020-12-31")
    facts = spark.range(161).select(F.col("id").cast("int").alias("date_code"), F.lit("A").alias("symbol_code"))
    codes = [r.date_code for r in src.lookback(facts, dim, 150).collect()]
    assert (min(codes), max(codes), len(codes)) == (10, 160, 151)
    assert src.lookback(facts, dim, 0).count() == 161


def test_calendar_and_chunks(spark):
    cal = src.calendar(spark)
    assert cal.count() == 4437 and cal.agg(F.max("date_code")).first()[0] == 4436
    chunks = src.range_chunks(spark, "2020-01-01", "2021-12-31").orderBy("chunk_no").collect()
    assert [c.chunk_start for c in chunks] == [D(2020, 1, 1), D(2020, 10, 1), D(2021, 7, 1)]


def test_backfill_keeps_the_end_of_the_span(spark):
    days = spark.sql("SELECT 'A' AS symbol, explode(sequence(DATE'2019-12-01', DATE'2022-02-01', INTERVAL 1 DAY)) AS date, 1.0D AS close")
    got = {r.date: r.chunk_no for r in src.chunked_backfill(days, "2020-01-31", "2021-12-31", 9).collect()}
    edges = [(c.chunk_start, c.chunk_end) for c in src.range_chunks(spark, "2020-01-31", "2021-12-31", 9).orderBy("chunk_no").collect()]
    assert min(got) == D(2020, 1, 31) and max(got) == D(2021, 12, 31) and len(got) == 701
    for day, n in got.items():
        assert n == min(k for k, (lo, hi) in enumerate(edges) if lo <= day <= hi), day
    whole = {r.date for r in src.chunked_backfill(days, "2020-01-31", "2021-12-31", 9, whole_ranges_only=True).collect()}
    assert max(whole) == max(hi for _, hi in edges if hi <= D(2021, 12, 31))


def operators_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_are_aggregated_by_hashing(spark):
    from pairloom.functions.columns import packed
    ticks = spark.createDataFrame([("A", dt.datetime(2020, 1, 1, h), 10.0 * n + h, 1.0, n, h) for n in (2, 1) for h in (9, 3)],
                                  "s string, ts timestamp, p double, v double, n int, h int")
    out = src.bars_from_ticks(ticks, "s", F.col("ts"), F.col("p"), F.col("v"), [packed((F.col("n"), 5), (F.col("h"), 2))])
    assert "SortAggregate" not in operators_of(out)
    row = out.first()
    assert (row.open, row.high, row.low, row.close, row.volume) == (13.0, 29.0, 13.0, 29.0, 4.0)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        ticks.select(packed((F.col("n"), 5), (F.col("h") * 100, 2)).alias("k")).collect()


def test_no_join_on_the_series_key_alone(spark):
    from pairloom.operators import labels
    from pairloom.operators.series import SeriesSpec
    import re
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bars(spark, [(s, D(2020, 1, i), float(i)) for s in "AB" for i in range(1, 9)])
        spec = SeriesSpec(("symbol",), "date")
        spans = df.withColumn("t1", F.date_add("date", 2))
        info = spark.createDataFrame([("A", "USD", "X")], "symbol string, currency string, exchange string")
        frames = [src.after_high_water(df, df, "2020-01-08"), src.drop_open_bar(df), src.with_symbol_info(df, info), src.shift_last_on_gap(df),
                  src.shift_last_if_missing(df, "2020-01-09"), labels.embargo_times(df, spec, 0.2), labels.purged_kfold(spans, spec, "t1", 2),
                  incremental.touched_tail(df, df)]
        for out in frames:
            joins = re.findall(r"(?:SortMerge|ShuffledHash)Join \[([^\]]*)\]", operators_of(out))
            assert joins and all("," in keys for keys in joins), joins
            out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_work_folder_must_be_shared_off_local_masters(spark):
    from types import SimpleNamespace

    from pairloom.session import work_dir

    def session(master, **conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get("dir", d)), sparkContext=SimpleNamespace(master=master))
    with pytest.raises(ValueError, match="checkpoint"):
        work_dir(session("spark://host:7077"), "x")
    assert work_dir(session("yarn", dir="hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert work_dir(session("local[4]"), "x")


def test_surrogate_key_marks_nulls(spark):
    import hashlib

    from pairloom.functions.columns import surrogate_key
    df = spark.createDataFrame([("a", None)], "x string, y string")
    want = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()
    assert df.select(surrogate_key("x", "y")).first()[0] == want


def test_missing_member_and_seed(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0)], "symbol string, close double")
    out = marts.with_missing_member(df, {"symbol": "Missing", "close": -1}).collect()
    assert ("Missing", -1.0) in [tuple(r) for r in out]
    (tmp_path / "s.csv").write_text(
        "symbol,exchange,name,sector,industry,asset_type,LOAD_TS\nBTC,CCC,Bitcoin,,,CRYPTOCURRENCY,\n")
    row = files.load_seed(spark, str(tmp_path / "s.csv"), schemas.SYMBOL_INFO, "2024-01-01 00:00:00").first()
    assert row.load_ts == dt.datetime(2024, 1, 1) and row.sector is None


def test_messages_round_trip_and_quarantine(spark):
    scored = spark.createDataFrame([(D(2024, 11, 6), 0, 0.587, 0.0, 0.0, 0.5)],
                                   "date date, direction int, confidence double, mu double, std double, spread double")
    body = tables.prediction_messages(scored).first().body
    raw = spark.createDataFrame([("m1", None, "a", body), ("m1", None, "a", body), ("m2", None, "a", "oops")], predictions.RAW)
    good = predictions.accepted(raw).collect()
    assert len(good) == 1 and good[0].prediction == 0 and good[0].confidence == 0.587 and good[0].message_spread == 0.5
    assert [r.msg_id for r in predictions.quarantined(raw).collect()] == ["m2"]


def test_quality_checks(spark):
    df = spark.createDataFrame([("A", 1, -1.0), ("A", 13, None), ("B", 2, 5.0)], "k string, month int, v double")
    assert {r.column_name: r.n_null for r in quality.null_counts(df, ["k", "v"]).collect()} == {"k": 0, "v": 1}
    assert [r.k for r in quality.duplicates(df, ["k"]).collect()] == ["A"]
    assert [r.month for r in quality.outside_range(df, "month", 1, 12).collect()] == [13]
    assert [r.v for r in quality.negatives(df, "v").collect()] == [-1.0]
    assert [r.v for r in quality.outside_any(df, ["v"], 0, 4).collect()] == [-1.0, 5.0]
    gate = quality.null_gate(df.withColumnRenamed("v", "actual")).first()
    assert gate.accepted and not quality.null_gate(df).first().accepted


def test_calendar_gaps(spark):
    df = bars(spark, [("A", D(2020, 1, 1), 1.0), ("A", D(2020, 1, 4), 1.0), ("B", D(2020, 1, 2), 1.0)])
    gaps = quality.calendar_gaps(df, src.calendar(spark, "2020-01-01", "2020-12-31")).collect()
    assert sorted((r.symbol, r.date.day) for r in gaps) == [("A", 2), ("A", 3)]


def test_projection_and_alignment(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert tables.project(df, ["A", "B"]).columns == ["A", "B"]
    with pytest.raises(ValueError, match="missing"):
        tables.project(df, ["A", "C"])
    out = training.align_columns(df, ["a", "x", "b"])
    assert out.columns == ["a", "x", "b"] and out.first().x == 0
    assert len(schemas.FEATURE_TABLE) == 45 and len(schemas.MODEL_FEATURES) == 38


def test_touched_tail_and_latest_rows(spark):
    stored = bars(spark, [("A", D(2020, 1, i), float(i)) for i in range(1, 11)] + [("B", D(2020, 1, 1), 1.0)])
    batch = bars(spark, [("A", D(2020, 1, 10), 99.0), ("A", D(2020, 1, 11), 11.0)])
    tail = incremental.touched_tail(stored, batch, lookback_days=3).orderBy("date").collect()
    assert [(r.date.day, r.close) for r in tail] == [(7, 7.0), (8, 8.0), (9, 9.0), (10, 99.0), (11, 11.0)]
    log = stored.withColumn("batch_id", F.lit(0)).unionByName(batch.withColumn("batch_id", F.lit(1)))
    now = {(r.symbol, r.date.day): r.close for r in incremental.latest_rows(log).collect()}
    assert now[("A", 10)] == 99.0 and len(now) == 12


def test_gate_decides_in_the_pass_that_writes(spark, tmp_path):
    """The batch runs once, a rejected one changes nothing, a repeated one adds nothing, a broken publication is made up for."""
    schema = "symbol string, date date, close double, actual int"
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    runs = spark.sparkContext.accumulator(0)

    def batch(rows):
        def count(batches):
            for b in batches:
                runs.add(b.num_rows)
                yield b
        df = spark.createDataFrame(rows, schema)
        return df.mapInArrow(count, df.schema)

    def table():
        return sorted(tuple(r) for r in spark.read.schema(schema).parquet(str(tmp_path / "t")).select("symbol", "date", "close", "actual").collect())

    required = ["symbol", "date", "close"]
    first = [("a", d, 1.0, None) for d in days[:3]] + [("a", days[0], 0.5, 1)]
    v = tables.gated_append(batch(first), str(tmp_path / "t"), str(tmp_path / "s0"), required)
    assert (v.accepted, v.n_rows, v.n_bad, v.nulls) == (True, 4, 0, {"symbol": 0, "date": 0, "close": 0, "actual": 3}) and runs.value == 4
    want = [("a", days[0], 0.5, 1), ("a", days[1], 1.0, None), ("a", days[2], 1.0, None)]
    assert table() == want
    bad = [("a", days[4], 2.0, None), ("b", days[4], None, None), (None, days[5], None, 7)]
    v = tables.gated_append(batch(bad), str(tmp_path / "t"), str(tmp_path / "s1"), required)
    assert (v.accepted, v.n_rows, v.n_bad, v.nulls["close"], v.nulls["symbol"]) == (False, 3, 2, 2, 1) and table() == want
    more = [("a", days[2], 9.0, None), ("a", days[3], 3.0, None), ("b", days[3], 4.0, None)]
    spark.createDataFrame(more[1:2], schema).write.mode("append").partitionBy("date").parquet(str(tmp_path / "t"))  # half of it is there
    for k in (2, 3):
        assert tables.gated_append(batch(more), str(tmp_path / "t"), str(tmp_path / f"s{k}"), required).accepted
        assert table() == sorted(want + more[1:])
    assert tables.gated_append(batch([]), str(tmp_path / "t"), str(tmp_path / "s4"), required).n_rows == 0 and table() == sorted(want + more[1:])


def test_work_folders_are_removed_on_request(spark, monkeypatch):
    import os

    from pairloom import session
    kept = session.work_dir(spark, "kept")
    os.makedirs(kept, exist_ok=True)
    monkeypatch.setattr(session, "_made", {})  # only what is named from here on
    df = session.stored(spark.range(3), "numbers")
    session.stored(spark.range(2), "more")
    made = [p for paths in session._made.values() for p in paths]
    assert df.count() == 3 and len(made) == 2 and all(map(os.path.isdir, made))
    assert session.remove_work(spark) == 2 and session.remove_work(spark) == 0
    assert not any(map(os.path.exists, made)) and os.path.isdir(kept)
