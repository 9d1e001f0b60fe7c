import datetime as dt

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sparkseries import sources
from sparkseries.operators import quality
from sparkseries.plans import layers
from sparkseries.plans.backtest import walk_forward, yearly_runs
from sparkseries.session import cut_lineage
from sparkseries.sources import registry


def test_text_scan_keeps_everything_as_text(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("Date;Time;Global_active_power\n16/12/2006;17:24:00;4,216\n1/1/2007;00:00:00;?\n")
    for columns in (None, ["Date", "Time", "Global_active_power"]):
        df = sources.read_text_columns(spark, str(tmp_path / "raw.csv"), columns)
        assert [t for _, t in df.dtypes] == ["string"] * 3 and df.columns[2] == "Global_active_power"
        assert df.count() == 2 and df.first().Global_active_power == "4,216"


def test_inferred_and_given_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("date,t\n1981-01-01,20.7\n1981-01-02,x\n")
    inferred = sources.read_inferred(spark, str(tmp_path / "t.csv"))
    assert dict(inferred.dtypes) == {"date": "date", "t": "string"}
    given = sources.read_inferred(spark, str(tmp_path / "t.csv"), "date date, t double")
    assert [r.t for r in given.collect()] == [20.7, None]


def test_file_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "bom.csv").write_bytes(b'\xef\xbb\xbf"Category","Annual Mean","5-yr smooth"\n1901,22.68,22.69\n')
    df = sources.read_inferred(spark, str(tmp_path / "bom.csv"))
    assert df.columns == ["Category", "Annual Mean", "5-yr smooth"]
    assert dict(df.dtypes) == {"Category": "int", "Annual Mean": "double", "5-yr smooth": "double"}


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "x")], "a int, yhat double, b string")
    sources.write_csv(df, str(tmp_path / "out"), ["a", "yhat"])
    back = sources.read_inferred(spark, str(tmp_path / "out"))
    assert [tuple(r) for r in back.collect()] == [(1, 2.5)]


def test_layer_overwrites_only_its_run(spark, tmp_path):
    base = str(tmp_path / "layer")
    assert sources.write_layer(spark.range(5), base, 1) == 5
    assert sources.write_layer(spark.range(7), base, 2) == 7
    assert sources.write_layer(spark.range(3), base, 1) == 3
    counts = {r.runid: r["count"] for r in sources.read_layer(spark, base).groupBy("runid").count().collect()}
    assert counts == {1: 3, 2: 7}
    pruned = sources.read_layer(spark, base, [2])
    assert pruned.count() == 7 and "PartitionFilters: [isnotnull(runid" in pruned._jdf.queryExecution().executedPlan().toString().replace("PartitionFilters: [runid", "PartitionFilters: [isnotnull(runid")
    stacked = sources.stack_layers({1: spark.range(2), 2: spark.range(3)})
    assert stacked.count() == 5 and set(stacked.columns) == {"id", "runid"}


def test_snapshots_keep_history(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sources.read_snapshot(spark, path)
    assert sources.write_snapshot(spark.range(0, 5), path) == 0
    assert sources.write_snapshot(spark.range(5, 10), path) == 1
    ids = lambda v: sorted(r.id for r in sources.read_snapshot(spark, path, v).collect())
    assert ids(None) == list(range(5, 10)) and ids(0) == list(range(5)) and ids(1) == ids(None)
    rows = sources.history(spark, path).collect()
    assert [(r.version, r.operation, r.operationParameters["mode"]) for r in rows] == [(1, "WRITE", "Overwrite"), (0, "WRITE", "Overwrite")]
    assert rows[0].timestamp >= rows[1].timestamp


def test_unpublished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    sources.write_snapshot(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/data/version=1")  # a write that never published
    assert sources.read_snapshot(spark, path).count() == 3
    assert sources.write_snapshot(spark.range(4), path) == 1
    assert sources.read_snapshot(spark, path).count() == 4


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    sources.log_run(spark, path, "train", "1", {"start": "1981-01-01"}, {"rmse": 2.5})
    sources.log_run(spark, path, "train", "2", {"start": "1982-01-01"}, {"rmse": 3.5})
    table = sources.run_table(sources.read_runs(spark, path), ["start", "rmse"]).orderBy("run_id").collect()
    assert [(r.run_id, r.start, r.rmse) for r in table] == [("1", "1981-01-01", "2.5"), ("2", "1982-01-01", "3.5")]


def test_model_registry(spark, tmp_path):
    base = str(tmp_path / "models")
    table = spark.createDataFrame([("a", 1.0)], "k string, slope double")
    signature = registry.schema_signature(table, table.select("slope"))
    assert sources.register_model(spark, base, "lines", table, signature) == 0
    assert sources.register_model(spark, base, "lines", table.withColumn("slope", F.lit(2.0)), signature) == 1
    assert sources.latest_model(spark, base, "lines").first().slope == 2.0
    stored = registry.model_signature(spark, base, "lines")
    registry.check_signature(table, stored["inputs"])
    with pytest.raises(ValueError):
        registry.check_signature(table.withColumn("slope", F.lit("x")), stored["inputs"])
    with pytest.raises(ValueError):
        registry.check_signature(table.drop("k"), stored["inputs"])
    with pytest.raises(FileNotFoundError):
        sources.latest_model(spark, base, "none")


def test_pipeline_in_the_registry(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features")]).fit(df)
    base = str(tmp_path / "models")
    sources.register_model(spark, base, "p", model)
    assert sources.register_model(spark, base, "p", model) == 1
    assert list(sources.latest_model(spark, base, "p").transform(df).first().features) == [1.0, 2.0]


def test_layered_job(spark, sf, tmp_path):
    base = str(tmp_path / "job")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    raw = orders.groupBy(F.to_date("o_orderdate").cast("string").alias("date")).agg(F.sum("o_totalprice").cast("string").alias("price"))
    runs = yearly_runs(1995, n_runs=3, train_years=2)
    scores = {r.runid: r for r in layers.run_layers(raw, "date", "price", runs, base, "nightly").collect()}
    direct = walk_forward(raw.select(F.to_date("date").alias("ds"), F.col("price").cast("double").alias("y")), runs)
    for r in direct.collect():
        assert scores[r.runid].n_rows == r.n_rows and scores[r.runid].rmse == pytest.approx(r.rmse, rel=1e-9)
    log = sources.run_table(sources.read_runs(spark, f"{base}/runs"), ["start", "bronze_train_count", "silver_eval_count", "eval_forecast_count"])
    rows = {r.run_id: r for r in log.collect()}
    assert rows["1"].start == "1995-01-01" and int(rows["1"].eval_forecast_count) == scores[1].n_rows
    assert int(rows["1"].bronze_train_count) == spark.read.parquet(f"{base}/bronze_train").where("runid = 1").count()


def test_quality_rules_count_null_as_failing(spark):
    df = spark.createDataFrame([(5.0,), (15.0,), (None,)], "v double")
    got = quality.expect(df, "d", {"big": "v > 10", "there": "v IS NOT NULL"}).collect()
    assert [(r.expectation, r.passing_records, r.failing_records) for r in got] == [("big", 1, 2), ("there", 2, 1)]
    both = quality.summarize(quality.expect(df, "d", {"big": "v > 10"}).unionByName(quality.expect(df, "d", {"big": "v > 10"})))
    assert both.first().passing_records == 2 and both.first().failing_records == 4


def test_checkpoint_folder_comes_from_the_session(spark):
    cut = cut_lineage(spark.range(5).withColumn("x", F.col("id") + 1))
    assert cut.count() == 5 and "Range" not in cut._jdf.queryExecution().logical().toString()


def test_rerun_without_rows_empties_its_run(spark, tmp_path):
    base = str(tmp_path / "layer")
    rows = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "id int, runid int")
    sources.write_layer(rows, base, runs=[1, 2])
    assert sources.write_layer(rows.where("runid = 1"), base, runs=[1, 2]) == 2
    assert {r.runid for r in sources.read_layer(spark, base).collect()} == {1}
    assert sources.write_layer(spark.range(0), base, 1) == 0
    assert not (tmp_path / "layer" / "runid=1").exists() and not (tmp_path / "layer" / "runid=2").exists()


def test_layer_has_few_files_per_run(spark, tmp_path):
    base = str(tmp_path / "layer")
    sources.write_layer(spark.range(0, 1000, 1, 8).withColumn("runid", F.col("id") % 3), base)
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in (tmp_path / "layer").glob("runid=*"))


def test_run_table_shows_the_last_value(spark, tmp_path):
    path = str(tmp_path / "runs")
    for value in (2.5, 1.5, 3.5):
        sources.log_run(spark, path, "train", "1", metrics={"rmse": value})
    assert sources.run_table(sources.read_runs(spark, path), ["rmse"]).first().rmse == "3.5"


def test_scoring_checks_the_signature(spark, tmp_path):
    base = str(tmp_path / "models")
    table = spark.createDataFrame([("a", 1.0)], "k string, slope double")
    sources.register_model(spark, base, "lines", table, registry.schema_signature(table, table))
    assert registry.checked_model(spark, base, "lines", table).count() == 1
    with pytest.raises(ValueError):
        registry.checked_model(spark, base, "lines", table.drop("slope"))


def test_other_header_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Time;Date;v\n10:00:00;1/1/2020;5\n")
    with pytest.raises(Exception, match="header|HEADER|schema"):
        sources.read_text_columns(spark, str(tmp_path / "t.csv"), ["Date", "Time", "v"]).collect()


def test_rerun_of_the_layered_job_logs_the_new_score(spark, tmp_path):
    base = str(tmp_path / "job")
    days = spark.sql("SELECT explode(sequence(date'1995-01-01', date'1998-12-31')) AS ds")
    raw = days.select(F.col("ds").cast("string").alias("date"), (F.dayofyear("ds") * 1.0 + F.dayofweek("ds")).cast("string").alias("price"))
    runs = yearly_runs(1995, n_runs=2, train_years=2)
    first = {r.runid: r.rmse for r in layers.run_layers(raw, "date", "price", runs, base, "nightly").collect()}
    layers.run_layers(raw.withColumn("price", (F.col("price").cast("double") * 2).cast("string")), "date", "price", runs, base, "nightly")
    log = {r.run_id: r for r in sources.run_table(sources.read_runs(spark, f"{base}/runs"), ["rmse", "train_dropped_count"]).collect()}
    assert all(float(log[str(k)].rmse) == pytest.approx(2 * v) for k, v in first.items())
    assert log["1"].train_dropped_count == "0"
