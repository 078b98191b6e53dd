"""Reading, shaping, writing, streaming and staging."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwise import staging
from tillwise.sources import tables as t
from tillwise.streaming.weekly import EVENT_SCHEMA, current_rows, merge_batch, resume_weekly_totals, weekly_totals


def test_csv_with_header_and_schema(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,order_date,units\no1,2015-01-05,3\no2,2015-01-06,4\n")
    rows = t.read_table(spark, str(path), "order_id string, order_date date, units int").collect()
    assert [(r.order_id, r.order_date, r.units) for r in rows] == [("o1", date(2015, 1, 5), 3), ("o2", date(2015, 1, 6), 4)]


def test_first_table_that_exists(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b.parquet"))
    paths = [str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")]
    assert t.first_table(spark, paths).count() == 3
    with pytest.raises(FileNotFoundError):
        t.first_table(spark, paths[:1])


def test_conform_fills_renames_and_parses(spark):
    old = spark.createDataFrame([("p", "3.5", 12.0), ("q", "x", 6.0)], "product_id string, avg_weekly_forecast string, current_stock double")
    schema = {"product_id": "string", "avg_weekly_qty": "double", "status": "string", "implied": "double"}
    got = t.conform(old, schema, {"avg_weekly_forecast": "avg_weekly_qty"}, {"status": "Safe", "implied": F.col("current_stock") / 6})
    assert [tuple(r) for r in got.collect()] == [("p", 3.5, "Safe", 2.0), ("q", None, "Safe", 1.0)]


def test_damaged_rows(spark):
    df = spark.createDataFrame(
        [("order_id", "quantity", "order_date"), ("o1", "2", "2015-01-05"), ("o2", "n/a", "2015-01-05"), ("o3", "1", "soon"), (None, "1", "2015-01-06")],
        "order_id string, quantity string, order_date string",
    )
    kept = t.drop_repeated_headers(df, "order_id")
    assert kept.count() == 4
    clean = t.coerce(kept, ["quantity"], ["order_date"], ["quantity", "order_date"]).collect()
    assert [r.order_id for r in clean] == ["o1", None]
    assert tuple(t.rejected_rows(kept, ["quantity"], ["order_date"]).first()) == (1, 1)


def test_vintages_stack_without_dedup(spark):
    old = spark.createDataFrame([("1", 5.0)], "Invoice string, Price double")
    new = spark.createDataFrame([("1", 5.0), ("2", 6.0)], "InvoiceNo string, UnitPrice double")
    got = t.stack_vintages([old, new], [{}, {"InvoiceNo": "Invoice", "UnitPrice": "Price"}])
    assert got.columns == ["Invoice", "Price"] and got.count() == 3


def test_append_keeps_earlier_partitions(spark, tmp_path):
    path = str(tmp_path / "lines")
    df = spark.createDataFrame([("CA_1", 1), ("TX_1", 2)], "store_id string, units int")
    t.write_table(df, path, ["store_id"])
    t.write_table(df.where("store_id = 'CA_1'"), path, ["store_id"], mode="append")
    assert {(r.store_id, r.n) for r in spark.read.parquet(path).groupBy("store_id").agg(F.count("*").alias("n")).collect()} == {("CA_1", 2), ("TX_1", 1)}
    t.write_table(df, str(tmp_path / "csv"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_params_round_trip(spark, tmp_path):
    path = str(tmp_path / "params")
    assert t.load_params(spark, path, {"depth": 7}) == {"depth": 7}
    t.save_params(spark, path, {"depth": 6, "step": 0.1})
    assert t.load_params(spark, path, {}) == {"depth": 6, "step": 0.1}


def test_models_round_trip(spark, tmp_path):
    from pyspark.ml.clustering import KMeans, KMeansModel
    from pyspark.ml.functions import array_to_vector

    rows = spark.range(10).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    model = KMeans(k=2, seed=1).fit(rows)
    t.save_models(spark, str(tmp_path / "m"), {"groups": model}, {"features": ["id"]})
    assert len(KMeansModel.load(str(tmp_path / "m" / "groups")).clusterCenters()) == 2
    assert t.load_params(spark, str(tmp_path / "m" / "metadata"), {}) == {"features": ["id"], "models": ["groups"]}


def totals_of(events):
    return sorted(map(tuple, weekly_totals(events, "ts", "event_type", "value").collect()))


def read_files(checkpoint):
    """Names of the files that the stream has taken in, by batch."""
    out = {}
    for p in Path(checkpoint, "sources", "0").glob("[0-9]*"):
        out |= {(json.loads(x)["batchId"], json.loads(x)["path"]): 1 for x in p.read_text().split("\n")[1:] if x}
    return [path for _, path in out]


def test_stream_goes_on_over_a_growing_folder(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder, place = str(tmp_path / "in"), (str(tmp_path / "table"), str(tmp_path / "state"))
    first, rest = events.where("event_id % 3 = 0"), events.where("event_id % 3 <> 0")
    first.repartition(3).write.parquet(folder)
    got = resume_weekly_totals(spark, folder, *place, files_per_batch=2, snapshot_every=3)
    assert got.columns == ["week", "event_type", "n", "total"]
    assert sorted(map(tuple, got.collect())) == totals_of(first)
    assert len(read_files(place[1])) == 3

    rest.repartition(9).write.mode("append").parquet(folder)
    for _ in range(2):  # the second call finds nothing new
        got = resume_weekly_totals(spark, folder, *place, files_per_batch=2, snapshot_every=3)
        assert sorted(map(tuple, got.collect())) == totals_of(events)
    taken = read_files(place[1])
    assert len(taken) == len(set(taken)) == 12
    batches = {int(p.name.split("=")[1]) for p in Path(place[0]).glob("batch=*")}
    assert 5 in batches and not {0, 1} & batches  # removed behind the second full copy


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table, keys = str(tmp_path / "t"), ["k"]
    make = lambda *rows: spark.createDataFrame(rows, "k string, n int")
    batches = [make(("a", 1), ("b", 1)), make(("a", 3)), make(("c", 1), ("a", 4)), make(("b", 9))]
    want = [{"a": 1, "b": 1}, {"a": 3, "b": 1}, {"a": 4, "b": 1, "c": 1}, {"a": 4, "b": 9, "c": 1}]
    for number, (batch, rows) in enumerate(zip(batches, want)):
        for _ in range(2):
            merge_batch(batch, number, table, keys, snapshot_every=2)
            assert {r.k: r.n for r in current_rows(spark, table, batch.schema, keys).collect()} == rows
    # After a failure an older batch may run again before the later ones do.
    merge_batch(batches[3], 3, table, keys, snapshot_every=2)
    assert {r.k: r.n for r in current_rows(spark, table, batches[0].schema, keys).collect()} == want[3]


def test_late_weeks_are_given_up(spark, tmp_path):
    folder, place = str(tmp_path / "in"), (str(tmp_path / "table"), str(tmp_path / "state"))

    def put(day, value):
        row = spark.sql(f"SELECT 1L AS event_id, TIMESTAMP_NTZ'{day} 12:00:00' AS ts, 1L AS user_id, 'a' AS event_type, {value}D AS value, '' AS props")
        row.write.mode("append").parquet(folder)
        return {str(r.week): r.total for r in resume_weekly_totals(spark, folder, *place, late="14 days").collect()}

    assert put("2024-01-01", 1) == {"2024-01-01": 1.0}
    assert put("2024-01-09", 2) == {"2024-01-01": 1.0, "2024-01-08": 2.0}
    assert put("2024-01-03", 4)["2024-01-01"] == 5.0  # late, but the week is open
    assert put("2024-03-05", 8)["2024-03-04"] == 8.0
    closed = put("2024-01-04", 16)  # given up: kept in the table as it was, gone from the state
    assert closed["2024-01-01"] == 5.0 and len(closed) == 3


def test_stream_without_files(spark, tmp_path):
    spark.createDataFrame([], EVENT_SCHEMA).write.parquet(str(tmp_path / "none"))
    got = resume_weekly_totals(spark, str(tmp_path / "none"), str(tmp_path / "t"), str(tmp_path / "s"), "nothing*")
    assert got.count() == 0 and got.columns == ["week", "event_type", "n", "total"]


def test_staging_goes_on_from_the_written_table(spark):
    got = staging.stage(spark.range(5).withColumn("x", F.col("id") * 2), "numbers")
    assert got.count() == 5 and got.inputFiles()[0].split("tillwise")[-1].find("numbers") > 0


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: None)})
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.scratch_dir(Session())
    Session.conf = type("C", (), {"get": staticmethod(lambda key, default=None: "hdfs:///shared/")})
    assert staging.scratch_dir(Session()) == "hdfs:///shared/tillwise/app"


def test_payload_is_json(spark, sf_dir):
    import __spark_entry__ as entry

    payload = json.loads(entry.queries()["report_payload"](spark, sf_dir).first().payload)
    assert payload["customers"][0]["customers"] == 150
    assert len(payload["weekly"]) == 52 and len(payload["forecast_weeks"]) == 12
    assert [r["label"] for r in payload["forecast_weeks"]][:2] == ["W+1", "W+2"]
    counts = payload["inventory"][0]
    assert counts["critical"] + counts["warning"] + counts["safe"] == counts["total"]
