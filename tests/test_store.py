"""Publishing, views over versions, checkpoints, incremental loads."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.plans.store import Checkpoint, StorageLimitError, Store
from tidemark.streaming.freshness import bar_stream, load_new

ROW = "trade_date date, stock_code string, close double"


def rows(spark, *values):
    from datetime import date

    return spark.createDataFrame([(date(2026, 1, day), c, x) for day, c, x in values], ROW)


def test_newest_version_wins(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    a = s.publish("processed", "stock_daily", rows(spark, (5, "A", 10.0), (6, "A", 1.0)), date="trade_date", inputs=["raw-1"])
    b = s.publish("processed", "stock_daily", rows(spark, (5, "A", 11.0)), date="trade_date")
    assert b.rows == 3 and len(b.folders) == 2 and b.inputs == ["raw-1", a.run_id] and (b.min_date, b.max_date) == ("2026-01-05", "2026-01-06")
    assert s.refresh({"daily_bar": ("processed", "stock_daily", ["trade_date", "stock_code"]), "absent": ("processed", "none", ["k"])}) == ["daily_bar"]
    assert sorted(r.close for r in spark.table("daily_bar").collect()) == [1.0, 11.0]
    c = s.publish("processed", "stock_daily", rows(spark, (7, "B", 1.0)), mode="replace")
    assert c.rows == 1 and len(c.folders) == 1
    assert sorted(r.close for r in spark.table("daily_bar").collect()) == [1.0, 11.0]  # a view is a snapshot


def test_nothing_becomes_active(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    with pytest.raises(ValueError, match="nothing"):
        s.publish("raw", "x", rows(spark))
    tiny = Store(spark, str(tmp_path), limit_bytes=1)
    with pytest.raises(StorageLimitError):
        tiny.publish("raw", "x", rows(spark, (5, "A", 1.0)))
    close = Store(spark, str(tmp_path), limit_bytes=1000)
    with pytest.raises(StorageLimitError):
        close.publish("raw", "x", rows(spark, (5, "A", 1.0)), estimate=1)
    assert s.load("raw", "x") is None and not list(tmp_path.rglob("*.parquet"))
    with pytest.raises(FileNotFoundError):
        s.read("raw", "x")


def test_checkpoints(tmp_path):
    c = Checkpoint(f"{tmp_path}/state/c.json")
    assert not c.done("b1", ["A", "B"])
    c.mark("b1", ["A", "B"])
    assert c.done("b1", ["A", "B"]) and not c.done("b1", ["A"]) and not c.done("b2", ["A", "B"])
    assert json.loads((tmp_path / "state/c.json").read_text())


def test_incremental_load(spark, tmp_path):
    s = Store(spark, f"{tmp_path}/root")
    seen = []

    def publish(df, batch):
        if not df.isEmpty():
            s.publish("raw", "bars", df)
            seen.append(batch)

    schema = rows(spark, (5, "A", 1.0)).schema
    rows(spark, (5, "A", 1.0)).write.mode("append").parquet(f"{tmp_path}/in")
    for _ in range(2):
        load_new(spark, f"{tmp_path}/in", schema, f"{tmp_path}/check", publish)
    rows(spark, (6, "B", 2.0)).write.mode("append").parquet(f"{tmp_path}/in")
    load_new(spark, f"{tmp_path}/in", schema, f"{tmp_path}/check", publish)
    assert len(seen) == 2 and s.read("raw", "bars").count() == 2


def test_bars_of_a_stream(spark, tmp_path):
    ticks = spark.range(20).select((F.lit("2026-01-05 10:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("time"), F.lit("A").alias("code"), F.col("id").cast("double").alias("price"), F.lit(1.0).alias("volume"))
    ticks.write.parquet(f"{tmp_path}/ticks")
    stream = bar_stream(spark.readStream.schema(ticks.schema).parquet(f"{tmp_path}/ticks"))
    stream.writeStream.trigger(availableNow=True).format("memory").queryName("bars5").outputMode("complete").start().awaitTermination()
    got = sorted((r.open, r.high, r.low, r.close, r.volume) for r in spark.table("bars5").collect())
    assert got == [(5.0 * i, 5.0 * i + 4, 5.0 * i, 5.0 * i + 4, 5.0) for i in range(4)]


def test_files_are_verified(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    m = s.publish("raw", "x", rows(spark, (5, "A", 1.0)).coalesce(1))
    before = spark.createDataFrame(s.files("raw", "x").collect())
    assert s.verify(before, "raw", "x").count() == 0
    rows(spark, (6, "B", 1.0)).coalesce(1).write.mode("append").parquet(m.folders[0])
    assert [r.problem for r in s.verify(before, "raw", "x").collect()] == ["new"]


def test_builder(spark, tmp_path):
    from datetime import date

    from tidemark.operators.quality import QualityError
    from tidemark.plans.pipeline import SURVIVORS, Builder

    state = Checkpoint(f"{tmp_path}/state.json")
    b = Builder(Store(spark, f"{tmp_path}/root"), state)
    bar = "time string, stock_code string, open double, high double, low double, close double, preClose double, volume double, amount double, suspendFlag double"
    stock = spark.createDataFrame([("20260105", c, 10.0, 11.0, 9.0, 10.5, 10.0, 100.0, 1000.0, 0.0) for c in ("A.SH", "B.SH")], bar)
    assert b.bars(stock, "stock", "batch-1").rows == 2 and b.bars(stock, "stock", "batch-1") is None
    assert b.latest("daily_bar").count() == 2
    with pytest.raises(QualityError):
        b.bars(stock.withColumn("high", F.lit(1.0)), "stock")
    assert b.latest("daily_bar").count() == 2
    b.calendar(spark.createDataFrame([(date(2026, 1, 5),), (date(2026, 1, 6),)], "trade_date date"), "SH")
    b.masters(spark.createDataFrame([("A.SH", "a", "20200101", "", "20260105")], "code string, InstrumentName string, OpenDate string, CreateDate string, ExpireDate string"), "stock")
    assert b.universe("ALL_A").rows == 1
    with pytest.raises(ValueError, match="survivors"):
        Builder(b.store, state, SURVIVORS).universe("ALL_A")
    fut = "time string, contract_code string, open double, high double, low double, close double, volume double, openInterest double, settelementPrice double"
    b.bars(spark.createDataFrame([("20260105", "IF2609.IF", 4010.0, 4010.0, 4010.0, 4010.0, 5.0, 7.0, 4005.0)], fut), "future")
    b.bars(spark.createDataFrame([("20260105", "SPOT", 4000.0, 4000.0, 4000.0, 4000.0)], "time string, index_code string, open double, high double, low double, close double"), "index")
    b.masters(spark.createDataFrame([("IF2609.IF", "0", "20260101", "20260918", "300")], "code string, CreateDate string, OpenDate string, ExpireDate string, VolumeMultiple string"), "future")
    mapping, basis = b.futures({"IF": "SPOT"})
    assert mapping.rows == 2 and basis.rows == 1 and basis.inputs == [mapping.run_id]
    b.financial(spark.createDataFrame([("A.SH", "Income", "20251231", date(2026, 1, 5), 1.0)], "stock_code string, table_name string, report_period string, announce_date date, value double"))
    assert "daily_bar" in b.refresh() and spark.table("future_basis_daily").first().basis_close == 10.0


def test_batches_are_known_by_what_was_asked(spark, tmp_path):
    from tidemark.plans.pipeline import Builder

    b = Builder(Store(spark, f"{tmp_path}/root"), Checkpoint(f"{tmp_path}/state.json"))
    schema = "time string, stock_code string, open double, high double, low double, close double, volume double, amount double"
    bars = lambda *rows: spark.createDataFrame([(d, c, 10.0, 11.0, 9.0, x, 100.0, 1000.0) for d, c, x in rows], schema)
    one = (("20260105", "A.SH", 10.0), ("20260105", "B.SH", 10.5))
    assert b.bars(bars(*one), "stock", "x").rows == 2 and b.bars(bars(*reversed(one)), "stock", "x") is None
    for changed in ((*one, ("20260105", "C.SH", 10.0)), (*one, ("20260106", "A.SH", 10.0)), (one[0], ("20260105", "B.SH", 9.5))):
        assert b.bars(bars(*changed), "stock", "x") is not None and b.bars(bars(*changed), "stock", "x") is None
    assert b.latest("daily_bar").count() == 4


def test_self_check(spark):
    from tidemark.sources.selfcheck import REDUCED, CapabilityError, check, gate

    one = rows(spark, (5, "A", 1.0))

    def refuse():
        raise PermissionError("no")

    def broken():
        raise RuntimeError("down")

    asked = {"stock_bars": lambda: one, "index_bars": lambda: one, "future_bars": lambda: one, "delisted_stocks": lambda: one.limit(0), "expired_contracts": refuse, "x": broken, "y": lambda: None}
    report = check(spark, asked)
    assert {r.capability: r.status for r in report.collect()} == {"stock_bars": "PASS", "index_bars": "PASS", "future_bars": "UNSUPPORTED", "delisted_stocks": "EMPTY", "expired_contracts": "NO_PERMISSION", "x": "ERROR", "y": "SKIP"}
    with pytest.raises(CapabilityError, match="delisted_stocks"):
        gate(report)
    good = asked | {"future_bars": lambda: one.select("*", *[F.lit(1.0).alias(c) for c in ("settlement", "open_interest", "volume")])}
    gate(check(spark, good), REDUCED)


def test_partitions_are_skipped(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.publish("raw", "x", rows(spark, (5, "A", 1.0), (6, "B", 2.0)).withColumn("year", F.year("trade_date")), partition_by=["year"])
    got = s.read("raw", "x").where("year = 2026")
    assert got.count() == 2 and s.read("raw", "x").where("year = 2025").count() == 0
    assert "PartitionFilters: [isnotnull(year" in got._jdf.queryExecution().executedPlan().toString()


def test_pinned_schemas(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    s.publish("processed", "stock_daily", rows(spark, (5, "A", 1.0)))
    s.publish("processed", "stock_daily", rows(spark, (6, "A", 1.0)).select("trade_date", "stock_code", F.lit(2).alias("close"), F.lit("x").alias("odd")))
    got = s.read("processed", "stock_daily")
    assert got.columns[:2] == ["trade_date", "stock_code"] and "odd" not in got.columns and dict(got.dtypes)["close"] == "double"
    assert sorted(r.close for r in got.collect()) == [1.0, 2.0] and {r.volume for r in got.collect()} == {None}
