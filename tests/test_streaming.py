import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import staging
from ledgerloom.plans.warehouse import SCOPE
from ledgerloom.sources.catalog import Catalog
from ledgerloom.sources.files import children
from ledgerloom.sources.schemas import LANDED
from ledgerloom.streaming import latest, orders
from ledgerloom.streaming.latest import Latest
from ledgerloom.streaming.orders import land_orders, landed_orders, latest_from_stream, order_feed, without_exact_redeliveries


def test_stream_equals_the_batch(warehouse):
    batch, streamed = warehouse.stg_orders, latest_from_stream(warehouse)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_later_files_win_rejects_are_kept_and_a_restart_changes_nothing(spark, tmp_path):
    feed, landing = str(tmp_path / "feed"), str(tmp_path / "landing")
    columns = "order_id string, customer_id string, order_ts string, currency string, status string, sales_channel string, discount_pct string, ingested_at string"
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    rates = spark.createDataFrame([("USD",)], "currency string")

    def deliver(*rows):
        spark.createDataFrame(list(rows), columns).coalesce(1).write.mode("append").json(feed)
        stream = order_feed(spark, feed, files_per_batch=1)
        land_orders(stream, customers, rates, landing, str(tmp_path / "bad"), str(tmp_path / "progress"))

    first = ("SO1", "C1", "2025-01-01T10:00:00Z", "USD", "completed", "web", "0", "2025-01-01T11:00:00Z")
    deliver(first, ("SO2", "C9", *first[2:]))
    deliver((*first[:4], "refunded", *first[5:7], "2025-01-05T00:00:00Z"))
    # an older state that arrives late, even after weeks, must not win
    deliver((*first[:4], "cancelled", *first[5:7], "2025-01-01T10:30:00Z"))

    schema = LANDED["orders"]
    raw = landed_orders(spark, landing, schema)
    assert raw.count() == 3
    raw = raw.withColumnRenamed("_micro_batch", "_batch_id").withColumn("_loaded_at", F.lit(None).cast("timestamp_ntz"))
    latest = staging.stg_orders(raw).collect()
    assert [(r.order_id, r.status, r.ingested_at) for r in latest] == [("SO1", "refunded", datetime(2025, 1, 5))]
    rejected = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [(r.order_id, r.reject_reason) for r in rejected] == [("SO2", "orphan_customer")]


def test_exact_redeliveries_are_dropped_within_the_lookback(spark, tmp_path):
    feed = str(tmp_path / "feed")
    rows = [("SO1", datetime(2025, 1, 1)), ("SO1", datetime(2025, 1, 1)), ("SO1", datetime(2025, 1, 2)), ("SO2", datetime(2025, 1, 2))]
    spark.createDataFrame(rows, "order_id string, ingested_at timestamp").write.parquet(feed)
    stream = spark.readStream.schema("order_id string, ingested_at timestamp").parquet(feed)
    query = (
        without_exact_redeliveries(stream, "ingested_at")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.order_id, r.ingested_at.day) for r in got) == [("SO1", 1), ("SO1", 2), ("SO2", 2)]


def test_many_micro_batches_leave_few_files_and_a_restart_changes_nothing(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    feed, landing = str(tmp_path / "feed"), str(tmp_path / "landing")
    columns = "order_id string, customer_id string, order_ts string, currency string, status string, sales_channel string, discount_pct string, ingested_at string"
    customers, rates = spark.createDataFrame([("C1",)], "customer_id string"), spark.createDataFrame([("USD",)], "currency string")
    want: dict = {}
    (tmp_path / "feed").mkdir()
    for i in range(18):
        lines = []
        # one delivery of an order per file, so that the place in a file decides nothing
        for key in rng.sample(range(12), 4):
            at, status = rng.randrange(10**6), rng.choice(["completed", "refunded", "cancelled"])
            stamp = f"2025-01-{1 + at // 43200 % 28:02d}T{at % 24:02d}:{at % 60:02d}:{i:02d}Z"
            row = (f"SO{key}", "C1", "2025-01-01T10:00:00Z", "USD", status, "web", "0", stamp)
            lines.append(json.dumps(dict(zip((c.split()[0] for c in columns.split(", ")), row))))
            want[row[0]] = max(want.get(row[0], ("",)), (stamp, status))
        (tmp_path / f"feed/{i:03d}.json").write_text("\n".join(lines))

    def read(folders):
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    schema = LANDED["orders"]
    schema = type(schema)([x for x in schema.fields if x.name not in ("_batch_id", "_loaded_at")])
    state = Latest(Catalog(spark, str(tmp_path / "state")), "orders", landing, orders.MICRO_BATCH, "order_id", lambda: [F.col("ingested_at").desc()], read, every=4, ranges=3)

    def run():
        stream = order_feed(spark, feed, files_per_batch=1)
        land_orders(stream, customers, rates, landing, str(tmp_path / "bad"), str(tmp_path / "progress"), state=state)

    # the job stops after the second fold is committed and before anything is cleared
    deleted = latest.delete

    def stop(*args):
        if state._upto() >= 7:
            raise RuntimeError("stopped")
        deleted(*args)

    with monkeypatch.context() as m:
        m.setattr(latest, "delete", stop)
        with pytest.raises(Exception, match="stopped"):
            run()
    run()
    got = {r.order_id: (r.ingested_at.strftime("%Y-%m-%dT%H:%M:%SZ"), r.status) for r in state.rows().collect()}
    assert got == want
    assert len(children(spark, landing)) <= 4
    run()  # nothing is waiting
    assert {r.order_id for r in state.rows().collect()} == set(want)
