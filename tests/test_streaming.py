import json
import os
import tempfile

from marginlens.operators import cleaning as C
from marginlens.schemas import ORDERS_SCHEMA
from marginlens.streaming import ingest, read_orders_stream, row_rules


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))


def test_stream_ingest_applies_row_rules_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="marginlens-stream-")
    inbox, table, ckpt = (os.path.join(base, n) for n in ("inbox", "table", "ckpt"))
    os.makedirs(inbox)
    line = {"Order Date": "1/1/2014", "Ship Date": "3/1/2014", "Customer ID": "C1", "Product ID": "P1",
            "Quantity": 1, "Price": 10.0}
    _write(inbox, "a.json", [
        {**line, "Row ID": 1, "Order ID": "O1", "Profit": 1.0},
        {**line, "Row ID": 2, "Order ID": "O1", "Profit": 2.0},
        {**line, "Row ID": 3, "Order ID": "O2", "Profit": -1.0},
    ])
    ingest(row_rules(read_orders_stream(spark, inbox)), table, ckpt).awaitTermination()
    _write(inbox, "b.json", [
        {**line, "Row ID": 4, "Order ID": "O3", "Profit": 5.0, "Ship Date": "2014-01-03"},
        {**line, "Row ID": 5, "Order ID": None, "Profit": 5.0},
        {**line, "Row ID": 6, "Order ID": "O4", "Profit": 0.0},
    ])
    ingest(row_rules(read_orders_stream(spark, inbox)), table, ckpt).awaitTermination()
    # A restart with nothing new adds nothing.
    ingest(row_rules(read_orders_stream(spark, inbox)), table, ckpt).awaitTermination()
    landed = spark.read.schema(ORDERS_SCHEMA).parquet(table)
    assert sorted(r["Row ID"] for r in landed.collect()) == [1, 2, 4, 6]
    cleaned = C.clean_orders(landed)
    assert sorted((r["Order ID"], r["Row ID"]) for r in cleaned.collect()) == [("O1", 1), ("O4", 6)]


def test_a_bad_first_line_still_removes_its_order(spark):
    base = tempfile.mkdtemp(prefix="marginlens-stream-")
    inbox, table, ckpt = (os.path.join(base, n) for n in ("inbox", "table", "ckpt"))
    os.makedirs(inbox)
    line = {"Order Date": "1/1/2014", "Customer ID": "C1", "Product ID": "P1", "Quantity": 1, "Price": 10.0, "Profit": 1.0}
    rows = [
        {**line, "Row ID": 1, "Order ID": "O1", "Ship Date": "not a date"},
        {**line, "Row ID": 2, "Order ID": "O1", "Ship Date": "3/1/2014"},
        {**line, "Row ID": 3, "Order ID": "O2", "Ship Date": "3/1/2014"},
    ]
    _write(inbox, "a.json", rows)
    ingest(row_rules(read_orders_stream(spark, inbox)), table, ckpt).awaitTermination()
    batch = C.clean_orders(spark.read.schema(ORDERS_SCHEMA).json(inbox))
    streamed = C.clean_orders(spark.read.schema(ORDERS_SCHEMA).parquet(table))
    assert [r["Row ID"] for r in batch.collect()] == [r["Row ID"] for r in streamed.collect()] == [3]
