import json
import os
import tempfile

import pytest
from pyspark.sql.utils import PythonException

from conftest import SF_SMALL
from marginlens.schemas import CUSTOMERS_SCHEMA, ORDERS_SCHEMA, PRODUCTS_SCHEMA
from marginlens.sources import files, views, workbook
from xlsx_fixture import write_xlsx

HEADER = CUSTOMERS_SCHEMA.fieldNames()


def scratch():
    return tempfile.mkdtemp(prefix="marginlens-test-")


def test_workbooks_folder(spark):
    d = scratch()
    write_xlsx(os.path.join(d, "a.xlsx"), [
        HEADER,
        ["C1", "Ann Lee", None, None, "1 Road", "Consumer", "US", "Austin", "Texas", 78701, "Central"],
        [None] * 11,
        ["C2", "Bo", "b@x.org", "555", None, "Corporate", "US", "Dallas", "Texas", 75201, "Central"],
    ])
    write_xlsx(os.path.join(d, "b.xlsx"), [HEADER, ["C3", "Cy", None, None, None, None, None, None, None, None, None]],
               inline_strings=True)
    with open(os.path.join(d, "notes.txt"), "w") as fh:
        fh.write("not a workbook")
    df = workbook.read_customers(spark, d)
    assert df.schema == CUSTOMERS_SCHEMA
    rows = {r["Customer ID"]: r for r in df.collect()}
    assert set(rows) == {"C1", "C2", "C3"}
    assert rows["C1"]["Postal Code"] == "78701" and rows["C1"]["email"] is None
    assert rows["C2"]["email"] == "b@x.org" and rows["C3"]["Customer Name"] == "Cy"


def test_workbook_header_must_match(spark):
    d = scratch()
    swapped = [HEADER[1], HEADER[0], *HEADER[2:]]
    write_xlsx(os.path.join(d, "bad.xlsx"), [swapped, ["Ann", "C1"]])
    with pytest.raises(PythonException, match="header mismatch"):
        workbook.read_customers(spark, d).collect()
    loose = workbook.read_customers(spark, d, strict_header=False).first()
    assert loose["Customer ID"] == "Ann"


def test_json_array_and_lines(spark):
    d = scratch()
    rows = [
        {"Row ID": 1, "Order ID": "O1", "Order Date": "1/1/2014", "Quantity": 2, "Price": 9.5, "Profit": 1.25,
         "extra": "ignored"},
        {"Row ID": "x", "Order ID": "O2", "Quantity": 3},
    ]
    with open(os.path.join(d, "orders.json"), "w") as fh:
        json.dump(rows, fh, indent=2)
    df = files.read_orders(spark, os.path.join(d, "orders.json"))
    assert df.schema == ORDERS_SCHEMA
    got = {r["Order ID"]: r for r in df.collect()}
    assert got["O1"]["Price"] == 9.5 and got["O1"]["Ship Date"] is None
    assert got["O2"]["Row ID"] is None and got["O2"]["Quantity"] == 3
    lines = os.path.join(d, "lines.json")
    with open(lines, "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in rows))
    assert files.read_orders(spark, lines, multi_line=False).count() == 2


def test_csv_header_checked(spark):
    d = scratch()
    good = os.path.join(d, "good.csv")
    with open(good, "w") as fh:
        fh.write("Product ID,Category,Sub-Category,Product Name,State,Price per product\n")
        fh.write('P1,Tech,Phones,"Phone, red",,199.99\n')
    df = files.read_products(spark, good)
    assert df.schema == PRODUCTS_SCHEMA
    row = df.first()
    assert row["Product Name"] == "Phone, red" and row["State"] is None and row["Price per product"] == 199.99
    bad = os.path.join(d, "bad.csv")
    with open(bad, "w") as fh:
        fh.write("Category,Product ID,Sub-Category,Product Name,State,Price per product\nTech,P1,Phones,X,,1\n")
    with pytest.raises(files.SourceError, match="header"):
        files.read_products(spark, bad)
    # A second file with another header fails the job that scans it.
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_products(spark, [good, bad]).collect()


def test_json_fields_can_be_required(spark):
    d = scratch()
    path = os.path.join(d, "orders.json")
    with open(path, "w") as fh:
        fh.write('[{"OrderID": "A-1", "Profit": 1.0}, {"OrderID": "A-2", "Profit": 2.0}]')
    assert files.read_orders(spark, path).count() == 2
    with pytest.raises(files.SourceError, match="Order ID"):
        files.read_orders(spark, path, strict_fields=True)


def test_strict_fields_finds_a_field_of_few_records(spark, tmp_path):
    names = files.ORDERS_SCHEMA.fieldNames()
    path = str(tmp_path / "sparse.json")
    with open(path, "w") as fh:
        for i in range(2000):
            fh.write(json.dumps({n: "1" for n in names if n != "Profit" or i in (700, 1300)}) + "\n")
    assert files.read_orders(spark, path, multi_line=False, strict_fields=True).count() == 2000


def test_missing_path_is_a_source_error(spark):
    with pytest.raises(files.SourceError, match="not found"):
        files.read_orders(spark, "/nonexistent/orders.json")
    with pytest.raises(files.SourceError):
        files.read_products(spark, "/nonexistent/products.csv")
    with pytest.raises(files.SourceError):
        workbook.read_customers(spark, "/nonexistent/folder")


def test_views(spark):
    c = spark.createDataFrame([("C1", "A")], ["Customer ID", "Customer Name"])
    o = spark.createDataFrame([("O1",)], ["Order ID"])
    p = spark.createDataFrame([("P1",)], ["Product ID"])
    names = views.register_raw_views(c, o, p)
    assert names == {"customers": "raw_customers_vw", "orders": "raw_orders_vw", "products": "raw_products_vw"}
    assert spark.sql("SELECT `Customer Name` FROM raw_customers_vw").first()[0] == "A"
    views.register_enriched_views(profit_summary=c)
    assert spark.table("profit_summary_view").count() == 1
    with pytest.raises(KeyError):
        views.register_enriched_views(unknown=c)


def test_workbook_records_round_trip_in_memory(spark):
    rows = [("C1", " Ann  <Lee> & co ", None, "", "x"), (None, "Bo", "b@x", "555", None)]
    schema = "`Customer ID` string, `Customer Name` string, email string, phone string, address string"
    df = spark.createDataFrame(rows, schema).repartition(2)
    from pyspark.sql.types import StructType
    back = workbook.decode_records(workbook.to_workbook_records(df), StructType.fromDDL(schema))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_large_workbook_streams_in_chunks():
    names = ["a", "b"]
    rows = [[str(i), None if i % 3 else f"x{i}"] for i in range(25)]
    content = workbook.encode_workbook(names, iter(rows))
    frames = list(workbook.iter_workbook_frames("w.xlsx", content, names, chunk_rows=10))
    assert [len(f) for f in frames] == [10, 10, 5]
    whole = workbook.decode_workbook("w.xlsx", content, names)
    assert whole.values.tolist() == [r for f in frames for r in f.values.tolist()]
    assert whole["a"].tolist() == [str(i) for i in range(25)]
    empty = workbook.decode_workbook("e.xlsx", workbook.encode_workbook(names, iter([])), names)
    assert len(empty) == 0 and list(empty.columns) == names


def test_orders_become_arrays_of_bounded_size_in_their_tasks():
    import pyarrow as pa

    from marginlens.plans import catalog

    rows = [json.dumps({"id": i}) for i in range(25_001)]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[a:a + 7_000])], names=["row"]) for a in range(0, len(rows), 7_000)]
    made = [json.loads(x) for batch in catalog._json_arrays(iter(batches)) for x in batch.column(0).to_pylist()]
    assert [len(x) for x in made] == [10_000, 10_000, 5_001] and [y["id"] for x in made for y in x] == list(range(25_001))
    assert list(catalog._json_arrays(iter([]))) == []


def test_ids_of_arrays_are_read_in_the_stream(spark, tmp_path):
    """A positioned read is the one way to a fraction's own text, so its absence shows in it; whole numbers are the same."""
    (tmp_path / "a.json").write_text('[{"Order ID": 1.50, "Customer ID": 123456789012345678901}]')
    setting = "spark.sql.json.enableExactStringParsing"
    before = spark.conf.get(setting)
    with files.numbers_in_stream(spark):
        row = files.read_orders(spark, str(tmp_path)).first()
    assert (row["Order ID"], row["Customer ID"]) == ("1.5", "123456789012345678901")
    assert spark.conf.get(setting) == before


def test_json_lines_round_trips_are_written_compressed(spark, monkeypatch):
    import glob

    from marginlens.plans import catalog

    kept = []
    monkeypatch.setattr(catalog, "read_once", lambda df, path: kept.append(path) or df)
    for name in ("s2_json_orders_roundtrip", "s4_accepted", "s4_quarantine"):
        assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    assert all(glob.glob(f"{p.removeprefix('file:')}/part-*.snappy") for p in kept) and len(kept) == 3
