"""Records that don't fit the schema, handed back instead of turned into NULLs."""

import pytest

from marginlens.sources import files

HEADER = "Product ID,Category,Sub-Category,Product Name,State,Price per product"


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"Row ID": 1, "Order ID": "A", "Quantity": 2, "Extra": true}\n{"Row ID": 2, "Order ID": "B"\n'
        '{"Row ID": "x", "Order ID": "C"}\n\n{"Order ID": "D", "Profit": 1.5}\nnot json\n')
    split = files.read_orders(spark, str(tmp_path), multi_line=False, quarantined=True)
    assert sorted(r["Order ID"] for r in split.accepted.collect()) == ["A", "D"]
    assert sorted(r["Order ID"] for r in split.accepted.select("Order ID").collect()) == ["A", "D"]
    assert split.accepted.count() == 2 and split.rejected.count() == 3
    got = split.rejected.collect()
    assert {r.record for r in got} == {'{"Row ID": 2, "Order ID": "B"', '{"Row ID": "x", "Order ID": "C"}', "not json"}
    assert all(r.file.endswith("a.json") for r in got)
    assert split.rejected.select("record").count() == 3


def test_json_array_file(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"Row ID": 1, "Order ID": "A"}, {"Row ID": 2, "Order ID": "B"}]')
    (tmp_path / "bad.json").write_text('[{"Row ID": 3, "Order ID": "C"}, {"Row ID"')
    split = files.read_orders(spark, str(tmp_path), quarantined=True)
    assert {r["Order ID"] for r in split.accepted.collect()} >= {"A", "B"}
    assert [r.file.rsplit("/", 1)[-1] for r in split.rejected.select("file").distinct().collect()] == ["bad.json"]


def test_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text(f"{HEADER}\nP1,A,B,N,S,1.5\nP2,A,B,N,S,cheap\nP3,A,B\nP4,A,B,N,S,2\n")
    split = files.read_products(spark, str(tmp_path), quarantined=True)
    assert sorted(r["Product ID"] for r in split.accepted.collect()) == ["P1", "P4"]
    assert {r.record for r in split.rejected.collect()} == {"P2,A,B,N,S,cheap", "P3,A,B"}
    with pytest.raises(files.SourceError, match="header"):
        (tmp_path / "q").mkdir()
        (tmp_path / "q" / "q.csv").write_text("a,b\n1,2\n")
        files.read_products(spark, str(tmp_path / "q"), quarantined=True)


def test_failures_at_load_and_at_action_are_one_type(spark, tmp_path):
    with pytest.raises(files.SourceError, match="path not found"):
        files.read_orders(spark, str(tmp_path / "none"), quarantined=True)
    (tmp_path / "p.csv").write_text(f"{HEADER}\nP1,A,B,N,S,1.5\n")
    (tmp_path / "q.csv").write_text(HEADER.replace("Category", "Kind", 1) + "\nP2,A,B,N,S,1\n")
    with pytest.raises(files.SourceError, match="products"):
        with files.source_errors("products", str(tmp_path)):
            files.read_products(spark, str(tmp_path)).collect()
