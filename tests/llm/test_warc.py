"""WARC archives: exact round trips, revisits, independent readers."""

import glob
import random

import zstandard

from marginlens.llm import warc

SCHEMA = "page_id long, url string, html string, key string, digest string, first int"


def rows(seed=1):
    rnd = random.Random(seed)
    texts = [None, "", "short", "é中文 " * 50, "<p>" + "x" * 300_000 + "</p>", "\r\n\r\n", "P*M\x18\x00\x00\x00\x00 \x00"]
    out = [(i, f"http://h{i % 7}.example.org/{i}", rnd.choice(texts) if rnd.random() < 0.5 else f"<html>page {i} " + "words and markup " * rnd.randint(1, 40))
           for i in rnd.sample(range(10_000), 400)]
    return out + [(None, None, "no id"), (None, "u", "short"), out[0], out[0], (20_000, "http://a b/\n", "short")]


def want(rows, min_bytes):
    first = {}
    for i, _, h in rows:
        h, i = (h or "").encode(), warc.LAST_ID if i is None else i
        first[h] = min(first.get(h, i), i)
    out, used = [], set()
    for i, _, h in rows:
        h, key = (h or "").encode(), warc.LAST_ID if i is None else i
        response = len(h) < min_bytes or (key == first[h] and h not in used)
        if response:
            used.add(h)
        refers = None if response or first[h] == warc.LAST_ID else first[h]
        out.append((i, len(h), warc.digest_text(h), "response" if response else "revisit", refers, h if response else None))
    return sorted(out, key=repr)


def test_round_trip_and_any_zstandard_reader(spark, tmp_path, monkeypatch):
    data = rows()
    df = spark.createDataFrame([(*r, "k", "d", 1) for r in data], SCHEMA)
    for min_bytes, size in ((0, 1 << 16), (6, 8 << 20)):
        monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
        path = f"{tmp_path}/{min_bytes}"
        warc.write_archives(df, path, min_bytes)
        got = warc.read_archives(spark, path)
        keep = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        assert sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in got.select(keep).collect()), key=repr) == want(data, min_bytes)
        files = [f for f in glob.glob(f"{path}/part-*")]
        assert len(files) > 1 or size > 1 << 16
        for f in files:  # one pass of a plain streaming reader over the whole archive
            raw = open(f, "rb").read()
            if not raw:
                continue
            assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY
            size_ = int.from_bytes(raw[4:8], "little")
            reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size_]))
            assert reader.stream_reader(raw, read_across_frames=True).read().startswith(b"WARC/1.1\r\n")


def test_empty_and_tiny_tables(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], SCHEMA), f"{tmp_path}/none")
    assert warc.read_archives(spark, f"{tmp_path}/none").collect() == []
    warc.write_archives(spark.createDataFrame([(1, "u", "x", "k", "d", 1)], SCHEMA), f"{tmp_path}/one")
    assert [r.payload_bytes for r in warc.read_archives(spark, f"{tmp_path}/one").collect()] == [1]


def test_query_on_whole_pages(spark):
    path = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in warc.op4_warc(spark, path).collect())
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{path}/pages.parquet").collect()]
    assert got == sorted(r[:5] for r in want(pages, 0))
