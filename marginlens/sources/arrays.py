"""JSON arrays of any size, read by many tasks.

A file that is one JSON array has no line ends to split it at, so Spark's own
multi-line reader gives each file to one task.  Here the text is read in byte
ranges, as pieces that end in ``}``.  Whether a piece begins inside a string, and
how deeply nested, depends on all text before it, but both are sums: each
range is summed up for either start (outside or inside a string), the sums are
composed along each file, and then every range knows how it begins and cuts its
own records.  A record that spans ranges is put together from its parts.

Only the sums, one row for each range of the scan (128 MB by default), meet in
one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marginlens.plans.session import written

#: Tasks of a scan at most, for each core: small ranges are dealt to them many at a time, and streamed.
TASKS_PER_CORE = 16
QUOTE, OPEN, CLOSE = 1, 2, 3
KINDS = np.zeros(256, np.uint8)
KINDS[list(b'"[{]}')] = QUOTE, OPEN, OPEN, CLOSE, CLOSE


def marks(chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Of whole pieces' bytes: the brackets' places, 1 or -1 for each, whether the quotes before it are odd, and all quotes."""
    kinds = KINDS[chunk]
    slashes = np.flatnonzero(chunk == ord("\\"))
    if len(slashes):  # the byte behind an odd run of them is escaped; a piece ends in a brace, so there is one
        first, last = np.ones(len(slashes), bool), np.ones(len(slashes), bool)
        first[1:] = last[:-1] = np.diff(slashes) > 1
        ends = slashes[last]
        kinds[ends[(ends - slashes[first]) % 2 == 0] + 1] = 0
    places = np.flatnonzero(kinds)
    kinds = kinds[places]
    odd = np.cumsum(kinds == QUOTE) % 2 == 1
    brackets = kinds != QUOTE
    return places[brackets], np.where(kinds[brackets] == OPEN, 1, -1), odd[brackets], len(odd) > 0 and bool(odd[-1])


def summary(chunks: Iterator[np.ndarray]) -> list[tuple[bool, int, int]]:
    """Of a range that begins outside and inside a string: how it ends, the change in depth and its lowest point."""
    out = [(False, 0, 0), (True, 0, 0)]
    for chunk in chunks:
        _, steps, odd, turned = marks(chunk)
        for i, (inside, depth, low) in enumerate(out):
            depths = depth + np.cumsum(steps[odd == inside])
            out[i] = inside ^ turned, int(depths[-1]) if len(depths) else depth, int(depths.min(initial=low))
    return out


def records(chunks: Iterator[np.ndarray], inside: bool, depth: int, base: int) -> Iterator[tuple[list[bytes], bool, bool]]:
    """The outermost objects of a range: texts, whether they began and whether they ended here."""
    parts: list[bytes] = []
    begun, open_ = False, depth > base
    for chunk in chunks:
        places, steps, odd, turned = marks(chunk)
        places, steps, text = places[odd == inside], steps[odd == inside], chunk.tobytes()
        depths = depth + np.cumsum(steps)
        starts = places[(steps > 0) & (depths == base + 1)].tolist()
        ends = (places[(steps < 0) & (depths == base)] + 1).tolist()
        if depth > base:
            parts.append(text[:ends[0]] if ends else text)
            if ends and open_:
                yield [b"".join(parts)], begun, True
            if ends:
                parts, ends, open_, begun = [], ends[1:], False, False
        whole = [text[a:b] for a, b in zip(starts, ends) if text[a] == ord("{")]
        if whole:
            yield whole, True, True
        if len(starts) > len(ends):
            open_ = begun = text[starts[-1]] == ord("{")
            parts = [text[starts[-1]:]]
        inside, depth = inside ^ turned, int(depths[-1]) if len(depths) else depth
    if open_:
        yield [b"".join(parts)], begun, False


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Neighbouring pieces of a range as one array of bytes, behind the range (file, start, then what is joined to it)."""
    for batch in batches:
        if not len(batch):
            continue
        file, start = batch.column(1), batch.column(2).to_numpy()
        other = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (start[1:] != start[:-1])
        pieces = batch.column(0).cast(pa.large_string())
        bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2], np.uint8)
        edges = [0, *(np.flatnonzero(other) + 1).tolist(), len(batch)]
        for lo, hi in zip(edges, edges[1:]):
            yield tuple(c[lo].as_py() for c in batch.columns[1:]), data[bounds[lo]:bounds[hi]]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[np.ndarray]]]:
    """Range by range: its chunks, to be read before the next range."""
    for key, chunks in groupby(_chunks(batches), lambda x: x[0]):
        yield key, (chunk for _, chunk in chunks)


BEGINS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("base", pa.int64()), ("inside", pa.bool_()), ("depth", pa.int64()), ("since", pa.int64())])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each range begins: inside a string, at what depth, and in which range its open record began.  Rows come by file and start."""
    for _, ranges in groupby((row for batch in batches for row in batch.to_pylist()), lambda row: row["file"]):
        inside, depth, since, base, out = False, 0, -1, None, []
        for row in ranges:
            base = int(row["array"]) if base is None else base
            out.append({"file": row["file"], "start": row["start"], "base": base, "inside": inside, "depth": depth, "since": since})
            end, change, low = (row["end1"], row["change1"], row["low1"]) if inside else (row["end0"], row["change0"], row["low0"])
            if depth + change > base and (depth <= base or depth + low <= base):
                since = row["start"]
            inside, depth = end, depth + change
        yield pa.RecordBatch.from_pylist(out, BEGINS)


def read_json_arrays(spark: SparkSession, path: str | list[str], schema: StructType | str) -> DataFrame:
    """The objects of JSON array files as rows of ``schema``, whatever the files' sizes.

    Fields bind by name as in Spark's reader: a missing field is NULL, an extra
    one is ignored, a malformed value is NULL.  Records are the outermost
    objects: of the array, or of a file that is not an array.  Elements that are
    no objects are skipped; a record cut off by the file's end is NULL but for
    the fields before the cut.  Empty files have no rows.  Building the
    plan reads the files once, for the ranges' sums.
    """
    meta = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    # The separator, the closing brace, is put back; behind a file's last one it closes nothing.
    pieces = spark.read.option("lineSep", "}").text(path).select(F.concat("value", F.lit("}")).alias("piece"), *meta)
    pieces = pieces.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), chunks in _ranges(batches):
            first = b""

            def seen() -> Iterator[np.ndarray]:
                nonlocal first
                for chunk in chunks:
                    first = first or start == 0 and chunk.tobytes().lstrip()[:1] or b""
                    yield chunk

            (end0, *outside), (end1, *inside) = summary(seen())
            made = [file, start, first == b"[", end0, *outside, end1, *inside]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in made], names=["file", "start", "array", "end0", "change0", "low0", "end1", "change1", "low1"])

    found = pieces.mapInArrow(sums, "file string, start long, array boolean, end0 boolean, change0 long, low0 long, end1 boolean, change1 long, low1 long")
    begins = written(found.repartition("file").sortWithinPartitions("file", "start").mapInArrow(
        _compose, "file string, start long, base long, inside boolean, depth long, since long"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, base, inside, depth, _), chunks in _ranges(batches):
            for texts, begun, ended in records(chunks, inside, depth, base):
                if begun and ended:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start, base, inside, depth, since), chunks in _ranges(batches):
            for texts, begun, ended in records(chunks, inside, depth, base):
                if not (begun and ended):
                    made = [file, start if begun else since, start, begun, texts[0].decode()]
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in made], names=["file", "since", "start", "begun", "text"])

    # One row of begins per range: at most one for each 128 MB of text.
    known = pieces.join(F.broadcast(begins), ["file", "start"]).select("piece", "file", "start", "base", "inside", "depth", "since")
    joined = known.mapInArrow(parts, "file string, since long, start long, begun boolean, text string").groupBy("file", "since").agg(
        F.max("begun").alias("object"), F.array_sort(F.collect_list(F.struct("start", "text"))).alias("parts")).filter("object").select(
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    texts = known.mapInArrow(whole, "text string").unionByName(joined)
    return texts.select(F.from_json("text", schema).alias("row")).select("row.*")
