"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Documents become byte-level BPE ids plus one end id; only documents longer
than the capacity are cut, into full pieces after a first one that may be
shorter.  Pieces are dealt to groups of bounded size, and each group is packed
by bounded-space online best fit: a fixed number of open bins is kept in a
bitset keyed by free space, a piece goes to the bin whose free space fits it
best, and when a new bin is needed and none may be opened, the fullest closes.

Pieces are written once as a checkpoint before they are packed, so a retried
task packs the same rows in the same order and lost executors change nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlens.llm.scratch import cut

#: Unicode white space, as the tokenizer's pattern takes it.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Chunks whose ids a task remembers; beyond it they are encoded each time.
MEMO = 400_000


class ChunkIds(dict):
    """Little-endian uint32 ids of a chunk, encoded once each.

    No match of the tokenizer's pre-split pattern runs from other characters
    on into white space, so a text's ids are those of its chunks (leading
    white space plus the characters up to the next) one after another.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary

    def __missing__(self, chunk: str) -> bytes:
        ids = np.asarray(self.encode(chunk), dtype="<u4").tobytes()
        if len(self) < MEMO:
            self[chunk] = ids
        return ids


def text_encoder(tokenizer_path: str):
    """``str -> bytes`` of little-endian uint32 ids.

    Ids are those of the ``tokenizers`` file.  When the same vocabulary lies
    beside it as ranks (``.tiktoken``), chunks are encoded from that, several
    times faster and id for id the same; texts that spell a special token
    always go through the ``tokenizers`` file.
    """
    import os

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)

    def whole(text: str) -> bytes:
        return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    ranks = tokenizer_path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks):
        return whole
    import public_tokenizers

    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    memo, chunks = ChunkIds(ranks, public_tokenizers.PATTERN), re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall
    get = memo.__getitem__

    def by_chunks(text: str) -> bytes:
        if any(s in text for s in specials):
            return whole(text)
        return b"".join(map(get, chunks(text)))

    return by_chunks


def cut_points(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one up to ``capacity``, else
    full pieces after a first one that takes the remainder."""
    first = n_ids if n_ids <= capacity else n_ids % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n_ids, capacity))]


def document_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                    keep_ids: bool = False) -> DataFrame:
    """Pieces of every row's ``text``: ``doc_id, piece, start, length,
    ids_crc32`` (and ``ids``, binary, with ``keep_ids``).

    NULL text counts as empty, which is one piece of the end id alone.
    Repeated rows and NULL ids are packed like any others; other columns,
    whatever their names, are ignored.
    """
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(tokenizer_path)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + length)]
                    rows.append((doc_id, k, start, length, zlib.crc32(part), *([part] if keep_ids else [])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, schema)


def best_fit(lengths, capacity: int, open_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length, in the order they come.

    ``open_bins`` bins at most are open; bit f of the set says that some open
    bin has f places free.  The lowest set bit at or above a length is the
    best fit, and the lowest set bit of all is the fullest bin.
    """
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    bits = is_open = made = 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, length in enumerate(lengths):
        fits = bits >> length
        if fits:
            f = length + (fits & -fits).bit_length() - 1
            b = free[f].pop()
            is_open -= 1
            if not free[f]:
                bits ^= 1 << f
        else:
            if is_open >= open_bins:
                f = (bits & -bits).bit_length() - 1
                free[f].pop()
                is_open -= 1
                if not free[f]:
                    bits ^= 1 << f
            f, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - f
        left = f - length
        if left:
            free[left].append(b)
            bits |= 1 << left
            is_open += 1
    return bins, offsets


def pack_pieces(pieces: DataFrame, capacity: int = 1024, open_bins: int = 16_384,
                pieces_per_group: int = 250_000) -> DataFrame:
    """``pieces`` with the sequence each lies in and its place there.

    Rows are dealt at random to ``count / pieces_per_group`` groups, and each
    group is packed by one task, so a task holds a bounded number of (narrow)
    rows at any size of the corpus.  Pieces come in a fixed random order, in
    runs of ``open_bins``, long ones of a run first: no bin has to close within
    a run, and its short pieces fill what the long ones left.  Lengths must lie between 1 and
    ``capacity``.  Adds ``sequence_id`` and ``offset`` (long); ``rid`` is the
    piece's number in the checkpoint.
    """
    pieces = cut(pieces.withColumn("rid", F.monotonically_increasing_id()))
    groups = max(1, math.ceil(pieces.count() / pieces_per_group))
    narrow = pieces.select("rid", F.col("length").cast("int").alias("length"), F.xxhash64("rid").alias("h"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        got = list(batches)
        if not got:
            return
        rows = pd.concat(got).sort_values(["h", "rid"], ignore_index=True)
        run = np.arange(len(rows)) // open_bins
        rows = rows.iloc[np.lexsort((np.arange(len(rows)), -rows["length"].to_numpy(), run))]
        bins, offsets = best_fit(rows["length"].tolist(), capacity, open_bins)
        group = TaskContext.get().partitionId()
        yield pd.DataFrame({"rid": rows["rid"].to_numpy(), "sequence_id": (group << 40) + bins, "offset": offsets})

    placed = narrow.repartition(groups, "h").mapInPandas(pack, "rid long, sequence_id long, offset long")
    return pieces.join(placed, "rid")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                   open_bins: int = 16_384, keep_ids: bool = False) -> DataFrame:
    """Documents cut into pieces and packed: ``document_pieces`` columns plus
    ``sequence_id`` and ``offset``.  Documents are packed to at most
    ``capacity`` tokens a sequence, gapless from offset 0."""
    return pack_pieces(document_pieces(docs, tokenizer_path, capacity, end_id, keep_ids), capacity, open_bins).drop("rid")


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
