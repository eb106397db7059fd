"""N-gram Jaccard self-join by token-combination prefixes, down to components.

A document's set are the keys of its distinct word shingles.  Two sets with
Jaccard similarity t or more share the first k of their common tokens within
prefixes of ``n - ceil(t n) + k`` tokens, in any global order of the tokens.
The order used here has three parts: tokens of a fixed share of the hash
space by ascending document frequency, then the others by hash.  Only that
share of the tokens is ever counted or shuffled, and a document whose prefix
holds nothing but tokens of its own is done at once.

Of the others, tokens of the 1-prefix that are rare are indexed singly.  For
frequent ones the prefix is extended by one token, and pairs (2-combinations)
of its frequent tokens are indexed (for large sets, whose pairs would be too
many, frequent tokens are indexed singly again; sets near the border have
both).  Rows of a small bucket become pairs, filtered by an exact upper bound
of the intersection.  The documents of large buckets are joined among themselves
once more, now with all their tokens counted: pages that share a template but
not their text then have prefixes of their own tokens and leave.  What still
fills a large bucket are near copies; they are tied to one hub only, so that
no group ever emits all its pairs.  The candidate graph's components are cut
into blocks of bounded size, and each task verifies a pair of blocks with the
whole sets.  Verified links give the components.

Equal sets are one class from the start, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlens.llm.components import Forest, components
from marginlens.llm.scratch import cut
from marginlens.llm.textkeys import shingle_keys, slices, word_keys

#: Tokens in more documents than this are frequent; buckets up to it are expanded into pairs.
FREQUENT = 16
#: Frequent tokens are combined in pairs in 1-prefixes of up to this length.
COMBINED = 26
#: Ranges of the hash space whose counts bound an intersection.
RANGES = 32
#: Documents and tokens of a block that is verified at once.
BLOCK_DOCS, BLOCK_TOKENS = 512, 2_000_000
#: Candidate documents up to this number are broadcast (after counting) to the second scan.
BROADCAST_ROWS = 1_000_000


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle keys of each text."""
    for words in word_keys(column):
        yield np.unique(shingle_keys(words, size))


def signature(keys: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(keys.tobytes())


def range_counts(keys: np.ndarray) -> np.ndarray:
    return np.bincount((keys >> np.uint64(59)).astype(np.int64), minlength=RANGES)


def _lists(parts: list[np.ndarray], kind) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind)))


def sketches(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row: ``rid, doc_id, n, sig``, counts per hash range, the tokens of
    the counted share, and as many others as the extended prefix may need;
    columns behind ``doc_id, text`` (longs) are handed on."""
    more = docs.columns[2:]
    share = np.uint64(int(min(0.999, 1.5 * (1 - percent / 100)) * 2**64))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, sig, counts, counted, others = [], [], [], [], []
            for keys in shingle_sets(batch.column(1), size):
                inside = int(np.searchsorted(keys, share))
                need = max(0, prefix_length(len(keys), percent) + 1 - inside)
                n.append(len(keys))
                sig.append(signature(keys))
                counts.append(range_counts(keys))
                counted.append(keys[:inside].view(np.int64).copy())
                others.append(keys[inside:inside + need].view(np.int64).copy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(sig, pa.binary()),
                 _lists(counts, np.int32), _lists(counted, np.int64), _lists(others, np.int64), *batch.columns[2:]],
                names=["doc_id", "n", "sig", "counts", "tokens", "others", *more])

    schema = ", ".join(["doc_id long, n int, sig binary, counts array<int>, tokens array<long>, others array<long>",
                        *[f"{c} long" for c in more]])
    made = docs.select(F.col("doc_id").cast("long"), "text", *more).mapInArrow(sketch, schema)
    return cut(made.withColumn("rid", F.monotonically_increasing_id()))


def index_keys(n: int, n_tokens: int, shared: list[tuple[int, int]], others: list[int], percent: int) -> list[tuple[int, int]]:
    """Keys under which a set is indexed: (token, 0) or (token, token).

    ``shared`` are (frequency, token) of its counted tokens that more than one
    document has; ``n_tokens`` counts the counted tokens in all.
    """
    p = prefix_length(n, percent)
    left = p - (n_tokens - len(shared))  # of the 1-prefix, behind the set's own tokens
    if left <= 0:
        return []
    order = [(c, t) for c, t in sorted(shared)] + [(0, t) for t in others]
    first, last = order[:left], order[left:left + 1]
    # linked sets are both up to border / t in size, or both at least t * border
    border = 100 * (COMBINED - 1) // (100 - percent)
    combine, single = n * percent <= border * 100, n * 100 >= border * percent
    if percent <= 50 and percent * n <= 100:  # one shared token may be enough for a link
        single = True
    keys = [(t, 0) for c, t in first if c <= FREQUENT or single]
    if combine:
        often = [t for c, t in first if c > FREQUENT or c == 0]
        if any(c > FREQUENT for c, _ in first):
            often += [t for _, t in last]
            keys += [(a, b) for i, a in enumerate(often) for b in often[i + 1:]]
    return keys


def candidate_index(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b, rid``: the keys of each class representative."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, rid = [], [], []
            for r, n, k, shared, others in zip(*(c.to_pylist() for c in batch.columns)):
                pairs = [(x["c"], x["t"]) for x in shared or []]
                for x, y in index_keys(n, k, pairs, others, percent):
                    a.append(x)
                    b.append(y)
                    rid.append(r)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, rid)], names=["a", "b", "rid"])

    return rows.select("rid", "n", "n_tokens", "shared", "others").mapInArrow(index, "a long, b long, rid long")


def enough(inner: Column | int, total: Column | int, percent: int):
    """100 * intersection >= percent * union, for an intersection and the sum of both sizes."""
    return inner * (100 + percent) >= total * percent


def fetched(docs: DataFrame, wanted: DataFrame, size: int, more: list[str]) -> DataFrame:
    """``rid``, the ``more`` columns (ints) and ``keys`` (the whole set) of the rows
    of ``wanted`` (``rid, wanted_id, sig``), by a second scan of the texts."""
    rows = wanted.count()
    right = F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted
    found = docs.select(F.col("doc_id").cast("long"), "text").join(right, F.col("doc_id").eqNullSafe(F.col("wanted_id")))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep, sets = [], []
            for i, keys in enumerate(shingle_sets(batch.column(0), size)):
                if signature(keys) == batch.column(2)[i].as_py():
                    keep.append(i)
                    sets.append(keys.tobytes())
            rows = batch.take(pa.array(keep, pa.int32()))
            yield pa.RecordBatch.from_arrays([rows.column(1), *rows.columns[3:], pa.array(sets, pa.binary())], names=["rid", *more, "keys"])

    kinds = {f.name: f.dataType.simpleString() for f in wanted.schema.fields}
    schema = ", ".join(["rid long", *[f"{c} {kinds[c]}" for c in more], "keys binary"])
    return found.select("text", "rid", "sig", *more).mapInArrow(sets_of, schema)


def counted_whole(sets: DataFrame) -> DataFrame:
    """Sketches (as :func:`sketches` gives them) with all tokens in the counted share."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = [np.frombuffer(k, np.uint64) for k in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(k) for k in keys], pa.int32()), _lists([range_counts(k) for k in keys], np.int32),
                 _lists([k.view(np.int64) for k in keys], np.int64), _lists([k[:0].view(np.int64) for k in keys], np.int64)],
                names=["rid", "n", "counts", "tokens", "others"])

    # Rows that repeat an id may be fetched twice; the shuffle also keeps a task from holding two Python workers.
    once = sets.select("rid", "keys").dropDuplicates(["rid"])
    return cut(once.mapInArrow(whole, "rid long, n int, counts array<int>, tokens array<long>, others array<long>"))


def candidate_edges(sketched: DataFrame, classes: DataFrame, percent: int, docs: DataFrame | None = None, size: int = 0) -> DataFrame:
    """``u, v``: edges of a graph whose components hold every link between classes.

    With ``docs`` the documents of large buckets are joined once more, by all
    their tokens; without, large buckets become stars.
    """
    tokens = sketched.select("rid", F.explode("tokens").alias("t"))
    counts = cut(tokens.groupBy("t").agg(F.count(F.lit(1)).cast("int").alias("c")).filter("c > 1"))
    shared = tokens.join(counts, "t").groupBy("rid").agg(F.collect_list(F.struct("c", "t")).alias("shared"))
    alpha = F.ceil(F.col("n") * F.lit(percent) / 100)
    rows = (
        sketched.filter("n > 0").select("rid", "n", F.size("tokens").alias("n_tokens"), "others")
        .join(classes.select(F.col("cls").alias("rid")), "rid", "left_semi")
        .join(shared, "rid", "left")
        .filter(F.col("n_tokens") - F.coalesce(F.size("shared"), F.lit(0)) < F.col("n") - alpha + 1)
    )
    index = cut(candidate_index(rows, percent))
    buckets = cut(index.groupBy("a", "b").agg(F.count(F.lit(1)).alias("m"), F.min("rid").alias("hub")).filter("m > 1"))
    placed = cut(index.join(buckets, ["a", "b"]))
    large = placed.filter(F.col("m") > FREQUENT)
    r, size_of = F.col("r"), F.size("r")
    pairs = (
        placed.filter(F.col("m") <= FREQUENT).groupBy("a", "b").agg(F.array_sort(F.collect_set("rid")).alias("r"))
        .filter(size_of > 1)
        .select(F.explode(F.flatten(F.transform(
            F.sequence(F.lit(0), size_of - 2),
            lambda i: F.transform(F.slice(r, i + 2, size_of), lambda y: F.struct(y.alias("u"), F.get(r, i).alias("v")))))).alias("p"))
        .select("p.u", "p.v").distinct()
    )
    known = sketched.select("rid", "n", "counts")
    bound = F.aggregate(F.zip_with("counts", "counts_v", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    close = (
        pairs.join(known.withColumnRenamed("rid", "u"), "u")
        .join(known.select(F.col("rid").alias("v"), F.col("n").alias("n_v"), F.col("counts").alias("counts_v")), "v")
        .filter(enough(bound, F.col("n") + F.col("n_v"), percent)).select("u", "v")
    )
    if docs is None:
        return large.filter("rid != hub").select(F.col("rid").alias("u"), F.col("hub").alias("v")).distinct().union(close)
    crowd = cut(large.select("rid").distinct().join(sketched.select("rid", F.col("doc_id").alias("wanted_id"), "sig"), "rid"))
    if crowd.isEmpty():
        return close
    return close.union(candidate_edges(counted_whole(fetched(docs, crowd, size, [])), classes, percent))


def verified(rid: list[int], block: list[int], sets: list[np.ndarray], across: bool, percent: int) -> list[tuple[int, int]]:
    """Star edges over the links between sets of one block, or ``across`` two.

    Pairs whose ends are already connected are not compared again.
    """
    order = sorted(range(len(rid)), key=lambda i: len(sets[i]))
    size = np.array([len(sets[i]) for i in order])
    ids = np.array([rid[i] for i in order])
    side = np.array([block[i] for i in order])
    counts = np.array([range_counts(sets[i]) for i in order])
    label, forest = np.arange(len(order)), Forest()
    for x, i in enumerate(order):
        end = int(np.searchsorted(size, size[x] * 100 // percent, "right"))
        near = np.arange(x + 1, end)
        near = near[label[near] != label[x]]
        if across:
            near = near[side[near] != side[x]]
        if not len(near):
            continue
        bound = np.minimum(counts[x], counts[near]).sum(1)
        for y in near[enough(bound, size[x] + size[near], percent)].tolist():
            if label[y] == label[x]:
                continue
            both = len(np.intersect1d(sets[i], sets[order[y]], assume_unique=True))
            if enough(both, int(size[x] + size[y]), percent):
                label[label == label[y]] = label[x]
                forest.join(int(ids[x]), int(ids[y]))
    return [(u, v) for u, v in forest.stars() if u != v]


def verified_links(docs: DataFrame, sketched: DataFrame, edges: DataFrame, size: int, percent: int) -> DataFrame:
    """``u, v``: links among the classes that ``edges`` connect, enough to connect what is linked."""
    blobs = components(edges)
    named = cut(blobs.join(sketched.select(F.col("rid").alias("node"), "doc_id", "sig", "n"), "node"))
    blocks = named.groupBy("label").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    wanted = cut(named.join(blocks, "label").select(
        F.col("node").alias("rid"), F.col("doc_id").alias("wanted_id"), "sig", "label", "blocks"))
    sets = fetched(docs, wanted, size, ["label", "blocks"])
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    dealt = (
        sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .select("label", "i", "j", "own", "rid", "keys")
        .repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
    )

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, held = None, {}

        def done():
            rid = sorted(held)
            return verified(rid, [held[r][0] for r in rid], [np.frombuffer(held[r][1], np.uint64) for r in rid],
                            group[1] != group[2], percent)

        for batch in batches:
            out = []
            for label, i, j, own, rid, keys in batch.itertuples(index=False):
                if (label, i, j) != group:
                    if group:
                        out += done()
                    group, held = (label, i, j), {}
                held[rid] = (own, keys)
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
        if group:
            yield pd.DataFrame(done(), columns=["u", "v"], dtype="int64")

    return dealt.mapInPandas(links, "u long, v long").distinct()  # so links and their contraction share no task


def text_keys(text: Column | str) -> list[Column]:
    """128 bits of a text as two longs, ``key_a, key_b``."""
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit("second"), text).alias("key_b")]


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80, keyed: bool = False) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a set are the
    distinct ``size``-word shingles, or the whole sequence of fewer words.
    Rows link when 100 * intersection >= percent * union; ``component_id`` is
    the smallest ``doc_id`` reachable by links.  NULL or empty texts have no
    shingles and are linked with nothing (their component is their own id).
    Repeated rows are rows of their own; a NULL id is a document whose
    component has the smallest id that is not NULL, if any.  Other columns,
    whatever their names, are ignored.

    ``keyed`` adds the ``text_keys`` of the row and ``component``, a number of
    its component that no other has, also where ids are NULL or repeated (NULL
    without shingles).
    """
    if not 50 <= percent <= 99:
        raise ValueError("percent must lie between 50 and 99")
    more = text_keys("text") if keyed else []
    docs = docs.select("doc_id", "text")
    sketched = sketches(docs.select("doc_id", "text", *more), size, percent)
    classes = cut(sketched.filter("n > 0").groupBy("sig").agg(F.min("rid").alias("cls"), F.min("doc_id").alias("least")))
    links = verified_links(docs, sketched, candidate_edges(sketched, classes, percent, docs, size), size, percent)
    linked = components(links)
    least = classes.join(linked.withColumnRenamed("node", "cls"), "cls")
    whole = least.groupBy("label").agg(F.min("least").alias("component"))
    named = least.join(whole, "label").select("cls", "component", "label")
    final = classes.join(named, "cls", "left").select(
        "sig", F.coalesce("component", "least").alias("component"), F.coalesce("label", "cls").alias("label"))
    return sketched.join(final, "sig", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        *(["key_a", "key_b", F.col("label").alias("component")] if keyed else []))


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=3, percent=90)
