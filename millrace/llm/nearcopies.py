"""Near copies by similarity: documents that share ``LEAST`` of their word shingles (Jaccard, of sets).

A document is the set of its shingles of ``WIDTH`` words; equal sets are one
node. Pairs are proposed by the SimHash operator, whose covering tables find
every two fingerprints of these shingles within its radius. Sets of similarity
0.8 mostly differ in more bits than any affordable radius, so the rest is
proposed by rare shingles: two sets of that similarity share one of the rarest
fifth of either's shingles, in any order of rarity that is the same for all. The
order is by the number of sets that hold a shingle, counted exactly. So sets
with a fifth of shingles of their own meet nobody, and documents which share
passages and little else do not meet, however large the table. Every proposed
pair that its sketches do not rule out is verified on the whole sets, so no
other pair is linked, and none is lost.

No bucket of a shingle gives all its pairs. First each member is compared with
one of them, its pivot; that joins groups of copies, however large. Only members
that are then in different components are compared with each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, materialize, release, slices, text_hash, written
from .simhash import components, keep_one, links, majority

WIDTH = 5
LEAST = 0.8
#: Hashes are counted in at least so many regions, of about so many shingles at most.
REGIONS = 256
REGION_SHINGLES = 1 << 23
#: Characters of the texts whose sets are dealt to the regions at a time.
_DEALT_CHARS = 1 << 20


def shingle_hashes(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of the text's shingles, in order (words as in ``simhash.fingerprint``; a shorter text is one shingle)."""
    words = (text or "").encode().lower().split()
    k = min(width, len(words))
    return np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)] if words else [], np.uint64)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted hashes of the text's distinct shingles."""
    return np.unique(shingle_hashes(text, width))


def set_hash(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes())


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty ones are equal."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def sketch(shingles: np.ndarray) -> bytes:
    """How many of a set's shingles fall into each of one to two times fewer cells, by their lowest bits; nothing if a
    cell has more than a byte holds."""
    cells = 1 << max(0, (len(shingles) - 1).bit_length() - 1)
    counts = np.bincount((shingles & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return counts.astype(np.uint8).tobytes() if len(shingles) and counts.max() <= 255 else b""


def most_similar(a: bytes, b: bytes) -> float:
    """What the similarity of two sets can be at most, by their sketches: no cell holds more common shingles than the
    lesser of its counts."""
    if not a or not b:
        return 1.0
    x, y = sorted((np.frombuffer(s, np.uint8).astype(np.int64) for s in (a, b)), key=len)
    y = y.reshape(-1, len(x)).sum(0)
    both = int(np.minimum(x, y).sum())
    return both / (int(x.sum()) + int(y.sum()) - both)


def _sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, tid, node`` (a hash of the set), ``n`` (its size), ``fp`` (the SimHash of its shingles) for every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nodes, sizes, fps = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text)
                nodes.append(set_hash(own))
                sizes.append(len(own))
                fps.append(majority(own))
            signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, fps)]
            columns = [batch.column(0), batch.column(2), signed[0], pa.array(sizes, pa.int64()), signed[1]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tid", "node", "n", "fp"])

    out = f"doc_id {kind}, tid long, node long, n long, fp long"
    return docs.select(F.col(id_col).alias("doc_id"), text_col, text_hash(F.col(text_col)).alias("tid")).mapInArrow(run, out)


def _parts(docs: DataFrame, text_col: str, bits: int) -> DataFrame:
    """``region, nodes, counts, low``: of the sets of some documents those that have shingles whose first ``bits`` bits
    are ``region``, how many each, and the low seven bytes of these. A pair of set and shingle takes 7 to 19 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in byte_slices((t for batch in slices(batches) for t in batch.column(0).to_pylist()), _DEALT_CHARS):
            sets = {set_hash(own): own for own in map(shingle_set, texts)}
            nodes = np.array(list(sets), np.uint64)
            values = np.concatenate(list(sets.values()))
            whose = np.repeat(np.arange(len(nodes)), [len(own) for own in sets.values()])
            region = values >> np.uint64(64 - bits)
            order = np.argsort(region, kind="stable")  # a set's shingles stay together
            low = values[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
            regions, starts = np.unique(region[order], return_index=True)
            columns = [[], [], []]
            for start, end in zip(starts, [*starts[1:], len(order)], strict=True):
                own, counts = np.unique(whose[order[start:end]], return_counts=True)
                for column, part in zip(columns, (nodes[own], counts.astype(np.uint32), low[start:end]), strict=True):
                    column.append(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(regions.astype(np.int64)), *(pa.array(c, pa.binary()) for c in columns)], names=["region", "nodes", "counts", "low"])

    return docs.select(text_col).mapInArrow(run, "region long, nodes binary, counts binary, low binary")


def shared_shingles(values: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs of ``values`` and ``nodes`` each one whose value several nodes have, once: value, node, how many."""
    order = np.argsort(values, kind="stable")
    values, same = values[order], np.zeros(len(values) + 1, bool)
    same[1:-1] = values[1:] == values[:-1]
    again = same[1:] | same[:-1]  # most are there once
    values, nodes = values[again], nodes[order[again]]
    order = np.lexsort((nodes, values))
    values, nodes = values[order], nodes[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (nodes[1:] != nodes[:-1])  # copies of a set are one
    values, nodes = values[first], nodes[first]
    _, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    several = counts[at] > 1
    return values[several], nodes[several], counts[at][several]


def _shared(docs: DataFrame, text_col: str, total: int) -> DataFrame:
    """``node, value, sets``: the shingles of every set that others have too, and how many sets have them. ``total``:
    about how many shingles there are."""
    bits = max(REGIONS - 1, total // REGION_SHINGLES).bit_length()

    def run(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        nodes, counts, low = (np.frombuffer(b"".join(parts[c].to_pylist()), kind) for c, kind in (("nodes", np.uint64), ("counts", np.uint32), ("low", np.uint8)))
        values = np.empty((len(low) // 7, 8), np.uint8)
        values[:, :7] = low.reshape(-1, 7)
        values[:, 7] = key[0].as_py() >> (bits - 8)
        value, node, sets = shared_shingles(values.view("<u8").ravel(), np.repeat(nodes, counts))
        return pa.table({"node": node.view(np.int64), "value": value.view(np.int64), "sets": sets.astype(np.int64)})

    return _parts(docs, text_col, bits).groupBy("region").applyInArrow(run, "node long, value long, sets long")


def _rare(docs: DataFrame, nodes: DataFrame, text_col: str, least: float) -> DataFrame:
    """``value, node, n, pos``: the shingles of which a set must share one with any set of similarity ``least``, those
    that no other set has left out.

    Sets of n and m shingles that are as similar have least * max(n, m) in common, so those that are not among the last
    least * n - 1 of the one cannot all be missing from the first of the other. The first are the rarest.
    """
    total = nodes.agg(F.sum("n")).first()[0] or 0
    shared = _shared(docs, text_col, total).repartition("node").groupBy(F.col("node").alias("of")).agg(F.sort_array(F.collect_list(F.struct("sets", "value"))).alias("shared"))
    own = F.col("n") - F.size("shared")  # they come first
    first = F.col("n") - F.ceil(F.lit(least) * F.col("n") - F.lit(1e-9)) + 1
    some = nodes.select("node", "n").join(shared, F.col("node") == F.col("of")).withColumn("own", own)
    some = some.select("node", "n", "own", F.posexplode(F.slice("shared", F.lit(1), F.greatest(first - F.col("own"), F.lit(0)).cast("int"))).alias("nth", "one"))
    return some.select(F.col("one.value").alias("value"), "node", "n", (F.col("own") + F.col("nth")).alias("pos"))


def _made(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, text_col: str, make: Callable[[np.ndarray], bytes]) -> DataFrame:
    """``node, own``: what ``make`` makes of the sorted set of each node in ``pairs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            own = [make(shingle_set(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], names=["node", "own"])

    some = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = nodes.join(some, "node", "left_semi").select("node", "tid")
    texts = docs.select(F.col(text_col).alias("text"), text_hash(F.col(text_col)).alias("text_tid"))
    texts = texts.join(wanted, F.col("text_tid") == F.col("tid")).select("node", "text").dropDuplicates(["node"])  # texts of one hash are one text
    return texts.mapInArrow(run, "node long, own binary")


def _exact(x: bytes, y: bytes) -> float:
    return similarity(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))


def _near(pairs: DataFrame, made: DataFrame, measure: Callable[[bytes, bytes], float], least: float) -> DataFrame:
    """The ``pairs`` (``a, b``) for which the ``measure`` of what is ``made`` of both is ``least`` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            near = [measure(x.as_py(), y.as_py()) >= least for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            keep = pa.array(np.flatnonzero(near), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])

    x, y = (made.select(F.col("node").alias(end), F.col("own").alias(side)) for end, side in zip("ab", "xy", strict=True))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, text_col: str, least: float) -> DataFrame:
    """The ``pairs`` (``a, b``) whose sets are as similar as ``least``.

    Every pair takes something of both its ends through a join. First that is the sketch, a tenth of the set in size,
    which tells whether the pair can be as similar at all; whole sets are made for what is left.
    """
    sketches = materialize(_made(docs, nodes, pairs, text_col, sketch), "copies-sketches")
    able = materialize(_near(pairs, sketches, most_similar, least), "copies-able")
    sets = materialize(_made(docs, nodes, able, text_col, np.ndarray.tobytes), "copies-sets")
    return _near(able, sets, _exact, least)


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """``a, b``: nodes that connect what fingerprints within the SimHash operator's radius connect."""
    heads = nodes.groupBy("fp").agg(F.min("node").alias("head"))
    found = links(heads.select("fp"))
    ends = [heads.select(F.col("fp").alias(f"{x}_fp"), F.col("head").alias(f"{x}_node")) for x in "ab"]
    near = found.join(ends[0], F.col("a") == F.col("a_fp")).join(ends[1], F.col("b") == F.col("b_fp")).select("a_node", "b_node")
    same = nodes.join(heads.select(F.col("fp").alias("h_fp"), "head"), F.col("fp") == F.col("h_fp")).filter("node <> head").select("head", "node")
    return near.union(same).toDF("a", "b")


def near_copies(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tid, node, component_id, keeper`` for every row.

    ``component_id`` is the smallest doc_id that links of similarity ``least``
    reach; ``keeper`` marks the rows of that id (and of one set, if the id is
    repeated); ``node`` is a hash of the shingle set, ``tid`` one of the text.

    Defined cases: null, empty and blank texts are near copies of each other
    alone; a null id belongs to a component but never names one, unless there is
    no other id (then null); an empty table gives no rows; other columns,
    whatever their names, are ignored. A very long text takes some ten times its
    size while its set is made.
    """
    spark, mark = docs.sparkSession, written()
    rows = materialize(_sets(docs, id_col, text_col), "copies-rows")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("tid").alias("tid"), F.min("n").alias("n"), F.min("fp").alias("fp"))
    nodes = materialize(nodes, "copies-nodes")
    met = materialize(_rare(docs, nodes, text_col, least), "copies-met")
    # The pivot has the fewest rarer shingles of its own, so it is the one nearest to all.
    pivots = materialize(met.groupBy(F.col("value").alias("p_value")).agg(F.min(F.struct("pos", "node", "n")).alias("pivot")), "copies-pivots")

    def able(n: Column, pos: Column, m: Column, at: Column) -> Column:
        """Whether sets of n and m shingles that first meet at these places can have as much in common as they must."""
        return F.least(n - pos, m - at) >= (n + m) * F.lit(least / (1 + least)) - F.lit(1e-9)

    star = met.join(pivots, F.col("value") == F.col("p_value"))
    star = star.filter((F.col("node") != F.col("pivot.node")) & able(F.col("n"), F.col("pos"), F.col("pivot.n"), F.col("pivot.pos")))
    star = star.select(F.col("pivot.node").alias("a"), F.col("node").alias("b"))
    ordered = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    first = materialize(star.union(_by_fingerprint(nodes)).select(*ordered).distinct(), "copies-pairs")
    release(spark, mark, rows, nodes, met, first)
    found = materialize(_verified(first, docs, nodes, text_col, least), "copies-links")
    release(spark, mark, rows, nodes, met, first, found)

    # A node's label: its smallest document (nodes without one come last), then its set, so that labels differ.
    label = F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), F.col("node").alias("node"))
    labels = nodes.select("node", label.alias("label"))
    now = materialize(components(found, labels).select(F.col("node").alias("of"), F.col("label.node").alias("root")), "copies-roots")
    placed = materialize(met.join(now, met.node == now.of).select("value", "node", "n", "pos", "root"), "copies-placed")
    release(spark, mark, rows, nodes, first, found, placed)
    open_ = placed.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select(F.col("value").alias("o_value"))
    rest = materialize(placed.join(open_, F.col("value") == F.col("o_value"), "left_semi"), "copies-rest")
    release(spark, mark, rows, nodes, first, found, rest)
    a, b = (rest.select("value", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "pos", "root"))) for x in "ab")
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & able(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"))
    across = a.join(b, "value").filter(apart).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    more = materialize(across.select("a", "b").distinct().join(first, ["a", "b"], "left_anti"), "copies-more")
    release(spark, mark, rows, nodes, found, more)
    also = materialize(_verified(more, docs, nodes, text_col, least), "copies-more-links")
    release(spark, mark, rows, nodes, found, also)
    found = found.union(also)

    comp = components(found, labels)
    of = materialize(comp.select(F.col("node").alias("c_node"), F.col("label.id").alias("component_id"), F.col("label.node").alias("root")), "copies-components")
    release(spark, mark, rows, of)
    keeper = (F.col("node") == F.col("root")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    return rows.join(of, rows.node == of.c_node).select("doc_id", "tid", "node", "component_id", keeper.alias("keeper"))


def one_of_each(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of the smallest id."""
    found = near_copies(docs, least, id_col, text_col)
    return keep_one(docs, found.filter("keeper").groupBy("doc_id", "node").agg(F.min("tid").alias("tid")), id_col, text_col)
