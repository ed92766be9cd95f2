"""SimHash near-duplicates with covering locality-sensitive hashing.

A random map takes each of the 64 bits to a non-zero vector of r + 1 bits. For
every non-zero vector v of r + 1 bits there is a mask of the bits whose vector
has an odd inner product with v. The (at most r) vectors of the bits in which
two fingerprints differ span a space that some v is orthogonal to, and under
that v's mask the two are equal: every pair within distance r meets in one of
the 2^(r+1) - 1 tables, with certainty.

Only distinct fingerprints enter the tables. A bucket of more than ``BUCKET``
of them is parted into blocks by hash, and each two of its blocks meet in a
group of their own, so that no task holds more than about ``BUCKET`` members
and no pair is lost. Groups give the edges of a spanning forest of their links,
not their pairs. Components follow by label propagation with pointer jumping
over tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_names, materialize, release, slices, text_hash, written

RADIUS = 4
BUCKET = 2000
SEED = 20

_BLOCK = 1 << 16


# Fingerprints


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """SimHash of the text's word shingles (words between blanks, A-Z lower-cased, repeats included)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    last = (ends - 1).tolist()
    k = min(width, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(whole[s:e], seed) for s, e in zip(starts[: len(words) - k], last[k:], strict=True)), np.uint64, len(words) - k)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes; 0 if there are none."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        ones += _ones(hashes[at : at + _BLOCK])
    bits = ones * 2 > len(hashes)
    return int(np.packbits(bits[::-1]).view(">u8")[0])


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes set each bit, the lowest first."""
    raw = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return raw.sum(0, dtype=np.int64)


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tid`` (a hash of the text), ``fp`` (a signed 64-bit number) for every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t, width, seed) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps)], names=["doc_id", "tid", "fp"])

    return docs.select(F.col(id_col).alias("doc_id"), text_col, text_hash(F.col(text_col)).alias("tid")).mapInArrow(run, f"doc_id {kind}, tid long, fp long")


# Covering masks


@lru_cache(100)
def covering_masks(radius: int, seed: int = SEED) -> tuple[int, ...]:
    """Masks such that any ``radius`` of the 64 bits are missed by one mask."""
    vectors = np.random.default_rng(seed).integers(1, 1 << (radius + 1), 64).tolist()
    return tuple(sum(1 << b for b, u in enumerate(vectors) if (u & v).bit_count() & 1) for v in range(1, 1 << (radius + 1)))


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among some distinct fingerprints: a breadth-first search."""
    left, edges = np.sort(fps).view(np.uint64), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                found = left[near]
                edges += [(int(at), int(x)) for x in found]
                queue += list(found)
                left = left[~near]
    return edges


def _edges(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [e for fps in batch.column(0) for e in _forest(fps.values.to_numpy(), radius)]
            both = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return buckets.select("fps").mapInArrow(run, "a long, b long")


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: edges that connect whatever distinct fingerprints ``fp`` links connect.

    ``fps`` must hold each fingerprint once.
    """
    key = ["table", "value"]
    dealt = materialize(_deal(fps, radius), "simhash-dealt")
    sizes = materialize(dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-sizes")
    own = sizes.select(F.col("table").alias("t"), F.col("value").alias("v"), F.ceil(F.col("n") * 2 / bucket).alias("blocks"), "n")
    placed = dealt.join(own, (dealt.table == own.t) & (dealt.value == own.v))
    whole = placed.filter(F.col("n") <= bucket).withColumns({"low": F.lit(0), "high": F.lit(0)})
    block = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    parts = placed.filter(F.col("n") > bucket).withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    parts = parts.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    columns = [*key, "low", "high", "fp"]
    groups = whole.select(columns).unionByName(parts.select(columns)).groupBy(*key, "low", "high").agg(F.collect_list("fp").alias("fps"))
    return materialize(_edges(groups, radius).distinct(), "simhash-links")


def _deal(fps: DataFrame, radius: int) -> DataFrame:
    """``table, value`` (the masked bits), ``fp`` for every table; all of it built-in functions."""
    signed = lambda x: int(np.array([x], np.uint64).view(np.int64)[0])
    masks = covering_masks(radius)
    tables = F.array(*(F.struct(F.lit(k).alias("table"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("value")) for k, m in enumerate(masks)))
    return fps.select(F.explode(tables).alias("t"), "fp").select("t.table", "t.value", "fp")


# Components


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``node, label``: the smallest label that reaches each node.

    ``labels``: ``node, label``, every node once. Each round a node takes the
    smallest label among its neighbours and itself, then the label that node's
    root has (labels of distinct nodes differ, so a label names its node).
    Rounds end when nothing changes; hubs are pre-aggregated map-side.
    """
    both = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")), "cc-edges")
    state = materialize(labels.select("node", "label"), "cc-0")
    touched = state.join(both.select(F.col("u").alias("node")).distinct(), "node", "left_semi")
    own = materialize(touched.select(F.col("label").alias("root"), F.col("node").alias("root_node")), "cc-roots")
    now = materialize(touched, "cc-start")
    for k in count(1):
        offered = both.join(now, both.u == now.node).groupBy(F.col("v").alias("node")).agg(F.min("label").alias("offer"))
        lower = now.join(offered, "node", "left").select("node", F.col("label").alias("was"), F.least("label", "offer").alias("label"))
        # Pointer jumping: the node whose own label this is may know a smaller one already.
        jump = now.join(own, now.node == own.root_node).select(F.col("root").alias("r"), F.col("label").alias("r_label")).filter("r <> r_label")
        step = lower.join(jump, lower.label == jump.r, "left").select("node", "was", F.least("label", "r_label").alias("label"))
        step = materialize(step, f"cc-{k}")
        now = step.select("node", "label")
        if not step.filter("label <> was").limit(1).count():
            break
    return state.join(now.select("node", F.col("label").alias("least")), "node", "left").select("node", F.coalesce("least", "label").alias("label"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = 4, seed: int = 42, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, tid, fp, component_id, keeper, n_copies`` for every row.

    ``component_id`` is the smallest doc_id that links of at most ``radius``
    differing bits reach; ``keeper`` marks the rows of that id (and of one
    fingerprint, if the id is repeated); ``n_copies`` counts the rows with the
    same fingerprint; ``tid`` is a hash of the text.

    Defined cases: null, empty and blank texts have fingerprint 0 and link like
    any other; repeated rows share fingerprint and component; a null id belongs
    to a component but never names one, unless there is no other id (then null);
    an empty table gives no rows; other columns, whatever their names, are
    ignored. A very long text takes a few times its size while it is hashed.
    """
    mark = written()
    rows = materialize(fingerprints(docs, width, seed, id_col, text_col), "simhash")
    nodes = materialize(rows.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    found = links(nodes.select(F.col("node").alias("fp")), radius, bucket)
    # A node's label: its smallest document (nodes without one come last), then its fingerprint, so that labels differ.
    label = F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), F.col("node").alias("fp"))
    comp = components(found, nodes.select("node", label.alias("label")))
    of = comp.join(nodes.select("node", "n"), "node").select(F.col("node").alias("c_fp"), F.col("label.id").alias("component_id"), F.col("label.fp").alias("root_fp"), F.col("n").alias("n_copies"))
    of = materialize(of, "simhash-components")  # a plain side, so that Spark may split a fingerprint that very many rows share
    release(docs.sparkSession, mark, rows, of)
    keeper = (F.col("fp") == F.col("root_fp")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    return rows.join(of, rows.fp == of.c_fp).select("doc_id", "tid", "fp", "component_id", keeper.alias("keeper"), "n_copies")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of the smallest id."""
    found = near_duplicates(docs, radius, id_col=id_col, text_col=text_col)
    return keep_one(docs, found.filter("keeper").groupBy("doc_id", "fp").agg(F.min("tid").alias("tid")), id_col, text_col)


def keep_one(docs: DataFrame, stay: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of ``docs`` for each ``doc_id, tid`` of ``stay``; of rows alike in both, that of the smallest hash of the
    other columns."""
    own_id, own_tid, row_tid, nth = free_names(docs, "stay_id", "stay_tid", "row_tid", "row_nth")
    stay = stay.select(F.col("doc_id").alias(own_id), F.col("tid").alias(own_tid)).distinct()
    others = F.to_json(F.struct(*(F.col(c) for c in docs.columns if c not in (id_col, text_col)), F.lit(0).alias(nth)))
    out = docs.withColumn(row_tid, text_hash(F.col(text_col))).join(stay, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(row_tid) == F.col(own_tid)))
    order = Window.partitionBy(id_col, row_tid).orderBy(F.xxhash64(others), others)
    return out.withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1).drop(own_id, own_tid, row_tid, nth)
