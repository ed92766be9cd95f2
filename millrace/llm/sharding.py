"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a document's hash. It starts as a
single bucket; a bucket splits on one more bit only while it holds more bytes
than the limit, so the depth differs from shard to shard. Cells of the
directory that were not split point to the same shard.

The hash is the MD5 of the key as text, of which the 60 leading bits are used.
The directory grows by rounds of up to ``ROUND_BITS`` bits: one aggregation
gives the bytes of every cell of the round, roll-ups over those at most
``2**ROUND_BITS`` cells find where splitting stops, and only documents of cells
that are still too large take part in the next round. Everything that is
broadcast is a round's directory, whose size ``ROUND_BITS`` bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

ROUND_BITS = 12
MAX_BITS = 60


def _cell(hash_col, start: int, bits: int):
    """``bits`` bits of the hash from bit ``start`` (0 is the leading one)."""
    shift = MAX_BITS - start - bits
    return F.shiftrightunsigned(hash_col, shift).bitwiseAND((1 << bits) - 1)


def extendible_shards(docs: DataFrame, max_bytes: int, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """Assign every row to a shard of at most ``max_bytes`` bytes of UTF-8 text.

    Returns one row per input row: ``doc_id, shard`` (the prefix as a string of
    0 and 1; empty for the undivided table), ``depth`` (bits of the prefix),
    ``page`` (see below), ``n_bytes`` of the row, ``shard_bytes`` and
    ``shard_docs`` of its page.

    Defined cases: a null or empty text has 0 bytes; a null key hashes as the
    empty text. Rows with equal keys have equal hashes, so no prefix can part
    them: where a bucket is too large at ``max_bits`` bits its rows go to
    overflow pages of at most the limit, with any positive numbers (elsewhere
    the page is 0). A single row larger than half the limit has a page for itself.
    An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long").alias("h"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    )
    rows = materialize(rows, "shard-sizes")  # texts are read once; rounds read 24 bytes a row
    todo, start, done = rows.withColumn("prefix", F.lit("")), 0, []
    while start < max_bits:
        bits = min(ROUND_BITS, max_bits - start)
        cells = todo.groupBy("prefix", _cell(F.col("h"), start, bits).alias("cell")).agg(F.sum("n_bytes").alias("b"))
        depths = F.array([F.lit(d) for d in range(0 if start == 0 else 1, bits + 1)])
        nodes = (
            cells.select("prefix", "cell", "b", F.explode(depths).alias("d"))
            .withColumn("node", F.call_function("shiftrightunsigned", F.col("cell"), F.lit(bits) - F.col("d")))
            .withColumn("node_bytes", F.sum("b").over(Window.partitionBy("prefix", "d", "node")))
        )
        stop = (
            nodes.groupBy("prefix", "cell")
            .agg(F.min(F.when(F.col("node_bytes") <= max_bytes, F.col("d"))).alias("d"))
            .withColumn("fits", F.col("d").isNotNull())
            .withColumn("d", F.coalesce("d", F.lit(bits)))
            .withColumn("bits", F.substring(F.lpad(F.bin("cell"), bits, "0"), F.lit(1), F.col("d")))
        )
        directory = materialize(stop.select(F.col("prefix").alias("p"), F.col("cell").alias("c"), "bits", "fits"), f"directory-{start}")
        here = todo.withColumn("c", _cell(F.col("h"), start, bits))
        small = directory.count() <= 1 << ROUND_BITS  # later rounds may have several prefixes
        side = F.broadcast(directory) if small else directory
        here = here.join(side, (here.prefix == side.p) & (here.c == side.c)).select("doc_id", "h", "n_bytes", F.concat("prefix", "bits").alias("prefix"), "fits")
        done.append(here.filter("fits").select("doc_id", "n_bytes", F.col("prefix").alias("shard"), F.lit(0).cast("long").alias("page")))
        todo, start = here.filter("not fits").drop("fits"), start + bits
        if not directory.filter("not fits").limit(1).count():
            todo = None
            break
        todo = materialize(todo, f"oversized-{start}")
    if todo is not None:
        done.append(_overflow(todo, max_bytes))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    total = out.groupBy(F.col("shard").alias("s"), F.col("page").alias("g")).agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return out.join(total, (out.shard == total.s) & (out.page == total.g)).select(
        "doc_id", "shard", F.length("shard").alias("depth"), "page", "n_bytes", "shard_bytes", "shard_docs"
    )


def _overflow(rows: DataFrame, max_bytes: int) -> DataFrame:
    """Pages for rows that no prefix can part: rows are dealt at random over
    blocks, each block fills pages of its own in sequence. Blocks are as many
    as their shard has limits' worth of bytes, so that a task sees about 64
    limits of one shard at most."""
    total = rows.groupBy(F.col("prefix").alias("p")).agg(F.sum("n_bytes").alias("t"))
    rows = rows.withColumn("u", F.monotonically_increasing_id())
    rows = materialize(rows, "overflow")  # row numbers stay as they are if a task runs again
    dealt = rows.join(total, rows.prefix == total.p).withColumn("block", F.pmod(F.xxhash64("u"), F.greatest(F.lit(1), F.ceil(F.col("t") / F.lit(64 * max_bytes)))))
    # Rows of at most half a limit share slots of half a limit of running bytes, so that the row that crosses a
    # slot's end still fits the page; larger rows have a page each.
    half = max(1, max_bytes // 2)
    size = F.when(F.col("n_bytes") > half, F.lit(0)).otherwise(F.col("n_bytes"))
    seq = Window.partitionBy("prefix", "block").orderBy("u").rowsBetween(Window.unboundedPreceding, 0)
    slot = F.when(F.col("n_bytes") > half, F.concat(F.lit("r"), F.col("u"))).otherwise(
        F.concat_ws(":", F.lit("s"), F.col("block"), F.floor((F.sum(size).over(seq) - size) / half))
    )
    # A page's number only has to differ within its shard.
    page = F.pmod(F.xxhash64(slot), F.lit((1 << 62) - 1)) + 1
    return dealt.withColumn("page", page).select("doc_id", "n_bytes", F.col("prefix").alias("shard"), "page")


def shard_sql(max_bytes: int) -> str:
    """DuckDB: a document's shard is its shortest prefix whose bucket fits (up to 12 bits)."""
    return f"""
with r as (select doc_id, coalesce(octet_length(encode(text)), 0)::bigint as n_bytes,
                  ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h from documents),
d as (select unnest(range(0, 13))::int as d),
n as (select d, h >> (60 - d) as node, sum(n_bytes) as b, count(*) as c from r, d group by all),
s as (select r.doc_id, r.h, r.n_bytes, min(n.d) as d from r join n on r.h >> (60 - n.d) = n.node where n.b <= {max_bytes} group by all)
select s.doc_id, substr(lpad(bin(s.h), 60, '0'), 1, s.d) as shard, s.d as depth, 0::bigint as page, s.n_bytes,
       n.b::bigint as shard_bytes, n.c::bigint as shard_docs
from s join n on n.d = s.d and n.node = s.h >> (60 - s.d)"""
