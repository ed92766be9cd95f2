"""Line-level deduplication on DataFrame functions alone.

Lines of all documents become rows of two 64-bit hashes, a document and a
position. The rows are range-partitioned by line hash and then by a hash of the
document, so that a line found in very many documents is spread over as many
ranges as its share of the rows asks for, and sorted within by document and
position. A pass over each sorted range streams first occurrences: the first
row of a (line, document) run. Their counts and the largest document of each
range are combined per line; lines seen in ``min_docs`` documents are shared
ones, kept in their largest document only. What comes back per document is a
compressed bitmap, not text: 64 lines to a word, and only words in which a line
goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, free_names, materialize, release, shuffle_parts, text_hash, written

BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``did, tid, words: map<int, bigint>`` for the documents that lose lines.

    ``did`` is the document id, ``tid`` a hash of its text (repeated rows share
    it). Word ``w`` holds lines ``64 w .. 64 w + 63``, lowest bit first; a set
    bit keeps its line. Words that keep all their lines are left out, and so
    are documents that do.
    """
    mark = written()
    line = F.btrim(F.col("line"), F.lit(BLANKS))
    rows = (
        docs.select(F.col(id_col).alias("did"), text_hash(F.col(text_col)).alias("tid"), F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
        .filter(F.octet_length("line") >= min_chars)
        .select("did", "tid", "pos", ascii_lower(line).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("did", "tid", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    rows = materialize(rows, "line-hashes")  # texts are split once, for the ranges' bounds and both uses
    ranged = rows.withColumn("spread", F.xxhash64("did")).repartitionByRange(shuffle_parts(docs), "h1", "h2", "spread").sortWithinPartitions("h1", "h2", "spread", "did", "pos")
    run = Window.partitionBy("h1", "h2", "spread", "did").orderBy("pos")
    firsts = ranged.withColumn("nth", F.row_number().over(run)).filter("nth = 1")
    shared = (
        firsts.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("did").alias("keeper"))
        .filter(F.col("n") >= min_docs)
        .select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), "keeper")
    )
    shared = materialize(shared, "lines-shared")  # a plain side, so that Spark may split a line that very many documents share
    dropped = rows.join(shared, (rows.h1 == shared.s1) & (rows.h2 == shared.s2) & ~rows.did.eqNullSafe(shared.keeper))
    words = dropped.groupBy("did", "tid", F.shiftright("pos", 6).alias("w")).agg(
        F.bitwise_not(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(63)))).alias("bits")
    )
    maps = materialize(words.groupBy("did", "tid").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("words")), "line-bitmaps")
    release(docs.sparkSession, mark, maps)
    return maps


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text_col``, plus ``n_lines`` and ``n_dropped``.

    A line is compared by its key: blanks (space, \\t..\\r) stripped at both
    ends, A-Z lower-cased. Keys of ``min_chars`` code points or more that occur
    in ``min_docs`` documents lose all their lines except in the largest id.

    Defined cases: a null text counts as one empty line and becomes the empty
    text; shorter keys and empty lines always stay; ids may be of any type that
    has an order; rows with one id are one document; all rows with a null id are
    one document, smaller than the rest; an empty table gives an empty table. A
    very long text is a single value of a row and its array of lines, so a task
    needs a few times its size. Other columns pass through untouched, whatever
    their names (new columns replace old ones named n_lines, n_dropped).
    """
    own_id, own_tid, own_words = free_names(docs, "did", "tid", "words")
    maps = keep_bitmaps(docs, min_chars, min_docs, id_col, text_col)
    maps = maps.select(F.col("did").alias(own_id), F.col("tid").alias(own_tid), F.col("words").alias(own_words))
    words = F.col(own_words)
    joined = docs.join(maps, F.col(id_col).eqNullSafe(F.col(own_id)) & (text_hash(F.col(text_col)) == F.col(own_tid)), "left")
    bits = lambda i: F.coalesce(F.try_element_at(words, F.shiftright(i, 6)), F.lit(-1).cast("long"))
    stays = lambda _, i: F.call_function("shiftrightunsigned", bits(i), i.bitwiseAND(63)).bitwiseAND(F.lit(1).cast("long")) == 1
    lines = _lines(F.col(text_col))
    kept = F.filter(lines, stays)
    gone = F.aggregate(F.map_values(words), F.lit(0), lambda n, w: n + F.bit_count(F.bitwise_not(w)).cast("int"))
    whole = F.coalesce(F.col(text_col), F.lit(""))
    n_lines = (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long")
    return joined.withColumns(
        {
            "n_lines": n_lines,
            "n_dropped": F.coalesce(gone, F.lit(0)).cast("long"),
            text_col: F.when(words.isNull(), whole).otherwise(F.array_join(kept, "\n")),
        }
    ).drop(own_id, own_tid, own_words)


def line_dedup_sql(min_chars: int = 20, min_docs: int = 3) -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') as key from l),
s as (select key, max(doc_id) as keeper from k where length(key) >= {min_chars} group by key having count(distinct doc_id) >= {min_docs}),
f as (select k.doc_id, k.pos, k.line, s.key is not null and s.keeper <> k.doc_id as gone from k left join s on k.key = s.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from f group by doc_id"""
