"""Line dedup: lines that many documents share are dropped everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.llm.common import fresh, stored

#: A shared line with more than one row in FREQUENT is broadcast instead of shuffled to.
FREQUENT = 1024
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\f\r")), UPPER, UPPER.lower())


def dedup_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, names: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """All rows and columns of ``docs``, the text without its shared lines; adds n_lines and n_dropped, or other ``names``.

    A line's key is dropped if it has at least ``least_chars`` code points and
    stands in at least ``least_docs`` documents. Only (document, position, hash) rows
    are exploded and shuffled, never the text of a line; hashes are 128 bits. Counts
    are reduced to one row per (key, document) and then to one per key by partial
    aggregation, so a line that a third of all documents share meets no single task.

    A document is a doc_id: repeated rows of an id count once, rows without an id
    count as one document together. A null or empty text is one empty line and stays
    empty, as text ''. Rows of equal id and text lose the same lines. No documents
    give no rows. Columns of ``docs`` that have the added ones' names are replaced. Very long texts cost time in
    proportion to their lines, dropped or not.
    """
    n_lines, n_dropped = names
    docs = docs.drop(*names)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n", -1)
    same = F.xxhash64(text)
    key = line_key(F.col("line"))
    # The text is hashed and split before its lines are laid out, not once for each of them.
    split = docs.select("doc_id", same.alias("_same"), lines.alias("_lines"))
    exploded = split.select("doc_id", "_same", F.posexplode("_lines").alias("pos", "line"))
    # Two seeds: the second hash runs over the key and its length.
    hashed = exploded.where(F.length(key) >= least_chars).select(
        "doc_id", "_same", "pos", F.xxhash64(key).alias("h"), F.xxhash64(F.length(key), key).alias("g")
    )
    rows = stored(hashed, "lines")
    counted = rows.groupBy("h", "g", "doc_id").agg(F.count(F.lit(1)).alias("rows")).groupBy("h", "g")
    counted = counted.agg(F.count(F.lit(1)).alias("docs"), F.sum("rows").alias("rows"))
    shared = stored(counted.where(F.col("docs") >= least_docs), "shared_lines")
    # Each of these holds over 1 / FREQUENT of all rows, so there are fewer than FREQUENT: they are marked where they lie.
    often = shared.where(F.col("rows") > rows.count() // FREQUENT).select("h", "g")
    marked = rows.join(F.broadcast(often), ["h", "g"], "left_semi").unionByName(
        rows.join(F.broadcast(often), ["h", "g"], "left_anti").join(shared.select("h", "g"), ["h", "g"], "left_semi")
    )
    own_same, drop_id, drop_same, drop = fresh(docs, "_same", "_drop_id", "_drop_same", "_drop")
    dropped = (
        marked.groupBy("doc_id", "_same").agg(F.sort_array(F.collect_set("pos")).alias(drop))
        .select(F.col("doc_id").alias(drop_id), F.col("_same").alias(drop_same), drop)
    )
    joined = docs.withColumn(own_same, same).join(
        dropped, F.col("doc_id").eqNullSafe(F.col(drop_id)) & (F.col(own_same) == F.col(drop_same)), "left"
    )
    number = F.size(lines)
    out = joined.withColumns({
        n_lines: number.cast("bigint"),
        n_dropped: F.coalesce(F.size(drop), F.lit(0)).cast("bigint"),
        "text": F.when(F.col(drop).isNull(), text).otherwise(F.array_join(without(lines, F.col(drop)), "\n")),
    })
    return out.select(*docs.columns, n_lines, n_dropped)


def without(lines: Column, drop: Column) -> Column:
    """The lines but those at the positions ``drop`` (ascending, from 0), in time linear in the lines."""
    def kept(x: Column) -> Column:
        return F.filter(x["lines"], lambda _, pos: ~F.coalesce(F.get(x["dropped"], pos), F.lit(False)))

    def flags(p: Column, i: Column) -> Column:
        return F.concat(F.array_repeat(F.lit(False), p - F.coalesce(F.get(drop, i - 1), F.lit(-1)) - 1), F.array(F.lit(True)))

    gaps = F.transform(drop, flags)
    # A lambda's argument is computed once: without it the flags would be made again for each line.
    return F.transform(F.array(F.struct(F.flatten(gaps).alias("dropped"), lines.alias("lines"))), kept)[0]


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    from screenmart.llm.common import documents

    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), least_docs=10, least_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP9_SQL = r"""
with lines as (
  select d.rowid_ as r, d.doc_id, u.pos, u.line,
         translate(trim(u.line, e' \t\n\x0b\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select row_number() over () as rowid_, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents) d,
       lateral (select unnest(d.ls) as line, generate_subscripts(d.ls, 1) as pos) u
), shared as (
  select key from lines where length(key) >= 1 group by key having count(distinct coalesce(doc_id::varchar, '')) >= 10
), marked as (select l.*, s.key is not null as dropped from lines l left join shared s on s.key = l.key)
select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from marked group by r, doc_id
"""
