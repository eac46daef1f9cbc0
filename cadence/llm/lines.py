"""Line dedup by a log-template tree.  DataFrame functions only.

A line's tokens that hold a digit are variable fields.  The tree has a fixed
depth: lines go by their token count, then by their first LEAD tokens, to a
leaf.  In a leaf a token at a place is constant if it stands there in lines of
enough different texts, else it becomes a field.  A line's template is its
constants and fields; a template with enough constants that occurs in enough
different texts recurs, and its lines are dropped everywhere.  Enough is
MIN_DOCS, for lines of LONG_TOKENS tokens or more LONG_DOCS.

Leaves with fewer lines than that cannot hold a recurring template and go
before any text is shuffled; counts are aggregated before each shuffle, so a
line that is in a third of all documents is one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepared, staged, text_or_empty

LEAD = 3
MIN_DOCS = 10
LONG_TOKENS = 50
LONG_DOCS = 3
#: Constants a recurring template needs, and the share of its tokens.
LEAST_CONSTANTS = 3
SHARE = 0.5
FIELD = "<*>"
_BLANK = r"[ \t\r\x0B\f]+"
#: Blanks that are not a single space.
_ODD = r"[ \t\r\x0B\f]{2,}|[\t\r\x0B\f]"
#: Leaves (8 bytes each) up to which their table is sent to every task.
BROADCAST_ROWS = 1_000_000
#: Keys of lines to drop (16 bytes each) up to which they are sent to every task.
BROADCAST_KEYS = 1_000_000
#: Tasks that share the lines of one template.
SPREAD = 32


def _single(text):
    """Blanks single; most texts need no replacement and get none."""
    odd = text.contains("  ")
    for blank in "\t\r\x0b\f":
        odd = odd | text.contains(blank)
    return F.when(odd, F.regexp_replace(text, _ODD, " ")).otherwise(text)


def _fields(single):
    """Tokens with a digit as fields, in a line whose blanks are single."""
    line = F.trim(single)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(line)


def canonical(line):
    """Blanks single, tokens with a digit as fields."""
    return _fields(_single(line))


def enough(n, min_docs: int = MIN_DOCS):
    """Different texts that a template of n tokens needs."""
    return F.when(n >= LONG_TOKENS, min(LONG_DOCS, min_docs)).otherwise(min_docs)


def _name(text):
    """The md5 of a text, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _split_lines(text):
    return F.split(text, "\n")


def _placed(docs: DataFrame, *columns) -> DataFrame:
    """``columns`` and line, n, leaf of every canonical line of every text."""
    texts = docs.select(*columns, F.explode(_split_lines(_single(text_or_empty()))).alias("line"))
    lines = texts.select(*[c for c in texts.columns if c != "line"], _fields(F.col("line")).alias("line")).where("line <> ''")
    # blanks are single, so they count tokens
    n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "))) + 1
    leaf = F.xxhash64("n", F.substring_index("line", " ", LEAD))
    return lines.withColumn("n", n).withColumn("leaf", leaf)


def _constants(held: DataFrame, tokens: DataFrame, min_docs: int) -> DataFrame:
    """(n, leaf, pos, token) that stand in lines of enough different texts.
    One line in enough texts settles a place, and too few texts over all its
    lines do; only between, where each line has few texts, are they listed."""
    place = ["n", "leaf", "pos", "token"]
    tally = tokens.where(F.col("token") != FIELD).groupBy(*place).agg(F.max("texts").alias("most"), F.sum("texts").alias("all"))
    need = enough(F.col("n"), min_docs)
    tally = staged(tally.where(F.col("all") >= need), "lines-places")
    open_ = tally.where(F.col("most") < need).select(*place)
    few = tokens.join(open_, place).select(*place, "key").join(held.select("key", "tid").distinct(), "key")
    counted = few.select(*place, "tid").distinct().groupBy(*place).agg(F.count(F.lit(1)).alias("t"))
    return tally.where(F.col("most") >= need).select(*place).unionByName(counted.where(F.col("t") >= need).select(*place))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, line, key, template) of the canonical lines to drop; key is the line's md5 in bytes."""
    busy = _placed(docs).groupBy("n", "leaf").agg(F.count(F.lit(1)).alias("rows"))
    busy = staged(busy.where(F.col("rows") >= enough(F.col("n"), min_docs)).select("leaf").distinct(), "lines-leaves")
    held = _placed(docs, "doc_id", _name(text_or_empty()).alias("tid")).join(_small(busy), "leaf")
    held = held.select("doc_id", "tid", "n", "leaf", "line", _name(F.col("line")).alias("key"))
    held = staged(held, "lines-held")
    seen = held.select("key", "tid").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("texts"))
    one = held.groupBy("key").agg(F.first("n").alias("n"), F.first("leaf").alias("leaf"), F.first("line").alias("line"))
    each = staged(one.join(seen, "key"), "lines-different")
    tokens = each.select("key", "n", "leaf", "texts", F.posexplode(F.split("line", " ")).alias("pos", "token"))
    place = ["n", "leaf", "pos", "token"]
    marked = tokens.join(_constants(held, tokens, min_docs).withColumn("c", F.lit(1)), place, "left")
    shape = marked.groupBy("key").agg(  # at most the tokens of a line
        F.sort_array(F.collect_list(F.struct("pos", F.when(F.col("c") == 1, F.col("token")).otherwise(FIELD).alias("t")))).alias("ts"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("constants"),
        F.max("n").alias("n"),
    )
    shape = shape.where((F.col("constants") >= LEAST_CONSTANTS) & (F.col("constants") >= SHARE * F.col("n")))
    template = staged(shape.select("key", "n", F.array_join("ts.t", " ").alias("template")), "lines-templates")
    common = (
        held.select("key", "tid")
        .join(template, "key")
        .select("template", "n", "tid")
        .distinct()
        .groupBy("template", "n")
        .agg(F.count(F.lit(1)).alias("texts"))
        .where(F.col("texts") >= enough(F.col("n"), min_docs))
    )
    # the lines of one template are shared by several tasks
    spread = common.select("template", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("turn"))
    dealt = template.select("key", "template", F.pmod(F.xxhash64("key"), F.lit(SPREAD)).cast("int").alias("turn"))
    bad = dealt.join(spread, ["template", "turn"]).select("key", "template")
    return staged(held.select("doc_id", "line", "key").join(bad, "key").select("doc_id", "line", "key", "template"), "lines-recurring")


def deduplicated(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): lines with a token, those dropped,
    and the text of the other lines in their order.

    Null text is empty: no lines, empty text.  Lines of blanks stay and do not
    count.  Exact copies of a text count as one text.  Rows that repeat an id
    stay; rows without an id keep the lines of their own templates out alike.
    Further columns are ignored."""
    prepared(docs.sparkSession)
    bad = recurring_lines(docs.select("doc_id", "text"), min_docs)
    few = bad.count() <= BROADCAST_KEYS
    drop = bad.groupBy("doc_id").agg(F.collect_set("key").alias("drop"))  # at most the lines of a text
    drop = staged(drop.withColumnRenamed("doc_id", "id"), "lines-drop")
    own = docs.select("doc_id", text_or_empty().alias("text"))
    joined = own.join(F.broadcast(drop) if few else drop, own["doc_id"].eqNullSafe(drop["id"]), "left")
    kept = F.filter(_split_lines(F.col("text")), lambda x: ~F.array_contains(F.col("drop"), _name(canonical(x))))
    return joined.select(
        "doc_id",
        F.regexp_count("text", F.lit(r"[^ \t\r\x0B\f\n][^\n]*+")).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), 0).otherwise(F.size(_split_lines(F.col("text"))) - F.size(kept)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept"),
    )


#: DuckDB SQL of the query's rows over the table documents.
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS tid FROM documents),
 raw AS (SELECT doc_id, tid, unnest(string_split(text, chr(10))) AS l FROM d),
 c AS (SELECT doc_id, tid, regexp_replace(trim(regexp_replace(l, '{_BLANK}', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS line FROM raw),
 p AS (SELECT DISTINCT tid, line, length(line) - length(replace(line, ' ', '')) + 1 AS n,
              array_to_string(list_slice(string_split(line, ' '), 1, {LEAD}), ' ') AS lead FROM c WHERE line <> ''),
 e AS (SELECT DISTINCT line, n, lead FROM p),
 t AS (SELECT line, n, lead, unnest(string_split(line, ' ')) AS token, unnest(range(0, n)) AS pos FROM e),
 k AS (SELECT t.n, t.lead, pos, token FROM t JOIN p USING (line) WHERE token <> '{FIELD}'
       GROUP BY ALL HAVING count(DISTINCT tid) >= CASE WHEN t.n >= {LONG_TOKENS} THEN {LONG_DOCS} ELSE {MIN_DOCS} END),
 s AS (SELECT t.line, t.n, string_agg(CASE WHEN k.token IS NULL THEN '{FIELD}' ELSE t.token END, ' ' ORDER BY t.pos) AS template, count(k.token) AS constants
       FROM t LEFT JOIN k ON t.n = k.n AND t.lead = k.lead AND t.pos = k.pos AND t.token = k.token GROUP BY t.line, t.n),
 g AS (SELECT template FROM s JOIN p USING (line) WHERE constants >= {LEAST_CONSTANTS} AND constants >= {SHARE} * s.n
       GROUP BY template, s.n HAVING count(DISTINCT tid) >= CASE WHEN s.n >= {LONG_TOKENS} THEN {LONG_DOCS} ELSE {MIN_DOCS} END),
 b AS (SELECT line FROM s WHERE template IN (SELECT template FROM g) AND constants >= {LEAST_CONSTANTS} AND constants >= {SHARE} * n),
 o AS (SELECT doc_id, tid, i, l, regexp_replace(trim(regexp_replace(l, '{_BLANK}', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS line
       FROM (SELECT doc_id, tid, unnest(string_split(text, chr(10))) AS l, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM d))
SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (line IN (SELECT line FROM b)) AS n_dropped,
       md5(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (line NOT IN (SELECT line FROM b)), '')) AS kept_md5
FROM o GROUP BY doc_id
"""
