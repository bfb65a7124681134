"""Removal of lines that repeat an earlier line, exactly or nearly (operator
10), DataFrame functions only.

A line's set is its distinct lower-case words (parted by blanks, ASCII
punctuation, tabs and CR, or what else ``blanks`` names).  A line goes if any line before it, in
the order (doc_id, line number), has a Jaccard similarity of ``percent`` per
cent or more with it, whether that line itself stays or not.  Lines without
words stay.

Words are ordered by rarity: by the level (log2) of how often the words of
their hash bucket occur in the whole table, then by hash.  This order is the
same everywhere, which is all that the prefix filter needs, and the table of
levels has a fixed size.

1. The words of each line's prefix are dealt by word, once.  Of lines of the
   same set (a 64-bit hash of it, its size and bitmap agree) all but the first
   are settled, and only first lines go on.  Within a word, pairs of a line
   and an earlier one pass the length and positional filters and a parity
   bitmap, whose differing bits never outnumber the differing words.
2. Words that more than ``CROWD`` such lines share would make too many pairs
   where thousands of lines are near copies.  Their lines are first compared
   with the first line of their part of the word's group; those that match are
   settled, and only the lines that are left meet all earlier ones.
3. The words of the pairs' lines are fetched and the Jaccard verified exactly.

A bitmap of fixed size over the ids' hashes tells the documents that no pair
can touch; they pass by without being shuffled.

Defined results: null and empty texts have no lines and come back as they
are; rows that share an id (null ids count as the least) are ordered by a hash
of their columns, and rows repeated exactly are one document, whose lines
don't remove each other; a document of which no line stays keeps an empty
text; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relevo.llm.common import packed, table, unpacked
from relevo.session import materialize

NAME = "op10_line_dedup"
PERCENT = 80
#: Hash buckets of the table of word frequencies, and of the touched ids.
BUCKETS = 1 << 17
#: Lines that may meet each other on a word at once, and lines of a part of
#: a larger group.
CROWD, PART = 256, 4096
_HASH_BITS = 57
#: ASCII punctuation, tab, CR and others that part words as blanks do.
PUNCTUATION = string.punctuation + "\t\r\x0b\x0c"
_LEAST = -(1 << 63)
_LOW = (1 << 32) - 1


def plain(text: Column, blanks: str) -> Column:
    """The lower-case text with blanks for the characters of ``blanks``."""
    low = F.lower(text)
    return F.translate(low, blanks, " " * len(blanks)) if blanks else low


def words(line: Column, blanks: str = PUNCTUATION) -> Column:
    """Distinct words of a line."""
    return F.array_remove(F.array_distinct(F.split(plain(line, blanks), " ")), "")


def _id() -> Column:
    return F.coalesce(F.col("rest.doc_id").cast("long"), F.lit(_LEAST))


def positioned(docs: DataFrame) -> DataFrame:
    """Packed documents with ``_doc`` (id, null as the least) and ``_row``,
    which tells rows apart that share an id."""
    own = [F.col("rest")[f.name] for f in docs.schema["rest"].dataType.fields if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return docs.withColumns({"_doc": _id(), "_row": F.pmod(F.xxhash64("text", *own), F.lit(1 << 31))})


def _lines(docs: DataFrame) -> DataFrame:
    """``doc, no, line``; ``no`` holds the row in its upper half and the line
    number in its lower one."""
    return docs.select(F.col("_doc").alias("doc"), "_row", F.posexplode(F.split("text", "\n")).alias("at", "line")).select(
        "doc", (F.shiftleft("_row", 32) + F.col("at")).alias("no"), "line"
    )


def _small_table(values) -> Column:
    """A constant array of small numbers."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<tinyint>")


def rarity_levels(docs: DataFrame, blanks: str = PUNCTUATION) -> list[int]:
    """Per hash bucket, the bit length of its words' occurrences in all texts."""
    text_words = docs.select(F.explode(F.split(plain(F.col("text"), blanks + "\n"), " ")).alias("w"))
    counted = text_words.filter("w <> ''").groupBy(F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).alias("b")).count().collect()
    levels = [0] * BUCKETS
    for r in counted:
        levels[r["b"]] = min(int(r["count"]).bit_length(), 63)
    return levels


def prefixes(docs: DataFrame, levels: list[int], percent: int, blanks: str = PUNCTUATION) -> DataFrame:
    """``token, doc, no, n, at, b, w2, k`` for the prefix words of each line,
    the rarest first; ``b, w2``: parity bitmap of the set, of two words for
    sets of more than 64; ``k``: a hash of the whole set."""
    level = _small_table(levels)
    hashed = F.array_distinct(F.transform(F.array_remove(F.split(plain(F.col("line"), blanks), " "), ""), lambda w: F.xxhash64(w)))
    number = lambda h: F.shiftleft(F.get(level, F.pmod(h, F.lit(BUCKETS)).cast("int")).cast("long"), _HASH_BITS).bitwiseOR(h.bitwiseAND(F.lit((1 << _HASH_BITS) - 1)))

    def parity(ids, part=None):
        if part is not None:
            ids = F.filter(ids, lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(1)) == part)
        bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(ids, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(bit(x)))

    def described(ids):
        n, zero = F.size(ids), F.lit(0).cast("long")
        long = n > 64
        least = F.floor((n * percent + 99) / 100).cast("int")
        return F.struct(
            n.alias("n"),
            F.when(long, parity(ids, 0)).otherwise(parity(ids)).alias("b"),
            F.when(long, parity(ids, 1)).otherwise(zero).alias("w2"),
            F.xxhash64(ids).alias("k"),
            F.slice(ids, F.lit(1), n - least + 1).alias("prefix"),
        )

    # the words' numbers are bound once, as a lambda's variable, and a generator isn't merged with what follows it
    lines = _lines(docs).select("doc", "no", F.inline(F.transform(F.array(F.sort_array(F.transform(hashed, number))), described)))
    return lines.select("doc", "no", "n", "b", "w2", "k", F.posexplode("prefix").alias("at", "token"))


def _before(a, b) -> Column:
    """Whether b's line stands before a's."""
    return (b["doc"] < a["doc"]) | ((b["doc"] == a["doc"]) & (b["no"] < a["no"]))


def _may_match(a, b, percent: int) -> Column:
    """Length, positional and bitmap filters for two lines that share a word."""
    n, m = a["n"], b["n"]
    need = F.ceil((n + m) * percent / (100 + percent))  # common words at that similarity
    length = (n * 100 >= m * percent) & (m * 100 >= n * percent)
    place = F.least(n - a["at"], m - b["at"]) + F.least(a["at"], b["at"]) >= need
    differ = lambda x, y: F.bit_count(x.bitwiseXOR(y))
    joined = lambda s: s["b"].bitwiseXOR(s["w2"])
    bits = F.when((n > 64) == (m > 64), differ(a["b"], b["b"]) + differ(a["w2"], b["w2"])).otherwise(differ(joined(a), joined(b)))
    return length & place & (bits <= n + m - 2 * need)


class _Side:
    """Columns of one side of a join."""

    def __init__(self, name: str):
        self.name = name

    def __getitem__(self, column: str) -> Column:
        return F.col(f"{self.name}.{column}")


_PAIR = ["doc", "no", "doc2", "no2"]
_LINE = ["doc", "no", "n", "at", "b", "w2"]


def _pairs(a: DataFrame, b: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Distinct ``doc, no, doc2, no2`` of lines of a and earlier ones of b that
    agree in the keys."""
    x, y = _Side("a"), _Side("b")
    on = _before(x, y) & _may_match(x, y, percent)
    for k in keys:
        on = on & (x[k] == y[k])
    both = a.alias("a").join(b.alias("b"), on)
    return both.select(x["doc"].alias("doc"), x["no"].alias("no"), y["doc"].alias("doc2"), y["no"].alias("no2")).distinct()


def _pairs_inside(rows: DataFrame, percent: int) -> DataFrame:
    """The same for words of at most ``CROWD`` lines: each word's lines as one
    short array, compared in place."""
    groups = rows.groupBy("token").agg(F.collect_list(F.struct(*_LINE)).alias("lines"))

    def earlier(a):
        return F.transform(F.filter("lines", lambda b: _before(a, b) & _may_match(a, b, percent)), lambda b: F.struct(a["doc"].alias("doc"), a["no"].alias("no"), b["doc"].alias("doc2"), b["no"].alias("no2")))

    return groups.select(F.inline(F.flatten(F.transform("lines", earlier)))).distinct()


def _touched(ids: DataFrame) -> Column:
    """Whether ``_doc`` may be among the ids ``doc`` (by a bitmap of their
    hashes; some others pass, too)."""
    bucket = lambda c: F.pmod(F.xxhash64(c, F.lit(5)), F.lit(BUCKETS)).cast("int")
    seen = bytearray(BUCKETS)
    for r in ids.select(bucket("doc").alias("b")).distinct().collect():
        seen[r["b"]] = 1
    return F.get(_small_table(seen), bucket("_doc")) == 1


def _verified(own: DataFrame, pairs: DataFrame, percent: int, blanks: str) -> DataFrame:
    """``doc, no`` of the pairs whose Jaccard similarity is high enough; the
    words come from ``own``, the documents dealt by id."""
    wanted = pairs.select("doc", "no").unionByName(pairs.select(F.col("doc2").alias("doc"), F.col("no2").alias("no")))
    per_doc = wanted.groupBy("doc").agg(F.collect_set("no").alias("nos"))
    mine = own.join(per_doc, own["_doc"] == per_doc["doc"]).select("doc", "_row", F.split("text", "\n").alias("lines"), F.explode("nos").alias("no"))
    mine = mine.filter(F.shiftright("no", 32) == F.col("_row"))
    texts = mine.select("doc", "no", words(F.get("lines", F.col("no").bitwiseAND(F.lit(_LOW)).cast("int")), blanks).alias("words"))
    other = texts.select(F.col("doc").alias("doc2"), F.col("no").alias("no2"), F.col("words").alias("words2"))
    both = pairs.join(texts, ["doc", "no"]).join(other, ["doc2", "no2"])
    common = F.size(F.array_intersect("words", "words2"))
    return both.filter(common * 100 >= (F.size("words") + F.size("words2") - common) * percent).select("doc", "no").distinct()


def _dealt(docs: DataFrame, touched: Column) -> DataFrame:
    """The touched documents, dealt by id.  Their row numbers come after the
    shuffle and need every column, so that all that reads them shares it."""
    part = docs.withColumn("_doc", _id()).filter(touched).drop("_doc")
    return positioned(part.repartition(_id()))


def dedup_lines(docs: DataFrame, percent: int = PERCENT, blanks: str = PUNCTUATION) -> DataFrame:
    """The documents without the lines that go, with ``_n_lines`` and
    ``_n_gone`` (their lines, and those that went)."""
    columns, docs = docs.columns, packed(docs)
    numbered = positioned(docs)
    rows = prefixes(numbered, rarity_levels(numbered, blanks), percent, blanks).repartition("token")
    same = Window.partitionBy("token", "k", "n", "b", "w2").orderBy("doc", "no")
    # a row repeated exactly has its lead's place, and is no copy of it
    rows = rows.withColumns({"lead": F.row_number().over(same) == 1, "copy": F.rank().over(same) > 1})
    rows = rows.withColumn("m", F.count_if("lead").over(Window.partitionBy("token")))
    null = F.lit(None).cast("long")
    crowd_columns = ["token", "n", "at", "b", "w2", "m"]
    # one job for all three, so that the prefixes are shuffled once
    found = _pairs_inside(rows.filter(F.col("lead") & F.col("m").between(2, CROWD)), percent).withColumns(dict.fromkeys(crowd_columns, null))
    rest = rows.filter((F.col("lead") & (F.col("m") > CROWD)) | (F.col("copy") & (F.col("at") == 0)))
    rest = rest.select("doc", "no", null.alias("doc2"), null.alias("no2"), *[F.when(F.col("lead"), F.col(c).cast("long")).alias(c) for c in crowd_columns])
    first_job = materialize(found.unionByName(rest), "line-pairs")
    pairs, crowd = first_job.filter("doc2 is not null").select(*_PAIR), first_job.filter("token is not null").drop("doc2", "no2")
    settled = copies = first_job.filter("doc2 is null and token is null").select("doc", "no")
    if not crowd.isEmpty():
        part = F.pmod(F.xxhash64("doc", "no"), F.ceil(F.col("m") / PART)).alias("part")
        parted = crowd.withColumn("part", part)
        head = parted.groupBy("token", "part").agg(F.min(F.struct(*_LINE)).alias("x")).select("token", "part", "x.*")
        near = _pairs(parted, head, ["token", "part"], percent)
        near = materialize(near, "line-near")
        ids = near.select("doc").unionByName(near.select(F.col("doc2").alias("doc")))
        near_copies = materialize(_verified(_dealt(docs, _touched(ids)), near, percent, blanks), "line-settled")
        settled = copies.unionByName(near_copies)
        left = crowd.join(near_copies, ["doc", "no"], "left_anti")
        pairs = materialize(pairs.unionByName(_pairs(left, crowd, ["token"], percent)), "line-pairs")
    ids = pairs.select("doc").unionByName(pairs.select(F.col("doc2").alias("doc")))
    touched = _touched(ids.unionByName(settled.select("doc")))
    own = _dealt(docs, touched)
    matched = _verified(own, pairs, percent, blanks).unionByName(settled)
    gone = matched.groupBy("doc").agg(F.collect_set("no").alias("gone"))
    out = own.join(gone, own["_doc"] == gone["doc"], "left")
    here = F.transform(F.filter(F.coalesce("gone", F.array().cast("array<long>")), lambda x: F.shiftright(x, 32) == F.col("_row")), lambda x: x.bitwiseAND(F.lit(_LOW)).cast("int"))
    out = out.withColumn("_gone", here).withColumn("_lines", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = F.when(F.size("_gone") > 0, F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")).otherwise(F.col("text"))
    out = out.select(*unpacked(columns, text=text), F.greatest(F.size("_lines"), F.lit(0)).alias("_n_lines"), F.size("_gone").alias("_n_gone"))
    rest = numbered.filter(~touched).select(*unpacked(columns), F.greatest(F.size(F.split("text", "\n")), F.lit(0)).alias("_n_lines"), F.lit(0).alias("_n_gone"))
    return out.unionByName(rest)


def remove_repeated_lines(docs: DataFrame, percent: int = PERCENT, blanks: str = PUNCTUATION) -> DataFrame:
    """The documents without repeated lines; a document that had lines with
    words and is left with none goes.  ``n_chars``, where present, follows the
    text."""
    out = dedup_lines(docs, percent, blanks)
    out = out.filter((F.col("_n_gone") == 0) | (F.trim(plain(F.col("text"), blanks + "\n")) != ""))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_n_gone") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_gone").cast("long").alias("n_removed"), "text")


_SQL_BLANKS = " || ".join([f"chr({ord(c)})" for c in PUNCTUATION])

ORACLE_SQL = f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents),
w AS MATERIALIZED (SELECT doc_id, no, row_number() OVER (ORDER BY doc_id, no) AS pos,
    list_filter(list_distinct(string_split(translate(lower(line), {_SQL_BLANKS}, '{" " * len(PUNCTUATION)}'), ' ')), lambda x: x <> '') AS ws FROM l),
t AS (SELECT pos, unnest(ws) AS word, len(ws) AS n FROM w),
f AS (SELECT word, count(*) AS df FROM t GROUP BY word),
r AS (SELECT pos, word, n, row_number() OVER (PARTITION BY pos ORDER BY df, word) AS place FROM t JOIN f USING (word)),
p AS MATERIALIZED (SELECT pos, word, n FROM r WHERE place <= n - (n * {PERCENT} + 99) // 100 + 1),
c AS (SELECT DISTINCT a.pos AS late, b.pos AS early FROM p a JOIN p b ON a.word = b.word AND b.pos < a.pos AND a.n * 100 >= b.n * {PERCENT} AND b.n * 100 >= a.n * {PERCENT}),
g AS (SELECT DISTINCT late FROM (SELECT late, len(list_intersect(x.ws, y.ws)) AS i, len(x.ws) + len(y.ws) AS s FROM c JOIN w x ON x.pos = late JOIN w y ON y.pos = early) WHERE i * 100 >= (s - i) * {PERCENT}),
k AS (SELECT doc_id, count(*) FILTER (late IS NOT NULL) AS n_removed, string_agg(line, chr(10) ORDER BY no) FILTER (late IS NULL) AS kept
  FROM w JOIN l USING (doc_id, no) LEFT JOIN g ON late = pos GROUP BY doc_id)
SELECT doc_id, len(string_split(text, chr(10)))::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN n_removed > 0 THEN coalesce(kept, '') ELSE text END AS text
FROM documents LEFT JOIN k USING (doc_id)
"""
