"""DuckDB SQL for every SQL-checkable registered query.

Each statement computes the query's meaning directly on the driver's views
(``documents``, ``conversations``, ``pages``, ``events``); column names match
``relevo.plans.queries``.  DuckDB's RE2 has ASCII ``\\w`` but a narrower
``\\s``, so the character classes of the cleaning pattern are spelled out.
"""

from __future__ import annotations

from relevo.functions.stopwords import ENGLISH_STOP_WORDS
from relevo.operators.labeling import HASH_RANGE, SAMPLE_SEED
from relevo.operators.model import CV_SEED, NUM_FOLDS
from relevo.plans.queries import (
    AUDIT_K,
    BAYES_FEATURES,
    DOCUMENT_PATTERN,
    FEATURE_SIZES,
    LANGUAGE_CLASSES,
    MINING_MIN_COUNT,
    MINING_SUPPORT,
    OLDER_STAMP,
    RELEVANT_VALUE,
    RUN_STAMP,
    SHORTLIST_K,
)

# Fixed values, RE2 spelling of the patterns in relevo.functions.text.
_PAT = r"(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|([0-9A-Za-z_]+://[^ \t\n\x0B\f\r]+)"
_HTML_BLOCK = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->"
_HTML_TAG = r"(?s)<[^>]*>"
_HTML_ENTITY = r"&(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"
_LINE_BLANKS = r"[\t\n\x0B\f\r \x{1c}-\x{1f}\x{85}\pZ]"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_SW = ", ".join(_lit(w) for w in ENGLISH_STOP_WORDS)
_PATTERN = "[" + ", ".join(_lit(w) for w in DOCUMENT_PATTERN) + "]::VARCHAR[]"


def clean(x: str) -> str:
    return (
        f"array_to_string(list_filter(string_split(trim(regexp_replace({x}, {_lit(_PAT)}, ' ', 'g'), "
        f"' ' || chr(9)), ' '), lambda t: length(t) >= 3), ' ')"
    )


def tokenize(x: str) -> str:
    body = f"regexp_replace(lower({x}), '\\s+$', '')"
    return (
        f"CASE WHEN lower({x}) = '' THEN [''] WHEN {body} = '' THEN []::VARCHAR[] "
        f"ELSE regexp_split_to_array({body}, '\\s') END"
    )


def no_stop_words(x: str) -> str:
    return f"list_filter({x}, lambda w: lower(w) NOT IN ({_SW}))"


def unique(x: str) -> str:
    return f"list_sort(list_distinct(list_filter({x}, lambda w: w <> '')))"


def hash_unit(x: str, seed: int = SAMPLE_SEED) -> str:
    return f"('0x' || substr(md5('{seed}:' || {x}), 1, 8))::BIGINT"


def strip_html(x: str) -> str:
    inner = f"regexp_replace({x}, {_lit(_HTML_BLOCK)}, ' ', 'g')"
    inner = f"regexp_replace({inner}, {_lit(_HTML_TAG)}, ' ', 'g')"
    return f"regexp_replace({inner}, {_lit(_HTML_ENTITY)}, ' ', 'g')"


def _docs(group: str) -> str:
    return f"""
d AS (SELECT {group} || '-' || CAST(doc_id AS VARCHAR) AS id, {group} AS collection_id, text AS raw FROM documents),
c AS (SELECT id, collection_id, {clean('raw')} AS text FROM d),
w AS (SELECT *, {tokenize('text')} AS words FROM c),
p AS (SELECT *, {no_stop_words('words')} AS filtered FROM w)
"""


DOCS = _docs("source")


def _multiclass(scored: bool = False) -> str:
    classes = ["[" + ", ".join(_lit(w) for w in c.split(" ")) + "]::VARCHAR[]" for c in LANGUAGE_CLASSES]
    hits = "[" + ", ".join(f"list_has_all(filtered, {c})" for c in classes) + "]"
    any_words = " OR ".join(f"list_has_all(words, {c})" for c in classes)
    return f"""WITH {_docs('lang')},
l AS (SELECT p.*, coalesce(list_position({hits}, true), 0) AS cls, NOT ({any_words}) AS cand,
             {hash_unit('id')} AS h FROM p),
g AS (SELECT collection_id, count(*) FILTER (WHERE cls > 0)::DOUBLE / count(*) AS f FROM l GROUP BY collection_id),
t AS (SELECT id, collection_id, cls::DOUBLE AS label, len(words)::BIGINT AS n_features
FROM l JOIN g USING (collection_id)
WHERE cls > 0 OR (cand AND h < coalesce(f, 0.0) * {float(HASH_RANGE)}))
""" + (_STATUS if scored else "SELECT id, collection_id, label, n_features FROM t")


# What the score of every text rests on: the classes among its collection's
# training rows.
_STATUS = """, k AS (SELECT collection_id, count(DISTINCT label) AS k FROM t GROUP BY collection_id)
SELECT p.id, p.collection_id, CASE coalesce(k, 0) WHEN 0 THEN 'untrained' WHEN 1 THEN 'one_class' ELSE 'trained' END AS status
FROM p LEFT JOIN k USING (collection_id)"""

LABELS = f"""
l AS (SELECT p.*, list_has_all(filtered, {_PATTERN}) AS pos, NOT list_has_all(words, {_PATTERN}) AS cand,
             {hash_unit('id')} AS h FROM p),
g AS (SELECT collection_id, count(*) AS n_texts, count(*) FILTER (WHERE pos) AS n_positive,
             count(*) FILTER (WHERE cand) AS n_candidates FROM l GROUP BY collection_id),
gf AS (SELECT *, n_positive::DOUBLE / n_texts AS positive_fraction,
              least(1.0, n_positive::DOUBLE / nullif(n_candidates, 0)) AS balanced_fraction FROM g)
"""


def _training(fraction: str) -> str:
    return f"""
WITH {DOCS}, {LABELS},
t AS (SELECT l.id, l.collection_id, CASE WHEN pos THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
             len(l.words)::BIGINT AS n_features, l.h
      FROM l JOIN gf USING (collection_id)
      WHERE pos OR (cand AND h < coalesce({fraction}, 0.0) * {float(HASH_RANGE)}))
"""


_WORD = 4294967295  # 32 bits


def _turned(x: str, r: int) -> str:
    return f"(((({x}) << {r}) | (({x}) >> {32 - r})) & {_WORD}::UBIGINT)"


def _mixed(k: str) -> str:
    return f"(({_turned(f'((({k}) * 3432918353::UBIGINT) & {_WORD}::UBIGINT)', 15)} * 461845907::UBIGINT) & {_WORD}::UBIGINT)"


def _hashed_terms(source: str) -> str:
    """``hashed(term, h)``: the signed 32-bit Murmur3 hash (seed 42) of the
    UTF-8 bytes of every term of ``source``, as the library's hashing has it."""
    return f"""
h0 AS (SELECT DISTINCT term FROM {source}),
h1 AS (SELECT term, octet_length(encode(term)) AS n, list_transform(regexp_extract_all(hex(encode(term)), '..'), lambda x: ('0x' || x)::UBIGINT) AS b FROM h0),
h2 AS (SELECT term, n, list_transform(range(n // 4), lambda i: b[4*i+1] | (b[4*i+2] << 8) | (b[4*i+3] << 16) | (b[4*i+4] << 24)) AS k,
  list_reduce(list_prepend(0::UBIGINT, list_transform(range((n // 4) * 4, n), lambda i: b[i+1] << (8 * (i % 4)))), lambda x, y: x | y) AS tail FROM h1),
h3 AS (SELECT term, n, list_transform(k, lambda x: {_mixed('x')}) AS k, {_mixed('tail')} AS tail FROM h2),
h4 AS (SELECT term, n, tail, list_reduce(list_prepend(42::UBIGINT, k), lambda h, x: ({_turned('xor(h, x)', 13)} * 5 + 3864292196::UBIGINT) & {_WORD}::UBIGINT) AS h FROM h3),
h5 AS (SELECT term, xor(xor(h, tail), n::UBIGINT) AS h FROM h4),
h6 AS (SELECT term, (xor(h, h >> 16) * 2246822507::UBIGINT) & {_WORD}::UBIGINT AS h FROM h5),
h7 AS (SELECT term, (xor(h, h >> 13) * 3266489909::UBIGINT) & {_WORD}::UBIGINT AS h FROM h6),
h8 AS (SELECT term, xor(h, h >> 16) AS h FROM h7),
hashed AS (SELECT term, CASE WHEN h >= 2147483648 THEN h::BIGINT - 4294967296 ELSE h::BIGINT END AS h FROM h8)"""


def _features(sizes: tuple[int, ...]) -> str:
    """``tf``: hashed term frequencies of every document at every hash size;
    ``tr``: the training rows; ``df``: document frequencies over these."""
    every = ", ".join(str(n) for n in sizes)
    return (
        _training("positive_fraction")
        + f""", w0 AS (SELECT id, collection_id, unnest(words) AS term FROM p),
{_hashed_terms('w0')},
tf AS (SELECT id, collection_id, n AS num_features, (((h % n) + n) % n)::INTEGER AS idx, count(*)::DOUBLE AS tf
  FROM w0 JOIN hashed USING (term), (SELECT unnest([{every}]) AS n) GROUP BY ALL),
tr AS (SELECT id, collection_id, label FROM t),
nr AS (SELECT collection_id, count(*) AS n_rows FROM tr GROUP BY collection_id),
df AS (SELECT tf.collection_id, num_features, idx, count(*) AS df FROM tf SEMI JOIN tr USING (id) GROUP BY ALL)"""
    )


def _bayes() -> str:
    """``m``: priors and sums of the collections with both classes; ``wt``:
    the weights of their terms."""
    return (
        _features((BAYES_FEATURES,))
        + f""", s AS (SELECT tf.collection_id, idx, sum(CASE WHEN label = 1 THEN 0 ELSE tf END) AS s0, sum(CASE WHEN label = 1 THEN tf ELSE 0 END) AS s1 FROM tf JOIN tr USING (id) GROUP BY ALL),
x AS (SELECT s.collection_id, s.idx, ln((n_rows + 1.0) / (df + 1.0)) AS idf, s0, s1 FROM s JOIN df USING (collection_id, idx) JOIN nr USING (collection_id)),
m0 AS (SELECT collection_id, count(*) AS n, count(*) FILTER (WHERE label = 1) AS n1 FROM tr GROUP BY collection_id),
m AS (SELECT m0.*, ln(coalesce(sum(idf * s0), 0) + {float(BAYES_FEATURES)}) AS l0, ln(coalesce(sum(idf * s1), 0) + {float(BAYES_FEATURES)}) AS l1
  FROM m0 LEFT JOIN x USING (collection_id) GROUP BY ALL),
wt AS (SELECT x.collection_id, idx, idf, ln(idf * s0 + 1.0) - l0 AS w0, ln(idf * s1 + 1.0) - l1 AS w1 FROM x JOIN m USING (collection_id) WHERE n1 > 0 AND n1 < n)"""
    )


def _itemsets() -> str:
    """Sets grown by one larger word at a time, as long as they are frequent."""
    return f"""
WITH RECURSIVE u AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, role AS collection_id, text AS raw
      FROM conversations),
uc AS (SELECT id, collection_id, {clean('raw')} AS text FROM u),
uw AS (SELECT *, {no_stop_words(tokenize('text'))} AS filtered FROM uc),
e AS (SELECT DISTINCT id, collection_id, x AS w FROM uw, unnest(filtered) AS t(x) WHERE x <> ''),
th AS (SELECT collection_id, greatest(ceil({MINING_SUPPORT} * count(*)), {MINING_MIN_COUNT}) AS m FROM uc GROUP BY collection_id),
f1 AS (SELECT e.collection_id, e.w FROM e JOIN th USING (collection_id) GROUP BY e.collection_id, e.w, th.m HAVING count(*) >= th.m),
o1 AS MATERIALIZED (SELECT e.id, e.collection_id, [e.w] AS items, e.w AS last FROM e SEMI JOIN f1 ON f1.collection_id = e.collection_id AND f1.w = e.w),
grown AS (SELECT id, collection_id, items, last FROM o1
  UNION ALL
  SELECT id, collection_id, items, last FROM (
    SELECT *, count(*) OVER (PARTITION BY collection_id, items) AS n FROM (
      SELECT g.id, g.collection_id, list_append(g.items, x.last) AS items, x.last
      FROM grown g JOIN o1 x ON g.id = x.id AND g.collection_id = x.collection_id AND x.last > g.last)) JOIN th USING (collection_id) WHERE n >= m),
fs AS (SELECT collection_id, items, count(*) AS freq FROM grown GROUP BY collection_id, items)
"""


def _histogram(by: str = "event_type", value: str = "CAST(value AS DOUBLE)") -> str:
    lo, hi, w, v = "lo", "hi", "wd", "value"
    raw = f"least(9, CAST(floor((({v} - {lo}) / ({hi} - {lo})) * 10.0) AS INTEGER))"
    down = f"CASE WHEN {v} < {lo} + ({raw}) * {w} THEN ({raw}) - 1 ELSE ({raw}) END"
    up_edge = f"CASE WHEN ({down}) + 1 = 10 THEN {hi} ELSE {lo} + (({down}) + 1) * {w} END"
    idx = f"CASE WHEN {v} >= {up_edge} AND ({down}) <> 9 THEN ({down}) + 1 ELSE ({down}) END"
    return f"""
WITH ev AS (SELECT {by}, {value} AS value FROM events WHERE value IS NOT NULL),
mm AS (SELECT event_type, min(value) AS mn, max(value) AS mx FROM ev GROUP BY event_type),
st AS (SELECT event_type,
              CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
              CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM mm),
st2 AS (SELECT *, (hi - lo) / 10.0 AS wd FROM st),
b AS (SELECT ev.event_type, lo, hi, wd, {idx} AS bin FROM ev JOIN st2 USING (event_type))
SELECT event_type, bin, lo + bin * wd AS bin_lo, CASE WHEN bin = 9 THEN hi ELSE lo + (bin + 1) * wd END AS bin_hi,
       count(*) AS n
FROM b GROUP BY event_type, bin, lo, hi, wd
"""


def _cells() -> str:
    return f"""
WITH cm AS (
  SELECT source || '-' || CAST(doc_id AS VARCHAR) AS id, source AS collection_id, text AS value FROM documents
  UNION ALL
  SELECT source || '-' || CAST(doc_id AS VARCHAR), source, split_part(text, chr(10), 1) FROM documents
  WHERE contains(text, chr(10)))
SELECT id, collection_id, {clean('value')} AS text FROM cm
"""


def _cell_qualifiers() -> str:
    return """
WITH cl AS (
  SELECT 'metadata' AS column_family, 'lang' AS qualifier, lang AS value FROM documents
  UNION ALL SELECT 'collection-management', 'text', text FROM documents
  UNION ALL SELECT 'collection-management', 'title', split_part(text, chr(10), 1) FROM documents
            WHERE contains(text, chr(10))
  UNION ALL SELECT 'metadata', 'source', source FROM documents)
SELECT column_family, qualifier, count(*) AS n_cells, sum(length(value))::BIGINT AS n_chars
FROM cl GROUP BY column_family, qualifier
"""


def _prefix_collections() -> str:
    return """
WITH d AS (SELECT source || '-' || CAST(doc_id AS VARCHAR) AS id, source FROM documents),
cfg AS (SELECT DISTINCT source AS collection_id FROM documents),
dl AS (SELECT cfg.collection_id, count(*) AS n_delimited FROM d JOIN cfg ON d.source = cfg.collection_id
       GROUP BY cfg.collection_id),
rw AS (SELECT cfg.collection_id, count(*) AS n_raw FROM d JOIN cfg ON starts_with(d.id, cfg.collection_id)
       GROUP BY cfg.collection_id)
SELECT coalesce(dl.collection_id, rw.collection_id) AS collection_id, n_delimited, n_raw
FROM dl FULL OUTER JOIN rw ON dl.collection_id = rw.collection_id
"""


def _labelled() -> str:
    return f"""
WITH q AS (SELECT source AS collection_id, quality::DOUBLE AS label, {hash_unit('CAST(doc_id AS VARCHAR)')} / {float(HASH_RANGE)} AS probability
      FROM documents JOIN labels USING (doc_id)),
s AS (SELECT *, CASE WHEN probability > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM q)"""


def _lines() -> str:
    strip = f"regexp_replace(value, '^{_LINE_BLANKS}+|{_LINE_BLANKS}+$', '', 'g')"
    return f"""
WITH d AS (SELECT source || '-' || CAST(doc_id AS VARCHAR) || chr(9) || text AS rec FROM documents),
ln AS (SELECT unnest(string_split(rec, chr(10))) AS value FROM d),
f AS (SELECT string_split({strip}, chr(9)) AS f FROM ln)
SELECT f[1] AS id, split_part(f[1], '-', 1) AS collection_id, {clean('f[2]')} AS text
FROM f WHERE len(f) = 2
"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "clean_text": f"WITH {DOCS} SELECT id, collection_id, text FROM c",
        "tokens": f"""WITH {DOCS}
SELECT id, len(words)::BIGINT AS n_words, array_to_string(words, ' ') AS words,
       len(filtered)::BIGINT AS n_filtered, array_to_string(filtered, ' ') AS filtered,
       array_to_string({unique('filtered')}, ' ') AS items FROM p""",
        "cell_texts": _cells(),
        "cell_qualifiers": _cell_qualifiers(),
        "prefix_collections": _prefix_collections(),
        "line_texts": _lines(),
        "page_texts": f"SELECT page_id AS id, {clean(strip_html('html'))} AS text FROM pages",
        "event_props": """
SELECT event_type, count(*) AS n_events, count(CAST(json_extract(props, '$.k') AS BIGINT)) AS n_with_k,
       sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS sum_k
FROM events GROUP BY event_type""",
        "positive_share": f"""WITH {DOCS}, {LABELS}
SELECT collection_id, n_texts, n_positive, n_candidates, round(positive_fraction, 6) AS positive_fraction FROM gf""",
        "training_set": _training("positive_fraction") + "SELECT id, collection_id, label, n_features FROM t",
        "training_set_balanced": _training("balanced_fraction") + "SELECT id, collection_id, label, n_features FROM t",
        "multiclass_training_set": _multiclass(),
        "testing_set": f"""WITH {DOCS}
SELECT id, collection_id, len(words)::BIGINT AS n_features, array_to_string(words, ' ') AS features FROM p""",
        "audit_sample": _training("positive_fraction")
        + f""", r AS (SELECT collection_id, label, id,
        row_number() OVER (PARTITION BY collection_id, label ORDER BY h, id) AS sample_rank FROM t)
SELECT collection_id, label, sample_rank::BIGINT AS sample_rank, id FROM r WHERE sample_rank <= {AUDIT_K}""",
        "term_idf": f"""WITH {DOCS},
tm AS (SELECT DISTINCT id, unnest(words) AS term FROM p),
n AS (SELECT count(*) AS n FROM p)
SELECT term, count(*) AS df, round(ln((any_value(n.n) + 1.0) / (count(*) + 1.0)), 6) AS idf
FROM tm, n GROUP BY term""",
        "hashed_tf_idf": _features(FEATURE_SIZES)
        + """ SELECT tf.id, tf.collection_id, tf.num_features, tf.idx, tf.tf, round(ln((n_rows + 1.0) / (coalesce(df, 0) + 1.0)), 6) AS idf,
       round(tf.tf * ln((n_rows + 1.0) / (coalesce(df, 0) + 1.0)), 6) AS tf_idf
FROM tf LEFT JOIN nr USING (collection_id) LEFT JOIN df ON df.collection_id = tf.collection_id AND df.num_features = tf.num_features AND df.idx = tf.idx""",
        "fold_idf": _features(FEATURE_SIZES)
        + f""", fd AS (SELECT id, collection_id, ({hash_unit('id', CV_SEED)} % {NUM_FOLDS})::INTEGER AS fold FROM tr),
fo AS (SELECT collection_id, fold, count(*) AS n FROM fd GROUP BY ALL),
own AS (SELECT fd.collection_id, num_features, fold, idx, count(*) AS df FROM tf JOIN fd USING (id) GROUP BY ALL),
part AS (SELECT df.collection_id, df.num_features, fo.fold, df.idx, df.df - coalesce(own.df, 0) AS df, n_rows - fo.n AS n
  FROM df JOIN fo ON fo.collection_id = df.collection_id JOIN nr ON nr.collection_id = df.collection_id
  LEFT JOIN own ON own.collection_id = df.collection_id AND own.num_features = df.num_features AND own.fold = fo.fold AND own.idx = df.idx)
SELECT collection_id, num_features, fold, idx, df::BIGINT AS df, round(ln((n + 1.0) / (df + 1.0)), 6) AS idf FROM part""",
        "bayes_weights": _bayes() + " SELECT collection_id, idx, round(idf, 6) AS idf, round(w0, 6) AS weight_0, round(w1, 6) AS weight_1 FROM wt",
        "bayes_scores": _bayes()
        + """, r AS (SELECT p.id, p.collection_id, n, n1,
    ln(n - n1 + 1.0) - ln(n + 2.0) + coalesce(sum(tf.tf * coalesce(idf * w0, ln(n + 1.0) * -l0)), 0) AS r0,
    ln(n1 + 1.0) - ln(n + 2.0) + coalesce(sum(tf.tf * coalesce(idf * w1, ln(n + 1.0) * -l1)), 0) AS r1
  FROM p LEFT JOIN m USING (collection_id) LEFT JOIN tf ON tf.id = p.id LEFT JOIN wt ON wt.collection_id = p.collection_id AND wt.idx = tf.idx
  GROUP BY p.id, p.collection_id, n, n1, l0, l1)
SELECT id, collection_id,
  CASE WHEN n IS NULL THEN NULL WHEN n1 = 0 THEN 0.0 WHEN n1 = n THEN 1.0 WHEN r1 > r0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
  round(CASE WHEN n IS NULL THEN NULL WHEN n1 = 0 THEN 0.0 WHEN n1 = n THEN 1.0 ELSE exp(r1 - greatest(r0, r1)) / (exp(r0 - greatest(r0, r1)) + exp(r1 - greatest(r0, r1))) END::DOUBLE, 6) AS probability_relevant,
  CASE WHEN n IS NULL THEN 'untrained' WHEN n1 = 0 OR n1 = n THEN 'one_class' ELSE 'trained' END AS status
FROM r""",
        "quality_auc": _labelled()
        + """, k AS (SELECT collection_id, label, 'hash' AS kind, round(probability, 2) AS score FROM s
  UNION ALL SELECT source, quality::DOUBLE, 'length', length(text)::DOUBLE FROM documents JOIN labels USING (doc_id)),
r AS (SELECT collection_id, kind, label, rank() OVER (PARTITION BY collection_id, kind ORDER BY score) + (count(*) OVER (PARTITION BY collection_id, kind, score) - 1) / 2.0 AS mid FROM k WHERE score IS NOT NULL AND label IS NOT NULL),
a AS (SELECT collection_id, kind, count(*) FILTER (WHERE label > 0.5) AS np, count(*) FILTER (WHERE label <= 0.5) AS nn, coalesce(sum(mid) FILTER (WHERE label > 0.5), 0) AS ranks FROM r GROUP BY ALL)
SELECT collection_id, kind, np::BIGINT AS n_positive, nn::BIGINT AS n_negative, round((ranks - np * (np + 1) / 2.0) / nullif(np * nn, 0), 6) AS auc FROM a""",
        "frequent_itemsets": _itemsets()
        + """SELECT collection_id, array_to_string(items, ' ') AS items, len(items)::BIGINT AS size, freq::BIGINT AS freq,
       CAST(freq AS VARCHAR) || ' ' || array_to_string(items, ' ') AS line FROM fs""",
        "pattern_shortlist": _itemsets()
        + f""", r AS (SELECT collection_id, array_to_string(items, ' ') AS items, freq::BIGINT AS freq,
        row_number() OVER (PARTITION BY collection_id ORDER BY freq DESC, array_to_string(items, ' ')) AS rank
        FROM fs WHERE len(items) BETWEEN 2 AND 4)
SELECT collection_id, rank::BIGINT AS rank, items, freq FROM r WHERE rank <= {SHORTLIST_K}""",
        "event_histogram": _histogram(),
        "pattern_file_lines": _itemsets()
        + """SELECT collection_id, row_number() OVER (PARTITION BY collection_id ORDER BY freq DESC, items DESC)::BIGINT AS line_no,
       CAST(freq AS VARCHAR) || ' ' || array_to_string(items, ' ') AS line FROM fs""",
        "prediction_roundtrip": f"""SELECT CAST(event_id AS VARCHAR) AS id, event_type AS collection_id, '{RUN_STAMP}' AS run_ts,
       CAST(value AS DOUBLE) AS probability FROM events""",
        "file_histogram": f"""WITH h AS ({_histogram(value='CASE WHEN length(event_type) % 2 = 0 THEN value ELSE -value END::DOUBLE')})
SELECT event_type AS collection_id, CASE WHEN length(event_type) % 2 = 0 THEN '{RUN_STAMP}' ELSE '{OLDER_STAMP}' END AS run_ts, bin, bin_lo, bin_hi, n FROM h""",
        "running_counts": f"""SELECT event_type AS collection_id, count(*) AS n_texts, count(*) FILTER (WHERE value > {RELEVANT_VALUE}) AS n_relevant,
       round(count(*) FILTER (WHERE value > {RELEVANT_VALUE})::DOUBLE / count(*), 6) AS relevant_share FROM events GROUP BY event_type""",
        "score_cell_rows": """SELECT CAST(event_id AS VARCHAR) AS row_key, 'classification' AS column_family, 'probability2' AS qualifier,
       CAST(value AS DOUBLE) AS value FROM events""",
        "cell_store": """WITH d AS (SELECT source || '-' || CAST(doc_id AS VARCHAR) AS row_key, doc_id, lang, n_chars FROM documents)
SELECT row_key, 'metadata' AS column_family, 'lang' AS qualifier, CASE WHEN doc_id % 3 = 0 THEN upper(lang) ELSE lang END AS value FROM d
UNION ALL SELECT row_key, 'collection-management', 'chars', CAST(n_chars AS VARCHAR) FROM d""",
        "run_names": """SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') || '_' || CAST(event_id AS VARCHAR) || '_' || event_type AS output_name FROM events""",
        "fold_numbers": f"""WITH d AS (SELECT source || '-' || CAST(doc_id AS VARCHAR) AS id, source AS collection_id FROM documents)
SELECT id, collection_id, {hash_unit('id', CV_SEED)} % {NUM_FOLDS} AS fold FROM d""",
        "vector_probability": "SELECT event_id, CAST(value AS DOUBLE) AS probability FROM events WHERE value IS NOT NULL",
        "label_error": _labelled() + """, n AS (SELECT source AS collection_id, count(*) AS n_texts FROM documents GROUP BY source)
SELECT collection_id, any_value(n_texts) AS n_texts, count(*) AS n_training, count(*) FILTER (label <> prediction) AS n_wrong,
       round(count(*) FILTER (label <> prediction)::DOUBLE / any_value(n_texts), 6) AS error_all_texts,
       round(count(*) FILTER (label <> prediction)::DOUBLE / count(*), 6) AS error_training
FROM s JOIN n USING (collection_id) GROUP BY collection_id""",
        "label_share": _labelled() + """
SELECT collection_id, count(*) AS n_texts, count(*) FILTER (prediction = 1.0) AS n_relevant,
       round(avg(prediction), 6) AS relevant_share, round(avg(probability), 6) AS mean_probability
FROM s GROUP BY collection_id""",
        "scored_ids": _training("positive_fraction") + _STATUS,
        "multiclass_scored_ids": _multiclass(scored=True),
    }
    return sql
