"""Cleaning, tokens and stop words (FIXTURES §3 edge rows)."""

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from relevo.functions import (
    ENGLISH_STOP_WORDS,
    clean_text,
    contains_all,
    remove_stop_words,
    strip_html,
    tokenize,
    unique_tokens,
)

# (text, cleaned) pairs; expected values follow the cleaning rule in ASCII mode.
EDGE_ROWS = [
    ("RT @user_name: see http://a.b/c?d=1 now #Tag", "name see now Tag"),
    ("x\ty abc\tdef", "x\ty abc\tdef"),
    ("cafés naïve seehttp://foo bar", "caf bar"),
    ("\U0001F600\U0001F600 hi yes", "yes"),
    ("aéb://x.y/zzz tail", "tail"),
    ("foo://bar\u00a0baz qux", "qux"),
    ("", ""),
    ("   \t  ", ""),
    ("line1\nline2 abc", "line1 line2 abc"),
    ("ab\x0bhttp://q\x0bzed", "zed"),
    ("@éabc @abcédef", "abc def"),
]


def test_clean_text_edge_rows(spark):
    df = spark.createDataFrame([(t,) for t, _ in EDGE_ROWS], "t string")
    got = [r[0] for r in df.select(clean_text("t")).collect()]
    assert got == [c for _, c in EDGE_ROWS]


TOKEN_CASES = ["", "abc", "Abc DEF", "x\ty abc\tdef", "ab\t", "\t\t\t", "abc\t\tdef", "a  b", "abc  "]


def test_tokenize_equals_ml_tokenizer(spark):
    df = spark.createDataFrame([(t,) for t in TOKEN_CASES], "text string")
    ours = [r[0] for r in df.select(tokenize("text")).collect()]
    ref = [r[0] for r in Tokenizer(inputCol="text", outputCol="w").transform(df).select("w").collect()]
    assert ours == ref


def test_stop_word_list_is_spark_default(spark):
    assert list(ENGLISH_STOP_WORDS) == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_remove_stop_words_equals_ml_remover(spark):
    rows = [(["the", "The", "cat", "", "i'll", "dog", "cat"],), ([],), ([""],)]
    df = spark.createDataFrame(rows, "words array<string>")
    ours = [r[0] for r in df.select(remove_stop_words("words")).collect()]
    ref = [r[0] for r in StopWordsRemover(inputCol="words", outputCol="f").transform(df).select("f").collect()]
    assert ours == ref


def test_stop_words_use_hash_set(spark):
    df = spark.createDataFrame([(["a", "b"],)], "words array<string>")
    plan = df.select(remove_stop_words("words").alias("f"))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan.upper()


def test_unique_tokens(spark):
    df = spark.createDataFrame([(["b", "a", "", "b"],), ([""],)], "w array<string>")
    assert [r[0] for r in df.select(unique_tokens("w")).collect()] == [["a", "b"], []]


@pytest.mark.parametrize(
    "tokens,pattern,expected",
    [(["a", "b"], ["a"], True), (["a"], ["a", "b"], False), (["a"], [], True), ([], [], True)],
)
def test_contains_all(spark, tokens, pattern, expected):
    df = spark.createDataFrame([(tokens, pattern)], "t array<string>, p array<string>")
    assert df.select(contains_all("t", F.col("p"))).first()[0] is expected


def test_strip_html(spark):
    html = '<html><head><script>var t="</p>";</script><style>p{}</style></head><body><p>Hello &amp; world</p><!-- x --></body></html>'
    df = spark.createDataFrame([(html,)], "h string")
    got = df.select(clean_text(strip_html("h"))).first()[0]
    assert got == "Hello world"


def test_linear_pattern_equals_fixed_pattern(spark):
    """Property check on random strings over the characters that matter."""
    import random

    from relevo.functions.text import CLEAN_PATTERN, CLEAN_PATTERN_LINEAR

    rng = random.Random(11)
    alphabet = ["a", "B", "7", "_", "@", ":", "/", " ", "\t", "\x0b", "é", "-", "ab", "://", "http", "@x"]
    rows = [("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "t string")
    a = F.regexp_replace("t", F.lit(CLEAN_PATTERN), F.lit(" "))
    b = F.regexp_replace("t", F.lit(CLEAN_PATTERN_LINEAR), F.lit(" "))
    assert df.filter(a != b).count() == 0


def test_keep_long_terms_equals_split_filter_join(spark):
    import random

    from relevo.functions.text import keep_long_terms

    rng = random.Random(5)
    alphabet = ["a", "b", "c", " ", " ", "\t", "xy", "abc"]
    rows = [("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))),) for _ in range(3000)]
    rows += [("",), (" ",), ("ab",), ("abc",), (" abc ",), ("a\tb",), ("ab\t cd",)]
    df = spark.createDataFrame(rows, "t string")
    ref = F.array_join(F.filter(F.split("t", " "), lambda x: F.length(x) >= 3), " ")
    assert df.filter(keep_long_terms("t") != ref).count() == 0


def test_clean_text_makes_signs_once(spark):
    """The character table's result is used several times, but made once."""
    plan = spark.createDataFrame([("a",)], "t string").select(clean_text("t").alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1


def test_tokenize_drops_no_more_than_its_pattern(spark):
    ends = ["", " ", "\t", "\n", "\r\n", "\x0b", "\x0c", "\u0085", " ", "  ", " ", "  \n "]
    rows = [(start + end,) for start in ("", "Abc", "ab cD", " x", "É ") for end in ends] + [(None,)]
    df = spark.createDataFrame(rows, "t string")
    low = F.lower("t")
    body = F.regexp_replace(low, r"\s+$", "")
    ref = F.when(low == "", F.array(F.lit(""))).when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"\s"))
    assert df.filter(~tokenize("t").eqNullSafe(ref)).count() == 0
