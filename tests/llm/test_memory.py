"""What a Python worker holds at a time."""

from pyspark.sql import types as T

from relevo.llm.common import map_columns
from relevo.llm.sentencepiece_fst import Transducer
from relevo.llm.word_cache import SLICE


def test_batches_of_long_texts_come_in_parts(spark):
    rows = [(i, "x" * (SLICE // 5) if i % 2 else None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def held(texts):
        return [[sum(len(t or "") for t in texts)] * len(texts)]

    found = map_columns(docs, ["text"], [T.StructField("held", T.LongType())], held).select("doc_id", "held").collect()
    assert [r["doc_id"] for r in found] == list(range(40))
    assert max(r["held"] for r in found) <= SLICE


def test_known_pairs_share_their_pieces():
    fst = Transducer([(p, -float(i), 1) for i, p in enumerate(["ab", "cd", "abcd", "a", "b", "c", "d", "▁"])], True, False, True)
    for text in ("ab cd", "cdab", "dcba abcd", "aabbccdd"):
        fst.encode(text)
    pieces = {id(p) for pair in fst.pairs for p in pair}
    assert len(pieces) == len({p for pair in fst.pairs for p in pair})
