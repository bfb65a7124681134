import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from relevo.llm import alignment as m

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


def plain(rows, libraries):
    """The result for (doc_id, text) rows from whole texts' tokens."""
    a_lib, b_lib = libraries
    byte = {}
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    for b in shown:
        byte[chr(b)] = b
    for k, b in enumerate(b for b in range(256) if b not in shown):
        byte[chr(256 + k)] = b
    docs, counts = [], Counter()
    for i, t in rows:
        a, b = ([], []) if not t else (a_lib.encode(" " + t, add_special_tokens=False).ids, b_lib.encode(t))
        a_bytes = [bytes(byte[c] for c in a_lib.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(b_lib.id_to_piece(x)[3:5], 16)]) if b_lib.is_byte(x) else b_lib.id_to_piece(x).replace("▁", " ").encode() for x in b]
        want = (" " + t).encode() if t else b""
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want or not t:
            docs.append((i, [], [], [], []))
            continue
        ends_a, ends_b = np.cumsum([*map(len, a_bytes)]).tolist(), np.cumsum([*map(len, b_bytes)]).tolist()
        links = [(x, y) for x, ea, la in zip(a, ends_a, a_bytes, strict=True) for y, eb, lb in zip(b, ends_b, b_bytes, strict=True) if max(ea - len(la), eb - len(lb)) < min(ea, eb)]
        both = sorted({*ends_a} & {*ends_b})
        groups, low = [], 0
        for end in both:
            groups.append([",".join(str(x) for x, e in zip(ids, ends, strict=True) if low < e <= end) for ids, ends in ((a, ends_a), (b, ends_b))])
            low = end
        docs.append((i, a, b, groups, links))
        counts.update(links)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    out = []
    for i, a, b, groups, links in docs:
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(groups), len(links), digest, sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links)))
    return sorted(out, key=repr)


def odd_texts():
    texts = ["", " ", "   x  y    ", "\n", "\n\n  \nfoo", "▁", "a▁b", "<s>", "<|endoftext|> <unk> </s> <0x0A>", "é日本語 العربية 😀", "\x00\t x", "a" * 3000, " " * 37 + "x", "it's we'll\nthey're", "x\x0by\x1cz\x85w v 　u", "line\r\nline\n\tend ", None, "same words here", "same words here"]
    rng = random.Random(1)
    alphabet = " \n  abcdetheing'sñ0123456789.,!?\"<>_-日本😀́ \t"
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(600)]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_whole_texts(spark, libraries, odd_docs, odd_rows, no_docs):
    rows = [*((i // 2 if i % 7 else None, t) for i, t in enumerate(odd_texts())), *odd_rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = plain(rows, libraries)
    assert result(m.align_documents(docs)) == want
    assert result(m.align_documents(odd_docs)) == plain(odd_rows, libraries)
    assert m.align_documents(no_docs).collect() == []


def test_many_small_runs_and_levels(spark, libraries, monkeypatch):
    monkeypatch.setattr(m, "RUN_CHARS", 200)
    monkeypatch.setattr(m, "BLOCK", 16)
    monkeypatch.setattr(m, "KNOWN_CHUNKS", 60)
    rows = list(enumerate(odd_texts()))[:300]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(m.align_documents(docs, radix=5, fan=3)) == plain(rows, libraries)


def test_room_is_made_for_frequent_chunks(libraries, monkeypatch):
    """Alignments stay the same when chunks are forgotten, and frequent ones
    are kept."""
    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public.path("piece_bpe_32k.model"), "rb") as b:
        aligner = m.Aligner(a.read(), b.read())
    texts = [t for t in odd_texts() if t] + ["often met words " * 3 + f"rare{i}" for i in range(300)]
    plenty = [m.make_run(aligner, [t])[0] for t in texts]
    aligner.reset()
    monkeypatch.setattr(m, "KNOWN_CHUNKS", 40)
    tight = [m.make_run(aligner, [t])[0] for t in texts]
    assert tight == plenty and len(aligner.groups) < 200
    aligner.make_room()
    assert {" often", " met", " words"} & set(aligner.index) and " rare7" not in aligner.index


def test_merge_and_blocks():
    rng = np.random.default_rng(3)
    runs, want = [], Counter()
    for _ in range(7):
        pairs = np.unique(rng.integers(0, 60_000, 20_000))
        sums = rng.integers(1, 9, len(pairs))
        want.update(dict(zip(pairs.tolist(), sums.tolist(), strict=True)))
        data = m.pack_blocks(pairs, sums)
        assert all(np.array_equal(x, y) for x, y in zip(m.whole(data, 2), (pairs, sums), strict=True))
        runs.append(data)
    got = {}
    last = -1
    for pairs, sums in m.merge_runs(runs):
        assert pairs[0] > last and (np.diff(pairs) > 0).all()
        last = pairs[-1]
        got.update(zip(pairs.tolist(), sums.tolist(), strict=True))
    assert got == want


def test_query(spark, sf_small, libraries):
    rows = [tuple(r) for r in spark.read.parquet(os.path.join(sf_small, "documents.parquet")).select("doc_id", "text").orderBy("doc_id").collect()]
    short = [r for r in rows if len(r[1] or "") < 1500]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    assert result(m.align_documents(docs).select(*names)) == plain(short, libraries)
    whole = {r.doc_id: r for r in m.query(spark, sf_small).collect()}
    assert len(whole) == len(rows)
    for r in plain(short, libraries):
        assert tuple(whole[r[0]][n] for n in names[:6]) == r[:6]
