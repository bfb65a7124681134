import random

from brute import dedup_lines as plain

from relevo.llm import line_dedup as m


def _rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    base = [[rng.choice(words) for _ in range(n)] for n in (5, 9, 20, 80, 120)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(4):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(len(line) // 5 + 1)):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(" ".join(line) + rng.choice(["", "  ", " END"]))
        rows.append((i, "\n".join(lines)))
    return rows


def test_equal_to_all_pairs(spark, monkeypatch):
    rows = _rows()
    docs = spark.createDataFrame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, no int, gone string").repartition(3)
    want = plain(rows)
    for crowd, part in ((256, 4096), (3, 5)):  # no crowded word, and nearly all of them
        monkeypatch.setattr(m, "CROWD", crowd)
        monkeypatch.setattr(m, "PART", part)
        out = m.dedup_lines(docs).collect()
        assert {r.doc_id: r.text for r in out} == want
        assert all(r.no == 9 and r.gone == "x" for r in out)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    out = m.dedup_lines(odd_docs).collect()
    assert len(out) == len(odd_rows)
    by_id = {r.doc_id: r for r in out}
    want = plain([r for k, r in enumerate(odd_rows) if r not in odd_rows[:k]])
    assert by_id[3].text is None and by_id[3]._n_lines == 0 and by_id[2].text == ""
    assert all(by_id[i].text == t for i, t in want.items() if i != 3)
    assert m.dedup_lines(no_docs).count() == 0
    kept = m.remove_repeated_lines(odd_docs.withColumn("n_chars", odd_docs["doc_id"] * 0))
    assert {2, 3, 8} <= {r.doc_id for r in kept.collect()} and 5 not in {r.doc_id for r in kept.collect()}


def test_rows_that_share_an_id(spark):
    rows = [(1, "one two three\nfour five six"), (1, "one two three\nseven eight nine"), (None, "one two three"), (2, "seven eight nine")]
    out = sorted((r.doc_id or 0, r.text) for r in m.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(0, "one two three"), (1, "four five six"), (1, "seven eight nine"), (2, "")]


def test_repeated_row_keeps_its_lines(spark, monkeypatch):
    rows = [(1, "one two three\nfour five six"), (1, "one two three\nfour five six"), (2, "seven eight nine\nseven eight nine"), (2, "seven eight nine\nseven eight nine"), (3, "four five six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(1, rows[0][1]), (1, rows[0][1]), (2, "seven eight nine"), (2, "seven eight nine")]
    for crowd in (256, 0):
        monkeypatch.setattr(m, "CROWD", crowd)
        assert sorted((r.doc_id, r.text) for r in m.dedup_lines(docs).collect()) == [*want, (3, "")]
        assert sorted((r.doc_id, r.text) for r in m.remove_repeated_lines(docs).collect()) == want


def test_punctuation_tab_and_crlf_part_words(spark):
    rows = [(1, "Of sh."), (2, "Of, | sh.!!\nnew one"), (3, "of\tSH\r\n!! |\nnew-one\r"), (4, "of sh\t\r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in m.remove_repeated_lines(docs).collect()}
    assert out == {1: "Of sh.", 2: "new one"}  # of 3 only a line without words is left
    only_blanks = {r.doc_id: r.text for r in m.remove_repeated_lines(docs, blanks="").collect()}
    assert only_blanks[3] == rows[2][1] and 4 in only_blanks
