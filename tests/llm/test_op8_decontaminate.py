import hashlib
import random
import re

import pytest

from ingestflow.llm import decontaminate as dc
from ingestflow.llm.common import Workspace, read_table
from tests.conftest import SF_SMALL

DOC = "doc_id long, text string, segment string, n_words string"
ITEM = "item_id long, text string, ordinal string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def brute(docs, items, size=10):
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for item, t in items:
            tw = words(t)
            n = min(size, len(tw))
            windows = {tuple(tw[i:i + n]) for i in range(len(tw) - n + 1)} if n else set()
            for i in range(len(w) - n + 1) if n else ():
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names.add("null" if item is None else str(item))
        out.append((doc, len(w), len(hit), len(names),
                    hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, size=10):
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOC)
    b = spark.createDataFrame([(i, t, "x") for i, t in items], ITEM)
    index = dc.build_index(d, Workspace(spark, "t"))
    got = dc.document_hits(index, dc.find_windows(index, b, size))
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_given_tables_equal_brute_force(spark):
    from ingestflow.llm.queries import op8_decontaminate
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    got = sorted((tuple(r) for r in op8_decontaminate(spark, SF_SMALL).collect()), key=str)
    assert got == brute(docs, items)
    assert any(r[5] for r in got)


@pytest.mark.parametrize("segment, block", [(1 << 17, 1 << 20), (30, 12)])
def test_random_texts_in_any_segments_and_blocks(spark, monkeypatch, segment, block):
    monkeypatch.setattr(dc, "SEGMENT_WORDS", segment)
    monkeypatch.setattr(dc, "BLOCK_WORDS", block)
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(60)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))) for i in range(12)]
    assert run(spark, docs, items, 5) == brute(docs, items, 5)


def test_edge_cases(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, None), (2, ""), (3, item), (3, item), (None, "x " + item.upper() + " y"), (4, "..!"),
            (5, "w " * 60000 + item), (6, item.replace(" ", "--")), (7, "short ITEM"), (8, "shorter item"),
            (9, "é" + item), (10, "one two three four five six seven eight nine ten")]
    items = [(1, item), (1, "short item"), (2, None), (3, ""), (4, "?!"), (None, "short item"), (20, item)]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a b")], []) == brute([(1, "a b")], [])


def test_matches_do_not_cross_documents(spark):
    assert run(spark, [(1, "a b"), (2, "c d")], [(1, "b c")], 2) == brute([(1, "a b"), (2, "c d")], [(1, "b c")], 2)


def test_proximity(spark):
    d = spark.createDataFrame([(1, "alpha x beta y gamma z delta", "", ""),
                               (2, "alpha " + "x " * 30 + "beta gamma delta", "", ""),
                               (3, "delta gamma beta alpha", "", ""), (4, "alpha beta", "", "")], DOC)
    b = spark.createDataFrame([(7, "alpha beta gamma delta", "")], ITEM)
    index = dc.build_index(d, Workspace(spark, "t"))
    got = dc.find_near(index, b, terms=4, span=8).join(
        dc.document_hits(index, dc.find_windows(index, b)).limit(0).select(), how="left")
    rows = {(r.ordinal, r.start, r.end) for r in got.collect()}
    assert len(rows) == 2 and {(s, e) for _, s, e in rows} == {(0, 7), (0, 4)}


def near_by_hand(text, chosen, rarest, span):
    """Words in any window of at most ``span`` words, around the rarest term, that no smaller one of its place beats."""
    w, out = words(text), set()
    for x in (i for i, word in enumerate(w) if word == rarest):
        fits = [(b - a, a, b) for a in range(x + 1) for b in range(x + 1, len(w) + 1) if chosen <= set(w[a:b])]
        if fits and min(fits)[0] <= span:
            out.add((x, min(fits)[0]))
    return out


@pytest.mark.parametrize("span", [4, 6, 9])
def test_proximity_with_repeated_terms_equals_brute_force(spark, span):
    rng = random.Random(span)
    texts = [" ".join(rng.choice("abcdxyz") for _ in range(rng.randint(0, 25))) for _ in range(80)]
    texts.append("x " * 92 + "b " + "x " * 7 + "a " + "x " * 8 + "b x x x c d")
    d = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOC).coalesce(1)
    index = dc.build_index(d, Workspace(spark, "t"))
    counts = {c: sum(t.split().count(c) for t in texts) for c in "abcd"}
    rarest = min("abcd", key=lambda c: counts[c])
    assert sorted(counts.values())[0] < sorted(counts.values())[1]
    found = {}
    for r in dc.find_near(index, spark.createDataFrame([(7, "a b c d", "")], ITEM), terms=4, span=span).collect():
        found.setdefault(r.ordinal, []).append((r.start, r.end))
    for i, text in enumerate(texts):
        want = near_by_hand(text, set("abcd"), rarest, span)
        assert bool(want) == (i in found), text
        for a, b in found.get(i, []):
            assert set("abcd") <= set(words(text)[a:b])
        for x, _ in want:
            assert any(a <= x < b for a, b in found[i])


def test_proximity_of_one_place_takes_the_smallest_window(spark):
    text = " ".join({92: "t", 100: "r", 109: "t", 113: "u"}.get(i, "x") for i in range(120))
    other = "t u x u t"  # more of the others, in the next document
    d = spark.createDataFrame([(1, text, "", ""), (2, other, "", "")], DOC).coalesce(1)
    got = dc.find_near(dc.build_index(d, Workspace(spark, "t")),
                       spark.createDataFrame([(7, "r t u", "")], ITEM), terms=3, span=20).collect()
    assert [(r.ordinal, r.start, r.end) for r in got] == [(0, 100, 114)]


def test_the_driver_holds_one_block_of_windows(spark, monkeypatch):
    import gc
    monkeypatch.setattr(dc, "BLOCK_WORDS", 4)
    held = {id(x) for x in gc.get_objects() if isinstance(x, dc.Windows)}
    docs = [(n, f"a b c d{n} e") for n in range(9)]
    items = [(n, f"c d{n} e") for n in range(6)]
    index = dc.build_index(spark.createDataFrame([(i, t, "", "") for i, t in docs], DOC), Workspace(spark, "t"))
    found = dc.find_windows(index, spark.createDataFrame([(i, t, "") for i, t in items], ITEM), 3)
    gc.collect()
    assert sum(isinstance(x, dc.Windows) and id(x) not in held for x in gc.get_objects()) <= 1
    assert sorted(r.item_id for r in found.collect()) == [str(n) for n in range(6)]
