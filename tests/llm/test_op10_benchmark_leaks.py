import random

import numpy as np
import pytest

from skeinwork.llm import benchmark_leaks as D
from skeinwork.llm.words import Words


def naive(a, b):
    best, table = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (D.MATCH if x == y else D.MISMATCH), table[i - 1][j] + D.GAP, table[i][j - 1] + D.GAP)
            best = max(best, table[i][j])
    return best


def test_alignment_against_the_textbook():
    r = random.Random(1)
    for _ in range(200):
        a, b = [np.array([r.randrange(4) for _ in range(r.randrange(0, 12))]) for _ in range(2)]
        assert D.smith_waterman(a, b) == naive(list(a), list(b))


def paraphrase(text, seed, share=0.15):
    r, out = random.Random(seed), []
    for w in text.split():
        x = r.random()
        out += [] if x < share / 3 else [f"other{r.randrange(999)}"] if x < 2 * share / 3 else [w, "extra"] if x < share else [w]
    return " ".join(out)


def corpus(prose):
    items = [(i, prose(1000 + i, 20 + i)) for i in range(30)] + [(50, None), (51, ""), (52, "two zebras")]
    text = dict(items)
    docs = [(i, prose(i, 200)) for i in range(60)]
    docs += [(100 + i, prose(i, 50) + " " + text[i % 30] + ". " + prose(2 * i, 60)) for i in range(40)]
    docs += [(200 + i, prose(i, 50) + "\n" + paraphrase(text[i], i).upper() + "\n" + prose(3 * i, 60)) for i in range(30)]
    docs += [(300, None), (301, ""), (302, prose(9, 30000) + " " + text[3]), (303, "here are two zebras"), (304, " ".join(text[4].split()[:4])), (100, prose(0, 50) + " " + text[0] + ". " + prose(0, 60))]
    return docs, items


def brute(docs, items):
    """Leaks by aligning every document, whole, with every item."""
    out = set()
    hashes = lambda t: Words([t or ""]).hash
    held = [(i, hashes(t)) for i, t in items]
    for d, t in docs:
        w = hashes(t)
        for i, own in held:
            if len(own) >= D.GRAM and D.smith_waterman(own, w) >= min(D.ENOUGH * D.MATCH * len(own), D.MATCH * D.SPAN):
                out.add((d, i))
            elif 0 < len(own) < D.GRAM and any(np.array_equal(w[k : k + len(own)], own) for k in range(len(w))):
                out.add((d, i))
    return out


def test_leaks_against_brute_force(spark, documents, prose, monkeypatch):
    docs, items = corpus(prose)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(docs).selectExpr("*", "1 as item_id", "2 as score")
    got = [(r.doc_id, r.item_id) for r in D.leaks(df, bench).collect()]
    want = brute(docs, items)
    assert set(got) == want and {(100 + i, i % 30) for i in range(40)} | {(200 + i, i) for i in range(30)} <= want and len(got) == len(want) + 1
    assert not {d for d, _ in want} & set(range(60))
    monkeypatch.setattr(D, "ITEM_BLOCK", 7)
    blocks = list(D.item_blocks(bench, rows=7))
    assert len(blocks) == 5
    clean = D.clean_documents(df, bench)
    assert clean.columns == df.columns and {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_empty_sides(spark, documents):
    none, some = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    assert D.leaks(documents([(1, "a b c d")]), none).count() == 0 and D.leaks(documents([]), some).count() == 0
    assert D.clean_documents(documents([(1, "a b c d"), (2, "e")]), none).count() == 2


def test_blocks_of_items_join_up(spark, documents, prose):
    docs, items = corpus(prose)
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in D.leaks(documents(docs), bench).collect()}
    parts = set()
    for block in D.item_blocks(bench, rows=11):
        parts |= {(r.doc_id, r.item_id) for r in D.leaks(documents(docs), spark.createDataFrame(block, "item_id long, text string")).collect()}
    assert parts == whole


def test_heavy_edits_against_brute_force(spark, documents, prose):
    """Copies with every 3rd to 6th word replaced, dropped or followed by another: none keeps a run of 6 words."""
    items = [(i, prose(1000 + i, 16 + 2 * i)) for i in range(22)] + [(90, prose(77, 260)), (91, "pi rho sigma")]
    docs = [(i, prose(i, 150)) for i in range(20)]
    for i, t in items:
        w = t.split()
        for k in range(2, 7):
            for kind, f in enumerate((lambda x: ["other"], lambda x: [], lambda x: [x, "extra"])):
                copy = [y for j, x in enumerate(w) for y in (f(x) if j % k == k - 1 else [x])]
                docs.append((1000 * (i + 1) + 10 * k + kind, f"{prose(i, 30)} {' '.join(copy)} {prose(3 * i, 30)}"))
        docs.append((1000 * (i + 1), " extra ".join(w)))
    want = brute(docs, items)
    assert {(1000 * (i + 1) + 10 * k, i) for i in range(22) for k in (4, 5, 6)} <= want
    got = D.leaks(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == len(want) and {(r.doc_id, r.item_id) for r in got} == want
    text, size = dict(docs), dict(items)
    for r in got:
        words = Words([text[r.doc_id]]).hash
        own = Words([size[r.item_id]]).hash
        assert D.smith_waterman(own, words) == D.smith_waterman(own, words[r.first_word : r.last_word]) == round(r.score * 2 * len(own))


def test_short_items_that_repeat(spark, documents):
    rows = [(1, "here two zebras and two zebras"), (2, "Two, ZEBRAS"), (3, "zebras two"), (4, None)]
    items = spark.createDataFrame([(1, "two zebras"), (2, "two zebras"), (3, "zebras"), (1, "two zebras"), (4, ""), (5, "gnu")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.first_word, r.last_word, r.score) for r in D.leaks(documents(rows), items).collect())
    assert got == sorted([(1, 1, 1, 3, 1.0), (1, 1, 1, 3, 1.0), (1, 2, 1, 3, 1.0), (1, 3, 2, 3, 1.0), (2, 1, 0, 2, 1.0), (2, 1, 0, 2, 1.0), (2, 2, 0, 2, 1.0), (2, 3, 1, 2, 1.0), (3, 3, 0, 1, 1.0)])


@pytest.mark.parametrize("share", [0.1, 0.2, 0.3, 0.4])
def test_recall_over_edit_rates(spark, documents, prose, share):
    """Every copy that brute alignment calls a leak is found, however much of it was edited."""
    r = random.Random(int(share * 10))
    items = [(i, prose(i, r.randrange(16, 60))) for i in range(30)]
    rows = []
    for k in range(120):
        item = items[k % 30][1]
        copy = []
        for w in item.split():
            x = r.random()
            copy += [w] if x >= share else [] if x < share / 4 else [f"new{r.randrange(9999)}"] if x < share * 0.8 else [w, f"more{r.randrange(99)}"]
        rows.append((1000 + k, prose(5000 + k, 60) + " " + " ".join(copy) + " " + prose(7000 + k, 60)))
    got = {(x.doc_id, x.item_id) for x in D.leaks(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    hashes = {i: Words([t]).hash for i, t in items}
    want = set()
    for d, t in rows:
        h = Words([t]).hash
        for i, own in hashes.items():
            if D.smith_waterman(own, h) >= min(D.ENOUGH * D.MATCH * len(own), D.MATCH * D.SPAN):
                want.add((d, i))
    assert got == want and len(want) >= (100 if share < 0.3 else 20)
