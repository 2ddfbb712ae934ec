import random
from collections import Counter

import numpy as np
import pytest

from skeinwork.llm import simhash_groups as G


def edit(text, seed, share=0.06):
    r = random.Random(seed)
    return " ".join(f"new{r.randrange(99999)}" if r.random() < share else w for w in text.split())


def brute(texts, reach=G.REACH):
    """(group number, links) of each distinct text by all pairs."""
    bits = np.unpackbits(G.fingerprints(texts).view(np.uint8), axis=1)
    near = (bits[:, None, :] != bits[None, :, :]).sum(2) <= reach
    np.fill_diagonal(near, False)
    group = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(near)):
            m = min(group[i], group[j])
            changed |= group[i] != m or group[j] != m
            group[i] = group[j] = m
    return group, near.sum(1).tolist()


def corpus(prose):
    rows = [(i, prose(i, 40 + i)) for i in range(60)]
    rows += [(100 + i, edit(prose(i % 8, 40 + i % 8), i)) for i in range(48)]  # near copies
    rows += [(200 + i, prose(5, 45)) for i in range(20)] + [(300, None), (301, ""), (302, "!!!"), (303, "???"), (304, "One."), (305, "one!"), (None, prose(5, 45)), (306, prose(1, 30000)), (200, prose(5, 45))]
    return rows


@pytest.mark.parametrize("settings", [{}, {"small": 2}, {"small": 2, "split": 6}])
def test_groups_against_all_pairs(documents, prose, settings):
    rows = corpus(prose)
    texts = sorted({t or "" for _, t in rows})
    group, links = brute(texts)
    got = G.near_duplicates(documents(rows), recall=0.9999, **settings).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    number = {t: g for t, g in zip(texts, group)}
    first = {}
    for i, t in rows:
        g = number[t or ""]
        first[g] = min(first.get(g, 10**9), i if i is not None else 10**9)
    copies = Counter(t or "" for _, t in rows)
    by_id = {i: t or "" for i, t in rows}
    for r in got:
        t = prose(5, 45) if r.doc_id is None else by_id[r.doc_id]
        assert (r.class_id, r.n_links, r.n_copies) == (first[number[t]], links[texts.index(t)], copies[t]), r
    kept = [r.doc_id for r in got if r.keep]
    assert sorted(kept) == sorted(first.values())


def test_recall_meets_the_target():
    r = np.random.default_rng(1)
    base = r.integers(0, 1 << 63, (400, G.LANES), dtype=np.uint64)
    flip = np.zeros((400, G.BITS), dtype=np.uint8)
    for i in range(400):
        flip[i, r.permutation(G.BITS)[: G.REACH]] = 1
    other = base ^ np.packbits(flip, axis=1, bitorder="little").view(np.uint64)
    for n, strips in ((1000, [3]), (300_000, [7, 3, 3, 3]), (20_000_000, [23, 3])):
        s = G.Search(n)
        met = np.zeros(400, dtype=bool)
        for rows, path in s.members(np.concatenate([base, other])):
            a, b = set(zip(rows[rows < 400], path[rows < 400])), set(zip(rows[rows >= 400] - 400, path[rows >= 400]))
            met[[i for i, _ in a & b]] = True
        assert met.mean() > 0.9 and s.strips == strips


def test_distinct_documents(spark, documents, prose):
    rows = corpus(prose)
    df = documents(rows).selectExpr("*", "1 as class_id", "2 as keep", "doc_id as text_key")
    out = G.distinct_documents(df)
    assert out.columns == df.columns
    kept = out.collect()
    ids = [r.doc_id for r in G.near_duplicates(documents(rows)).collect() if r.keep]
    assert sorted(str(r.doc_id) for r in kept) == sorted(set(map(str, ids)))
    assert len(kept) == len({r.doc_id for r in kept})


def test_repeated_rows_leave_one(documents):
    rows = [(1, "a b c")] * 5 + [(2, "d e f")]
    assert sorted(r.doc_id for r in G.distinct_documents(documents(rows)).collect()) == [1, 2]
    nulls = [(None, "a b c")] * 3
    assert G.distinct_documents(documents(nulls)).count() == 1


def test_empty(documents):
    assert G.near_duplicates(documents([])).count() == 0 and G.distinct_documents(documents([])).count() == 0


def test_components_of_chains(spark):
    edges = [(i + 1, i) for i in range(0, 40)] + [(i + 1, i) for i in range(100, 110)] + [(200, 100)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 111)} | {200: 100}


@pytest.mark.parametrize("n, strips", [(1000, [3]), (200_000, [7, 3, 3]), (14_000_000, [23]), (200_000_000, [23, 7])])
def test_recall_at_exactly_reach_bits(n, strips):
    r, pairs = np.random.default_rng(2), 4000
    base = r.integers(0, 1 << 63, (pairs, G.LANES), dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, (pairs, G.LANES), dtype=np.uint64)
    flip = (r.random((pairs, G.BITS)).argsort(1) < G.REACH).astype(np.uint8)
    other = base ^ np.packbits(flip, axis=1, bitorder="little").view(np.uint64)
    s = G.Search(n)
    met = np.zeros(pairs, dtype=bool)
    for rows, path in s.members(np.concatenate([base, other])):
        code = path * pairs + rows % pairs
        met[np.intersect1d(code[rows < pairs], code[rows >= pairs]) % pairs] = True
    assert s.strips == strips
    assert met.mean() >= G.RECALL - 3 * (G.RECALL * (1 - G.RECALL) / pairs) ** 0.5


def test_codes_are_perfect():
    for strip, weight in ((3, 1), (7, 1), (23, 3)):
        code = G.Code.get(strip)
        assert np.array_equal(np.bincount(code.owner), np.full(code.centres, 2**strip // code.centres))
        centre = np.zeros(code.centres, dtype=np.int64)
        total = np.zeros((code.centres, strip))
        points = np.arange(1 << strip)
        for k in range(strip):
            total[:, k] = np.bincount(code.owner, weights=points >> k & 1)
            centre |= (2 * total[:, k] > 2**strip // code.centres).astype(np.int64) << k
        assert np.bitwise_count(points ^ centre[code.owner]).max() == weight


def test_work_grows_with_a_power_below_one_half():
    """Rows a fingerprint at the shipped setting, from thousands to billions of texts."""
    rows = {n: G.Search(n).repetitions for n in (16_000, 250_000, 14_000_000, 200_000_000, 1_000_000_000)}
    assert rows[250_000] <= 20 and all(k <= rows[250_000] * (n / 250_000) ** 0.5 for n, k in rows.items() if n > 250_000)


@pytest.mark.parametrize("small", [4096, 40, 2])
def test_recall_of_groups_on_texts_at_the_shipped_setting(documents, prose, small):
    rows = [(i, prose(i, 80)) for i in range(120)] + [(1000 + i, edit(prose(i % 120, 80), i, 0.05)) for i in range(240)]
    group, links = brute([t for _, t in rows])
    got = {r.doc_id: r.class_id for r in G.near_duplicates(documents(rows), small=small).collect()}
    right = sum(got[i] == rows[g][0] for (i, _), g in zip(rows, group))
    assert sum(links) > 300 and right >= 0.95 * len(rows)
