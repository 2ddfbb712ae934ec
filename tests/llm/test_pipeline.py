"""run() against a brute-force version of every stage on a small corpus."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline as P
from skeinwork.llm import benchmark_leaks as D
from skeinwork.llm import byte_convnet as B
from skeinwork.llm import mix_sources as M
from skeinwork.llm import simhash_groups as G
from skeinwork.llm.words import Words

DE = "haus baum strasse wasser himmel garten fenster schule katze vogel berg wiese".split()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(3)
    en = "house tree street water sky garden window school cat bird mountain meadow".split()

    def text(k, words, n):
        q = random.Random(k)
        return " ".join(q.choice(words) + q.choice(words)[:3] for _ in range(n))

    items = [(i, text(9000 + i, en, 30)) for i in range(6)]
    rows = [(i, text(i, DE if i % 3 == 0 else en, 40 + i % 50), "de" if i % 3 == 0 else "en", f"s{i % 4}") for i in range(160)]
    for i in range(20):  # near copies, copies, leaks, and rows that are nothing
        words = rows[i][1].split()
        words[r.randrange(len(words))] = "changed"
        rows.append((500 + i, " ".join(words), rows[i][2], "s1"))
        rows.append((600 + i, rows[i + 20][1], rows[i + 20][2], "s2"))
        rows.append((700 + i, text(700 + i, en, 20) + " " + items[i % 6][1] + " " + text(800 + i, en, 20), "en", None))
    rows += [(900, None, "en", "s1"), (901, "", "en", "s1"), (902, "123 !!", None, "s1"), (903, "zxqv kjhw qqxz vbnm wxyz " * 12, "en", "s1"), (904, "".join(r.sample(text(905, en, 90), 400)), "de", "s1"), (3, rows[3][1], "de", "s3"), (None, text(999, en, 50), "en", "s0")]
    d = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, items


def stages(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    out = [docs]
    for _, f in P.STAGES:
        out.append(P.settled(f(spark, out[-1], d)))
    return out


def test_stages_against_brute_force(spark, corpus):
    d, rows, items = corpus
    docs, known, distinct, clean, mixed, sharded = stages(spark, d)
    for x in (known, distinct, clean, mixed):
        assert x.columns == docs.columns
    pull = lambda x: [(r.doc_id, r.text, r.source) for r in x.collect()]

    net = B.learn(docs.where(B.fold() != 2).select("doc_id", "text", "lang"))
    langs, _, known_ = net.predict([t for _, t, *_ in rows])
    want = [(i, t, s) for (i, t, _, s), lang, k in zip(rows, langs, known_) if lang != B.UNKNOWN and k >= B.SURE]
    a = pull(known)
    assert Counter(a) == Counter(want) and not {900, 901, 902, 903, 904} & {i for i, *_ in a} and len(a) >= len(rows) - 5

    texts = sorted({t for _, t, _ in a})
    bits = np.unpackbits(G.fingerprints(texts).view(np.uint8), axis=1)
    group = list(range(len(texts)))
    for i, j in zip(*np.nonzero((bits[:, None] != bits[None]).sum(2) <= G.REACH)):
        old, new = max(group[i], group[j]), min(group[i], group[j])
        group = [new if g == old else g for g in group]
    first = {}
    for i, t, _ in a:
        g = group[texts.index(t)]
        if i is not None:
            first[g] = min(first.get(g, i), i)
        else:
            first.setdefault(g, None)
    b = pull(distinct)
    assert sorted(str(i) for i, *_ in b) == sorted(map(str, first.values())) and len({group[texts.index(t)] for _, t, _ in b}) == len(b)

    own = [Words([t]).hash for _, t in items]
    leaks = {t for _, t, _ in b if any(D.smith_waterman(o, Words([t]).hash) >= D.ENOUGH * D.MATCH * len(o) for o in own)}
    c = pull(clean)
    assert Counter(c) == Counter(x for x in b if x[1] not in leaks) and {i for i, t, _ in b if t in leaks} == {i for i in (x[0] for x in b) if i and 700 <= i < 720}

    e = pull(mixed)
    size, taken = defaultdict(int), defaultdict(int)
    for _, t, s in c:
        size[s] += len(t.split())
    for _, t, s in e:
        taken[s] += len(t.split())
    names = sorted(s for s in size if s is not None) + [None] * (None in size)
    goals = M.targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(size.values()))
    assert all(0 <= goal - taken[s] < 100 for s, goal in zip(names, goals)) and set(e) <= set(c) and max(Counter(e).values()) <= 2

    f = sharded.collect()
    counts = Counter(r.shard for r in f)
    assert Counter(r.doc_id for r in f) == Counter(i for i, *_ in e)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(40)) <= 1
    assert Counter(map(tuple, P.run(spark, d).collect())) == Counter(map(tuple, f))


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
