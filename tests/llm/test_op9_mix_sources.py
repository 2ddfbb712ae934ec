import random
import re
from collections import Counter, defaultdict

from skeinwork.llm import mix_sources as M


def best(lengths, counts, budget):
    sums = {0}
    for n, c in zip(lengths, counts):
        for _ in range(c):
            sums |= {s + n for s in sums if s + n <= budget}
    return max(sums)


def test_fit_against_all_subsets():
    r = random.Random(1)
    for _ in range(200):
        lengths = sorted(r.sample(range(0, 40), r.randrange(1, 6)))
        counts = [r.randrange(1, 5) for _ in lengths]
        budget = r.uniform(0, sum(a * b for a, b in zip(lengths, counts)))
        take = M.fit(lengths, counts, budget)
        got = sum(a * b for a, b in zip(lengths, take))
        assert all(0 <= t <= c for t, c in zip(take, counts)) and got <= budget
        assert best(lengths, counts, int(budget)) - got <= max(lengths)


def test_fit_of_large_budgets_is_exact():
    r = random.Random(2)
    lengths = list(range(1, 3000))
    counts = [r.randrange(1, 200) for _ in lengths]
    total = sum(a * b for a, b in zip(lengths, counts))
    for share in (0.1, 0.5, 0.99):
        assert int(total * share) == sum(a * b for a, b in zip(lengths, M.fit(lengths, counts, total * share)))


def test_targets():
    t = M.targets([100, 100, 100], [5, 2, 1], 450)
    assert sum(t) == 450 and t[0] == 200 and abs(t[1] - 500 / 3) < 1e-9 and abs(t[2] - 250 / 3) < 1e-9
    assert M.targets([], [], 0) == [] and M.targets([0, 10], [5, 2], 15) == [0, 15] and M.targets([0], [5], 0) == [0]


def corpus(prose):
    r = random.Random(5)
    rows = [(i, prose(i, r.randrange(0, 60)), "en", f"src{i % 5}") for i in range(400)]
    rows += [(1000 + i, "five words are in here", "en", "hot") for i in range(300)] + [(2000, None, "en", "src1"), (2001, "", None, None), (2002, "a b\x0bc d", "en", None), (2003, "x y", "en", "src1"), (2003, "x y", "en", "src1"), (None, "q", "en", "é")]
    return rows


def test_query(spark, documents, prose, tmp_path):
    rows = corpus(prose)
    documents(rows).selectExpr("*", "1 as target", "2 as copies", "3 as size").write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op9_mix_sources(spark, str(tmp_path)).collect()
    again = M.op9_mix_sources(spark, str(tmp_path)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r["size"], r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == Counter((i, size(t), s) for i, t, _, s in rows)
    words, taken = defaultdict(int), defaultdict(int)
    for r in got:
        words[r.source] += r["size"]
        taken[r.source] += r.taken
        assert r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
    names = sorted((s for s in words if s is not None)) + [None]
    want = dict(zip(names, M.targets([words[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(words.values()))))
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 and r.source_size == words[r.source]
    for s in names:
        assert -4 <= taken[s] - want[s] <= 0 or s == "hot" and abs(taken[s] - want[s]) < 5, s


def test_rows_are_repeated(documents, prose):
    df = documents(corpus(prose))
    plan = {(r.doc_id, r.text): r.copies for r in M.mix(df, df.columns).collect() if r.doc_id != 2003}
    got = Counter((r.doc_id, r.text) for r in M.mixed_rows(df).collect() if r.doc_id != 2003)
    assert got == Counter({k: n for k, n in plan.items() if n})
    assert M.mixed_rows(df).columns == df.columns
    clash = df.selectExpr("*", "1 as copies", "2 as size", "3 as target", "4 as source_size", "5 as taken")
    assert M.mixed_rows(clash).columns == clash.columns and M.mixed_rows(clash).count() == sum(got.values()) + M.mixed_rows(df).where("doc_id = 2003").count()


def test_empty(documents):
    assert M.mixed_rows(documents([])).count() == 0 and M.mixed_rows(documents([(1, None), (2, "")])).count() == 0


def test_targets_by_aggregates_are_those_of_the_list(spark):
    r = random.Random(9)
    for n in (1, 2, 7, 500):
        sizes = [r.choice([0, 1, r.randrange(10**6), r.randrange(10**9)]) for _ in range(n)]
        names = sorted({f"h{r.randrange(10**9)}.example" for _ in range(4 * n)})[: n - 1] + [None]
        df = spark.createDataFrame([(s or "", s is None, w) for s, w in zip(names, sizes)], "__source string, __none boolean, words long").repartition(5)
        want = dict(zip(names, M.targets(sizes, [(5, 2, 1)[i % 3] for i in range(n)], 1.5 * sum(sizes))))
        got = {None if x["__none"] else x["__source"]: x["__target"] for x in M.targeted(df).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) <= 1e-9 * max(1.0, want[k]) for k in want)


def test_fit_is_the_best_sum_of_what_is_left():
    """After the even share the program finds the best sum of the documents that are left, whatever the budget."""
    lengths, counts = [3, 5, 7, 1000], [40, 40, 40, 2]
    total = sum(a * b for a, b in zip(lengths, counts))
    for budget in range(0, total, 7):
        even = [c * budget // total for c in counts]
        rest = budget - sum(a * b for a, b in zip(lengths, even))
        take = M.fit(lengths, counts, budget)
        got = sum(a * b for a, b in zip(lengths, take))
        assert all(e <= t <= c for e, t, c in zip(even, take, counts))
        assert got == budget - rest + best(lengths, [c - e for c, e in zip(counts, even)], rest)
