import hashlib
import os
import random

import xxhash
from pyspark.sql import functions as F

from skeinwork.llm import span_prints as S


def test_spans_and_extensions_against_brute_force():
    r = random.Random(1)
    a = "".join(r.choice("abé😀") for _ in range(300))
    b = a[50:200] + "".join(r.choice("abé😀") for _ in range(200))
    p, q = S.PrefixHashes(a), S.PrefixHashes(b)
    for _ in range(500):
        i, j = r.randrange(len(a)), r.randrange(len(b))
        n = r.randrange(1, min(len(a) - i, len(b) - j) + 1)
        assert p.same(i, q, j, n) == (a[i : i + n] == b[j : j + n])
        k = 0
        while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
            k += 1
        assert p.common(i, q, j) == k


def test_blocks_change_nothing(monkeypatch, prose):
    long = prose(1, 4000)
    whole = S.fingerprint(long)
    monkeypatch.setattr(S, "BLOCK", 1 << 10)
    monkeypatch.setattr(S._Tables, "made", None)
    assert S.fingerprint(long) == whole
    monkeypatch.setattr(S._Tables, "made", None)


def test_likeness(prose):
    near = lambda x, y: S.likeness(S.decode(S.fingerprint(x)), S.decode(S.fingerprint(y)))
    a, b = prose(1), prose(2)
    assert near(a, a) == near("", "") == near(None, "") == 1 and near(a, "") == 0
    assert 0.4 < near(a, S.edited(a, b)) <= 1 and near(a, b) < 0.3 and near(a, a.replace("alpha", "Alpha", 1)) > 0.8


def expected(rows):
    """The contract, by loops. Rows by (doc_id, hash of the text, text), a null id first."""
    signed = lambda t: (x := xxhash.xxh64_intdigest((t or "").encode(), 42)) - (x >> 63 << 64)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1]), r[1] is not None, r[1] or ""))
    out = []
    for i, (k, t) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][1] or ""
        h = len(t) // 2
        e = t[: len(t) - h] + n[:h]
        ends = [len(os.path.commonprefix([x, y])) for x, y in ((t, n), (t[::-1], n[::-1]))]
        out.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), S.fingerprint(t), S.fingerprint(e), *ends))
    return sorted(out, key=str)


def check(docs, rows, **options):
    got = S.fingerprints(docs, **options).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.common_start, r.common_end) for r in got), key=str) == expected(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_query_against_brute_force(documents, prose):
    rows = [(i * 3, prose(i, 5 + i)) for i in range(60)] + [(7, None), (8, ""), (10, "x"), (11, "😀é"), (12, prose(0, 20000)), (None, "null id"), (30, "again"), (30, "again"), (30, "other")]
    check(documents(rows), rows)
    for size in (1, 7):  # rows at the borders of buckets meet their neighbours too
        check(documents(rows), rows, per_bucket=size)


def test_a_hot_id_is_cut_by_its_texts(documents, prose, monkeypatch):
    rows = [(i, prose(i, 4)) for i in range(-40, 40)] + [(None, prose(i, 4)) for i in range(100, 160)] + [(7, prose(i, 4)) for i in range(200, 300)]
    check(documents(rows), rows, per_bucket=10)
    df, seen = documents(rows), []
    split = type(df).repartitionById

    def watched(self, n, column):
        seen.append((n, self.where("copy = 0").groupBy(column).count().agg(F.max("count")).first()[0]))
        return split(self, n, column)

    monkeypatch.setattr(type(df), "repartitionById", watched)
    S.fingerprints(df, per_bucket=10)
    ((width, most),) = seen
    assert width >= 20 and most <= 40


def test_small_tables(documents):
    assert S.fingerprints(documents([])).count() == 0
    check(documents([(5, "one")]), [(5, "one")])
    check(documents([(5, None), (5, None)]), [(5, None), (5, None)])


def test_common_extensions_to_the_code_point(prose):
    r = random.Random(8)
    for k in range(200):
        n = r.choice([0, 1, 7, 9, 50, 400, 3000])
        start, end = prose(k, 600)[:n], prose(k + 1000, 600)[: r.choice([0, 3, 80, 2000])]
        a, b = start + prose(k + 2000, r.randrange(1, 9)) + end, start + prose(k + 3000, r.randrange(1, 9)) + end
        if k % 10 == 0:
            b = a[: r.randrange(0, len(a))]
        p, q = S.prints(S.code_points(a)), S.prints(S.code_points(b))
        assert S.extension(a, b, p, q, 2) == len(os.path.commonprefix([a, b]))
        assert S.extension(a, b, p, q, 3) == len(os.path.commonprefix([a[::-1], b[::-1]]))
