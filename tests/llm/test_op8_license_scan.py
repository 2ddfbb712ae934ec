import re

from skeinwork.llm import license_scan as L
from skeinwork.llm.words import HashSet, Words

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def test_words_and_grams_against_the_expression():
    texts = ["Under the MIT License!", "", "É é ßA9_b", "x" * 10, "a-b c", "ÀB c d", "one"]
    w = Words(texts)
    for i, t in enumerate(texts):
        assert [w.word(j) for j in range(w.first[i], w.first[i + 1])] == words(t)
    at, h = w.grams(2)
    pairs = {}
    for i, g in zip(at, h):
        assert w.doc[i] == w.doc[i + 1]
        assert pairs.setdefault(int(g), (w.word(i), w.word(i + 1))) == (w.word(i), w.word(i + 1))
    assert len(at) == sum(max(0, len(words(t)) - 1) for t in texts)
    found, _ = HashSet(h[:2]).find(h)
    assert set(found) == {i for i, g in enumerate(h) if g in h[:2]}


def base(text):
    w = words(text)
    out = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(out), min((i for i, _ in out), default=None), max((i for i, _ in out), default=None), ",".join(sorted({x for _, x in out}))


MIT = next(t for label, t in L.TEMPLATES if label == "mit" and len(t) > 200)


def corpus(prose):
    edited = MIT.split()
    for i in (9, 21, 33):
        edited[i] = "other"
    del edited[15]
    return [
        (1, "Released under the MIT License."), (2, "x UNDER THE MIT LICENSE under the mit-license, Apache License, Version 2.0 cc by nc"), (3, None), (4, ""), (5, prose(1)), (6, prose(2, 300) + " " + " ".join(edited) + " " + prose(3, 50)),
        (7, "This work is licensed under the GNU General Public License, version 3."), (8, "All rights reserved."), (9, prose(4, 30000) + " under the mit license"), (10, "under the mit"), (1, "Released under the MIT License."), (11, "All rights reserved." * 500),
    ]


def test_query_against_brute_force(spark, documents, prose, tmp_path):
    rows = corpus(prose)
    documents(rows).selectExpr("*", "1 as key", "'x' as label").write.parquet(f"{tmp_path}/documents.parquet")
    got = L.op8_license_scan(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text[r.doc_id]) and 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    labels = {r.doc_id: r.labels for r in got}
    assert labels == {1: "mit", 2: "apache-2,cc-by-nc,mit", 3: "", 4: "", 5: "", 6: "mit", 7: "gpl-3", 8: "all-rights-reserved", 9: "mit", 10: "", 11: "all-rights-reserved"}


def test_spans(documents, prose):
    _, spans = L.scan_licenses(documents(corpus(prose)))
    n = len(MIT.split())
    (s,) = [r for r in spans.collect() if r.label == "mit" and r.last_word - r.first_word > 20]
    assert abs(s.first_word - 300) <= 1 and abs(s.last_word - s.first_word - n) <= 3 and s.score > 0.7


def test_empty(documents, spark, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert L.op8_license_scan(spark, str(tmp_path)).count() == 0


def test_versions_kinds_and_overlaps(spark, documents, tmp_path):
    gpl, cc = "GNU General Public License", "Creative Commons Attribution"
    rows = {
        f"Licensed under the {gpl}, version 3.": "gpl-3", f"This program is licensed under the {gpl}, version 3": "gpl-3", f"x licensed under the {gpl}, version 2 y": "gpl-2", f"This work is licensed under the {gpl}, version 2.": "gpl-2",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "lgpl", "This work is licensed under the GNU Affero General Public License, version 3.": "agpl-3", "Licensed under the Apache License, Version 1.2": "",
        f"Licensed under a {cc}-NonCommercial 4.0 International License": "cc-by-nc", f"Licensed under a {cc} 4.0 International License": "cc-by", "licensed under CC BY-SA 3.0 licensed under CC BY-SA 4.0": "cc-by-sa",
    }
    documents(list(enumerate(rows))).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.labels for r in L.op8_license_scan(spark, str(tmp_path)).collect()}
    assert [(t, got[i]) for i, t in enumerate(rows)] == list(rows.items())


def test_a_span_that_went_takes_no_other_along(documents):
    one, two, three = "a b c d e f g h", "g h i j k l", "k l m n o"
    _, spans = L.scan_licenses(documents([(1, "a b c d e f g h i j k l m n o")]), templates=[("one", one), ("two", two), ("three", three)])
    assert sorted(r.label for r in spans.collect()) == ["one", "three"]


def test_in_order_is_the_longest_common_subsequence():
    import random

    r = random.Random(1)
    for _ in range(300):
        a, b = [[r.choice("abcd") for _ in range(r.randrange(0, 14))] for _ in range(2)]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
        assert L.in_order(a, b) == table[-1][-1]


def test_whole_licenses(documents, prose):
    """Every template, two words in twenty changed where it is long, is found in a long text with its label."""
    rows = []
    for t, (_, wording) in enumerate(L.TEMPLATES):
        w = wording.split()
        if len(w) > 60:
            w = [f"new{i}" if i % 20 in (7, 13) and not w[i].isdigit() else x for i, x in enumerate(w)]
        rows.append((t, prose(t, 100) + " " + " ".join(w).title() + ". " + prose(t + 500, 50)))
    _, spans = L.scan_licenses(documents(rows))
    got = {}
    for r in spans.select("key", "label", "score", "first_word", "last_word").join(documents(rows).select(L.row_key().alias("key"), "doc_id"), "key").collect():
        got.setdefault(r.doc_id, []).append(r)
    for t, (label, wording) in enumerate(L.TEMPLATES):
        assert {r.label for r in got[t]} == {label}
        best = max(got[t], key=lambda r: r.last_word - r.first_word)
        assert abs(best.first_word - 100) <= 8 and best.score >= 0.85
