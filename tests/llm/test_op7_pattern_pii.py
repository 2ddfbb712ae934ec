import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from skeinwork.llm import pattern_pii as P

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    """The base as it is stated, by plain regular expressions."""
    out = [("email", m) for m in re.finditer(EMAIL, text)]
    out += [("ip", m) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(CARD, text):
        d = re.sub(r"[\x20-]", "", m.group())
        if 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(PHONE, text) if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "B9", "@", ".", "-", " ", "+", "(", "%", "_", "0", "1", "25", "256", "4111 1111 1111 1111", "4111111111111111", "a@b.c", "1.2.3.4", "+1 (234) 567-8901", "é", "٣", "\n"]), max_size=14).map("".join))
def test_base_is_that_of_the_expressions(text):
    assert P.base_spans(text)[0] == plain(text)


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "@" * 300_000, "a." * 150_000, "+1" + "(" * 300_000, "1 " * 150_000, "a@b" * 100_000, "x" * 300_000, "a@b.c " * 20_000, '="' * 100_000, ":" + " " * 300_000, "DE" * 150_000):
        P.instances(text, *P.base_spans(text))


def hexes(i):
    return hashlib.sha1(str(i).encode()).hexdigest()


def corpus():
    rows = [(i, f'Mail me.{i}@x.org now. token = "{hexes(i)}" end') for i in range(40)]
    rows += [(100 + i, f"Reach ann.{i}@corp.org or member no. MK-{i:06d}-77 today") for i in range(20)]
    rows += [(200 + i, f"serial badge {hexes(500 + i)} of course") for i in range(3)]  # a form alone is no evidence
    rows += [(300, None), (301, ""), (302, "4111 1111 1111 1112 and 999.1.1.1"), (303, "x" * 50_000 + " 10.0.0.1"), (0, rows[0][1])]
    return rows


def test_query_against_the_base_and_new_spans(documents):
    rows = corpus()
    got = P.personal_data(documents(rows).selectExpr("*", "1 as key", "2 as spans")).collect()
    assert len(got) == len(rows)
    text = {i: t or "" for i, t in rows}
    discovered = set()
    for r in got:
        base = plain(text[r.doc_id])
        write = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(write).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert spans[: len(write)] == write and len(spans) == len(write) + r.n_id == r.n_spans and all(s.startswith("id:") for s in spans[len(write) :])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in P.KINDS]
        if r.doc_id < 40:
            (new,) = spans[len(write) :]
            assert text[r.doc_id][int(new.split(":")[1]) : int(new.split(":")[2])] == hexes(r.doc_id)
            discovered |= {r.doc_id} if r.n_discovered else set()
        if 200 <= r.doc_id:
            assert r.n_id == 0
    assert len(discovered) == 40 - P.SEEDS  # all but the seeds were found by patterns
    assert P.personal_data(documents([])).count() == 0


def test_patterns_find_what_no_cue_stands_by(documents):
    """Seeds in one context teach a second one (the word after them), where unlike tokens stand by no cue; letters in quotes too."""
    rows = [(i, f"user token {hexes(i)} granted") for i in range(30)] + [(100 + i, f"entry {i:03d}-XK-{i * 7:05d} granted") for i in range(30)]
    rows += [(200 + i, f"the {1900 + i}-{1950 + i} granted, {i}.5 granted, v1.{i} granted") for i in range(3)] + [(300 + i, f"page no{i} of 30") for i in range(5)]
    got = {r.doc_id: r for r in P.personal_data(documents(rows)).collect()}
    assert all(got[i].n_id == 1 for i in range(30)) and all(got[100 + i].n_discovered == 1 for i in range(30))
    assert all(got[i].n_id == 0 for i in got if i >= 200)
    scored = {r.pattern: r.confidence for r in P.learn_patterns(P.scanned(documents(rows)))[0].collect()}
    assert scored["r1| |granted"] > P.SURE and not any("page" in p for p in scored)
    rows = [(i, f'login password: "{hexes(i)}"') for i in range(20)] + [(50, 'login password: "swordfish"'), (51, "login password: none")]
    got = {r.doc_id: r.n_id for r in P.personal_data(documents(rows)).collect()}
    assert got[50] == 1 and got[51] == 0 and sum(got.values()) == 21


def brute_confidence(rows, rounds=P.ROUNDS):
    """The rounds in plain Python, seeds given by the same rule."""
    graph, low, high = {}, {}, {}
    for _, text in rows:
        text = text or ""
        for a, b, known in P.instances(text, *P.base_spans(text)):
            patterns, word = P.contexts(text, a, b)
            known = 0 if known == 1 and word not in P.CUES else known
            x = hashlib.blake2b(text[a:b].encode(), digest_size=12).hexdigest()
            if patterns:
                low[x], high[x] = min(low.get(x, 9), known), max(high.get(x, -9), known)
            for p in patterns:
                graph.setdefault(p, set()).add(x)
    seeds = sorted(x for x in low if low[x] >= 0 and high[x] == 1)[: P.SEEDS]
    fixed = {x: 0.0 if low[x] < 0 else 1.0 if high[x] > 1 or x in seeds else None for x in low}
    belief = {x: v or 0.0 for x, v in fixed.items()}
    for k in range(rounds):
        scored = {}
        for p, xs in graph.items():
            total, kinds = sum(belief[x] for x in xs), {}
            for x in xs:
                kind = high[x] if high[x] >= P.BASE else 0
                kinds[kind] = kinds.get(kind, 0.0) + belief[x]
            scored[p] = (max(kinds.values()) / (total + sum(fixed[x] == 0.0 for x in xs) + P.PRIOR), sum(belief[x] >= 0.5 for x in xs))
        if k < rounds - 1:
            doubt = dict.fromkeys(low, 1.0)
            for p, xs in graph.items():
                if scored[p][0] >= P.SURE / 2 and scored[p][1] >= 2:
                    for x in xs:
                        doubt[x] *= 1 - min(scored[p][0], 0.999)
            belief = {x: 1 - doubt[x] if fixed[x] is None else fixed[x] for x in low}
    return {p: c for p, (c, n) in scored.items() if c >= P.SURE and n >= P.SUPPORT}


def test_rounds_against_brute_force(spark, documents):
    rows = corpus() + [(i + 500, f"entry {hexes(i)} end, card 411111111111{i:04d} and call +1 (555) 010-{i:04d} now") for i in range(60)]
    for held in (rows, [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]):
        got = {r.pattern: r.confidence for r in P.learn_patterns(P.scanned(documents(held)))[0].collect()}
        want = brute_confidence(held)
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_driver_documents_have_discoveries(spark):
    got = P.op7_pattern_pii(spark, "/root/testdata/sf0.1").agg({"n_id": "sum", "n_discovered": "sum"}).first()
    assert got["sum(n_discovered)"] > 100 and got["sum(n_id)"] > got["sum(n_discovered)"]


def test_numbers_that_identify_nobody(documents):
    rows = [(i, f"call +1 (555) 010-{i:04d} the") for i in range(20)] + [(100, "call 1999-2001 the call 3.50 the call 12:30 the call 2024-01-02 the call v1.2.3 the call 1,000,000 the call 42nd the")]
    got = {r.doc_id: r for r in P.personal_data(documents(rows)).collect()}
    assert all(got[i].n_phone == 1 and got[i].n_id == 0 for i in range(20)) and got[100].n_spans == 0


def test_ibans_and_tokens():
    text = 'pay DE89 3704 0044 0532 0130 00 or DE88 3704 0044 0532 0130 00, {"key":"ab12cd"} x=y1'
    spans = P.instances(text, *P.base_spans(text))
    assert [text[a:b] for a, b, k in spans if k == 3] == ["DE89 3704 0044 0532 0130 00"]
    assert {"ab12cd", "y1"} <= {text[a:b] for a, b, _ in spans}


def test_failed_forms_never_come_back(documents):
    rows = [(i, f"card number 411111111111{i:04d} paid") for i in range(400)]
    for r in P.personal_data(documents(rows)).collect():
        assert r.n_card + r.n_id <= 1 and r.n_id == 0


def test_words_that_stand_before_anything_teach_nothing(documents):
    """Ten addresses of each kind after "of"; a serial number after it isn't marked, one after "call" (phones only) is."""
    rows = [(i, f"{w} {x} x{i}y") for i in range(10) for w, x in (("of", f"ab{i}@c.de"), ("of", f"10.0.0.{i}"), ("of", f"+1 (555) 010-{i:04d}"), ("call", f"+1 (555) 011-{i:04d}"))]
    rows += [(100, "of AB-12345"), (101, "call AB-12345")]
    got = {r.doc_id: r.n_id for r in P.personal_data(documents(rows)).collect()}
    assert got[100] == 0 and got[101] == 1
