import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skeinwork.llm import chat_templates as C

PIECES = st.sampled_from(["<", "\\", "|", "im_end", "|>", "<|im_end|>", "<|im_start|>assistant\n", "\n", "\r", "é😀", " x "])
TEXT = st.lists(PIECES, max_size=8).map("".join)
TURN = st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb\\n", "<|im_end|>", ""]) | TEXT, TEXT)


@settings(max_examples=300, deadline=None)
@given(st.lists(TURN, max_size=5), st.sampled_from([1, 3, 10**6]))
def test_round_trip(turns, size):
    reader = C.Reader()
    for text, masks in C.chunks_of(C.compile_template(C.CHATML)({"role": r, "text": t} for r, t in turns), size):
        reader.feed(text, masks)
    n, digest, chars, loss, _ = reader.done()
    own = "".join(t for r, t in turns if r == "assistant")
    assert (n, chars) == (len(turns), len(own))
    assert digest == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest() and loss == hashlib.sha256(own.encode()).hexdigest()


@given(TEXT)
def test_escape(text):
    assert "<|" not in C.escape(text) and C.unescape(C.escape(text)) == text and C.unescape_role(C.escape_role(text)) == text and "\n" not in C.escape_role(text)


def render(source, *messages):
    return "".join(t for t, _ in C.compile_template(source)([dict(m) for m in messages]))


def test_language():
    m = ({"role": "user", "text": " a "}, {"role": "assistant", "text": "b"})
    assert render("{% for x in messages %}{{ loop.index ~ ':' ~ (x.text | trim | upper) }}{% if not loop.last %}, {% endif %}{% endfor %}", *m) == "1:A, 2:B"
    assert render("{% for x in messages -%}  {% if x.role == 'user' and loop.first %}u{% elif x['role'] in 'assistant' %}a{% else %}o{% endif %}  {%- endfor %}", *m) == "ua"
    assert render("{% set n = 'x' | replace('x', 'y') %}{{ n }}{# gone #}{{ none | default('d') }}") == "yd"
    assert C.simplify(C.parse("{% if 1 < 2 %}a{{ 'b' ~ 3 }}{% else %}{{ z }}{% endif %}c")) == [("text", "ab3c")]
    masked = list(C.compile_template("x{% generation %}y{% endgeneration %}z")([]))
    assert masked == [("x", False), ("y", True), ("z", False)]


@pytest.mark.parametrize("bad", ["{{ m.__class__ }}", "{{ m.text.upper }}", "{% for a in b %}{% endfor %}", "{{ a | eval }}", "{% if a %}", "{{ a( }}", "{% nope %}", "{{ 'a }}", "{{ x['__init__'] }}"])
def test_sandbox(bad):
    with pytest.raises(C.TemplateError):
        C.compile_template(bad)


def test_query(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", "a"), (2, None, "assistant", None), (None, 0, "user", "n"), (3, 5, None, "x" * 200_000 + "<|im_end|>"), (1, 0, "user", "a")]
    rows += [(9, i, "assistant" if i % 2 else "user", f"<|{i}") for i in range(3000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in C.op4_chat_templates(spark, str(tmp_path)).collect()}
    groups = defaultdict(list)
    for c, t, r, x in rows + [(-1, i, r, "<|im_end|><|im_start|>assistant ok") for i, r in enumerate(("user", "assistant"))]:
        groups[c].append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(groups)
    for c, g in groups.items():
        own = "".join(x for *_, r, x in sorted(g) if r == "assistant")
        assert got[c].n_turns == len(g) and got[c].loss_chars == len(own) and got[c].loss_sha256 == hashlib.sha256(own.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in sorted(g)).encode()).hexdigest()


def test_empty_table(spark):
    assert C.read_back(C.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string, more int"))).count() == 0
