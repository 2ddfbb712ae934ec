import zlib

import numpy as np
import pytest

from skeinwork.llm import byte_convnet as B

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def answers(spark):
    return {r.doc_id: r for r in B.op2_byte_convnet(spark, D).collect()}


def test_held_out_accuracy(spark, answers):
    docs = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "lang").collect()
    assert len(answers) == len(docs)
    for r in docs:
        assert answers[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [answers[r.doc_id].lang_pred == r.lang for r in docs if answers[r.doc_id].held_out]
    assert len(held) > 200 and np.mean(held) > 0.97
    assert all(0 <= r.score <= 1 for r in answers.values())


def test_windows_cover_every_byte():
    for n in (0, 1, 255, 256, 257, 1000):
        data = bytes(i % 251 + 1 for i in range(n))
        w = B.windows_of(data, 256)
        assert w.shape == (max(1, -(-n // 256)), 256) and set(data) <= set(w.ravel().tolist())


def test_gradients_lower_the_loss_and_runs_agree():
    x = np.stack([np.frombuffer((c * 128).encode()[:256], dtype=np.uint8) for c in ("ab", "ba", "xy", "yx")] * 32)
    y = np.array([0, 0, 1, 1] * 32)
    nets = [B.Net(["a", "x"]) for _ in range(2)]
    before = nets[0].logs(x)[np.arange(len(y)), y].mean()
    for n in nets:
        n.train(x, y, epochs=4)
    after = nets[0].logs(x)
    assert after[np.arange(len(y)), y].mean() > before and (after.argmax(1) == y).all()
    assert all(np.array_equal(nets[0].p[k], nets[1].p[k]) for k in nets[0].p)


def test_joined_filters_equal_separate_ones():
    net, x = B.Net(["a", "b"]), np.random.default_rng(1).integers(1, 255, (5, 256)).astype(np.uint8)
    padded = np.concatenate([x, np.zeros((5, max(B.WIDTHS) - 1), np.uint8)], axis=1)
    z = net.pooled(padded) @ net.p["v"] + net.p["b"]
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    assert np.allclose(z, net.logs(x), atol=0.2)  # the separate path sees more padding at the end


def test_cases(spark, documents):
    train = [(i, t, l) for i, (t, l) in enumerate([("the cat and the dog of the house", "en"), ("der hund und die katze im haus", "de")] * 40)] + [(900, None, "en"), (901, "text", None)]
    net = B.learn(documents(train).select("doc_id", "text", "lang"))
    assert net.classes == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "the cat of the dog"), (5, "the " * 50000), (4, "the cat of the dog")]
    df = documents(rows).withColumnRenamed("lang", "score2")
    got = B.identified(df, net).collect()
    assert [r.lang_pred for r in got] == ["und", "und", "und", "en", "en", "en"] and got[0].score == 0 and got[3].score == got[5].score
    assert B.learn(documents([])).classes == [] and B.identified(documents([]), net).count() == 0
    assert {r.lang_pred for r in B.identified(documents([(1, "abc")]), B.Net([])).collect()} == {"und"}
    one = B.learn(documents([(1, "abc", "xx")]).select("doc_id", "text", "lang"))
    got = B.identified(documents([(1, "abc")]), one, any_="sum").collect()
    assert [r.lang_pred for r in got] == ["xx"] and got[0].score == got[0].sum


def test_letters_that_make_no_language(spark):
    """Shuffled letters, random ones and unseen scripts are of no language, documents of the tables are."""
    import random

    docs = spark.read.parquet(f"{D}/documents.parquet")
    net = B.learn(docs.select("doc_id", "text", "lang"))
    rows = docs.select("text").collect()
    known = np.array(net.predict([r.text for r in rows])[2])
    assert np.mean(known >= B.SURE) > 0.998
    r = random.Random(4)
    none = ["".join(r.sample(t, len(t))) for t in (x.text[:2000] for x in rows[:200]) if len(t) > 300]
    none += [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(2, 9))) for _ in range(60)) for _ in range(100)]
    none += ["".join(chr(r.randrange(a, a + 60)) for _ in range(200)) for a in range(0x400, 0xA000, 400)]
    langs, scores, known = net.predict(none)
    assert np.mean(np.array(known) < B.SURE) > 0.95 and set(langs) <= {*net.classes, B.UNKNOWN} and all(x <= y for x, y in zip(scores, known))


def test_more_languages_than_fit(documents):
    """The best sampled ones are learned; none is an error."""
    rows = [(i, f"text number {'abcdefgh'[i % 8] * 9} of many", f"l{min(i % 8, 5)}") for i in range(80)] + [(900, "once", "aa")]
    net = B.learn(documents(rows).select("doc_id", "text", "lang"), classes=3)
    assert net.classes == ["l0", "l1", "l5"]
