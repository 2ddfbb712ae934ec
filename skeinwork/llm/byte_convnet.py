"""Language identification by a byte convolutional network.

A text is cut into windows of WINDOW bytes that cover all of it. Each byte is embedded, filters of several widths run over the
window, the largest answer of each filter is kept, and a softmax layer turns these into probabilities; the windows of a text
vote with the mean of their logarithms. The network is trained here, in numpy, on labelled text: SAMPLE documents of each of
LANGUAGES languages at most, those with the least seeded hash, and WINDOWS windows spread over each whole text (of more
languages, those with the most sampled documents, then by name). What is learned from is thus bounded whatever the input; every
text is read whole.

Besides the languages the network learns what is none of them: text whose letters are shuffled, drawn at random, or of scripts at
random. That class is never an answer, but it takes its share of the probability: letters that make no language have a low score,
and the pipeline drops what is more likely none than all languages together, whatever their number (SURE).

The network is a few thousand numbers and is shipped to the workers with the function that applies it.

Cases: null text, or a text without a letter, is `und` with score 0; with no labelled row every text is `und`; with one language
every text with a letter is of that one, junk with a low score; rows with a null lang or id aren't learned from; texts that repeat get the same answer;
an empty table gives an empty result; extra columns are carried by `identified` and never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import settled, slices, table

WINDOW, WIDTHS, FILTERS, DIMENSIONS = 256, (2, 3, 4, 5), 12, 6
SAMPLE, WINDOWS, LANGUAGES, EPOCHS, RATE, SEED = 600, 4, 200, 5, 0.004, 5
#: With less than this probability of being of any language, a text is rejected by the pipeline.
SURE = 0.5
UNKNOWN = "und"


def windows_of(data: bytes, size: int = WINDOW) -> np.ndarray:
    """All of data in windows of `size` bytes; the last is padded with zeros, or starts earlier where there is room."""
    n = max(1, -(-len(data) // size))
    out = np.zeros((n, size), dtype=np.uint8)
    raw = np.frombuffer(data, dtype=np.uint8)
    whole = len(data) // size
    out[:whole] = raw[: whole * size].reshape(whole, size)
    if whole < n and len(data):
        tail = raw[-size:]
        out[-1, : len(tail)] = tail
    return out


def junk(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Windows that are of no language, one for each of x: its letters shuffled, random letters of ASCII in words, random letters of one script."""
    out = np.zeros_like(x)
    kinds = rng.integers(0, 3, len(x))
    for i, raw in enumerate(x):
        text = raw.tobytes().rstrip(b"\0").decode("utf-8", "ignore") or "x"
        if kinds[i] == 0:
            made = "".join(rng.permutation(list(text)))
        else:
            low, high = (97, 123) if kinds[i] == 1 else (lambda a: (a, a + 96))(int(rng.integers(0x370, 0xD700)))
            letters = rng.integers(low, high, len(text))
            made = "".join(chr(c) if chr(c).isalnum() and rng.random() > 0.15 else " " for c in letters)
        data = made.encode("utf-8", "ignore")[: x.shape[1]]
        out[i, : len(data)] = np.frombuffer(data, dtype=np.uint8)
    return out


class Net:
    """Embedding, filters of widths WIDTHS, max over positions, softmax over the classes and one more, which stands for none of them."""

    def __init__(self, classes: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.p = {"e": rng.normal(0, 0.3, (256, DIMENSIONS)), "v": np.zeros((FILTERS * len(WIDTHS), len(classes) + 1)), "b": np.zeros(len(classes) + 1)}
        for w in WIDTHS:
            self.p[f"w{w}"] = rng.normal(0, 1 / np.sqrt(w * DIMENSIONS), (w * DIMENSIONS, FILTERS))
            self.p[f"c{w}"] = np.zeros(FILTERS)
        self.p["e"][0] = 0
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}

    def _columns(self, embedded: np.ndarray, w: int) -> np.ndarray:
        n, size, d = embedded.shape
        flat = embedded.reshape(n, size * d)
        return np.lib.stride_tricks.sliding_window_view(flat, w * d, axis=1)[:, ::d]

    def pooled(self, x: np.ndarray, keep: bool = False):
        embedded = self.p["e"][x]
        pools, tops = [], []
        for w in WIDTHS:
            answers = self._columns(embedded, w).reshape(-1, w * DIMENSIONS) @ self.p[f"w{w}"]
            answers = answers.reshape(len(x), -1, FILTERS)
            top = answers.max(axis=1) + self.p[f"c{w}"]
            if keep:
                tops.append(answers.argmax(axis=1))
            pools.append(np.tanh(top))
        return (np.concatenate(pools, axis=1), tops, embedded) if keep else np.concatenate(pools, axis=1)

    def logs(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the classes' probabilities for each window, that of none of them last."""
        out = np.empty((len(x), len(self.classes) + 1), dtype=np.float32)
        wide, size = max(WIDTHS), x.shape[1]
        # All widths in one product: narrow filters have zeros below, and zero bytes follow the window.
        joined = np.zeros((wide * DIMENSIONS, FILTERS * len(WIDTHS)), dtype=np.float32)
        for i, w in enumerate(WIDTHS):
            joined[: w * DIMENSIONS, i * FILTERS : (i + 1) * FILTERS] = self.p[f"w{w}"]
        shift = np.concatenate([self.p[f"c{w}"] for w in WIDTHS])
        embedded = np.zeros((32, size + wide - 1, DIMENSIONS), dtype=np.float32)
        for a in range(0, len(x), 32):
            # Always 32 windows: a product's last digits depend on its shape, and a text's answer mustn't on its neighbours.
            part, n = x[a : a + 32], min(32, len(x) - a)
            if n < 32:
                part = np.concatenate([part, np.zeros((32 - n, size), dtype=np.uint8)])
            np.take(self.p["e"], part, axis=0, out=embedded[:, :size])
            columns = np.lib.stride_tricks.as_strided(embedded, (len(part), size, wide * DIMENSIONS), (embedded.strides[0], DIMENSIONS * 4, 4))
            answers = (columns.reshape(-1, wide * DIMENSIONS) @ joined).reshape(len(part), size, -1)
            z = np.tanh(answers.max(axis=1) + shift) @ self.p["v"] + self.p["b"]
            z -= z.max(axis=1, keepdims=True)
            out[a : a + n] = (z - np.log(np.exp(z).sum(axis=1, keepdims=True)))[:n]
        return out

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> None:
        """Adam on the cross entropy; gradients go through the positions of the maxima alone."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 64):
                batch = order[a : a + 64]
                h, tops, embedded = self.pooled(x[batch], keep=True)
                z = h @ self.p["v"] + self.p["b"]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
                z[np.arange(len(batch)), y[batch]] -= 1
                z /= len(batch)
                g = {k: np.zeros_like(v) for k, v in self.p.items()}
                g["v"], g["b"] = h.T @ z, z.sum(axis=0)
                back = (z @ self.p["v"].T) * (1 - h * h)
                for i, w in enumerate(WIDTHS):
                    own = back[:, i * FILTERS : (i + 1) * FILTERS]
                    g[f"c{w}"] = own.sum(axis=0)
                    spots = tops[i][:, :, None] + np.arange(w)  # batch x filters x width
                    seen = embedded[np.arange(len(batch))[:, None, None], spots].reshape(len(batch), FILTERS, -1)
                    g[f"w{w}"] = np.einsum("bfk,bf->kf", seen, own)
                    to = (own[:, :, None] * self.p[f"w{w}"].T[None]).reshape(-1, DIMENSIONS)
                    np.add.at(g["e"], x[batch][np.arange(len(batch))[:, None, None], spots].reshape(-1), to)
                g["e"][0] = 0
                t += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, its probability, and the probability of any language."""
        langs, scores, any_ = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        if not self.classes:
            return langs, scores, any_
        able = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        for a, b in slices([texts[i] for i in able], 1 << 19):
            own = able[a:b]
            parts = [windows_of(texts[i].encode("utf-8", "surrogatepass")) for i in own]
            ends = np.cumsum([len(p) for p in parts])
            logs = self.logs(np.concatenate(parts))
            mean = np.add.reduceat(logs.astype(np.float64), [0, *ends[:-1]], axis=0) / np.diff([0, *ends])[:, None]
            p = np.exp(mean - mean.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i, row in zip(own, p):
                k = int(row[:-1].argmax())
                langs[i], scores[i], any_[i] = self.classes[k], float(row[k]), float(1 - row[-1])
        return langs, scores, any_


def _samples(windows: int):
    def each(batches):
        for batch in batches:
            langs, data = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                every = windows_of(text.encode("utf-8", "surrogatepass"))
                spots = np.unique(np.linspace(0, len(every) - 1, min(windows, len(every))).astype(int))
                langs += [lang] * len(spots)
                data += [every[i].tobytes() for i in spots]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(data, pa.binary())], names=["lang", "data"])

    return each


def learn(docs: DataFrame, sample: int = SAMPLE, windows: int = WINDOWS, classes: int = LANGUAGES) -> Net:
    """A network trained on (doc_id, text, lang) rows. At most sample * windows windows of each of `classes` languages reach the driver: the bound of what it collects."""
    able = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    pick = able.select("lang", "doc_id", F.xxhash64(F.lit(SEED), "doc_id").alias("h"))
    # A rank below a constant is pruned before the shuffle, so a hot language sends `sample` rows a partition at most.
    ranked = pick.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))).where(F.col("k") <= sample)
    ranked = settled(ranked.select("lang", "doc_id"))
    names = sorted(r["lang"] for r in ranked.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(classes).collect())
    if not names:
        return Net([])
    # sample rows a language, so at most sample * classes pairs of a name and an id.
    chosen = F.broadcast(ranked.where(F.col("lang").isin(names)).distinct())
    text = able.select("lang", "doc_id", "text").join(chosen, ["lang", "doc_id"], "left_semi").select("lang", "text")
    rows = text.mapInArrow(_samples(windows), "lang string, data binary").toPandas().sort_values(["lang", "data"])
    net = Net(names)
    x = np.frombuffer(b"".join(rows["data"]), dtype=np.uint8).reshape(len(rows), WINDOW)
    y = np.searchsorted(np.array(names), rows["lang"].to_numpy(dtype=str))
    # Short texts too: some windows are cut to a random length.
    rng = np.random.default_rng(SEED)
    cut = x.copy()
    cut[np.arange(WINDOW)[None, :] >= rng.integers(8, 120, len(cut))[:, None]] = 0
    # As many windows of no language as a language has on average; long ones, as little can be said of a few letters.
    some = x[rng.permutation(len(x))[: -(-2 * len(x) // len(names))]]
    none = junk(some, rng)
    net.train(np.concatenate([x, cut, none]), np.concatenate([y, y, np.full(len(none), len(names))]))
    return net


def identified(docs: DataFrame, net: Net, lang: str = "lang_pred", score: str = "score", any_: str | None = None) -> DataFrame:
    """docs with two more columns, the language and its probability; on request a third, the probability of any language."""
    at = docs.columns.index("text")
    more = [(lang, T.StringType(), pa.string()), (score, T.DoubleType(), pa.float64()), (any_, T.DoubleType(), pa.float64())][: 3 if any_ else 2]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t, _ in more]])

    def each(batches):
        for batch in batches:
            found = net.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, t) for c, (_, _, t) in zip(found, more)]], names=[*batch.schema.names, *[n for n, _, _ in more]])

    return docs.mapInArrow(each, schema)


def fold(key: str = "doc_id"):
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4))


def op2_byte_convnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = learn(docs.where(fold() != 2).select("doc_id", "text", "lang"))
    out = identified(docs.select("doc_id", "text"), net)
    return out.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
