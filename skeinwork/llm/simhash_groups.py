"""SimHash near-duplicates by the recursion of May and Ozerov.

A text's fingerprint has BITS bits: the signs of the sum of +-1 vectors of its distinct words and word pairs. Texts are linked
if their fingerprints differ in REACH bits at most, and the groups are the connected components of the links.

Search: in each of many repetitions a fingerprint meets, level by level, a strip of random coordinates and the centres of a
perfect code on it, shifted at random, and goes on into the list of the centre from which its partial weight on the strip is at
most the code's radius. A perfect code has exactly one such centre, so a level costs no more rows than it gets: with random
centres (the first version: strips of 8, weight 1, 16 centres) a fingerprint was in several lists or in none, and two levels
took 54 rows a fingerprint, three over 300, where these take 18 and 80. The codes are Golay's (strips of 23, weight 3, 4096
lists), Hamming's (strips of 7, weight 1, 16 lists) and the majority of three (weight 1, 2 lists), as many of each as bring the
lists to LIST fingerprints; there are as many repetitions as find a pair at distance REACH with probability RECALL (nearer pairs more surely). The last
lists are searched by brute force. A list above SPLIT rows is cut into blocks, and each pair of blocks is a task of its own:
nothing is capped.

Equal texts are combined before all that, equal fingerprints next. A list or block sends on a spanning forest of its links,
never all pairs; the components come from alternating large-star and small-star steps, whose tables are written to the shared
folder. The number of links of a text is then counted exactly inside its group, block by block.

Cases: null is the empty text; texts without a word are alike only if equal; a group's class_id is its least doc_id (null if it
has none); rows that repeat are copies of each other; an empty table gives an empty result; extra columns are carried by
`distinct_documents` and ignored elsewhere.
"""

from __future__ import annotations

import hashlib
import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, settled, slices, table
from .words import Words, mix

BITS, REACH = 256, 60
LIST, SPLIT, RECALL, SEED = 4096, 8192, 0.95, 9
LANES = BITS // 64
LANE_COLUMNS = [f"f{i}" for i in range(LANES)]
FEATURE = np.uint64((1 << 44) - 1)


def _bits(features: np.ndarray) -> np.ndarray:
    """One row of BITS zeros and ones for each feature."""
    out = np.empty((len(features), LANES), dtype=np.uint64)
    for k in range(LANES):
        out[:, k] = mix(mix(features * np.uint64(0xBF58476D1CE4E5B9 + 2 * k * 0x632BE5AB)) + np.uint64(k + 1))
    return np.unpackbits(out.view(np.uint8), axis=1, bitorder="little")


def _signs(features: np.ndarray) -> np.ndarray:
    total = np.zeros(BITS, dtype=np.int64)
    for a in range(0, len(features), 255 * 16):
        bits = _bits(features[a : a + 255 * 16])
        for b in range(0, len(bits), 255):  # sums of 255 rows fit a byte
            total += bits[b : b + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * total >= len(features), bitorder="little").view(np.uint64)


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of LANES unsigned longs for each text."""
    w = Words(texts)
    at, pairs = w.grams(2)
    shift = np.uint64(44)
    rows = np.concatenate([w.doc, w.doc[at]]).astype(np.uint64)
    # A feature is the upper 44 bits of its hash below the number of its text, so that one sort makes them distinct by text (np.unique hashes, several times slower).
    features = np.sort(rows << shift | np.concatenate([w.hash, pairs]) >> np.uint64(20))
    features = features[np.concatenate([[True], features[1:] != features[:-1]])[: len(features)]]
    ends = np.searchsorted(features, np.arange(len(texts) + 1, dtype=np.uint64) << shift)
    features &= FEATURE
    out = np.zeros((len(texts), LANES), dtype=np.uint64)
    for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        own = features[a:b]
        if a == b:
            digest = hashlib.blake2b(texts[i].encode("utf-8", "surrogatepass"), digest_size=8).digest()
            own = np.frombuffer(digest, dtype=np.uint64) & FEATURE
        out[i] = _signs(own)
    return out


def _print_batch(batch):
    texts = [t or "" for t in batch.column(2).to_pylist()]
    lanes = np.concatenate([fingerprints(texts[a:b]) for a, b in slices(texts, 1 << 20)]).view(np.int64)
    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(lanes[:, k]) for k in range(LANES)]], names=["doc_id", "text_key", *LANE_COLUMNS])


def text_key(text: str = "text"):
    """128 bits in hex: the same for equal texts, null like the empty one."""
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def printed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the lanes of the fingerprint of every row; the texts aren't shuffled."""
    lanes = ", ".join(f"{c} long" for c in LANE_COLUMNS)
    return map_arrow(docs.select("doc_id", text_key().alias("text_key"), "text"), _print_batch, f"doc_id long, text_key string, {lanes}")


class Code:
    """A perfect code: every point of its strip lies within `weight` of exactly one centre. owner: the centre's number by point; caught: chance that two points d apart have one centre, by d."""

    made: dict[int, Code] = {}

    def __init__(self, strip: int, weight: int, generator: int):
        self.strip, self.weight = strip, weight
        free = strip - generator.bit_length() + 1
        centres = np.zeros(1, dtype=np.int64)
        for i in range(free):  # all sums of shifts of the generator
            centres = np.concatenate([centres, centres ^ (generator << i)])
        self.centres, self.bits = len(centres), free
        ball = np.array([sum(1 << i for i in at) for w in range(weight + 1) for at in combinations(range(strip), w)])
        self.owner = np.empty(1 << strip, dtype=np.int16)
        for e in ball:
            self.owner[centres ^ e] = np.arange(len(centres))
        apart = np.zeros(strip + 1)
        for e in ball:
            apart += np.bincount(np.bitwise_count(ball ^ e), minlength=strip + 1)
        self.caught = [apart[d] / len(ball) / math.comb(strip, d) for d in range(strip + 1)]

    @classmethod
    def get(cls, strip: int) -> Code:
        """The code of a strip of 3, 7 or 23, made once a process."""
        if strip not in cls.made:
            cls.made[strip] = cls(strip, *{3: (1, 0b111), 7: (1, 0b1011), 23: (3, 0b101011100011)}[strip])
        return cls.made[strip]


def levels_for(n: int, small: int = LIST) -> list[int]:
    """Strips, one a level, that bring lists of n fingerprints to `small` ones or fewer: each 23 cuts by 2^12, each 7 by 2^4, each 3 by 2."""
    golay, rest = divmod(max(1, math.ceil(math.log2(max(1.0, n / small)))), 12)
    if rest == 11:
        golay, rest = golay + 1, 0
    return [23] * golay + [7] * (rest // 4) + [3] * (rest % 4)


def together(reach: int, strips: list[int]) -> float:
    """Chance that two fingerprints reach bits apart share the list of one repetition, whose strips have no coordinate in common."""
    chance, left = {reach: 1.0}, BITS
    for strip in strips:
        caught = Code.get(strip).caught
        after: dict[int, float] = {}
        for differ, p in chance.items():
            for d, c in enumerate(caught):
                if c and d <= differ and strip - d <= left - differ:
                    ways = math.comb(differ, d) * math.comb(left - differ, strip - d) / math.comb(left, strip)
                    after[differ - d] = after.get(differ - d, 0.0) + p * ways * c
        chance, left = after, left - strip
    return sum(chance.values())


class Search:
    """The filters for n fingerprints: strips and repetitions and, drawn from the seed, the strips' coordinates and the codes' shifts."""

    def __init__(self, n: int, reach: int = REACH, recall: float = RECALL, seed: int = SEED, small: int = LIST):
        self.strips = levels_for(n, small)
        self.repetitions = math.ceil(math.log(1 - recall) / math.log1p(-min(together(reach, self.strips), 1 - 1e-12)))
        rng = np.random.default_rng(seed)
        ends = np.cumsum([0, *self.strips])
        drawn = [rng.permutation(BITS)[: ends[-1]] for _ in range(self.repetitions)]
        self.coordinates = [[order[a:b] for a, b in zip(ends[:-1], ends[1:])] for order in drawn]
        self.shifts = [[int(rng.integers(0, 1 << s)) for s in self.strips] for _ in range(self.repetitions)]

    def members(self, lanes: np.ndarray):
        """(row, list) pairs of some fingerprints, a chunk for every repetition; a row is in one list of each."""
        bits = np.unpackbits(lanes.view(np.uint8).reshape(len(lanes), -1), axis=1, bitorder="little").T.astype(np.int32)
        rows = np.arange(len(lanes))
        for r in range(self.repetitions):
            path = np.full(len(lanes), r, dtype=np.int64)
            for strip, coordinates, shift in zip(self.strips, self.coordinates[r], self.shifts[r]):
                code, point = Code.get(strip), np.full(len(lanes), shift, dtype=np.int32)
                for k, c in enumerate(coordinates):
                    point ^= bits[c] << k
                path = path * code.centres + code.owner[point]
            yield rows, path


def _member_batches(n: int, settings: dict):
    def each(batches):
        search = Search(n, **settings)
        names = ["list", "node", *LANE_COLUMNS]
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy()
            lanes = np.stack([batch.column(1 + k).to_numpy() for k in range(LANES)], axis=1)
            held, size = [], 0
            for rows, path in search.members(np.ascontiguousarray(lanes)):
                held.append((rows, path))
                size += len(rows)
                if size > 1 << 18:
                    yield _members(held, node, lanes, names)
                    held, size = [], 0
            if size:
                yield _members(held, node, lanes, names)

    return each


def _members(held, node, lanes, names):
    rows, path = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
    return pa.RecordBatch.from_arrays([pa.array(path), pa.array(node[rows]), *[pa.array(lanes[rows, k]) for k in range(LANES)]], names=names)


def near(a: list[np.ndarray], b: list[np.ndarray], reach: int):
    """Positions (x, y) of the rows of a and b that are reach bits apart at most; a and b are columns of lanes. All lanes but the last settle most pairs, the last is looked at for the others."""
    rows = max(1, (1 << 17) // max(1, len(b[0])))
    for s in range(0, len(a[0]), rows):
        own = [x[s : s + rows, None] for x in a]
        held = np.empty((len(own[0]), len(b[0])), dtype=np.uint64)
        one, total = np.empty(held.shape, dtype=np.uint8), np.empty(held.shape, dtype=np.uint8)
        for k in range(LANES - 1):  # at most 192: a byte holds it
            np.bitwise_xor(own[k], b[k][None, :], out=held)
            np.bitwise_count(held, out=one if k else total)
            if k:
                np.add(total, one, out=total)
        x, y = np.nonzero(total <= reach)
        last = total[x, y].astype(np.int16) + np.bitwise_count(own[-1][x, 0] ^ b[-1][y])
        yield x[last <= reach] + s, y[last <= reach]


def _blocked(rows: DataFrame, key: str, sizes: DataFrame, split: int) -> DataFrame:
    """rows with i, j and side, sorted by group: a key of more than `split` rows has a group for each pair of its blocks, any other key one."""
    half = max(1, split // 2)
    held = rows.join(sizes, key, "left").withColumn("blocks", F.coalesce(F.ceil(F.col("n") / half), F.lit(1)).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    held = held.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    out = held.select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", *LANE_COLUMNS)
    return out.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "side")


def _groups(batches):
    """(nodes, lanes, rows of side 0; in a group of one block all rows) of each group of sorted rows."""
    rest = None
    for batch in [*batches, None] if isinstance(batches, list) else _ended(batches):
        if batch is None:
            if rest is not None and len(rest[0]):
                yield rest
            return
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(5 + LANES)]
        if rest is not None:
            columns = [np.concatenate([x, y]) for x, y in zip(rest, columns)]
        change = (np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0) | (np.diff(columns[2]) != 0)
        cuts = [0, *(np.flatnonzero(change) + 1), len(columns[0])]
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            if b - a > 1:
                yield [c[a:b] for c in columns]
        rest = [c[cuts[-2] :] for c in columns]


def _ended(batches):
    yield from batches
    yield None


def _forest(nodes: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) of the components of the given links between positions."""
    root = np.arange(len(nodes))

    def find():
        nonlocal root
        while not np.array_equal(up := root[root], root):
            root = up

    for x, y in pairs:
        while True:
            a, b = root[x], root[y]
            open_ = a != b
            if not open_.any():
                break
            x, y, a, b = x[open_], y[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            find()
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _links(group, reach: int):
    """Linked positions (x, y) of a group, a chunk of rows at a time."""
    same = group[1][0] == group[2][0]
    # Unsigned: bitwise_count takes the bits of a negative number's absolute value.
    lanes = [c.view(np.uint64) for c in group[5:]]
    left = np.arange(len(lanes[0])) if same else np.flatnonzero(group[3] == 0)
    right = left if same else np.flatnonzero(group[3] == 1)
    for a in range(0, len(left), 256):
        mine = left[a : a + 256]
        theirs = right[a:] if same else right
        for x, y in near([c[mine] for c in lanes], [c[theirs] for c in lanes], reach):
            x, y = mine[x], theirs[y]
            yield (x[x < y], y[x < y]) if same else (x, y)


def _edges(reach: int):
    def each(batches):
        a, b, size = [], [], 0
        for g in _groups(batches):
            x, y = _forest(g[4], _links(g, reach))
            if len(x):
                a.append(np.maximum(x, y))
                b.append(np.minimum(x, y))
                size += len(x)
            if size > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                a, b, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return each


def _degrees(reach: int):
    def each(batches):
        for g in _groups(batches):
            n = np.zeros(len(g[4]), dtype=np.int64)
            for x, y in _links(g, reach):
                np.add.at(n, x, 1)
                np.add.at(n, y, 1)
            yield pa.RecordBatch.from_arrays([pa.array(g[4]), pa.array(n)], names=["node", "links"])

    return each


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a > b) but the roots, by large-star and small-star steps; root is the least node."""
    def mark(df):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    edges = settled(edges.distinct())
    seen = mark(edges)
    while seen[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u and v > m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        edges = settled(small)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def groups(docs: DataFrame, reach: int = REACH, split: int = SPLIT, **settings) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): rows has doc_id, text_key for each document; nodes has text_key, class_id, class_key, n_links, n_copies, first_id for each text.

    class_key is the text_key of the document that stays: the one with the least doc_id, then text_key.
    """
    rows = settled(printed(docs))
    lanes = [F.first(c).alias(c) for c in LANE_COLUMNS]  # the same in all rows of a key
    texts = rows.groupBy("text_key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"), *lanes)
    texts = settled(texts.withColumn("node", F.monotonically_increasing_id()))  # fixed by the written table
    points = settled(texts.groupBy(*LANE_COLUMNS).agg(F.min("node").alias("node")).select("node", *LANE_COLUMNS))
    n = points.count()
    settings = {"reach": reach, **settings}
    # Filters cost the same for every row, so rows are spread evenly whatever the files look like.
    wide = points.repartition(max(1, min(20000, max(docs.sparkSession.sparkContext.defaultParallelism, n // 10000))))
    lane_types = ", ".join(f"{c} long" for c in LANE_COLUMNS)
    members = wide.mapInArrow(_member_batches(n, settings), f"list long, node long, {lane_types}")
    hot = settled(members.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > split))
    found = _blocked(members, "list", hot, split).mapInArrow(_edges(reach), "a long, b long")
    alike = texts.join(points.withColumnRenamed("node", "b"), LANE_COLUMNS).where("node > b").select(F.col("node").alias("a"), "b")
    roots = components(found.union(alike))
    placed = settled(texts.join(roots, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root"))
    classes = placed.groupBy("class").agg(F.count("*").alias("n"), F.min(F.struct(F.col("first_id").isNull(), "first_id", "text_key")).alias("least")).where("n > 1")
    classes = settled(classes.select("class", "n", F.col("least.first_id").alias("class_id"), F.col("least.text_key").alias("class_key")))
    grouped = placed.join(classes.select("class"), "class", "left_semi").select("class", "node", *LANE_COLUMNS)
    large = classes.where(F.col("n") > split).select("class", "n")
    degrees = _blocked(grouped, "class", large, split).mapInArrow(_degrees(reach), "node long, links long")
    degrees = degrees.groupBy("node").agg(F.sum("links").alias("n_links"))
    nodes = placed.join(classes.drop("n"), "class", "left").join(degrees, "node", "left").select(
        "text_key", F.when(F.col("class_key").isNull(), F.col("first_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_key", "text_key").alias("class_key"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies", "first_id",
    )
    return rows, nodes


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, class_id, n_links (other texts in reach), n_copies (documents of the same text, this one too), keep (true for the rows of the id and text that stay)."""
    rows, nodes = groups(docs, **settings)
    out = rows.select("doc_id", "text_key").join(nodes, "text_key")
    keep = (F.col("text_key") == F.col("class_key")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    return out.select("doc_id", "class_id", "n_links", "n_copies", keep.alias("keep"))


def distinct_documents(docs: DataFrame, **settings) -> DataFrame:
    """docs with one row left of each group: all its columns, in the same order."""
    rows, nodes = groups(docs, **settings)
    names = docs.columns
    kept = nodes.where("text_key = class_key").select(F.col("text_key").alias("__kept"), F.col("first_id").alias("__id"))
    # Only ids that repeat with the same text need a second look at the rows.
    again = rows.groupBy("doc_id", "text_key").count().where("count > 1").select(F.col("doc_id").alias("__again"), "text_key")
    twice = (F.col("__kept") == F.col("text_key")) & F.col("__id").eqNullSafe(F.col("__again"))
    many, single = settled(kept.join(again, twice, "left_semi")), kept.join(again, twice, "left_anti")
    same = (F.col("__key") == F.col("__kept")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    held = docs.withColumn("__key", text_key())
    one = held.join(single, same, "left_semi").select(*names)
    rest = held.join(many, same, "left_semi").dropDuplicates(["doc_id", "__key"]).select(*names)
    return one.unionByName(rest)


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
