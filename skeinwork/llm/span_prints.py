"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, modulo each of two primes, P[i] = sum of c[j] * B^j over j < i. Any span then has the hash
(P[b] - P[a]) * B^-a, so spans of any two texts compare in constant time, and the longest common extension of two positions is
found by binary search. A fingerprint keeps of a text: its length, the hash of all of it, the hashes of its prefixes and
suffixes at lengths that grow geometrically (a sampled prefix array, on which the same binary search works), and a sketch of
the hashes of its spans of WIDTH code points. Equal texts have equal fingerprints; two fingerprints give a likeness from 0 to 1.
Where neighbours meet, the marks tell between which lengths their longest common extensions from the start and to the end lie,
and a binary search on prefix arrays of that much of both texts gives these to the code point.

A fingerprint has a bounded size. Arrays are built over BLOCK code points at a time, so that a text of any length needs
bounded memory.

Cases: null is the empty text; texts that repeat have the same fingerprint; the neighbour of the last document is the first;
rows are ordered by (doc_id, hash of the text, text), a null id first; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from base64 import urlsafe_b64decode, urlsafe_b64encode
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

PRIMES, BASES = (2147483647, 2147483629), (911382323, 972663749)
WIDTH, SLOTS, BLOCK = 8, 64, 1 << 18
#: Lengths at which prefixes and suffixes are sampled: every one to 8, then growing by an eighth.
MARKS = [1, 2, 3, 4, 5, 6, 7, 8]
while MARKS[-1] < 1 << 36:
    MARKS.append(MARKS[-1] * 9 // 8)
MARKS = np.array(MARKS, dtype=np.int64)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out, k = np.ones(n, dtype=np.uint64), 1
    while k < n:  # doubling: the next k powers are the first k times base^k
        step = np.uint64(pow(base, k, prime))
        out[k : 2 * k] = out[: min(k, n - k)] * step % np.uint64(prime)
        k *= 2
    return out


class _Tables:
    """Powers of the bases and of their inverses up to BLOCK, made once a process."""

    made: list | None = None

    @classmethod
    def get(cls) -> list:
        if cls.made is None:
            cls.made = [(_powers(b, p, BLOCK + 1), _powers(pow(b, -1, p), p, BLOCK + 1)) for b, p in zip(BASES, PRIMES)]
        return cls.made


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class PrefixHashes:
    """Prefix arrays of one text: span(a, b), same(a, other, b, n), common(a, other, b)."""

    def __init__(self, text: str | None):
        codes = code_points(text)
        self.n = len(codes)
        self.sums = []
        for p, (power, _) in zip(PRIMES, _Tables.get()):
            out, at = np.zeros(self.n + 1, dtype=np.uint64), 0
            for a in range(0, self.n, BLOCK):
                part = codes[a : a + BLOCK].astype(np.uint64) + np.uint64(1)
                step = np.uint64(pow(int(power[1]), a, p))
                terms = part * (power[: len(part)] * step % np.uint64(p)) % np.uint64(p)
                out[a + 1 : a + 1 + len(part)] = (np.cumsum(terms) + np.uint64(at)) % np.uint64(p)
                at = int(out[a + len(part)])
            self.sums.append(out)

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The hash of code points a to b; equal for equal spans wherever they stand."""
        return tuple((int(s[b]) - int(s[a])) * pow(base, -a, p) % p for s, base, p in zip(self.sums, BASES, PRIMES))

    def same(self, a: int, other: PrefixHashes, b: int, n: int) -> bool:
        return self.span(a, a + n) == other.span(b, b + n)

    def common(self, a: int, other: PrefixHashes, b: int) -> int:
        """Length of the longest common extension of position a here and b there."""
        low, high = 0, min(self.n - a, other.n - b)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(a, other, b, mid) else (low, mid - 1)
        return low


def _fold(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x * np.uint64(0x9E3779B1) ^ y * np.uint64(0x85EBCA77)) >> np.uint64(7)).astype(np.uint16)


def _least(sketch: np.ndarray, mixed: np.ndarray) -> None:
    """Keeps in each slot (the top bits) the least of the other bits. Small values are tried first; only if they leave a slot empty are all needed."""
    low = np.uint64((1 << 58) - 1)
    if len(mixed) > 32 * SLOTS:
        some = mixed[mixed & low < np.uint64((1 << 58) // len(mixed) * 16 * SLOTS)]
        np.minimum.at(sketch, (some >> np.uint64(58)).astype(np.int64), some & low)
        if (sketch <= low).all():
            return
    np.minimum.at(sketch, (mixed >> np.uint64(58)).astype(np.int64), mixed & low)


def _mod(x: np.ndarray, p: np.uint64) -> np.ndarray:
    """x % p; numpy divides by a scalar several times faster than it takes remainders."""
    q = x // p
    q *= p
    return np.subtract(x, q, out=q)


def prints(codes: np.ndarray) -> tuple:
    """(n, whole hash, prefix marks, suffix marks, sketch) of a text's code points."""
    n, table_ = len(codes), _Tables.get()
    marks = MARKS[: np.searchsorted(MARKS, n, "right")]
    at = np.concatenate([marks, n - marks])  # positions whose prefix hash is kept
    kept = np.zeros((2, len(at)), dtype=np.uint64)
    total = [0, 0]
    sketch = np.full(SLOTS, np.iinfo(np.uint64).max, dtype=np.uint64)
    width = min(WIDTH, n)
    for a in range(0, n, BLOCK - WIDTH):
        # The last WIDTH - 1 code points of a block are read again with the next one, for the spans across.
        part = codes[a : a + BLOCK - 1].astype(np.uint64) + np.uint64(1)
        new = min(len(part), BLOCK - WIDTH)
        here = (at >= a) & (at <= a + new)
        hashes = []
        for k, (p, (power, inverse)) in enumerate(zip(PRIMES, table_)):
            prime = np.uint64(p)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_mod(part * power[: len(part)], prime), out=sums[1:])
            step = pow(BASES[k], a, p)
            if here.any():
                kept[k, here] = (sums[at[here] - a] % prime * np.uint64(step) + np.uint64(total[k])) % prime
            total[k] = (total[k] + int(sums[new] % prime) * step) % p
            if k == 0:
                m = max(0, len(part) - width + 1)
                hashes.append(_mod(_mod(sums[width : width + m] - sums[:m], prime) * inverse[:m], prime))
        if len(hashes[0]):
            mixed = hashes[0] * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            _least(sketch, mixed)
    whole = total[0] << 32 | total[1]
    m = len(marks)
    # A suffix of length s has the hash (P[n] - P[n - s]) * B^-(n - s).
    ends = []
    for k, p in enumerate(PRIMES):
        prime, away = np.uint64(p), n - marks
        far = np.array([pow(BASES[k], -int(x) * BLOCK, p) if x else 1 for x in away // BLOCK], dtype=np.uint64)
        back = table_[k][1][away % BLOCK] * far % prime
        ends.append((np.uint64(total[k]) + prime - kept[k, m:]) % prime * back % prime)
    heads, tails = _fold(kept[0, :m], kept[1, :m]), _fold(*ends)
    empty = sketch == np.iinfo(np.uint64).max
    small = np.where(empty, 0, (sketch >> np.uint64(3)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    return n, whole, heads, tails, small


def encode(p: tuple) -> str:
    n, whole, heads, tails, sketch = p
    return f"{n:x}.{whole:016x}.{urlsafe_b64encode(heads.tobytes() + tails.tobytes() + sketch.tobytes()).decode()}"


def decode(fingerprint: str) -> tuple:
    n, whole, rest = fingerprint.split(".", 2)
    data = np.frombuffer(urlsafe_b64decode(rest), dtype=np.uint16)
    m = (len(data) - SLOTS) // 2
    return int(n, 16), int(whole, 16), data[:m], data[m : 2 * m], data[2 * m :]


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common prefix (suffix) as far as the marks tell, by binary search."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[mid - 1] == b[mid - 1] else (low, mid - 1)
    return int(MARKS[low - 1]) if low else 0


def likeness(a: tuple, b: tuple) -> float:
    """1 for equal texts, else the larger of the share in common at both ends and the share of common spans (Dice)."""
    if a[:2] == b[:2]:
        return 1.0
    longest = max(a[0], b[0])
    if not min(a[0], b[0]):
        return 0.0
    ends = min(_agree(a[2], b[2]) + _agree(a[3], b[3]), min(a[0], b[0])) / longest
    used = (a[4] > 0) | (b[4] > 0)
    jaccard = float(np.sum((a[4] == b[4]) & used)) / max(1, int(np.sum(used)))
    return float(min(1.0, max(ends, 2 * jaccard / (1 + jaccard))))


def extension(a: str, b: str, mine: tuple, its: tuple, at: int) -> int:
    """Length of the longest common prefix of two texts (at = 2) or suffix (at = 3), exact but for collisions of whole hashes: up to the first mark where the fingerprints differ, by binary search on prefix arrays."""
    if mine[:2] == its[:2]:
        return mine[0]
    k = int(np.searchsorted(MARKS, _agree(mine[at], its[at]), "right"))
    most = min(len(a), len(b), int(MARKS[k]))
    if not most:
        return 0
    parts = [x[:most] if at == 2 else x[-most:][::-1] for x in (a, b)]
    return PrefixHashes(parts[0]).common(0, PrefixHashes(parts[1]), 0)


def fingerprint(text: str | None) -> str:
    return encode(prints(code_points(text)))


def edited(text: str, following: str) -> str:
    """text with its last half replaced by the first as many code points of the following one, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_start long, common_end long"


def _row(own: tuple, following: tuple) -> tuple:
    (doc_id, text, mine), (_, after, its) = own, following
    new = edited(text, after)
    changed = prints(code_points(new)) if new != text else mine
    ends = [extension(text, after, mine, its, at) for at in (2, 3)]
    return doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), encode(mine), encode(changed), likeness(mine, changed), likeness(mine, its), *ends


def _neighbours(batches):
    """Rows sorted by (bucket, doc_id, text): each but the last of a bucket with the one after it."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    before, bucket = None, None
    for batch in batches:
        out = []
        for b, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            now = (doc_id, text or "", prints(code_points(text)))
            if before is not None and b == bucket:
                out.append(_row(before, now))
            before, bucket = now, b
        if out:
            columns = zip(*out)
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def fingerprints(docs: DataFrame, per_bucket: int = 4000, most: int = 65536) -> DataFrame:
    """Each document's fingerprint, its edited text's, and the likeness to both neighbours in order of doc_id.

    The order is cut into buckets by quantiles of doc_id, `most` at most, each of about per_bucket rows up to that number; an id
    that fills several is cut further by ranges of the hash of its texts. A bucket is a partition, and also gets the first row
    of the next one (of the last: the first row of all), so that every row meets its neighbour in one shuffle of the texts and
    rows stream through a sort. Rows with the same id and text stay in one bucket.
    """
    spark = docs.sparkSession
    id_, h = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))), F.xxhash64(F.coalesce("text", F.lit("")))
    ids = docs.select(id_.alias("id"))
    n = ids.count()
    if not n:
        return spark.createDataFrame([], SCHEMA)
    count = max(1, min(most, n // per_bucket))
    # approxQuantile gives doubles; a cut need not be an id, only the same for all rows.
    found = [int(x) for x in ids.stat.approxQuantile("id", [k / count for k in range(1, count)], 0.2 / count)] if count > 1 else []
    cuts = sorted(set(found))
    step = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    # A cut that comes m times is an id with some m buckets' rows: its bucket is cut into m by the hash, and what follows the id goes to the last.
    times = Counter(found)
    parts = [1, *(times[c] for c in cuts)]
    start = [0]
    for m in parts:
        start.append(start[-1] + m)
    width = start.pop()

    def looked_up(values: list[int], at):
        return F.element_at(F.lit(values).cast("array<long>"), at + 1)

    def bucket_of(c, hashed):
        """The number of cuts up to c, by two short scans, and the range of the hash."""
        if not cuts:
            return F.lit(0)
        group = F.size(F.filter(F.lit([g[0] for g in groups]).cast("array<long>"), lambda x: x <= c))
        inner = F.element_at(F.lit([g + [(1 << 63) - 1] * (step - len(g)) for g in groups]).cast("array<array<long>>"), F.greatest(group, F.lit(1)))
        base = F.when(group == 0, 0).otherwise((group - 1) * step + F.size(F.filter(inner, lambda x: x <= c)))
        if width == len(parts):
            return base
        m = looked_up(parts, base)
        spot = F.when(c == looked_up([-(1 << 63), *cuts], base), F.shiftright((F.shiftright(hashed, 32) + F.lit(1 << 31)) * m, 32)).otherwise(m - 1)
        return (looked_up(start, base) + spot).cast("int")

    rows = docs.select("doc_id", "text", id_.alias("id"), h.alias("h"))
    rows = rows.withColumn("b", bucket_of(F.col("id"), F.col("h")))
    # `most` rows, or as many again as hot ids were cut into.
    spans = rows.groupBy("b").agg(F.min(F.struct("id", "h")).alias("first")).orderBy("b").collect()
    held = [r["b"] for r in spans]
    firsts = spark.createDataFrame([(r["first"]["id"], r["first"]["h"], held[i - 1]) for i, r in enumerate(spans)], "id long, h long, prior int")
    # Of rows that share the first id and hash only the first by text is wanted; all are sent, and the sort puts them last in the bucket before.
    rows = rows.join(F.broadcast(firsts), ["id", "h"], "left")
    rows = rows.withColumn("copy", F.explode(F.when(F.col("prior").isNull(), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    at = F.when(F.col("copy") == 0, F.col("b")).otherwise(F.col("prior"))
    rows = rows.select(at.cast("int").alias("bucket"), "doc_id", "text", "copy", "h")
    # A bucket is its partition's number: hashed numbers would leave some partitions empty and fill others twice.
    rows = rows.repartitionById(width, "bucket").sortWithinPartitions("bucket", "copy", F.col("doc_id").asc_nulls_first(), "h", F.col("text").asc_nulls_first())
    return rows.drop("h").mapInArrow(_trimmed, SCHEMA)


def _trimmed(batches):
    """Drops all but the first of a bucket's rows lent by the next bucket, then pairs neighbours."""
    def lent():
        seen = None
        for batch in batches:
            keep = []
            for b, c in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                keep.append(c == 0 or seen != b)
                if c:
                    seen = b
            yield batch.filter(pa.array(keep))

    return _neighbours(lent())


def op1_span_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
