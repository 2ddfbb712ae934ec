r"""Personal data by bootstrapped contextual extraction.

The base finds e-mail and IP addresses, card and phone numbers by their form. Kind `id` is found by bootstrapping. Instances are
the base's spans, IBANs, and every identifier-like token: one with a digit or an @, or one in quotes after an assignment sign.
Each is an instance of the lexical patterns around it, which say nothing of the token itself: the word before it with the signs
between, the two words before it, the word after it, and both sides.

Seeds, whose belief is 1: the base's spans; IBANs with a right check number; and SEEDS distinct tokens of the corpus, those with
the least hash among the ones of a key's form (KEY: 16 or more letters and digits, both) that stand by one of the CUES. No other
token is believed for its form or for the word beside it. Counter-examples, whose belief is 0: what has a form of the base and
fails its test, and PLAIN numbers (years and ranges of years, counts, decimals, versions, dates, times).

Spark scores the graph in rounds: a pattern's confidence is belief / (belief + counter-examples + PRIOR), summed over its
distinct instances (one of unknown kind with no belief yet weighs nothing), times the share of its strongest kind in the belief:
"call" stands before phone numbers, "of" before anything. An instance's belief is the noisy-or of its patterns'
confidence. Patterns that end with SURE confidence and SUPPORT distinct believed instances mark every instance of unknown kind
around which they stand, so an identifier is found that no seed and no list named. `n_discovered` counts those.

What moves between nodes is (pattern, instance) pairs; texts stay where they are. Counts are over distinct instances, combined on
the map side, so that a pattern or a copied passage with a third of all rows is one row a partition. A context reaches CONTEXT
characters to either side of its token; the token and the text are taken whole.

Cases: null is the empty text; a text of any length is read whole, in linear time; texts that repeat get the same spans; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, row_key, settled, table

KINDS = ("email", "ip", "card", "phone")
ROUNDS, SURE, SUPPORT, PRIOR, SEEDS, CONTEXT = 3, 0.8, 5, 1.0, 16, 64
#: `known` of a base span of the first kind; those of the others follow.
BASE = 10
CUES = frozenset("token secret password passwd apikey key".split())
#: What a seed beside a cue looks like.
KEY = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9+/_-]{16,}")
#: Numbers that identify nobody.
PLAIN = re.compile(
    r"[0-9]{1,4}(?:st|nd|rd|th|s|%)?|[0-9]{1,3}(?:[,.][0-9]{3})+|[vV]?[0-9]+(?:[.,][0-9]+)+%?|[0-9]{4}[-/\u2013][0-9]{2,4}|[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}|[0-9]{1,2}(?::[0-9]{2}){1,2}(?:\.[0-9]+)?|[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.+Z-]+"
)

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile(r"[0-9@]")
_BREAK = frozenset("\"'`=,;|<>(){}[]")
_PIECE = re.compile(r"[^\s\"'`=,;|<>(){}\[\]]*")
_QUOTED = re.compile(r"[=:]\s*([\"'])([^\s\"']+)\1")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SPARE = ".:!?#*$%&~^"


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the e-mail form, leftmost and apart, in time linear in the text: every match holds one @, so these are gone through."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL_SET:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, m.end()))
            done = m.end()
        else:
            done = at + 1  # a local part can't reach over an @
        at = text.find("@", max(at + 1, done))
    return out


Spans = list[tuple[int, int]]


def addresses(text: str) -> tuple[Spans, Spans]:
    """Matches of four dotted runs of digits, leftmost and apart: those whose parts are 255 at most, and the others."""
    out, not_ = [], []
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        run: list[tuple[int, int]] = []
        at = m.start()
        for part in m.group().split("."):
            if part:
                run.append((at, at + len(part)))
                if len(run) == 4:
                    parts = [text[a:b].lstrip("0") or "0" for a, b in run]
                    fits = all(len(x) <= 3 and int(x) <= 255 for x in parts)
                    (out if fits else not_).append((run[0][0], run[3][1]))
                    run = []
            else:
                run = []
            at += len(part) + 1
    return out, not_


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> tuple[Spans, Spans]:
    """Runs of 13 to 19 digits: those that pass Luhn's check, and the others."""
    out, not_ = [], []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19:
                (out if luhn(digits) else not_).append(m.span())
    return out, not_


def phones(text: str) -> Spans:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], Spans]:
    """((kind, start, end) by kind as listed, then start; spans that have a form but fail its test)."""
    found, failed = [("email", s) for s in emails(text)] if "@" in text else [], []
    if _DIGIT.search(text):
        ips, no_ips = addresses(text)
        numbers, no_numbers = cards(text)
        found += [("ip", s) for s in ips] + [("card", s) for s in numbers] + [("phone", s) for s in phones(text)]
        failed = no_ips + no_numbers
    return [(k, a, b) for k, (a, b) in found], failed


def iban(span: str) -> bool:
    """Whether the check number is right."""
    x = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def tokens(text: str) -> Spans:
    """Identifier-like tokens, left to right and apart: pieces between white space, quotes, brackets and signs of assignment or lists that hold a digit or an @, and quoted ones after an assignment."""
    out, done = [], 0
    m = _SIGN.search(text)
    while m:
        a = m.start()
        while a > done and not text[a - 1].isspace() and text[a - 1] not in _BREAK:
            a -= 1
        done = b = _PIECE.match(text, m.start()).end()
        while a < b and text[a] in _SPARE:
            a += 1
        while b > a and text[b - 1] in _SPARE:
            b -= 1
        if a < b:
            out.append((a, b))
        m = _SIGN.search(text, done)
    held = set(out)
    return sorted(held | {m.span(2) for m in _QUOTED.finditer(text) if not _SIGN.search(m.group(2))})


_WORD = re.compile(r"\w+")
_NUMBER = re.compile(r"[0-9]+")
_WHITE = re.compile(r"\s+")


def contexts(text: str, a: int, b: int, reach: int = CONTEXT) -> tuple[list[str], str]:
    """(patterns of the place a to b, the word before it)."""
    before, after = text[max(0, a - reach) : a].lower(), text[b : b + reach].lower()
    words = [m for m in _WORD.finditer(before)][-2:]
    named = [_NUMBER.sub("9", m.group()) for m in words]
    left = _WHITE.sub(" ", before[words[-1].end() :]) if words else ""
    m = _WORD.search(after)
    right = f"{_WHITE.sub(' ', after[: m.start()])}|{_NUMBER.sub('9', m.group())}" if m else ""
    out = []
    if words:
        out.append(f"l1|{named[-1]}|{left}")
        if len(words) > 1:
            out.append(f"l2|{named[0]}|{named[1]}|{left}")
        if right:
            out.append(f"lr|{named[-1]}|{left}|{right}")
    if right:
        out.append(f"r1|{right}")
    return out, named[-1] if named else ""


def _over(spans: Spans, ends: list[int], a: int, b: int) -> bool:
    """Whether a to b overlaps one of the spans, which are sorted and merged; ends are their ends."""
    i = bisect_left(ends, a + 1)
    return i < len(spans) and spans[i][0] < b


def _merged(spans: Spans) -> tuple[Spans, list[int]]:
    out: Spans = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out, [b for _, b in out]


def instances(text: str, base: list[tuple[str, int, int]], failed: Spans) -> list[tuple[int, int, int]]:
    """(start, end, known) of the places of a text that patterns stand around: known is BASE and up for a base span by its kind, 3 for an IBAN, -1 for a counter-example, 1 for what may be chosen as a seed, else 0."""
    if not _SIGN.search(text) and not _QUOTED.search(text):
        return []
    # A run of digits inside a longer word, such as a hash, is neither a seed nor a counter-example.
    whole = lambda a, b: not (a and text[a - 1].isalnum() or b < len(text) and text[b].isalnum())
    out = [(a, b, BASE + KINDS.index(k)) for k, a, b in base if whole(a, b)]
    failed = [x for x in failed if whole(*x)]
    seen, ends = _merged([(a, b) for a, b, _ in out])
    fresh = [(a, b, -1) for a, b in failed if not _over(seen, ends, a, b)]
    fresh += [(*m.span(), 3) for m in _IBAN.finditer(text) if not _over(seen, ends, *m.span()) and iban(m.group())]
    ibans = [(a, b) for a, b, k in fresh if k == 3]
    if ibans:  # a failed form inside an IBAN says nothing against it
        held = _merged(ibans)
        fresh = [x for x in fresh if x[2] == 3 or not _over(*held, x[0], x[1])]
    out += fresh
    seen, ends = _merged([(a, b) for a, b, _ in out])
    for a, b in tokens(text):
        if not _over(seen, ends, a, b):
            out.append((a, b, -1 if PLAIN.fullmatch(text, a, b) else 1 if KEY.fullmatch(text, a, b) else 0))
    return sorted(out)


SCANNED = (
    "key string, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, "
    "found array<struct<start:long,end:long,patterns:array<string>,instance:string,known:int>>"
)
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("patterns", pa.list_(pa.string())), ("instance", pa.string()), ("known", pa.int32())]))


def _scan(batch):
    """The base of each row and the instances of its patterns. A token of a key's form has known 1 only if a cue stands before it."""
    rows = []
    for key, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
        text = text or ""
        base, failed = base_spans(text)
        write = [f"{k}:{a}:{b}" for k, a, b in base]
        found = []
        for a, b, known in instances(text, base, failed):
            patterns, word = contexts(text, a, b)
            digest = hashlib.blake2b(text[a:b].encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
            found.append({"start": a, "end": b, "patterns": patterns, "instance": digest, "known": 0 if known == 1 and word not in CUES else known})
        counts = [sum(k == x for k, _, _ in base) for x in KINDS]
        rows.append((key, doc_id, *counts, hashlib.sha256(",".join(write).encode()).hexdigest(), ",".join(write), found))
    types = [pa.string(), pa.int64(), *[pa.int64()] * 4, pa.string(), pa.string(), _FOUND]
    names = ["key", "doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "found"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def scanned(docs: DataFrame) -> DataFrame:
    """One pass over the texts: a narrow row for each; key stands for (doc_id, text) with 128 bits."""
    return map_arrow(docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text"), _scan, SCANNED)


def learn_patterns(scan: DataFrame, rounds: int = ROUNDS, sure: float = SURE, support: int = SUPPORT, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """((pattern, confidence, support) of the patterns that hold, (instance) of the chosen seeds), from all scanned rows."""
    graph = scan.select(F.explode("found").alias("f")).select(F.explode("f.patterns").alias("pattern"), "f.instance", "f.known")
    graph = settled(graph.groupBy("pattern", "instance").agg(F.min("known").alias("low"), F.max("known").alias("high")))
    known = graph.groupBy("instance").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    # At most `seeds` rows, whatever the corpus.
    chosen = settled(known.where("low >= 0 and high = 1").select("instance").orderBy("instance").limit(seeds))
    # A counter-example stays one for good, wherever else it stands.
    fixed = known.join(F.broadcast(chosen.withColumn("seed", F.lit(1))), "instance", "left")
    fixed = settled(fixed.select("instance", F.when(F.col("high") >= BASE, F.col("high")).otherwise(0).alias("kind"), F.when(F.col("low") < 0, 0.0).when((F.col("high") > 1) | F.col("seed").isNotNull(), 1.0).alias("fixed")))
    believed = fixed.withColumn("belief", F.coalesce("fixed", F.lit(0.0)))
    for k in range(rounds):
        by_kind = [F.sum(F.when(F.col("kind") == n, F.col("belief")).otherwise(0.0)).alias(f"k{n}") for n in (0, *range(BASE, BASE + len(KINDS)))]
        scored = graph.join(believed, "instance").groupBy("pattern").agg(F.sum("belief").alias("belief"), *by_kind, F.count_if(F.col("fixed") == 0.0).alias("against"), F.count_if(F.col("belief") >= 0.5).alias("support"))
        strongest = F.greatest("k0", *(f"k{n}" for n in range(BASE, BASE + len(KINDS))))
        # belief / (belief + against + PRIOR) times strongest / belief
        scored = scored.select("pattern", (strongest / (F.col("belief") + F.col("against") + PRIOR)).alias("confidence"), "support")
        if k < rounds - 1:
            strong = scored.where((F.col("confidence") >= sure / 2) & (F.col("support") >= 2)).select("pattern", "confidence")
            doubt = graph.join(strong, "pattern").groupBy("instance").agg(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))).alias("doubt"))
            believed = fixed.join(doubt, "instance", "left").withColumn("belief", F.coalesce("fixed", 1.0 - F.exp(F.coalesce("doubt", F.lit(0.0)))))
    return scored.where((F.col("confidence") >= sure) & (F.col("support") >= support)), chosen


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id, n_discovered (those of n_id that aren't seeds), n_spans for every row."""
    scan = settled(scanned(docs))
    patterns, seeds = learn_patterns(scan, **options)
    found = scan.select("key", F.explode("found").alias("f")).where("f.known in (0, 1, 3)").select("key", "f.start", "f.end", "f.instance", "f.known", F.explode_outer("f.patterns").alias("pattern"))
    found = found.join(patterns.select("pattern", F.lit(1).alias("held")), "pattern", "left").join(F.broadcast(seeds.withColumn("seed", F.lit(1))), "instance", "left")
    more = found.where("held = 1 or seed = 1 or known = 3").groupBy("key", "start", "end").agg(F.max(F.when((F.col("seed") == 1) | (F.col("known") == 3), 0).otherwise(1)).alias("fresh"))
    more = more.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("more"), F.sum("fresh").alias("fresh"))
    out = scan.drop("found").join(more, "key", "left")
    added = F.coalesce(F.transform("more", lambda x: F.concat_ws(":", F.lit("id"), x["start"], x["end"])), F.array().cast("array<string>"))
    spans = F.array_join(F.concat(F.when(F.col("base") == "", F.array().cast("array<string>")).otherwise(F.array("base")), added), ",")
    n_id = F.size(added).cast("long")
    total = F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone") + n_id
    return out.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", spans.alias("spans"), n_id.alias("n_id"), F.coalesce("fresh", F.lit(0)).cast("long").alias("n_discovered"), total.alias("n_spans"))


def op7_pattern_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
