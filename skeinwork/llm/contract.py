r"""SQL for what SQL can say of the operators' results, and queries that give just that.

op4 and op5 are compared whole; op5's SQL knows the markup of the tables' pages alone (an <article> of <h1> and <p>), the
operator any. Of the others, the parts that need no model, hash or search have queries of their own here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import license_scan, mix_sources, pattern_pii, ring_shards, span_prints
from .common import table

CHAT_TEMPLATES = r"""
  with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
  select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (where role = 'assistant'), '')) as loss_sha256,
    cast(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) as bigint) as formatted_chars
  from c group by conv_id"""

HOST_EXTRACT = r"""
  with b as (select page_id, url, regexp_extract(html, '<article>(.*?)</article>', 1, 's') as body from pages),
  -- A title may be cut inside a reference: &amp, &lt and the like count without their semicolon too.
  t as (select page_id, url, list_transform(string_split_regex(body, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(
    regexp_replace(x, '<[^>]*>', ' ', 'g'), '&#39;', ''''), '&nbsp;?', ' ', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) as parts from b),
  j as (select page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) as text from t)
  select page_id, url, text, length(text) as n_chars, 'markup' as decided from j"""

SQL = {"op4_chat_templates": CHAT_TEMPLATES, "op5_host_extract": HOST_EXTRACT}
QUERIES = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@query("""
  with d as (select doc_id, coalesce(text, '') as t, coalesce(lead(text) over w, first_value(text) over (order by doc_id), '') as f, lead(doc_id) over w as follows from documents window w as (order by doc_id)),
  e as (select doc_id, t, case when follows is null then coalesce(first_value(t) over (order by doc_id), '') else f end as f from d)
  select doc_id, length(t) as n_chars, sha256(substr(t, 1, length(t) - length(t) // 2) || substr(f, 1, length(t) // 2)) as edited_sha256 from e""")
def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1 without its fingerprints."""
    return span_prints.fingerprints(table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


@query("""
  with n as (select count(*) as n, sum(strlen(coalesce(text, '')) + 16) as bytes from documents),
  s as (select cast(range as int) as shard from range(40))
  select cast(n // 40 + case when shard < n % 40 then 1 else 0 end as bigint) as n_rows, cast(count(*) as bigint) as shards, cast(any_value(bytes) as bigint) as bytes from s, n group by 1""")
def shard_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3's law: how many shards have how many rows, and the sizes of all rows."""
    out = ring_shards.shard_documents(table(spark, sf_dir, "documents"))
    each = out.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"), (F.max("slot") + 1).alias("slots"), F.count_distinct("slot").alias("different"))
    total = each.agg(F.sum("bytes").alias("bytes")).withColumn("one", F.lit(1))
    sound = each.where("n_rows = slots and n_rows = different").groupBy("n_rows").agg(F.count("*").alias("shards")).withColumn("one", F.lit(1))
    return sound.join(total, "one").drop("one")  # the total is one row


@query(r"""
  with d as (select doc_id, coalesce(text, '') as t from documents),
  f as (select doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') as e, regexp_extract_all(t, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+') as i,
    list_transform(regexp_extract_all(t, '[0-9](?:[ -]?[0-9])+'), lambda x: regexp_replace(x, '[ -]', '', 'g')) as c, list_transform(regexp_extract_all(t, '\+[0-9][ ().0-9-]+[0-9]'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g'))) as p from d)
  select doc_id, cast(len(e) as bigint) as n_email, cast(len(list_filter(i, lambda x: list_max(list_transform(string_split(x, '.'), lambda y: cast(y as hugeint))) <= 255)) as bigint) as n_ip,
    cast(len(list_filter(c, lambda x: length(x) between 13 and 19 and list_sum(list_transform(range(1, length(x) + 1), lambda k: case when k % 2 = 1 then cast(x[length(x) - k + 1] as int)
      when cast(x[length(x) - k + 1] as int) > 4 then 2 * cast(x[length(x) - k + 1] as int) - 9 else 2 * cast(x[length(x) - k + 1] as int) end)) % 10 = 0)) as bigint) as n_card,
    cast(len(list_filter(p, lambda x: x between 9 and 15)) as bigint) as n_phone from f""")
def personal_data_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7's base: what its forms find."""
    return pattern_pii.scanned(table(spark, sf_dir, "documents")).select("doc_id", *(f"n_{k}" for k in pattern_pii.KINDS))


@query(r"""
  with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
  p as (select * from (values (['under', 'the', 'mit', 'license'], 'mit'), (['apache', 'license', 'version', '2'], 'apache-2'), (['cc', 'by', 'nc'], 'cc-by-nc')) as v (words, label)),
  h as (select doc_id, label, unnest(list_filter(range(0, len(w)), lambda i: w[i + 1 : i + len(words)] = words)) as spot from d, p)
  select d.doc_id, cast(any_value(len(w)) as bigint) as n_words, count(spot) as n_base, coalesce(min(spot), -1) as first_word, coalesce(max(spot), -1) as last_word, coalesce(string_agg(distinct label, ',' order by label), '') as base_labels
  from d left join h on h.doc_id = d.doc_id group by d.doc_id""")
def license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8's base: the phrases and where they stand, -1 for nowhere."""
    scanned, _ = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    first, last = (F.coalesce(c, F.lit(-1)).alias(c) for c in ("first_word", "last_word"))
    return scanned.select("doc_id", "n_words", "n_base", first, last, F.array_join("base", ",").alias("base_labels"))


@query(r"""
  with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
  s as (select source, sum(size) as words, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from d group by 1),
  r as (select *, 2.0 * words / w as level, sum(2.0 * words) over (order by 2.0 * words / w rows between unbounded preceding and 1 preceding) as full_, sum(w) over (order by 2.0 * words / w rows between current row and unbounded following) as open_, 1.5 * sum(words) over () as budget from s where words > 0),
  u as (select arg_min((budget - coalesce(full_, 0)) / open_, level) filter (where (budget - coalesce(full_, 0)) / open_ <= level) as unit from r),
  t as (select s.*, case when words = 0 then 0 else least(w * unit, 2.0 * words) end as target from s, u)
  select doc_id, cast(size as bigint) as size, cast(words as bigint) as source_size, round(target, 4) as target from d join t on d.source is not distinct from t.source""")
def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9 without its choice: sizes and targets."""
    out = mix_sources.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["doc_id", "source"])
    return out.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"))
