"""The registered queries of the corpus operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, gnat, grouping, jaccard, lm, packing, pii, quality, rules, spelling, sstable, substring, warc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(_read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs)).drop("th")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), TOKENIZER)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_read(spark, sf_dir, "documents"), TOKENIZER).drop("th")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.with_ablation(rules.ledger(_read(spark, sf_dir, "documents")), "clean-1")
    base = F.col("failed").bitwiseAND(F.lit(rules.POLICIES["base-1"])) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "sole_rule", "sole_rule_docs")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_read(spark, sf_dir, "documents")).drop("th")


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.token_shards(_read(spark, sf_dir, "documents"), TOKENIZER)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("th")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, _read(spark, sf_dir, "labels"))).drop("th")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gnat.mine(_read(spark, sf_dir, "embeddings")).drop("ath")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.pack(_read(spark, sf_dir, "documents"), WORD_TOKENIZER)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_pii, op3_warc, op4_packing, op5_lm_scoring, op6_quality_rules, op7_jaccard_join, op8_token_shards, op9_decontamination, op10_quality_classifier, op11_hard_negatives, op12_spelling_variants, op13_best_fit_packing, pipeline)}

_WORDS = r"""select doc_id, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents"""

ORACLE_SQL = {
    "op1_substring_dedup": f"""
with w as ({_WORDS}),
win as (select doc_id, i, array_to_string(ws[i:i+49], ' ') as k
        from (select doc_id, ws, unnest(generate_series(1, len(ws) - 49)) as i from w where len(ws) >= 50)),
seen as (select doc_id, i, min(doc_id) over (partition by k) as f from win),
gone as (select distinct doc_id, unnest(generate_series(i, i + 49)) as p from seen where f < doc_id),
per as (select doc_id, list(p) as ps, count(*) as n from gone group by doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(array_to_string(case when ps is null then ws else
    list_transform(list_filter(generate_series(1, len(ws)), lambda p: not list_contains(ps, p)), lambda p: ws[p]) end, ' '), '')) as kept_sha256
from w left join per using (doc_id)""",
    "op3_warc": """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, strlen(h) as payload_bytes, sha1(h) as x, max(page_id) over (partition by h) as m from p)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
  array_to_string(list_transform(generate_series(0, 31), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr(x, 5 * cast(floor(k / 4) as int) + 1, 5) as int) >> (15 - 5 * (k % 4))) & 31), 1)), '') as payload_digest,
  case when page_id = m then 'response' else 'revisit' end as record_type, case when page_id < m then m end as refers_to
from d""",
    "op6_quality_rules": f"""
with w as ({_WORDS}),
win as (select doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] as k
        from (select doc_id, ws, unnest(generate_series(1, len(ws) - 2)) as i from w where len(ws) >= 3)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, k) as c from win) where c > 1),
per as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from rep) group by doc_id),
m as (select w.doc_id, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
        cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as ls,
        cast(coalesce(per.n, 0) as bigint) as n_repeat_words,
        len(list_filter(ws, lambda x: trim(x, '#*$%&|<>') = '')) as lone
      from w left join per using (doc_id)),
f as (select *, cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
g as (select *, list_filter([case when n_words < 50 then 'few_words' end, case when 100 * n_repeat_words > 50 * n_words then 'repeated_words' end,
    case when 100 * n_symbols > 10 * coalesce(word_chars, 0) then 'many_symbols' end, case when coalesce(word_chars, 0) < 2 * n_words then 'short_words' end,
    case when coalesce(word_chars, 0) > 20 * n_words then 'long_words' end, case when len(ls) >= 4 and 100 * n_dup_lines > 50 * len(ls) then 'repeated_lines' end,
    case when 100 * lone > 20 * n_words then 'lone_symbols' end], lambda x: x is not null) as bad from f)
select doc_id, n_words, coalesce(word_chars, 0) as word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, len(bad) = 0 as kept,
  case when len(bad) = 1 then bad[1] end as sole_rule, case when len(bad) = 1 then count(*) over (partition by len(bad) = 1, bad[1]) end as sole_rule_docs
from g""",
    "op7_jaccard_join": r"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i:i+4], ' ') as k from (select doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) as i from w where len(ws) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.k = b.k and a.doc_id <> b.doc_id group by all),
links as (select x, y from pairs join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)),
reach as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, least(w.doc_id, coalesce(r.m, w.doc_id)) as component_id
from w left join n using (doc_id) left join (select x, min(y) as m from reach group by x) r on r.x = w.doc_id""",
    "op11_hard_negatives": """
with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
           from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, cast(list_dot_product(a.v, b.v) as bigint) as s from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
pos as (select a, b, s from (select *, row_number() over (partition by a order by s desc, b) as k from s where same) where k <= 5),
neg as (select p.a, p.b, p.s, n.b as nb, n.s as ns, row_number() over (partition by p.a, p.b order by n.s desc, n.b) as k
        from pos p join s n on n.a = p.a and not n.same and 80 * p.s <= 100 * n.s and 100 * n.s <= 100 * p.s)
select a as anchor_id, b as positive_id, cast(k as int) as rank, nb as negative_id, s as positive_score, ns as negative_score from neg where k <= 5""",
    "op12_spelling_variants": r"""
with recursive t as (select list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t),
runs as (select doc_id, w, count(*) as n from (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as w from documents) where length(w) >= 5 group by all),
hashed as (select w, n, xor(list_reduce(list_transform(range(0, strlen(x)), lambda i: cast('0x' || substr(hex(x), cast(2 * i + 1 as bigint), 2) as bigint)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) as h
           from (select w, n, coalesce(cast(doc_id as varchar), '') || ':' || w as x from runs), t),
words as (select w, cast(sum(n) as bigint) as n from (select case when h % 97 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as w, n from hashed) where length(w) >= 5 group by w having sum(n) >= 3),
less as (select w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) as r from (select w, n, unnest(range(1, length(w) + 1)) as i from words)),
near as (select a.w, b.w as x, b.n as k from less a join less b on a.i = b.i and a.r = b.r and a.w <> b.w
   union select a.w, b.w, b.n from less a join words b on a.r = b.w union select b.w, a.w, a.n from less a join words b on a.r = b.w),
best as (select w, count(*) as n_near, max(k) as k, arg_min(x, struct_pack(a := -k, b := x)) as x from near group by w),
f as (select words.w, words.n, coalesce(n_near, 0) as n_near, case when k >= 2 * words.n then x end as form, case when k >= 2 * words.n then k end as form_n from words left join best using (w)),
chain as (select w, w as at from f union all select c.w, f.form from chain c join f on f.w = c.at where f.form is not null)
select f.w as word, f.form, c.at as root, f.n, f.n_near, f.form_n from f join chain c on c.w = f.w join f g on g.w = c.at and g.form is null""",
}
