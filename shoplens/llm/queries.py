"""One registered query per llm operator, with production parameters and over the
whole intended table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import (bloom_lm, decontaminate, fim, html_extract, langid, mixing, paragraph_dedup, resampling, secret_scan,
                          simhash, token_counts, topk, toxicity)
from shoplens.llm.common import table


def op1_paragraph_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return paragraph_dedup.repeats(table(spark, sf, "documents"))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"), width=4, max_bits=4)


def op3_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract(table(spark, sf, "pages"))


def op4_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf, "documents"))


def op6_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.taken(table(spark, sf, "documents"), placed=True)


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.predictions(table(spark, sf, "documents"))


def op9_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop(
        "n_near_items", "text_key")


def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.findings(table(spark, sf, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fim.digests(table(spark, sf, "documents"))


def op12_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resampling.resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return bloom_lm.scores(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_paragraph_dedup, op2_simhash, op3_html_extract, op4_top_k, op5_token_counts, op6_toxicity, op7_mixing,
        op8_language_id, op9_decontaminate, op10_secret_scan, op11_fill_in_middle, op12_resampling, op13_lm_scores)
}

ORACLE: dict[str, str] = {}

ORACLE["op4_top_k"] = r"""
with whole as (
    select vec_id, min([cast(floor(cast(x as double) * 256) as bigint) for x in embedding]) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    group by vec_id),
scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_sum([q.v[i] * c.v[i] for i in generate_series(1, least(len(q.v), len(c.v)))])
               as bigint) as score
    from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from scored qualify rank <= 5
"""

# The layout is ordered by a hash that DuckDB has too, so every document's share is the same, and
# so is its place in the schedule: slot i is the lattice point i * k mod n.
ORACLE["op7_mixing"] = r"""
with sized as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
    from documents),
per as (
    select source, cast(sum(size) as bigint) as source_size,
           row_number() over (order by source nulls last) - 1 as number
    from sized group by source),
weighed as (
    select *, [3, 1, 2][cast(number % 3 as int) + 1] as weight, 2 * source_size as most from per),
leveled as (
    select *, (sum(source_size) over () * 1.5::double
               - coalesce(sum(most) over (order by most / weight, number rows between unbounded preceding and 1 preceding), 0))
              / sum(weight) over (order by most / weight, number rows between current row and unbounded following) as own_level
    from weighed),
settled as (select arg_min(own_level, most / weight) as level from leveled where not most <= weight * own_level),
plan as (
    select number, source, source_size, coalesce(least(most::double, weight * level), most::double) as target,
           cast(floor(target + 0.5) as bigint) as words, cast(ceil(words / 2048) as bigint) as blocks,
           cast(sum(blocks) over (order by number) as bigint) as hi
    from leveled left join settled on true),
steps as (select max(hi) as n, cast(round(n * (sqrt(5) - 1) / 2) as bigint) as near from plan),
step as (
    select n, coalesce((select arg_min(k, [abs(k - near), case when k < near then 1 else 0 end])
                        from unnest(range(1, n)) u(k) where gcd(k, n) = 1), 1) as k from steps),
slots as (
    select slot, number, row_number() over (partition by number order by slot) - 1 as block
    from (select slot, slot * k % n as point from step, unnest(range(n)) u(slot)) join plan on hi - blocks <= point and point < hi),
laid as (
    select s.doc_id, p.number, p.source, s.size, p.source_size, p.target, p.words,
           coalesce(sum(s.size) over (partition by p.source order by
               substr(md5(concat_ws('/', cast(s.doc_id as varchar), cast(s.size as varchar))), 1, 15), s.size, s.doc_id
               rows between unbounded preceding and 1 preceding), 0)::bigint as first
    from sized s join plan p on s.source is not distinct from p.source),
runs as (
    select number, first, first + run * source_size as begins, least(first + run * source_size + size, words) as ends
    from laid, unnest([0, 1]) u(run) where size > 0),
pieces as (
    select number, first, block from runs, unnest(range((begins // 2048)::bigint, ((ends - 1) // 2048 + 1)::bigint)) u(block) where begins < ends),
placed as (
    select number, first, min(slot) as first_slot, count(*) as n_pieces
    from pieces join slots using (number, block) group by number, first)
select doc_id, source, size, source_size, target, cast(
    greatest(0, least(first + size, words) - first)
    + greatest(0, least(first + source_size + size, words) - (first + source_size)) as bigint) as taken,
    case when size > 0 then first_slot end as first_slot, case when size > 0 then coalesce(n_pieces, 0) else 0 end as n_pieces
from laid left join placed using (number, first)
"""

ORACLE["op9_decontaminate"] = r"""
with tokens as (
    select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
items as (
    select coalesce(cast(item_id as varchar), '') as item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark),
windows as (
    select distinct item_id, least(len(w), 10) as n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') as phrase
    from items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) u(k) where len(w) > 0),
lengths as (select distinct n from windows),
places as (
    select row, k, n, array_to_string(w[k : k + n - 1], ' ') as phrase
    from tokens, lengths, unnest(range(1, len(w) - n + 2)) u(k) where len(w) >= n),
found as (select row, k, n, item_id from places join windows using (n, phrase)),
hits as (select row, count(distinct p) as n_hit from found, unnest(range(k, k + n)) u(p) group by row),
named as (select row, count(distinct item_id) as n_items, list_sort(list(distinct item_id)) as ids from found group by row)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from tokens left join hits using (row) left join named using (row)
"""

ORACLE["op11_fill_in_middle"] = r"""
with drawn as (
    select doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
           [cast('0x' || substr(sha256('42:' || coalesce(cast(doc_id as varchar), '')), 8 * k + 1, 8) as bigint)
            for k in [0, 1, 2, 3]] as h
    from documents),
cut as (
    select *, len(u) as n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 50
                then 'plain' when h[4] % 100 < 80 then 'spm' else 'psm' end as form
    from drawn),
parts as (
    select *, coalesce(array_to_string(u[1 : a], ''), '') as p, coalesce(array_to_string(u[a + 1 : b], ''), '') as m,
           coalesce(array_to_string(u[b + 1 : n], ''), '') as s
    from cut)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(p || m || s) as restored_sha256
from parts
"""

# DuckDB has no CRC-32: its table is made here, and a word's bytes are read off its hex form.
ORACLE["op12_resampling"] = r"""
with words as (
    select row_number() over () as row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents),
goal as (
    select unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
    from benchmark),
steps as (
    select list(list_reduce([cast(i as bigint), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
    from range(256) r(i)),
occurrences as (select row, unnest(w) as word from words),
vocabulary as (
    select word, xor(list_reduce(list_prepend(4294967295::bigint,
               [cast('0x' || substr(hex(encode(word)), 2 * k - 1, 2) as bigint) for k in generate_series(1, octet_length(encode(word)))]),
               lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
    from (select word from occurrences union select word from goal), steps),
source as (select bucket, count(*) as s from occurrences join vocabulary using (word) group by bucket),
target as (select bucket, count(*) as t from goal join vocabulary using (word) group by bucket),
totals as (select (select count(*) from occurrences) as all_s, (select count(*) from goal) as all_t),
gain as (
    select bucket, cast(floor(1000 * ln((coalesce(t, 0) + 1)::double * (all_s + 10000)::double
               / ((coalesce(s, 0) + 1)::double * (all_t + 10000)::double))) as bigint) as gain
    from source full join target using (bucket), totals),
weighed as (
    select row, sum(gain) as weight from occurrences join vocabulary using (word) join gain using (bucket) group by row),
scored as (
    select row, doc_id, cast(len(w) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
           cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8)
               as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
    from words left join weighed using (row)),
placed as (
    select row, row_number() over (order by score desc, doc_id nulls last) as place, count(*) over () as able
    from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when place <= 10 * able // 100 then cast(place as bigint) end as rank
from scored left join placed using (row)
"""
