"""The registered queries as SQL for another engine, where SQL can express them.

Tokens, model fits, repeated byte strings and packings are beyond it; the tests compare
these with plain Python.
"""

WORDS = r"'[^\x20\x09-\x0D]+'"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A document of fewer than four words is one shingle; it cannot equal one of four words.
NGRAM_JACCARD = f"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORDS}) as w from documents),
sh as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s
  from (select doc_id, w, unnest(generate_series(1, len(w) - 3)) as i from d where len(w) >= 4)
  union all select doc_id, array_to_string(w, ' ') from d where len(w) between 1 and 3),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
linked as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
ways as (select a, b from linked union all select b, a from linked),
reach(node, other) as (
  select doc_id, doc_id from documents
  union select r.node, l.b from reach r join ways l on l.a = r.other)
select node as doc_id, coalesce(max(n.n), 0)::bigint as n_shingles, min(other) as component_id
from reach left join n on n.doc_id = node group by node"""

MIXING = f"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, {WORDS})), 0)::bigint as size from documents),
per as (select source, sum(size)::bigint as source_size from d group by source),
weighed as (
  select *, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight,
    2.0::double * source_size as lim, 1.5::double * (sum(source_size) over ())::double as total from per),
tried as (
  select *, (total - coalesce(sum(lim) over (order by lim / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0)) /
    sum(weight) over (order by lim / weight, source nulls last rows between current row and unbounded following) as try
  from weighed),
levelled as (select *, max(case when try * weight <= lim then try end) over () as level from tried),
targets as (
  select source, source_size, case when level is null then lim else least(lim, level * weight) end as target,
    ('0x' || substr(md5('mix' || coalesce('=' || source, 'null')), 1, 5))::int / 1048576.0::double as start from levelled),
ranked as (
  select d.doc_id, d.size, t.source_size, t.target, t.start,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as step,
    row_number() over (partition by d.source order by d.size desc, d.doc_id::varchar) as rank
  from d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (size * least(floor(start + step * rank) - floor(start + step * (rank - 1)), ceil(step)))::bigint as taken from ranked"""

_RULES = [
    "n_words < 20",
    "100 * n_repeat_words > 30 * n_words",
    "100 * n_symbols > 40 * n_words",
    "n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines",
    "100 * n_upper > 35 * word_chars",
    "100 * n_marks > 50 * n_words",
    "100 * n_echo_words > 30 * n_words",
    "word_chars > 30 * n_words",
]
_BITS = " + ".join(f"case when {rule} then {1 << i} else 0 end" for i, rule in enumerate(_RULES))
QUALITY_RULES = rf"""
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {WORDS}) as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
grams as (
  select doc_id, i, count(*) over (partition by doc_id, gram) as n from (
    select doc_id, i, array_to_string(w[i:i + 7], ' ') as gram
    from (select doc_id, w, unnest(generate_series(1, len(w) - 7)) as i from d where len(w) >= 8))),
repeated as (
  select doc_id, count(distinct i + j) as n_repeat_words from grams, (select unnest(range(8)) as j) where n > 1 group by doc_id),
echoes as (
  select doc_id, count(*) as n_echo_words
  from (select doc_id, w, unnest(generate_series(2, len(w))) as i from d where len(w) >= 2) where w[i] = w[i - 1] group by doc_id),
m as (
  select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    len(regexp_extract_all(text, '\p{{Lu}}'))::bigint as n_upper, len(regexp_extract_all(text, '!'))::bigint as n_marks,
    coalesce(n_echo_words, 0)::bigint as n_echo_words
  from d left join repeated using (doc_id) left join echoes using (doc_id)),
b as (select *, ({_BITS})::bigint as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits & 3 <> 0 as base_failed, bits = 0 as kept, bits
from b"""

EXACT_TOPK = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as q from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 20"""

# Twenty bits, five hexadecimal digits, are four characters of base 32.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(sha, {5 * i + 1}, 5))::int // {32**j}) % 32 + 1, 1)"
    for i in range(8)
    for j in (3, 2, 1, 0)
)
WARC = f"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as size, sha1(coalesce(html, '')) as sha from pages),
newest as (select sha, max(page_id) as newest from p group by sha)
select page_id, size::bigint as payload_bytes, {_BASE32} as payload_digest,
  case when page_id = newest then 'response' else 'revisit' end as record_type,
  case when page_id <> newest then newest end as refers_to
from p join newest using (sha)"""

_H = ", ".join(f"('0x' || substr(sha, {8 * i + 1}, 8))::bigint as h{i + 1}" for i in range(4))
FILL_IN_MIDDLE = rf"""
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u,
    sha256('7:' || coalesce(doc_id::varchar, '')) as sha from documents),
h as (select *, len(u)::bigint as n, {_H} from d),
c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100 then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form from h),
p as (
  select *, coalesce(array_to_string(u[1:a], ''), '') as pre, coalesce(array_to_string(u[a + 1:b], ''), '') as mid,
    coalesce(array_to_string(u[b + 1:n], ''), '') as suf from c)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars,
  case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(case when form = 'plain' then text else pre || mid || suf end) as restored_sha256
from p"""

HARD_NEGATIVES = """
with v as (
  select distinct vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scored as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other_id, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select *, row_number() over (partition by anchor_id order by score desc, other_id) as positive_rank from scored where same
  qualify positive_rank <= 5),
ranked as (
  select p.anchor_id, p.other_id as positive_id, p.positive_rank, n.other_id as negative_id,
    p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as rank
  from positives p join scored n
    on n.anchor_id = p.anchor_id and not n.same and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score, positive_rank::int as positive_rank
from ranked where rank <= 5"""
