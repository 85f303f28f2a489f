"""DuckDB SQL next to the queries that SQL can express."""

from __future__ import annotations

from . import op2, op9


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def secrets() -> str:
    parts = [
        f"select rid, {i} as place, {_quoted(r.kind)} as kind, {r.least} as least, regexp_extract_all(t, {_quoted(r.pattern)}) as w, "
        f"regexp_extract_all(t, {_quoted(r.pattern)}, {r.group}) as g, regexp_split_to_array(t, {_quoted(r.pattern)}) as p "
        f"from t where regexp_matches(t, {_quoted(r.hint)})"
        for i, r in enumerate(op2.RULES)
    ]
    return f"""
with t as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
m as ({" union all ".join(parts)}),
e as (select rid, place, kind, least, unnest(range(len(w))) as i, unnest(w) as w, unnest(g) as g, unnest(p[1:len(w)]) as p from m),
s as (select *, sum(length(p) + length(w)) over (partition by rid, place order by i) as e from e),
k as (select rid, place, kind, (e - length(w))::bigint as b, e::bigint as e from s where length(g) >= least),
a as (
  select rid, count(*) filter (where place = 0) as n_assign, count(*) filter (where place = 1) as n_access,
    count(*) filter (where place = 2) as n_hex,
    string_agg(kind || ':' || b || ':' || e, ',' order by b, place) filter (where place < 3) as base,
    string_agg(kind || ':' || b || ':' || e, ',' order by b, place) as spans
  from k group by rid
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join a using (rid)
"""


def mixing() -> str:
    return f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    md5('{op9.SEED}:' || coalesce(doc_id::varchar, '')) as digest
  from documents
),
per as (
  select source, sum(size)::bigint as source_size,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w
  from d group by source
),
ranked as (
  select *, row_number() over (order by 2 * source_size / w, source nulls last) as k from per
),
level as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(2 * source_size) over before, 0)) / (sum(w) over () - coalesce(sum(w) over before, 0)) as lam
  from ranked window before as (order by k rows between unbounded preceding and 1 preceding)
),
first as (select min(k) as k, arg_min(lam, k) as lam from level where 2 * source_size >= w * lam),
target as (
  select source, source_size, case when level.k < first.k then (2 * source_size)::double else w * first.lam end as target
  from level, first
),
quota as (
  select *, case when source_size > 0 then floor(target + 0.5)::bigint // source_size else 0 end as passes,
    case when source_size > 0 then floor(target + 0.5)::bigint % source_size else 0 end as rest
  from target
),
run as (
  select d.*, source_size, target, passes, rest,
    sum(size) over (partition by d.source order by digest, size rows between unbounded preceding and current row) as upto
  from d join quota on d.source is not distinct from quota.source
)
select doc_id, size, source_size, target,
  (size * (passes + case when 2 * upto - size <= 2 * rest then 1 else 0 end))::bigint as taken
from run
"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit (reflected polynomial 0xEDB88320)."""
    bits = f"flatten(list_transform(range(1, length({text}) + 1), lambda k: list_transform(range(8), lambda j: (ascii({text}[k]) >> j) & 1)))"
    step = "xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {bits}), lambda c, b: {step}), 4294967295)"


def periodic_runs() -> str:
    """A run has 5 words or more that match at its lag, so equal stretches of 5 words give all diagonals."""
    return f"""
with t as (
  select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    {crc32("(doc_id::varchar)")} as h
  from documents
),
c as (select *, len(w) as n, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a, 3 + (h // 10) % 8 as m from t),
d as materialized (
  select rid, doc_id, n, case when a is null then w
    else list_transform(range(n), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % (1 + (n - a) // m) + 1] end) end as w
  from c
),
five as (select rid, n, unnest(range(n - 4)) as i, unnest(list_transform(range(n - 4), lambda i: w[i + 1:i + 5])) as g from d where n >= 6),
same as (
  select x.rid, x.i - y.i as q, x.i, x.i - row_number() over (partition by x.rid, x.i - y.i order by x.i) as island
  from five x join five y on x.rid = y.rid and x.g = y.g and x.i > y.i and 4 * (x.i - y.i) <= x.n
),
stretch as (select rid, q, min(i) - q as start, count(*) + 4 + q as length from same group by rid, q, island),
run as (select rid, start, length, min(q) as period from stretch where length >= greatest(6, 4 * q) group by rid, start, length),
per as (
  select rid, count(*) as n_runs, min(struct_pack(l := -length, s := start, p := period)) as best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as runs
  from run group by rid
),
gone as (select distinct rid, unnest(range(start + period, start + length)) as i from run),
kept as (
  select d.rid, string_agg(x.word, ' ' order by x.i) as collapsed
  from (select rid, unnest(w) as word, unnest(range(n)) as i from d) x join d using (rid) left join gone g on g.rid = x.rid and g.i = x.i
  where g.i is null group by d.rid
)
select d.doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, -best.l as length, best.p as period,
  (-1000 * best.l) // best.p as exponent_milli, sha256(coalesce(runs, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from d left join per using (rid) left join kept using (rid)
"""


def archive() -> str:
    return """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
),
f as (select payload_digest, min(page_id) as first from p where payload_bytes >= 100 group by payload_digest),
r as (select p.*, case when page_id is distinct from first then first end as refers_to from p left join f using (payload_digest))
select page_id, payload_bytes, payload_digest, case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to from r
"""


def hard_negatives() -> str:
    return """
with e as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as materialized (
  select a.id as anchor, b.id as other, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from e a join e b on a.id % 100 = 0 and a.id <> b.id
),
pos as (
  select anchor, other, score from s where same qualify row_number() over (partition by anchor order by score desc, other) <= 5
),
neg as (
  select p.anchor as anchor_id, p.other as positive_id, n.other as negative_id, p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor, p.other order by n.score desc, n.other)::int as rank
  from pos p join s n on n.anchor = p.anchor and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from neg where rank <= 5
"""
