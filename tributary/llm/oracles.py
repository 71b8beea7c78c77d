"""DuckDB SQL that queries of this subpackage must agree with, where SQL can express them."""

from __future__ import annotations

OP1 = """
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select vec_id as x, vec_id as y from embeddings union select r.x, l.y from reach r join links l on r.y = l.x)
select vec_id, (select count(*) from links where x = vec_id) as n_links, (select min(y) from reach where x = vec_id) as component_id, vec_id = (select min(y) from reach where x = vec_id) as kept from embeddings
"""

#: The tree of 16 shards, level by level: where a ticket goes is reckoned from its rank and its node's bounds.
_LEVEL = """
t{next} as (select source, buckets, ticket, rank, case when high - low <= 1 or goes_left then low else mid end as low, case when goes_left then mid else high end as high,
    case when high - low <= 1 or goes_left then first else first + sent end as first, case when goes_left then sent when high - low <= 1 then held else held - sent end as held
    from (select *, rank < first + sent and high - low > 1 as goes_left from (select *, held * (mid - low) // (high - low) as sent from (select *, low + (high - low) // 2 as mid from t{level})))),"""

OP3 = (
    r"""
with d as (select row_number() over () as uid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, ('0x' || substr(md5('11:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as h from documents),
s as (select source, sum(size)::bigint as words from d group by 1),
w as (select *, [5, 2, 1][(row_number() over (order by source is null, encode(source)) - 1) % 3 + 1] as weight from s),
o as (select *, sum(words) over () - 3 * coalesce(sum(words) over below, 0) as rest_words, sum(weight) over () - coalesce(sum(weight) over below, 0) as rest_weight
    from w window below as (order by words::double / weight, source is null, source rows between unbounded preceding and 1 preceding)),
l as (select *, rest_words::double / rest_weight::double as water, rest_words::double / rest_weight::double * weight > words * 3 as capped from o),
t as (select source, words, case when capped then (words * 3)::double else max(water) filter (not capped) over () * weight end as target from l),
q as (select *, least(floor(target + 0.5)::bigint, words * 3) as quota, greatest(1, ceil(words * (select least(65536, greatest(256, count(*) // 2000)) from d)::double / greatest((select sum(words) from s), 1)::double))::bigint as buckets from t),
z as (select *, case when words > 0 then quota // words else 0 end as passes, case when words > 0 then quota % words else 0 end as rest from q),
p as (select d.*, words, target, h % buckets as bucket from d join z on d.source is not distinct from z.source),
c as (select source, bucket, sum(size)::bigint as held from p group by all),
e as (select z.*, unnest(range(z.buckets)) as bucket from z),
b as (select e.*, coalesce(c.held, 0) as held, coalesce(sum(coalesce(c.held, 0)) over (partition by e.source order by e.bucket rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from e left join c on e.source is not distinct from c.source and e.bucket = c.bucket),
n as (select source, any_value(buckets) as buckets, (any_value(passes) * any_value(buckets) + count(*) filter (before < rest))::bigint as blocks from b group by 1),
k as (select source, buckets, unnest(range(blocks)) as ticket from n),
m as (select *, ('0x' || substr(md5('11:tree:' || coalesce(source, '') || ':' || (source is null)::varchar || ':' || ticket::varchar), 1, 15))::bigint as key from k),
t0 as (select source, buckets, ticket, row_number() over (order by key, source is null, source, ticket) - 1 as rank, 0 as low, 16 as high, 0::bigint as first, count(*) over () as held from m),"""
    + "".join(_LEVEL.format(level=i, next=i + 1) for i in range(4))
    + """
leaf as (select source, buckets, low as shard, count(*) as quota from t4 group by all),
x as (select source, buckets, shard, unnest(range(first::bigint, (first + quota)::bigint)) as place from (select *, coalesce(sum(quota) over (partition by source order by shard rows between unbounded preceding and 1 preceding), 0) as first from leaf)),
g as (select source, place // buckets as pass, place % buckets as bucket, shard from x),
y as (select p.*, g.pass, g.shard, ('0x' || substr(md5('11:' || g.shard || ':' || g.pass || ':' || p.h), 1, 15))::bigint as place, case when b.before < b.rest and b.before + b.held > b.rest and g.pass = b.passes then b.rest - b.before end as room
    from p join g on p.source is not distinct from g.source and p.bucket = g.bucket join b on p.source is not distinct from b.source and p.bucket = b.bucket),
v as (select *, case when room is null then size else greatest(0, least(size, room - coalesce(sum(size) over (partition by source, bucket, pass order by place, h, doc_id, size rows between unbounded preceding and 1 preceding), 0))) end as part from y),
a as (select uid, sum(part)::bigint as taken, string_agg(shard::varchar, ',' order by pass) as shards, string_agg(place::varchar, ',' order by pass) as places from v where part > 0 or (size = 0 and room is null) group by 1)
select doc_id, size::bigint as size, words as source_size, target, coalesce(taken, 0) as taken, coalesce(shards, '') as shards, coalesce(places, '') as places from p left join a on p.uid = a.uid
"""
)

OP6 = r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n
"""

OP7 = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select doc_id, unnest(range(1, len(w) - 48)) as p, w from d where len(w) >= 50),
windows as (select doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) as k from starts),
judged as (select doc_id, p, min(doc_id) over (partition by k) < doc_id as gone from windows),
places as (select doc_id, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from d),
covered as (select places.doc_id, places.p, word, coalesce(bool_or(gone) over (partition by places.doc_id order by places.p rows between 49 preceding and current row), false) as gone
    from places left join judged on places.doc_id = judged.doc_id and places.p = judged.p),
left_over as (select doc_id, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by p) filter (not gone) as kept from covered group by 1)
select d.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join left_over on d.doc_id = left_over.doc_id
"""

ORACLES: dict[str, str] = {"op1_embedding_near_dedup": OP1, "op3_mix_sources": OP3, "op6_exact_dedup": OP6, "op7_substring_dedup": OP7}
