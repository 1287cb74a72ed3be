"""SQL (DuckDB) for those operators that SQL can express."""

from __future__ import annotations

_USABLE = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

OP1 = f"""
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as q from embeddings where vec_id is not null and {_USABLE}),
s as (select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""

_COMPONENTS = """
reach(id, low) as (select id, id from node union select l.a, r.low from reach r join link l on l.b = r.id where r.low < l.a),
comp as (select id, min(low) as component_id from reach group by id)
"""

OP5 = f"""
with recursive v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings where {_USABLE} and len(list_filter(embedding, lambda x: x <> 0)) > 0),
node as (select vec_id as id from embeddings),
link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.95),
{_COMPONENTS},
n as (select a, count(*) as n from link group by a)
select c.id as vec_id, coalesce(n.n, 0)::bigint as n_links, c.component_id, c.id = c.component_id as kept from comp c left join n on n.a = c.id
"""

_WORDS = r"(select doc_id, list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> '') as w from documents)"

OP6 = f"""
with recursive words as {_WORDS},
sh as (select distinct doc_id, array_to_string(w[k:k + 4], ' ') as s from (select doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) as k from words where len(w) > 0)),
size as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by all),
link as (select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b where c >= 0.8 * (x.n + y.n - c) - 1e-9),
node as (select doc_id as id from documents),
{_COMPONENTS},
n as (select a, count(*) as n from link group by a),
same as (select doc_id, min(doc_id) over (partition by shingles) as class_id from (select doc_id, list(s order by s) as shingles from sh group by doc_id))
select c.id as doc_id, coalesce(same.class_id, c.id) as class_id, coalesce(n.n, 0)::bigint as n_links, c.component_id, c.id = c.component_id as kept from comp c left join n on n.a = c.id left join same on same.doc_id = c.id
"""

OP2 = f"""
with words as {_WORDS},
runs as (select doc_id, k, md5(array_to_string(w[k + 1:k + 50], ' ')) as h from (select doc_id, w, unnest(range(0, len(w) - 49)) as k from words where len(w) >= 50)),
again as (select doc_id, k from (select doc_id, k, row_number() over (partition by h order by doc_id, k) as nth from runs) where nth > 1),
cut as (select doc_id, k, case when k - lag(k) over (partition by doc_id order by k) <= 50 then 0 else 1 end as opens from again),
island as (select doc_id, k, sum(opens) over (partition by doc_id order by k) as i from cut)
select doc_id, min(k)::integer as span_start, (max(k) - min(k) + 50)::integer as span_words from island group by doc_id, i
"""


def _draw(level: int, child: str, weight: str) -> str:
    """The weighted draw of a child, as `sharding.draw`."""
    return f"-ln((('0x' || substr(md5(concat_ws(':', coalesce(doc_id::varchar, ''), {level}, {child}, 0)), 1, 13))::bigint + 0.5) / 4503599627370496) / {weight}"


def _tree(shards: int) -> str:
    """doc_id to region, rack and shard of a tree of so many equal shards, four to a rack and two racks to a region."""
    regions = ", ".join(f"({r}, {min(8, shards - 8 * r)})" for r in range(-(-shards // 8)))
    racks = ", ".join(f"({r}, {min(4, shards - 4 * r)})" for r in range(-(-shards // 4)))
    return f"""
a as (select doc_id, arg_min(c, {_draw(0, "c", "w")}) as region from keys, (values {regions}) t(c, w) group by doc_id),
b as (select doc_id, any_value(region) as region, arg_min(c, {_draw(1, "c", "w")}) as rack from a join (values {racks}) t(c, w) on c // 2 = region group by doc_id),
tree as (select doc_id, any_value(region) as region, any_value(rack) as rack, arg_min(c, {_draw(2, "c", "1.0")}) as shard from b join (select unnest(range({shards}))::integer as c) on c // 4 = rack group by doc_id)
"""


#: CRC-32 byte by byte, the table made of its polynomial.
_CRC = """
poly(i, c, k) as (select i, i, 0 from range(256) t(i) union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from poly where k < 8),
crc as (select list(c order by i) as t from poly where k = 8),
sums as (select s, strlen(s) + 1 as size, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(s)), '..'), lambda x: ('0x' || x)::bigint)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32 from (select distinct coalesce(text, '') as s from documents), crc)
"""

OP10 = f"""
with recursive {_CRC},
keys as (select distinct doc_id from documents),
now as (with {_tree(16)} select * from tree), grown as (with {_tree(17)} select doc_id, shard as grown_shard from tree),
rows as (select d.doc_id, size::bigint as size, text_crc32::bigint as text_crc32, region, rack, shard, grown_shard, ('0x' || substr(md5(concat_ws(':', coalesce(d.doc_id::varchar, ''), text_crc32, 1)), 1, 13))::bigint as place
  from documents d join sums on s = coalesce(text, '') join now on now.doc_id is not distinct from d.doc_id join grown on grown.doc_id is not distinct from d.doc_id)
select doc_id, size, text_crc32, 'key' as law, shard, row_number() over (partition by shard order by place, doc_id nulls first, text_crc32, size) - 1 as slot, grown_shard, region, rack from rows
"""

#: On pages whose main text is the blocks of one <article> of headings and paragraphs, as all of the driver's are; the
#: operator's choice of a container is tested on other pages.
OP9 = r"""
with a as (select page_id, url, string_split_regex(replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '<br>', ' '), '</?(?:p|h[1-6]|ul|li)>') as parts from pages),
b as (select page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) as text from a)
select page_id, url, text, length(text)::bigint as n_chars from b
"""
