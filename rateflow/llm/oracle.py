"""SQL of the operators that SQL can express."""


def _canonical(n_chars="n_chars"):
    values = ("doc_id", "source", "lang", n_chars, "text")
    return " || ".join(f"coalesce(strlen(cast({v} as varchar)) || ':' || cast({v} as varchar), '-')" for v in values)


# CRC-32 of the decimal doc_id, bit by bit.
_BIT = "case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end"
_BYTE = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda a, k: {_BIT})"
_CODES = "list_transform(range(1, strlen(cast(doc_id as varchar)) + 1), lambda i: cast(ascii(substr(cast(doc_id as varchar), i, 1)) as bigint))"
_CRC = f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {_CODES}), lambda c, b: {_BYTE}), 4294967295)"

_UP = """list_transform(range((len(nodes) + 1) // 2),
  lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"""

MERKLE = f"""
with recursive leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place, row_number() over () as id
  from (select doc_id, lang, sha256({_canonical()}) as leaf,
    case when {_CRC} % 7 = 0 then sha256({_canonical('(n_chars + 1)')}) else sha256({_canonical()}) end as start
    from documents)),
tree as (
  select lang, 0 as level, list(leaf order by place) as nodes from leaves group by lang
  union all select lang, level + 1, {_UP} from tree where len(nodes) > 1),
subroots as (
  select lang, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as place from tree where len(nodes) = 1),
top as (
  select 0 as level, list(subroot order by place) as nodes from subroots
  union all select level + 1, {_UP} from top where len(nodes) > 1),
node as (select lang, level, unnest(range(len(nodes))) as idx, unnest(nodes) as digest from tree),
top_node as (select level, unnest(range(len(nodes))) as idx, unnest(nodes) as digest from top),
root as (select nodes[1] as root from top where len(nodes) = 1),
steps as (
  select l.id, t.level, xor(l.place >> t.level, 1) as other, n.digest
  from leaves l join tree t on t.lang is not distinct from l.lang and len(t.nodes) > 1
  left join node n on n.lang is not distinct from l.lang and n.level = t.level and n.idx = xor(l.place >> t.level, 1)
  union all
  select l.id, 1000 + t.level, xor(s.place >> t.level, 1), n.digest
  from leaves l join subroots s on s.lang is not distinct from l.lang join top t on len(t.nodes) > 1
  left join top_node n on n.level = t.level and n.idx = xor(s.place >> t.level, 1)),
proofs as (
  select id, sha256(coalesce(string_agg(digest, '' order by level), '')) as proof_sha256,
    list(case when digest is null then '-' when other % 2 = 1 then 'R' || digest else 'L' || digest end order by level) as sides
  from steps group by id),
folded as (
  select l.*, subroot, coalesce(proof_sha256, sha256('')) as proof_sha256,
    list_reduce(list_prepend(l.start, coalesce(sides, [])), lambda a, x: case x[1:1] when '-' then sha256(a)
      when 'R' then sha256(a || x[2:]) else sha256(x[2:] || a) end) as folded_root
  from leaves l join subroots s on s.lang is not distinct from l.lang left join proofs p on p.id = l.id)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from folded, root
"""

REPEATED_BYTES = """
with texts as (
  select row_number() over () as id, doc_id, coalesce(encode(text), ''::blob) as b, octet_length(coalesce(encode(text), ''::blob)) as n
  from documents),
places as (select id, b, unnest(range(n - 199)) as i from texts where n >= 200),
windows as (select id, i, md5(b[i + 1 : i + 200]) as window_md5 from places),
repeated as (
  select id, i from (select id, i, count(*) over (partition by window_md5) as times from windows) where times > 1),
opened as (
  select id, i, case when i <= lag(i) over (partition by id order by i) + 200 then 0 else 1 end as opens from repeated),
islands as (select id, i, sum(opens) over (partition by id order by i) as island from opened),
spans as (select id, island, min(i) as first, max(i) + 200 as stop from islands group by id, island),
gaps as (select id, first, stop, coalesce(lag(stop) over (partition by id order by first), 0) as before from spans),
cut as (
  select g.id, sum(stop - first) as n_removed, count(*) as n_spans, max(stop) as last,
    string_agg(hex(b[before + 1 : first]), '' order by first) as kept
  from gaps g join texts t on t.id = g.id group by g.id)
select t.doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(case when c.id is null then b else unhex(kept || hex(b[last + 1 : n])) end) as kept_sha256
from texts t left join cut c on c.id = t.id
"""

REPEATED_PASSAGES = r"""
with texts as (
  select row_number() over () as id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
places as (select id, words, unnest(range(len(words) - 34)) as i from texts where len(words) >= 35),
windows as (select id, i, md5(array_to_string(words[i + 1 : i + 35], ' ')) as window_md5 from places),
repeated as (
  select id, i from (select id, i, count(*) over (partition by window_md5) as times from windows) where times > 1),
opened as (
  select id, i, case when i <= lag(i) over (partition by id order by i) + 35 then 0 else 1 end as opens from repeated),
islands as (select id, i, sum(opens) over (partition by id order by i) as island from opened),
spans as (select id, island, min(i) as first, max(i) + 35 as stop from islands group by id, island),
gaps as (select id, first, stop, coalesce(lag(stop) over (partition by id order by first), 0) as before from spans),
cut as (
  select g.id, sum(stop - first) as n_removed, max(stop) as last, flatten(list(words[before + 1 : first] order by first)) as kept
  from gaps g join texts t on t.id = g.id group by g.id)
select t.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(array_to_string(case when c.id is null then words else list_concat(kept, words[last + 1 :]) end, ' ')) as kept_sha256
from texts t left join cut c on c.id = t.id
"""

NEAR_TEXTS = r"""
with recursive texts as (
  select row_number() over () as id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
sets as (
  select id, doc_id, list_distinct(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(range(len(words) - 4), lambda i: array_to_string(words[i + 1 : i + 5], ' ')) end) as shingles
  from texts),
groups as (
  select md5(array_to_string(list_sort(shingles), chr(10))) as key, any_value(shingles) as shingles, len(any_value(shingles)) as n,
    min(doc_id) as least from sets where len(shingles) > 0 group by 1),
pieces as (select key, n, unnest(shingles) as shingle from groups),
pairs as (
  select x.key as a, y.key as b from pieces x join pieces y on x.shingle = y.shingle and x.key < y.key
  group by x.key, y.key, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
edges as (select a, b from pairs union all select b, a from pairs),
reached as (select key as a, key as b from groups union select r.a, e.b from reached r join edges e on e.a = r.b),
smallest as (select a as key, min(least) as component_id from reached join groups g on g.key = b group by a)
select doc_id, cast(len(s.shingles) as bigint) as n_shingles, coalesce(c.component_id, doc_id) as component_id
from sets s left join smallest c on c.key = md5(array_to_string(list_sort(s.shingles), chr(10))) and len(s.shingles) > 0
"""

NEAR_VECTORS = """
with recursive vectors as (
  select row_number() over () as id, vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings),
usable as (
  select id, vec_id, len(e) as size, e, sqrt(list_dot_product(e, e)) as norm from vectors
  where e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0),
edges as (
  select x.id as a, y.id as b from usable x join usable y on x.id <> y.id and x.size = y.size
  where list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.95),
links as (select a as id, count(*) as n_links from edges group by a),
reached as (select id as a, id as b from vectors union select r.a, e.b from reached r join edges e on e.a = r.b),
smallest as (select a as id, min(vec_id) as component_id from reached join vectors v on v.id = b group by a)
select vec_id, coalesce(n_links, 0) as n_links, component_id, coalesce(vec_id = component_id, true) as kept
from vectors v join smallest s on s.id = v.id left join links l on l.id = v.id
"""

ORACLE = {
    "op5_embedding_near_dedup": NEAR_VECTORS,
    "op9_ngram_jaccard_join": NEAR_TEXTS,
    "op10_substring_dedup": REPEATED_PASSAGES,
    "op12_merkle_manifest": MERKLE,
    "op13_suffix_array_dedup": REPEATED_BYTES,
}
