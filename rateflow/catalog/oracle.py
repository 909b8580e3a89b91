"""The SQL each query must agree with, for DuckDB over the same tables."""

from rateflow.schema import AGENCY_CARDS, AGENCY_GRID, AGENCY_PAIRS


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


ORDERS = """(select 'Customer#' || o_custkey as name, o_orderpriority as rating,
  o_orderstatus as pred, cast(o_orderdate as date) as rat_date,
  case when o_orderkey % 3 = 2 then 'watch' else '-' end as observation,
  'A' || (o_orderkey % 3) as agency from orders)"""

EVENTS = """(select 'User#' || user_id as name, 'R' || (event_id % 7) as rating,
  props as pred, cast(ts as date) as rat_date, '-' as observation, event_type as agency from events)"""

PARTS = """(select p_name as name, p_brand as rating, p_type as pred,
  date '2024-01-01' + p_size as rat_date, '-' as observation,
  'A' || (p_partkey % 3) as agency from part)"""

CUSTOMER_ROWS = f"""(select c_name || ' & "Co" <' || c_nationkey || '>' as name,
  c_mktsegment as rating, case when c_custkey % 3 = 0 then '-' else 'N' || c_nationkey end as pred,
  date '2024-01-01' + cast(c_custkey % 90 as int) as rat_date,
  case when c_custkey % 3 = 2 then 'watch' else '-' end as observation,
  {_quoted(AGENCY_PAIRS)} as agency from customer)"""

SUPPLIER_ROWS = f"""(select s_name as name, 'R' || (s_suppkey % 7) as rating,
  'N' || s_nationkey as pred, date '2024-01-01' + cast(s_suppkey % 90 as int) as rat_date,
  '-' as observation, {_quoted(AGENCY_GRID)} as agency from supplier)"""

PART_ROWS = f"""(select p_name as name, p_brand as rating, 'S' || p_size as pred,
  date '2024-01-01' + cast(p_partkey % 90 as int) as rat_date, p_type as observation,
  {_quoted(AGENCY_CARDS)} as agency from part)"""

LISTED = f"""(select * from {CUSTOMER_ROWS} union all select * from {SUPPLIER_ROWS}
  union all select * from {PART_ROWS})"""


def _escaped(column):
    return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _unescaped(column):
    """The references the pages hold; a reference may lack its semicolon."""
    for name, plain in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        column = f"regexp_replace({column}, '&{name}\\b;?', '{plain}', 'g')"
    return column


# The texts are written out here a second time, so that a wrong template shows.
def _item(indent, end):
    lines = (
        ("<b>", _escaped("name"), "</b>"),
        ("<i>rating</i>:             <b>", _escaped("rating"), "</b>"),
        ("<i>prediction</i>:     ", _escaped("pred"), ""),
        ("<i>rating_date</i>:   ", "strftime(rat_date, '%Y-%m-%d')", ""),
        ("<i>observation</i>:  ", _escaped("observation"), ""),
        ("<i>agency</i>:           ", _escaped("agency"), ""),
    )
    pieces = [p for before, value, behind in lines for p in (_quoted(f"\n{indent}{before}"), value, _quoted(behind))]
    return " || ".join([*pieces, _quoted(end)])


DIGEST_ITEM = _item("    ", "\n    ")
LOOKUP_ITEM = _item("", "\n            ")


def _summary(counts):
    return f"""select rat_date as "DT", '<i>Number of agencies ratings TODAY:</i>' || chr(10) ||
      string_agg({_escaped('agency')} || ' - ' || n || ' набл.' || chr(10), '' order by agency) as text
      from {counts} group by rat_date"""


def _digest(ratings, days):
    counts = f"(select rat_date, agency, count(name) as n from {ratings} group by 1, 2)"
    known = f"(select distinct rat_date from {ratings})"
    return f"""
      select day as "DT", 'header' as kind, 'Credit ratings Updates on ' || strftime(day, '%Y-%m-%d') || ':' as text
        from {days} where day in {known}
      union all
      select day, 'none', 'No updates on ' || strftime(day, '%Y-%m-%d') from {days} where day not in {known}
      union all
      select rat_date, 'item', {DIGEST_ITEM} from {ratings}
        where rat_date in (select day from {days})
      union all
      select "DT", 'summary', text from ({_summary(counts)}) where "DT" in (select day from {days})"""


def _calendar(first, last):
    return f"""(select cast(unnest(generate_series({first}, {last}, interval 1 day)) as date) as day)"""


RANGE = _calendar("date '2023-12-25'", "date '2024-02-05'")

COLUMNS = "name, rating, pred, rat_date, observation, agency"

ANSWERS = f"""
with ratings as (select * from {PARTS}),
words as (select unnest(string_split(name, ' ')) as word from ratings),
asked as (
  select upper(word) as request from words
  union select substring(word, 1, 2) from words
  union select strftime(rat_date, '%Y-%m-%d') from ratings
  union select n_name from nation
  union select '2024-13-45' from ratings),
found as (
  select request, r.* from asked join ratings r on
    case when regexp_matches(request, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$')
      then r.rat_date = try_cast(request as date)
      else contains(lower(r.name), lower(request)) end),
placed as (
  select *, row_number() over (partition by request
    order by rat_date, agency, name, rating, pred, observation) - 1 as place from found),
parts as (
  select request, place // 20 as part, string_agg({LOOKUP_ITEM}, '' order by place) as items
  from placed group by 1, 2)
select a.request, cast(coalesce(p.part, 0) as bigint) as part,
  coalesce(case when p.part = 0 then 'Доступные рейтинги:' else '' end || p.items,
    'Нет рейтинга') as text
from asked a left join parts p on a.request = p.request"""

CHANGES = f"""
with merged as (select {COLUMNS}, count(*) as copies from {ORDERS} group by all),
known as (select *, lag(rating) over w as previous, row_number() over w as nth from merged
  window w as (partition by agency, name order by rat_date, rating, pred, observation))
select {COLUMNS}, copies, previous,
  case when nth = 1 then 'assigned' when rating is not distinct from previous then 'confirmed'
    else 'changed' end as event
from known"""

REJECTS = f"""
select {_quoted(AGENCY_PAIRS)} as source, c_custkey // 40 as page_id, 'no second table' as reason, 1 as n
  from customer where (c_custkey // 40) % 5 = 4 group by 2
union all
select {_quoted(AGENCY_PAIRS)}, c_custkey // 40, 'parts: 6', count(*)
  from customer where (c_custkey // 40) % 5 <> 4 and c_custkey % 14 = 0 group by 2"""

CLEAN = r"""regexp_replace(html, '<!--.*?-->|<script[\s>].*?</script\s*>|<style[\s>].*?</style\s*>', '', 'gis')"""

LINKS = rf"""
with hrefs as (select page_id, regexp_extract_all({CLEAN}, '<a\s[^>]*?href\s*=\s*"([^"]*)"', 1) as h from pages)
select page_id, pos::int as pos, h[pos + 1] as href, starts_with(h[pos + 1], '/t') as inside, (pos % 6)::int as cell
from (select page_id, h, unnest(range(len(h))) as pos from hrefs)"""

HEADINGS = rf"""
with heads as (select page_id, regexp_extract_all({CLEAN}, '<h1[^>]*>(.*?)</h1>', 1, 's') as h from pages)
select page_id, pos::int as pos, {_unescaped('h[pos + 1]')} as heading
from (select page_id, h, unnest(range(len(h))) as pos from heads)"""



def _broken(table, key, agency, gone, nested, named, mismatch):
    """Faults of a feed's pages, by page number; see the query."""
    rows = f"""(select {key} as key, {key} // 40 as page_id, ({key} // 40) % 7 as kind,
      cast({key} % 40 - case when {key} < 40 then 1 else 0 end as int) as place,
      date '2024-01-01' + cast({key} % 90 as int) as day from {table})"""
    page = f"select distinct page_id, kind from {rows}"
    emptied = "cards and dates differ in number" if mismatch else "no entries"
    faults = f"case kind when 1 then '{gone}' when 2 then '{emptied}' when 3 then '{nested}' end"
    out = f"""select case kind when 0 then 'other' else {_quoted(agency)} end as source, page_id,
        case kind when 0 then 'unknown source' else {faults} end as reason, cast(null as int) as place
      from ({page}) where kind in (0, 1, 2, 3)
      union all select {_quoted(agency)}, page_id, 'unreadable date: ' || strftime(day, '%d.%m.') || '20x4', place
      from {rows} where kind = 4"""
    return out + (f" union all select {_quoted(agency)}, page_id, 'missing name', place from {rows} where kind = 5" if named else "")


ALL_REJECTS = f"""select source, page_id, reason, count(*) as n, cast(sum(place) as bigint) as places
  from ({_broken('customer', 'c_custkey', AGENCY_PAIRS, 'no second table', 'nested or open span', True, False)}
  union all {_broken('supplier', 's_suppkey', AGENCY_GRID, 'no issuers table', 'nested or open cell', True, False)}
  union all {_broken('part', 'p_partkey', AGENCY_CARDS, 'no listing container', 'nested or open heading', False, True)})
  group by 1, 2, 3"""

OUTBOX_ORDER = f"""select day as "DT", case when n is null then 'none' else 'header' end as first_kind,
  case when n is null then 'none' else 'summary' end as last_kind, coalesce(n + 2, 1) as n
  from {RANGE} left join (select rat_date, count(*) as n from {EVENTS} group by 1) on day = rat_date"""

ORACLE = {
    "q_day_slice": f"select * from {ORDERS} where rat_date = date '1996-09-17'",
    "q_until": f"select * from {ORDERS} where rat_date <= date '1996-09-17'",
    "q_since": f"select * from {ORDERS} where rat_date >= date '1996-09-17'",
    "q_count_agency": "select l_returnflag as agency, count(l_partkey) as num_ratings from lineitem group by 1",
    "q_count_agency_rating": """select l_returnflag as agency, l_linestatus as rating,
      count(l_partkey) as num_ratings from lineitem group by 1, 2""",
    "q_count_date": "select cast(ts as date) as rat_date, count(event_type) as num_ratings from events group by 1",
    "q_stamp": """select l_returnflag as agency, l_linestatus as rating, count(l_partkey) as num_ratings,
      date '1996-09-17' as record_date from lineitem group by 1, 2""",
    "q_union_feeds": """select c_name as name, 'first' as agency from customer
      union all select s_name, 'second' from supplier union all select p_name, 'third' from part""",
    "q_norm_date": """select o_orderkey, strftime(o_orderdate, '%-d.%m.%Y') as shown,
      cast(o_orderdate as date) as rat_date, strftime(o_orderdate, '%Y-%m-%d') as iso from orders""",
    "q_composite": """select o_orderkey, o_orderpriority as rating,
      case when o_orderkey % 3 = 0 then '-' else o_orderstatus end as pred,
      case when o_orderkey % 3 = 2 then 'watch' else '-' end as observation,
      cast(o_orderdate as date) as rat_date from orders""",
    "q_pairs": f"select * from {CUSTOMER_ROWS}",
    "q_grid6": f"select * from {SUPPLIER_ROWS}",
    "q_cards5": f"select * from {PART_ROWS}",
    "q_shapes": f"select agency, rat_date, count(name) as num_ratings from {LISTED} group by 1, 2",
    "q_nested": f"select * from {LISTED}",
    "q_archive": f"select * from {CUSTOMER_ROWS}",
    "q_rejects": REJECTS,
    "q_rejects_all": ALL_REJECTS,
    "q_links": LINKS,
    "q_headings": HEADINGS,
    "q_escape": f"select doc_id, {_escaped('text')} as escaped, text as restored from documents",
    "q_name_search": f"select * from {PARTS} where lower(name) like '%widget%'",
    "q_name_wildcards": f"select * from {PARTS} where lower(name) like '%b%_dget%'",
    "q_name_literal": f"""select * from (select * replace (case agency when 'A0' then replace(name, ' ', '%')
      when 'A1' then replace(name, ' ', '_') else name end as name) from {PARTS})
      where contains(lower(name), '%widget') or contains(lower(name), '_widget')""",
    "q_date_lookup": f"select * from {ORDERS} where rat_date = date '1996-09-17'",
    "q_route": """select o_orderkey, text, case when regexp_matches(text, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')
      then 'date' else 'name' end as route from (
        select o_orderkey, unnest([strftime(o_orderdate, '%Y-%-m-%-d'), o_orderpriority, o_orderstatus]) as text
        from orders)""",
    "q_item_msg": f"select agency, name, rat_date, {DIGEST_ITEM} as digest, {LOOKUP_ITEM} as lookup from {ORDERS}",
    "q_digest": _digest(ORDERS, f"(select distinct rat_date as day from {ORDERS})"),
    "q_digest_empty": f"""select * from ({_digest(ORDERS, _calendar(
        "(select min(o_orderdate) from orders) - interval 7 day",
        "(select max(o_orderdate) from orders) + interval 7 day"))}) where kind = 'none'""",
    "q_summary": _summary("""(select cast(l_shipdate as date) as rat_date, l_returnflag as agency,
      count(l_partkey) as n from lineitem group by 1, 2)"""),
    "q_answers": ANSWERS,
    "q_answers_index": ANSWERS,
    "q_roundtrip": f"""select name, case when rat_date = date '2024-01-25' then 'one file'
      when rat_date between date '2024-01-10' and date '2024-01-20' then lower(rating) else rating end as rating,
      pred, rat_date, observation, agency, rat_date as "DT" from {EVENTS}
      where rat_date <> date '2024-01-15'""",
    "q_stats_store": f"""
      select 'agencies_stats' as stats, agency as first_key, '' as second_key, count(name) as num_ratings
        from {EVENTS} group by 2
      union all select 'agencies_stats_full', agency, rating, count(name) from {EVENTS} group by 2, 3
      union all select 'ratings_date_stats', strftime(rat_date, '%Y-%m-%d'), '', count(name)
        from {EVENTS} group by 2""",
    "q_day_run": _digest(
        f"(select * from {LISTED} where rat_date = date '2024-02-10')", "(select date '2024-02-10' as day)"
    ),
    "q_backfill": f"""select agency, rating, count(name) as num_ratings, rat_date as "DT"
      from {LISTED} group by agency, rating, rat_date""",
    "q_stream": f"select distinct {COLUMNS} from {LISTED}",
    "q_stream_news": f"""select rat_date as "DT", count(*) as told, count(*) as num_ratings
      from (select distinct {COLUMNS} from {LISTED}) group by 1""",
    "q_change": CHANGES,
    "q_change_standing": CHANGES,
    "q_outbox": _digest(EVENTS, RANGE),
    "q_outbox_order": OUTBOX_ORDER,
}
