"""DuckDB statements that compute the same results as ``tables.QUERIES`` on
the same parquet tables (registered as views under their table names)."""

from __future__ import annotations

_BLANK = r"[ \t\n\r\f]"

_POSTINGS = rf"""
with runs as (
  select doc_id,
         unnest(regexp_extract_all(text, '[^ \t\n\r\f]+|{_BLANK}+')) as run,
         generate_subscripts(regexp_extract_all(text, '[^ \t\n\r\f]+|{_BLANK}+'), 1) as i
  from documents
), offs as (
  select doc_id, run,
         sum(strlen(run)) over (partition by doc_id order by i
                                rows between unbounded preceding and current row)
           - strlen(run) as off
  from runs
)
select run as word, doc_id, off::bigint as off
from offs
where not regexp_full_match(run, '{_BLANK}+')
"""


def _page_rank(rounds: int = 3, damping: float = 0.85) -> str:
    d = repr(damping)
    ctes = [
        """li as (select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem)""",
        """e as (select src, dst from (
              select l_partkey as src,
                     lead(l_partkey) over (partition by l_orderkey
                                           order by l_linenumber, l_partkey, l_suppkey) as dst
              from li) t where dst is not null)""",
        """nodes as (select distinct l_partkey as id from li)""",
        """n as (select count(*)::double as n from nodes)""",
        """deg as (select src, count(*)::double as deg from e group by src)""",
        """r0 as (select id, 1.0::double / (select n from n) as rank from nodes)""",
    ]
    for r in range(1, rounds + 1):
        ctes.append(
            f"""r{r} as (
              select nodes.id,
                     (1.0::double - {d}::double) / (select n from n)
                       + {d}::double * coalesce(c.s, 0.0::double) as rank
              from nodes left join (
                select e.dst, sum(p.rank / deg.deg) as s
                from e join deg on deg.src = e.src join r{r - 1} p on p.id = e.src
                group by e.dst) c on c.dst = nodes.id)"""
        )
    return (
        "with "
        + ",\n".join(ctes)
        + f"\nselect id, printf('%.8e', rank)::double as rank from r{rounds}"
    )


ORACLE_SQL = {
    "word_count": rf"""
select word, count(*)::bigint as n
from (select unnest(string_split_regex(text, '{_BLANK}+')) as word from documents) t
where word <> ''
group by word
""",
    "inverted_index_postings": _POSTINGS,
    "inverted_index": f"""
with postings as ({_POSTINGS})
select word, doc_id,
       string_agg(doc_id::varchar || ':' || off::varchar, ' ' order by off) as postings
from postings
group by word, doc_id
""",
    "top_k": """
select c_custkey as emp_id, c_mktsegment as dept_id, c_acctbal as salary, c_name as emp_info
from customer
order by c_acctbal desc, c_custkey
limit 10
""",
    "equi_join": """
select o.o_custkey as join_key, o.o_orderkey as id, o.o_totalprice as price,
       c.c_name as description
from orders o join customer c on o.o_custkey = c.c_custkey
""",
    "matrix_multiply": """
with e as (
  select vec_id, generate_subscripts(embedding, 1) - 1 as d, unnest(embedding) as x
  from embeddings
), ev as (
  select vec_id, d::bigint as d, round(x::double * 1000.0)::bigint as v from e
)
select a.d as i, b.d as j, sum(a.v * b.v)::bigint as v
from ev a join ev b on a.vec_id = b.vec_id
group by a.d, b.d
""",
    "page_rank": _page_rank(),
    "list_item_count": """
select item, count(*)::bigint as n
from (select unnest(string_split(p_name, ' ')) as item from part) t
where item <> ''
group by item
""",
    "weekday_totals": """
select l_suppkey as base,
       ['MON','TUE','WED','THR','FRI','SAT','SUN'][isodow(l_shipdate)] as day,
       sum(l_quantity::bigint)::bigint as trips,
       sum(l_linenumber)::bigint as vehicles
from lineitem
group by 1, 2
""",
    "group_avg_top_k": """
select p_type as category, avg(l_quantity) as avg_rating
from lineitem join part on l_partkey = p_partkey
group by p_type
order by avg_rating desc, category
limit 3
""",
    "filtered_join_avg_top_k": """
select p_partkey as id, p_name as title, avg(l_quantity) as avg_rating
from part join lineitem on p_partkey = l_partkey
where list_contains(string_split(p_name, ' '), 'ring')
group by p_partkey, p_name
having sum(l_quantity) <> 0
order by avg_rating desc, id
limit 10
""",
}

ORACLE_SQL["product_by_key"] = """
select l_orderkey, product(l_linenumber) as product
from lineitem
group by l_orderkey
"""
ORACLE_SQL["top_k_distinct"] = """
select nation, segment
from (select distinct c_nationkey as nation, c_mktsegment as segment from customer) t
order by nation desc, segment
limit 10
"""

ORACLE_SQL["top_k_large"] = """
select l_quantity, l_partkey, l_orderkey, l_linenumber
from lineitem
order by l_quantity desc, l_partkey, l_orderkey, l_linenumber
limit 20000
"""
ORACLE_SQL["matrix_multiply_tiles"] = ORACLE_SQL["matrix_multiply"]
ORACLE_SQL["filtered_join_unique"] = ORACLE_SQL["filtered_join_avg_top_k"]

ORACLE_SQL["filtered_join_zero_sums"] = """
select p_partkey as id, p_name as title, avg(-l_quantity) as avg_rating
from part join lineitem on p_partkey = l_partkey
where list_contains(string_split(p_name, ' '), 'ring') and p_partkey % 3 <> 0
group by p_partkey, p_name
order by avg_rating desc, id
limit 10
"""

_MOVIE_FILTER = "list_contains(string_split(p_name, ' '), 'ring')"

TEXT_ORACLE_SQL = {
    "top_k_text": """
select c_custkey as emp_id, c_mktsegment as dept_id,
       round(c_acctbal * 100.0)::bigint as salary, c_name as emp_info
from customer
order by salary desc, emp_id
limit 10
""",
    "equi_join_text": """
select o.o_custkey::varchar as join_key, o.o_orderkey::varchar as id,
       round(o.o_totalprice * 100.0)::bigint::varchar as price, c.c_name as description
from orders o join customer c on o.o_custkey = c.c_custkey
""",
    "matrix_multiply_text": ORACLE_SQL["matrix_multiply"],
    "page_rank_text": ORACLE_SQL["page_rank"],
    "list_item_count_text": ORACLE_SQL["list_item_count"],
    "weekday_totals_text": """
select l_suppkey::varchar as base,
       ['MON','TUE','WED','THR','FRI','SAT','SUN'][isodow(l_shipdate)] as day,
       sum(l_quantity::bigint)::bigint as trips,
       sum(l_linenumber)::bigint as vehicles
from lineitem
group by 1, 2
""",
    "group_avg_top_k_text": """
select 's' || l_suppkey::varchar as category, avg(l_quantity::bigint::double) as avg_rating
from lineitem
group by 1
order by avg_rating desc, category
limit 3
""",
    "filtered_join_avg_top_k_text": f"""
select p_partkey::varchar as id, p_name as title, avg(l_quantity::bigint::double) as avg_rating
from part join lineitem on p_partkey = l_partkey
where {_MOVIE_FILTER}
group by p_partkey, p_name
having sum(l_quantity::bigint) <> 0
order by avg_rating desc, id
limit 10
""",
}

# document files: 250 ids each, documents in the order of their ids
_FILE_POSTINGS = rf"""
with texts as (
  select doc_id, (doc_id // 250)::varchar as file, coalesce(text, '') as text from documents
), docs as (
  select doc_id, file, text,
         coalesce(sum(strlen(text) + 1) over (partition by file order by doc_id
                  rows between unbounded preceding and 1 preceding), 0) as base
  from texts
), runs as (
  select doc_id, file, base,
         unnest(regexp_extract_all(text, '[^ \t\n\r\f]+|{_BLANK}+')) as run,
         generate_subscripts(regexp_extract_all(text, '[^ \t\n\r\f]+|{_BLANK}+'), 1) as i
  from docs
), offs as (
  select file, run as word,
         (base + sum(strlen(run)) over (partition by doc_id order by i
                 rows between unbounded preceding and current row) - strlen(run))::bigint as off
  from runs
)
select file, word, off from offs where not regexp_full_match(word, '{_BLANK}+')
"""

FILE_ORACLE_SQL = {
    "inverted_index_files": f"""
with postings as ({_FILE_POSTINGS})
select word, file, (off - off % 262144)::bigint as posting_block,
       string_agg(file || ':' || off::varchar, ' ' order by off) as postings
from postings
group by word, file, posting_block
""",
    "word_count_files": rf"""
with texts as (
  select text from documents union all select text from benchmark union all select text from conversations
)
select word, count(*)::bigint as n
from (select unnest(string_split_regex(text, '{_BLANK}+')) as word from texts) t
where word <> ''
group by word
""",
    "equi_join_files": TEXT_ORACLE_SQL["equi_join_text"],
    "word_count_sorted_file": f"""
with counts as ({ORACLE_SQL["word_count"]})
select row_number() over (order by word) as pos, word || chr(9) || n::varchar as value from counts
""",
    "weekday_totals_file": """
select l_suppkey::varchar || ',' || ['MON','TUE','WED','THU','FRI','SAT','SUN'][isodow(l_shipdate)] || ' '
       || sum(l_quantity::bigint)::bigint::varchar || ',' || sum(l_linenumber)::bigint::varchar as value
from lineitem
group by l_suppkey, isodow(l_shipdate)
""",
    "list_item_count_file": f"""
with counts as ({ORACLE_SQL["list_item_count"]})
select row_number() over (order by item) as pos, '(' || item || ',' || n::varchar || ')' as value from counts
""",
    "top_k_file": f"""
with best as ({TEXT_ORACLE_SQL["top_k_text"]})
select row_number() over (order by salary, emp_id desc) as pos,
       emp_id::varchar || '|' || dept_id || '|' || salary::varchar || '|' || emp_info as value
from best
""",
    "weekday_totals_malformed": """
with marked as (
  select *, l_orderkey % 11 = 0 or l_orderkey % 13 = 0 or l_orderkey % 17 = 0
            or l_orderkey % 19 = 0 or l_orderkey % 23 = 0 as spoiled
  from lineitem
), counts as (select count(*)::bigint as n_lines, count(*) filter (spoiled)::bigint as n_dropped from marked)
select l_suppkey::varchar as base,
       ['MON','TUE','WED','THR','FRI','SAT','SUN'][isodow(l_shipdate)] as day,
       sum(l_quantity::bigint)::bigint as trips,
       sum(l_linenumber)::bigint as vehicles,
       n_lines, n_dropped
from marked, counts
where not spoiled
group by 1, 2, n_lines, n_dropped
""",
}
