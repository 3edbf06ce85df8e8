"""Oracle SQL (DuckDB) of plans.figures."""

_PERIODS = [f"{y}_Q{q}" for y in range(1995, 2002) for q in range(1, 5)]

_ORDER_VALUES = """
  select o_orderkey as order_key, 'total' as field, o_totalprice::decimal(18,2) as value from orders
  union all
  select l_orderkey, 'line', round(l_extendedprice::decimal(12,2) * (1 - l_discount::decimal(4,2)) * (1 + l_tax::decimal(4,2)), 2)::decimal(18,2) from lineitem
"""

_LINE_CHECKS = """
  select l_orderkey, l_linenumber, l_partkey, l_returnflag, neto + abs(rebaja) as expected, bruto - cantidad * 2 as actual
  from (select *, round(l_quantity)::bigint as cantidad, round(l_extendedprice)::bigint as bruto,
               round(l_extendedprice * (1 - l_discount))::bigint as neto, round(l_extendedprice * l_discount)::bigint as rebaja from lineitem)
"""

_LOCALE = """
  select *, case when comma then replace(replace(kept, '.', ''), ',', '.') when whole then replace(kept, '.', '') else kept end as plain
  from (
    select *, contains(kept, ',') as comma,
           not contains(kept, ',') and (dots = 0 or dots > 1 or regexp_full_match(kept, '[^.]*\\.[0-9]{{3}}')) as whole
    from (select *, length(kept) - length(replace(kept, '.', '')) as dots
          from (select *, regexp_replace(regexp_replace(t, '^-', ''), '[^0-9.,]', '', 'g') as kept from ({0})))
  )
"""

_LINES = "select raw_id, replace(replace(replace(payload, ';', ' '), '|', ' '), chr(9), ' ') as line from raw_line"
_NORMAL = "regexp_replace(regexp_replace(regexp_replace(line, '\\(\\s*([0-9.,]+)\\s*\\)', '-\\1', 'g'), '([0-9])\\s+,([0-9])', '\\1,\\2', 'g'), '(\\s)([0-9])\\s+([0-9])', '\\1\\2\\3', 'g')"

_BY_QUARTER = "select o_orderstatus as status, year(o_orderdate) || '_Q' || quarter(o_orderdate) as period, round(sum(o_totalprice), 2) as value from orders group by 1, 2"
_ROMAN = "['I', 'II', 'III', 'IV']"

SQL = {
    "reconcile_order_totals": f"""
      select order_key, 'lines_make_total' as rule, coalesce(sum(value) filter (field = 'line'), 0)::double as expected, (max(value) filter (field = 'total'))::double as actual,
             coalesce(abs(abs(coalesce(sum(value) filter (field = 'line'), 0)) - abs(max(value) filter (field = 'total'))), 0)::double as difference,
             coalesce(abs(abs(coalesce(sum(value) filter (field = 'line'), 0)) - abs(max(value) filter (field = 'total'))) <= 1, true) as match
      from ({_ORDER_VALUES}) group by order_key""",
    "reconcile_sources": f"""
      with v as ({_ORDER_VALUES}), o as (select order_key, value as a from v where field = 'total'), l as (select order_key, sum(value) as b from v where field = 'line' group by 1)
      select coalesce(o.order_key, l.order_key) as order_key, case when a is not null and b is not null then 'both' when b is null then 'order_only' else 'lines_only' end as source,
             coalesce(abs(abs(a) - abs(b)) <= 1000, true) as match, a::double as value_a, b::double as value_b, coalesce(abs(abs(a) - abs(b)), 0)::double as difference, coalesce(a, b)::double as value
      from o full join l on o.order_key = l.order_key where a is not null or b is not null""",
    "formula_check": f"select l_orderkey, l_linenumber, l_partkey, expected, actual, abs(expected - actual) as difference, coalesce(abs(expected - actual) <= 60, true) as match from ({_LINE_CHECKS})",
    "validation_summary": f"select l_returnflag as category, count(*) as n, count(*) filter (abs(expected - actual) <= 60) as passed, bool_or(abs(expected - actual) > 60) as has_failures from ({_LINE_CHECKS}) group by 1",
    "parse_thousands": """
      select prov_id, case when contains(raw_value, '(') and contains(raw_value, ')') then -abs(v) else v end as value
      from (select *, try_cast(case when regexp_full_match(k, '-?[0-9]+') then k end as bigint) as v from (select *, replace(regexp_replace(raw_value, '[^0-9.\\-]', '', 'g'), '.', '') as k from provenance))""",
    "parse_locale_decimal": f"""
      select prov_id, case when t like '-%' then -n else n end as v, case when n is not null then whole end as is_int
      from (select *, try_cast(case when regexp_full_match(plain, '[0-9]*\\.?[0-9]*') and regexp_matches(plain, '[0-9]') then plain end as double) as n from ({_LOCALE.format("select prov_id, trim(raw_value) as t from provenance")}))""",
    "parse_mixed_number": """
      select value_id, case when w then -n else n end as value from (
        select *, try_cast(case when regexp_full_match(plain, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then plain end as double) as n from (
          select *, case when dots > 1 or (dots = 1 and commas = 1 and strpos(k, '.') < strpos(k, ',')) then replace(replace(k, '.', ''), ',', '.')
                         when commas > 1 or (commas = 1 and dots = 1) then replace(k, ',', '') else replace(k, ',', '.') end as plain
          from (select *, length(k) - length(replace(k, '.', '')) as dots, length(k) - length(replace(k, ',', '')) as commas
                from (select *, regexp_replace(case when w then substr(t, 2, length(t) - 2) else t end, '[$€£¥CLP\\s]', '', 'g') as k
                      from (select value_id, trim(value_text) as t, trim(value_text) like '(%)' as w from kpi_value)))))""",
    "normalize_line": f"select raw_id, {_NORMAL} as line from ({_LINES})",
    "number_tokens": """
      select doc_id, len(t) as n, md5(array_to_string(t, ' ')) as tokens_md5
      from (select doc_id, case when text is not null then list_filter(regexp_extract_all(text, '-?[0-9.,]+'), lambda x: regexp_matches(x, '[0-9]')) end as t from documents)""",
    "current_value": f"""
      with tok as (
        select raw_id, line, list_filter(regexp_extract_all({_NORMAL}, '-?[0-9.,]+'), lambda x: regexp_matches(x, '[0-9]')) as ts from ({_LINES})
      ), parts as (
        select raw_id, u.t, u.i from (select raw_id, unnest(list_transform(ts, lambda x, i: {{'t': x, 'i': i}})) as u from tok)
      ), num as (
        select raw_id, i, whole, case when t like '-%' then -n else n end as v from (
          select *, try_cast(case when regexp_full_match(plain, '[0-9]*\\.?[0-9]*') and regexp_matches(plain, '[0-9]') then plain end as double) as n from ({_LOCALE.format("select raw_id, i, t from parts")})) where n is not null
      ), firsts as (
        select raw_id, min(i) as i0 from num where not (whole and v > 0 and v < 100) group by 1
      ), kept as (
        select num.raw_id, list(v order by i) as vs from num join firsts on num.raw_id = firsts.raw_id and i >= i0 group by 1
      )
      select tok.raw_id, vs[1] as value, coalesce(vs[2], vs[1]) as second, regexp_matches(line, '\\s[0-9]\\s+[0-9]') as ambiguous from tok left join kept on tok.raw_id = kept.raw_id""",
    "normalize_text": "select value_id, trim(regexp_replace(regexp_replace(lower(strip_accents(label)), '[.,;:()\\[\\]]', ' ', 'g'), '\\s+', ' ', 'g')) as label from kpi_value",
    "clean_whitespace": "select item_id, trim(regexp_replace(concepto, '[\\s\\x{00A0}]+', ' ', 'g')) as concepto from line_item",
    "snake_case_names": """
      select sheet, field, regexp_replace(regexp_replace(lower(strip_accents(trim(label))), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as snake,
             substr(array_to_string(list_transform(string_split(field, '_'), lambda w: upper(w[1]) || w[2:]), ' '), 1, 31) as title from field_rule""",
    "content_hash": "select doc_id, sha256(text) as sha from documents",
    "scale_floor_trunc": "select c_custkey, floor(c_acctbal / 1000)::bigint as floored, trunc(c_acctbal / 1000)::bigint as truncated from customer",
    "period_key": f"""
      select o_orderkey, y || '_Q' || {_ROMAN}[q] as quarter_key, {_ROMAN}[q] || 'Q' || y as quarter_label, y || '_M' || lpad(m::varchar, 2, '0') as month_key, 'FY' || y as year_label,
             'estados_' || y || '_' || {_ROMAN}[q] || '.pdf' as file
      from (select o_orderkey, year(o_orderdate) as y, quarter(o_orderdate) as q, month(o_orderdate) as m from orders)""",
    "period_parse": """
      select prov_id, case when ok then substr(period, 1, 4)::int end as year, case when ok then q end as quarter,
             case when ok then substr(period, 1, 4)::int else 9999 end as sort_year, case when ok then q else 9 end as sort_period
      from (select *, coalesce(regexp_full_match(period, '[0-9]{4}_Q(IV|I{1,3}|[1-4])'), false) as ok,
                   case substr(period, 7) when 'I' then 1 when '1' then 1 when 'II' then 2 when '2' then 2 when 'III' then 3 when '3' then 3 else 4 end as q from provenance)""",
    "provenance_primary": """
      select segment_id, period, field, prov_id, source_type from provenance
      qualify row_number() over (partition by segment_id, period, field order by coalesce(confidence, -1) desc, coalesce(source_type, '') <> 'xml', ord nulls first, prov_id) = 1""",
    "fallback_chain": """
      select user_id, event_type, value from events where event_type in ('purchase', 'click', 'view') and value is not null
      qualify row_number() over (partition by user_id order by case event_type when 'purchase' then 1 when 'click' then 2 else 3 end, event_id) = 1""",
    "top_orders": "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100",
    "reference_check": """
      with s as (select l_partkey, round(sum(l_extendedprice) / sum(l_quantity), 4) as v from lineitem group by 1)
      select p_partkey, p_retailprice as expected, v as value, round(abs(v - p_retailprice), 4) as difference,
             coalesce(case when p_retailprice = 0 then v is not null else abs(v - p_retailprice) / abs(p_retailprice) <= 0.01 end, false) as match
      from part left join s on p_partkey = l_partkey""",
    "coalesce_merge": """
      with x as (select segment_id, year, quarter, regexp_replace(lower(trim(field)), '[ _-]+', '_', 'g') as field, max(value) as value, max(note_ref) as note_ref from value_xbrl group by all),
           p as (select segment_id, year, quarter, regexp_replace(lower(trim(field)), '[ _-]+', '_', 'g') as field, max(value) as value, max(note_ref) as note_ref from value_pdf group by all)
      select coalesce(x.segment_id, p.segment_id) as segment_id, coalesce(x.year, p.year) as year, coalesce(x.quarter, p.quarter) as quarter, coalesce(x.field, p.field) as field,
             coalesce(x.value, p.value) as value, coalesce(x.note_ref, p.note_ref) as note_ref,
             case when x.field is not null and p.field is not null then 'both' when x.field is not null then 'first' else 'second' end as source
      from x full join p on x.segment_id = p.segment_id and x.year = p.year and x.quarter = p.quarter and x.field = p.field""",
    "period_matrix": f"select status, {', '.join(f'''max(value) filter (period = '{p}') as "{p}"''' for p in _PERIODS)} from ({_BY_QUARTER}) group by status",
    "matrix_unpivot": f"select status, period, value from ({_BY_QUARTER}) where period in ({', '.join(repr(p) for p in _PERIODS)})",
    "incremental_append": f"with v as ({_BY_QUARTER}) select status, period, value from v where period < '1998_Q1' union all select status, period, -value from v where period >= '1998_Q1'",
    "missing_keys": "select doc_id as k from documents where not exists (select 1 from embeddings where vec_id = doc_id)",
    "valid_keys": "select vec_id as k, label from embeddings where exists (select 1 from documents where doc_id = vec_id)",
    "period_cross": "select year, month, (month // 3)::int as quarter from (select distinct year(o_orderdate)::int as year from orders), (select unnest([3, 6, 9, 12])::int as month)",
    "split_documents": """
      with f as (select segment_id, min(page_no) as p from documents where contains(lower(text), 'auditores') group by 1)
      select doc_id, d.segment_id, case when page_no >= p then 2 else 1 end as part from documents d left join f on f.segment_id is not distinct from d.segment_id""",
}

SQL["normalize_frame"] = (
    SQL["parse_mixed_number"].replace("select value_id, case when w then -n else n end as value from", "select value_id, case when w then -n else n end as valor_texto, loaded_at as fecha_de_carga from").replace("select value_id, trim(value_text)", "select value_id, loaded_at, trim(value_text)")
)

_TOTALS = """
  select doc_id, section, sum(case when coalesce(t, false) then 0 else coalesce(ytd_actual, 0) end)::bigint as calculated, max(ytd_actual) filter (t) as reported
  from (select *, contains(lower(concepto), 'total') or regexp_matches(lower(concepto), '\\bsuma\\b') as t from line_item
        where section in (select section from field_rule where is_total group by 1 having count(*) = 1)) group by 1, 2
"""

SQL["section_total"] = f"select doc_id, section, calculated, reported, (reported - calculated)::bigint as difference, coalesce(reported = calculated, false) as match from ({_TOTALS})"
SQL["report_rows"] = f"""
  select section as category, case when coalesce(reported = calculated, false) then 'ok: ' || doc_id || ' = ' || coalesce(format('{{:,}}', reported), '-')
         else 'mismatch: ' || doc_id || ' expected ' || coalesce(format('{{:,}}', calculated), '-') || ', found ' || coalesce(format('{{:,}}', reported), '-') || ', off by ' || coalesce(format('{{:,}}', reported - calculated), '-') end as line
  from ({_TOTALS})"""
SQL["combined_vectors"] = "select vec_id, (2 * len(embedding))::int as width, round(embedding[len(embedding)]::double / sqrt(2 * list_dot_product(embedding::double[], embedding::double[])), 6) as last from embeddings"
SQL["layout_map"] = """
  with v as (select * replace (regexp_replace(lower(trim(field)), '[ _-]+', '_', 'g') as field) from value_pdf),
       s as (select sheet, field, year, quarter, count(value) as n, round(sum(value), 2) as total from v group by all)
  select r.sheet, r.field, p.year, p.quarter, row_no, label, n, total from field_rule r cross join (select distinct year, quarter from v) p
  left join s on r.sheet = s.sheet and r.field = s.field and p.year = s.year and p.quarter = s.quarter"""
