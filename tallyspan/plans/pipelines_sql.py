"""Oracle SQL (DuckDB) of plans.pipelines."""

from tallyspan.plans.figures_sql import _LOCALE, _NORMAL
from tallyspan.plans.filings_sql import _FIELD_OF, _NORM, _SECTION_LABELS
from tallyspan.plans.filings_sql import SQL as _FILINGS

_PAGE_LINES = """select doc_id, page_no, i as line_no, line from (
  select doc_id, page_no, unnest(ls) as line, generate_subscripts(ls, 1) as i
  from (select doc_id, coalesce(page_no, 0) as page_no, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) as ls from documents where text is not null))"""

_SEGMENT_LINES = f"""
  with marked as (
    select *, count(*) filter (mark = 'start') over w as seg, last_value(mark ignore nulls) over w as last_mark
    from (select *, case when regexp_matches(line, '^(Nota|Note) [0-9]+') then 'start' when trim(line) = '' then 'end' end as mark from ({_PAGE_LINES}))
    window w as (partition by doc_id order by page_no, line_no rows unbounded preceding)
  ), inside as (select * from marked where last_mark = 'start' and mark is null),
  sized as (select doc_id, seg, count(*) as n, bool_or(contains(lower(line), 'deuda')) as told from inside group by 1, 2 having told or n >= 3),
  chosen as (select doc_id, seg from sized qualify row_number() over (partition by doc_id order by told desc, case when told then seg else -n end, seg) = 1)
  select i.doc_id, i.page_no, i.line_no, i.line from inside i join chosen c on c.doc_id = i.doc_id and c.seg = i.seg"""


def _values(lines: str) -> str:
    """The first line of a document and field with a value, typed and signed by the field rules."""
    return f"""
  with l as ({lines}), m as (
    select l.doc_id, l.page_no, l.line_no, l.line, k.sheet, k.field from l join keyword_rule k
      on len(list_filter(k.match_words, lambda w: contains(lower(l.line), lower(w)))) > 0 and len(list_filter(k.exclude_words, lambda w: contains(lower(l.line), lower(w)))) = 0
  ), tok as (
    select line as full_line, list_filter(regexp_extract_all({_NORMAL}, '-?[0-9.,]+'), lambda x: regexp_matches(x, '[0-9]')) as ts from (select distinct line from m)
  ), parts as (
    select full_line, u.t, u.i from (select full_line, unnest(list_transform(ts, lambda x, i: {{'t': x, 'i': i}})) as u from tok)
  ), num as (
    select full_line, i, whole, case when t like '-%' then -n else n end as v from (
      select *, try_cast(case when regexp_full_match(plain, '[0-9]*\\.?[0-9]*') and regexp_matches(plain, '[0-9]') then plain end as double) as n from ({_LOCALE.format("select full_line, i, t from parts")})) where n is not null
  ), first as (
    select full_line, v from num where not (whole and v > 0 and v < 100) qualify row_number() over (partition by full_line order by i) = 1
  ), found as (
    select m.doc_id, m.sheet, m.field, v from m join first on first.full_line = m.line qualify row_number() over (partition by m.doc_id, m.sheet, m.field order by m.page_no, m.line_no) = 1
  ), typed as (
    select doc_id, f.sheet, f.field, sign, case when value_type = 'int' then trunc(v)::bigint::double else v end as v from found join field_rule f on f.sheet = found.sheet and f.field = found.field
  )
  select doc_id, sheet, field, case when sign = 'negative' and v > 0 then -v else v end as value from typed"""


_CELLS = "concat_ws(''', ''', concepto, coalesce(ytd_actual::varchar, '-'), coalesce(ytd_anterior::varchar, '-'), coalesce(quarter_actual::varchar, '-'), coalesce(quarter_anterior::varchar, '-'))"
_TABLES = f"""(select doc_id, page_no, section, string_agg(lower(replace({_CELLS}, chr(10), '\\n')), chr(10) order by item_id) as t from line_item where concepto is not null group by 1, 2, 3)"""

_ITEMS = f"""(select doc_id, section, field, ytd_actual::double as value from (select doc_id, section, item_ord, item_id, ytd_actual, {_FIELD_OF} as field from line_item l)
  where field is not null and ytd_actual is not null qualify row_number() over (partition by doc_id, section, field order by item_ord desc, item_id desc) = 1)"""
_STATEMENT_ITEMS = f"(select doc_id, field, value from {_ITEMS} where section = 'resultados')"
_FACTS = f"({_FILINGS['mapped_facts']})"

_COMBINED = f"""
  select coalesce(a.doc_id, b.doc_id) as doc_id, coalesce(a.field, b.field) as field, coalesce(a.value, b.value) as value, case when a.doc_id is not null and b.doc_id is not null then 'both' when a.doc_id is not null then 'first' else 'second' end as source
  from (select * from {_FACTS} f where doc_id in (select doc_id from {_FACTS} where value is not null group by 1 having count(*) >= 10)) a
  full join {_STATEMENT_ITEMS} b on a.doc_id = b.doc_id and a.field = b.field"""

_TERMS = ("ganancia_bruta", "otros_ingresos", "otros_egresos_funcion", "ingresos_financieros", "gastos_admin_ventas", "costos_financieros", "diferencias_cambio")
_of = "max(value) filter (field = '{0}')".format
_NAMED = str(("ingresos_ordinarios", "costo_ventas", "ganancia_antes_impuestos", *_TERMS))

_STATEMENT_CHECKS = f"""
  select 'formula' as category, doc_id, rule, expected, actual, abs(expected - actual) as difference, coalesce(abs(expected - actual) <= 1, true) as match from (
    select doc_id, 'gross' as rule, {_of("ganancia_bruta")} as expected, {_of("ingresos_ordinarios")} + {_of("costo_ventas")} as actual from {_STATEMENT_ITEMS} where field in {_NAMED} group by 1
    union all select doc_id, 'pre_tax', {_of("ganancia_antes_impuestos")}, {" + ".join(map(_of, _TERMS))} from {_STATEMENT_ITEMS} where field in {_NAMED} group by 1)
  union all
  select 'pair', coalesce(a.doc_id, b.doc_id), coalesce(a.field, b.field), a.value, b.value, coalesce(abs(abs(a.value) - abs(b.value)), 0), coalesce(abs(abs(a.value) - abs(b.value)) <= 1, true)
  from (select * from {_STATEMENT_ITEMS} where field in (select field from field_rule where section = 'resultados')) a
  full join (select * from {_FACTS} where field in (select field from field_rule where section = 'resultados')) b on a.doc_id = b.doc_id and a.field = b.field where a.value is not null or b.value is not null
  union all
  select 'reference', r.doc_id, r.field, r.expected, i.value, abs(i.value - r.expected),
         coalesce(i.value is not null and case when is_int then abs(i.value - r.expected) <= 1 when r.expected = 0 then true else abs(i.value - r.expected) / abs(r.expected) <= 0.01 end, false)
  from (select segment_id || '_' || year || 'Q' || quarter as doc_id, field, max(value) as expected from value_xbrl where regexp_full_match(segment_id, 'SG-[0-9]{{9}}') and sheet = 'sheet3' and value is not null group by 1, 2) r
  join (select field, value_type = 'int' as is_int from field_rule where section = 'resultados') k on k.field = r.field
  left join {_STATEMENT_ITEMS} i on i.doc_id = r.doc_id and i.field = r.field"""

_ONE_TOTAL = "(select section from field_rule where is_total group by 1 having count(*) = 1)"
_NOTE_CHECKS = f"""
  select 'sum' as category, doc_id, rule, coalesce(expected, 0) as expected, actual, coalesce(abs(abs(coalesce(expected, 0)) - abs(actual)), 0) as difference, coalesce(abs(abs(coalesce(expected, 0)) - abs(actual)) <= 1, true) as match
  from (
    select i.doc_id, f.section as rule, sum(i.value) filter (not f.is_total) as expected, max(i.value) filter (f.is_total) as actual
    from (select doc_id, field, value from {_ITEMS} where section in {_ONE_TOTAL}) i join (select section, field, is_total from field_rule where section in {_ONE_TOTAL}) f on f.field = i.field group by 1, 2)"""


def _shown(c: str) -> str:
    return f"coalesce(format('{{:,}}', round_even({c}, 0)::bigint), '-')"


SQL = {
    "figures_from_lines": _values(_PAGE_LINES),
    "figures_from_segments": _values(_SEGMENT_LINES),
    "figures_from_grids": f"""
      with wanted as (select section, unnest(labels) as label from keyword_rule),
      scored as (select t.doc_id, t.page_no, t.section as idx, w.section, count(*) filter (contains(t.t, lower(w.label))) as score from {_TABLES} t, wanted w group by 1, 2, 3, 4 having score >= 3),
      best as (select * from scored qualify row_number() over (partition by doc_id, section order by -score, page_no nulls first, idx) = 1),
      lines as (
        select b.section, l.doc_id, l.item_id, i - 1 as line, t, l.ytd_actual
        from (select *, unnest(ls) as t, generate_subscripts(ls, 1) as i from (select *, string_split(concepto, chr(10)) as ls from line_item where concepto is not null)) l
        join best b on b.doc_id = l.doc_id and b.page_no = l.page_no and b.idx = l.section where trim(t) <> ''),
      named as (select *, {_NORM.format("t")} as n from lines), labels as ({_SECTION_LABELS}),
      hits as (
        select d.section, item_id, line, label from named d join labels l on d.section = l.section
        where contains(n, m) or len(list_filter(string_split(m, ' '), lambda w: contains(n, w))) >= 0.8 * len(string_split(m, ' '))
        qualify row_number() over (partition by d.section, item_id, line order by -length(label), rule_ord, place) = 1),
      concepts as (select d.section, d.doc_id, d.item_id, d.line, coalesce(label, 'Totales') as concepto, case when d.line = 0 then ytd_actual end as v
                   from named d left join hits h on h.section = d.section and h.item_id = d.item_id and h.line = d.line where label is not null or contains(lower(t), 'total')),
      totals as (select section, arg_min(field, rule_ord) as total from field_rule where is_total group by 1),
      fields as (
        select c.*, case when total is not null and (starts_with(lower(concepto), 'total') or starts_with(lower(concepto), 'suma')) then total
          else (select arg_min(k.field, k.rule_ord) from keyword_rule k where k.section = c.section and not exists (select 1 from field_rule f where f.section = k.section and f.field = k.field and f.is_total)
                and len(list_filter(k.match_words, lambda w: contains(lower(c.concepto), lower(w)))) > 0 and len(list_filter(k.exclude_words, lambda w: contains(lower(c.concepto), lower(w)))) = 0) end as field
        from concepts c left join totals on totals.section = c.section),
      last as (select section, doc_id, field, v from fields where field is not null and v is not null qualify row_number() over (partition by section, doc_id, field order by item_id desc, line desc) = 1)
      select l.doc_id, l.section, l.field, (case when sign = 'negative' and v > 0 then -v else v end)::double as value from last l join field_rule f on f.section = l.section and f.field = l.field""",
    "table_or_next_page": f"""
      with wanted as (select doc_id, min(page_no) - (min(item_id) % 2) as p from line_item where concepto is not null group by 1),
      labels as (select labels[1] as label from keyword_rule where section = 'nota_21'),
      scored as (
        select t.doc_id, t.page_no, t.section, t.page_no - p as turn, (count(*) filter (contains(t.t, lower(label))))::int as score
        from {_TABLES} t join wanted w on w.doc_id = t.doc_id and t.page_no in (p, p + 1), labels group by 1, 2, 3, 4 having score >= 2)
      select doc_id, page_no, section as table_idx, score from scored qualify row_number() over (partition by doc_id order by turn, -score, section) = 1""",
    "statement_figures": _COMBINED,
    "statement_records": f"""
      with v as ({_COMBINED})
      select d.doc_id, f.row_no, f.label, f.field, v.value from (select distinct doc_id from v) d cross join (select * from field_rule where section = 'resultados') f left join v on v.doc_id = d.doc_id and v.field = f.field""",
    "statement_checks": _STATEMENT_CHECKS,
    "note_checks": _NOTE_CHECKS,
    "check_report": f"""
      with c as ({_NOTE_CHECKS} union all {_STATEMENT_CHECKS}), cats as (select unnest(['sum', 'formula', 'source', 'pair', 'reference']) as category, unnest([0, 1, 2, 3, 4]) as part),
      docs as (select doc_id, count(*) filter (not match) as failed from c group by 1),
      n as (select doc_id, category, count(*) filter (match) as p, count(*) filter (not match) as f from c group by 1, 2),
      bad as (
        select doc_id, part, rule, 'mismatch: ' || rule || ' expected ' || {_shown("expected")} || ', found ' || {_shown("actual")} || ', off by ' || {_shown("difference")} as line
        from c join cats on cats.category = c.category where not match)
      select d.doc_id, part::int as part, 0 as line_no, cats.category || ': ' || case when p is null then 'not run' else p || ' passed, ' || f || ' failed' end as line from docs d cross join cats left join n on n.doc_id = d.doc_id and n.category = cats.category
      union all select doc_id, 5, 0, case when failed = 0 then 'all checks passed' else failed || ' checks failed' end from docs
      union all select doc_id, part::int, (row_number() over (partition by doc_id, part order by rule, line))::int, line from bad""",
}
