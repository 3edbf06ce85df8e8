"""Oracle SQL (DuckDB) of problems 5 and 6, written apart from the operators."""

_FIELD = "'(?:\"(?:[^\"]|\"\")*\"|[^\"' || s || ']*)'"

_P5_TESTED = f"""
with lines as (
  select raw_id, record_kind, payload, case sep when '|' then '\\|' when '.' then '\\.' else sep end as s, sep from raw_line
), shaped as (
  select *, payload is null or not regexp_matches(payload, '\\S') as blank,
         regexp_full_match(payload, {_FIELD} || '(?:' || s || {_FIELD} || ')*', 's') as quoted,
         regexp_extract_all(sep || payload, s || '(' || {_FIELD} || ')', 1, 's') as raw
  from lines
), fields as (
  select *, list_transform(raw, lambda x: trim(case when x like '"%' then replace(substr(x, 2, length(x) - 2), '""', '"') else x end, e' \\t\\r\\n')) as f from shaped
), tested as (
  select raw_id, record_kind, f, blank, quoted, len(f) as n, case record_kind when 'line_item' then 5 when 'source_info' then 8 end as due,
    case record_kind
      when 'line_item' then f[1] <> '' and len(list_filter(f[2:5], lambda x: regexp_full_match(x, '-?|-?([0-9]+|[0-9]{{1,3}}(\\.[0-9]{{3}})+)|\\(\\s*([0-9]+|[0-9]{{1,3}}(\\.[0-9]{{3}})+)\\s*\\)'))) = 4
      when 'source_info' then f[1] <> '' and regexp_full_match(f[6], '[0-9]+(\\.[0-9]+)?') and coalesce(try_cast(f[6] as double) between 0 and 1, false)
        and regexp_full_match(f[7], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}(\\.[0-9]{{1,6}})?(Z|\\+00:00)?')
        and try_strptime(substr(f[7], 1, 19), '%Y-%m-%dT%H:%M:%S') is not null
        and regexp_full_match(f[8], '-?|(M?US\\$ ?)?(-?([0-9]+|[0-9]{{1,3}}(\\.[0-9]{{3}})+)(,[0-9]+)?|\\(\\s*([0-9]+|[0-9]{{1,3}}(\\.[0-9]{{3}})+)(,[0-9]+)?\\s*\\))')
    end as valid
  from fields
)
"""

_P5 = _P5_TESTED + """
select raw_id, case when blank then 'column_count' when not quoted then 'quoting' when n <> due then 'column_count' else 'value' end as reason
from tested where blank or not quoted or n <> due or not coalesce(valid, false)
"""


def _number(x: str) -> str:
    """A checked amount or figure as a decimal, null for an empty one."""
    plain = f"replace(regexp_replace(regexp_replace({x}, '^M?US\\$', ''), '[.() ]', '', 'g'), ',', '.')"
    return f"case when regexp_matches({x}, '^(M?US\\$ ?)?\\(') then -try_cast({plain} as decimal(38, 6)) else try_cast({plain} as decimal(38, 6)) end"


_P5_VALID = " from tested where record_kind = '{0}' and not blank and quoted and n = due and coalesce(valid, false)"
_AMOUNTS = ("ytd_actual", "ytd_anterior", "quarter_actual", "quarter_anterior")
_P5_ITEMS = _P5_TESTED + "select raw_id, f[1] as concepto, " + ", ".join(f"({_number(f'f[{i}]')})::bigint as {c}" for i, c in enumerate(_AMOUNTS, 2)) + _P5_VALID.format("line_item")
_P5_RECORDS = (
    _P5_TESTED
    + "select raw_id, f[1] as field, "
    + ", ".join(f"nullif(f[{i}], '') as {c}" for i, c in enumerate(("source_type", "file_path", "location", "extraction_method"), 2))
    + ", f[6]::double as confidence, regexp_replace(f[7], '(Z|\\+00:00)$', '')::timestamp as timestamp, "
    + f"({_number('f[8]')})::double as raw_value"
    + _P5_VALID.format("source_info")
)

_SIDE = """
  select 'SG-' || lpad(regexp_replace(segment_id, '[^0-9]', '', 'g'), 9, '0') as segment_id, year::bigint as year, quarter::bigint as quarter,
         lower(trim(sheet)) as sheet, regexp_replace(lower(trim(field)), '[ _-]+', '_', 'g') as field,
         value, period_type, note_ref, nullif(lower(trim(period_type)), '') as pt, xbrl_available as xa, nullif(lower(trim(note_ref)), '') as nr,
         row_number() over (partition by regexp_replace(segment_id, '[^0-9]', '', 'g'), year, quarter, lower(trim(sheet)), regexp_replace(lower(trim(field)), '[ _-]+', '_', 'g')
                            order by loaded_at desc nulls last, value desc nulls last, period_type desc nulls last, xbrl_available desc nulls last, note_ref desc nulls last) as rn
  from {0}
"""

_P6 = f"""
with a as (select * from ({_SIDE.format("value_pdf")}) where rn = 1), b as (select * from ({_SIDE.format("value_xbrl")}) where rn = 1),
j as (
  select coalesce(a.segment_id, b.segment_id) as segment_id, coalesce(a.year, b.year) as year, coalesce(a.quarter, b.quarter) as quarter,
         coalesce(a.sheet, b.sheet) as sheet, coalesce(a.field, b.field) as field, a.rn as ina, b.rn as inb,
         a.value as va, b.value as vb, a.pt as pa, b.pt as pb, a.xa as xa, b.xa as xb, a.nr as na, b.nr as nb
  from a full join b on a.segment_id = b.segment_id and a.year = b.year and a.quarter = b.quarter and a.sheet = b.sheet and a.field = b.field
), t as (
  select j.*, case when r.value_type = 'int' then 1 else 0.001 end as tol from j left join field_rule r on r.sheet = j.sheet and r.field = j.field
), d as (
  select segment_id, year, quarter, sheet, field, unnest(case
    when inb is null then ['only_pdf'] when ina is null then ['only_xbrl']
    else list_filter([
      case when (va is null) <> (vb is null) or abs(abs(va) - abs(vb)) > tol + 1e-9 then 'value' end,
      case when pa is distinct from pb then 'period_type' end,
      case when xa is distinct from xb then 'xbrl_available' end,
      case when na is distinct from nb then 'note_ref' end], lambda x: x is not null) end) as difference
  from t
)
select segment_id, year, quarter, sheet, field, difference from d
"""

_P6_COMPARED = f"""
with a as (select * from ({_SIDE.format("value_pdf")}) where rn = 1), b as (select * from ({_SIDE.format("value_xbrl")}) where rn = 1),
j as (
  select coalesce(a.segment_id, b.segment_id) as segment_id, coalesce(a.year, b.year) as year, coalesce(a.quarter, b.quarter) as quarter,
         coalesce(a.sheet, b.sheet) as sheet, coalesce(a.field, b.field) as field, a.rn as ina, b.rn as inb,
         a.value as va, b.value as vb, a.period_type as rpa, b.period_type as rpb, a.note_ref as rna, b.note_ref as rnb, a.pt as pa, b.pt as pb, a.xa as xa, b.xa as xb, a.nr as na, b.nr as nb
  from a full join b on a.segment_id = b.segment_id and a.year = b.year and a.quarter = b.quarter and a.sheet = b.sheet and a.field = b.field
), t as (
  select j.*, case when r.value_type = 'int' then 1 else 0.001 end as tol from j left join field_rule r on r.sheet = j.sheet and r.field = j.field
), d as (
  select segment_id, year, quarter, sheet, field, unnest(case
    when inb is null then [struct_pack(difference := 'only_pdf', value_a := null::varchar, value_b := null::varchar)]
    when ina is null then [struct_pack(difference := 'only_xbrl', value_a := null::varchar, value_b := null::varchar)]
    else list_filter([
      case when (va is null) <> (vb is null) or abs(abs(va) - abs(vb)) > tol + 1e-9 then struct_pack(difference := 'value', value_a := va::decimal(38,6)::varchar, value_b := vb::decimal(38,6)::varchar) end,
      case when pa is distinct from pb then struct_pack(difference := 'period_type', value_a := rpa, value_b := rpb) end,
      case when xa is distinct from xb then struct_pack(difference := 'xbrl_available', value_a := xa::varchar, value_b := xb::varchar) end,
      case when na is distinct from nb then struct_pack(difference := 'note_ref', value_a := rna, value_b := rnb) end], lambda x: x is not null) end) as d
  from t
)
select segment_id, year, quarter, sheet, field, d.difference, d.value_a, d.value_b, false as match from d
"""

SQL = {"p5_found": _P5, "p5_line_items": _P5_ITEMS, "p5_source_records": _P5_RECORDS, "p6_found": _P6, "p6_comparison": _P6_COMPARED}
