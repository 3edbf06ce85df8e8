"""Oracle SQL (DuckDB) of plans.filings."""

from tallyspan.plans.figures_sql import _LOCALE, _NORMAL

_NORM = "trim(regexp_replace(regexp_replace(lower(strip_accents(replace({0}, chr(160), ' '))), '[.,;:()\\[\\]]', ' ', 'g'), '\\s+', ' ', 'g'))"

_SCORE = """
  (select doc_id, segment_id, (contains(t, 'costo')::int + contains(t, 'margen')::int + contains(t, 'flujo')::int + contains(t, 'deuda')::int + contains(t, 'cobre')::int
          + 5 * contains(t, 'dotación')::int + 5 * contains(t, 'dotacion')::int - 5 * contains(t, 'auditores')::int) as score
   from (select doc_id, segment_id, lower(text) as t from documents where text is not null))
"""

_LINES = "select doc_id, i as line_no, line from (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as i from (select doc_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) as ls from documents where text is not null))"

_SEGMENTS = """
  select * from (
    select *, count(*) filter (event_type = 'signup') over w as seg_no,
           last_value(case when event_type in ('signup', 'error') then event_type end ignore nulls) over w as last_mark
    from events window w as (partition by user_id order by event_id rows unbounded preceding)
  ) where last_mark = 'signup' and event_type not in ('signup', 'error')
"""

_CHOSEN = """
  select doc_id, ctx_id, strategy from (
    select *, case when {named} then 1 when {dated} then 2 when {last} then 3 end as strategy
    from (select *, regexp_extract(doc_id, '_([0-9]{{4}})Q', 1) as y, ['-03-31', '-06-30', '-09-30', '-12-31'][regexp_extract(doc_id, 'Q([1-4])$', 1)::int] as e from xbrl_context)
  ) where strategy is not null
  qualify row_number() over (partition by doc_id order by strategy, {newest}, ctx_ord) = 1
"""
_CURRENT = _CHOSEN.format(
    named="contains(ctx_id, 'AcumuladoActual') and not contains(ctx_id, 'AcumuladoAnoActual')",
    dated="period_type = 'duration' and start_date = y || '-01-01' and end_date = y || e",
    last="period_type = 'duration' and end_date is not null",
    newest="case when strategy = 3 then -epoch(end_date::date) else 0 end",
)
_YEARLY = _CHOSEN.format(
    named="contains(ctx_id, 'AcumuladoAnoActual')",
    dated="period_type = 'duration' and start_date = y || '-01-01' and end_date = y || '-12-31'",
    last="period_type = 'instant' and starts_with(instant, y)",
    newest="0",
)
_CONTEXTS = "(select * from xbrl_context qualify row_number() over (partition by doc_id, ctx_id order by ctx_ord) = 1)"
_NUMBER = "try_cast(case when regexp_full_match(trim(regexp_replace(value, '\\s+', ' ', 'g')), '[+-]?[0-9]*\\.?[0-9]+') then trim(regexp_replace(value, '\\s+', ' ', 'g')) end as double)"


SQL = {
    "page_find": """
      select segment_id, min(page_no) as page_no from (select segment_id, page_no, lower(text) as t from documents)
      where (contains(t, 'costo') or contains(t, 'cost') or contains(t, 'coût') or contains(t, 'cout'))
        and (contains(t, 'energía') or contains(t, 'energia') or contains(t, 'deuda') or contains(t, 'debt') or contains(t, 'power')) group by 1""",
    "section_context": """
      select doc_id, p::int as position, md5(substr(text, greatest(1, p - 100), p + 200 - greatest(1, p - 100))) as context_md5
      from (select doc_id, text, strpos(lower(text), 'nota ') as p from documents) where p > 0""",
    "table_score": f"select doc_id, score from {_SCORE}",
    "best_table": f"select segment_id, doc_id, score from {_SCORE} where score >= 2 qualify row_number() over (partition by segment_id order by score desc, doc_id) = 1",
    "explode_lines": f"select doc_id, line_no::int as line_no, length(line)::int as n_chars from ({_LINES})",
    "line_segments": f"select user_id, seg_no, count(*) as n, min(event_id) as first_id from ({_SEGMENTS}) group by 1, 2",
    "chosen_segment": f"""
      select user_id, seg_no, n as n_rows from (select user_id, seg_no, count(*) as n, coalesce(bool_or(event_type = 'purchase' and value > 60), false) as told from ({_SEGMENTS}) group by 1, 2)
      where told or n >= 3 qualify row_number() over (partition by user_id order by told desc, case when told then seg_no else -n end, seg_no) = 1""",
    "latest_context": "select doc_id, ctx_id, end_date from xbrl_context where period_type = 'duration' and end_date is not null qualify row_number() over (partition by doc_id order by end_date desc, ctx_ord) = 1",
    "current_context": _CURRENT,
    "year_context": _YEARLY,
    "fact_contexts": f"select f.fact_id, f.doc_id, f.context_ref, c.period_type, c.start_date, c.end_date, c.instant from xbrl_fact f left join {_CONTEXTS} c on c.doc_id = f.doc_id and c.ctx_id = f.context_ref",
    "facts_by_substring": "select fact_id, name from xbrl_fact where contains(lower(name), 'profitloss')",
    "ytd_max": f"""
      select f.doc_id, f.name, max(floor({_NUMBER} / 1000))::bigint as ytd from xbrl_fact f join {_CONTEXTS} c on c.doc_id = f.doc_id and c.ctx_id = f.context_ref
      where ends_with(c.start_date, '-01-01') group by 1, 2 having ytd is not null""",
    "fact_categories": "select regexp_extract(name, '[A-Z][a-z]*') as category, count(*) as n from xbrl_fact group by 1",
    "units_distinct": "select distinct unit_ref, coalesce(nullif(regexp_extract(unit_ref, 'iso4217[:_]([A-Z]{3})', 1), ''), unit_ref) as label from xbrl_fact where unit_ref is not null",
    "sheet_listing": """
      select file_id, regexp_extract(file_name, '^([A-Za-z]+[0-9]*)_', 1) as sheet_name, regexp_extract(file_name, '[0-9]{4}')::int as year,
             case coalesce(nullif(regexp_extract(file_name, '_(IV|III|II|I)Q[0-9]{4}', 1), ''), regexp_extract(file_name, '_Q(IV|III|II|I|[1-4])\\.', 1))
               when 'I' then 1 when '1' then 1 when 'II' then 2 when '2' then 2 when 'III' then 3 when '3' then 3 when 'IV' then 4 when '4' then 4 end as quarter from sheet_file""",
    "line_values": f"""
      with m as (
        select l.doc_id, l.line_no, l.line, k.section, k.field from ({_LINES}) l join keyword_rule k on len(list_filter(k.match_words, lambda w: contains(lower(l.line), lower(w)))) > 0 and len(list_filter(k.exclude_words, lambda w: contains(lower(l.line), lower(w)))) = 0
      ), tok as (
        select doc_id, line_no, list_filter(regexp_extract_all({_NORMAL}, '-?[0-9.,]+'), lambda x: regexp_matches(x, '[0-9]')) as ts from (select distinct doc_id, line_no, line from m)
      ), parts as (
        select doc_id, line_no, u.t, u.i from (select doc_id, line_no, unnest(list_transform(ts, lambda x, i: {{'t': x, 'i': i}})) as u from tok)
      ), num as (
        select doc_id, line_no, i, whole, case when t like '-%' then -n else n end as v from (
          select *, try_cast(case when regexp_full_match(plain, '[0-9]*\\.?[0-9]*') and regexp_matches(plain, '[0-9]') then plain end as double) as n from ({_LOCALE.format("select doc_id, line_no, i, t from parts")})) where n is not null
      ), first as (
        select doc_id, line_no, v from num where not (whole and v > 0 and v < 100) qualify row_number() over (partition by doc_id, line_no order by i) = 1
      )
      select m.doc_id, section, field, v as value from m join first on first.doc_id = m.doc_id and first.line_no = m.line_no qualify row_number() over (partition by m.doc_id, section, field order by m.line_no) = 1""",
    "vector_topk": """
      with q as (select vec_id as query_id, embedding as qe from embeddings where vec_id % 50 = 0),
           s as (select query_id, vec_id as neighbor_id, round(list_cosine_similarity(qe::double[], embedding::double[]), 9) as sim from q, embeddings where vec_id <> query_id)
      select query_id, neighbor_id, (row_number() over (partition by query_id order by sim desc, neighbor_id))::int as rank, round(sim, 5) as similarity from s
      qualify row_number() over (partition by query_id order by sim desc, neighbor_id) <= 10""",
    "neighbor_counts": """
      with q as (select vec_id as query_id, embedding as qe from embeddings where vec_id % 50 = 0),
           s as (select query_id, list_cosine_similarity(qe::double[], embedding::double[]) as sim from q, embeddings where vec_id <> query_id)
      select query_id, (count(*) filter (sim >= 0.3))::bigint as n, round(max(sim), 5) as max_similarity from s group by 1""",
    "similar_pairs": """
      select q.vec_id as query_id, e.vec_id as neighbor_id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 5) as similarity
      from embeddings q, embeddings e where q.vec_id % 50 = 0 and e.vec_id <> q.vec_id and (e.vec_id % 50 <> 0 or q.vec_id < e.vec_id) and list_cosine_similarity(q.embedding::double[], e.embedding::double[]) >= 0.3""",
    "similarity_violations": """
      with p as (
        select q.vec_id as id, list_cosine_similarity(q.embedding::double[], e.embedding::double[]) as s
        from embeddings q, embeddings e where q.vec_id % 50 = 0 and e.vec_id <> q.vec_id and (e.vec_id % 50 <> 0 or q.vec_id < e.vec_id) and s >= 0.3)
      select id, 'pair' as kind, 1::bigint as n from p where s >= 0.4 union all select id, 'neighbors', count(*) from p where s < 0.4 group by 1 having count(*) >= 2""",
    "concat_normalize": """
      select vec_id, (2 * len(embedding))::int as width, round(embedding[1]::double / sqrt(2 * list_dot_product(embedding::double[], embedding::double[])), 6) as first, 1.0::double as norm, 1.0::double as same from embeddings""",
    "refactor_index": "select p_partkey, round(0.25 * p_size + 0.15 * (p_size % 7) + 0.6 * 25.403 * power((p_partkey % 100) / 100.0, 5), 6)::double as score from part",
    "stream_totals": "select date_trunc('hour', ts) as window_start, event_type, count(*) as n, round(sum(value), 2) as total from events group by 1, 2",
}

_FIELD_OF = """(select arg_min(k.field, k.rule_ord) from keyword_rule k where k.section = l.section
  and len(list_filter(k.match_words, lambda w: contains(lower(l.concepto), lower(w)))) > 0
  and len(list_filter(k.exclude_words, lambda w: contains(lower(l.concepto), lower(w)))) = 0)"""

_SECTION_LABELS = f"select *, {_NORM.format('label')} as m from (select section, rule_ord, unnest(labels) as label, generate_subscripts(labels, 1) as place from keyword_rule)"

SQL["label_match"] = f"""
  with items as (select item_id, section, {_NORM.format("concepto")} as n from line_item), labels as ({_SECTION_LABELS}),
       hits as (
         select item_id, label from items i join labels l on i.section = l.section
         where contains(n, m) or len(list_filter(string_split(m, ' '), lambda w: contains(n, w))) >= 0.8 * len(string_split(m, ' '))
         qualify row_number() over (partition by item_id order by -length(label), rule_ord, place) = 1)
  select i.item_id, label from items i left join hits h on h.item_id = i.item_id"""
SQL["keyword_match"] = f"select item_id, {_FIELD_OF} as field from line_item l"
SQL["sheet_items"] = f"""
  with n as (select doc_id, section, item_ord, item_id, ytd_actual, {_FIELD_OF} as field from line_item l)
  select doc_id, section, field, ytd_actual from n where field is not null and ytd_actual is not null
  qualify row_number() over (partition by doc_id, section, field order by item_ord desc, item_id desc) = 1"""
SQL["grid_rows"] = f"""
  with lines as (select doc_id, section, item_id, i - 1 as line, t, ytd_actual, ytd_anterior, quarter_actual, quarter_anterior
                 from (select *, unnest(ls) as t, generate_subscripts(ls, 1) as i from (select *, string_split(concepto, chr(10)) as ls from line_item where concepto is not null)) where trim(t) <> ''),
       named as (select *, {_NORM.format("t")} as n from lines), labels as ({_SECTION_LABELS}),
       hits as (
         select item_id, line, label from named d join labels l on d.section = l.section
         where contains(n, m) or len(list_filter(string_split(m, ' '), lambda w: contains(n, w))) >= 0.8 * len(string_split(m, ' '))
         qualify row_number() over (partition by item_id, line order by -length(label), rule_ord, place) = 1)
  select doc_id, section, d.item_id, d.line::int as line, coalesce(label, 'Totales') as concepto, case when d.line = 0 then ytd_actual end as ytd_actual, case when d.line = 0 then ytd_anterior end as ytd_anterior,
         case when d.line = 0 then quarter_actual end as quarter_actual, case when d.line = 0 then quarter_anterior end as quarter_anterior
  from named d left join hits h on h.item_id = d.item_id and h.line = d.line where label is not null or contains(lower(t), 'total')"""
SQL["mapped_facts"] = f"""
  with cur as ({_CURRENT}), instants as (
    select doc_id, ctx_id from xbrl_context where period_type = 'instant' and starts_with(instant, regexp_extract(doc_id, '_([0-9]{{4}})Q', 1)) qualify row_number() over (partition by doc_id order by ctx_ord) = 1
  ), chosen as (
    select doc_id, ctx_id, 'duration' as context_type, 0 as turn from cur union all select doc_id, ctx_id, 'instant', strategy from ({_YEARLY}) union all select doc_id, ctx_id, 'instant', 4 from instants
  ),
  names as (
    select field, context_type, apply_scaling, ensure_negative, unnest(ns) as name, generate_subscripts(ns, 1) as rank from (select *, [primary_fact] || coalesce(fallbacks, []) as ns from fact_mapping)
  ), firsts as (
    select f.doc_id, n.field, turn, n.rank, apply_scaling, ensure_negative, {_NUMBER} as v
    from xbrl_fact f join names n on f.name = n.name join chosen c on c.doc_id = f.doc_id and c.ctx_id = f.context_ref and c.context_type = n.context_type
    qualify row_number() over (partition by f.doc_id, n.field, turn, n.rank order by fact_ord) = 1
  ), best as (
    select *, case when apply_scaling then trunc(v / 1000)::bigint::double else v end as s from firsts where v is not null qualify row_number() over (partition by doc_id, field order by turn, rank) = 1
  ), found as (select doc_id, field, case when ensure_negative and s > 0 then -s else s end as value from best)
  select * from found union all
  select cur.doc_id, m.field, m.default_value from cur, fact_mapping m
  where m.default_value is not null and not exists (select 1 from found where found.doc_id = cur.doc_id and found.field = m.field)"""
