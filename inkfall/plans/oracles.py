"""The SQL equivalents of the registered queries."""

from __future__ import annotations

from inkfall.functions.text import DATASET, ENTITY, FOLD_MORE, FOLD_ONE, NOISE, QUANTITY, SECTION_BOOSTS, SECTION_PENALTIES, STOPWORDS

_ITEMS = "(select distinct on (paper_id, item_id) * from evidence_items)"
_RECORDS = "(select distinct on (record_id) * from field_records)"
_NOTES = "(select distinct on (ann_id) * from annotations)"
#: Blanks of any script, as (?U)\s has them.
_S = r"[\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_S}+', ' ', 'g'))"


def _fold(x: str) -> str:
    out = f"translate(lower(replace({x}, 'İ', 'i̇')), '{''.join(FOLD_ONE)}', '{''.join(FOLD_ONE.values())}')"
    for a, b in FOLD_MORE.items():
        out = f"replace({out}, '{a}', '{b}')"
    return _collapse(out)


def _bare(x: str) -> str:
    return _collapse(f"regexp_replace({_fold(x)}, '[^\\pL\\pM\\p{{Nd}}\\p{{Pc}}\\x{{200C}}\\x{{200D}}\\s]', '', 'g')")


def _score(path: str) -> str:
    return " + ".join(f"(case when contains(lower(coalesce({path}, '')), '{k}') then {v} else 0 end)" for k, v in (SECTION_BOOSTS | SECTION_PENALTIES).items())


_RANK = "case lower(trim(coalesce(confidence, 'nr'))) when 'h' then 3 when 'm' then 2 when 'l' then 1 when 'nr' then 0 else -1 end"
_NOISE = " or ".join(f"regexp_matches(item_text, '{p}')" for p in NOISE)
_USAGE = """(select event_id as seq, event_type as stage, cast(floor(abs(value) * 10) as bigint) as input_tokens,
    cast(floor(cast(floor(abs(value) * 10) as bigint) / 2) as bigint) as cached_tokens, cast(floor(cast(floor(abs(value) * 10) as bigint) / 3) as bigint) as output_tokens,
    user_id % 3 as version, user_id % 7 as prefix from events)"""
def _words(x: str) -> str:
    return f"list_filter(string_split({_collapse(x)}, ' '), lambda w: w <> '')"


_MERGED = f"""
    select paper_id, field_index, case when n = 1 then v when n = 0 then 'nr' end as merged_value,
        case when n = 1 then case r when 3 then 'h' when 2 then 'm' when 1 then 'l' else 'nr' end else 'nr' end as merged_confidence,
        case when n = 1 then coalesce(array_to_string(list_sort(list_distinct(flatten(locs))), ','), '') else '' end as locations, n > 1 as conflict, n as n_values
    from (select paper_id, field_index, count(distinct v) as n, min(v) as v, max(case when v is not null then rk end) as r, list(loc) filter (v is not null and loc is not null) as locs
        from (select paper_id, field_index, loc, {_RANK} as rk, case when {_collapse("coalesce(extracted_value, '')")} not in ('', 'nr') then {_collapse("extracted_value")} end as v
            from {_RECORDS} where paper_id is not null and field_index is not null) group by all)
"""

#: Points of the fields' words that an item's text has: every distinct word of four letters a-z or more.
_TOKENS = "(select distinct unnest(regexp_extract_all(lower(concat_ws(' ', field_name, definition, reviewer_question)), '[a-z]{4,}')) as tok from extraction_map)"
_OVERLAP = f"(select i.paper_id, i.item_id, count(t.tok) as overlap from {_ITEMS} i left join {_TOKENS} t on contains(lower(i.item_text), t.tok) group by 1, 2)"

_CHOSEN = f"""(with recursive r as (select i.paper_id, i.item_id, coalesce(length(item_text), 0) as n, row_number() over (partition by i.paper_id order by {_score('section_path')} + case item_type when 'figure_caption' then 5 when 'table' then 10 else 0 end + 3 * overlap desc, i.item_id) as rn
        from {_ITEMS} i join {_OVERLAP} o on i.paper_id = o.paper_id and i.item_id = o.item_id),
    g as (select paper_id, item_id, rn, case when n <= 10000 then n else 0 end as used, case when n <= 10000 then 1 else 0 end as c, n <= 10000 as kept from r where rn = 1
        union all select r.paper_id, r.item_id, r.rn, g.used + case when g.c < 150 and g.used + r.n <= 10000 then r.n else 0 end, g.c + case when g.c < 150 and g.used + r.n <= 10000 then 1 else 0 end, g.c < 150 and g.used + r.n <= 10000
        from g join r on r.paper_id = g.paper_id and r.rn = g.rn + 1)
    select paper_id, item_id from g where kept)"""

_JS = "replace(to_json({x})::varchar, '/', '/')"
_PACKAGES = f"""(select paper_id, count(*) as evidence_count, '{{"paper_id":' || to_json(paper_id) || ',"evidence_count":' || count(*) || ',"evidence":[' || string_agg('{{"id":' || to_json(item_id) || ',"type":' || coalesce(to_json(item_type), 'null') || ',"section":' || coalesce(to_json(section_path), 'null')
        || ',"page":' || coalesce(page::varchar, 'null') || ',"coords":null,"text":' || to_json(coalesce(item_text, '')) || '}}', ',' order by item_id) || ']}}' as package
    from {_CHOSEN} c join {_ITEMS} i using (paper_id, item_id) group by 1)"""
_OFFSETS = f"""(select paper_id, item_id, item_text, cast(e - n as int) as start, cast(e as int) as end from (select paper_id, item_id, item_text, length(item_text) as n, sum(length(item_text) + 2) over (partition by paper_id order by item_id rows between unbounded preceding and current row) - 2 as e from {_ITEMS} where item_text <> ''))"""

_PAGES = """(select report_id, paper_id, p.page as page, coalesce(p.page_text, '') as page_text from (select report_id, paper_id, unnest(page_texts) as p from coverage_reports))"""

_METRICS = f"""
    with pages as {_PAGES},
    native as (select a.report_id, a.page, length(a.page_text) as own, coalesce(sum(length(b.page_text)) + count(b.page_text) - 1, 0) as native
        from pages a left join pages b on a.paper_id = b.paper_id and a.page = b.page and a.report_id <> b.report_id group by 1, 2, 3),
    per as (select report_id, count(*) filter (own < 100 and native > 100) as short_pages, avg(own / native) filter (native > 0) as ratio from native group by 1),
    blocks as (select paper_id, avg(case when coords is null and page is null then 1.0 else 0.0 end) as missing from {_ITEMS} group by 1),
    capt as (select report_id, bool_or(contains(lower(i.item_text), lower(ref))) as captioned from (select report_id, paper_id, unnest(list_distinct(regexp_extract_all(full_pdf_text, '\\b(?:Table|Figure)\\s+\\d+'))) as ref from coverage_reports) r join {_ITEMS} i using (paper_id) group by 1),
    sent as (select report_id, [coalesce(s.sentence, '') for s in sentence_records] as ss, coalesce(full_pdf_text, '') as t from coverage_reports),
    facts as (select r.report_id, coalesce(short_pages, 0) as short_pages, coalesce(ratio, 1.0) as ratio, coalesce(missing, 0.0) as missing, coalesce(captioned, false) as captioned, t,
        case when len(ss) > 0 then len(list_filter(ss, lambda s: len(list_filter(string_split({_collapse('s')}, ' '), lambda w: w <> '')) > 120)) / len(ss) else 0.0 end as long_share,
        case when len(ss) > 0 then len(list_filter(ss, lambda s: regexp_matches(lower(s), 'references|bibliography|et al\\.|\\[1\\]|\\(1\\)'))) / len(ss) else 0.0 end as leak,
        (case when contains(lower(t), 'abstract') then 1 else 0 end) + (case when contains(lower(t), 'introduction') then 1 else 0 end) + (case when contains(lower(t), 'methods') then 1 else 0 end) + (case when contains(lower(t), 'results') then 1 else 0 end) as present,
        len(regexp_extract_all(t, '\\b(?:Table|Figure)\\s+\\d+')) as refs,
        case when length(t) > 0 then length(regexp_replace(t, '[\\t\\n\\r\\x20-\\x7f]', '', 'g')) / length(t) else 0.0 end as weird
        from coverage_reports r join sent using (report_id) left join per using (report_id) left join blocks using (paper_id) left join capt using (report_id))
    select report_id, metric_name, round(cast(v as double), 9) as computed_value, cast(th as double) as threshold, fired as triggered from (
        select report_id, unnest([
            {{'metric_name': 'min_chars_per_page', 'v': cast(short_pages as double), 'th': 100.0, 'fired': short_pages > 0}},
            {{'metric_name': 'extraction_coverage_ratio', 'v': cast(ratio as double), 'th': 0.6, 'fired': ratio < 0.6}},
            {{'metric_name': 'long_sentence_fraction', 'v': cast(long_share as double), 'th': 0.12, 'fired': long_share > 0.12}},
            {{'metric_name': 'section_coverage', 'v': cast(present as double), 'th': 4.0, 'fired': t <> '' and present < 4}},
            {{'metric_name': 'caption_table_figure_coverage', 'v': cast(refs as double), 'th': null, 'fired': refs > 0 and not captioned}},
            {{'metric_name': 'coordinate_availability', 'v': cast(missing as double), 'th': 0.1, 'fired': missing > 0.1}},
            {{'metric_name': 'references_in_body', 'v': cast(leak as double), 'th': 0.05, 'fired': leak > 0.05}},
            {{'metric_name': 'weird_char_ratio', 'v': cast(weird as double), 'th': 0.05, 'fired': weird > 0.05}}], recursive := true) from facts)
"""


_CUT = "list_filter([" + _collapse("y") + " for y in string_split(regexp_replace(full_pdf_text, '([.!?])" + _S + "+', '\\1' || chr(1), 'g'), chr(1))], lambda w: w <> '')"
_SENTENCES = f"""(select report_id, ord, {_collapse("s")} as sentence from (select report_id, unnest(l) as s, generate_subscripts(l, 1) as ord from (select report_id, {_CUT} as l from coverage_reports where full_pdf_text is not null)))"""
#: Every two reports with text of a paper.
_PAIRS = "(select a.report_id || '|' || b.report_id as reports, a.report_id as a, b.report_id as b from coverage_reports a join coverage_reports b on a.paper_id = b.paper_id and a.report_id < b.report_id where a.full_pdf_text is not null and b.full_pdf_text is not null)"


_W = r"\pL\pM\p{Nd}\p{Pc}"
_BLOCKS = f"""(select report_id, paper_id, source, block_index, text, case when regexp_matches(text, '^{_S}*\\[?\\p{{Nd}}+\\]?{_S}+[{_W}]') then 'other' when regexp_matches(regexp_replace(text, '^{_S}+|{_S}+$', '', 'g'), '^(?:\\d+[.\\d]*\\s+)?[A-Z][A-Za-z\\s]{{1,49}}[A-Za-z]$') then 'section' else 'paragraph' end as kind
    from (select report_id, paper_id, source, unnest(l) as text, generate_subscripts(l, 1) - 1 as block_index from (select *, list_filter(string_split(regexp_replace(full_pdf_text, '\\n[ \\t\\n\\x0B\\f\\r]*\\n', chr(1), 'g'), chr(1)), lambda x: trim(x) <> '') as l from coverage_reports where full_pdf_text is not null)))"""
_CLEAN = "regexp_replace(needle, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x{FFFD}]', '', 'g')"


_ROUTING = f"""with c as (select page_id, paper_id, case when blank then [1] else list_filter([case when n_words < 50 then 2 end, case when alpha < 0.6 then 3 end, case when font_count = 0 then 4 end, case when image > 0.85 then 5 end], lambda x: x is not null) end as st
            from (select *, regexp_replace(t, '{_S}+', '', 'g') = '' as blank, len(list_filter(string_split({_collapse('t')}, ' '), lambda w: w <> '')) as n_words,
                case when length(cl) > 0 then length(regexp_replace(cl, '\\PL', '', 'g')) / length(cl) else 0.0 end as alpha, case when page_area > 0 then image_area / page_area else 0.0 end as image
                from (select *, coalesce(page_text, '') as t, regexp_replace(regexp_replace(coalesce(page_text, ''), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x{{FFFD}}]', '', 'g'), '{_S}', '', 'g') as cl from page_texts)))
        select page_id, len(st) = 0 as is_native, array_to_string(st, ',') as stages, case when len(st) = 0 then 'native' else 'ocr' end as selected_extractor,
            case when len(st) = 0 then case when max(case when len(st) > 0 then 1 else 0 end) over (partition by paper_id) = 1 then 'mixed_native_page' else 'all_native' end
                when st[1] = 1 then 'stage_1_empty_text' else 'stages_' || array_to_string(st, '_') end as reason from c"""


ORACLE_SQL = {
    "coverage_metrics": _METRICS,
    "branch_status": f"""select report_id, case when sum(cast(triggered as int)) / count(*) <= 0.5 then 'pass' else 'fail' end as status, sum(cast(triggered as int)) between 1 and 2 as borderline, cast(sum(cast(triggered as int)) as bigint) as n_triggered from ({_METRICS}) group by 1""",
    "adjudicated": """select paper_id, source as primary_source, passes / total as confidence from (
        select paper_id, source, passes, sum(n) over (partition by paper_id) as total, row_number() over (partition by paper_id order by passes desc, first_seen) as rn
        from (select paper_id, source, count(*) filter (status = 'pass') as passes, count(*) as n, min(report_id) as first_seen from coverage_reports group by 1, 2)) where rn = 1""",
    "pairwise_agreement": """select a.report_id as report_a, b.report_id as report_b, case when coalesce(a.status, 'none') = coalesce(b.status, 'none') then 1.0::double else 0.0::double end as agreement
        from coverage_reports a join coverage_reports b on a.paper_id = b.paper_id and a.report_id < b.report_id""",
    "exact_agreement": f"""select reports, cast(sum(na) as bigint) as n_primary, cast(sum(nb) as bigint) as n_candidate, cast(sum(least(na, nb)) as bigint) as n_exact, case when sum(na) > 0 then sum(least(na, nb)) / sum(na) else 0.0 end as agreement_rate
        from (select reports, sentence, count(*) filter (side = 0) as na, count(*) filter (side = 1) as nb from (select reports, sentence, 0 as side from {_PAIRS} p join {_SENTENCES} s on s.report_id = p.a union all select reports, sentence, 1 from {_PAIRS} p join {_SENTENCES} s on s.report_id = p.b) group by 1, 2) group by 1""",
    "zipped_sentences": f"""with n as (select report_id, sentence, row_number() over (partition by report_id order by ord) as place from {_SENTENCES})
        select reports, cast(x.place as int) as place, x.sentence as left_sentence, y.sentence as right_sentence from {_PAIRS} p join n x on x.report_id = p.a join n y on y.report_id = p.b and x.place = y.place""",
    "page_routing": _ROUTING,
    "page_summary": """select paper_id, count(*) as n_pages, string_agg(page_text, chr(10) order by page_index) as full_text from (select distinct on (paper_id, page_index) * from page_texts where page_text is not null and page_text <> '') group by 1""",
    "preceding_section": f"""with h as (select paper_id, page, arg_max(section_path, item_id) as section_path from {_ITEMS} where section_path is not null and page is not null group by 1, 2),
        p as (select distinct paper_id, page_index + 1 as page from annotations where page_index is not null and paper_id is not null)
        select p.paper_id, p.page, h.section_path from p asof left join h on p.paper_id = h.paper_id and p.page >= h.page""",
    "noise_sentences": f"select paper_id, item_id from {_ITEMS} where {_NOISE}",
    "numbered_items": f"""select paper_id, item_id, letter || lpad(cast(row_number() over (partition by paper_id, letter order by item_id) as varchar), 6, '0') as new_id
        from (select *, case item_type when 'figure_caption' then 'F' when 'table' then 'T' else 'S' end as letter from {_ITEMS})""",
    "carried_sections": f"select paper_id, item_id, last_value(section_path ignore nulls) over (partition by paper_id order by item_id rows between unbounded preceding and current row) as section from {_ITEMS}",
    "section_scores": f"select paper_id, item_id, cast({_score('section_path')} + case item_type when 'figure_caption' then 5 when 'table' then 10 else 0 end as int) as rank_score from {_ITEMS}",
    "evidence_within_budget": f"select paper_id, item_id from {_CHOSEN}",
    "kept_prefix": f"""with run as (select paper_id, item_id, sum(length(item_text)) over (partition by paper_id order by item_id rows between unbounded preceding and current row) as running from {_ITEMS}),
        held as (select distinct paper_id, unnest(loc) as item_id from {_RECORDS} where lower(trim(confidence)) in ('h', 'high'))
        select paper_id, item_id, cast(running as bigint) as running from run left join held using (paper_id, item_id) where running <= 10000 or held.item_id is not null""",
    "provenance": f"""with l as (select record_id, paper_id, unnest(loc) as item_id, generate_subscripts(loc, 1) as pos from {_RECORDS} where paper_id is not null),
        j as (select l.*, i.item_text from l left join {_ITEMS} i on l.paper_id = i.paper_id and l.item_id = i.item_id)
        select r.record_id, coalesce(string_agg(j.item_text, chr(10) order by j.pos) filter (j.item_text <> ''), '') as evidence, count(*) filter (j.item_id is not null and j.item_text is null) as unresolved
        from {_RECORDS} r left join j on r.record_id = j.record_id where r.paper_id is not null group by 1""",
    "unresolved_locations": f"""select distinct l.record_id, l.paper_id, l.item_id from (select record_id, paper_id, unnest([x, regexp_replace(x, '^S', 'F'), regexp_replace(x, '^S', 'T')]) as item_id from (select record_id, paper_id, unnest(loc) as x from {_RECORDS} where paper_id is not null)) l
        where not exists (select 1 from evidence_items i where i.paper_id = l.paper_id and i.item_id = l.item_id)""",
    "annotation_sentences": f"""select n.ann_id, r.report_id, cast(min(r.range_index) as int) as range_index from {_NOTES} n join (select paper_id, report_id, unnest(sentence_to_char_range) as r, generate_subscripts(sentence_to_char_range, 1) - 1 as range_index from coverage_reports) r
        on n.paper_id = r.paper_id and n.char_start >= r.r.char_start and n.char_start < r.r.char_end and r.r.char_start >= 0 and n.char_start >= 0 group by 1, 2""",
    "sentence_offsets": """select report_id, cast(ord - 1 as int) as ord, case when s is not null then instr(t, s) - 1 end as char_start, case when instr(t, s) > 0 then instr(t, s) - 1 + length(s) else -1 end as char_end
        from (select report_id, coalesce(full_pdf_text, '') as t, unnest([x.sentence for x in sentence_records]) as s, generate_subscripts(sentence_records, 1) as ord from coverage_reports)""",
    "quote_context": f"""select ann_id, report_id, substr(t, greatest(pos - 20, 1), least(pos - 1, 20)) as prefix, substr(t, pos + length(sentence_text), 20) as suffix
        from (select n.ann_id, r.report_id, n.sentence_text, r.full_pdf_text as t, instr(r.full_pdf_text, n.sentence_text) as pos from {_NOTES} n join coverage_reports r on n.paper_id = r.paper_id where r.full_pdf_text is not null and n.sentence_text <> '') where pos > 0""",
    "merged_fields": _MERGED,
    "every_field": f"""select d.paper_id, d.field_index, coalesce(m.merged_value, 'nr') as merged_value from (select p.paper_id, f.field_index from (select distinct paper_id from ({_MERGED})) p, (select distinct field_index from extraction_map) f) d
        left join ({_MERGED}) m on d.paper_id = m.paper_id and d.field_index = m.field_index""",
    "ranked_candidates": f"""select paper_id, field_index, record_id, rk as rank, cast(place as int) as place from (select *, row_number() over (partition by paper_id, field_index order by rk desc, record_id) as place from (select *, {_RANK} as rk from {_RECORDS} where paper_id is not null)) where place <= 5""",
    "flagged_fields": f"select record_id, paper_id, field_index, lower(trim(confidence)) as confidence from {_RECORDS} where lower(trim(confidence)) in ('l', 'nr')",
    "not_reported": f"""select field_index, field_name, count(*) as n_missing, count(*) * 100.0 / (select count(distinct paper_id) from field_records) as missing_rate from {_RECORDS} where extracted_value = 'nr' group by 1, 2 order by n_missing desc, field_index, field_name limit 10""",
    "wide_export": f"""select paper_id, string_agg(v, '|' order by field_index) as row_text from (select p.paper_id, m.field_index, coalesce(l.extracted_value, '') as v from (select distinct paper_id from field_records where paper_id is not null) p cross join extraction_map m
        left join (select paper_id, field_name, arg_max({{'v': extracted_value}}, record_id).v as extracted_value from {_RECORDS} where paper_id is not null group by 1, 2) l on l.paper_id = p.paper_id and l.field_name = m.field_name) group by 1""",
    "record_problems": f"""select record_id, array_to_string(list_filter([case when paper_id is null then 'paper_id' end, case when field_index is null or field_index < 1 then 'field_index' end, case when extracted_value is null then 'extracted_value' end,
        case when confidence is null or lower(trim(confidence)) not in ('h', 'm', 'l', 'nr') then 'confidence' end, case when len(list_filter(coalesce(loc, []), lambda x: not regexp_matches(x, '^[STF]\\d{{6}}$'))) > 0 then 'location' end], lambda x: x is not null), '|') as errors from {_RECORDS}""",
    "stage_summaries": f"""select stage, count(*) as requests, cast(sum(input_tokens) as bigint) as input_tokens, cast(sum(cached_tokens) as bigint) as cached_tokens, cast(sum(output_tokens) as bigint) as output_tokens, round(case when sum(input_tokens) > 0 then sum(cached_tokens) / sum(input_tokens) else 0.0 end, 9) as cache_rate, min(seq) as first_seq from {_USAGE} group by 1""",
    "low_cache": f"select stage, count(*) as requests from {_USAGE} group by 1 having count(*) >= 3 and case when sum(input_tokens) > 0 then sum(cached_tokens) / sum(input_tokens) else 0.0 end * 100 < 50",
    "prefix_drift": f"""select stage, version, count(*) as n, string_agg(cast(prefix as varchar), ',' order by seq) as prefixes from (select stage, version, prefix, min(seq) as seq from {_USAGE} group by 1, 2, 3) group by 1, 2 having count(*) > 1""",
    "usage_totals": f"""select case when count(*) = 0 then 'telemetry_unavailable' else 'ok' end as status, cast(sum(input_tokens) as bigint) as input_tokens, cast(sum(output_tokens) as bigint) as output_tokens, round(sum(cached_tokens) / sum(input_tokens), 9) as cache_rate, round(sum(output_tokens) / sum(input_tokens), 9) as output_ratio from {_USAGE}""",
    "expensive_requests": f"select seq, input_tokens + output_tokens as total from {_USAGE} order by total desc, seq limit 5",
    "pending_papers": """select distinct paper_id from papers p where not exists (select 1 from papers m where m.paper_id = p.paper_id and m.status = 'complete' and m.n_pages > 2 and m.pdf_content_hash = p.pdf_content_hash and m.model_id = p.model_id)""",
    # The chunks as they are to be, domain by domain: for 3 and 5 chunks as fixed, for 4 and 8 the twelve first ones shared out evenly.
    "chunk_ranges": """select m.chunks, m.chunk, min(field_index) as lo, max(field_index) as hi, count(*) as n_fields
        from (select 3 as chunks, unnest([1, 1, 1, 1, 1, 2, 2, 2, 2, 2, 2, 2, 3]) as chunk, unnest(range(1, 14)) as domain union all select 5, unnest([1, 1, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 5]), unnest(range(1, 14))
            union all select 4, unnest([1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3, 4]), unnest(range(1, 14)) union all select 8, unnest([1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 7, 8]), unnest(range(1, 14))) m
        join extraction_map f on cast(split_part(f.domain_group, '.', 1) as int) = m.domain group by 1, 2""",
    "chunk_fields": """with c as (select field_index, [1, 1, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 5][cast(split_part(domain_group, '.', 1) as int)] as chunk from extraction_map), r as (select chunk, min(field_index) as lo, max(field_index) as hi from c group by 1)
        select r.chunk, f.field_index from r join extraction_map f on f.field_index between r.lo and r.hi""",
    "budget_checks": f"""select paper_id, i.stage, estimate, cast(coalesce(budget_limit, 100000) as int) as budget_limit, estimate <= coalesce(budget_limit, 100000) as within_budget
        from (select paper_id, stage, length(string_agg(coalesce(item_text, ''), chr(10) || chr(10))) // 4 as estimate from {_ITEMS} group by 1, 2) i left join stage_budgets b on i.stage = b.stage""",
    "lexical_checks": f"""with n as (select check_id, paper_id, source, {_fold('needle')} as n1, {_bare('needle')} as n2 from (select distinct on (check_id) * from presence_checks)),
        t as (select paper_id, source, {_fold("coalesce(full_pdf_text, '')")} as t1, {_bare("coalesce(full_pdf_text, '')")} as t2 from coverage_reports),
        s as (select check_id, max(coalesce(case when length(n1) >= 10 and contains(t1, n1) then 1.0 when length(n1) >= 10 and n2 <> '' and contains(t2, n2) then 0.9 else 0.0 end, 0.0)) as c from n left join t using (paper_id, source) group by 1)
        select check_id, cast(c as double) as confidence, c > 0 as found, case when c > 0 then 'verified' else 'no_match' end as status from s""",
    "nearest_vectors": """select query_id, vec_id, round(d, 6) as score from (select q.vec_id as query_id, v.vec_id, list_dot_product(q.embedding::double[], v.embedding::double[]) as d,
        row_number() over (partition by q.vec_id order by list_dot_product(q.embedding::double[], v.embedding::double[]) desc, v.vec_id) as rn from embeddings q join embeddings v on v.vec_id <> q.vec_id where q.vec_id % 100 = 0) where rn = 1""",
    "file_years": "select paper_id, nullif(regexp_extract(source_pdf, '(?:19|20)\\d{2}'), '') as year from papers",
    "pending_by_identity": """select distinct paper_id from papers p where not exists (select 1 from papers m where m.paper_id = p.paper_id and m.status = 'complete' and m.n_pages > 2 and m.pdf_content_hash = p.pdf_content_hash and m.model_id = p.model_id
        and (m.lang = 'en' or coalesce(p.route, '') = 'other'))""",
    "evidence_packages": f"select paper_id, cast(evidence_count as int) as evidence_count, length(package) as n_chars, sha256(package) as digest from {_PACKAGES}",
    "evidence_reduction": f"""select p.paper_id, round(case when t.n > 0 then greatest(0.0, 1 - length(p.package) / t.n) else 0.0 end, 9) as reduction from {_PACKAGES} p join (select paper_id, sum(coalesce(length(item_text), 0)) as n from {_ITEMS} group by 1) t using (paper_id)""",
    "item_offsets": f"select paper_id, item_id, start, \"end\" from {_OFFSETS}",
    "keyword_overlaps": f"select paper_id, item_id, cast(overlap as int) as overlap from {_OVERLAP}",
    "enriched_quantities": f"""with o as {_OFFSETS}, a as (select paper_id, unnest(range(0, cast(e + 1 as bigint), 997)) as at from (select paper_id, max("end") as e from o group by 1)),
        g as (select o.paper_id, o.item_id, count(*) as n from a join o on a.paper_id = o.paper_id and a.at >= o.start and a.at < o."end" group by 1, 2)
        select i.paper_id, i.item_id, cast(coalesce(g.n, len(regexp_extract_all(i.item_text, '{QUANTITY}')), 0) as int) as n_found, case when g.n is not null then 'service' when len(regexp_extract_all(i.item_text, '{QUANTITY}')) > 0 then 'heuristic' else '' end as source
        from {_ITEMS} i left join g on i.paper_id = g.paper_id and i.item_id = g.item_id""",
    "service_annotations": """select distinct candidate_id, coalesce(nullif(source, ''), nullif(payload, ''), '') as text, 'entity' as type, case when cand_index is not null then greatest(0.0, least(1.0, cand_index / 2.0)) end as confidence, status as state from candidates""",
    "chunk_errors": f"""with r as (select paper_id, domain_group as chunk, record_id, field_index, extracted_value, loc, trim(confidence) as c, row_number() over (partition by paper_id, domain_group order by record_id) - 1 as pos from {_RECORDS} where paper_id is not null and domain_group is not null and field_index is not null),
        e as (select paper_id, chunk, pos, case when extracted_value is null or loc is null or c is null then 'missing_keys' when c not in ('h', 'm', 'l', 'nr') then 'confidence'
            when exists (select 1 from (select unnest(loc) as x) u where x not in (select item_id from evidence_items v where v.paper_id = r.paper_id)) then 'unknown_location' end as rule from r),
        f as (select paper_id, chunk, arg_min(pos || ':' || rule, pos) filter (rule is not null) as first from e group by 1, 2), n as (select paper_id, chunk, count(*) as n, count(distinct field_index) as want from r group by 1, 2)
        select n.paper_id, n.chunk, case when n.chunk % 5 = 0 then 'parse' when n.n <> n.want then 'count' else f.first end as error from n join f on n.paper_id = f.paper_id and n.chunk = f.chunk""",
    "reconstructed_fields": f"""select r.record_id as key, r.field_index, m.domain_group, m.field_name, r.extracted_value, coalesce((select string_agg(i.item_text, chr(10) order by l.pos) from (select unnest(r.loc) as x, generate_subscripts(r.loc, 1) as pos) l join {_ITEMS} i on i.paper_id = r.paper_id and i.item_id = l.x where i.item_text <> ''), '') as evidence, r.confidence
        from {_RECORDS} r join extraction_map m using (field_index) where r.paper_id is not null""",
    "cross_references": f"""select record_id, coalesce(array_to_string([case when field_index is null then 'field_index=null' else 'field_index=' || field_index end || ' | location_metadata[' || (i - 1) || '].id=' || loc[i] for i in range(1, len(loc) + 1) if loc[i] <> loc[1]], chr(10)), '') as errors from {_RECORDS}""",
    "record_messages": f"""select record_id, array_to_string(list_filter([case when field_index is null then 'path=$.field_index | is required' end, case when domain_group is null then 'path=$.domain_group | is required' end, case when field_name is null then 'path=$.field_name | is required' end,
        case when extracted_value is null then 'path=$.extracted_value | is required' end, case when confidence is null then 'path=$.confidence | is required' end, case when confidence not in ('h', 'm', 'l', 'nr') then 'path=$.confidence | is none of the values' end, case when domain_group < 1 then 'path=$.domain_group | is less than 1' end,
        case when field_index < 1 then 'path=$.field_index | is less than 1' end, case when length(field_name) < 1 then 'path=$.field_name | is too short' end, case when len(list_filter(loc, lambda x: not regexp_matches(x, '^[STF]\\d{{6}}$'))) > 0 then 'path=$.loc | has an item that does not match' end], lambda x: x is not null), chr(10)) as messages from {_RECORDS}""",
    "prompt_mitigation": f"""with recursive i as (select paper_id, stage, item_id, coalesce(length(item_text), 0) as n, row_number() over (partition by paper_id, stage order by item_id) as place from {_ITEMS}),
        p as (select i.paper_id, i.stage, item_id, place, sum(n) over (partition by i.paper_id, i.stage order by item_id rows between unbounded preceding and current row) + (place - 1) * 2 as chars, coalesce(n_pages, 0) * 40 as other, coalesce(budget_limit // 100, 100000) as lim
            from i left join papers q on q.paper_id = i.paper_id left join stage_budgets b on b.stage = i.stage),
        a as (select paper_id, stage, max(chars) as all_chars, max(place) as all_items, max(chars) filter (place <= 20 and ((chars + other) // 4 <= lim or place = 1)) as kept, max(place) filter (place <= 20 and ((chars + other) // 4 <= lim or place = 1)) as kept_items, max(other) as other, max(lim) as lim from p group by 1, 2),
        c as (select *, least(kept, 3000) as cur from a where (all_chars + other) // 4 > lim union all select * replace (cur - greatest(1, cur // 10) as cur) from c where cur > 0 and (cur + other) // 4 > lim),
        d as (select paper_id, coalesce(stage, '') as stage, min(cur) as cur from c group by 1, 2),
        e as (select a.*, case when (all_chars + other) // 4 <= lim then all_chars else d.cur end as fin, case when (all_chars + other) // 4 <= lim then all_items else kept_items end as ni from a left join d on a.paper_id = d.paper_id and coalesce(a.stage, '') = d.stage)
        select paper_id, stage, case when (all_chars + other) // 4 <= lim then 'ok' when (fin + other) // 4 <= lim then 'pruned' else 'rejected' end as status, cast((all_chars + other) // 4 as bigint) as estimate, cast((fin + other) // 4 as bigint) as after, cast(ni as int) as n_items, cast(fin as bigint) as chars, cast(lim as int) as budget_limit from e""",
    "stage_limits": "select stage, cast(case when stage = 'synthesis' then 120000 else budget_limit end as int) as budget_limit from stage_budgets",
    "prompt_sections": """select field_index, 'system,evidence,alpha,zeta' as sections, (select string_agg(name || ':' || tok, ',' order by tok desc, name) from (select * from (values ('zeta', coalesce(length(definition), 0) // 4), ('evidence', coalesce(length(reviewer_question), 0) // 4), ('system', coalesce(length(field_name), 0) // 4), ('alpha', coalesce(length(format), 0) // 4)) v(name, tok) order by tok desc, name limit 3)) as top from extraction_map""",
    "block_kinds": f"select report_id, cast(block_index as int) as block_index, kind, case kind when 'section' then 'sections' when 'paragraph' then 'paragraphs' else 'references' end as layer from {_BLOCKS}",
    "paired_blocks": f"""with k as (select report_id, kind, text, row_number() over (partition by report_id, kind order by block_index) as place from {_BLOCKS} where kind <> 'other')
        select reports, x.kind, cast(x.place as int) as place, x.text as primary_text, y.text as secondary_text from {_PAIRS} p join k x on x.report_id = p.a join k y on y.report_id = p.b and x.kind = y.kind and x.place = y.place""",
    "block_segments": f"select report_id, cast(block_index as int) as block_index, 'seg-' || (row_number() over (partition by report_id order by block_index) - 1) as segment_id from {_BLOCKS}",
    "block_pages": f"select paper_id, cast(coalesce(page - 1, 0) as int) as page_index, string_agg(coalesce(item_text, ''), chr(10) order by item_id) as text, count(*) as block_count from {_ITEMS} group by 1, 2",
    "merged_pages": f"""with c as (select distinct on (paper_id, page_index) paper_id, page_index, page_id, source, is_native from page_texts join ({_ROUTING}) r using (page_id) order by page_id)
        select p.paper_id, p.page_index, p.page_id as block_index, cast(row_number() over (partition by p.paper_id order by p.page_index, p.page_id) - 1 as int) as ord from page_texts p join c on p.paper_id = c.paper_id and p.page_index = c.page_index where (p.source <> 'paddleocr') = c.is_native""",
    "char_ranges": """select report_id, cast(ord - 1 as int) as ord, instr(t, s) - 1 as start, case when instr(t, s) > 0 then instr(t, s) - 1 + length(s) else -1 end as end, instr(t, s) = 0 as one_engine_only
        from (select report_id, coalesce(full_pdf_text, '') as t, unnest([x.sentence for x in sentence_records]) as s, generate_subscripts(sentence_records, 1) as ord from coverage_reports) where s is not null""",
    "checks_until_verified": """with c as (select distinct paper_id, check_id as ord, coalesce(status = 'verified', false) as verified from presence_checks where paper_id is not null)
        select * from c where not exists (select 1 from c d where d.paper_id = c.paper_id and d.verified and d.ord < c.ord)""",
    "check_statuses": "select distinct check_id, case when not source <> 'paddleocr' then 'degraded' when score >= 0.95 then 'candidate_match' else 'no_match' end as status from presence_checks",
    "median_sizes": f"select paper_id, median(cast(score as double)) as median_size from {_ITEMS} where page is not null and score is not null group by 1",
    "found_locations": f"""with s as (select * from {_ITEMS} where page is not null), m as (select paper_id, median(cast(score as double)) as md from s group by 1), h as (select s.paper_id, s.page, s.item_id, trim(coalesce(section_path, '')) as t from s join m using (paper_id) where score >= md + 2.0),
        n as (select distinct paper_id, page_index as page from annotations where paper_id is not null and page_index is not null), f as (select n.paper_id, n.page, coalesce(arg_max(h.t, h.item_id), '') as t from n left join h on h.paper_id = n.paper_id and h.page <= n.page group by 1, 2)
        select paper_id, page, 'P.1 ' as claimed, l as found_location, lower(trim(l)) <> 'p.1' as drift from (select *, case when t <> '' then 'p.' || (page + 1) || ' — ' || t else 'p.' || (page + 1) end as l from f)""",
    "line_pages": """select paper_id, page_index, string_agg(t, chr(10) order by k) as text, round(10 * 0.48, 6) as x0, round(min(k * 20.0) * 0.48, 6) as y0, round(max(10.0 + length(t)) * 0.48, 6) as x1, round(max(k * 20.0 + 18.0) * 0.48, 6) as y1, round(coalesce(avg(ocr_confidence), 0.0), 6) as confidence
        from (select paper_id, page_index, ocr_confidence, unnest(l) as t, generate_subscripts(l, 1) - 1 as k from (select *, string_split(page_text, chr(10)) as l from (select distinct on (paper_id, page_index) * from page_texts where source = 'paddleocr'))) where t <> '' group by 1, 2""",
    "joined_spans": f"""select paper_id, item_id as line_index, string_agg(case when k = 0 then '' when k % 3 = 0 then ' ' when gap > greatest(0, case when pl > 0 then w / pl / 4 else 1.0 end) then ' ' else '' end || t, '' order by k) as text
        from (select paper_id, item_id, t, k, (k - 1) % 2 as gap, 100 - (k - 1) % 2 as w, lag(length(t)) over (partition by paper_id, item_id order by k) as pl from (select paper_id, item_id, unnest(l) as t, generate_subscripts(l, 1) - 1 as k from (select *, string_split(section_path, ' ') as l from {_ITEMS} where section_path is not null))) group by 1, 2""",
    "croppable_items": f"select paper_id, item_id from {_ITEMS} where item_type in ('figure_caption', 'table') and len(coords) = 4 and page > 0",
    "lexical_places": f"""with n as (select check_id, paper_id, source, {_fold('needle')} as n1 from (select distinct on (check_id) * from presence_checks)),
        p as (select report_id, paper_id, source, page, {_fold('t')} as t from (select report_id, paper_id, source, x.page as page, coalesce(x.page_text, '') as t from (select *, unnest(page_texts) as x from coverage_reports))),
        h as (select check_id, page, instr(t, n1) - 1 as o, t, n1, row_number() over (partition by check_id order by report_id, page) as rn from n join p using (paper_id, source) where length(n1) >= 10 and contains(t, n1))
        select check_id, page, cast(o as int) as offset, substr(t, greatest(o - 63, 1), least(o, 64)) as before, substr(t, o + length(n1) + 1, 64) as after from h where rn = 1""",
    "normalised_vectors": """select vec_id, round(case when n > 0 then 1.0 else 0.0 end, 9) as squares, round(case when n > 0 then embedding[1]::double / n else embedding[1]::double end, 9) as first from (select *, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n from embeddings)""",
    "near_vectors": """with v as (select vec_id, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n from embeddings)
        select query_id, vec_id, round(d, 6) as score from (select q.vec_id as query_id, v.vec_id, list_dot_product(q.e, v.e) / q.n / v.n as d, row_number() over (partition by q.vec_id order by list_dot_product(q.e, v.e) / q.n / v.n desc, v.vec_id) as rn from v q join v on v.vec_id <> q.vec_id where q.vec_id % 100 = 0) where rn = 1 and d >= 0.3""",
    "run_delta": f"""with t as (select seq % 2 as k, count(*) as n, sum(input_tokens) as i, sum(cached_tokens) as c, sum(output_tokens) as o from {_USAGE} group by 1)
        select round(a.c / a.i - b.c / b.i, 9) as cache_rate_change, round((a.i - a.c) / a.n - (b.i - b.c) / b.n, 6) as uncached_change, cast(a.i + a.o - b.i - b.o as bigint) as tokens_change from t a, t b where a.k = 0 and b.k = 1""",
    "resolved_years": """with f as (select paper_id, arg_min({'t': page_text}, page_id).t as first from page_texts where page_index = 0 group by 1),
        y as (select p.paper_id, case when n_pages = 3 then strftime(ingested_at, '%Y') end as h, case when n_pages = 4 then strftime(ingested_at, '%Y') end as m, nullif(regexp_extract(substr(coalesce(first, ''), 1, 2000), '(?:19|20)\\d{2}'), '') as p, nullif(regexp_extract(source_pdf, '(?:^|[_\\-\\s.])((?:19|20)\\d{2})(?:[_\\-\\s.]|$)', 1), '') as n from papers p left join f using (paper_id))
        select paper_id, coalesce(h, m, p, n, 'nr') as year, case when h is not null or m is not null then 'h' when p is not null then case when n = p then 'h' else 'm' end when n is not null then 'm' else 'nr' end as confidence,
            case when h is not null then 'tei_header' when m is not null then 'pdf_metadata' when p is not null then 'first_page_text' when n is not null then 'filename_pattern' else '' end as provenance from y""",
    "item_keywords": f"""select paper_id, item_id, array_to_string(list_filter(string_split({_collapse('item_text')}, ' '), lambda w: w <> '' and lower(w) not in ({", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS)})), ' ') as keywords from {_ITEMS}""",
    "short_hashes": "select paper_id, 'pdf:' || substr(sha256(source_pdf), 1, 16) as cache_key from papers",
    "folded_needles": f"select check_id, {_fold('needle')} as plain, {_bare('needle')} as bare, {_collapse(_CLEAN)} as clean from (select distinct on (check_id) * from presence_checks)",
    "evidence_types": f"select item_type, count(*) as n from {_ITEMS} group by 1",
    "payload_labels": """select candidate_id, case when json_valid(t) and json_type(t) = 'OBJECT' then json_extract_string(t, '$.label') end as label from (select distinct candidate_id, trim(coalesce(payload, ''), chr(32) || chr(9) || chr(10) || chr(13)) as t from candidates)""",
    "nfkc_texts": None,
    "text_functions": f"""select paper_id, item_id, {_collapse('item_text')} as collapsed, length(item_text) // 4 as tokens, cast(len({_words('item_text')}) as int) as n_words, length(regexp_replace(item_text, '[\\t\\n\\r\\x20-\\x7f]', '', 'g')) as n_weird,
        case when length({_collapse('item_text')}) <= 200 then {_collapse('item_text')} else case when contains(substr({_collapse('item_text')}, 1, 200), ' ') then regexp_extract(substr({_collapse('item_text')}, 1, 200), '(?s)^(.+) [^ ]*$', 1) else substr({_collapse('item_text')}, 1, 200) end end as snippet,
        cast(len(regexp_extract_all(item_text, '{QUANTITY}')) as int) as n_quantities, array_to_string(list_slice(regexp_extract_all(regexp_replace(item_text, '[ªµº\\x{{C0}}-\\x{{24F}}\\x{{370}}-\\x{{1FFF}}\\x{{3040}}-\\x{{D7FF}}]', '_', 'g'), '{ENTITY}'), 1, 10), '|') as entities,
        cast(len(list_filter(string_split(regexp_replace(item_text, '([.!?])' || '{_S}' || '+', '\\1' || chr(1), 'g'), chr(1)), lambda w: regexp_replace(w, '{_S}', '', 'g') <> '')) as int) as n_sentences from {_ITEMS}""",
    "merged_with_malformed": f"""select m.paper_id, m.field_index, case when b.bad then null else merged_value end as merged_value, case when b.bad then 'nr' else merged_confidence end as merged_confidence, case when b.bad then '' else locations end as locations, conflict or b.bad as conflict, n_values
        from ({_MERGED}) m join (select paper_id, field_index, bool_or(loc is null) as bad from {_RECORDS} group by 1, 2) b on m.paper_id = b.paper_id and m.field_index = b.field_index""",
    "papers_without_conflict": f"select paper_id, count(*) filter (conflict) = 0 as skipped_synthesis, count(*) filter (conflict) as n_conflicts from ({_MERGED}) group by 1",
    "conflict_candidates": f"""with r as (select * from (select *, row_number() over (partition by paper_id, field_index order by {_RANK} desc, record_id) as place from {_RECORDS} where paper_id is not null) where place <= 5),
        t as (select record_id, coalesce((select string_agg(i.item_text, chr(10) order by l.pos) from (select unnest(r.loc) as x, generate_subscripts(r.loc, 1) as pos) l join {_ITEMS} i on i.paper_id = r.paper_id and i.item_id = l.x where i.item_text <> ''), '') as t from r)
        select r.paper_id, r.field_index, r.record_id, cast(place as int) as place, field_name, extracted_value as value, coalesce(array_to_string(loc, ','), '') as evidence_ids,
            case when length(t) <= 200 then t when contains(substr(t, 1, 200), ' ') then regexp_extract(substr(t, 1, 200), '(?s)^(.+) [^ ]*$', 1) else substr(t, 1, 200) end as snippet
        from r join t using (record_id) join ({_MERGED}) m on m.paper_id = r.paper_id and m.field_index = r.field_index where m.conflict""",
    "synthesis_fields": f"""select paper_id, field_index from (select distinct paper_id from ({_MERGED})) p cross join (select field_index from extraction_map where cast(split_part(domain_group, '.', 1) as int) = 12) f union select paper_id, field_index from ({_MERGED}) where conflict""",
    "prefilled_fields": "select paper_id, field_index, field_name, v as extracted_value, case when v = 'nr' then 'nr' else 'h' end as confidence from (select paper_id, 1 as field_index, coalesce(nullif(lang, ''), 'nr') as v from papers union all select paper_id, 2, coalesce(nullif(regexp_extract(source_pdf, '(?:19|20)\\d{2}'), ''), 'nr') from papers) join extraction_map using (field_index)",
    "left_to_ask": """select p.paper_id, m.field_index from papers p cross join extraction_map m where not (m.field_index = 1 and coalesce(p.lang, '') not in ('', 'nr')) and not (m.field_index = 2 and regexp_matches(p.source_pdf, '(?:19|20)\\d{2}'))""",
    "protected_items": f"""select distinct paper_id, item_id from (select paper_id, unnest(string_split(locations, ',')) as item_id from ({_MERGED}) where merged_confidence = 'h' and locations <> '' union all select paper_id, unnest(loc) from {_RECORDS} where paper_id is not null and lower(trim(confidence)) = 'h')""",
    "report_totals": f"select count(distinct paper_id) as n_papers, count(*) as n_fields, count(*) filter (lower(trim(confidence)) in ('l', 'nr')) as n_flagged, count(*) filter (extracted_value = 'nr') as n_missing from {_RECORDS}",
    "sentence_rows": f"""with h as (select paper_id, item_id, trim(regexp_replace(regexp_replace(list_reduce(string_split(coalesce(item_text, ''), chr(10)), lambda a, b: a || case when regexp_matches(b, '^[A-Z\\-*•·]') then chr(10) else ' ' end || b), '\\n{{2,}}', chr(10), 'g'), '[ \\t]+', ' ', 'g')) as t from {_ITEMS} where page is not null),
        s as (select paper_id, item_id, {_collapse("unnest(string_split(regexp_replace(t, '([.!?])" + _S + "+', '\\1' || chr(1), 'g'), chr(1)))")} as item_text from h)
        select paper_id, item_id, item_text as sentence from s where length(item_text) >= 20 and not ({_NOISE})""",
    "points_outside_tables": f"""select paper_id, item_id from {_ITEMS} i where page is not null and len(coords) = 4 and item_type <> 'table' and not exists (select 1 from {_ITEMS} t where t.paper_id = i.paper_id and t.page = i.page and t.item_type = 'table' and len(t.coords) = 4 and i.coords[1] between t.coords[1] and t.coords[3] and i.coords[2] between t.coords[2] and t.coords[4])""",
    "annotation_records": f"""with n as (select paper_id, ann_id as ord, sentence_text as sentence, coalesce(ocr_derived, false) as ocr, case when char_end > 0 then char_start end as s, case when char_end > 0 then char_end end as e from {_NOTES} where paper_id is not null and sentence_text is not null),
        f as (select paper_id, string_agg(sentence, ' ' order by ord) as t from n group by 1), r as (select paper_id, sentence, arg_max(s, ord) as s, arg_max(e, ord) as e from n where s is not null group by 1, 2)
        select n.paper_id, n.ord, n.sentence, case when ocr then 'FragmentSelector' else 'TextPositionSelector' end as selector, case when not ocr then coalesce(r.s, 0) end as start, case when not ocr then coalesce(r.e, 0) end as end, substr(t, greatest(p - 20, 1), least(p - 1, 20)) as prefix, substr(t, p + length(n.sentence), 20) as suffix, case when ocr then 4 end as n_xywh
        from (select n.*, f.t, instr(f.t, n.sentence) as p from n join f using (paper_id)) n left join r on r.paper_id = n.paper_id and r.sentence = n.sentence""",
    "canonical_papers": """select paper_id as key, c as content, sha256(c) as id from (select paper_id, '{"lang":' || coalesce(to_json(lang), 'null') || ',"n_pages":' || coalesce(n_pages::varchar, 'null') || ',"paper_id":' || to_json(paper_id) || '}' as c from papers)""",
    "response_log": "select distinct candidate_id, substr(payload, 1, 12) as preview, length(payload) as n_chars, sha256(payload) as sha256 from candidates",
    "branch_scores": f"""with b as (select report_id, r.paper_id, r.source, coalesce(full_pdf_text, '') as t, coalesce(r.status, '') = 'fail' or trim(coalesce(full_pdf_text, '')) = '' as failed, n_pages,
            len(list_filter(coalesce(page_texts, []), lambda p: trim(coalesce(p.page_text, '')) <> '')) as filled from coverage_reports r left join papers p using (paper_id)),
        w as (select report_id, paper_id, unnest(list_distinct({_words('lower(t)')})) as w from b), n as (select paper_id, w, count(*) as n from w group by 1, 2), k as (select paper_id, count(distinct report_id) as k from w group by 1),
        a as (select w.report_id, case when max(k.k) = 1 then 1.0 else count(*) filter (n.n > 1) / count(*) end as agreement from w join n on n.paper_id = w.paper_id and n.w = w.w join k on k.paper_id = w.paper_id group by 1),
        s as (select b.*, round(case when failed then 0.0 else 0.30 + 0.25 * case when n_pages > 0 then least(filled / n_pages, 1.0) else 0.0 end
            + 0.10 * case when regexp_matches(t, '(?m)^[\\s\\x0B]*\\d+\\.?[\\s\\x0B]+[A-Z]') or regexp_matches(t, '(?m)^[\\s\\x0B]*[A-Z][A-Z ]{{3,}}[\\s\\x0B]*$') or regexp_matches(t, '(?im)^[\\s\\x0B]*(?:Abstract|Introduction|Methods|Results|Discussion|Conclusion|References)\\b') then 1 else 0 end
            + 0.10 * case when length(t) between 500 and 200000 then 1 else 0 end + 0.10 * (1.0 - case when length(t) > 0 then (length(t) - length(regexp_replace(t, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x{{FFFD}}\\x{{FFF0}}-\\x{{FFFF}}]', '', 'g'))) / length(t) else 1.0 end)
            + 0.15 * coalesce(agreement, 0.0) end, 9) as composite from b left join a using (report_id))
        select paper_id, report_id, source, cast(composite as double) as composite, cast(row_number() over (partition by paper_id order by composite desc, report_id) as int) as place from s""",
    "spaced_texts": "select paper_id, string_agg(coalesce(page_text, ''), ' ' order by page_index) as full_text from (select distinct on (paper_id, page_index) * from page_texts where page_index is not null) group by 1",
    "final_fields": f"""with m as ({_MERGED}), r as (select *, row_number() over (partition by paper_id, field_index order by case lower(trim(confidence)) when 'h' then 3 when 'm' then 2 when 'l' then 1 when 'nr' then 0 else -1 end desc, record_id) as rn from {_RECORDS} where paper_id is not null and run_stage = 'synthesis')
        select paper_id, field_index, merged_value as value, merged_confidence as confidence from m where not conflict union all select r.paper_id, r.field_index, r.extracted_value, r.confidence from r join m on m.paper_id = r.paper_id and m.field_index = r.field_index where m.conflict and rn = 1""",
    "chunk_choice": f"""with recursive t as (select distinct [1, 1, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 5][cast(split_part(domain_group, '.', 1) as int)] as chunk, unnest(regexp_extract_all(lower(concat_ws(' ', field_name, definition, reviewer_question)), '[a-z]{{4,}}')) as tok from extraction_map),
        o as (select i.paper_id, i.item_id, c.chunk, (select count(*) from t where t.chunk = c.chunk and contains(lower(coalesce(i.item_text, '')), t.tok)) as overlap from {_ITEMS} i, (select distinct chunk from t) c),
        r as (select i.paper_id, o.chunk, i.item_id, coalesce(length(item_text), 0) as n, row_number() over (partition by i.paper_id, o.chunk order by {_score('section_path')} + case item_type when 'figure_caption' then 5 when 'table' then 10 else 0 end + 3 * overlap desc, i.item_id) as rn from {_ITEMS} i join o on i.paper_id = o.paper_id and i.item_id = o.item_id),
        g as (select paper_id, chunk, item_id, rn, case when n <= 3000 then n else 0 end as used, case when n <= 3000 then 1 else 0 end as c, n <= 3000 as kept from r where rn = 1
            union all select r.paper_id, r.chunk, r.item_id, r.rn, g.used + case when g.c < 20 and g.used + r.n <= 3000 then r.n else 0 end, g.c + case when g.c < 20 and g.used + r.n <= 3000 then 1 else 0 end, g.c < 20 and g.used + r.n <= 3000 from g join r on r.paper_id = g.paper_id and r.chunk = g.chunk and r.rn = g.rn + 1)
        select paper_id, chunk, item_id from g where kept""",
    "cached_papers": "select paper_id, coalesce(n_pages % 2 = 1, false) as kept from papers",
    "expected_indices": "select chunk, string_agg(field_index::varchar, ',' order by field_index) as indices from (select field_index, [1, 1, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 5][cast(split_part(domain_group, '.', 1) as int)] as chunk from extraction_map) group by 1",
    "exported_values": f"select record_id, {_bare('extracted_value')} as value from {_RECORDS}",
    "block_sentences": f"""select report_id, cast(block_index as int) as block_index, cast(row_number() over (partition by report_id, block_index order by k) - 1 as int) as ord, s as sentence from (select report_id, block_index, {_collapse('s')} as s, k from (select report_id, block_index, unnest(l) as s, generate_subscripts(l, 1) as k from (select *, string_split(regexp_replace(text, '([.!?])' || '{_S}' || '+', '\\1' || chr(1), 'g'), chr(1)) as l from {_BLOCKS} where kind = 'paragraph'))) where s <> ''""",
    "prompt_texts": """select chunk, 'Read.' || chr(10) || string_agg(concat_ws(' | ', field_index::varchar, field_name, definition, reviewer_question, format, categories_or_examples), chr(10) order by field_index) || chr(10) || 'Answer in JSON.' as prompt
        from (select *, [1, 1, 1, 2, 2, 3, 3, 3, 3, 4, 4, 4, 5][cast(split_part(domain_group, '.', 1) as int)] as chunk from extraction_map) group by 1""",
    "manifests": "select paper_id, case when route = 'native' then 'complete' else status end as status, case when route = 'native' then 'm2' else model_id end as model_id from papers",
    "block_messages": f"""select paper_id, item_id, array_to_string(list_filter([case when item_text is null then 'path=$.text | is required' end, case when page is null then 'path=$.page_index | is required' end, case when page - 2 < 0 then 'path=$.page_index | is less than 0' end, case when item_text = '' then 'path=$.text | is too short' end], lambda x: x is not null), ';') as messages from {_ITEMS}""",
    "first_sentences": f"select report_id, cast(ord - 1 as int) as ord, sentence from (select *, row_number() over (partition by report_id order by ord) as rn from {_SENTENCES}) where rn <= 5",
}
ORACLE_SQL["valid_papers"] = f"select paper_id, bool_and(error is null) as ok, count(*) as n_chunks from ({ORACLE_SQL['chunk_errors']}) group by 1"
ORACLE_SQL = {k: v for k, v in ORACLE_SQL.items() if v}
