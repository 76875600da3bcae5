"""The same queries as plain SQL, written row by row or brute force rather than like the library."""

from __future__ import annotations

from workload.views import T1, with_views

# Helper views of the SQL side only.
O: dict[str, str] = {}

O["folder_parts"] = r"""
select case_key, ok as folder_valid,
       case when ok then regexp_extract(folder_name, pat, 1) end as m1,
       case when ok then regexp_extract(folder_name, pat, 2) end as m2,
       case when ok then regexp_extract(folder_name, pat, 3) end as m3,
       case when ok then regexp_extract(folder_name, pat, 4) end as m4,
       case when ok then regexp_extract(folder_name, pat, 5) end as m5,
       case when ok then regexp_extract(folder_name, pat, 6) end as citizen_id,
       case when ok then regexp_extract(folder_name, pat, 7) end as person_name_raw,
       case when ok then trim(replace(regexp_extract(folder_name, pat, 7), '_', ' ')) end as person_name_display,
       case when ok then regexp_extract(folder_name, pat, 1) end as unit_code
from (select *, regexp_matches(folder_name, pat) as ok
      from (select *, '^([^.]+)\.([^.]+)\.([^.]+)\.([^.]+)\.([^_]+)_([^_]+)_(.+)$' as pat from {folders}) a) b
"""

O["parsed"] = r"""
select relative_path, filename, file_code, file_sequence, file_slug,
       case when file_code is null or file_slug is null then 'MALFORMED_NAME'
            when code is null then 'FILE_NGOAI_TAXONOMY' else 'OK' end as status,
       coalesce(lower(file_slug) = lower(slug), false) as canonical,
       name as catalog_name, priority as catalog_priority, filename_base as catalog_base
from (
  select *, case when coded then parts[1] end as file_code,
         case when coded and numbered then cast(parts[len(parts)] as bigint) end as file_sequence,
         case when coded and not list_contains(slug_parts, '') then array_to_string(slug_parts, '.') end as file_slug
  from (
    select *, parts[2:len(parts) - case when numbered then 1 else 0 end] as slug_parts
    from (
      select *, len(parts) >= 2 and regexp_full_match(parts[1], '[0-9]{2,3}') as coded,
             len(parts) >= 3 and regexp_full_match(parts[len(parts)], '[0-9]+') as numbered
      from (select relative_path, filename, string_split(left(filename, length(filename) - 4), '.') as parts
            from {files}) a) b) c) d
left join {catalog} on code = file_code
"""

O["evidence_n"] = """
select coalesce(f.case_key, e.case_key) as case_key, coalesce(f.code, e.code) as code,
       greatest(coalesce(f.n, 0), coalesce(e.n, 0)) as n
from (select case_key, taxonomy_code as code, count(*) as n from {documents_previous}
      where is_present and parse_status = 'OK' and taxonomy_code is not null group by all) f
full join (select case_key, type_id as code, count(*) as n from {evidence} where type_id is not null group by all) e
  on f.case_key = e.case_key and f.code = e.code
"""


def checklist_of(cases: str, evidence: str) -> str:
    return f"""
select c.case_key, t.code, t.name, t.priority,
       case when coalesce(e.n, 0) > 0 then 'CO_TAI_LIEU' else coalesce(o.status, t.default_applicability) end as status,
       coalesce(e.n, 0) as document_count, o.status is not null as has_override,
       case t.priority when 1 then 3 when 2 then 2 else 1 end as weight
from {{{cases}}} c cross join (select * from {{catalog}} where active) t
left join {{{evidence}}} e on e.case_key = c.case_key and e.code = t.code
left join {{overrides}} o on o.case_key = c.case_key and o.taxonomy_code = t.code
"""


def half_even(part: str, whole: str) -> str:
    """Exact half-even quotient of two integers, in hundredths (round_even works on doubles)."""
    q, r = f"({part} // {whole})", f"({part} % {whole})"
    up = f"case when 2 * {r} > {whole} or (2 * {r} = {whole} and {q} % 2 = 1) then 1 else 0 end"
    return f"cast({q} + {up} as double) / 100"


DONE = "sum(case when status in ('CO_TAI_LIEU', 'KHONG_PHAT_SINH') then weight else 0 end)"
CENTS = "sum(cast(cast(progress_percent as decimal(9, 2)) * 100 as bigint))"


def rollup_of(checklist: str) -> str:
    return f"""
select case_key,
       {half_even(f'(10000 * {DONE})', 'sum(weight)')} as progress_percent,
       cast(sum(document_count) as bigint) as document_count,
       count(*) filter (status = 'CO_TAI_LIEU') as type_count,
       count(*) filter (status = 'CAN_BO_SUNG') as missing_type_count,
       count(*) filter (status = 'CAN_BO_SUNG' and priority = 1) as missing_priority1_count
from {{{checklist}}} group by case_key
"""


O["checklist"] = checklist_of("cases_previous", "evidence_n")
O["rollup"] = rollup_of("checklist")

O["diff"] = """
select coalesce(l.relative_path, p.relative_path) as relative_path, coalesce(l.case_key, p.case_key) as case_key,
       case when l.relative_path is null then 'GONE' when p.relative_path is null then 'NEW'
            when p.is_present and p.size_bytes = l.size_bytes and p.mtime_ns = l.mtime_ns then 'UNCHANGED'
            else 'CHANGED' end as change_kind, l.size_bytes
from {documents_previous} p full join {listing} l on l.relative_path = p.relative_path
"""

O["touched"] = """
select case_key from {folders} union select case_key from {cases_previous} where is_present
"""


def documents_after(listing: str, touched: str) -> str:
    return f"""
select l.case_key, l.relative_path, f.filename, f.file_code as taxonomy_code, f.catalog_name as taxonomy_name,
       f.file_sequence as sequence_no, f.catalog_priority as priority, l.size_bytes, l.mtime_ns,
       case when same then p.sha256 else b.sha256 end as sha256,
       case when same then p.page_count else b.page_count end as page_count,
       case when same and p.parse_status = 'FILE_KHONG_DOC_DUOC' or not same and not b.readable
            then 'FILE_KHONG_DOC_DUOC' else f.status end as parse_status,
       true as is_present, coalesce(p.first_seen_at, {T1}) as first_seen_at, {T1} as last_seen_at,
       case when same then p.last_hashed_at else {T1} end as last_hashed_at
from (select l.*, coalesce(d.change_kind = 'UNCHANGED', false) as same
      from {listing} l join {{diff}} d on d.relative_path = l.relative_path) l
join {{parsed}} f on f.relative_path = l.relative_path
join {{probe}} b on b.relative_path = l.relative_path
left join {{documents_previous}} p on p.relative_path = l.relative_path
union all
select p.case_key, p.relative_path, p.filename, p.taxonomy_code, p.taxonomy_name, p.sequence_no, p.priority,
       p.size_bytes, p.mtime_ns, p.sha256, p.page_count, p.parse_status,
       case when p.case_key in (select case_key from {touched}) then false else p.is_present end,
       p.first_seen_at,
       case when p.case_key in (select case_key from {touched}) then {T1} else p.last_seen_at end, p.last_hashed_at
from {{documents_previous}} p where p.relative_path not in (select relative_path from {listing})
"""


O["scope"] = "select case_key from {folders} where case_key like '07.%'"
O["scoped_listing"] = "select * from {listing} where case_key in (select case_key from {scope})"
O["documents"] = documents_after("{listing}", "{touched}")
O["scoped_documents"] = documents_after("{scoped_listing}", "{scope}")

O["upserted"] = f"""
select coalesce(f.case_key, p.case_key) as case_key, coalesce(f.folder_path, p.folder_path) as folder_path,
       coalesce(f.case_key, p.folder_name) as folder_name,
       n.m1, n.m5, n.citizen_id, n.person_name_display, n.unit_code,
       coalesce(p.auto_status, 'CHUA_XU_LY') as auto_status, p.manual_status,
       coalesce(p.effective_status, 'CHUA_XU_LY') as effective_status,
       coalesce(p.progress_percent, 0) as progress_percent, coalesce(p.document_count, 0) as document_count,
       coalesce(p.warning_count, 0) as warning_count,
       case when f.case_key is not null then true else p.is_present end as is_present,
       coalesce(p.first_seen_at, {T1}) as first_seen_at,
       case when f.case_key is not null then {T1} else p.last_seen_at end as last_seen_at,
       case when f.case_key is not null then {T1} else p.last_scanned_at end as last_scanned_at,
       p.completed_at, p.reviewed_by, p.note
from {{cases_previous}} p full join {{folders}} f on f.case_key = p.case_key
left join {{folder_parts}} n on n.case_key = f.case_key
"""

O["cases_after"] = f"""
select * replace (is_present and not lost as is_present,
                  case when lost then {T1} else last_scanned_at end as last_scanned_at)
from (select *, is_present and case_key not in (select case_key from {{folders}}) as lost from {{upserted}}) u
"""

O["raised_documents"] = """
with d as (select o.*, f.status, f.canonical, f.file_code,
                  count(o.sha256) over (partition by o.case_key, o.sha256) as copies
           from {documents} o join {parsed} f on f.relative_path = o.relative_path where o.is_present),
r as (
  select case_key, relative_path, 'SAI_TEN_FILE' as warning_type, 'WARNING' as severity,
         'Tên file không theo mẫu: ' || filename as message from d where status = 'MALFORMED_NAME'
  union all
  select case_key, relative_path, 'FILE_NGOAI_TAXONOMY', 'WARNING', 'Mã tài liệu ngoài taxonomy: ' || file_code
  from d where status = 'FILE_NGOAI_TAXONOMY'
  union all
  select case_key, relative_path, 'SAI_TEN_FILE', 'WARNING', 'Tên file khác tên chuẩn catalog: ' || filename
  from d where status = 'OK' and not canonical
  union all
  select case_key, relative_path, 'TRUNG_TAI_LIEU', 'WARNING', 'Có file trùng SHA-256 trong cùng hồ sơ.'
  from d where copies > 1
  union all
  select case_key, relative_path, 'FILE_KHONG_DOC_DUOC', 'ERROR', 'Không đọc được PDF.'
  from d where parse_status = 'FILE_KHONG_DOC_DUOC')
select *, case_key || ':' || relative_path || ':' || warning_type || ':' || message as fingerprint from r
"""

O["raised_folders"] = """
select case_key, null as relative_path, 'SAI_TEN_THU_MUC' as warning_type, 'WARNING' as severity,
       'Tên thư mục không theo mẫu: ' || case_key as message,
       case_key || ':0:SAI_TEN_THU_MUC:Tên thư mục không theo mẫu: ' || case_key as fingerprint
from {folder_parts} where not folder_valid
"""

O["raised"] = """
select * from {raised_folders} union all by name select * from {raised_documents}
"""

O["merged"] = f"""
select coalesce(p.case_key, c.case_key) as case_key, coalesce(p.fingerprint, c.fingerprint) as fingerprint,
       coalesce(p.warning_type, c.warning_type) as warning_type,
       case when c.fingerprint is not null then true
            when p.case_key in (select case_key from {{folders}}) then false else p.active end as active,
       coalesce(p.created_at, {T1}) as created_at,
       case when c.fingerprint is not null or p.case_key in (select case_key from {{folders}}) then {T1}
            else p.updated_at end as updated_at,
       p.fingerprint is null as is_new
from {{warnings_previous}} p full join {{raised}} c on c.fingerprint = p.fingerprint
"""

O["counters"] = """
select (select count(*) from {folders}) as folders_seen,
        (select count(*) from {listing}) as files_seen,
        (select count(*) from {folders} where case_key not in (select case_key from {cases_previous})) as cases_created,
        (select count(*) from {folders} where case_key in (select case_key from {cases_previous})) as cases_updated,
        (select count(*) from {diff} where change_kind = 'NEW') as docs_created,
        (select count(*) from {diff} where change_kind in ('UNCHANGED', 'CHANGED')) as docs_updated,
        (select count(*) from {merged} where is_new) as warnings_created
"""

O["week_forms"] = """
select *, monday + ((w::int - 1) * 7 + case when form = 6 then 0 else d::int - 1 end)::int as found,
       w::int between 1 and extract(week from late_day) and (form = 6 or d::int between 1 and 7) as fine
from (select *, event_id % 16 as form, strftime(cast(plain as timestamp), '%d/%m/%Y %H:%M') as whole,
             substring(plain, 9, 2) || '/' || substring(plain, 6, 2) || '/' || substring(plain, 1, 4) as day,
             date_trunc('week', make_date(y::bigint, 1, 4))::date as monday, make_date(y::bigint, 12, 28) as late_day
      from {stamp_forms}) forms
"""
O["judged_uploads"] = """
select s.token, s.case_key, case when u.token is null then 'nothing to upload' else u.reason end as reason, u.file
from {sessions} s left join (
  select token, first(problem order by position) filter (problem is not null) as reason, first(base order by position) filter (problem is not null) as file
  from {named_uploads} group by token) u on u.token = s.token
"""
O["named_uploads"] = r"""
select *, case when ext is null or ext not in ('.jpg', '.jpeg', '.png', '.pdf') then 'file type not allowed'
               when ext = '.pdf' and page_count is null then 'unreadable PDF'
               when ext = '.pdf' and page_count = 0 then 'PDF without pages' end as problem,
       case when ext = '.pdf' then page_count else 1 end as n_pages
from (select *, case when position('.' in base) > 1 then lower('.' || string_split(base, '.')[-1]) end as ext
      from (select *, string_split(name, '/')[-1] as base from {uploads}) a) b
"""

O["warnings_after"] = """
select case_key, warning_type, active from {merged} union all select case_key, warning_type, active from {reviews}
"""

O["evidence_after"] = """
select case_key, code, greatest(coalesce(max(f), 0), coalesce(max(e), 0)) as n from (
  select case_key, taxonomy_code as code, count(*) as f, null as e from {documents}
  where is_present and parse_status = 'OK' and taxonomy_code is not null group by all
  union all
  select case_key, type_id as code, null as f, count(*) as e from {evidence} where type_id is not null group by all) u
group by all
"""
O["present_cases"] = "select * from {cases_after} where is_present"
O["checklist_after"] = checklist_of("present_cases", "evidence_after")
O["rollup_after"] = rollup_of("checklist_after")

O["changed"] = """
select case_key from {present_cases} c where completed_at is not null and exists (
  select 1 from {documents} d where d.case_key = c.case_key and d.is_present and d.last_hashed_at > c.completed_at)
"""

O["figures"] = """
select r.*, c.effective_status as old_effective_status, c.manual_status, a.auto_status,
       coalesce(c.manual_status, a.auto_status) as effective_status, w.warning_count,
       c.case_key in (select case_key from {changed}) as changed_after_completion
from {rollup_after} r join {present_cases} c on c.case_key = r.case_key
join (select case_key, count(*) as warning_count, bool_or(warning_type in ('REVIEW_PENDING', 'CAN_XAC_MINH')) as pending
      from (select case_key, warning_type from {warnings_after} where active
            union all select case_key, 'CHANGED_AFTER_COMPLETION' from {changed}) x group by case_key
      union all
      select case_key, 0, false from {present_cases} where case_key not in (
        select case_key from {warnings_after} where active union select case_key from {changed})) w
  on w.case_key = r.case_key
join lateral (select case when r.document_count = 0 then 'CHUA_XU_LY' when w.pending then 'DANG_SO_HOA'
                          when r.missing_type_count > 0 then 'CAN_BO_SUNG' else 'CHO_KIEM_TRA' end as auto_status) a
  on true
"""

# Actions one by one: running state with plain windows over each case.
O["override_steps"] = """
select a.seq, a.case_key, a.code, a.status, a.ts, coalesce(e.n, 0) as evidence, t.default_applicability,
       coalesce(lag(a.status) over (partition by a.case_key, a.code order by a.ts, a.seq), o.status) as old_status
from {accepted} a
left join {evidence_n} e on e.case_key = a.case_key and e.code = a.code
left join {overrides} o on o.case_key = a.case_key and o.taxonomy_code = a.code
join {catalog} t on t.code = a.code
where a.action = 'override'
"""

O["steps"] = """
with change as (
  select seq, old_status,
         case when evidence > 0 then 0 else
           (case when status = 'CAN_BO_SUNG' then 1 else 0 end)
           - (case when coalesce(old_status, default_applicability) = 'CAN_BO_SUNG' then 1 else 0 end) end as delta
  from {override_steps}),
pending as (select case_key, bool_or(active) as review_pending from {reviews} group by case_key),
base as (
  select a.*, c.old_status, coalesce(c.delta, 0) as delta, p.manual_status as m0, p.effective_status as e0,
         p.completed_at as d0, p.reviewed_by as r0, r.document_count as docs, r.missing_type_count as missing0,
         coalesce(w.review_pending, false) as pending
  from {accepted} a left join change c on c.seq = a.seq
  join {cases_previous} p on p.case_key = a.case_key
  join {rollup} r on r.case_key = a.case_key
  left join pending w on w.case_key = a.case_key),
ran as (
  select *,
    sum(delta) over w_to as delta_to, sum(delta) over w_before as delta_before,
    count(*) filter (action <> 'note') over w_before as recomputes,
    last_value(case when action in ('manual_status', 'complete', 'reopen') then
      {'m': case action when 'complete' then 'HOAN_THANH' when 'manual_status' then status end} end ignore nulls) over w_to as m_to,
    last_value(case when action in ('manual_status', 'complete', 'reopen') then
      {'m': case action when 'complete' then 'HOAN_THANH' when 'manual_status' then status end} end ignore nulls) over w_before as m_before,
    last_value(case when action in ('complete', 'reopen') then
      {'d': case when action = 'complete' then ts end, 'r': case when action = 'complete' then reviewed_by end} end
      ignore nulls) over w_before as d_before
  from base
  window w_to as (partition by case_key order by ts, seq rows between unbounded preceding and current row),
         w_before as (partition by case_key order by ts, seq rows between unbounded preceding and 1 preceding)),
state as (
  select *, case when m_to is null then m0 else m_to.m end as manual_after,
         case when m_before is null then m0 else m_before.m end as manual_before,
         case when d_before is null then d0 else d_before.d end as completed_before,
         case when d_before is null then r0 else d_before.r end as reviewed_before,
         case when docs = 0 then 'CHUA_XU_LY' when pending then 'DANG_SO_HOA'
              when missing0 + delta_to > 0 then 'CAN_BO_SUNG' else 'CHO_KIEM_TRA' end as auto_after,
         case when docs = 0 then 'CHUA_XU_LY' when pending then 'DANG_SO_HOA'
              when missing0 + coalesce(delta_before, 0) > 0 then 'CAN_BO_SUNG' else 'CHO_KIEM_TRA' end as auto_before
  from ran)
select *, case when recomputes = 0 then e0 else coalesce(manual_before, auto_before) end as effective_before,
       coalesce(manual_after, auto_after) as effective_after
from state
"""

O["action_rows"] = """
with a as (
  select *, case when completed_before is not null then
         'Hồ sơ từng được đánh dấu hoàn thành lúc ' || strftime(completed_before, '%Y-%m-%dT%H:%M:%S.%f+00:00')
         || ' bởi ' || coalesce(nullif(reviewed_before, ''), 'không xác định') || '.' end as reopen_detail,
         case action when 'override' then effective_before when 'reopen' then 'CHUA_XU_LY' end as left_with
  from {steps})
select case_key, seq * 2 as seq, ts as created_at,
       case action when 'override' then 'CHECKLIST_OVERRIDE' when 'manual_status' then 'MANUAL_STATUS_CHANGED'
            when 'complete' then 'MARK_COMPLETED' when 'reopen' then 'REOPENED' else 'NOTE_UPDATED' end as event_type,
       case when action in ('manual_status', 'complete', 'reopen') then effective_before end as from_status,
       case action when 'manual_status' then status when 'complete' then 'HOAN_THANH' when 'reopen' then 'CHUA_XU_LY' end as to_status,
       case action when 'override' then code || ': ' || coalesce(old_status, 'None') || ' -> ' || status
            when 'complete' then reviewed_by when 'reopen' then reopen_detail when 'note' then note end as detail
from a
union all
select case_key, seq * 2 + 1, ts,
       case when manual_after is null then 'AUTO_STATUS_CHANGED' else 'MANUAL_STATUS_CHANGED' end,
       left_with, effective_after, 'recompute'
from a where left_with <> effective_after
"""

O["last_state"] = """
select case_key,
  arg_max({'m': case action when 'complete' then 'HOAN_THANH' when 'manual_status' then status end}, {'t': ts, 's': seq})
    filter (action in ('manual_status', 'complete', 'reopen')) as m,
  arg_max({'d': case when action = 'complete' then ts end, 'r': case when action = 'complete' then reviewed_by end}, {'t': ts, 's': seq})
    filter (action in ('complete', 'reopen')) as d,
  arg_max({'n': note}, {'t': ts, 's': seq}) filter (action = 'note') as n
from {accepted} group by case_key
"""

O["override_last"] = """
select case_key, code as taxonomy_code, status, note, ts as updated_at
from {accepted} where action = 'override'
qualify row_number() over (partition by case_key, code order by ts desc, seq desc) = 1
"""

O["taken"] = r"""
select case_key, code, max(cast(nullif(regexp_extract(tail, '^\.([0-9]+)\.pdf$', 1), '') as bigint)) as max_sequence,
       bool_or(tail = '.pdf') as plain_exists
from (select f.case_key, t.code, substring(f.filename, length(t.filename_base) + 1) as tail
      from {named_files} f join {catalog} t on starts_with(f.filename, t.filename_base || '.')
      where f.is_present) n
where regexp_full_match(tail, '(\.[0-9]+)?\.pdf')
group by case_key, code
"""

O["request_pages"] = """
select r.*, case when r.k % 59 = 0 then 0 else n_pages + case when r.k % 53 = 0 then 3 else 0 end end as pages_asked
from {requests} r
"""

O["judged"] = """
select r.*, case
  when t.code is null then 'invalid type code'
  when not regexp_full_match(r.token, '[0-9a-f]{32}') then 'unreadable session'
  when r.k % 61 = 0 then 'session of another case'
  when r.pages_asked = 0 or r.pages_asked > 5 or (r.k % 43 = 0 and r.pages_asked >= 2) then 'invalid page list'
  when c.case_key is null then 'unknown case'
  when r.k % 47 = 0 and exists (select 1 from range(1, r.pages_asked + 1) g(n) where (45 * n - 180) % 90 <> 0)
    then 'invalid rotation' end as reason
from {request_pages} r left join {catalog} t on t.code = r.type_id
left join (select case_key from {cases} where is_present) c on c.case_key = r.case_key
"""

O["named"] = """
select token, k, pages_asked, document_date, case_key, type_id, filename_base, sequence, first,
       filename_base || case when sequence is null then '' else '.' || sequence end || '.pdf' as filename
from (
  select j.token, j.k, j.pages_asked, j.document_date, j.case_key, j.type_id, t.filename_base,
         case when x.max_sequence is not null then x.max_sequence + j.rank
              when x.plain_exists then 1 + j.rank when j.rank > 1 then j.rank end as sequence,
         x.max_sequence is null and j.rank = case when x.plain_exists then 1 else 2 end as first
  from (select *, row_number() over (partition by case_key, type_id order by requested_at, token) as rank
        from {judged} where reason is null) j
  join {catalog} t on t.code = j.type_id
  left join {taken} x on x.case_key = j.case_key and x.code = j.type_id) n
"""

SHOWN = "case_key, person_name_display, effective_status, unit_code, progress_percent"
RULE = "select relative_path, severity, message, fingerprint from {raised_documents} where warning_type = "
FOLD = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def search(q: str) -> str:
    fields = ("person_name_display", "person_name_raw", "citizen_id")
    return "is_present and (" + " or ".join(f"{FOLD % f} like '%{q}%'" for f in fields) + ")"


ACTIVE = "case_key in (select case_key from {warnings} where active)"

LABEL_TABLE = """
('CO_TAI_LIEU', 'Có tài liệu'), ('KHONG_PHAT_SINH', 'Không phát sinh'), ('CHUA_XAC_DINH', 'Chưa xác định'),
('CAN_BO_SUNG', 'Cần bổ sung'), ('CHO_KIEM_TRA', 'Chờ kiểm tra'), ('DANG_SO_HOA', 'Đang số hóa'),
('CHUA_XU_LY', 'Chưa xử lý'), ('HOAN_THANH', 'Hoàn thành'), ('OK', 'Hợp lệ'),
('MALFORMED_NAME', 'Tên tệp không chuẩn'), ('FILE_NGOAI_TAXONOMY', 'Ngoài danh mục chuẩn'),
('FILE_KHONG_DOC_DUOC', 'Không đọc được tệp'), ('SAI_TEN_FILE', 'Sai tên tệp'),
('TRUNG_TAI_LIEU', 'Trùng lặp tài liệu'), ('CHECKLIST_OVERRIDE', 'Điều chỉnh checklist'),
('MANUAL_STATUS_CHANGED', 'Chỉnh sửa trạng thái thủ công'), ('MARK_COMPLETED', 'Đánh dấu hoàn thành'),
('REOPENED', 'Mở lại hồ sơ'), ('NOTE_UPDATED', 'Cập nhật ghi chú'), ('true', 'Có'), ('false', 'Không')
"""
O["label"] = f"select * from (values {LABEL_TABLE}) l(value, label)"

SQL: dict[str, str] = {
    "folder_parse": "select * from {folder_parts}",
    "folder_invalid": "select case_key from {folder_parts} where not folder_valid",
    "filename_parse": "select relative_path, file_code, file_sequence, file_slug, status, canonical from {parsed}",
    "parse_status_counts": "select status, canonical, count(*) as n from {parsed} group by all",
    "canonical_match": """select file_code, catalog_name, count(*) filter (canonical) as matching,
        count(*) filter (not canonical) as different from {parsed} where status = 'OK' group by all""",
    "canonical_name": """select relative_path, catalog_base || '.pdf' as plain,
        catalog_base || '.' || greatest(file_sequence, 1) || '.pdf' as numbered from {parsed} where status = 'OK'""",
    "path_containment": "select k, k % 3 = 1 as inside from {files}",
    "path_ignored": """select k, coalesce(list_bool_or(list_transform(string_split(path, '/'), lambda s: starts_with(s, '.')
        or s in ('Thumbs.db', '.DS_Store') or starts_with(s, '~$'))), false) as ignored
        from (select k, case when k % 5 = 0 then '.x/' when k % 5 = 1 then '~$' when k % 10 = 2 then 'Thumbs.db/'
          when k % 5 = 2 then 'xThumbs.db/' when k % 10 = 3 then '01.a~$b.pdf/' when k % 10 = 4 then 'thumbs.db/'
          else '' end || filename as path from {files})""",
    "catalog_normalize": """select id as code, name_vi as name, filename_base,
        case when priority between 1 and 3 then priority else 3 end as priority, true as active,
        'CHUA_XAC_DINH' as default_applicability, split_part(filename_base, '.', 2) as slug from {entries}""",
    "catalog_lookup": """select type_id, type_id = 'UNKNOWN' or type_id in (select code from {catalog}) as code_valid,
        count(*) as n from {requests} group by all""",
    "catalog_seed": """select coalesce(n.code, o.code) as code, coalesce(n.name, o.name) as name,
        coalesce(n.filename_base, o.filename_base) as filename_base, coalesce(n.priority, o.priority) as priority,
        case when n.code is null then o.active else true end as active,
        coalesce(o.default_applicability, n.default_applicability) as default_applicability
        from {stored_catalog} o full join {catalog} n on n.code = o.code""",
    "docs_per_type": """select case_key, taxonomy_code as code, count(*) as n from {documents_previous}
        where is_present and parse_status = 'OK' and taxonomy_code is not null group by all""",
    "external_evidence": """select case_key, type_id as code, count(*) as n from {evidence}
        where type_id is not null group by all""",
    "evidence_merge": "select * from {evidence_n}",
    "checklist_rows": "select * exclude (weight) from {checklist}",
    "checklist_without_evidence": """
        select t.code, case when d.n > 0 then 'CO_TAI_LIEU' else coalesce(o.status, t.default_applicability) end as status,
               o.status is not null as has_override, count(*) as n, cast(sum(coalesce(d.n, 0)) as bigint) as documents
        from {cases_previous} c cross join (select * from {catalog} where active) t
        left join (select case_key, taxonomy_code as code, count(*) as n from {documents_previous}
                   where is_present and parse_status = 'OK' group by all) d on d.case_key = c.case_key and d.code = t.code
        left join {overrides} o on o.case_key = c.case_key and o.taxonomy_code = t.code
        group by all""",
    "checklist_search": "select case_key, code, status from {checklist} where status = 'CAN_BO_SUNG'",
    "type_picker": "select code, name from {catalog} where lower(code || ' ' || name) like '%bản blue%'",
    "case_progress": "select case_key, progress_percent from {rollup}",
    "case_rollup": "select * exclude (progress_percent) from {rollup}",
    "scan_diff": "select relative_path, case_key, change_kind from {diff}",
    "scan_to_probe": "select relative_path, size_bytes from {diff} where change_kind in ('NEW', 'CHANGED')",
    "docs_not_listed": """select relative_path, case_key from {documents_previous} p
        where not exists (select 1 from {listing} l where l.relative_path = p.relative_path)""",
    "cases_not_listed": """select case_key from {cases_previous} except select case_key from {folders}""",
    "docs_upsert": "select * from {documents} where is_present",
    "docs_tombstone": "select * from {documents} where not is_present",
    "cases_upsert": """select case_key, folder_path, m1, m5, citizen_id, person_name_display, unit_code, auto_status,
        effective_status, is_present, first_seen_at, last_seen_at, last_scanned_at, completed_at, note from {upserted}""",
    "cases_tombstone": """select case_key, effective_status, last_seen_at, last_scanned_at from {cases_after}
        where not is_present""",
    "scoped_diff": """select relative_path, case_key, change_kind from {diff}
        where case_key in (select case_key from {scope})""",
    "scoped_upsert": """select relative_path, parse_status, is_present, last_seen_at, last_hashed_at
        from {scoped_documents}""",
    "scan_counters": "select * from {counters}",
    "run_summary": f"""select 1::bigint as run_id, 'SUCCESS' as status, {T1} as started_at, c.* exclude (cases_created, cases_updated, docs_updated),
        0::bigint as errors,
        '{{"run_id":1,"status":"SUCCESS","folders_seen":' || folders_seen || ',"files_seen":' || files_seen || ',"cases_created":' || cases_created
        || ',"cases_updated":' || cases_updated || ',"docs_created":' || docs_created || ',"docs_updated":' || docs_updated
        || ',"warnings_created":' || warnings_created || ',"errors":0,"error_messages":[],"duration_ms":0}}' as summary_json
        from {{counters}} c""",
    "warn_bad_folder": "select case_key, severity, message, fingerprint from {raised_folders}",
    "warn_malformed_name": RULE + "'SAI_TEN_FILE' and message like 'Tên file không theo mẫu%'",
    "warn_not_canonical": RULE + "'SAI_TEN_FILE' and message like 'Tên file khác tên chuẩn%'",
    "warn_unknown_type": RULE + "'FILE_NGOAI_TAXONOMY'",
    "warn_duplicate": RULE + "'TRUNG_TAI_LIEU'",
    "warn_unreadable": RULE + "'FILE_KHONG_DOC_DUOC'",
    "warn_union": "select warning_type, severity, count(*) as n from {raised} group by all",
    "warn_lifecycle": "select fingerprint, active, created_at, updated_at, is_new from {merged}",
    "dup_in_case": """select * from (select case_key, relative_path, sha256,
        count(*) over (partition by case_key, sha256) as copies from {documents_previous} where is_present) d
        where copies > 1""",
    "dup_text": """select doc_id, source, sha256, count(*) over (partition by source, sha256) as copies
        from (select doc_id, source, sha256(text) as sha256 from documents) d""",
    "dup_groups": """select source, sha256(text) as sha256, count(*) as n from documents
        group by all having count(*) > 1""",
    "case_status": """select case_key, auto_status, effective_status, progress_percent, document_count, warning_count,
        missing_priority1_count, type_count, missing_type_count, changed_after_completion from {figures}""",
    "recompute_from_changes": """select case_key, auto_status, effective_status, progress_percent, document_count, warning_count,
        missing_priority1_count, type_count, missing_type_count, changed_after_completion from {figures}""",
    "counts_from_changes": """select case_key, case when parse_status = 'OK' then taxonomy_code end as code, last_hashed_at, count(*) as n
        from {documents} where is_present group by all""",
    "case_snapshot": """select c.case_key, coalesce(f.auto_status, c.auto_status) as auto_status, c.manual_status,
        coalesce(f.effective_status, c.effective_status) as effective_status,
        coalesce(f.progress_percent, c.progress_percent) as progress_percent,
        coalesce(f.document_count, c.document_count) as document_count,
        coalesce(f.warning_count, c.warning_count) as warning_count, c.is_present, c.last_scanned_at
        from {cases_after} c left join {figures} f on f.case_key = c.case_key""",
    "status_transitions": f"""select case_key,
        case when manual_status is null then 'AUTO_STATUS_CHANGED' else 'MANUAL_STATUS_CHANGED' end as event_type,
        old_effective_status as from_status, effective_status as to_status, 'recompute' as detail, {T1} as created_at
        from {{figures}} where old_effective_status <> effective_status""",
    "changed_after_completion": "select case_key from {changed}",
    "recompute_warnings": """select warning_type, active, count(*) as n from (
        select warning_type, active from {warnings_after}
        union all select 'CHANGED_AFTER_COMPLETION', true from {changed}) w group by all""",
    "dash_status_counts": """select s.status, coalesce(n, 0) as n
        from (values ('CHUA_XU_LY'), ('DANG_SO_HOA'), ('CHO_KIEM_TRA'), ('CAN_BO_SUNG'), ('HOAN_THANH')) s(status)
        left join (select effective_status, count(*) as n from {cases} where is_present group by 1) c
          on c.effective_status = s.status""",
    "dash_totals": f"""select count(*) as total,
        {half_even(CENTS, 'count(*)')} as progress,
        cast(sum(missing_priority1_count) as bigint) as missing_p1,
        count(*) filter (effective_status in ('DANG_SO_HOA', 'CHUA_XU_LY')) as open_cases,
        count(distinct coalesce(nullif(unit_code, ''), 'Chưa xác định')) as units
        from {{cases}} where is_present""",
    "dash_units": f"""select coalesce(nullif(unit_code, ''), 'Chưa xác định') as unit,
        {half_even(CENTS, 'count(*)')} as progress,
        count(*) as count from {{cases}} where is_present group by 1""",
    "dash_actions": """select case_key, effective_status, warning_count from {cases} where is_present
        and (effective_status in ('CAN_BO_SUNG', 'DANG_SO_HOA', 'CHO_KIEM_TRA') or warning_count > 0)
        order by case_key limit 10""",
    "dash_warnings": "select count(*) as n from {warnings} where active",
    "last_run": "select * from {runs} order by run_id desc limit 1",
    "run_log": "select * from {runs} order by run_id desc limit 50",
    "case_search": f"select {SHOWN} from {{cases}} where {search('le van')}",
    "case_search_accent": f"""select {SHOWN} from {{cases}} where {search('đỗ')}
        union all select {SHOWN} from {{cases}} where {search('Đỗ thị_1')}""",
    "case_search_indexed": f"""select 0 as search, {SHOWN} from {{cases}} where {search('le van')}
        union all select 1, {SHOWN} from {{cases}} where {search('Đỗ thị_1')}
        union all select 2, {SHOWN} from {{cases}} where {search('nguyen')} and {ACTIVE}
        union all select 3, {SHOWN} from {{cases}} where {search('07')}""",
    "case_filter_status_unit": f"""select {SHOWN} from {{cases}} where is_present
        and effective_status = 'CAN_BO_SUNG' and unit_code = '07'""",
    "case_with_warning": f"select {SHOWN} from {{cases}} where is_present and {ACTIVE}",
    "case_missing_p1": f"select {SHOWN} from {{cases}} where is_present and missing_priority1_count > 0",
    "case_filter_all": f"""select {SHOWN} from {{cases}} where {search('thị')} and {ACTIVE}
        and effective_status = 'CAN_BO_SUNG' and missing_priority1_count > 0""",
    "case_filter_total": f"select count(*) as total from {{cases}} where {search('nguyen')} and {ACTIVE}",
    "case_page_name": f"""select {SHOWN} from {{cases}} where is_present
        order by {FOLD % 'coalesce(person_name_display, case_key)'}, case_key limit 50 offset 100""",
    "case_page_after": f"""select {SHOWN} from {{cases}} where is_present
        order by {FOLD % 'coalesce(person_name_display, case_key)'}, case_key limit 50 offset 100""",
    "case_page_progress": f"""select {SHOWN} from {{cases}} where is_present
        order by progress_percent, case_key limit 50 offset 50""",
    "case_page_updated": f"""select {SHOWN} from {{cases}} where is_present
        order by last_scanned_at desc, case_key limit 50""",
    "page_clamp": """select * exclude (total), least(greatest(page, 1), total_pages) as shown_page from (
        select *, greatest(1, (total + size - 1) // size) as total_pages from (
          select o_orderkey, o_orderkey % 60 - 5 as page, o_custkey % 300 - 5 as page_size,
                 least(greatest(o_custkey % 300 - 5, 1), 200) as size from orders) p,
          (select count(*) as total from {cases} where is_present) t) q""",
    "distinct_units": "select distinct unit_code from {cases} where is_present and unit_code is not null",
    "case_picker": "select case_key, folder_name, person_name_display from {cases} where is_present",
    "case_lookup": f"select {SHOWN} from {{cases}} where case_key = '05.000.036.001.5_000000000005_le_VAN_5'",
    "document_lookup": """select relative_path, sha256, parse_status from {documents_previous}
        where relative_path = (select max(relative_path) from {documents_previous} where is_present) and is_present""",
    "case_page_far": f"""select {SHOWN} from (
          select *, row_number() over (order by {FOLD % 'coalesce(person_name_display, case_key)'}, case_key) as n, count(*) over () as total
          from {{cases}} where is_present) c
        where n > ((total + 49) // 50 * 4 // 5 - 1) * 50 and n <= (total + 49) // 50 * 4 // 5 * 50""",
    "review_list": """select c.case_key, c.folder_name, c.person_name_display, c.effective_status,
        count(w.fingerprint) as warning_count
        from {cases} c left join {warnings} w on w.case_key = c.case_key and w.active
        where c.is_present group by all""",
    "detail_documents": """select case_key, relative_path, filename, page_count, l.label
        from {documents_previous} d join {label} l on l.value = d.parse_status where is_present""",
    "detail_warnings": """select w.case_key, fingerprint, severity, l.label, message
        from {warnings} w join {label} l on l.value = w.warning_type
        where active and w.case_key in (select case_key from {cases} where is_present)""",
    "detail_documents_order": """select case_key, relative_path,
        row_number() over (partition by case_key order by relative_path) as position from {documents_previous} where is_present""",
    "detail_warnings_order": """select case_key, fingerprint,
        row_number() over (partition by case_key order by severity desc, created_at, fingerprint) as position
        from {warnings} where active""",
    "detail_history_top12": """select case_key, position, seq, l.label, detail from (
        select *, row_number() over (partition by case_key order by created_at desc, seq desc) as position
        from {history}) h join {label} l on l.value = h.event_type where position <= 12""",
    "detail_counts": """select c.case_key, c.effective_status, c.progress_percent,
        (select count(*) from {documents_previous} d where d.case_key = c.case_key and d.is_present) as documents,
        (select count(*) from {warnings} w where w.case_key = c.case_key and w.active) as warnings,
        (select count(*) from {history} h where h.case_key = c.case_key) as history,
        least((select count(*) from {history} h where h.case_key = c.case_key), 12) as history_shown from {cases} c""",
    "detail_one_case": """select * exclude (weight) from {checklist}
        where case_key = '05.000.036.001.5_000000000005_le_VAN_5'""",
    "reject_actions": """select * from (select a.seq, a.case_key, a.action, case
        when a.action = 'override' and a.status = 'bogus' then 'invalid checklist status'
        when a.action = 'override' and not coalesce(t.active, false) then 'invalid type code'
        when a.action = 'manual_status' and a.status = 'HOAN_THANH' then 'invalid case status'
        when a.case_key not in (select case_key from {cases_previous}) then 'unknown case' end as reason
        from {actions} a left join {catalog} t on t.code = a.code) r where reason is not null""",
    "accept_actions": """select case_key, action, count(*) as n from {accepted}
        where case_key in (select case_key from {cases_previous}) group by all""",
    "override_latest": "select * from {override_last}",
    "override_merge": """select * from {override_last} union all by name
        select * from {overrides} o where not exists (
          select 1 from {override_last} n where n.case_key = o.case_key and n.taxonomy_code = o.taxonomy_code)""",
    "action_fold": """select c.case_key, case when s.m is null then c.manual_status else s.m.m end as manual_status,
        case when s.d is null then c.completed_at else s.d.d end as completed_at,
        case when s.d is null then c.reviewed_by else s.d.r end as reviewed_by
        from {cases_previous} c left join {last_state} s on s.case_key = c.case_key""",
    "note_latest": """select c.case_key, case when s.n is null then c.note else s.n.n end as note
        from {cases_previous} c left join {last_state} s on s.case_key = c.case_key""",
    "override_audit": """select seq, evidence, code || ': ' || coalesce(old_status, 'None') || ' -> ' || status as detail
        from {override_steps}""",
    "action_replay": """select seq, case_key, action, effective_before, effective_after, completed_before,
        reviewed_before from {steps}""",
    "action_history": "select * from {action_rows}",
    "reopen_audit": "select case_key, seq, detail from {action_rows} where event_type = 'REOPENED'",
    "max_sequence": "select * from {taken}",
    "next_name": """select r.case_key, r.code, t.filename_base || case when x.max_sequence is not null
          then '.' || (x.max_sequence + 1) when x.plain_exists then '.2' else '' end || '.pdf' as filename,
        case when x.plain_exists and x.max_sequence is null then t.filename_base || '.1.pdf' end as plain_becomes
        from (select distinct case_key, type_id as code from {requests} where type_id <> 'UNKNOWN') r
        join {catalog} t on t.code = r.code left join {taken} x on x.case_key = r.case_key and x.code = r.code""",
    "import_names": "select token, case_key, type_id, sequence, filename from {named}",
    "import_second_batch": """
        select token, case_key, type_id, sequence, filename_base || case when sequence is null then '' else '.' || sequence end || '.pdf' as filename
        from (select j.*, t.filename_base, case when x.max_sequence is not null then x.max_sequence + j.rank
                     when x.plain_exists then 1 + j.rank when j.rank > 1 then j.rank end as sequence
              from (select *, row_number() over (partition by case_key, type_id order by k % 2, requested_at, token) as rank
                    from {judged} where reason is null) j
              join {catalog} t on t.code = j.type_id left join {taken} x on x.case_key = j.case_key and x.code = j.type_id) n
        where k % 2 = 1""",
    "import_token_reuse": """select token, case_key, type_id, coalesce(reason, 'session already used') as reason
        from {judged} where k % 3 = 0 and (reason is not null or k % 2 = 0)""",
    "schema_upgrade": """select case_key, 0::bigint as type_count, 0::bigint as missing_type_count, null::varchar as note, document_count,
        28 as n_columns from {cases_previous}""",
    "records_json": """select '{"case_key":"' || case_key || '","effective_status":"CAN_BO_SUNG","unit_code":' || coalesce('"' || unit_code || '"', 'null')
        || ',"document_count":' || document_count || '}' as record from {cases} where is_present and effective_status = 'CAN_BO_SUNG'""",
    "import_renames": """select case_key, type_id, filename_base || '.pdf' as rename_from,
        filename_base || '.1.pdf' as rename_to from {named} where first""",
    "import_rejects": "select token, case_key, type_id, reason from {judged} where reason is not null",
    "import_provenance": """select token, filename, nullif(document_date, '') as document_date,
        '[' || array_to_string(list_transform(range(1, pages_asked + 1),
          lambda n: case when n % 3 = 0 then '"photo.jpg"' else '"scan.pdf"' end), ',') || ']' as source_files,
        '{"scan.pdf":"' || sha256(k || 'scan.pdf') || '"' ||
        case when pages_asked >= 3 then ',"photo.jpg":"' || sha256(k || 'photo.jpg') || '"' else '' end || '}'
          as source_sha256 from {named}""",
    "page_list_check": """select conv_id as request, cast(sum(n) as bigint) as pages, count(*) filter (n > 1) as repeated,
        count(*) filter (not known) as unknown, bool_and(n = 1 and known) as valid
        from (select c.conv_id, c.turn, count(*) as n, exists (
                select 1 from conversations p where p.conv_id + 1 = c.conv_id and p.turn = c.turn) as known
              from conversations c group by c.conv_id, c.turn) t group by conv_id""",
    "rotation_check": """select o_orderkey, o_orderkey * 15 - 300 as rotation,
        (o_orderkey * 15 - 300) % 90 = 0 as valid from orders""",
    "upload_type_check": """select page_id, 'upload' || page_id || ['.jpg', '.JPEG', '.png', '.pdf', '.gif', '', '.pdf.exe',
        '.tar.PDF'][page_id % 8 + 1] as name, page_id % 8 in (0, 1, 2, 3, 7) as allowed from pages""",
    "labels": """select v.value, case when v.value is null then 'Chưa xác định' when l.label is not null then l.label
          when trim(v.value) = upper(trim(v.value)) and contains(v.value, '_') then 'Chưa xác định' else trim(v.value) end as label,
        case when v.value is null then '?' when l.label is not null then l.label
          when trim(v.value) = upper(trim(v.value)) and contains(v.value, '_') then '?' else trim(v.value) end as or_given,
        count(*) as n
        from (select warning_type as value from {warnings} union all select event_type from {history}
              union all select effective_status from {cases} union all select parse_status from {documents_previous}
              union all select o_orderpriority from orders
              union all select ' ' || upper(c_mktsegment) || '_X ' from customer
              union all select cast(is_present as varchar) from {cases}
              union all select manual_status from {cases}) v
        left join {label} l on l.value = trim(v.value) group by all""",
    "format_ts": """select event_id, case event_id % 7 when 4 then 'Chưa quét' when 6 then 'Chưa quét' when 3 then written
        when 2 then substring(written, 9, 2) || '/' || substring(written, 6, 2) || '/' || substring(written, 1, 4) || ' 00:00'
        else strftime(cast(substring(replace(trim(written), 'T', ' '), 1, 19) as timestamp), '%d/%m/%Y %H:%M') end as shown
        from {stamps}""",
    "format_ts_forms": """select event_id, case
          when form in (0, 1, 2, 7, 8, 10, 15) then whole when form = 3 then day || ' ' || substring(plain, 12, 2) || ':00'
          when form in (4, 5, 6) and fine then strftime(found, '%d/%m/%Y') || case when form = 4 then ' ' || substring(plain, 12, 5) else ' 00:00' end
          else written end as shown from {week_forms}""",
    "folded_names": "select k, folded from {odd_names}",
    "listing_order": "select relative_path, row_number() over (order by folded, relative_path) as position from {odd_names}",
    "manifest_check": """select token, case when k % 10 > 4 then 1 end as n_pages, case when k % 10 > 4 then cast(c as varchar) when k % 10 in (2, 3) then 'x' end as case_key,
        case when k % 10 in (0, 4) then 'not JSON' when k % 10 = 1 then 'not an object' when k % 10 in (2, 3) then 'no list of pages' end as reason,
        case when k % 10 <= 4 then text end as broken from (select m.*, o_custkey as c from {manifest_texts} m join orders on o_orderkey = k) j""",
    "inventory_listing": """select relative_path, string_split(relative_path, '/')[1] as case_key, size_bytes, mtime_ns
        from (select substring(path, 7) as relative_path, size_bytes, mtime_ns from {inventory}
              where path like '/data/%' and path not like '/data/.hidden/%' and path not like '%/../%' and lower(path) like '%.pdf') f""",
    "upload_rejects": "select token, case_key, reason, file from {judged_uploads} where reason is not null",
    "upload_manifest": """select token, case_key, before + n as number, 'p' || (before + n) as page_id, base as source_name,
          'source-' || lpad(position::varchar, 3, '0') || ext as source_path, case when ext = '.pdf' then n::int end as source_page,
          'p' || (before + n) || '.png' as preview_name
        from (select *, unnest(range(1, n_pages + 1)) as n from (
            select *, (coalesce(sum(n_pages) over (partition by token order by position rows between unbounded preceding and 1 preceding), 0))::bigint as before
            from {named_uploads} where token in (select token from {judged_uploads} where reason is null)) a) b""",
    "format_day": """select event_id, case event_id % 7 when 4 then '—' when 6 then '—' when 3 then written
        else strftime(cast(substring(trim(written), 1, 10) as date), '%d/%m/%Y') end as shown from {stamps}""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, O) for name, sql in SQL.items()}
