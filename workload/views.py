"""Input views over the driver tables.

Each view is one SQL text that both Spark and DuckDB run, so that the two sides of a
comparison start from the same inputs. All views read whole tables. ``{sha}x{end}`` is the
SHA-256 function of the engine at hand.

The data plays these parts:

* ``part``     -> the catalog: parts fall into 104 classes, one document type each
* ``customer`` -> case folders with files; ``supplier`` -> empty case folders
* ``orders``   -> files; flags say which of two snapshots (previous, current) hold a file
* ``lineitem`` -> externally reported documents
* ``events``   -> operator actions
"""

from __future__ import annotations

import re

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

T0 = "timestamp '2024-01-01 00:00:00'"  # previous scan
T1 = "timestamp '2024-01-20 00:00:00'"  # current scan


def text(e: str) -> str:
    return f"cast({e} as varchar(40))"


def code(n: str) -> str:
    """A two or three digit type code (lpad alone would cut 100 to 10)."""
    return f"case when {n} < 100 then lpad({text(n)}, 2, '0') else {text(n)} end"


def folder(k: str) -> str:
    """Folder name of customer ``k``; one in 17 does not parse."""
    return (
        f"case when {k} % 17 = 0 then 'Folder sai ' || {text(k)} else "
        f"lpad({text(f'{k} % 25')}, 2, '0') || '.000.036.001.' || {text(k)} || '_' || "
        f"lpad({text(k)}, 12, '0') || '_' || "
        f"case {k} % 3 when 0 then 'Đỗ_Thị_' when 1 then 'Nguyen_Van_' else 'le_VAN_' end || {text(k)} end"
    )


def archive(k: str) -> str:
    """Folder name of supplier ``k``."""
    return f"'Kho luu ' || {text(k)}"


# Every order is in at least one of the two snapshots.
_IN_PREVIOUS = "(o_orderstatus = 'F' or o_orderdate < timestamp '1999-01-01 00:00:00')"
_IN_CURRENT = "(o_orderstatus <> 'F')"

VIEWS: dict[str, str] = {}

# Raw catalog entries: priorities 0 to 4, of which only 1 to 3 are allowed.
VIEWS["entries"] = f"""
select {code('n')} as id, name_vi, {code('n')} || '.' || replace(name_vi, ' ', '_') as filename_base,
       priority, n
from (select p_partkey % 104 + 1 as n,
             'Văn bản ' || min(p_name) || ' ' || {text('p_partkey % 104 + 1')} as name_vi,
             cast(sum(p_size) % 5 as int) as priority
      from {{part}} group by p_partkey % 104 + 1) classes
"""

VIEWS["catalog"] = """
select id as code, name_vi as name, filename_base,
       case when priority in (1, 2, 3) then priority else 3 end as priority,
       n % 52 <> 0 as active,
       case when n % 13 = 5 then 'KHONG_PHAT_SINH' else 'CHUA_XAC_DINH' end as default_applicability,
       substring(filename_base, length(id) + 2) as slug
from {entries}
"""

# The catalog as stored before this version: some codes missing, one retired.
VIEWS["stored_catalog"] = """
select case when n % 40 = 0 then 'R' || id else id end as code, 'old ' || name_vi as name, filename_base,
       3 as priority, n % 3 <> 0 as active,
       case when n % 4 = 0 then 'CAN_BO_SUNG' else 'CHUA_XAC_DINH' end as default_applicability
from {entries}
"""

# The richest customers are new in the current snapshot, the poorest have lost their folder.
VIEWS["folders_previous"] = f"""
select {folder('c_custkey')} as case_key, c_custkey as k, c_acctbal as bal from {{customer}} where c_acctbal < 9500
union all
select {archive('s_suppkey')} as case_key, s_suppkey as k, s_acctbal as bal from {{supplier}}
"""

VIEWS["folders"] = f"""
select case_key, '/data/' || case_key as folder_path, case_key as folder_name
from (select {folder('c_custkey')} as case_key from {{customer}} where c_acctbal > -500
      union all
      select {archive('s_suppkey')} as case_key from {{supplier}}) f
"""

# One file per order. The name pattern depends on the key: unparsable, wrong slug, empty slug,
# upper-case extension or slug, or canonical with a sequence number.
VIEWS["files"] = f"""
select case_key, case_key || '/' || filename as relative_path, filename,
       size_bytes, size_bytes + case when k % 7 = 0 then 1 else 0 end as size_now,
       k * 1000003 + 17 as mtime_ns, {{sha}}content{{end}} as sha256,
       {{sha}}case when k % 7 = 0 then content || ':v2' else content end{{end}} as sha256_now,
       readable, case when readable then cast(1 + k % 5 as int) end as page_count,
       k, c, v, n, code, in_previous, in_current
from (
  select k, c, v, n, {code('n')} as code, {folder('c')} as case_key, content, size_bytes,
         k % 29 <> 0 as readable, in_previous, in_current,
         case v when 0 then 'not-a-document-' || {text('k')} || '.pdf'
                when 1 then {code('n')} || '.wrong_slug.' || {text('k')} || '.pdf'
                when 2 then {code('n')} || '..' || {text('k')} || '.pdf'
                when 3 then {code('n')} || '.' || coalesce(slug, 'tai_lieu_la') || '.' || {text('k')} || '.PDF'
                when 4 then {code('n')} || '.' || upper(coalesce(slug, 'tai_lieu_la')) || '.' || {text('k')} || '.pdf'
                else {code('n')} || '.' || coalesce(slug, 'tai_lieu_la') || '.' || {text('k')} || '.pdf' end as filename
  from (select o_orderkey as k, o_custkey as c, o_orderkey % 13 as v, (o_orderkey * 7 + o_custkey) % 110 + 1 as n,
               {text('o_custkey')} || ':' || o_orderstatus || ':' || o_orderpriority as content,
               cast(floor(o_totalprice) as bigint) as size_bytes,
               {_IN_PREVIOUS} as in_previous, {_IN_CURRENT} as in_current
        from {{orders}}) o
  left join (select code as type_code, slug from {{catalog}}) t on type_code = {code('n')}
) named
"""

VIEWS["listing"] = """
select relative_path, case_key, size_now as size_bytes, mtime_ns
from {files} where in_current and case_key in (select case_key from {folders})
"""

VIEWS["probe"] = """
select relative_path, sha256_now as sha256, page_count, readable
from {files} where in_current and case_key in (select case_key from {folders})
"""

# The document table after the previous scan. One in 31 was already absent; customers
# 0 mod 29 were absent with all their documents.
VIEWS["documents_previous"] = f"""
select case_key, relative_path, filename, case when v <> 0 then f.code end as taxonomy_code,
       name as taxonomy_name, case when v = 0 then null else k end as sequence_no,
       priority, size_bytes, mtime_ns, sha256, page_count,
       case when not readable then 'FILE_KHONG_DOC_DUOC' when v in (0, 2) then 'MALFORMED_NAME'
            when n > 104 then 'FILE_NGOAI_TAXONOMY' else 'OK' end as parse_status,
       k % 31 <> 0 and c % 29 <> 0 as is_present,
       {T0} as first_seen_at, {T0} as last_seen_at, {T0} as last_hashed_at
from {{files}} f left join {{catalog}} t on t.code = f.code and v <> 0
where in_previous and case_key in (select case_key from {{folders_previous}})
"""

# The case table before the current scan: some cases completed or set by hand, some absent.
VIEWS["cases_previous"] = f"""
select case_key, '/old/' || case_key as folder_path, case_key as folder_name,
       cast(null as varchar(40)) as m1, cast(null as varchar(40)) as m2, cast(null as varchar(40)) as m3,
       cast(null as varchar(40)) as m4, cast(null as varchar(40)) as m5,
       cast(null as varchar(40)) as citizen_id, cast(null as varchar(40)) as person_name_raw,
       cast(null as varchar(40)) as person_name_display, cast(null as varchar(40)) as unit_code,
       'CHUA_XU_LY' as auto_status,
       case k % 11 when 0 then 'HOAN_THANH' when 1 then 'DANG_SO_HOA' end as manual_status,
       case k % 11 when 0 then 'HOAN_THANH' when 1 then 'DANG_SO_HOA' when 2 then 'CHO_KIEM_TRA'
                   else 'CHUA_XU_LY' end as effective_status,
       cast(0 as double) as progress_percent, cast(0 as bigint) as document_count,
       cast(0 as bigint) as warning_count, cast(0 as bigint) as missing_priority1_count,
       cast(0 as bigint) as type_count, cast(0 as bigint) as missing_type_count,
       k % 29 <> 0 as is_present,
       {T0} as first_seen_at, {T0} as last_seen_at, {T0} + (k % 86400) * interval '1' second as last_scanned_at,
       case when k % 11 = 0 then {T0} + (k % 60) * interval '1' day end as completed_at,
       case when k % 22 = 0 then 'operator ' || {text('k')} end as reviewed_by,
       case when k % 5 = 0 then 'note ' || {text('k')} end as note
from {{folders_previous}}
"""

VIEWS["evidence"] = f"""
select {folder('o_custkey')} as case_key,
       case when l_quantity > 40 then {code('(l_partkey % 110 + 1)')} end as type_id
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
"""

# Operator actions. Some name unknown cases (users 7 mod 50), bad codes or bad statuses.
VIEWS["actions"] = f"""
select case when user_id % 50 = 7 then 'unknown ' || {text('user_id')} else {folder('user_id')} end as case_key,
       case event_type when 'click' then 'override' when 'error' then 'manual_status'
            when 'purchase' then 'complete' when 'signup' then 'reopen' else 'note' end as action,
       case when event_type = 'click' then {code('(event_id * 7 % 106 + 1)')} end as code,
       case when event_type = 'click' then
                 case event_id % 9 when 0 then 'CO_TAI_LIEU' when 1 then 'KHONG_PHAT_SINH'
                      when 2 then 'CHUA_XAC_DINH' when 8 then 'bogus' else 'CAN_BO_SUNG' end
            when event_type = 'error' then
                 case event_id % 5 when 0 then 'CHUA_XU_LY' when 1 then 'DANG_SO_HOA' when 2 then 'CHO_KIEM_TRA'
                      when 3 then 'CAN_BO_SUNG' else 'HOAN_THANH' end end as status,
       case when event_type in ('click', 'view') then props end as note,
       case when event_type = 'purchase' and event_id % 3 <> 0 then 'reviewer ' || {text('event_id % 10')} end as reviewed_by,
       cast(ts as timestamp) as ts, event_id as seq
from {{events}}
"""

# Actions that pass all checks.
VIEWS["accepted"] = """
select a.* from {actions} a
left join {catalog} t on t.code = a.code
where a.case_key in (select case_key from {folders_previous})
  and (a.action <> 'override' or (a.status <> 'bogus' and coalesce(t.active, false)))
  and (a.action <> 'manual_status' or a.status <> 'HOAN_THANH')
"""

# Overrides stored before the actions.
VIEWS["overrides"] = f"""
select case_key, code as taxonomy_code,
       case (k + n) % 4 when 0 then 'CO_TAI_LIEU' when 1 then 'KHONG_PHAT_SINH' when 2 then 'CHUA_XAC_DINH'
            else 'CAN_BO_SUNG' end as status,
       cast(null as varchar(40)) as note, {T0} as updated_at
from (select case_key, k, k % 110 + 1 as n, {code('(k % 110 + 1)')} as code from {{folders_previous}}) f
"""

# Warnings stored before the current scan: what the previous one raised for file names, and
# reviews pending on customers in debt.
VIEWS["warnings_previous"] = f"""
select case_key, relative_path, 'SAI_TEN_FILE' as warning_type, 'WARNING' as severity,
       'Tên file không theo mẫu: ' || filename as message, k % 5 <> 0 as active,
       case_key || ':' || relative_path || ':SAI_TEN_FILE:Tên file không theo mẫu: ' || filename as fingerprint,
       {T0} as created_at, {T0} as updated_at
from {{files}} where in_previous and (filename like 'not-a-document%' or filename like '%..%')
  and case_key in (select case_key from {{folders_previous}})
union all
select case_key, cast(null as varchar(40)) as relative_path, 'REVIEW_PENDING' as warning_type,
       'WARNING' as severity, 'review' as message, bal < 0 as active,
       case_key || ':case:REVIEW_PENDING:review' as fingerprint, {T0} as created_at, {T0} as updated_at
from {{folders_previous}}
"""

# Reviews reported from outside after the scan.
VIEWS["reviews"] = f"""
select {folder('c_custkey')} as case_key, cast(null as varchar(40)) as relative_path,
       case when c_nationkey % 2 = 0 then 'REVIEW_PENDING' else 'CAN_XAC_MINH' end as warning_type,
       'WARNING' as severity, 'review' as message, c_acctbal < 0 as active,
       {folder('c_custkey')} || ':case:review' as fingerprint, {T1} as created_at, {T1} as updated_at
from {{customer}}
"""

# A finished case table for the read queries.
VIEWS["cases"] = f"""
select case_key, '/data/' || case_key as folder_path, case_key as folder_name,
       citizen_id, person_name_raw, replace(person_name_raw, '_', ' ') as person_name_display, unit_code,
       auto_status, manual_status, coalesce(manual_status, auto_status) as effective_status,
       cast((k * 37) % 10001 as double) / 100 as progress_percent,
       k % 9 as document_count, case when k % 4 = 0 then k % 3 else 0 end as warning_count,
       case when k % 6 = 0 then k % 5 else 0 end as missing_priority1_count,
       k % 8 as type_count, k % 6 as missing_type_count, is_present,
       {T0} as first_seen_at, {T1} as last_seen_at,
       {T1} + ((k * 7919) % 86400) * interval '1' second as last_scanned_at,
       case when manual_status = 'HOAN_THANH' then {T1} end as completed_at,
       cast(null as varchar(40)) as reviewed_by, cast(null as varchar(40)) as note, k
from (select c_custkey as k, {folder('c_custkey')} as case_key,
             case when c_custkey % 17 <> 0 then lpad({text('c_custkey')}, 12, '0') end as citizen_id,
             case when c_custkey % 17 <> 0 then
                  case c_custkey % 3 when 0 then 'Đỗ_Thị_' when 1 then 'Nguyen_Van_' else 'le_VAN_' end || {text('c_custkey')}
                  end as person_name_raw,
             case when c_custkey % 17 = 0 then null when c_custkey % 23 = 0 then ''
                  else lpad({text('c_custkey % 25')}, 2, '0') end as unit_code,
             case c_nationkey % 4 when 0 then 'CHUA_XU_LY' when 1 then 'DANG_SO_HOA' when 2 then 'CHO_KIEM_TRA'
                  else 'CAN_BO_SUNG' end as auto_status,
             case when c_mktsegment = 'HOUSEHOLD' then 'HOAN_THANH' when c_mktsegment = 'MACHINERY' then 'DANG_SO_HOA'
                  end as manual_status,
             c_acctbal > -900 as is_present
      from {{customer}}
      union all
      select s_suppkey as k, {archive('s_suppkey')} as case_key, null as citizen_id, null as person_name_raw,
             null as unit_code, 'CHUA_XU_LY' as auto_status, null as manual_status, s_acctbal > -900 as is_present
      from {{supplier}}) base
"""

# A finished warning table: one row per order.
VIEWS["warnings"] = f"""
select {folder('o_custkey')} as case_key, {text('o_orderkey')} || '.pdf' as relative_path,
       case o_orderkey % 4 when 0 then 'SAI_TEN_FILE' when 1 then 'TRUNG_TAI_LIEU'
            when 2 then 'FILE_NGOAI_TAXONOMY' else 'FILE_KHONG_DOC_DUOC' end as warning_type,
       case when o_orderkey % 4 = 3 then 'ERROR' else 'WARNING' end as severity,
       o_orderpriority as message, o_orderstatus = 'O' as active,
       {text('o_custkey')} || ':' || {text('o_orderkey')} as fingerprint,
       cast(o_orderdate as timestamp) as created_at, cast(o_orderdate as timestamp) as updated_at
from {{orders}}
"""

# A finished history table: one row per event.
VIEWS["history"] = f"""
select {folder('user_id')} as case_key,
       case event_type when 'click' then 'CHECKLIST_OVERRIDE' when 'error' then 'MANUAL_STATUS_CHANGED'
            when 'purchase' then 'MARK_COMPLETED' when 'signup' then 'REOPENED' else 'NOTE_UPDATED' end as event_type,
       cast(null as varchar(40)) as from_status, cast(null as varchar(40)) as to_status,
       props as detail, cast(ts as timestamp) as created_at, event_id as seq
from {{events}}
"""

# One scan run per order date.
VIEWS["runs"] = """
select cast(extract(year from started_at) * 10000 + extract(month from started_at) * 100
            + extract(day from started_at) as bigint) as run_id, started_at,
       started_at + interval '5' second as ended_at,
       case when files_seen % 5 = 0 then 'ERROR' else 'SUCCESS' end as status, folders_seen, files_seen
from (select cast(o_orderdate as timestamp) as started_at, count(distinct o_custkey) as folders_seen,
             count(*) as files_seen
      from {orders} group by o_orderdate) days
"""

# Files for naming: canonical names, with plain (unnumbered) ones for some types.
VIEWS["named_files"] = """
select case_key, case_key || '/' || filename as relative_path, filename, is_present
from (
  select case_key, f.code || '.' || coalesce(slug, 'tai_lieu_la') || case when f.code in ('07', '33', '101') then '' else '.' || seq end
         || '.pdf' as filename, max(in_current) as is_present
  from (select case_key, code, in_current, cast(k % 9 + 1 as varchar(40)) as seq from {files}) f
  left join {catalog} t on t.code = f.code
  group by 1, 2
) names
"""

# One import request per order: a session token, a type, one to four pages of two sources.
VIEWS["requests"] = f"""
select case when o_orderkey % 41 = 0 then 'no-token-' || {text('o_orderkey')} else md5({text('o_orderkey')}) end as token,
       {folder('o_custkey')} as case_key,
       case when o_orderkey % 37 = 0 then 'UNKNOWN' else {code('((o_orderkey * 3 + o_custkey) % 4 * 26 + 7)')} end as type_id,
       case when o_orderkey % 2 = 0 then '2024-01-01' else '' end as document_date, o_orderpriority as note,
       o_orderkey as k, o_orderkey % 4 + 1 as n_pages,
       cast(o_orderdate as timestamp) as requested_at
from {{orders}}
"""

# Timestamps as text, in the forms the formatters meet.
VIEWS["stamps"] = f"""
select event_id, case event_id % 7
         when 0 then replace(written, ' ', 'T') || '+07:00' when 1 then replace(written, ' ', 'T') || 'Z'
         when 2 then substring(written, 1, 10) when 3 then 'bad ' || written when 4 then ''
         when 5 then ' ' || written || '  ' end as written
from (select event_id, {text('ts')} as written from {{events}}) e
"""


# The same moments in every form of ISO 8601, good and bad.
_DAY, _TIME = "substring(written, 1, 10)", "substring(written, 12)"
VIEWS["stamp_forms"] = f"""
select event_id, y, w, d, written as plain, case event_id % 16
         when 0 then written when 1 then replace(replace({_DAY}, '-', '') || 'T' || {_TIME}, ':', '')
         when 2 then {_DAY} || 'x' || replace({_TIME}, '.', ',') when 3 then {_DAY} || ' ' || substring({_TIME}, 1, 2)
         when 4 then y || '-W' || w || '-' || d || 'T' || substring({_TIME}, 1, 5) when 5 then y || 'W' || w || d
         when 6 then y || '-W' || w when 7 then replace({_DAY}, '-', '') || ' ' || substring({_TIME}, 1, 5) || 'Z'
         when 8 then written || '+23:59' when 9 then written || '+99:99' when 10 then written || '-0530'
         when 11 then {_DAY} || 'T' || substring({_TIME}, 1, 5) || '+24:00' when 12 then {_DAY} || 'T'
         when 13 then substring(written, 1, 4) || '-13-01 ' || {_TIME} when 14 then {_DAY} || 'T2' || substring({_TIME}, 2, 1) || ':61'
         else {_DAY} || ' ' || {_TIME} || '+05' end as written
from (select event_id, {text('ts')} as written, {text('1999 + event_id % 31')} as y, {code('event_id % 54')} as w,
             {text('event_id % 8')} as d from {{events}}) e
"""

# Names whose case is not a matter of single ASCII letters, with their folded form spelled out.
VIEWS["odd_names"] = f"""
select k, case k % 8 when 0 then 'ΟΔΟΣ' when 1 then 'οδος' when 2 then 'Straße' when 3 then 'STRASSE' when 4 then 'İstanbul'
                     when 5 then 'ISTANBUL' when 6 then 'ıstanbul' else 'ĐƠN XIN' end || '/' || {text('k')} || '.pdf' as relative_path,
       case k % 8 when 0 then 'οδοσ' when 1 then 'οδοσ' when 2 then 'strasse' when 3 then 'strasse' when 4 then 'i̇stanbul'
                  when 5 then 'istanbul' when 6 then 'ıstanbul' else 'đơn xin' end || '/' || {text('k')} || '.pdf' as folded
from (select o_orderkey as k from {{orders}}) o
"""

# Texts of session manifests, some of them broken.
_OPEN, _SHUT = "chr(123)", "chr(125)"  # braces are taken by the views themselves
VIEWS["manifest_texts"] = f"""
select md5({text('o_orderkey')}) as token, o_orderkey as k,
       case o_orderkey % 10 when 0 then {_OPEN} || '"case_id": "' when 1 then '[1, 2]'
         when 2 then {_OPEN} || '"case_id": "x", "pages": "none"' || {_SHUT} when 3 then {_OPEN} || '"case_id": "x"' || {_SHUT} when 4 then ''
         else {_OPEN} || '"case_id": "' || {text('o_custkey')} || '", "sources": [], "pages": [' || {_OPEN}
              || '"page_id": "p1", "source_page": 1' || {_SHUT} || ']' || {_SHUT} end as text
from {{orders}}
"""

# An inventory as an object store writes it: absolute paths of all kinds of files.
VIEWS["inventory"] = f"""
select case k % 9 when 0 then '/other/' when 1 then '/data/.hidden/' when 2 then '/data/a/../' else '/data/' end || relative_path
         || case when k % 7 = 0 then '.txt' else '' end as path, size_bytes, mtime_ns
from {{files}}
"""

# Uploads: a session for each order, a file for each of its lines. Names come with folders, odd extensions and none.
VIEWS["sessions"] = f"""
select md5({text('o_orderkey')}) as token, {folder('o_custkey')} as case_key, o_orderkey as k from {{orders}}
"""
VIEWS["uploads"] = f"""
select md5({text('l_orderkey')}) as token, {folder('o_custkey')} as case_key, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as int) as position,
       case when l_partkey % 151 = 0 then '' when l_partkey % 97 = 0 then 'C/' || {text('l_partkey')} || '.tif'
            when l_partkey % 3 = 0 then 'photo ' || {text('l_partkey')} || '.JPG' when l_partkey % 3 = 1 then 'a.b/' || {text('l_suppkey')} || '.pdf'
            else 'scan.' || {text('l_partkey')} || '.PDF' end as name,
       {{sha}}{text('l_partkey')} || ':' || {text('l_linenumber')}{{end}} as sha256,
       case when l_suppkey % 61 = 7 then null else cast(case when l_suppkey % 53 = 9 then 0 else l_quantity end as int) end as page_count
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
where l_orderkey % 19 <> 0
"""


def dependencies(sql: str, known: dict[str, str]) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", sql)) if n in known]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """DuckDB text: ``sql`` preceded by the views it names in braces."""
    known = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(body: str) -> None:
        for name in dependencies(body, known):
            if name not in order:
                visit(known[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    names = {**{t: t for t in TABLES}, **{n: f"v_{n}" for n in known}, "sha": "sha256(", "end": ")"}

    def fill(body: str) -> str:
        return re.sub(r"\{(\w+)\}", lambda m: names.get(m[1], m[0]), body).strip()

    if not order:
        return fill(sql)
    return "with " + ",\n".join(f"v_{n} as ({fill(known[n])})" for n in order) + "\n" + fill(sql)
