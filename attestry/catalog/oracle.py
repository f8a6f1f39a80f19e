"""DuckDB SQL for the registered queries, written apart from the Spark code.

Every text is self-contained: the shared tables are common table expressions
put in front of the query that names them.
"""

from __future__ import annotations

import re

from attestry.catalog.fixtures import NUMBERED
from attestry.functions.prompts import DEFAULT_TEMPLATE
from attestry.functions.text import WHITESPACE
from attestry.schemas import SIZE_BUCKETS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)


def _strip(sql: str) -> str:
    return f"trim({sql}, {_BLANKS})"


def _size_text(sql: str) -> str:
    """printf rounds by the exact binary value, as wanted."""
    x = f"({sql})::double"
    k = [1024.0**i for i in range(5)]
    return (
        f"case when {x} < {k[1]} then printf('%.1f B', {x})"
        f" when {x} < {k[2]} then printf('%.1f KB', {x} / {k[1]})"
        f" when {x} < {k[3]} then printf('%.1f MB', {x} / {k[2]})"
        f" when {x} < {k[4]} then printf('%.1f GB', {x} / {k[3]})"
        f" else printf('%.1f TB', {x} / {k[4]}) end"
    )


def _round1(sql: str) -> str:
    return f"printf('%.1f', {sql})::double"


def _pct(part: str, total: str) -> str:
    return _round1(f"{part}::double / {total} * 100")


_EXT = r"lower(regexp_extract(regexp_extract({0}, '[^/]*$'), '(?s)^\.*[^.].*(\.[^.]*)$', 1))"


def _ext(column: str) -> str:
    return _EXT.format(column)


def _ext_label(column: str) -> str:
    return f"coalesce(nullif({_ext(column)}, ''), '(no extension)')"


def _case(column: str) -> str:
    return rf"nullif(regexp_extract({column}, '^R_(\d+)_\d{{4}}/', 1), '')"


_BUCKET = (
    "case when size < 1048576 then '< 1 MB' when size < 10485760 then '1-10 MB'"
    " when size < 52428800 then '10-50 MB' when size < 104857600 then '50-100 MB'"
    " else '> 100 MB' end"
)
_ROUTE = (
    "case when ext = '.pdf' then 'pdf' when ext in ('.xlsx', '.xls') then 'excel'"
    " when ext in ('.png', '.jpg', '.jpeg', '.tiff', '.bmp') then 'image' else 'unsupported' end"
)
_MEDIA = (
    "case ext when '.jpg' then 'image/jpeg' when '.jpeg' then 'image/jpeg'"
    " when '.tiff' then 'image/tiff' when '.bmp' then 'image/bmp' else 'image/png' end"
)
_SUPPLIER_MATCH = (
    "case when extracted_supplier <> '' and db_supplier <> '' then"
    " contains(lower(db_supplier), lower(extracted_supplier))"
    " or contains(lower(extracted_supplier), lower(db_supplier)) end"
)
_IN_RANGE = (
    "case when extracted_price <> 0 and db_original_price > 0 then"
    " abs(extracted_price - db_original_price) / db_original_price < 0.2::double end"
)
_GARBAGE = (
    f"(item_name is null or {_strip('item_name')} = '' or lower(item_name) like '%as per%'"
    " or lower(item_name) like '%refer%' or lower(item_name) like '%attached%')"
)
_GRADE = (
    "case when db_is_garbage and our_canonical_name <> '' then 'MAJOR'"
    " when our_name_length > db_name_length * 1.5::double then 'MINOR'"
    " when abs(our_name_length - db_name_length) < 10 then 'SAME' else 'UNCLEAR' end"
)

# What makes the number and the id of an attachment: its row alone, or its place in the case.
_ROW_NUMBER = """\
                l_partkey * 3 + l_suppkey * 5 + l_linenumber as rn,
                ('0x' || left(md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|'
                  || l_suppkey || '|' || l_shipdate::date || '|' || l_returnflag || '|'
                  || l_linestatus), 15))::bigint as att_id,
"""
_CASE_NUMBER = """\
                row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber,
                  l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                  l_returnflag, l_linestatus) as rn,
"""

_TABLES = {
    "att": """
        select l_orderkey as ras_id, l_linenumber::bigint as dtl_id, att_id,
               case when l_partkey % 29 <> 0 then 'f' || (l_partkey % 7) || ext end as file_name,
               case l_partkey % 6 when 0 then 'Quotation' when 1 then 'MPBP' when 2 then 'BER'
                 when 3 then 'Email' when 4 then 'PO' end as att_type,
               case when l_partkey % 11 <> 0 then l_suppkey end as supplier_id,
               l_shipdate as uploaded_on, rn, l_partkey, l_suppkey, l_extendedprice,
               'R_' || l_orderkey || '_2025/' || file_name as path
        from (select *,
                l_partkey * 3 + l_suppkey * 5 + l_linenumber as rn,
                ('0x' || left(md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|'
                  || l_suppkey || '|' || l_shipdate::date || '|' || l_returnflag || '|'
                  || l_linestatus), 15))::bigint as att_id,
                case (l_linenumber + l_partkey) % 10 when 0 then '.pdf' when 1 then '.PDF'
                  when 2 then '.xlsx' when 3 then '.xls' when 4 then '.png' when 5 then '.jpeg'
                  when 6 then '.msg' when 7 then '.docx' when 8 then '' else '.tiff' end as ext
              from lineitem)""",
    "loc": """
        select *, case l_suppkey % 5 when 1 then '/' || path when 2 then 'box/' || path
                    when 3 then '/box/' || path when 4 then '  ' || path || ' ' end as file_location
        from att""",
    "blob": """
        select name, max(size) as size from (
          select path as name, cast(floor(l_extendedprice * case rn % 4 when 0 then 1 when 1 then 20
                   when 2 then 400 else 4000 end) as bigint) as size
          from att where path is not null and (ras_id + rn) % 13 <> 0
          union all select 'misc/doc_' || doc_id || '.txt', n_chars from documents)
        group by name""",
    "bi": """
        select l_orderkey as ras_id,
               case l_partkey % 9 when 0 then null when 1 then '  ' when 2 then 'As per attached'
                 when 3 then 'Refer annexure' when 4 then p_brand when 5 then p_name
                 else p_name || ' ' || p_brand end as item_name,
               p_type as category,
               case when l_suppkey % 8 = 0 then null when l_suppkey % 3 = 0
                 then upper(s_name) || ' LTD' else s_name end as supplier,
               case when l_partkey % 31 = 0 then null when l_partkey % 23 = 0 then 0::double
                 else l_extendedprice end as original_inr,
               l_extendedprice * (1 - l_discount) as negotiated_inr
        from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey""",
    "resp": """
        select att_id::varchar as request_id,
          case rn % 5 when 0 then body
            when 1 then '```json' || chr(10) || body || chr(10) || '```'
            when 2 then '```' || body || '```' when 3 then '  ' || body || chr(10)
            else '```json' || body end
          || case when l_partkey % 17 = 0 then ' trailing prose' else '' end as raw
        from (select *,
          case when l_partkey % 19 = 0 then '[1]' when l_partkey % 37 = 0 then 'null' else
            '{"document_classification": {"verified_type": "'
            || case when l_suppkey % 4 = 0 then 'Invoice' else coalesce(att_type, 'Other') end
            || '", "confidence": "'
            || case l_suppkey % 3 when 0 then 'high' when 1 then 'medium' else 'low' end
            || '", "att_type_matches_content": '
            || case when l_suppkey % 7 = 0 then 'null' when l_suppkey % 4 <> 0
                 and att_type is not null then 'true' else 'false' end
            || ', "att_type_from_db": "' || coalesce(att_type, 'unknown') || '", "classification_reason": '
            || case when l_suppkey % 5 = 0 then 'null' else '"part ' || l_partkey || ' is named"' end
            || '}, "is_quotation": ' || case when l_partkey % 2 = 0 then 'true' else 'false' end
            || ', "quotation_data": '
            || case when l_partkey % 2 = 1 or l_partkey % 41 = 0 then 'null' else
                 '{"supplier_name": "Supplier#' || lpad(l_suppkey::varchar, 9, '0')
                 || '", "canonical_item_name": '
                 || case when l_partkey % 13 = 0 then 'null'
                      else '"Item ' || l_partkey || ' model X"' end
                 || ', "quoted_price": '
                 || case when l_partkey % 43 = 0
                           then '"' || cast(l_extendedprice as decimal(18,2)) || '"'
                         when l_partkey % 47 = 0 then '"8,623"'
                         else cast(l_extendedprice * case when rn % 3 = 0 then 1.5::double
                                else 1.1::double end as decimal(18,0))::varchar end
                 || case when l_suppkey % 6 = 0 then '' else
                      ', "currency": "' || ['INR', 'USD', 'EUR'][l_suppkey % 3 + 1]
                      || '", "unit_price": ' || l_suppkey || '.5, "item_model": "M-' || l_partkey % 100
                      || '", "technical_specifications": {"power": "' || l_partkey % 50
                      || ' kW", "weight": ' || l_suppkey || '}, "quantity": "' || l_partkey % 9
                      || ' pcs", "payment_terms": "' || l_suppkey % 90
                      || ' days", "delivery_terms": "FOB", "warranty": null, "validity": "30 days"'
                      || ', "quotation_date": "2024-01-0' || (l_partkey % 9 + 1)
                      || '", "quotation_reference": "Q-' || l_partkey || '"' end
                 || '}' end
            || ', "additional_items": ' || case when l_partkey % 4 = 0
                 then '[{"item_name": "Spare ' || l_partkey || '", "price": ' || l_suppkey
                      || ', "specs": null}, {"item_name": "Kit", "price": "on request"}]' else '[]' end
            || ', "raw_summary": '
            || case when l_partkey % 3 = 0 then 'null' else '"About part ' || l_partkey || '."' end
            || '}' end as body
          from att where file_name is not null)""",
    "sheet_row": """
        select coalesce(lang, 'none') as file, source as sheet,
               substr(source, 4)::int + 1 as sheet_no, doc_id as row_no,
               coalesce(text, '') as line
        from documents""",
    "customer_cell": r"""
        select 'nation_' || c_nationkey || '.xlsx' as file,
               case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2
                 when 'FURNITURE' then 3 when 'HOUSEHOLD' then 4 else 5 end as sheet_no,
               c_mktsegment as sheet, c_custkey + 2 as row_no,
               case when c_custkey % 5 <> 0 then c_name end as c1,
               case when c_custkey % 7 <> 3 then c_acctbal::decimal(18,2)::varchar end as c2,
               case when c_custkey % 3 = 0 then 'a\n' || c_custkey % 11 || '\tb' end as c3,
               case when c_custkey % 4 = 0 then left(c_name || ' ' || c_name || ' ' || c_name, 47) || '...'
                    else 'é' end as c5
        from customer""",
    "cell_line": """
        select file, sheet_no, sheet, row_no,
               lpad(coalesce(c1, 'NaN'), greatest(8, w1)::int, ' ') || ' '
               || lpad(coalesce(c2, 'NaN'), greatest(15, w2)::int, ' ') || ' '
               || case when three then lpad(coalesce(c3, 'NaN'), greatest(10, w3)::int, ' ')
                       else lpad('NaN', 10, ' ') end || ' '
               || lpad('NaN', 10, ' ') || ' ' || lpad(c5, greatest(4, w5)::int, ' ') as line
        from (select *, max(coalesce(length(c1), 3)) over s as w1, max(coalesce(length(c2), 3)) over s as w2,
                     max(coalesce(length(c3), 3)) over s as w3, max(length(c5)) over s as w5,
                     bool_or(c3 is not null) over s as three
              from customer_cell window s as (partition by file, sheet_no, sheet))
        union all
        select file, sheet_no, sheet, 1,
               lpad('customer', greatest(8, max(coalesce(length(c1), 3)))::int, ' ') || ' '
               || lpad('account balance', greatest(15, max(coalesce(length(c2), 3)))::int, ' ') || ' '
               || lpad('Unnamed: 2', greatest(10, max(coalesce(length(c3), 3)))::int, ' ') || ' Unnamed: 3 '
               || lpad('note', greatest(4, max(length(c5)))::int, ' ')
        from customer_cell group by file, sheet_no, sheet""",
    "candidates": """
        select ras_id, count(*) as num_attachments,
               count(distinct supplier_id) as num_suppliers,
               count(distinct att_type) as num_doc_types,
               string_agg(distinct coalesce(att_type, 'NULL'), ', '
                          order by coalesce(att_type, 'NULL')) as doc_types,
               max(uploaded_on) as latest_upload
        from loc
        where uploaded_on >= (select max(l_shipdate) from lineitem) - interval 6 month
        group by ras_id
        having count(*) >= 3 and count(distinct supplier_id) >= 2
        order by num_suppliers desc, num_attachments desc, ras_id limit 50""",
    "sample": """
        select * from candidates
        order by num_suppliers desc, num_attachments desc, ras_id limit 5""",
    "norm": f"""
        select *, case when starts_with(b, 'box/') then substr(b, 5) else b end as blob_path
        from (select *, case when starts_with(a, '/') then substr(a, 2) else a end as b
              from (select *, nullif({_strip("file_location")}, '') as a from loc))""",
    "direct": """
        select norm.ras_id, file_name, att_type, supplier_id,
               'RAS_' || norm.ras_id || '/' || file_name as local_path, blob_path,
               size as size_bytes, att_id, uploaded_on
        from norm join blob on blob.name = norm.blob_path where file_name <> ''""",
    "fallback": r"""
        select c.ras_id, regexp_extract(name, '[^/]*$') as file_name, 'unknown' as att_type,
               null::bigint as supplier_id,
               'RAS_' || c.ras_id || '/' || regexp_extract(name, '[^/]*$') as local_path,
               name as blob_path, size as size_bytes, null::bigint as att_id,
               null::timestamp as uploaded_on
        from blob join (select distinct ras_id from loc
                        where ras_id not in (select ras_id from direct)) c
          on regexp_extract(name, '^R_(\d+)_', 1) = c.ras_id::varchar""",
    "routed": f"""
        select *, {_ROUTE} as route,
          case when ext in ('.doc', '.ppt', '.pptx', '.msg') then 'known_unconverted'
               when {_ROUTE} = 'unsupported' then 'unknown' end as reason
        from (select *, {_ext("file_name")} as ext from loc where file_name is not null)""",
    "cleaned": rf"""
        select request_id, {_strip(r"regexp_replace(regexp_replace(regexp_replace("
                                   + _strip("raw") + r", '^```json', ''), '^```', ''), '```\z', '')")}
                 as cleaned
        from resp""",
    "parsed": """
        select request_id,
          case when not json_valid(cleaned) then 'json_error'
               when json_type(case when json_valid(cleaned) then cleaned end) <> 'OBJECT'
                 then 'error' else 'success' end as status,
          case when json_type(case when json_valid(cleaned) then cleaned end) <> 'OBJECT'
               then 'not_an_object' end as error,
          case when json_valid(cleaned) and json_type(
                 case when json_valid(cleaned) then cleaned end) = 'OBJECT' then cleaned end as j
        from cleaned""",
    "fields": """
        select request_id, status, error,
          j ->> '$.document_classification.verified_type' as verified_type,
          j ->> '$.document_classification.confidence' as confidence,
          (j ->> '$.document_classification.att_type_matches_content')::boolean as matches,
          coalesce((j ->> '$.is_quotation')::boolean, false) as is_quotation,
          j ->> '$.quotation_data.supplier_name' as supplier_name,
          j ->> '$.quotation_data.canonical_item_name' as canonical_item_name,
          try_cast(j ->> '$.quotation_data.quoted_price' as double) as quoted_price,
          j ->> '$.quotation_data.currency' as currency,
          j ->> '$.document_classification.classification_reason' as said_reason,
          j ->> '$.document_classification.att_type_from_db' as said_type,
          try_cast(j ->> '$.quotation_data.unit_price' as double) as unit_price,
          j ->> '$.quotation_data.item_model' as item_model,
          j ->> '$.quotation_data.technical_specifications.power' as power,
          j ->> '$.quotation_data.technical_specifications.weight' as weight,
          concat_ws('; ', j ->> '$.quotation_data.quantity', j ->> '$.quotation_data.payment_terms',
                    j ->> '$.quotation_data.delivery_terms', j ->> '$.quotation_data.warranty',
                    j ->> '$.quotation_data.validity', j ->> '$.quotation_data.quotation_date',
                    j ->> '$.quotation_data.quotation_reference') as terms,
          json_array_length(j, '$.additional_items')::integer as num_additional,
          j ->> '$.additional_items[0].item_name' as additional_name,
          j ->> '$.additional_items[0].price' as additional_price,
          j ->> '$.raw_summary' as raw_summary
        from parsed""",
    "stored": """
        select *, 'RAS_' || ras_id || '_' || replace(replace(file_name, '/', '_'), '\\', '_')
                  || '.json' as json_file
        from routed join fields on fields.request_id = routed.att_id::varchar
        where status = 'success'""",
    "docs": """
        select * from (select *, row_number() over (partition by json_file
                         order by uploaded_on desc, att_id desc) as copy
                       from stored where route <> 'unsupported') where copy = 1""",
    "results": """
        select r.ras_id, r.file_name,
          case when st in ('success', 'unsupported') then ext end as ext, st as status,
          case when st = 'success' then verified_type end as verified_type,
          case when st = 'success' then att_type end as att_type_from_db,
          case when st = 'success' then matches end as att_type_matches,
          case when st = 'success' then is_quotation end as is_quotation,
          case when st = 'success' and is_quotation then canonical_item_name end
            as canonical_item_name,
          case when st = 'success' and is_quotation then quoted_price end as quoted_price,
          case when st = 'success' and is_quotation then supplier_name end as supplier_name,
          case when st = 'error' then error end as error
        from (select routed.*, fields.* exclude (request_id),
                case when blob.name is null then 'not_found'
                     when route = 'unsupported' then 'unsupported' else status end as st
              from routed left join blob on blob.name = routed.path
                   left join fields on fields.request_id = routed.att_id::varchar) r""",
    "first_call": """
        select att_id::varchar as request_id, l_partkey, l_suppkey, raw, 1 as call_no,
               3000 as max_tokens, case l_partkey % 5 when 0 then 'failed' when 1 then 'cut'
                 else 'finished' end as outcome
        from resp join att on att.att_id::varchar = resp.request_id where l_partkey % 13 <> 5""",
    "call": """
        select request_id, call_no, max_tokens, outcome,
               case outcome when 'finished' then raw when 'cut' then left(raw, length(raw) // 2) end as raw,
               case when outcome = 'failed' then 'timeout' end as error
        from (select * from first_call
              union all by name
              select request_id, l_partkey, l_suppkey, raw, 2 as call_no,
                     case when outcome = 'cut' then 6000 else 3000 end as max_tokens,
                     case when outcome = 'cut' and l_suppkey % 3 = 0 then 'cut'
                       when l_suppkey % 3 = 1 then 'failed' else 'finished' end as outcome
              from first_call where outcome <> 'finished' and l_suppkey % 4 <> 0)""",
    "last_call": """
        select * from call
        qualify row_number() over (partition by request_id
          order by outcome = 'finished' desc, call_no desc) = 1""",
    "line": """
        select event_id, case event_id % 10 when 3 then left(good, length(good) - 1)
                 when 4 then '[' || props || ']' when 5 then good || ' and more'
                 when 6 then event_type else good end as raw
        from (select *, '{"json_file": '
                || case when event_id % 17 = 0 then 'null' else '"e' || event_id || '"' end
                || ', "is_quotation": ' || case when user_id % 2 = 0 then 'true' else 'false' end
                || ', "quotation_data": {"supplier_name": "' || event_type || '", "quoted_price": '
                || case when event_id % 11 = 0 then '"n/a"' else value::decimal(18,2)::varchar end
                || ', "currency": "' || ['INR', 'USD', 'EUR'][user_id % 3 + 1]
                || '", "technical_specifications": ' || props || '}, "raw_summary": "user ' || user_id
                || '", "meta": {"ras_id": "' || user_id || '", "supplier_id_from_db": ' || user_id
                || '}}' as good
              from events)""",
    "doc_class": """
        select ras_id::varchar as ras_id, file_name, att_type as att_type_from_db,
               verified_type as our_verified_type, confidence as our_confidence, matches,
               said_reason as reason
        from docs""",
    "prices": f"""
        select ras_id, file_name, extracted_supplier, db_supplier,
               {_SUPPLIER_MATCH} as supplier_match, extracted_price, currency, db_original_price,
               db_negotiated_price, {_IN_RANGE} as price_in_range
        from (select docs.ras_id::varchar as ras_id, file_name,
                     supplier_name as extracted_supplier, supplier as db_supplier,
                     quoted_price as extracted_price, currency,
                     original_inr as db_original_price, negotiated_inr as db_negotiated_price
              from docs join bi on docs.ras_id = bi.ras_id where is_quotation)""",
    "pair": f"""
        select *, {_IN_RANGE} as price_in_range, {_GRADE} as improvement
        from (select json_file, docs.ras_id::varchar as ras_id, file_name,
                     quoted_price as extracted_price, original_inr as db_original_price,
                     canonical_item_name as our_canonical_name,
                     coalesce(length(canonical_item_name), 0)::integer as our_name_length,
                     coalesce(length(item_name), 0)::integer as db_name_length,
                     {_GARBAGE} as db_is_garbage
              from docs join bi on docs.ras_id = bi.ras_id where is_quotation)""",
    "names": f"""
        select ras_id, file_name, db_item_name, db_name_length, db_has_specs, db_is_garbage,
               our_canonical_name, our_name_length, our_has_specs,
               (our_name_length > db_name_length and our_has_specs) or db_is_garbage
                 as our_is_better,
               {_GRADE} as improvement
        from (select docs.ras_id::varchar as ras_id, file_name, item_name as db_item_name,
                     coalesce(length(item_name), 0)::integer as db_name_length,
                     coalesce(regexp_matches(item_name, '[0-9]'), false) as db_has_specs,
                     {_GARBAGE} as db_is_garbage, canonical_item_name as our_canonical_name,
                     coalesce(length(canonical_item_name), 0)::integer as our_name_length,
                     coalesce(regexp_matches(canonical_item_name, '[0-9]'), false)
                       as our_has_specs
              from docs join bi on docs.ras_id = bi.ras_id where is_quotation)""",
}


# Attachments with their place in the case as number, and an id of both.
_NUMBERED_ATT = (
    _TABLES["att"]
    .replace("dtl_id, att_id,", "dtl_id, l_orderkey * 100 + rn as att_id,")
    .replace(_ROW_NUMBER, _CASE_NUMBER)
)


def _with_tables(sql: str, numbered: bool) -> str:
    """Put the common tables a query needs, and those they need, in front of it."""
    known = _TABLES | {"att": _NUMBERED_ATT} if numbered else _TABLES
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"(from|join)\s+{name}\b", text):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    tables = ",\n".join(f"{name} as ({known[name]})" for name in needed)
    return f"with {tables}\n{sql}" if needed else sql


def _prompt(file_name: str, att_type: str) -> str:
    slots = {"file_name": file_name, "att_type": att_type}
    parts = re.split(r"\{(file_name|att_type)\}", DEFAULT_TEMPLATE.user)
    return " || ".join(slots[p] if i % 2 else _text(p) for i, p in enumerate(parts))


_LABEL = "coalesce(att_type, 'unknown')"
_FILE_PROMPT = _prompt("file_name", _LABEL)
_DOC_PROMPT = (
    _prompt("'doc_' || doc_id || '.xlsx'", "'unknown'")
    + f" || {_text(DEFAULT_TEMPLATE.text_header)} || text"
)
_DOMAIN = ", ".join(f"({i}, {_text(b)})" for i, b in enumerate(SIZE_BUCKETS, start=1))
_FILE_TYPES = f"""
    select extension, num_files, {_pct("num_files", "sum(num_files) over ()")} as pct, total_bytes,
           total_bytes / num_files as avg_bytes, {_size_text("total_bytes")} as total_size,
           {_size_text("total_bytes / num_files")} as avg_size, first_name
    from (select {_ext_label("name")} as extension, count(*) as num_files,
                 sum(size)::bigint as total_bytes, min(name) as first_name
          from blob group by 1)"""

_SQL = {
    "q01_inventory_summary": f"""
        select count(*) as total_files, sum(size)::bigint as total_bytes,
               count(distinct {_case("name")}) as distinct_cases,
               {_size_text("sum(size)")} as total_size
        from blob""",
    "q02_file_type_stats": f"select * exclude (first_name) from ({_FILE_TYPES})",
    "q02b_top_file_types": f"""
        select * from ({_FILE_TYPES}) order by num_files desc, first_name limit 15""",
    "q03_size_buckets": f"""
        select position, bucket, num_files,
               {_pct("num_files", "sum(num_files) over ()")} as pct
        from (select position, d.bucket, count(b.bucket) as num_files
              from (values {_DOMAIN}) d(position, bucket)
              left join (select {_BUCKET} as bucket from blob) b on b.bucket = d.bucket
              group by 1, 2)""",
    "q04_case_coverage": f"""
        select ras_id, num_files, total_bytes, {_size_text("total_bytes")} as total_size,
               file_types
        from (select {_case("name")} as ras_id, count(*) as num_files,
                     sum(size)::bigint as total_bytes, min(name) as first_name,
                     string_agg(distinct {_ext_label("name")}, ', '
                                order by {_ext_label("name")}) as file_types
              from blob where {_case("name")} is not null group by 1
              order by num_files desc, first_name)""",
    "q04b_largest_cases": f"""
        select ras_id, num_files, total_bytes, {_size_text("total_bytes")} as total_size,
               file_types
        from (select {_case("name")} as ras_id, count(*) as num_files,
                     sum(size)::bigint as total_bytes, min(name) as first_name,
                     string_agg(distinct {_ext_label("name")}, ', '
                                order by {_ext_label("name")}) as file_types
              from blob where {_case("name")} is not null group by 1
              order by num_files desc, first_name limit 500)""",
    "q04c_case_file_types": f"""
        select ras_id, chunk_no, substr(text, chunk_no * 16 + 1, 16) as text
        from (select *, unnest(range((length(text) + 15) // 16)) as chunk_no
              from (select {_case("name")} as ras_id,
                           string_agg(distinct {_ext_label("name")}, ', '
                                      order by {_ext_label("name")}) as text
                    from blob where {_case("name")} is not null group by 1))""",
    "q05_files_per_case_stats": f"""
        select min(n) as min_files, {_round1("sum(n)::double / count(*)")} as avg_files,
               list_sort(list(n))[count(*) // 2 + 1] as median_files, max(n) as max_files,
               count(*) as num_cases
        from (select count(*) as n from blob where {_case("name")} is not null
              group by {_case("name")})""",
    "q06_sample_paths": f"""
        select name as path, {_size_text("size")} as size, {_ext_label("name")} as extension
        from (select * from blob order by name limit 20)""",
    "q07_path_parse": f"""
        select name, size, {_case("name")} as ras_id, {_ext_label("name")} as extension
        from blob""",
    "q08_format_size": f"""
        select name, size, {_size_text("size")} as size_text, {_BUCKET} as bucket from blob""",
    "q09_select_cases": "select * from candidates",
    "q09b_pick_sample": "select * from sample",
    "q10_case_items": "select * from bi where ras_id in (select ras_id from candidates)",
    "q10b_doc_case_items": "select * from bi where ras_id in (select ras_id from docs)",
    "q11_case_attachments": """
        select ras_id, dtl_id, att_id, file_name, file_location, att_type, supplier_id, uploaded_on
        from loc where ras_id in (select ras_id from candidates)""",
    "q11b_doc_case_attachments": """
        select ras_id, att_id, file_name, att_type, supplier_id
        from loc where ras_id in (select ras_id from docs)""",
    "q12_normalise_location": "select att_id, file_location, blob_path from norm",
    "q13_resolve_direct": "select * from direct",
    "q14_resolve_fallback": "select * from fallback",
    "q15_manifest": "select * from direct union all by name select * from fallback",
    "q15b_sample_manifest": """
        select * from (select * from direct union all by name select * from fallback)
        where ras_id in (select ras_id from sample)""",
    "q15c_unresolved": """
        select ras_id, att_id, file_name, blob_path,
               case when blob_path is null then 'blank_location'
                    when file_name is null then 'null_file_name'
                    when file_name = '' then 'empty_file_name' else 'object_not_found' end as reason
        from norm where att_id not in (select att_id from direct)""",
    "q16_missing_files": """
        select ras_id, att_id, blob_path, blob_path in (select name from blob) as found
        from norm where blob_path is not null""",
    "q16b_read_contents": """
        select 'pages/' || page_id || '.html' as blob_path, page_id % 3 <> 0 as found,
               num_pieces, size, digest
        from pages left join (
          select page_id, count(*) as num_pieces, any_value(n)::bigint as size,
                 sha256(string_agg(sha256(unhex(piece)), '' order by k)) as digest
          from (select page_id, n, k, substr(h, k * 2000 + 1, 2000) as piece
                from (select page_id, hex(encode(html)) as h, octet_length(encode(html)) as n,
                             unnest(range(greatest(1, (octet_length(encode(html)) + 999) // 1000))) as k
                      from pages where page_id % 3 <> 0))
          group by page_id) using (page_id)""",
    "q16c_piece_plan": """
        select blob_path, k as piece_no, k * 67108864 as "offset",
               least(67108864, size_bytes - k * 67108864) as length
        from (select distinct blob_path, size_bytes,
                     unnest(range(greatest(1, (size_bytes + 67108863) // 67108864))) as k
              from direct)""",
    "q17_route": "select att_id, file_name, ext, route, reason from routed",
    "q18_media_type": f"select att_id, ext, {_MEDIA} as media_type from routed",
    "q19_render_prompt": f"""
        select source, {_text(DEFAULT_TEMPLATE.version)} as prompt_version,
               length(prompt)::bigint as prompt_chars, md5(prompt) as prompt_md5
        from (select 'att:' || att_id as source, {_FILE_PROMPT} as prompt
              from routed where route <> 'unsupported'
              union all select 'doc:' || doc_id, {_DOC_PROMPT} from documents)""",
    "q20_sheet_text": """
        select file, sheet_no, sheet, chunk_no, substr(text, chunk_no * 4096 + 1, 4096) as text
        from (select *, unnest(range((length(text) + 4095) // 4096)) as chunk_no
              from (select file, sheet_no, sheet, '=== Sheet: ' || sheet || ' ===' || chr(10) || chr(10)
                             || string_agg(line, chr(10) order by row_no) as text
                    from sheet_row group by file, sheet_no, sheet))""",
    "q20b_sheet_sizes": """
        select file, count(*) as num_sheets, sum(n)::bigint as num_rows,
               length(string_agg('=== Sheet: ' || sheet || ' ===' || chr(10) || chr(10) || body,
                                 chr(10) || chr(10)))::bigint as num_chars
        from (select file, sheet, sheet_no, count(*) as n, string_agg(line, chr(10)) as body
              from sheet_row group by all)
        group by file""",
    "q20c_row_text": "select file, sheet_no, sheet, row_no, line as row_text from cell_line",
    "q20d_cell_text": """
        select file, sheet_no, sheet, chunk_no, substr(text, chunk_no * 256 + 1, 256) as text
        from (select *, unnest(range((length(text) + 255) // 256)) as chunk_no
              from (select file, sheet_no, sheet, '=== Sheet: ' || sheet || ' ===' || chr(10) || chr(10)
                             || string_agg(line, chr(10) order by row_no) as text
                    from cell_line group by file, sheet_no, sheet))""",
    "q21b_message_parts": f"""
        select att_id::varchar as request_id, part_no::integer as part_no,
               case when part_no = 0 then 'text' else 'image_url' end as type,
               case when part_no = 0 then length({_FILE_PROMPT})::integer end as text_chars,
               case when part_no > 0 then 'data:' || case when route = 'pdf' then 'image/png'
                 else {_MEDIA} end || ';base64,' || to_base64(encode(path)) end as url,
               case when part_no > 0 then 'high' end as detail
        from (select *, unnest(range(0, 1 + case when route = 'image' then 1
                else rn % 8 end)) as part_no
              from routed where route in ('pdf', 'image'))""",
    "q22_clean_response": "select request_id, cleaned from cleaned",
    "q23_parse_status": "select request_id, status, error from parsed",
    "q24_typed_fields": """
        select request_id, verified_type, confidence, matches, is_quotation, supplier_name,
               canonical_item_name, quoted_price, currency, said_reason as reason, said_type, unit_price,
               item_model, power, weight, terms, num_additional, additional_name,
               additional_price, raw_summary
        from fields where status = 'success'""",
    "q25_latest_docs": """
        select json_file, att_id, uploaded_on, verified_type
        from (select *, row_number() over (partition by json_file
                order by uploaded_on desc, att_id desc) as copy from stored) where copy = 1""",
    "q25b_documents": """
        select json_file, ras_id::varchar as ras_id, file_name, ext as file_extension,
               att_type as att_type_from_db, supplier_id as supplier_id_from_db, is_quotation,
               canonical_item_name, quoted_price
        from docs""",
    "q25c_last_answers": """
        select request_id, call_no, max_tokens, outcome, md5(raw) as raw_md5, error from last_call""",
    "q25d_open_calls": """
        select request_id, coalesce(n, 0)::integer + 1 as call_no,
               case when bound is null then 3000 else least(2 * bound, 8000) end::integer as max_tokens
        from (select att_id::varchar as request_id from routed where route <> 'unsupported')
        left join (select request_id, max(call_no) as n, bool_or(outcome = 'finished') as done,
                          max(case when outcome = 'cut' then max_tokens end) as bound
                   from call group by request_id) using (request_id)
        where not coalesce(done, false) and coalesce(bound, 0) < 8000""",
    "q25e_document_lines": """
        select raw ->> '$.json_file' as json_file, (raw ->> '$.is_quotation')::boolean as is_quotation,
               raw ->> '$.quotation_data.supplier_name' as supplier_name,
               try_cast(raw ->> '$.quotation_data.quoted_price' as double) as quoted_price,
               raw ->> '$.quotation_data.currency' as currency,
               raw ->> '$.quotation_data.technical_specifications.k' as k,
               raw ->> '$.raw_summary' as raw_summary, raw ->> '$.meta.ras_id' as ras_id,
               (raw ->> '$.meta.supplier_id_from_db')::bigint as supplier_id
        from line where event_id % 10 not in (3, 4, 5, 6) and event_id % 17 <> 0""",
    "q25f_rejected_lines": """
        select null::varchar as json_file, event_id,
               case when event_id % 10 = 4 then 'not_an_object'
                    when event_id % 10 in (3, 5, 6) then 'json_error' else 'no_key' end as reason
        from line where event_id % 10 in (3, 4, 5, 6) or event_id % 17 = 0""",
    "q26_extraction_results": "select * from results",
    "q26b_results_of_calls": """
        select r.ras_id, r.file_name, case when st in ('success', 'unsupported') then ext end as ext,
          st as status, case when st = 'success' then verified_type end as verified_type,
          case when st = 'success' then att_type end as att_type_from_db,
          case when st = 'success' then matches end as att_type_matches,
          case when st = 'success' then is_quotation end as is_quotation,
          case when st = 'success' and is_quotation then canonical_item_name end
            as canonical_item_name,
          case when st = 'success' and is_quotation then quoted_price end as quoted_price,
          case when st = 'success' and is_quotation then supplier_name end as supplier_name,
          case when st = 'error' then why end as error
        from (select routed.*, fields.* exclude (request_id, error, status),
                case when route = 'unsupported' then 'unsupported'
                     when outcome = 'cut' then 'json_error' when outcome = 'finished' then status
                     else 'error' end as st,
                case when outcome = 'finished' then fields.error
                     else coalesce(last_call.error, 'no_response') end as why
              from routed left join last_call on last_call.request_id = routed.att_id::varchar
                   left join fields on fields.request_id = routed.att_id::varchar) r""",
    "q27_extraction_summary": """
        select count(*) as total, count(*) filter (status = 'success') as success,
               count(*) filter (is_quotation) as quotations,
               count(*) filter (status = 'success' and not att_type_matches)
                 as att_type_mismatches
        from results""",
    "q28_doc_classification": "select * from doc_class",
    "q29_classification_counts": """
        select count(*) as documents, count(*) filter (matches) as matches,
               count(*) filter (not matches) as mismatches,
               count(*) filter (matches is null) as not_judged
        from doc_class""",
    "q30_supplier_match": """
        select ras_id, extracted_supplier, db_supplier, supplier_match, count(*) as pairs
        from prices group by all""",
    "q30b_supplier_links": """
        select ras_id, extracted_supplier, db_supplier, count(*) as pairs
        from prices where supplier_match group by all""",
    "q31_price_check": "select * from prices",
    "q32_price_summary": """
        select count(*) filter (price_in_range) as price_hits,
               count(price_in_range) as price_checked,
               count(*) filter (supplier_match) as supplier_hits,
               count(supplier_match) as supplier_checked
        from prices""",
    "q32b_document_checks": """
        select json_file, ras_id, file_name, extracted_price, count(*) as items,
               count(price_in_range) as items_checked, count(*) filter (price_in_range) as hits,
               case when extracted_price > 0 then
                 min_by(db_original_price, (abs(db_original_price - extracted_price), db_original_price))
                   filter (db_original_price > 0) end as nearest_price,
               count(*) filter (improvement = 'MAJOR') as MAJOR,
               count(*) filter (improvement = 'MINOR') as MINOR,
               count(*) filter (improvement = 'SAME') as SAME,
               count(*) filter (improvement = 'UNCLEAR') as UNCLEAR,
               case when count(*) filter (improvement = 'MAJOR') > 0 then 'MAJOR'
                    when count(*) filter (improvement = 'MINOR') > 0 then 'MINOR'
                    when count(*) filter (improvement = 'SAME') > 0 then 'SAME' else 'UNCLEAR' end
                 as best_grade
        from pair group by json_file, ras_id, file_name, extracted_price""",
    "q33_name_quality": "select * from names",
    "q33b_item_name_features": f"""
        select ras_id, item_name, coalesce(length(item_name), 0)::integer as db_name_length,
               coalesce(regexp_matches(item_name, '[0-9]'), false) as db_has_specs,
               {_GARBAGE} as db_is_garbage
        from bi""",
    "q34_name_summary": "select improvement, count(*) as pairs from names group by improvement",
    "q35_mismatch_examples": """
        select ras_id, file_name, att_type_from_db, our_verified_type, reason
        from doc_class where not matches
        order by ras_id, file_name, att_type_from_db, our_verified_type, reason limit 3""",
    "q35b_improvement_examples": """
        select ras_id, file_name, db_item_name, our_canonical_name
        from names where improvement = 'MAJOR'
        order by ras_id, file_name, db_item_name nulls first, our_canonical_name limit 3""",
    "q36_manifest_csv": "select * from direct union all by name select * from fallback",
    "q36b_documents_json": """
        select json_file, ras_id::varchar as ras_id, file_name, ext as file_extension,
               att_type as att_type_from_db, supplier_id as supplier_id_from_db, is_quotation,
               canonical_item_name, quoted_price
        from docs""",
    "q36c_upserted_documents": """
        select json_file, case when ras_id % 3 = 0 then 'second' else 'first' end as raw_summary
        from docs where ras_id % 3 = 0 or supplier_id % 2 = 0""",
    "q36d_source_names": """
        select ras_id, dtl_id, att_id, file_name, file_location, att_type, supplier_id, uploaded_on
        from loc""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_tables(sql, name in NUMBERED) for name, sql in _SQL.items()}
