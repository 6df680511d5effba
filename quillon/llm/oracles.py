"""SQL for the queries that it can express; it takes whole tables and whole texts."""

from __future__ import annotations

from quillon.llm.decontam import NEAR_LEAST, NEAR_SLOP
from quillon.llm.license_scan import template_bigrams
from quillon.llm.line_dedup import RATIO_PCT

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = "coalesce(regexp_extract_all(" + _FOLD.format("text") + r", '[0-9a-z\x{80}-\x{10FFFF}]+'), [])"

DECONTAMINATE = f"""with d as (select doc_id, {_TERMS} ws from documents),
i as (select cast(item_id as varchar) item, {_TERMS} ws from benchmark),
iw as (select item, least(len(ws), 10) n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) k, ws from i where len(ws) > 0),
grams as (select distinct item, n, ws[k : k + n - 1] g from iw),
dw as (select doc_id, n, unnest(range(1, len(ws) - n + 2)) k, ws from d, (select distinct n from grams) where len(ws) >= n),
hits as (select doc_id, item, k, dw.n from dw join grams on grams.n = dw.n and grams.g = dw.ws[k : k + dw.n - 1]),
tx as (select ws, list_distinct(ws) ts, len(list_distinct(ws)) n, len(ws) + {NEAR_SLOP} span, list(distinct item) ids from i where len(list_distinct(ws)) >= {NEAR_LEAST} group by 1),
occ as (select doc_id, p, w, tx.ws, tx.n, tx.span from (select doc_id, unnest(range(1, len(ws) + 1)) p, unnest(ws) w from d) join (select ws, n, span, unnest(ts) t from tx) tx on t = w),
whole as (select doc_id, ws from occ group by 1, 2 having count(distinct w) = any_value(n)),
closer as (select occ.* from occ join whole using (doc_id, ws)),
nearby as (select distinct doc_id, ws from (select a.doc_id, a.ws, a.p from closer a join closer b on a.doc_id = b.doc_id and a.ws = b.ws and b.p between a.p - a.span + 1 and a.p group by 1, 2, 3 having count(distinct b.w) = any_value(a.n))),
nears as (select doc_id, count(*) n_near, string_agg(item, ',' order by item) near_items from (select distinct doc_id, unnest(ids) item from nearby join tx using (ws)) group by 1),
pos as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(k, k + n)) p from hits) group by 1),
its as (select doc_id, count(distinct item) n_items, string_agg(item, ',' order by item) items from (select distinct doc_id, item from hits) group by 1)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated, coalesce(n_near, 0) as n_near_items, coalesce(near_items, '') as near_items
from d left join pos using (doc_id) left join its using (doc_id) left join nears using (doc_id)"""

_FORMS = ", ".join(f"({k}, '{name}', [{', '.join(repr(b) for b in grams)}])" for k, (name, grams) in enumerate(template_bigrams()))
LICENSE_SCAN = f"""with t(k, name, b) as (values {_FORMS}),
w as (select doc_id, row_number() over () line, string_split(trim(regexp_replace({_FOLD.format("line")}, '[^a-z0-9]+', ' ', 'g')), ' ') w from (select doc_id, unnest(string_split(text, chr(10))) line from documents)),
a as (select doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) a from w),
s as (select doc_id, line, k, name, 2.0::double * len(list_intersect(a, b)) / (len(a) + len(b)) dice from a, t where len(a) > 0),
best as (select doc_id, line, max(struct_pack(dice := dice, k := -k)) m from s where dice * 100 >= 80 group by 1, 2),
doc as (select doc_id, count(*) n, max(m) m from best group by 1)
select documents.doc_id, (select name from t where t.k = -doc.m.k) as license_id, coalesce(round(doc.m.dice, 6), 0.0::double) as dice, coalesce(n, 0) as n_license_lines from documents left join doc using (doc_id)"""

LINE_DEDUP = rf"""with l as (select distinct doc_id, source, line from (select doc_id, source, unnest(string_split(text, chr(10))) line from documents) where regexp_matches(line, '[^\x20\x09-\x0D]')),
c as (select source, line, count(*) n from l group by 1, 2), t as (select source, count(*) pages from documents group by 1),
bad as (select source, list(line) gone from c join t using (source) where n >= 5 and n * 100 > pages * {RATIO_PCT} group by 1),
k as (select doc_id, source, string_split(text, chr(10)) lines, list_filter(string_split(text, chr(10)), lambda x: not list_contains(coalesce(gone, []), x)) kept from documents left join bad using (source))
select doc_id, source, len(lines) as n_lines, len(lines) - len(kept) as n_dropped, length(coalesce(array_to_string(kept, chr(10)), '')) as n_kept_chars, sha256(coalesce(array_to_string(kept, chr(10)), '')) as text_sha256 from k"""

SQL = {"op2_decontaminate": DECONTAMINATE, "op4_license_scan": LICENSE_SCAN, "op5_line_dedup": LINE_DEDUP}
