"""DuckDB SQL of the queries that SQL can express on the small tables. It compares all windows or shared
shingles with each other, which suits a check and not a large corpus."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WS = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

NEAR_DUPLICATES = f"""with recursive d as (select doc_id, regexp_extract_all({_LOWER}, {_WS}) as w from documents),
sh as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from (select *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from sh group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b using (s) where a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
e as (select x as a, y as b from l union all select y, x from l),
r(node, m) as (select doc_id, doc_id from n union select e.b, r.m from r join e on e.a = r.node where r.m < e.b),
c as (select node, min(m) as component_id from r group by 1)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id, coalesce(component_id, doc_id) = doc_id as kept from documents left join n using (doc_id) left join c on node = doc_id"""

REPEATED_WORDS = f"""with d as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), {_WS}) as w from documents),
win as (select rid, i, array_to_string(w[i:i + 34], ' ') as s from (select *, unnest(range(1, len(w) - 33)) as i from d)),
cov as (select distinct rid, unnest(range(i, i + 35)) as pos from win where s in (select s from win group by s having count(*) > 1)),
words as (select rid, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from d),
kept as (select rid, string_agg(word, ' ' order by pos) as t, count(*) as n from words anti join cov using (rid, pos) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256 from d left join kept using (rid)"""

CONTAMINATION = f"""with d as (select row_number() over () as rid, doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) as w from documents),
b as (select cast(item_id as varchar) as item_id, regexp_extract_all({_LOWER}, {_ALNUM}) as w from benchmark),
bw as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as s from (select *, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
dw as (select rid, i, n, array_to_string(w[i:i + n - 1], ' ') as s from (select d.*, k.n, unnest(range(1, len(w) - k.n + 2)) as i from d, (select distinct n from bw) k where len(w) >= k.n)),
h as (select rid, i, n, s from dw where (n, s) in (select (n, s) from bw)),
hits as (select rid, count(*) as n_hit from (select distinct rid, unnest(range(i, i + n)) as pos from h) group by 1),
items as (select rid, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct rid, item_id from h join bw using (n, s)) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated from d left join hits using (rid) left join items using (rid)"""

URL_VERDICTS = r"""with u as (select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
c as (select *, regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\.', '') || regexp_replace(regexp_replace(path, '/{2,}', '/', 'g'), '(/|\.html?)$', '') as page from h),
l as (select distinct page from c where list_has_any(regexp_split_to_array(host, '[.\-]'), ['ads', 'adult', 'bets', 'casino', 'pills', 'spam']) and page <> ''),
r(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f as (select c.page_id, c.url, r.h || r.p as rule, r.v as verdict, row_number() over (partition by c.page_id, c.url order by length(r.h || r.p) desc) as n from (select distinct page_id, url, host, path from c) c join r on (c.host = r.h or ends_with(c.host, '.' || r.h)) and starts_with(c.path, r.p))
select c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, case when c.page in (select page from l) then 'block' else 'allow' end) as verdict from c left join f on f.n = 1 and f.page_id is not distinct from c.page_id and f.url is not distinct from c.url"""

FILTER_AUDIT = r"""with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
m as (select doc_id, part, len(w) < 200 as a, 100 * len(list_distinct(w)) < 50 * len(w) as b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) as c, regexp_matches(t, '[#$%&*|]') as d, coalesce(min(doc_id) over (partition by t) < doc_id, false) as e from d),
g as (select part, (case when a then 1 else 0 end) + (case when b then 2 else 0 end) + (case when c then 4 else 0 end) + (case when d then 8 else 0 end) + (case when e then 16 else 0 end) as bits,
  coalesce(doc_id in (select doc_id from labels where quality = 1 and doc_id is not null), false) as good, coalesce(doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null), false) as toxic from m),
n as (select part, bits, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from g group by 1, 2),
l(f, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o as (select v.f || w.f || x.f || y.f || z.f as filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] as bits from l v, l w, l x, l y, l z where v.bit | w.bit | x.bit | y.bit | z.bit = 31),
s as (select filter_order, cast(step as int) as step, bits[step] as mine, list_sum(bits[1:step - 1]) as seen from (select *, unnest(range(1, 6)) as step from o)),
r as (select part, filter_order, step, mine, coalesce(seen, 0) as seen, n.* exclude (part) from n, s),
x as (select part, filter_order, step, mine, sum(case when bits & (seen | mine) = 0 then n else 0 end) as kept, sum(case when bits & mine <> 0 and bits & seen = 0 then n else 0 end) as removed, sum(case when bits & mine <> 0 and bits & seen <> 0 then n else 0 end) as redundant,
  sum(case when bits = mine then n else 0 end) as unique_fails, sum(case when bits & mine <> 0 and bits & seen = 0 then good else 0 end) as good_lost, sum(case when bits & mine <> 0 and bits & seen = 0 then toxic else 0 end) as toxic_lost from r group by all)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, mine) as bigint) as shapley from x"""


def _rounds(n: int) -> str:
    """CTEs of n rounds of assignment (a1, ...) and means (c1, ...) from the codebooks c0, and one more assignment."""
    steps = []
    for r in range(n + 1):
        steps.append(f"d{r} as materialized (select rid, p, e, list_sum([(x[i] - y[i]) * (x[i] - y[i]) for i in range(1, len(x) + 1)]) as d from (select x.rid, x.p, x.x, c.e, c.y from x join c{r} c using (p))),\na{r} as materialized (select rid, p, min(d) as d, arg_min(e, d * 16 + e) as e from d{r} group by all)")
        if r < n:
            steps.append(f"s{r} as (select p, e, i, sum(x[i]) as s, count(*) as n from (select a.p, a.e, x.x, unnest(range(1, len(x.x) + 1)) as i from a{r} a join x using (rid, p)) group by all),\nc{r + 1} as materialized (select c.p, c.e, coalesce(m.y, c.y) as y from c{r} c left join (select p, e, list(cast((s - (((s % n) + n) % n)) // n as bigint) order by i) as y from s{r} group by all) m using (p, e))")
    return ",\n".join(steps)


VECTOR_CODES = f"""with k as materialized (select row_number() over () as rid, vec_id, label, [cast(floor(cast(x as double) * 4096) as bigint) for x in embedding] as v from embeddings where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
x as materialized (select rid, p, v[p * len(v) // 8 + 1:(p + 1) * len(v) // 8] as x from (select *, unnest(range(8)) as p from k)),
c0 as materialized (select p, e, x as y from x join (select rid, row_number() over (order by vec_id) - 1 as e from (select rid, vec_id from k order by vec_id limit 16)) using (rid)),
{_rounds(6)},
t as (select rid, string_agg(printf('%02x', cast(e as int)), '' order by p) as code, cast(sum(d) as bigint) as error from a6 group by 1)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, (select sha256(string_agg(array_to_string(y, ','), ',' order by p, e)) from c6) as codebooks_sha256 from k join t using (rid)"""
