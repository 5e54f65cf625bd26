"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .url_filter import SEEDS, SYMBOLS

OP3 = r"""
with w as (select doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
s as (select distinct doc_id, sh from (
    select doc_id, unnest(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) sh from w where len(w) >= 4
    union all select doc_id, array_to_string(w, ' ') from w where len(w) between 1 and 3)),
n as (select doc_id, count(*) n from s group by 1),
k as (select sh from s group by 1 having count(*) > 1),
live as (select doc_id, any_value(n.n) n from s join k using (sh) join n using (doc_id) group by 1 having 100 * count(*) >= 85 * any_value(n.n)),
p as (select a.doc_id x, b.doc_id y, count(*) o from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id
      where a.doc_id in (select doc_id from live) and b.doc_id in (select doc_id from live) group by 1, 2),
links as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * o >= 85 * (nx.n + ny.n - o)),
e as (select x, y from links union all select y, x from links),
r as (select distinct x doc_id, x root from e),
walk as (with recursive reach(doc_id, root) as (select doc_id, root from r union select e.y, reach.root from reach join e on e.x = reach.doc_id) select doc_id, min(root) root from reach group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(walk.root, d.doc_id))::bigint as component_id
from documents d left join n using (doc_id) left join walk on walk.doc_id = d.doc_id
"""

OP4 = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
win as (select doc_id, unnest(range(1, len(w) - 18)) p, unnest(list_transform(range(1, len(w) - 18), lambda i: md5(array_to_string(w[i:i + 19], ' ')))) h from w where len(w) >= 20),
later as (select doc_id, p from win qualify row_number() over (partition by h order by doc_id, p) > 1),
gone as (select distinct doc_id, unnest(range(p, p + 20)) p from later),
words as (select doc_id, unnest(range(1, len(w) + 1)) p, unnest(w) t from w where len(w) > 0),
kept as (select words.doc_id, string_agg(t, ' ' order by p) txt, count(*) n from words anti join gone using (doc_id, p) group by 1)
select w.doc_id, len(w.w)::bigint as n_words, (len(w.w) - coalesce(kept.n, 0))::bigint as n_removed, sha256(coalesce(kept.txt, '')) as kept_sha256 from w left join kept using (doc_id)
"""

OP5 = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) v from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]))::bigint score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20
"""


def op8(rules) -> str:
    """The URL filter with ``rules`` of (verdict, host/path)."""
    fits = []
    for verb, text in sorted(rules, key=lambda r: -len(r[1])):
        h, p = text.split("/", 1)
        fits.append((f"((host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '/{p}'))", text, verb))
    rule = "case " + " ".join(f"when {f} then '{t}'" for f, t, _ in fits) + " end"
    verdict = "case " + " ".join(f"when {f} then '{v}'" for f, _, v in fits) + " end"
    seeds = ", ".join(f"'{x}'" for x in SEEDS)
    return rf"""
with h as (select page_id, url, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
  regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) path from pages),
a as (select *, [31, 31] || list_transform(string_split(translate(translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '123456789', '000000000'), ''),
  lambda ch: case when instr('{SYMBOLS}', ch) = 0 then 30 else instr('{SYMBOLS}', ch) - 1 end) codes from h where host || path <> ''),
t as (select *, list_transform(range(1, len(codes) - 1), lambda i: (codes[i] * 32 + codes[i + 1]) * 32 + codes[i + 2]) cells,
  list_has_any(regexp_split_to_array(host, '[.-]'), [{seeds}]) rejected, substr(md5(url), 1, 1) in ('0', '1', '2') kept_out from a),
n as (select rejected::int * 32768 + c id, count(*) n from (select rejected, unnest(cells) c from t where not kept_out) group by 1),
g as (select r.id, coalesce(n.n, 0)::double n, r.id // 32768 y, (r.id % 32768) // 32 ba, (r.id // 32) % 32 a, r.id % 32 c from (select unnest(range(65536)) id) r left join n on n.id = r.id),
g1 as (select *, sum(n) over (partition by y, a, c) nac, sum(n) over (partition by y, ba) nba, sum((n > 0)::int) over (partition by y, ba) tba from g),
g2 as (select *, sum(case when ba < 32 then nac else 0 end) over (partition by y, a) na, sum((ba < 32 and nac > 0)::int) over (partition by y, a) ta,
  sum(case when ba < 32 then nac else 0 end) over (partition by y, c) nc, sum(n) over (partition by y) n0 from g1),
g3 as (select *, (nc + 1.0) / (n0 + 32) p0 from g2),
g4 as (select *, case when na > 0 then (nac + ta * p0) / (na + ta) else p0 end p1 from g3),
g5 as (select *, case when nba > 0 then (n + tba * p1) / (nba + tba) else p1 end p2 from g4),
m as (select id % 32768 k, case when min(n0) > 0 then sum(ln(p2) * case y when 0 then 1 else -1 end) else 0 end v from g5 group by 1),
s as (select page_id, any_value(rejected) rejected, any_value(kept_out) kept_out, avg(v) score from (select page_id, rejected, kept_out, unnest(cells) k from t) join m using (k) group by 1),
b as (select floor(score * 1000) b, sum(rejected::int)::double r, sum((not rejected)::int)::double a from s where kept_out group by 1),
j as (select b, (b + coalesce(lag(b) over (order by b) + 1, b)) / 2000.0 cut,
  coalesce(sum(r) over (order by b rows between unbounded preceding and 1 preceding), 0) / nullif(sum(r) over (), 0)
  + 1 - coalesce(sum(a) over (order by b rows between unbounded preceding and 1 preceding), 0) / nullif(sum(a) over (), 0) j from b),
cut as (select arg_max(cut, j * 1e6 - b * 1e-6) cut from j where j is not null)
select page_id, host, path, {rule} as rule, coalesce({verdict}, case when s.score < (select cut from cut) then 'block' else 'allow' end) as verdict
from h left join s using (page_id)
"""
