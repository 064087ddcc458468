"""SQL twins, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

TOPK = """with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) e from embeddings
  where vec_id is not null and embedding is not null and not coalesce(list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x))), false)),
p as (select q.vec_id query_id, v.vec_id, cast(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])) as bigint) score from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) rn from p)
select query_id, cast(rn as int) rank, vec_id, score from r where rn <= 5"""

NEAR = """with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\x09-\\x0D]+'), lambda x: x <> '') w from documents),
sets as (select doc_id, case when len(w) = 0 then [] else list_distinct(list_transform(range(1, greatest(len(w) - 2, 2)), lambda i: array_to_string(w[i:i+3], ' '))) end s from w),
sizes as (select doc_id, cast(len(s) as bigint) n from sets),
items as (select doc_id, unnest(s) x from sets),
common as (select a.doc_id a, b.doc_id b, count(*) c from items a join items b on a.x = b.x and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (select c.a, c.b from common c join sizes p on p.doc_id = c.a join sizes q on q.doc_id = c.b where 100 * c.c >= 80 * (p.n + q.n - c.c)),
two as (select a, b from links union all select b, a from links),
reach as (select doc_id id, doc_id c from documents union select r.id, t.b from reach r join two t on t.a = r.c),
least as (select id, min(c) component_id from reach group by id)
select s.doc_id, s.n n_shingles, l.component_id, s.doc_id = l.component_id kept from sizes s join least l on l.id = s.doc_id"""

LINES = """with d as (select doc_id, text, string_split(text, chr(10)) ls from documents),
o as (select doc_id, unnest(range(0, len(ls))) pos, unnest(ls) line from d),
u as (select line, min({'d': doc_id, 'p': pos}) f from o where length(line) >= 30 group by line),
h as (select line, f, length(line) n, m from (select *, unnest([length(line) - 1, length(line)]) m from u)),
k as (select line, f, n, m, 0 side, left(line, m // 2) part from h union all select line, f, n, m, 1, right(line, m - m // 2) from h),
pairs as (select distinct a.line x, b.line y from k a join k b on a.m = b.m and a.side = b.side and a.part = b.part and a.f < b.f and abs(a.n - b.n) <= 1),
c as (select x, y, case when length(x) <= length(y) then x else y end s, case when length(x) <= length(y) then y else x end t from pairs),
late as (select distinct y line from c where list_bool_or(list_transform(range(0, length(s) + 1), lambda i: left(s, i) = left(t, i)
  and right(s, greatest(length(s) - i - case when length(s) = length(t) then 1 else 0 end, 0)) = right(t, greatest(length(t) - i - 1, 0)) and i < length(t)))),
marked as (select o.doc_id, o.pos, o.line, length(o.line) >= 30 and (o.line in (select line from late) or {'d': o.doc_id, 'p': o.pos} <> u.f) gone from o left join u on u.line = o.line)
select doc_id, count(*) n_lines, count(case when gone then 1 end) n_removed, coalesce(string_agg(line, chr(10) order by pos) filter (not coalesce(gone, false)), '') as text from marked group by doc_id"""


def _spans(kind: str, pattern: str, hint: str, confirmed: str) -> str:
    """A list of structs (s, e, x) of the confirmed matches of a pattern; x is the match."""
    return f"""list_filter(list_transform(range(1, case when regexp_matches(t, '{hint}') then len(m_{kind}) else 0 end + 1), lambda i: struct_pack(
      s := cast(list_sum(list_transform(g_{kind}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m_{kind}[1:i-1], lambda x: length(x))), 0) as bigint),
      e := cast(list_sum(list_transform(g_{kind}[1:i], lambda x: length(x))) + list_sum(list_transform(m_{kind}[1:i], lambda x: length(x))) as bigint),
      x := m_{kind}[i])), lambda z: {confirmed}) {kind}"""


_DIGITS = "regexp_replace(z.x, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda j: case when j % 2 = 1 then cast(substring(reverse({_DIGITS}), j, 1) as int)
  else cast(substring(reverse({_DIGITS}), j, 1) as int) * 2 - case when cast(substring(reverse({_DIGITS}), j, 1) as int) > 4 then 9 else 0 end end)) % 10 = 0"""
_TURNED = "substring(replace(z.x, ' ', ''), 5) || substring(replace(z.x, ' ', ''), 1, 4)"
_MOD97 = f"""list_reduce(list_transform(string_split({_TURNED}, ''), lambda c: case when c between 'A' and 'Z' then ascii(c) - 55 else ascii(c) - 48 end), lambda a, b: (a * case when b > 9 then 100 else 10 end + b) % 97, 0) = 1"""
_SMALL = "len(list_filter(string_split(z.x, '.'), lambda p: not regexp_matches(p, '^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$'))) = 0"
_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "@", "true", 0.8, "mail|contact|write", "example|test", 0.0),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", r"[0-9]\.[0-9]", _SMALL, 0.6, r"\bip\b|host|address|server", "version|release|section", 0.0),
    ("card", "[0-9](?:[ -]?[0-9])+", "[0-9]", f"length({_DIGITS}) between 16 and 19 and {_LUHN}", 0.8, "card|visa|credit|payment", "isbn|order|serial", 0.0),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", f"length({_DIGITS}) between 8 and 15", 0.7, "phone|call|tel|mobile|fax", "score|diff", 0.0),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", "[A-Z]{2}[0-9]{2}", _MOD97, 0.8, "iban|account|bank", "order|serial", 0.5),
    ("nid", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "[0-9]-[0-9]{2}-[0-9]", "true", 0.3, "ssn|social|security|insurance|national", "part|model|serial", 0.5),
)


def _rated(kind, pattern, hint, confirmed, score, helps, hurts, least) -> str:
    near = "lower(substring(t, greatest(z.s - 48, 0) + 1, z.s - greatest(z.s - 48, 0)) || ' ' || substring(t, z.e + 1, 24))"
    value = f"round(least({score} + case when regexp_matches({near}, '{helps}') then 0.3 else 0.0 end - case when regexp_matches({near}, '{hurts}') then 0.2 else 0.0 end, 1.0), 2)"
    return f"list_filter(list_transform({kind}, lambda z: struct_pack(v := '{kind}:' || z.s || ':' || z.e, c := cast({value} as double))), lambda z: z.c >= {least}) {kind}"


_ALL = [k[0] for k in _KINDS]


def _joined(kinds: list[str], part: str) -> str:
    return "array_to_string(" + " || ".join(f"list_transform({k}, lambda z: {part})" for k in kinds) + ", ',')"


PII = f"""with d as (select doc_id, coalesce(text, '') t from documents),
m as (select doc_id, t, {", ".join(f"regexp_extract_all(t, '{p}') m_{k}, string_split_regex(t, '{p}') g_{k}" for k, p, *_ in _KINDS)} from d),
s as (select doc_id, t, {", ".join(_spans(*k[:4]) for k in _KINDS)} from m),
r as (select doc_id, {", ".join(_rated(*k) for k in _KINDS)} from s)
select doc_id, {", ".join(f"cast(len({k}) as bigint) n_{k}" for k in _ALL)}, sha256({_joined(_ALL[:4], "z.v")}) base_sha256, {_joined(_ALL, "z.v")} spans, {_joined(_ALL, "cast(z.c as varchar)")} scores from r"""

# Unsigned crc32 of a list of bytes, as a macro of the table for one byte.
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end))"
_CRC = "xor(list_reduce([4294967295::bigint] || {bytes}, lambda c, b: xor(c // 256, tab[cast(xor(c % 256, b) as int) + 1])), 4294967295)"

TRIE = f"""with tables as materialized (select {_CRC_TABLE} tab),
turns as (select conv_id c, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} order by turn nulls first) t from conversations where conv_id is not null group by conv_id),
h as (select c, t, c - c % 100 b, {_CRC.format(bytes="list_transform(string_split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint))")} % 6 h from turns cross join tables),
s as (select h.c, coalesce(b.t, [])[1:h.h] || h.t[h.h + 1:] s from h left join turns b on b.c = h.b),
p as (select c, d, md5(cast(s[1:d] as varchar)) id, case when d > 0 then md5(cast(s[1:d - 1] as varchar)) end up, case when d > 0 then length(s[d].x) else 0 end n, d = len(s) fin from (select *, unnest(range(0, len(s) + 1)) d from s)),
nodes as (select id, any_value(up) up, any_value(d) depth, min(c) conv_id, count(*) n_convs, any_value(n) n,
  sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (fin), '')) ends_sha256 from p group by id),
kids as (select up id, count(*) k from nodes where up is not null group by up),
f as (select n.*, coalesce(k.k, 0) n_children from nodes n left join kids k on k.id = n.id),
above as (select a.id above, b.id from (select distinct id, c from p qualify row_number() over (partition by id order by c) = 1) b join p a on a.c = b.c join nodes m on m.id = a.id join nodes o on o.id = b.id where m.depth <= o.depth),
sums as (select above id, count(case when f.n_children = 0 then 1 end) n_leaves, cast(sum((f.n_convs - 1) * f.n) as bigint) saved_tokens from above join f on f.id = above.id group by above)
select f.conv_id, f.depth, u.conv_id parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256 from f join sums s on s.id = f.id left join nodes u on u.id = f.up"""

_UTF8 = "flatten(list_transform(string_split(r, ''), lambda x: case when unicode(x) < 128 then [cast(unicode(x) as bigint)] else [192 + unicode(x) // 64, 128 + unicode(x) % 64] end))"

SPELLING = f"""with recursive tables as materialized (select {_CRC_TABLE} tab),
runs as (select coalesce(cast(doc_id as varchar), '') d, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') r from documents),
k as (select r, {_CRC.format(bytes=f"list_transform(string_split(d || ':', ''), lambda x: cast(ascii(x) as bigint)) || {_UTF8}")} h from runs cross join tables where length(r) >= 7),
e as (select case when h % 31 = 0 then left(r, cast(h % length(r) as int)) || substring(r, cast(h % length(r) as int) + 2) else r end word from k),
v as materialized (select word, count(*) n from e where length(word) >= 7 group by word having count(*) >= 2),
d as materialized (select word, i, left(word, i) || substring(word, i + 2) rest from (select word, unnest(range(0, length(word))) i from v)),
pairs as materialized (select distinct d.word a, v.word b from d join v on v.word = d.rest union select distinct v.word, d.word from d join v on v.word = d.rest union select x.word, y.word from d x join d y on x.rest = y.rest and x.i = y.i and x.word <> y.word),
best as (select p.a, count(*) n_near, min({{'m': -w.n, 'o': p.b}}) b from pairs p join v w on w.word = p.b group by p.a),
f as materialized (select v.word, v.n, coalesce(b.n_near, 0) n_near, case when -b.b.m >= 10 * v.n then b.b.o end form, case when -b.b.m >= 10 * v.n then -b.b.m end form_n from v left join best b on b.a = v.word),
walk as (select word, word spot from f union all select w.word, f.form from walk w join f on f.word = w.spot where f.form is not null)
select f.word, f.form, w.spot root, f.n, f.n_near, f.form_n from f join walk w on w.word = f.word join f t on t.word = w.spot and t.form is null"""

ORACLES: dict[str, str] = {"op13_spelling": SPELLING, "op11_prefix_trie": TRIE, "op4_topk": TOPK, "op6_near_duplicates": NEAR, "op7_line_dedup": LINES, "op9_pii": PII}
