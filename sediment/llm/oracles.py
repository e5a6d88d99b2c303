"""DuckDB SQL for the corpus queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# Rules: measures per document, failure counts per host, beta prior by beta-binomial moments, verdicts joined back.
OP1 = rf"""
with d as (select row_number() over () as r, * from documents),
w as (select r, {WORDS} as words, coalesce(text, '') as t from d),
g as (select r, unnest(range(1, len(words) - 1)) as i, words from w where len(words) >= 3),
tri as (select r, i, words[i] || chr(1) || words[i + 1] || chr(1) || words[i + 2] as g from g),
rep as (select r, i from (select r, i, count(*) over (partition by r, g) as n from tri) where n > 1),
cov as (select r, count(distinct p) as n_repeat_words from (select r, unnest([i, i + 1, i + 2]) as p from rep) group by r),
l as (select r, unnest(string_split(t, chr(10))) as line from w),
ln as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
       from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (select d.r, d.doc_id, d.source, len(words)::bigint as n_words,
             length(array_to_string(words, ''))::bigint as word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
             coalesce(n_lines, 0) as n_lines, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
             coalesce(n_repeat_words, 0)::bigint as n_repeat_words
      from d join w using (r) left join cov using (r) left join ln using (r)),
f as (select *, n_words < 50 as f1, 100 * n_repeat_words > 50 * n_words as f2,
             100 * n_symbols > 10 * word_chars as f3, 100 * n_dup_lines > 30 * n_lines as f4 from m),
h as (select source, count(*) as n, unnest([1, 2, 3, 4]) as rule,
             unnest([count(*) filter (f1), count(*) filter (f2), count(*) filter (f3), count(*) filter (f4)]) as f
      from f where source is not null group by source),
a as (select rule, count(*) - 1 as within, sum(n) as docs, sum(n::double * n) as squares, sum(f) / sum(n) as mean, sum(f * f / n) as q
      from h group by rule),
b as (select rule, mean, case when mean * (1 - mean) > 0 and docs - squares / docs - within > 0
        then ((q - docs * mean * mean) / (mean * (1 - mean)) - within) / (docs - squares / docs - within) else 0 end as between_hosts from a),
p as (select rule, mean, case when between_hosts > 1e-9 then greatest(1 / between_hosts - 1, 2) end as strength,
             greatest(0.5, 20 * mean / (1 - mean + 20 * mean)) as most from b),
s as (select h.source, bool_or(case when strength is null then mean else (f + mean * strength) / (n + strength) end > most) as bad
      from h join p using (rule) group by h.source)
select doc_id, f.source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 or f2 as base_failed,
       not (f1 or f2) and not coalesce(bad, false) as kept
from f left join s on s.source = f.source"""

# Full shingle sets, all pairs that share a shingle, and the least identifier reachable.
OP2 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as words from documents),
s as (select distinct doc_id, unnest(case when len(words) = 1 then words
          else list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) end) as g from w where len(words) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
e as (select a, b from shared join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 80 * (na.n + nb.n - k)),
reach as (select doc_id as a, doc_id as b from documents union select reach.a, e.b from reach join e on e.a = reach.b)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.low as component_id, d.doc_id = c.low as kept
from documents d left join n using (doc_id) join (select a, min(b) as low from reach group by a) c on c.a = d.doc_id"""

OP4 = """
with p as (select page_id, coalesce(html, '') as payload from pages),
q as (select page_id, strlen(payload)::bigint as payload_bytes, sha256(payload) as payload_digest from p),
o as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first_id from q)
select page_id, case when first_id <> page_id then 'revisit' else 'response' end as record_type, payload_bytes, payload_digest,
       case when first_id <> page_id then first_id end as refers_to, true as intact from o"""

# Inverted Poisson draws from hashes, copies, and the key of the shuffle.
OP5 = """
with t as (select source, sum(coalesce(n_chars, 0))::double as total from documents group by source),
r as (select source, case when total > 0 then pow(total, 0.7) / (select sum(pow(total, 0.7)) from t)
                          * (select sum(total) from t) / total else 1 end as rate from t),
d as (select source, greatest(ceil(rate / 32), 1)::int as draws, rate / greatest(ceil(rate / 32), 1) as mean from r),
c as (select source, draws, list_transform(range(0, 129),
        lambda k: list_sum(list_transform(range(0, k + 1), lambda j: exp(j * ln(mean) - mean - lgamma(j + 1))))) as sums from d),
u as (select x.*, sums, unnest(range(1, draws + 1)) as j from documents x join c using (source)),
n as (select doc_id, sum(len(list_filter(sums, lambda s: s <=
        ('0x' || substr(md5('2026:count:' || doc_id || ':' || j), 1, 13))::bigint / 4503599627370496.0)))::bigint as copies
      from u group by doc_id)
select doc_id, text, lang, source, n_chars, copy::int as copy,
       ('0x' || substr(md5('2026:order:' || doc_id || ':' || copy), 1, 13))::bigint / 4503599627370496.0 as shuffle_key
from (select x.*, unnest(range(1, copies + 1)) as copy from documents x join n using (doc_id))"""

OP8 = """
with recursive v as (select vec_id, embedding::double[] as x from embeddings),
ok as (select vec_id, x, sqrt(list_dot_product(x, x)) as size from v where x is not null and list_dot_product(x, x) > 0),
e as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.vec_id <> b.vec_id
      where list_dot_product(a.x, b.x) / (a.size * b.size) >= 0.9),
reach as (select vec_id as a, vec_id as b from embeddings union select reach.a, e.b from reach join e on e.a = reach.b)
select r.a as vec_id, (select count(*) from e where e.a = r.a)::bigint as n_links, min(r.b) as component_id, r.a = min(r.b) as kept
from reach r group by r.a"""

# Listed rules, and rules of any tokens counted over all combinations of the labelled pages.
OP10 = r"""
with p as (select page_id, url, translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                  regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path,
                  regexp_extract(url, '^[^?#]*\?([^#]*)', 1) as asked from pages),
t as (select *, list_sort(list_distinct(
          (case when contains(url, '://') then ['scheme=' || string_split(url, '://')[1]] else [] end)
          || list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'host=' || x)
          || list_transform(list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda x: x <> ''), lambda x: 'path=' || x)
          || list_transform(list_filter(list_transform(string_split(asked, '&'), lambda x: string_split(x, '=')[1]), lambda x: x <> ''), lambda x: 'query=' || x)
        )) as tokens from p),
b as (select row_number() over () as r, tokens, coalesce(quality = 0 or toxic = 1, false) as bad
      from t join labels l on l.doc_id = t.page_id where url is not null),
i as (select r, bad, unnest(tokens) as a from b),
o as (select a from i group by a having count(*) filter (bad) >= 10),
k as (select r, any_value(bad) as bad, list(a order by a) as tokens from i join o using (a) group by r),
x as (select bad, list_filter(tokens, lambda y, j: (m >> (j - 1)) & 1 = 1) as k
      from (select bad, tokens, unnest(range(1, (1::bigint << len(tokens)))) as m from k)),
y as (select k, count(*) as n, count(*) filter (bad) as h from x group by k),
rules as (select k from y where h >= 10 and h > 0.5 * n and (h + 1.96 * 1.96 / 2 - 1.96 * sqrt(h * (n - h) / n + 1.96 * 1.96 / 4)) / (n + 1.96 * 1.96)
          >= 1.25 * (select count(*) filter (bad) / count(*) from b)),
hit as (select distinct url from t join rules on list_has_all(tokens, k)),
f as (select t.*, hit.url is not null as mined, suffix(host, '.example.org') or host = 'example.org' as own,
             suffix(host, '.org') or host = 'org' as org, suffix(host, '.com') or host = 'com' as com from t left join hit on hit.url = t.url),
g as (select *, case when own and starts_with(path, '/en/1') then 'example.org/en/1' when own and starts_with(path, '/es/') then 'example.org/es/'
                     when com and starts_with(path, '/fr/') then 'com/fr/' when com and starts_with(path, '/de/') then 'com/de/'
                     when org and starts_with(path, '/') then 'org/' end as rule from f)
select page_id, coalesce(host, '') as host, coalesce(path, '') as path, rule,
       case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block' when rule is not null then 'allow'
            when mined then 'block' else 'allow' end as verdict from g"""

# Remainders of the checksum's polynomial for half a byte, as it is defined.
CRC32 = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
    "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an SQL text, half a byte at a time."""
    digits = (
        f"list_transform(range(1, strlen({text}) * 2 + 1), "
        f"lambda i: instr('0123456789ABCDEF', substr(hex({text}), (i + 2 * (i % 2) - 1)::int, 1)) - 1)"
    )
    step = f"lambda a, b: xor(a >> 4, ({CRC32})[(xor(a, b) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {digits}::bigint[]), {step}), 4294967295)"


# Counted words, neighbours by deleted characters, forms and the ends of their chains.
OP12 = rf"""
with recursive r as (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
g as (select doc_id, run, count(*) as k, coalesce(doc_id::varchar, '') || ':' || run as named from r where length(run) >= 5 group by all),
h as (select run, k, {crc32("named")} as h from g),
w as (select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word,
             sum(k)::bigint as n from h group by 1),
v as (select word, n from w where length(word) >= 5 and n >= 3),
x as (select word, n, i, substr(word, 1, i::int - 1) || substr(word, i::int + 1) as rest
      from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
e as (select a.word, b.word as near, b.n from x a join x b on a.i = b.i and a.rest = b.rest and a.word <> b.word
      union select x.word, v.word, v.n from x join v on x.rest = v.word
      union select v.word, x.word, x.n from x join v on x.rest = v.word),
o as (select word, count(*) as n_near, max(n) as top from e group by word),
b as (select e.word, any_value(n_near) as n_near, any_value(top) as top, min(near) as near from e join o on o.word = e.word and o.top = e.n group by e.word),
f as (select v.word, case when top >= 2 * n then near end as form, n, coalesce(n_near, 0)::bigint as n_near,
             case when top >= 2 * n then top end as form_n from v left join b using (word)),
c as (select word, word as last, 0 as k from f union all select c.word, f.form, k + 1 from c join f on f.word = c.last where f.form is not null),
z as (select word, arg_max(last, k) as root from c group by word)
select word, form, root, n, n_near, form_n from f join z using (word)"""

# Rebuilt conversations, one row for each of their prefixes, and nodes as groups of equal prefixes.
TURN = "md5(length(role)::varchar || ':' || role || text)"
OP11 = rf"""
with t as (select conv_id::bigint as c, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
o as (select c, strlen(text) as size, {TURN} as g,
             row_number() over (partition by c order by turn nulls first, {TURN}) as i from t),
k as (select distinct c, c - c % 5 as base, {crc32("c::varchar")} % 9 as h from t),
r as (select k.c, o.i, g, size from k join o on o.c = k.base where o.i <= h
      union all select k.c, h + o.i, g, size from k join o on o.c = k.c where o.i > h),
s as (select c, row_number() over (partition by c order by i) as d, g, size from r),
p as (select c, d, size, md5(string_agg(g, '') over (partition by c order by d)) as node from s
      union all select c, 0, 0, 'root' from k),
l as (select c, d, node, lag(node) over (partition by c order by d) as up, lead(node) over (partition by c order by d) is null as last, size from p),
n as (select node, d, any_value(up) as up, min(c) as conv_id, count(*) as n_convs, any_value(size) as size,
             sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (last), '')) as ends_sha256 from l group by node, d),
ch as (select up as node, count(*) as n_children from n where up is not null group by up),
m as (select n.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * size as own from n left join ch using (node)),
a as (select distinct x.node as above, y.node as below from p x join p y on x.c = y.c and x.d <= y.d),
u as (select above, count(*) filter (n_children = 0) as n_leaves, sum(own) as saved from a join m on m.node = a.below group by above)
select m.conv_id, m.d::bigint as depth, q.conv_id as parent_conv_id, m.n_convs, m.n_children::bigint as n_children,
       n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, m.ends_sha256
from m left join m q on q.node = m.up join u on u.above = m.node"""
