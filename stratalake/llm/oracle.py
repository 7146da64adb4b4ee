"""SQL in another engine for the queries that SQL can express."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_RULES = """(values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')) r(rule_host, rule_path, kind)"""

URL_FILTER = f"""
with rest as (
  select page_id, url,
    case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest
  from pages),
split as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path
  from rest),
parted as (select page_id, {_LOWER.format('raw')} as host, path, row_number() over () as n from split),
fitting as (
  select n, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    max_by(kind, length(rule_host || rule_path)) as kind
  from parted join {_RULES}
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by n)
select page_id, host, path, rule, coalesce(kind, 'allow') as verdict from parted left join fitting using (n)
"""

LINE_DEDUP = r"""
with texts as (select row_number() over () as n, doc_id, text, string_split(text, chr(10)) as lines from documents),
starts as (
  select n, doc_id, lines, unnest(range(0, len(lines) - 2)) as pos from texts where len(lines) >= 3),
windows as (
  select n, doc_id, pos, [lines[pos + 1], lines[pos + 2], lines[pos + 3]] as w from starts),
worded as (select * from windows where regexp_matches(array_to_string(w, ''), '[^\x20\x09-\x0D]')),
later as (
  select n, pos from (select n, pos, row_number() over (partition by w order by doc_id, pos) as k from worded) where k > 1),
gone as (select distinct n, pos + k as pos from later, (values (0), (1), (2)) s(k)),
cells as (select n, unnest(lines) as line, unnest(range(0, len(lines))) as pos from texts),
left_over as (
  select n, string_agg(line, chr(10) order by pos) as text, count(*) as kept
  from cells anti join gone using (n, pos) group by n)
select t.doc_id, coalesce(len(lines), 0)::bigint as n_lines,
  (coalesce(len(lines), 0) - coalesce(kept, 0))::bigint as n_removed,
  case when t.text is null then null else coalesce(l.text, '') end as text
from texts t left join left_over l using (n)
"""

_TIME = """case weight
  when 3 then case
    when part >= 0.625e0 then 0.5e0 + (part - 0.625e0) * 2e0
      / (1e0 + sqrt(greatest(1e0 + (part - 0.625e0) * -2e0, 0e0)))
    when part >= 0e0 then 0e0 + (part - 0e0) * 2e0 / (1.5e0 + sqrt(greatest(2.25e0 + (part - 0e0) * -2e0, 0e0))) end
  when 1 then 0e0 + (part - 0e0) * 2e0 / (1e0 + sqrt(greatest(1e0 + (part - 0e0) * 0e0, 0e0)))
  when 2 then {ramp} end"""


def _ramp() -> str:
    """Piece-wise inverse of the rising schedule, from the same knots as the operator."""
    from stratalake.llm.mixing import SCHEDULES, segments

    out = []
    for start, length, rate, change, done in reversed(segments(SCHEDULES[2])):
        out.append(
            f"when part >= {done!r}::double then {start!r}::double + (part - {done!r}::double) * 2e0 / ({rate!r}::double"
            f" + sqrt(greatest({rate * rate!r}::double + (part - {done!r}::double) * {2 * change / length!r}::double, 0e0)))"
        )
    return "case " + " ".join(out) + " end"


def _mixing() -> str:
    time = _TIME.format(ramp=_ramp())
    return rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    case when source is null then '1' else '0' || source end as key,
    md5(coalesce(doc_id::varchar, '')) as digest
  from documents),
sources as (select key, sum(size)::bigint as source_size from sized group by key),
weighed as (
  select key, source_size, [3, 1, 2][(row_number() over (order by key) - 1) % 3 + 1] as weight,
    2 * source_size as cap, 1.5e0 * (sum(source_size) over ())::double as wanted
  from sources),
sorted as (select *, cap::double / weight as ratio from weighed),
levels as (
  select *, (wanted - coalesce(sum(cap) over (order by ratio, key rows between unbounded preceding and 1 preceding), 0)::double)
    / (sum(weight) over (order by ratio, key rows between current row and unbounded following))::double as level
  from sorted),
one as (select first(level order by ratio, key) as level from levels where level <= ratio),
goals as (
  select key, source_size, weight, least(cap::double, coalesce(one.level * weight, cap::double)) as target
  from levels left join one on true),
whole as (select sum(target) as whole from goals),
begun as (
  select *, coalesce(sum(size) over (partition by key order by digest, size, doc_id nulls last
    rows between unbounded preceding and 1 preceding), 0)::bigint as begin
  from sized),
taken as (
  select b.*, source_size, weight, target, whole,
    greatest(least(size, floor(target)::bigint - begin), 0) as take0,
    greatest(least(size, floor(target)::bigint - source_size - begin), 0) as take1
  from begun b join goals using (key), whole),
timed as (
  select *, (select {time} from (select begin::double / target as part)) as time0,
    (select {time} from (select (begin + source_size)::double / target as part)) as time1
  from (select * from taken where target > 0)
  union all select *, null, null from taken where target <= 0)
select doc_id, source, size, source_size, weight::bigint as weight, target, (take0 + take1)::bigint as taken,
  case when take0 > 0 then floor(least(time0, 1e0) * whole)::bigint end as first_position,
  case when take1 > 0 then floor(least(time1, 1e0) * whole)::bigint end as second_position
from timed
"""


_SHINGLES = r"""
tokens as (
  select doc_id, regexp_extract_all(LOWERED, '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, case when coalesce(len(w), 0) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) end as s
  from tokens)""".replace("LOWERED", _LOWER.format("text"))

MINHASH = f"""
with recursive {_SHINGLES},
classes as (select min(doc_id) as c, list_sort(s) as s, len(s) as n from sets where len(s) > 0 group by list_sort(s), len(s)),
cells as (select c, n, unnest(s) as g from classes),
-- two alike sets share one of the rarest shingles of each: the first 15 in a hundred and one, by frequency
ranked as (
  select c, n, cells.g, row_number() over (partition by c order by k, cells.g) as r
  from cells join (select g, count(*) as k from cells group by g) using (g)),
rare as (select c, n, g from ranked where r <= n - (85 * n + 99) // 100 + 1),
pairs as (
  select distinct a.c as x, b.c as y from rare a join rare b
    on a.g = b.g and a.c < b.c and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
links as (
  select x, y from (
    select x, y, a.n as nx, b.n as ny, len(list_intersect(a.s, b.s)) as common
    from pairs join classes a on a.c = x join classes b on b.c = y)
  where 100 * common >= 85 * (nx + ny - common)),
reach(c, to_c) as (
  select c, c from classes
  union select r.c, l.y from reach r join (select x, y from links union all select y, x from links) l on r.to_c = l.x),
named as (select c, min(to_c) as component from reach group by c)
select doc_id, len(sets.s)::bigint as n_shingles, coalesce(component, doc_id)::bigint as component_id,
  doc_id = coalesce(component, doc_id) as kept
from sets left join classes on list_sort(sets.s) = classes.s left join named using (c)
"""

DECONTAMINATION = r"""
with d as (
  select doc_id, coalesce(regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w from documents),
b as (
  select item_id, regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select item_id, w[i:i + 9] as g from (select item_id, w, unnest(range(1, len(w) - 8)) as i from b where len(w) >= 10)
  union select item_id, w from b where len(w) between 1 and 9),
sizes as (select distinct len(g) as m from windows),
spots as (
  select doc_id, m, i, w[i:i + m - 1] as g
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, sizes where len(w) >= m)),
found as (select distinct doc_id, m, i, item_id from spots join windows using (g)),
hits as (
  select doc_id, count(distinct h) as n_hit
  from (select doc_id, unnest(range(i, i + m)) as h from (select distinct doc_id, m, i from found)) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (doc_id) left join items using (doc_id)
""".replace("LOWERED", _LOWER.format("text"))

QUALITY_RULES = r"""
with t as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, string_split(coalesce(text, ''), chr(10)) as l
  from documents),
trigrams as (
  select doc_id, i, [w[i], w[i + 1], w[i + 2]] as g
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from t where len(w) >= 3)),
repeats as (
  select doc_id, unnest([i, i + 1, i + 2]) as i
  from (select doc_id, i, count(*) over (partition by doc_id, g) as k from trigrams) where k > 1),
repeated as (select doc_id, count(distinct i) as n from repeats group by doc_id),
lines as (select doc_id, unnest(l) as line from t),
lined as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
m as (
  select doc_id, len(w)::bigint as n_words, coalesce(length(array_to_string(w, '')), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(repeated.n, 0)::bigint as n_repeat_words,
    coalesce(n_lines, 0)::bigint as n_lines,
    length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]+', '', 'g'))::bigint as n_letters,
    length(regexp_replace(text, '[^A-Z]+', '', 'g'))::bigint as n_upper
  from t left join lined using (doc_id) left join repeated using (doc_id)),
f as (
  select *, (case when n_words < 50 then 1 else 0 end | case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
    | case when 10 * n_symbols > 10 * n_words then 4 else 0 end | case when 10 * n_symbols > 3 * n_words then 8 else 0 end
    | case when n_lines >= 4 and 2 * n_dup_lines > n_lines then 16 else 0 end
    | case when word_chars > 30 * n_words then 32 else 0 end | case when 2 * word_chars < 3 * n_words then 64 else 0 end
    | case when 10 * n_upper > 8 * n_letters then 128 else 0 end
    | case when 2 * n_letters < word_chars then 256 else 0 end)::bigint as failed
  from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, (failed & 3) <> 0 as base_failed,
  (failed & 511) = 0 as kept,
  case failed & 511 when 1 then 'few_words' when 2 then 'repeated_words' when 4 then 'many_symbols' when 8 then 'some_symbols'
    when 16 then 'repeated_lines' when 32 then 'long_words' when 64 then 'short_words' when 128 then 'upper_case'
    when 256 then 'few_letters' end as only_rule,
  case when only_rule is null then 0 else count(*) over (partition by failed & 511) end as n_only_rule
from f
"""

_FIELD = "coalesce(octet_length(encode({0}::varchar)) || ':' || {0}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# One row for each level of a tree, the nodes as a list; level 0 are the leaves.
_LEVELS = """{0}_levels as (
  select {1}, 0 as level, nodes from {0}_leaves
  union all
  select {1}, level + 1, list_transform(range(1, len(nodes) + 1, 2), lambda i: sha256(array_to_string(nodes[i:i + 1], '')))
  from {0}_levels where len(nodes) > 1)"""

_CRC = """(xor(list_reduce(flatten(list_transform(string_split(doc_id::varchar, ''),
    lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda x, c: case when c >= 0 then xor(x, c) when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end,
  4294967295::bigint), 4294967295))"""

MERKLE_MANIFEST = f"""
with recursive leaves as (
  select doc_id, lang, {_leaf("n_chars")} as leaf,
    case when {_CRC} % 7 = 0 then {_leaf("(n_chars + 1)")} end as other
  from documents),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from leaves),
lang_leaves as (select lang, list(leaf order by pos) as nodes from placed group by lang),
{_LEVELS.format("lang", "lang")},
tops as (
  select lang, nodes[1] as subroot, row_number() over (order by encode(lang) nulls first) - 1 as place
  from lang_levels where len(nodes) = 1),
root_leaves as (select 0 as one, list(subroot order by place) as nodes from tops),
{_LEVELS.format("root", "one")},
top as (select nodes[1] as root from root_levels where len(nodes) = 1),
turned as (
  select p.*, subroot, root, place from placed p join tops t on p.lang is not distinct from t.lang, top),
steps as (
  select lang, pos, level, pos >> level as spot, nodes from turned join lang_levels using (lang) where lang is not null
  union all
  select t.lang, pos, level, pos >> level, nodes from turned t, lang_levels l where t.lang is null and l.lang is null
  union all
  select lang, pos, 1000 + level, place >> level, nodes from turned, root_levels),
proofs as (
  select lang, pos, list(case when spot % 2 = 1 then '<' || nodes[spot] else coalesce('>' || nodes[spot + 2], '') end order by level) as path
  from steps where len(nodes) > 1 group by lang, pos),
folded as (
  select t.*, coalesce(path, []) as path,
    list_reduce(coalesce(path, []), lambda n, s: sha256(case when s[1] = '<' then s[2:] || n else n || s[2:] end),
      coalesce(other, leaf)) as folded_root
  from turned t left join proofs p on t.lang is not distinct from p.lang and t.pos = p.pos)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) as proof_sha256, folded_root,
  folded_root = root as verified
from folded
"""

ORACLE = {
    "op11_merkle_manifest": MERKLE_MANIFEST,
    "op4_minhash": MINHASH,
    "op7_decontamination": DECONTAMINATION,
    "op8_quality_rules": QUALITY_RULES,
    "op3_mixing": _mixing(),
    "op5_url_filter": URL_FILTER,
    "op6_line_dedup": LINE_DEDUP,
}
