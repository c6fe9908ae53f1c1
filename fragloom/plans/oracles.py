"""DuckDB SQL for the driver's queries of the reference's capabilities, by name."""

from __future__ import annotations

from fragloom.functions import text as T
from fragloom.operators.schema import COMPLETENESS_FIELDS, FIELDS, FRAGMENTS, REQUIRED_FIELDS
from fragloom.plans.queries import APPROVED_ID, LIFETIME_S, MANUAL_IDS, SALARIES
from fragloom.sources import fixtures as X


def _titles(words: list[str], undotted: list[str]) -> str:
    return "(?:" + "|".join(w.replace(".", r"\.").replace("(", r"\(").replace(")", r"\)") + ("" if w in undotted else r"\.?") for w in words) + ")"


def norm(name: str) -> str:
    out = f"trim(regexp_replace(translate(lower({name}), '{T.ACCENTED}', '{T.PLAIN}'), '\\s+', ' ', 'g'))"
    title = _titles(T.NAME_TITLES, [])
    for pattern in (f"^{title}\\s+", f"\\s+{title}$") * 2:
        out = f"trim(regexp_replace({out}, '{pattern}', '', 'i'))"
    return f"nullif({out}, '')"


def plain(text: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(coalesce({text}, ''))), '\\s+', ' ', 'g'))"


def untitled(text: str) -> str:
    front = f"trim(regexp_replace({text}, '^{_titles(T.BUILT_PREFIXES, T.UNDOTTED_PREFIXES)}\\s+', '', 'i'))"
    return f"trim(regexp_replace({front}, '\\s+{_titles(T.BUILT_SUFFIXES, T.UNDOTTED_SUFFIXES)}$', '', 'i'))"


def canonical(key: str) -> str:
    out = f"regexp_replace(lower(trim({key})), '[\\s_\\-]+', '', 'g')"
    for wrong, right in T.KEY_ALIASES.items():
        out = f"case when {out} = '{wrong}' then '{right}' else {out} end"
    return out


def amount(text: str) -> str:
    digits = f"replace(regexp_replace({text}, '[^0-9.,\\-]', '', 'g'), ',', '.')"
    dots = f"(length({digits}) - length(replace({digits}, '.', '')))"
    joined = f"replace(left({digits}, length({digits}) - strpos(reverse({digits}), '.')), '.', '') || right({digits}, strpos(reverse({digits}), '.'))"
    return f"try_cast(case when {dots} > 1 then {joined} else {digits} end as double)"


def trigrams(text: str) -> str:
    words = f"list_filter(string_split(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"
    return f"list_distinct(flatten(list_transform({words}, lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))"


def similarity(a: str, b: str) -> str:
    common = f"len(list_intersect({trigrams(a)}, {trigrams(b)}))"
    return f"cast(cast({common} / (len({trigrams(a)}) + len({trigrams(b)}) - {common}) as float) as double)"


PERSONS = f"persons as (select p.*, {norm('full_name')} as norm_name from ({X.PERSONS}) p)"
REVIEWS = f"reviews as ({X.REVIEWS})"
BOTH = f"with {PERSONS}, {REVIEWS}"
RECURSIVE = BOTH.replace("with ", "with recursive ", 1)
FILLED = " + ".join(f"(case when {f} is not null then 1 else 0 end)" for f in COMPLETENESS_FIELDS)
GOLD = f"""gold as (
  select *, ({FILLED}) / 8.0 as completeness from persons p
  where match_key in (select match_key from reviews where status = 'approved')
     or ({" and ".join(f"{f} is not null" for f in REQUIRED_FIELDS)} and ({FILLED}) >= 7
         and norm_name in (select norm_name from persons group by norm_name having count(*) = 1)))"""
ELIGIBLE = "norm_name is not null and length(norm_name) >= 3 and len(string_split(norm_name, ' ')) >= 2"

# Fragments

KINDS = "case " + " ".join(f"when best < 0.5 then 'unknown' when s_{kind} = best then '{kind}'" if i == 0 else f"when s_{kind} = best then '{kind}'" for i, kind in enumerate(FRAGMENTS)) + " end"
SHARES = ", ".join(f"len(list_intersect(map_keys(m), {list(keys)!r})) / {float(len(keys))} as s_{kind}" for kind, keys in FRAGMENTS.items())
CLASSIFIED = f"""
raw as ({X.FRAGMENTS}),
decoded as (select *, case when json_valid(value) then map_from_entries(list_transform(json_keys(value), lambda k: {{'k': {canonical('k')}, 'v': json_extract_string(value, '$."' || k || '"')}})) end as m from raw),
shares as (select *, {SHARES} from decoded where m is not null),
scored as (select *, greatest({", ".join(f"s_{k}" for k in FRAGMENTS)}) as best from shares),
typed as (select *, {KINDS} as fragment_type, {untitled(f"case when coalesce(m['fullname'], '') <> '' then {plain("m['fullname']")} else {plain(plain("m['name']") + " || ' ' || " + plain("m['lastname']"))} end")} as name,
  {plain("m['passport']")} as p, {plain("m['address']")} as a from scored),
classified as (select seq, ts, value, m, fragment_type, name, case when p <> '' then 'passport:' || p when name <> '' then 'name:' || name when a <> '' then 'addr:' || a else '' end as match_key from typed)"""
LINKED = f"""{CLASSIFIED},
usable as (select *, epoch_us(ts) / 1000000.0 as t, case when match_key like 'name:%' then substring(match_key, 6) when fragment_type = 'personal' and match_key like 'passport:%' and name <> '' then name end as aname,
  case when fragment_type = 'personal' and match_key like 'passport:%' and name <> '' then match_key end as reg
  from classified where fragment_type <> 'unknown' and match_key <> ''),
looked as (select *, last_value(reg ignore nulls) over w as lk, last_value(case when reg is not null then t end ignore nulls) over w as lt
  from usable window w as (partition by aname order by seq rows between unbounded preceding and 1 preceding)),
linked as (select *, case when match_key like 'name:%' and lk is not null and t - lt < {3 * LIFETIME_S} then lk else match_key end as buffer_key from looked)"""
CHUNKED = f"""{LINKED},
gaps as (select *, case when t - lag(t) over (partition by buffer_key order by seq) >= {LIFETIME_S} then 1 else 0 end as gap from linked),
lives as (select *, sum(gap) over (partition by buffer_key order by seq) as life from gaps),
chunks as (select *, (row_number() over (partition by buffer_key, life order by seq) - 1) // 2 as chunk from lives),
chunked as (select *, count(*) over (partition by buffer_key, life, chunk) = 2 as fired from chunks)"""


def _field(field: str) -> str:
    whens = [f"when fragment_type = '{kind}' then nullif(m['{key}'], '')" for kind, keys in FRAGMENTS.items() for key, target in keys.items() if target == field]
    if field == "full_name":
        whens.insert(0, "when fragment_type = 'personal' then nullif(name, '')")
    value = f"case {' '.join(whens)} end"
    return amount(value) if field == "salary" else value


FOLDED = f"""{CHUNKED},
parts as (select *, {", ".join(f"{_field(f)} as f_{f}" for f in FIELDS)} from chunked where fired),
folded as (select buffer_key, min_by(match_key, seq) as match_key, min(seq) as first_seq, max(seq) as last_seq, max(ts) as updated_at,
  {", ".join(f"min_by(f_{f}, seq) filter (where f_{f} is not null) as {f}" for f in FIELDS)} from parts group by buffer_key, life, chunk)"""
UPSERTED = f"""{FOLDED},
grouped as (select match_key, min(last_seq) as place, {", ".join(f"min_by({f}, last_seq) filter (where {f} is not null) as {f}" for f in FIELDS)}, min(updated_at) as created_at, max(updated_at) as updated_at from folded group by match_key),
upserted as (select *, row_number() over (order by place, match_key) as id, {norm('full_name')} as norm_name from grouped)"""
SECONDS = "cast(floor(epoch(created_at)) as bigint) as created_at, cast(floor(epoch(updated_at)) as bigint) as updated_at"

# Merge

MERGED_TIMES = f"{X.EPOCH} + id * 60 as created_s, {X.EPOCH} + id * 90 as updated_s"
ABSENT = [f for f in FIELDS if f not in "passport full_name city company job email iban phone ipv4 salary".split()]
SURVIVORS = f"""{RECURSIVE},
links as (
  select a.id as u, b.id as v from persons a join persons b on a.passport = b.passport and a.id < b.id where {similarity('a.norm_name', 'b.norm_name')} >= 0.85
  union
  select min(id), max(id) from persons where {ELIGIBLE} group by norm_name having count(*) = 2 and count(passport) >= 1 and count(distinct passport) <= 1),
edges as (select u, v from links union select v, u from links),
reach(node, near) as (select u, u from edges union select r.node, e.v from reach r join edges e on e.u = r.near),
survivors as (select node as loser, min(near) as survivor from reach group by node having min(near) < node)"""


def _survived(prefix: str) -> str:
    one = [f for f in FIELDS if f not in (*ABSENT, "full_name")]
    return f"""{prefix},
mapped as (select p.*, coalesce(s.survivor, p.id) as root, {MERGED_TIMES} from persons p left join survivors s on p.id = s.loser),
folded as (select root as id, min_by(match_key, id) as match_key, (list(full_name order by length(full_name) desc nulls last, id))[1] as full_name,
  {", ".join(f"min_by({f}, id) filter (where {f} is not null) as {f}" for f in one)}, min(created_s) as created_at, max(updated_s) as updated_at from mapped group by root)
select id, match_key, {", ".join("cast(null as varchar) as " + f if f in ABSENT else f for f in FIELDS)}, {norm('full_name')} as norm_name, created_at, updated_at from folded"""


# Reconcile

NAMES = f"""{BOTH},
people as (select id, norm_name as norm, passport from persons where {ELIGIBLE} and match_key not in (select match_key from reviews where status in ('approved', 'merged'))),
catalog as (select norm, string_split(norm, ' ') as words, count(*) as n_persons, min(id) as anchor_id, count(distinct passport) as n_passports from people group by norm),
names as (select *, words[1] || ' ' || words[2] as key2, words[1] || '|' || left(words[2], 3) as keyt from catalog)"""
PAIRS = f"""{NAMES},
pairs as (
  select a.norm as a, b.norm as b, {similarity('a.norm', 'b.norm')} as sim, false as contain
  from names a join names b on a.keyt = b.keyt and a.norm <> b.norm
  where a.keyt in (select keyt from names group by keyt having sum(n_persons) <= 20) and {similarity('a.norm', 'b.norm')} >= 0.85 and {similarity('a.norm', 'b.norm')} < 1
  union all
  select a.norm, b.norm, {similarity('a.norm', 'b.norm')}, true
  from names a join names b on a.key2 = b.key2 and a.norm <> b.norm
  where a.key2 in (select key2 from names group by key2 having sum(n_persons) <= 20) and len(a.words) <> len(b.words)
    and (len(list_filter(a.words, lambda w: not list_contains(b.words, w))) = 0 or len(list_filter(b.words, lambda w: not list_contains(a.words, w))) = 0))"""
GROUPS = f"""{PAIRS},
near as (select p.a as norm, min(n.anchor_id) as near, max(sim) as sim, bool_or(contain) as containment, bool_or(not contain) as fuzzy from pairs p join names n on n.norm = p.b group by p.a),
named as (select n.*, coalesce(r.sim, 1.0) as sim, coalesce(containment, false) as containment, coalesce(fuzzy, false) as fuzzy, r.norm is not null as has_near, least(n.anchor_id, coalesce(near, n.anchor_id)) as anchor, a.passport as anchor_passport
  from names n left join near r using (norm) join people a on a.id = n.anchor_id),
kept as (select least(p.id, anchor) as group_id, p.id as person_id, cast(round(cast(sim as decimal(18, 9)), 3) as double) as confidence, case when containment then 'name_containment' when fuzzy then 'fuzzy_name' else 'exact_name' end as reason
  from people p join named n using (norm)
  where (has_near or n_persons between 2 and 20) and not (not has_near and n_persons > 1 and p.passport is not null and anchor_passport is not null and p.passport <> anchor_passport)),
groups as (select * from kept where group_id in (select group_id from kept group by group_id having count(*) > 1))"""
GOLD_GROUPS = f"""{GROUPS},
gold_groups as (select group_id, count(*) as member_count, max(confidence) as max_confidence, (list(reason order by confidence desc, person_id))[1] as reason, string_agg(cast(person_id as varchar), ',' order by person_id) as members
  from groups where person_id in (select id from persons where match_key not in (select match_key from reviews)) group by group_id having count(*) >= 2)"""
PREFIXES = f"""{NAMES}, candidates as (select a.anchor_id as person_id_a, b.anchor_id as person_id_b, length(a.norm) / length(b.norm) as confidence from names a join names b on a.key2 = b.key2 and a.norm <> b.norm and starts_with(b.norm, a.norm))"""


def _top(table: str, field: str, n: int) -> str:
    return f"select {field}, count(*) as person_count from {table} where {field} is not null group by {field} order by person_count desc, {field} limit {n}"


def _upserted_into(phone: str) -> str:
    full = f"id, match_key, full_name, city, coalesce(company, 'other') as company, {phone} as phone, norm_name"
    return f"""with {PERSONS} select {full} from persons
      union all select (select max(id) from persons) + row_number() over (order by id), 'new:' || id, full_name, city, 'other', '7' || id, norm_name from persons"""


RAW_KEYS = "['E-Mail', 'Company Address', 'company_email', 'Company Adress', ' Full Name ', 'IPv4']"
STARRED = "line"
for _pattern, _instead in T.REDACTIONS:
    _flags = "gi" if _pattern.startswith("(?i)") else "g"
    STARRED = f"regexp_replace({STARRED}, '{_pattern.removeprefix('(?i)')}', '{_instead.replace('$', chr(92))}', '{_flags}')"

ORACLES = {
    "norm_names": f"with {PERSONS} select id, norm_name from persons",
    "normalized_texts": f"with {PERSONS} select id, {plain('''concat('  Ñandú', chr(9), full_name, '  À la  Crème ')''')} as plain, {untitled(plain('full_name'))} as untitled, full_name as first from persons",
    "normalized_keys": f"select r_regionkey, unnest(range(0, 6)) as n, unnest(list_transform({RAW_KEYS}, lambda k: {canonical('k')})) as key from region",
    "salaries": f"select o_orderkey, {amount('s')} as salary from (select o_orderkey, {SALARIES} as s from (select o_orderkey, cast(o_orderkey % 900 + 100 as varchar) as p from orders))",
    "masked": f"""select c_custkey, repeat('*', greatest(0, length(c_name) - 4)) || right(c_name, 4) as secret, '***' as short, {STARRED} as line
      from (select *, 'passport: AB' || (c_custkey + 100000) || ' iban ES91' || '2100041845020' || c_custkey || ' mail ' || lower(translate(c_name, '#', '.')) || '@example.com' as line from customer)""",
    "thousands": "select o_orderkey, coalesce(replace(format('{:,}', v), ',', '.'), '—') as shown from (select o_orderkey, case when o_orderkey % 5 <> 0 then cast(trunc(o_totalprice * 100) as bigint) end as v from orders)",
    "trigram_similarity": f"with {PERSONS}, x as (select id, norm_name as a, concat_ws(' ', reverse(string_split(norm_name, ' ')[1]), string_split(norm_name, ' ')[2]) as b from persons where norm_name is not null) select id, round({similarity('a', 'b')}, 5) as sim from x",
    "fragment_types": f"with {CLASSIFIED} select seq, fragment_type, match_key from classified union all select seq, null, null from decoded where m is null",
    "fragment_rejects": f"with {CLASSIFIED} select seq, case when fragment_type = 'unknown' then 'unknown' else 'orphan' end as reason from classified where fragment_type = 'unknown' or match_key = '' union all select seq, 'undecodable' from decoded where m is null",
    "bronze_counts": f"with {CLASSIFIED} select fragment_type, count(*) as n from classified group by fragment_type",
    "bounded_consume": f"with {CLASSIFIED} select seq, value from classified order by seq limit 500",
    "alias_links": f"with {LINKED} select seq, match_key, buffer_key from linked",
    "buffer_firings": f"with {CHUNKED} select seq, buffer_key, cast(life as bigint) as life, cast(chunk as bigint) as chunk, fired from chunked",
    "folded_persons": f"with {FOLDED} select last_seq as seq, first_seq, buffer_key, match_key, {', '.join(FIELDS)}, cast({' + '.join(f'(case when {f} is not null then 1 else 0 end)' for f in FIELDS)} as bigint) as filled from folded",
    "upserted_persons": f"with {UPSERTED} select id, match_key, {', '.join(FIELDS)}, norm_name, {SECONDS} from upserted",
    "fragment_log": f"""with {UPSERTED}, last as (select match_key, max(last_seq) as last_seq from folded group by match_key)
      select u.id as person_id, f.buffer_key as match_key, row_number() over (partition by u.id order by p.seq) - 1 as n, p.fragment_type
      from last l join folded f on f.match_key = l.match_key and f.last_seq = l.last_seq join upserted u on u.match_key = l.match_key
      join parts p on p.buffer_key = f.buffer_key and p.seq between f.first_seq and f.last_seq""",
    "merge_survivors": f"{SURVIVORS} select loser, survivor from survivors",
    "merged_persons": _survived(SURVIVORS),
    "manual_merge": _survived(f"with {PERSONS}, survivors as (select {max(MANUAL_IDS)} as loser, {min(MANUAL_IDS)} as survivor)"),
    "manual_merge_trace": f"""{BOTH}, l as (select match_key from persons where id = {max(MANUAL_IDS)}), s as (select match_key from persons where id = {min(MANUAL_IDS)})
      select match_key, status, cast(null as varchar) as survivor_match_key from reviews where match_key not in (select match_key from l) union all select l.match_key, 'merged', s.match_key from l, s""",
    "review_upsert": f"{BOTH} select match_key, case when id % 2 = 0 then 'approved' else 'merged' end as status, 'note ' || id || ' again' as note from persons union all select match_key, status, null from reviews where match_key not in (select match_key from persons)",
    "upsert_into_existing": _upserted_into("case when id % 6 = 0 or phone is null then '7' || id else phone end"),
    "upsert_nulls_only": _upserted_into("case when id % 6 = 0 then '' when phone is null then '7' || id else phone end"),
    "upsert_rows_sent": f"with {PERSONS} select 2 * count(*) as rows_sent from persons",
    "bronze_scan": f"with {CLASSIFIED} select seq, value from classified",
    "reprocessed_persons": f"with {UPSERTED} select id, match_key, {', '.join(FIELDS)}, norm_name, {SECONDS} from upserted",
    "approved_reviews": f"""{BOTH}, k as (select match_key from persons where id = {APPROVED_ID})
      select match_key, 'approved' as status, 'seen' as note from k union all select match_key, status, null from reviews where match_key not in (select match_key from k)""",
    "gold_stats_answer": f"{BOTH}, {GOLD} select count(*) as total_persons, count(iban) as with_bank, round(coalesce(avg(completeness) * 8, 0), 2) as avg_completeness from gold",
    "assistant_search": f"""with {PERSONS}, hits as (select id, full_name, count(*) over () as total from persons where (full_name ilike '%a%' or company ilike '%a%' or email ilike '%a%') and company ilike '%s%')
      select total, (select count(*) from persons) as total_persons, (select count(iban) from persons) as with_bank, id, full_name from hits order by id limit 10 offset 10""",
    "metrics_summary": f"with {CLASSIFIED}, n as (select fragment_type, count(*) as n from classified group by fragment_type) select fragment_type, cast(n / 10.0 as double) as a_second, cast((select count(*) from n) as double) as kinds from n",
    "name_catalog": f"{NAMES} select norm, len(words) as n_words, key2, keyt, n_persons, anchor_id, n_passports from names",
    "name_pairs": f"{PAIRS} select a, b, round(sim, 5) as sim, contain from pairs",
    "duplicate_groups": f"{GROUPS} select group_id, person_id, confidence, reason from groups",
    "duplicate_totals": f"{GROUPS} select count(distinct group_id) as n_groups, count(*) as n_members from groups",
    "gold_duplicate_groups": f"{GOLD_GROUPS} select * from gold_groups",
    "backfilled_names": f"with {PERSONS} select id, norm_name from persons",
    "group_members": f"""{GOLD_GROUPS}, m as (select group_id, unnest(string_split(members, ',')) as person_id from gold_groups)
      select group_id, cast(to_json(list({{'person_id': id, 'full_name': full_name, 'city': city, 'company': company}} order by id)) as varchar) as members from m join persons on id = cast(person_id as bigint) group by group_id""",
    "gold_persons": f"{BOTH}, {GOLD} select id, match_key, full_name, city, completeness from gold",
    "gold_stats": f"{BOTH}, {GOLD} select count(*) as total_persons, count(passport) as with_passport, count(city) as with_city, count(company) as with_company, count(iban) as with_bank, count(ipv4) as with_ipv4, cast(count(*) filter (where passport is not null and city is not null) as bigint) as cross_linked, coalesce(avg(completeness) * 8, 0) as avg_completeness from gold",
    "gold_top_cities": f"{BOTH}, {GOLD} {_top('gold', 'city', 50)}",
    "gold_top_companies": f"{BOTH}, {GOLD} {_top('gold', 'company', 50)}",
    "gold_completeness": f"{BOTH}, {GOLD} select cast({FILLED} as bigint) as fields_filled, count(*) as person_count from gold group by 1 order by 1",
    "maintained_gold": f"{SURVIVORS.replace(PERSONS, PERSONS.replace('persons as', 'silver as', 1) + ', persons as (select * from silver)', 1)}, merged as ({_survived('').lstrip(',').replace('mapped as', 'with mapped as', 1).replace('min(created_s) as created_at, max(updated_s) as updated_at', '0 as created_at, 0 as updated_at')}), {GOLD.replace('from persons', 'from merged')} select id, match_key, completeness from gold",
    "persons_page": f"with {PERSONS} select id, full_name, company from persons where (full_name ilike '%ST%' or company ilike '%ST%' or email ilike '%ST%') and company ilike '%a%' order by id limit 40 offset 20",
    "persons_city": f"with {PERSONS} select id, city, job from persons where lower(city) = 'brand#11' and job ilike '%%e_%' order by id limit 500",
    "person_lookup": f"with {PERSONS} select id, full_name, passport, email, salary from persons where id = 77",
    "live_stats": f"with {PERSONS} select count(*) as total_persons, count(iban) as with_bank from persons",
    "live_top_cities": f"with {PERSONS} {_top('persons', 'city', 5)}",
    "gold_page": f"{BOTH}, {GOLD} select id, full_name, completeness from gold where id > 100 order by id limit 31",
    "match_candidates": f"{PREFIXES} select person_id_a, person_id_b, round(confidence, 6) as confidence from candidates where confidence >= 0.4 order by candidates.confidence desc, person_id_a * 1000000000 + person_id_b limit 100",
    "groups_page": f"""{GOLD_GROUPS}, page as (select * from gold_groups where max_confidence >= 0.6 order by max_confidence desc, group_id limit 25),
      m as (select group_id, max_confidence as confidence, reason, cast(unnest(string_split(members, ',')) as bigint) as person_id from page),
      open as (select m.*, count(*) over (partition by group_id) as n from m where person_id in (select id from persons where match_key not in (select match_key from reviews)))
      select group_id, confidence, open.reason, person_id, full_name, city, company from open join persons on id = person_id where n >= 2""",
    "medallion": f"with {CLASSIFIED}, {PERSONS}, {REVIEWS}, {GOLD} select b as bronze, s as silver, g as gold, round(b / greatest(s, 1), 6) as ratio from (select (select count(*) from classified) as b, (select count(*) from persons) as s, (select count(*) from gold) as g)",
    "new_persons": f"with {PERSONS} select count(*) filter (where id * 60 > 6000) as n_new, count(*) as n_all from persons",
    "firing_size_quantiles": f"with {FOLDED}, q as (select quantile_disc(last_seq - first_seq, [0.5, 0.99]) as q from folded) select unnest([cast(0.5 as double), cast(0.99 as double)]) as share, unnest(q) as value from q",
}
ORACLES["published_gold"] = ORACLES["maintained_gold"]
