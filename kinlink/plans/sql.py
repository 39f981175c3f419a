"""SQL twins of the queries, for any engine that has the test tables as views (written for DuckDB).

``PREFIX`` is a chain of common table expressions that restates fixtures, normalisation, blocking, labels and features; a query's
oracle is the chain and a last SELECT. Expressions that a query doesn't use aren't run.
"""

from __future__ import annotations

from kinlink.functions.text import ADDRESS_ABBREVIATIONS, LEGAL_FORMS, NAME_ABBREVIATIONS
from kinlink.operators.experiments import RARITIES, all_experiments
from kinlink.operators.features import FEATURES, RATIOS

TOP_K, CAP, MIN_SIM, LARGEST_K = 10, 100, 0.05, 200
_FORMS = "[" + ", ".join(f"'{f}'" for f in LEGAL_FORMS) + "]"


def _mapped(table: tuple[tuple[str, str], ...]) -> str:
    whens = " ".join(f"when '{v}' then '{to}'" for word, to in table for v in ({word} if "'?" not in word else {word.replace("'?", ""), word.replace("'?", "''")}))
    return f"lambda t: case t {whens} else t end"


BASE = rf"""
tk as materialized (select doc_id, lang, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') as w from documents),
parts as (select doc_id, lang, array_to_string(w[1:5], ' ') as nm, lower(array_to_string(w[1:12], ' ')) as k, coalesce(w[6], 'main') as w6 from tk),
ent as materialized (
  select 'S' || (doc_id % 3 + 1) || '-' || doc_id as entity_id, 's' || (doc_id % 3 + 1) as source,
         nm || case doc_id % 5 when 0 then ' Inc.' when 1 then ' LLC' when 2 then ', Ltd' when 3 then ' & Co' else '' end as business_name,
         case when doc_id % 3 <> 0 and doc_id % 29 = 0 then null
              else (length(k) + 1) || ' ' || w6 || ' St, Ste ' || (length(k) % 50) || ', ' || (10000 + length(nm)) end as business_address,
         case when doc_id % 41 = 0 then null when doc_id % 2 = 0 then lang else upper(lang) end as country, k as match_key
  from parts),
n1 as (select *, regexp_replace(trim(regexp_replace(lower(nfc_normalize(business_name)), '\s+', ' ', 'g')), '\s*&\s*', ' and ', 'g') as n,
         regexp_replace(lower(nfc_normalize(business_address)), '[,.]', ' ', 'g') as a from ent),
n2 as (select * replace (regexp_replace(regexp_replace(n, '([a-z])\.([a-z])', '\1\2', 'g'), '([a-z])\.([a-z])', '\1\2', 'g') as n,
         trim(regexp_replace(regexp_replace(a, '[^\p{{L}}\p{{N}}_\s\-]', ' ', 'g'), '\s+', ' ', 'g')) as a) from n1),
n3 as (select * replace (regexp_replace(regexp_replace(regexp_replace(n, '\.(\s|$)', '\1', 'g'), '[-/|\\]', ' ', 'g'), '[^\p{{L}}\p{{N}}_\s'']', ' ', 'g') as n) from n2),
n4 as (select *, list_transform(list_filter(string_split(trim(regexp_replace(n, '\s+', ' ', 'g')), ' '), lambda t: t <> ''), {_mapped(NAME_ABBREVIATIONS)}) as w,
         list_transform(string_split(a, ' '), {_mapped(ADDRESS_ABBREVIATIONS)}) as aw from n3),
n5 as (select * replace (case when list_contains({_FORMS}, w[len(w)]) then w[1:len(w) - 1] else w end as w) from n4),
n6 as (select * replace (case when len(w) > 1 and list_contains({_FORMS}, w[1]) then w[2:] else w end as w) from n5),
norm as materialized (
  select entity_id, source, business_name, business_address, country, business_address is null or trim(business_address) = '' as address_missing,
         nullif(array_to_string(w, ' '), '') as normalized_name, nullif(array_to_string(list_sort(w), ' '), '') as token_sorted_name,
         nullif(array_to_string(aw, ' '), '') as normalized_address, upper(country[1]) || lower(country[2:]) as normalized_country
  from n6),
truth as materialized (
  select l.entity_id as source1_entity_id, coalesce(r.ids, '') as matched_entity_ids
  from (select * from ent where source = 's1') l
  left join (select match_key, string_agg(entity_id, ',' order by entity_id) as ids from ent where source <> 's1' group by match_key) r using (match_key)),
records as materialized (
  select source1_entity_id as s1_id, case when matched_entity_ids = '' then [] else list_sort(list_distinct(string_split(matched_entity_ids, ','))) end as targets,
         matched_entity_ids = '' as is_singleton from truth),
tgt as materialized (select s1_id, target_id, lower(target_id[1:2]) as target_source from (select s1_id, unnest(targets) as target_id from records)),
gold as (select least(s1_id, target_id) as lo, greatest(s1_id, target_id) as hi from tgt)"""


def tfidf(tag: str, left: str, right: str, low: int = 2, high: int = 3, k: int = TOP_K) -> str:
    """``tag (l, r, score, rank)``; left and right select id, grp and text."""
    sizes = ", ".join(f"({n})" for n in range(low, high + 1))
    return rf"""
{tag}_b as materialized (select 'l' as side, * from ({left}) union all select 'r' as side, * from ({right})),
{tag}_w as (select side, id, grp, ' ' || unnest(list_filter(string_split(regexp_replace(lower(text), '\s+', ' ', 'g'), ' '), lambda x: x <> '')) || ' ' as w from {tag}_b),
{tag}_i as (select side, id, grp, w, n, unnest(range(1, greatest(length(w) - n + 2, 1))) as i from {tag}_w, (values {sizes}) v(n)),
{tag}_f as materialized (select side, id, grp, substr(w, i, n) as gram, count(*) as n from {tag}_i group by all),
{tag}_d as (select f.grp, gram, ln((1.0::double + any_value(total)) / (1 + count(*))) + 1 as idf
            from {tag}_f f join (select grp, count(*) as total from {tag}_b where text is not null group by grp) t on f.grp = t.grp group by f.grp, gram),
{tag}_r as materialized (select side, id, grp, gram, (1 + ln(n)) * idf as w from {tag}_f join {tag}_d using (grp, gram)),
{tag}_n as materialized (select side, id, grp, gram, w / sqrt(sum(w * w) over (partition by side, id)) as w from {tag}_r),
{tag}_s as (select a.id as l, b.id as r, round(sum(a.w * b.w), 9) as score from {tag}_n a join {tag}_n b on a.grp = b.grp and a.gram = b.gram where a.side = 'l' and b.side = 'r' group by all),
{tag} as materialized (select * from (select *, row_number() over (partition by l order by score desc, r) as rank from {tag}_s) where rank <= {k})"""


def _side(source: str, text: str = "normalized_name", grp: str = "''", where: str = "true") -> str:
    return f"select entity_id as id, {grp} as grp, {text} as text from norm where source = '{source}' and {text} is not null and {where}"


_POSTAL = r"nullif(array_to_string(regexp_extract_all(case when not address_missing then normalized_address end, '\d+'), ' '), '')"
_COUNTRY = "coalesce(country, 'unknown')"


def _blocking(r: str) -> str:
    rare = ",".join(
        f"""
rare_df_{r}_{i} as materialized (select token from rtok_{r} group by token having count(*) <= greatest(floor((select count(*) from norm where source = '{r}' and normalized_name is not null) * {p}::double), 1)),
rare_l_{r}_{i} as materialized (select id, token from ltok where token in (select token from rare_df_{r}_{i})),
rare_{r}_{i} as (
  select l, r, shared / n_rare::double as score from (
    select *, row_number() over (partition by l order by shared desc, r) as k from (
      select a.id as l, b.id as r, count(*) as shared from rare_l_{r}_{i} a join rtok_{r} b using (token) group by all))
  join (select id as l, count(*) as n_rare from rare_l_{r}_{i} group by id) using (l) where k <= 50)"""
        for i, p in enumerate(RARITIES)
    )
    both = f"l.source = 's1' and r.source = '{r}' and l.entity_id <> r.entity_id"
    pairs = "select l.entity_id as l, r.entity_id as r, 1.0::double as score from norm l join norm r on"
    return (
        tfidf(f"tf_{r}", _side("s1"), _side(r))
        + ","
        + tfidf(f"big_{r}", _side("s1"), _side(r), k=LARGEST_K)
        + ","
        + tfidf(f"post_{r}", _side("s1", _POSTAL), _side(r, _POSTAL), 2, 4, 50)
        + ","
        + tfidf(f"cn_{r}", _side("s1", grp=_COUNTRY), _side(r, grp=_COUNTRY), k=50)
        + ","
        + tfidf(f"ca_{r}", _side("s1", "normalized_address", _COUNTRY, "not address_missing"), _side(r, "normalized_address", _COUNTRY, "not address_missing"), k=50)
        + f""",
ts_{r} as ({pairs} l.token_sorted_name[1:5] = r.token_sorted_name[1:5] where {both}),
ap_{r} as ({pairs} l.normalized_address[1:8] = r.normalized_address[1:8] where {both} and not l.address_missing and not r.address_missing),
rtok_{r} as materialized (select distinct entity_id as id, unnest(string_split(normalized_name, ' ')) as token from norm where source = '{r}' and normalized_name is not null),{rare},
cand_{r} as materialized (
  select l, r, score, method from (select *, row_number() over (partition by l order by score desc, r) as k from (
    select l, r, max(score) as score, string_agg(distinct method, '+' order by method) as method from (
      select l, r, score, 'tfidf' as method from tf_{r} where score >= {MIN_SIM} union all
      select l, r, score, 'token_sort' from ts_{r} union all select l, r, score, 'addr_prefix' from ap_{r}) group by l, r)) where k <= {CAP}),
lab_{r} as materialized (
  select c.l, c.r, c.score, c.method, case when s.is_singleton then 'singleton_negative' when t.s1_id is not null then 'positive' else 'unsampled_negative' end as kind
  from cand_{r} c left join tgt t on t.s1_id = c.l and t.target_id = c.r left join records s on s.s1_id = c.l),
per_{r} as materialized (select l, max(score) as tp_max, count(*) as n_pos from lab_{r} where kind = 'positive' group by l),
neg_{r} as materialized (
  select n.*, p.n_pos, greatest(0, round(tp_max - 0.1::double, 9)) as f1, greatest(0, round(tp_max - 0.2::double, 9)) as f2,
         round(quantile_cont(score, 0.3) over (partition by n.l), 9) as easy_most, max(score) over (partition by n.l) as top, md5('42|' || n.l || '|' || n.r) as draw
  from lab_{r} n join per_{r} p using (l) where kind = 'unsampled_negative'),
smp_{r} as materialized (
  select l, r, score, method, kind from lab_{r} where kind <> 'unsampled_negative'
  union all select l, r, score, method, 'hard_negative' from (
    select *, row_number() over (partition by l order by draw, r) as k from neg_{r} where score >= case when top >= f1 then f1 else f2 end) where k <= 2 * n_pos
  union all select l, r, score, method, 'easy_negative' from (
    select *, row_number() over (partition by l order by draw, r) as k from neg_{r} where score <= easy_most) where k <= 2 * n_pos),
rank_{r} as (
  select *, cast(row_number() over o - 1 as double) as candidate_rank, coalesce(score - lead(score) over o, 0) as candidate_margin
  from smp_{r} window o as (partition by l order by score desc, r, kind)),
feat_{r} as materialized ({_features(r)})"""
    )


def _features(r: str) -> str:
    jac = lambda a, b: f"case when len(list_distinct(list_concat({a}, {b}))) = 0 then 1.0 else len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b})))::double end"
    plain = lambda x: f"translate({x}, 'äöüßéèêëçñíóáúàâîïôûùœæ', 'ABCDEFGHIJKLMNOPQRSTUVW')"  # noqa: E731  the engine counts bytes; texts have no upper case
    edit = lambda a, b: f"case when greatest(length({a}), length({b})) = 0 then 1.0 else 1 - levenshtein({plain(a)}, {plain(b)}) / greatest(length({a}), length({b}))::double end"
    diff = lambda a, b: f"abs(length({a}) - length({b})) / greatest(length({a}), length({b}), 1)::double"
    name = {"name_exact": "(a.nm = b.nm)::int::double", "name_levenshtein": edit("a.nm", "b.nm"), "name_token_jaccard": jac("a.nt", "b.nt"), "name_ngram_cosine": jac("a.nb", "b.nb"), "name_length_difference": diff("a.nm", "b.nm")}
    addr = {
        "address_exact": "(a.ad = b.ad)::int::double", "address_jaccard": jac("a.at", "b.at"), "address_ngram_similarity": jac("a.ab", "b.ab"), "address_edit_distance": edit("a.ad", "b.ad"),
        "numeric_token_similarity": jac("a.an", "b.an"), "postal_similarity": "(a.pc = b.pc and a.pc <> '')::int::double", "address_length_difference": diff("a.ad", "b.ad"),
    }
    none, one, eq = "a.co = '' and b.co = ''", "a.co = '' or b.co = ''", "(a.co = b.co)::int::double"
    cols = {k: f"case when a.nm = '' or b.nm = '' then 0.0 else {v} end" for k, v in name.items()}
    cols |= {k: f"case when a.ms or b.ms then -1.0 when a.ad = '' or b.ad = '' then 0.0 else {v} end" for k, v in addr.items()}
    cols |= {"country_exact": f"case when {none} then 1.0 when {one} then 0.0 else {eq} end", "country_normalized": f"case when {none} then 0.0 when {one} then -1.0 else {eq} end", "country_unseen": f"({one})::int::double"}
    cols |= {"blocking_score": "p.score"} | {f"blocking_method_{m}": f"contains(p.method, '{m}')::int::double" for m in ("tfidf", "token_sort", "addr_prefix")}
    cols |= {"candidate_rank": "candidate_rank", "candidate_margin": "candidate_margin", "candidate_source_s2": f"{float(r == 's2')}", "candidate_source_s3": f"{float(r == 's3')}"}
    cols |= {"address_missing_left": "a.ms::int::double", "address_missing_right": "b.ms::int::double", "address_missing_either": "(a.ms or b.ms)::int::double"}
    each = ", ".join(f"cast({v} as double) as {k}" for k, v in cols.items())
    return f"select p.l, p.r, p.kind, p.method, cast(p.kind = 'positive' as integer) as label, '{r}' as candidate_source, {each} from rank_{r} p join sets a on a.entity_id = p.l join sets b on b.entity_id = p.r"


_GRAMS = "case when length({0}) < 2 then [] else list_distinct(list_transform(range(1, length({0})), lambda i: substr({0}, i, 2))) end"
SETS = rf""",
ltok as materialized (select distinct entity_id as id, unnest(string_split(normalized_name, ' ')) as token from norm where source = 's1' and normalized_name is not null),
txt as (select entity_id, coalesce(normalized_name, '') as nm, coalesce(normalized_address, '') as ad, lower(coalesce(normalized_country, '')) as co, address_missing as ms from norm),
sets as materialized (
  select *, case when nm = '' then [] else list_distinct(string_split(nm, ' ')) end as nt, {_GRAMS.format("nm")} as nb,
         case when ad = '' then [] else list_distinct(string_split(ad, ' ')) end as at, {_GRAMS.format("ad")} as ab,
         list_distinct(list_filter(string_split_regex(ad, '[^\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '\d+'))) as an, case when ad = '' then '' else string_split(ad, ' ')[-1] end as pc
  from txt)"""
PREFIX = f"with {BASE}{SETS},{_blocking('s2')},{_blocking('s3')}"


def oracle(body: str) -> str:
    return f"{PREFIX}\n{body}"


def recall_row(cand: str, pair_type: str, source: str) -> str:
    """The single row of ``evaluate_candidates``."""
    return f"""
select '{pair_type}' as pair_type, cast(count(n_targets) as bigint) as s1_entities_in_gt, cast(coalesce(sum(n_targets), 0) as bigint) as total_gt_targets, cast(coalesce(sum(n_found), 0) as bigint) as found_targets,
       round(coalesce(sum(n_found), 0) / greatest(coalesce(sum(n_targets), 0), 1)::double, 6) as recall, (select cast(count(*) as bigint) from {cand}) as total_candidates,
       round((select coalesce(avg(n), 0) from (select count(*) as n from {cand} group by l)), 6) as avg_candidates_per_entity,
       cast(count(*) filter (n_targets is null) as bigint) as singleton_s1_count, cast(coalesce(sum(n_cands) filter (n_targets is null), 0) as bigint) as singleton_cand_vol
from (select s1_id from records) s
left join (select t.s1_id, count(*) as n_targets, count(c.l) as n_found from tgt t left join {cand} c on c.l = t.s1_id and c.r = t.target_id where target_source = '{source}' group by 1) h using (s1_id)
left join (select l as s1_id, count(*) as n_cands from {cand} group by 1) v using (s1_id)"""


def experiment_ctes() -> str:
    """``runs (pair_type, run, experiment, l, r)`` of all experiments."""
    table = {"tfidf_name": ("big", "score"), "tfidf_boosted": ("big", "least(score * 2, 1.0)"), "token_sort": ("ts", "score"), "address_prefix": ("ap", "score"), "postal_ngram": ("post", "score"), "country_tfidf_name": ("cn", "score"), "country_tfidf_addr": ("ca", "score")}
    table |= {f"rare_token_{p}": (f"rare_{{r}}_{i}", "score") for i, p in enumerate(RARITIES)}
    selects = []
    for r, pair in (("s2", "S1_S2"), ("s3", "S1_S3")):
        for run, e in enumerate(all_experiments()):
            for p in e.parts:
                name, score = table[p]
                source = name.format(r=r) if "{r}" in name else f"{name}_{r}"
                where = f"score >= {MIN_SIM}" + (f" and rank <= {e.top_k}" if e.top_k and p.startswith("tfidf") else "") if name in ("big", "post", "cn", "ca") else "true"
                selects.append(f"select '{pair}' as pair_type, {run} as run, '{e.name}' as experiment, {e.group} as experiment_set, {e.cap} as cap, l, r, {score} as score from {source} where {where}")
    return f""",
run_pairs as materialized (
  select pair_type, run, experiment, experiment_set, l, r from (
    select *, row_number() over (partition by pair_type, run, l order by score desc, r) as k from (
      select pair_type, run, experiment, experiment_set, cap, l, r, max(score) as score from ({" union all ".join(selects)}) group by all)) where k <= cap),
run_names as (select * from (values {", ".join(f"({i}, '{e.name}', {e.group})" for i, e in enumerate(all_experiments()))}) v(run, experiment, experiment_set)),
bare as (select distinct entity_id as s1_id from norm where source = 's1' and address_missing),
gold_t as materialized (select case target_source when 's2' then 'S1_S2' else 'S1_S3' end as pair_type, t.s1_id, target_id, b.s1_id is not null as is_bare from tgt t left join bare b on b.s1_id = t.s1_id),
run_hits as (select p.pair_type, run, count(*) as found, count(*) filter (is_bare) as found_bare from run_pairs p join gold_t g on g.pair_type = p.pair_type and g.s1_id = p.l and g.target_id = p.r group by all),
run_vol as (
  select pair_type, run, sum(n) as total, avg(n) as mean, coalesce(sum(n) filter (not has), 0) as single from (
    select p.pair_type, run, l, count(*) as n, l in (select s1_id from gold_t g where g.pair_type = p.pair_type) as has from run_pairs p group by all) group by all),
run_tot as (select pair_type, count(*) as n_targets, count(*) filter (is_bare) as n_bare from gold_t group by all),
run_eval as materialized (
  select n.run, n.experiment, n.experiment_set, t.pair_type, coalesce(found, 0) / n_targets::double as recall, case when n_bare > 0 then coalesce(found_bare, 0) / n_bare::double end as address_missing_recall,
         coalesce(mean, 0) as avg_candidates, cast(coalesce(total, 0) as bigint) as total_candidates, cast(coalesce(single, 0) as bigint) as singleton_volume
  from run_names n cross join run_tot t left join run_hits h on h.run = n.run and h.pair_type = t.pair_type left join run_vol v on v.run = n.run and v.pair_type = t.pair_type)"""


def sweep(prefix: str) -> str:
    return f"""{PREFIX}{experiment_ctes()}
select experiment, pair_type, round(recall, 6) as recall, round(address_missing_recall, 6) as address_missing_recall, round(avg_candidates, 6) as avg_candidates, total_candidates, singleton_volume
from run_eval where starts_with(experiment, '{prefix}')"""


def feature_select(names: list[str], source: str = "s2") -> str:
    cols = ", ".join(f"round({n}, 9) as {n}" for n in names)
    return oracle(f"select l as source1_entity_id, r as candidate_entity_id, kind as negative_type, {cols} from feat_{source}")


NATIVE_FEATURES = [f for f in FEATURES if f not in RATIOS]
