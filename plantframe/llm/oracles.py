"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from plantframe.llm import hard_negatives, licenses, line_dedup, mixing, near_dedup, quality, url_filter, vector_codes

WORD = r"[^\x20\x09-\x0D]+"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _quality() -> str:
    stops = " ".join(f"when lang = '{lang}' then (select count(distinct w) from unnest(ws) u(w) where w in ({_quoted(x for w in words for x in (w, w.capitalize()))}))"
                     for lang, words in quality.STOP_WORDS.items())
    bad = []
    for _, metric, least, most in quality.RULES:
        m = " / ".join([metric.split(" / ")[0], f"nullif({metric.split(' / ')[1]}, 0)"]) if " / " in metric else metric
        bad += [f"coalesce(({m})::double < {least}::double, false)"] if least is not None else []
        bad += [f"coalesce(({m})::double > {most}::double, false)"] if most is not None else []
    return f"""
with t as (select row_number() over () r, doc_id, lang, coalesce(text, '') text from documents),
w as (select r, doc_id, lang, text, regexp_extract_all(text, '{WORD}') ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) ls from t),
grams as (select r, p, md5(array_to_string(ws[p:p + 7], ' ')) g from (select r, ws, unnest(range(1, len(ws) - 6)) p from w where len(ws) > 8)),
dup as (select r, p from grams qualify count(*) over (partition by r, g) > 1),
cover as (select r, sum(least(8, coalesce(nxt - p, 8))) n from (select r, p, lead(p) over (partition by r order by p) nxt from dup) group by r),
m as (select doc_id, len(ws)::bigint n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
  (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, coalesce(n, 0)::bigint n_repeat_words, len(ls) n_lines,
  len(list_filter(ls, lambda x: rtrim(x) like '%...')) n_ellipsis_lines,
  length(text) - length(regexp_replace(text, '\\p{{L}}', '', 'g')) n_letters, length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g')) n_capitals,
  len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) n_echo_words,
  case {stops} end n_stop_words
  from w left join cover using (r)),
b as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({' or '.join(bad)}) kept from b"""


def _licenses() -> str:
    rows = ", ".join(f"('{n}', '{c}', '{t.replace(chr(39), chr(39) * 2)}')" for n, (c, t) in licenses.TEMPLATES.items())
    return f"""
with d as (select doc_id, coalesce(text, '') text from documents),
units as (
  select doc_id, 'line' unit, i - 1 unit_no, string_split(text, chr(10))[i] t from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) i from d)
  union all
  select doc_id, 'paragraph', i - 1, p[i] from (select doc_id, p, unnest(range(1, len(p) + 1)) i from (select doc_id, string_split_regex(text, '\\n[\\x20\\t\\r]*\\n') p from d)) where contains(p[i], chr(10))
  union all
  select doc_id, 'document', 0, text from d where regexp_matches(text, '\\n[\\x20\\t\\r]*\\n')),
texts as (select row_number() over () u, * from units),
words as (select u, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') ws from texts),
own as (select distinct u, ws[i] a, ws[i + 1] b from (select u, ws, unnest(range(1, len(ws))) i from words where len(ws) > 1)),
n_own as (select u, count(*) n from own group by u),
templates(license, license_class, t) as (values {rows}),
tw as (select license, license_class, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') ws from templates),
tg as (select distinct license, license_class, ws[i] a, ws[i + 1] b from (select license, license_class, ws, unnest(range(1, len(ws))) i from tw)),
n_tg as (select license, count(*) n from tg group by license),
met as (select u, license, license_class, count(*) c from own join tg using (a, b) group by all)
select doc_id, unit, unit_no::bigint unit_no, license, license_class, round(2.0::double * c / (n_own.n + n_tg.n), 6) dice
from met join n_own using (u) join n_tg using (license) join texts using (u) where 2.0::double * c / (n_own.n + n_tg.n) >= {licenses.MIN_DICE}::double"""


def _near() -> str:
    return f"""
with recursive w as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') ws from documents),
s as (select doc_id, array_to_string(ws[i:i + 4], ' ') g, count(*)::double x from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) i from w where len(ws) > 0) group by all),
n as (select doc_id, sum(x) n from s group by doc_id),
common as (select a.doc_id a, b.doc_id b, sum(a.x) ca, sum(b.x) cb from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
pairs as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 1 / (x.n / ca + y.n / cb - 1) >= {near_dedup.SIMILARITY}::double - 1e-9::double),
kinds as (select a, b, x, y, count(*)::double k from (
  select a, b, g, max(case when doc_id = a then x else 0 end) x, max(case when doc_id = b then x else 0 end) y from pairs join s on doc_id in (a, b) group by a, b, g) group by all),
links as (select a, b from (select i.a, i.b, i.k / sum(j.k * greatest(j.x / i.x, j.y / i.y)) part from kinds i join kinds j on i.a = j.a and i.b = j.b where i.x > 0 and i.y > 0 group by i.a, i.b, i.x, i.y, i.k)
  group by a, b having sum(part) >= {near_dedup.SIMILARITY}::double),
both_ways as (select a, b from links union all select b, a from links),
reach(node, root) as (select a, a from both_ways union select b, root from reach join both_ways on node = a where b > root),
least as (select node, min(root) root from reach group by node)
select doc_id, coalesce(root, doc_id) class_id from documents left join least on node = doc_id"""


def _lines() -> str:
    blank = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with d as (select row_number() over () r, doc_id, coalesce('=' || source, '~') h, text, string_split(text, chr(10)) ls from documents),
totals as (select h, count(*) pages from d group by h),
u as (select distinct r, h, trim(l, {blank}) l from (select r, h, unnest(ls) l from d) where trim(l, {blank}) <> ''),
boiler as (select h, l from (select h, l, count(*) n from u group by h, l) join totals using (h) where n > pages * {line_dedup.RATIO}::double and n >= {line_dedup.LEAST_PAGES}),
sets as (select h, list(l) bs from boiler group by h),
k as (select doc_id, text, ls, case when bs is null then ls else list_filter(ls, lambda x: not list_contains(bs, trim(x, {blank}))) end ks from d left join sets using (h))
select doc_id, coalesce(len(ls), 0)::bigint n_lines, coalesce(len(ls) - len(ks), 0)::bigint n_dropped, array_to_string(ks, chr(10)) text from k"""


def _words_repeats() -> str:
    return f"""
with w as (select row_number() over () r, doc_id, coalesce(doc_id, 9223372036854775807) did, regexp_extract_all(coalesce(text, ''), '{WORD}') ws from documents),
grams as (select r, did, p, sha256(array_to_string(ws[p:p + 49], ' ')) g from (select r, did, ws, unnest(range(1, len(ws) - 48)) p from w where len(ws) >= 50)),
dup as (select r, p from grams qualify min(did) over (partition by g) < did),
hit as (select distinct r, p + k q from dup, range(50) u(k)),
words as (select r, unnest(range(1, len(ws) + 1)) q, unnest(ws) x from w),
kept as (select r, count(hit.q) n_removed, string_agg(case when hit.q is null then x end, ' ' order by q) k from words left join hit using (r, q) group by r)
select doc_id, len(ws)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed, sha256(coalesce(k, '')) kept_sha256 from w left join kept using (r)"""


def _byte_repeats() -> str:
    return """
with w as (select row_number() over () r, doc_id, coalesce(doc_id, 9223372036854775807) did, hex(encode(coalesce(text, ''))) h from documents),
grams as (select r, did, p, substr(h, 2 * p + 1, 100) g from (select r, did, h, unnest(range(0, length(h) // 2 - 49)) p from w where length(h) >= 100)),
dup as (select r, p from grams qualify min(did) over (partition by g) < did),
runs as (select r, min(p) a, max(p) + 50 b from (select r, p, sum(new) over (partition by r order by p) island from (select r, p, case when p <= lag(p) over (partition by r order by p) + 50 then 0 else 1 end new from dup)) group by r, island),
gaps as (select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) before from runs),
kept as (select r, sum(b - a) n_removed, count(*) n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) k from gaps join w using (r) group by r)
select doc_id, (length(h) // 2)::bigint n_bytes, coalesce(n_removed, 0)::bigint n_removed, coalesce(n_spans, 0)::bigint n_spans, sha256(unhex(coalesce(k, h))) kept_sha256 from w left join kept using (r)"""


def _share(rows: str, parent: str, keys: str, budget: str, supply: str, weight: str, out: str) -> str:
    """SQL of one level of shares: children sorted by supply per weight fill up in turn."""
    by = f"partition by {parent}" if parent else ""
    order = f"{by} order by {supply} / {weight}, {keys}"
    return f"""(select * exclude (s_, w_, lv_, fin_), case when lv_ is null then {supply} else least({supply}, fin_ * {weight}) end {out} from (
  select *, min_by(lv_, s_) over ({by}) fin_ from (select *, case when {supply} > ({budget} - s_) / w_ * {weight} then ({budget} - s_) / w_ end lv_ from (
  select *, coalesce(sum({supply}) over ({order} rows between unbounded preceding and 1 preceding), 0) s_,
  sum({weight}) over ({order} rows between current row and unbounded following) w_ from {rows}))))"""


def _mix() -> str:
    case = lambda c, table, other: f"case {' '.join(f'when {c} = {chr(39)}{k}{chr(39)} then {w}::double' for k, w in table.items())} else {other}::double end"
    domains = _share("doms", "", "k_domain", "b_root", "s", "w_domain", "b_domain")
    langs = _share("(select l.*, b_domain from langs l join domains using (k_domain))", "k_domain", "k_domain, k_lang", "b_domain", "s", "w_lang", "b_lang")
    leaves = _share("(select f.*, b_lang from leaf f join langshares using (k_domain, k_lang))", "k_domain, k_lang", "k_domain, k_lang, k_source", "b_lang", "supply", "w_source", "allot")
    return f"""
with base as (select doc_id, lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) n, regexp_extract(coalesce(source, ''), '(\\d{{1,9}})$', 1) x,
  coalesce('=' || lang, '~') k_lang, coalesce('=' || source, '~') k_source from documents),
d as (select *, case when try_cast(x as int) < 5 then 'web' when try_cast(x as int) < 12 then 'books' else 'other' end k_domain from base where n > 0),
leaf as (select k_domain, k_lang, k_source, sum(n)::bigint tokens, sum(n)::double * {mixing.MAX_EPOCHS} supply, 1.0::double w_source, {case("k_domain", mixing.DOMAIN_WEIGHTS, 0)} w_domain,
  {case("substr(k_lang, 2)", mixing.LANG_WEIGHTS, mixing.OTHER_LANG_WEIGHT)} w_lang, floor(sum(sum(n)) over () * {mixing.BUDGET_SHARE}::double) b_root from d group by k_domain, k_lang, k_source),
doms as (select k_domain, sum(supply) s, max(w_domain) w_domain, max(b_root) b_root from leaf group by k_domain),
domains as {domains},
langs as (select k_domain, k_lang, sum(supply) s, max(w_lang) w_lang from leaf group by k_domain, k_lang),
langshares as {langs},
plan as (select k_domain, k_lang, k_source, (a // tokens)::int epochs, a % tokens rest from (select *, floor(allot + 1e-6)::bigint a from {leaves})),
o as (select *, md5('{mixing.SEED}:' || epochs || ':' || coalesce(doc_id::varchar, '')) o from d join plan using (k_domain, k_lang, k_source)),
r as (select *, sum(n) over (partition by k_domain, k_lang, k_source order by o, doc_id, n rows unbounded preceding) run from o)
select doc_id, lang, source, k_domain mix_domain, n::bigint mix_tokens, (epochs + case when run <= rest then 1 else 0 end)::bigint mix_copies from r where epochs + case when run <= rest then 1 else 0 end > 0"""


def _like(glob: str) -> str:
    """A glob as an anchored regular expression."""
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + "(?s:.*)", i + 2
            continue
        c = glob[i]
        out, i = out + ("[^/]*" if c == "*" else "[^/]" if c == "?" else "\\" + c if c in ".+()[]{}^$|\\" else c), i + 1
    return f"^{out}$"


def _urls() -> str:
    fits = lambda r: f"((host = '{r.split('/')[0]}' or host like '%.{r.split('/')[0]}') and starts_with(path, '/{r.split('/', 1)[1]}'))"
    sites = sorted(url_filter.SITE_RULES, key=lambda x: (-len(x[1]), x[1]))
    rule = "case " + " ".join(f"when {fits(r)} then '{r}'" for _, r in sites) + " end"
    site = "case " + " ".join(f"when {fits(r)} then '{v}'" for v, r in sites) + " end"
    glob = "case " + " ".join(f"when regexp_matches(host || path, '{_like(g)}') then '{v}'" for v, g in reversed(url_filter.GLOB_RULES)) + " else 'allow' end"
    return f"""
with c as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
h as (select page_id, regexp_extract(rest, '^[^/?#]*') raw, rest from c),
p as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') path from h)
select page_id, host, path, {rule} "rule", coalesce({site}, {glob}) verdict from p"""


def _vector_codes() -> str:
    p, e = vector_codes.PARTS, vector_codes.ENTRIES
    steps = []
    for r in range(vector_codes.ROUNDS + 1):  # nearest entry, ties to the lower one, then new entries
        steps.append(f"""near{r} as (select r, part, min(d * {e} + entry) % {e} entry, min(d * {e} + entry) // {e} d from (
  select r, part, entry, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - b[i]) * (x[i] - b[i]))) d from parts join book{r} using (part)) group by r, part)""")
        steps.append(f"""sums{r} as (select part, entry, i, sum(x[i]) s, count(*) n from (select part, entry, x, unnest(range(1, len(x) + 1)) i from near{r} join parts using (r, part)) group by all),
book{r + 1} as (select part, entry, coalesce(m, b) b from book{r} left join (select part, entry, list(((s - ((s % n) + n) % n) // n)::bigint order by i) m from sums{r} group by part, entry) using (part, entry))""")
    last = vector_codes.ROUNDS
    return f"""
with kept as (select row_number() over () r, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (select r, part, v[part * len(v) // {p} + 1:(part + 1) * len(v) // {p}] x from (select r, v, unnest(range({p})) part from kept)),
book0 as (select part, entry, x b from (select r, row_number() over (order by vec_id) - 1 entry from kept qualify entry < {e}) join parts using (r)),
{", ".join(steps)},
coded as (select r, string_agg(printf('%02x', entry::int), '' order by part) code, sum(d)::bigint error from near{last} group by r),
books as (select sha256(string_agg(array_to_string(b, ','), ',' order by part, entry)) h from book{last})
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, h codebooks_sha256 from coded join kept using (r), books"""


def _hard_negatives() -> str:
    h = hard_negatives
    return f"""
with rows_ as (select vec_id id, case when vec_id % {h.NOISY_STEP} = 0 then (label + 1) % {h.LABELS} else label end label, list_transform(embedding, lambda x: floor(256 * x::double)) v
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
met as (select a.id a, b.id b, a.label = b.label same, list_inner_product(a.v, b.v)::bigint s from rows_ a join rows_ b on a.id % {h.ANCHOR_STEP} = 0 and a.id <> b.id),
pos as (select a, b p, s ps from met where same qualify row_number() over (partition by a order by s desc, b) <= {h.POSITIVES})
select a anchor_id, p positive_id, (row_number() over (partition by a, p order by s desc, b))::int "rank", b negative_id, ps positive_score, s negative_score
from pos join met using (a) where not same and {h.LEAST_SHARE} * ps <= 100 * s and 100 * s <= {h.MOST_SHARE} * ps
qualify row_number() over (partition by a, p order by s desc, b) <= {h.NEGATIVES}"""


ORACLES: dict[str, str] = {
    "op2_quality_rules": _quality(),
    "op3_license_scan": _licenses(),
    "op5_probminhash_near_dedup": _near(),
    "op6_line_dedup": _lines(),
    "op7_relative_lempel_ziv_dedup": _words_repeats(),
    "op8_suffix_array_dedup": _byte_repeats(),
    "op9_source_mixing": _mix(),
    "op10_url_filter": _urls(),
    "op11_vector_dictionary_codes": _vector_codes(),
    "op13_hilbert_hard_negatives": _hard_negatives(),
}
