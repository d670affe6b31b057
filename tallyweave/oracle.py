"""The core queries as SQL for DuckDB, written independently of the plans they check."""

from __future__ import annotations

from tallyweave.functions import vocabulary as V
from tallyweave.operators.quality import STATES

_ASCII = "".join(map(chr, range(0x21, 0x7F)))
_WIDE = "".join(chr(ord(c) + 0xFEE0) for c in _ASCII)
_SPARE = "".join(c for c in map(chr, [*range(1, 32), *range(0x21, 0x7F)]) if not c.islower() and not c.isdigit() and c != "_")
_BLANKS = "            　"
_OTHER = {"‑": "‐", "ϲ": "ς", "Ϲ": "Σ"}
_LONGER = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "№": "No", "Ⅰ": "I", "Ⅱ": "II", "Ⅲ": "III", "Ⅳ": "IV", "ⅰ": "i", "ⅱ": "ii", "ⅲ": "iii", "ⅳ": "iv"}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def compatible(c: str) -> str:
    """Compatibility form of the characters these tables can hold."""
    out = f"translate({c}, {quoted(_WIDE + _BLANKS + ''.join(_OTHER))}, {quoted(_ASCII + ' ' * len(_BLANKS) + ''.join(_OTHER.values()))})"
    for a, b in _LONGER.items():
        out = f"replace({out}, '{a}', '{b}')"
    # A small sigma at the end of a word has a form of its own.
    return rf"regexp_replace(lower(nfc_normalize({out})), '(\p{{L}})σ($|[^\p{{L}}])', '\1ς\2', 'g')"


def words_only(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(replace({c}, '&', ' and '), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def clean(c: str) -> str:
    return rf"coalesce(regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), '')"


def _case(values: dict[str, str], c: str, other: str) -> str:
    return f"case {c} " + " ".join(f"when {quoted(k)} then {quoted(v)}" for k, v in values.items()) + f" else {other} end"


# Words are set apart by doubled blanks so that neighbouring legal forms are both found.
_FORMS = V.LEGAL_FORMS.replace(" ", "  ")
_SPREAD = "' ' || replace(name_norm, ' ', '  ') || ' '"

def _form(c: str) -> str:
    return f"regexp_extract(' ' || replace({c}, ' ', '  ') || ' ', ' ({_FORMS}) ', 1)"


NORMAL = rf"""
raw as materialized (
  select distinct 1 side, {clean('entity_id')} entity_id, {clean('business_name')} business_name, {clean('business_address')} business_address, {clean('country')} country from train_source1
  union all select distinct 2, {clean('entity_id')}, {clean('business_name')}, {clean('business_address')}, {clean('country')} from train_source2
  union all select distinct 2, {clean('entity_id')}, {clean('business_name')}, {clean('business_address')}, {clean('country')} from train_source3),
n1 as (select *, {words_only(compatible('business_name'))} name_norm, {words_only(compatible('business_address'))} addr from raw),
n2 as (select *, trim(regexp_replace(regexp_replace({_SPREAD}, ' ({_FORMS}) ', ' ', 'g'), '\s+', ' ', 'g')) name_core,
  regexp_replace(regexp_extract({_SPREAD}, ' ({_FORMS}) ', 1), '\s+', ' ', 'g') form,
  array_to_string(list_transform(string_split(addr, ' '), lambda t: {_case(V.ADDRESS_WORDS, 't', 't')}), ' ') address_norm from n1),
nrm as materialized (select side, entity_id, business_name, business_address, name_norm, name_core, address_norm, upper(country) country_norm,
  (length(business_name) > 0)::int has_name, (length(business_address) > 0)::int has_address,
  array_to_string(list_sort(string_split(name_norm, ' ')), ' ') name_sorted, array_to_string(list_sort(string_split(name_core, ' ')), ' ') core_sorted,
  {_case(V.SHORT_FORMS, 'form', "''")} legal_suffix,
  regexp_extract(address_norm, '\b(\d{{5,6}})\b', 1) pincode, regexp_extract(address_norm, '\b(\d+[a-z]?)\b', 1) street_num,
  regexp_matches(address_norm, '\b({'|'.join(V.LANDMARKS)})\b')::int has_landmark, string_split(address_norm, ' ')[1] addr_token1,
  length(name_norm)::int name_len, (case when name_norm = '' then 0 else len(string_split(name_norm, ' ')) end)::int name_ntoken,
  (length(regexp_extract(address_norm, '\b(\d{{5,6}})\b', 1)) > 0)::int has_pincode from n2)"""

# Labels of equal letters are one country; two or three letters stand for the one longer label that nearly all rows of such labels have.
COUNTRIES = r"""
labels as (select country_norm, case when x in ('na', 'none', 'null', 'unknown') then '' else x end own, n from (select country_norm, lower(regexp_replace(country_norm, '[^\p{L}]', '', 'g')) x, count(*) n from nrm group by all)),
longer as (select own as whole, sum(n) n from labels where own <> '' group by own),
begun as (select whole, n, left(whole, 2) short from longer where length(whole) > 2 union select whole, n, left(whole, 3) from longer where length(whole) > 3),
step as (select short, whole from (select *, sum(n) over (partition by short) total, row_number() over (partition by short order by n desc, whole) k from begun) where k = 1 and n >= 0.9 * total),
ckeys as (select country_norm, coalesce(b.whole, a.whole, own) country_key from labels left join step a on a.short = own left join step b on b.short = a.whole),
rec as materialized (select nrm.*, country_key from nrm join ckeys using (country_norm))"""

SCORED = """
items as (
  select source1_entity_id s1_id, trim(unnest(string_split(candidate_entity_ids, ','))) cand_id,
    unnest(list_resize(candidate_scores, greatest(len(candidate_scores), len(string_split(candidate_entity_ids, ','))))) score
  from candidate_pairs where candidate_entity_ids is not null and candidate_scores is not null),
scored as (select s1_id, cand_id, max(score) score from items where score is not null and regexp_matches(cand_id, '^S[23]-') group by all)"""

TRUTH = """
truth as (select source1_entity_id s1_id, list_distinct(list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> '')) targets from train_matches),
wanted as (select distinct s1_id, unnest(targets) cand_id from truth)"""

def _grams(c: str) -> str:
    return f"list_distinct(list_transform(generate_series(1, length({c}) - 2), lambda i: substr({c}, i::int, 3)))"


GRAMS = f"""
grams as materialized (select side, entity_id, case when length(name_norm) < 3 then [] else {_grams('name_norm')} end ng, case when length(address_norm) < 3 then [] else {_grams('address_norm')} end ag from nrm),
close as (select s1_id, cand_id, len(list_intersect(a.ng, b.ng)) nc, len(a.ng) + len(b.ng) nb, len(list_intersect(a.ag, b.ag)) ac, len(a.ag) + len(b.ag) ab
  from scored join grams a on a.side = 1 and a.entity_id = s1_id join grams b on b.side = 2 and b.entity_id = cand_id),
char3 as (select s1_id, cand_id, coalesce(nc / nullif(nb - nc, 0), 0.0) name_char3, coalesce(ac / nullif(ab - ac, 0), 0.0) addr_char3 from close)"""
_COLUMNS = ("name_norm", "name_core", "name_sorted", "core_sorted", "address_norm", "addr_token1", "pincode", "street_num", "legal_suffix", "country_norm", "has_pincode", "has_address", "has_landmark", "name_len", "name_ntoken")
PAIRS = f"""
pairs as (select s1_id, cand_id, {', '.join(f'a.{c} {c}_1, b.{c} {c}_2' for c in _COLUMNS)}
  from scored join (select * from nrm where side = 1) a on a.entity_id = s1_id join (select * from nrm where side = 2) b on b.entity_id = cand_id)"""


def _words(c: str) -> str:
    return f"list_filter(string_split({c}, ' '), lambda t: t <> '')"


def _jaccard(a: str, b: str) -> str:
    return f"coalesce(len(list_intersect({a}, {b}))::double / nullif(len(list_distinct(list_concat({a}, {b}))), 0), 0.0)"


def token_jaccard(c: str) -> str:
    return _jaccard(_words(f"{c}_1"), _words(f"{c}_2"))


def _ratio(x: str, y: str) -> str:
    return f"case when {x} = 0 and {y} = 0 then 1.0 else coalesce(least({x}, {y})::double / nullif(greatest({x}, {y}), 0), 0.0) end"


SETS = f"{token_jaccard('name_norm')} name_set, {token_jaccard('name_core')} core_set, {token_jaccard('address_norm')} addr_set"
STRUCTURED = """
(addr_token1_1 <> '' and addr_token1_1 = addr_token1_2)::int addr_token_match, (country_norm_1 = country_norm_2)::int country_match, (country_norm_1 <> country_norm_2)::int country_mismatch,
(has_pincode_1 = 1 and pincode_1 = pincode_2)::int pincode_exact_match, (has_pincode_1 = 1 and has_pincode_2 = 1 and left(pincode_1, 3) = left(pincode_2, 3))::int pincode_prefix_match,
(has_pincode_1 = 1 and has_pincode_2 = 1)::int both_has_pincode, (has_pincode_1 <> has_pincode_2)::int one_missing_pincode, (street_num_1 <> '' and street_num_1 = street_num_2)::int street_num_match,
(legal_suffix_1 <> '' and legal_suffix_1 = legal_suffix_2)::int suffix_match, (legal_suffix_1 <> '' and legal_suffix_2 <> '' and legal_suffix_1 <> legal_suffix_2)::int suffix_mismatch,
(has_address_1 = 1 and has_address_2 = 1)::int both_has_address, has_landmark_1 has_landmark_s1, has_landmark_2 has_landmark_s23"""

DIGEST = "('0x' || substr(md5({0}), 1, 6))::bigint"
KEYS = """
met as (select *, unnest(case when side = 2 then [case when country_key = '' then '?' else country_key end, '*'] when country_key = '' then ['*'] else [country_key, '?'] end) country from rec),
keys as (select side, entity_id, country, unnest(list_distinct(list_concat(
  case when pincode <> '' then [{'key_type': 'pincode', 'key': pincode}] else [] end,
  case when length(name_core) >= 3 then [{'key_type': 'prefix4', 'key': left(name_core, 4)}] else [] end,
  case when length(name_core) >= 6 then [{'key_type': 'prefix6', 'key': left(name_core, 6)}] else [] end,
  list_transform(list_filter(string_split(name_core, ' '), lambda t: length(t) >= 4)[1:4], lambda t: {'key_type': 'token', 'key': t}),
  case when name_core <> '' then [{'key_type': 'bigram', 'key': array_to_string(string_split(name_core, ' ')[1:2], '_')}] else [] end,
  case when length(addr_token1) >= 3 then [{'key_type': 'addr_token', 'key': addr_token1}] else [] end,
  case when length(pincode) >= 3 then [{'key_type': 'pin_prefix', 'key': left(pincode, 3)}] else [] end)), recursive := true) from met),
placed as (select country, key_type, key, entity_id cand_id, row_number() over (partition by country, key_type, key order by md5(entity_id), entity_id) - 1 as pos,
  count(*) over (partition by country, key_type, key) n from keys where side = 2),
capped as (select l.entity_id s1_id, p.cand_id, p.key_type, p.key from keys l join placed p using (country, key_type, key)
  where l.side = 1 and (p.pos - """ + DIGEST.format("l.entity_id") + """ % p.n + p.n) % p.n < 75)"""
RULES = """
ruled as (select s1_id, cand_id from (select s1_id, cand_id, row_number() over (partition by s1_id order by n desc, md5(s1_id || cand_id), cand_id) k from (select s1_id, cand_id, count(*) n from capped group by all)) where k <= 200)"""

CHAR_TERMS = """list_concat({parts})"""


def _char_grams(n: int, tag: bool = True) -> str:
    label = f"'{n}:' || " if tag else ""
    word = f"list_transform(generate_series(1, greatest(length(t) + 2 - {n - 1}, 1)), lambda i: {label}substr(' ' || t || ' ', i::int, {n}))"
    return f"flatten(list_transform({_words('text')}, lambda t: {word}))"


_LONG_WORDS = f"list_filter({_words('text')}, lambda t: length(t) >= 2)"
_WORD_GRAMS = f"list_concat({_LONG_WORDS}, list_transform(generate_series(1, len({_LONG_WORDS}) - 1), lambda i: {_LONG_WORDS}[i] || ' ' || {_LONG_WORDS}[i + 1]))"


def _weights(name: str, terms: str, cap: int) -> str:
    return f"""
{name}_tf as (select country, side, entity_id, term, count(*) tf from (select country, side, entity_id, unnest({terms}) term from reps) group by all),
{name}_df as (select * from (select *, row_number() over (partition by country order by total desc, term) k from (select country, term, count(*) df, sum(tf) total from {name}_tf group by all)) where k <= {cap}),
{name}_raw as (select country, side, entity_id, term, df, (1 + ln(tf)) * (ln((1.0 + n) / (1.0 + df)) + 1) w from {name}_tf join {name}_df using (country, term) join sizes using (country)),
{name} as (select *, w / sqrt(sum(w * w) over (partition by side, entity_id)) u from {name}_raw),
{name}_hit as (select a.entity_id s1_id, b.entity_id cand_id, a.u * b.u p from {name} a join {name} b using (country, term) where a.side = 1 and b.side = 2)"""


REPS = """
reps as (select side, entity_id, country_key country, trim(concat_ws(' ', name_norm, name_norm, address_norm)) as text from rec),
sizes as (select country, count(*) n from reps group by all)"""

TFIDF = f"""{_weights('cg', f"list_concat({_char_grams(2)}, {_char_grams(3)})", 200_000)[1:]},{_weights('wg', _WORD_GRAMS, 100_000)},
sums as (select s1_id, cand_id, round(sum(p), 9) score from (select * from cg_hit union all select * from wg_hit) group by all),
top as (select *, row_number() over (partition by s1_id order by score desc, cand_id) as rank from sums where score > 0)"""
HYBRID = "hybrid as (select s1_id, cand_id from ruled union select s1_id, cand_id from top where rank <= 20)"

GRID = "grid as (select k, case when k = 70 then 0.95 else 0.25 + k * ((0.95::double - 0.25) / 70) end t from range(71) g(k))"
F05 = "case when n_pred = 0 and n_true = 0 then 1.0 when n_pred = 0 or n_true = 0 or n_hit = 0 then 0.0 else 1.25 * (n_hit / n_pred) * (n_hit / n_true) / (0.25 * (n_hit / n_pred) + n_hit / n_true) end"
ASSIGNED = "assigned as (select * from (select *, row_number() over (partition by cand_id order by score desc, s1_id) k from scored where score >= 0.5) where k = 1)"
SCORES = f"""
counts as (select t.s1_id, len(t.targets)::double n_true, count(a.cand_id)::double n_pred, count(w.cand_id)::double n_hit
  from truth t left join assigned a on a.s1_id = t.s1_id left join wanted w on w.s1_id = a.s1_id and w.cand_id = a.cand_id group by t.s1_id, t.targets),
f05s as (select *, {F05} f05 from counts)"""
CURVE = f"""
at_t as (select g.k, g.t, t.s1_id, len(t.targets)::double n_true, count(s.cand_id)::double n_pred, count(w.cand_id)::double n_hit
  from grid g cross join truth t left join scored s on s.s1_id = t.s1_id and s.score >= g.t left join wanted w on w.s1_id = s.s1_id and w.cand_id = s.cand_id group by g.k, g.t, t.s1_id, t.targets),
curve as (select k, t, avg({F05}) f from at_t group by all)"""
LABELLED = """
every as (select s1_id, cand_id from scored where s1_id in (select s1_id from truth) union select s1_id, cand_id from wanted),
labelled as (select e.s1_id, e.cand_id, (w.cand_id is not null)::int as label from every e left join wanted w using (s1_id, cand_id)),
ranked as (select *, sum(label) over (partition by s1_id) p, row_number() over (partition by s1_id, label order by md5(s1_id || cand_id || '|42'), cand_id) k from labelled),
training as (select s1_id, cand_id, label from ranked where label = 1 or k <= case when p > 0 then floor(p * 10.0) else 5 end)"""
LINES = """
line as (select source1_entity_id s1_id, candidate_entity_ids is not null ok, case when trim(candidate_entity_ids) = '' then [] else string_split(candidate_entity_ids, ',') end ids from candidate_pairs),
good as (select * from line where ok),
ids as (select s1_id, unnest(ids) id from good),
broken as (
  select 'malformed_line' as rule, s1_id offender from line where not ok
  union select 'repeated_record', s1_id from good group by s1_id having count(*) > 1
  union select 'repeated_id', s1_id from good where len(ids) <> len(list_distinct(ids))
  union select 'source1_id', id from ids where starts_with(id, 'S1-')
  union select 'wrong_prefix', id from ids where not starts_with(id, 'S1-') and not regexp_matches(id, '^S[23]-')
  union select 'missing_record', entity_id from train_source1 where entity_id not in (select s1_id from good)
  union select 'extra_record', s1_id from good where s1_id not in (select entity_id from train_source1)
  union select 'unknown_id', id from ids where regexp_matches(id, '^S[23]-') and id not in (select entity_id from train_source2 union all select entity_id from train_source3))"""


def _rewritten() -> str:
    out = "name_core_2"
    steps = []
    for k, (a, b, _) in enumerate(V.VARIANTS):
        steps.append(f"v{k} as (select s1_id, cand_id, name_core_1, case when contains(name_core_1, '{a}') and contains({out}, '{b}') then replace({out}, '{b}', '{a}') else {out} end z{k} from {'v' + str(k - 1) if k else 'indian'})")
        out = f"z{k}"
    return ",\n".join(steps)


def _least(k: int, grams: str) -> str:
    return f"list_min(list_transform({grams}, lambda x: left(md5('{k}:' || x), 8)))"


ALL_NAMES = rf"""
texts as materialized (select {words_only(compatible('business_name'))} txt from (""" + " union all ".join(f"select distinct {', '.join(clean(c) + ' ' + c for c in ('entity_id', 'business_name', 'business_address', 'country'))} from {x}" for x in ("train_source1", "train_source2", "train_source3", "test_source1", "test_source2")) + rf""")),
words as (select unnest(list_distinct({_words('txt')})) token from texts),
idf as materialized (select token, count(*) df, ln(((select count(*) from texts) + 1.0) / (count(*) + 1.0)) + 1 idf from words group by token)"""
# Weight of the common words over that of all words of two texts, by pair and text.
WEIGHED = """
long as (""" + " union all ".join(f"select '{c}' c, s1_id, cand_id, side, unnest(list_distinct({_words('txt')})) token from (select s1_id, cand_id, 1 side, {c}_1 txt from pairs union all select s1_id, cand_id, 2, {c}_2 from pairs)" for c in ("name_norm", "name_core", "address_norm")) + """),
per as (select c, s1_id, cand_id, token, count(*) sides, coalesce(any_value(idf), ln((select count(*) from texts) + 1.0) + 1) v from long left join idf using (token) group by all),
shares as (select c, s1_id, cand_id, case when max(sides) = 2 then sum(case when sides = 2 then v else 0 end) / sum(v) else 0 end j from per group by all)"""


REACHED = """
linked as (select s1_id u, cand_id v from wanted union select cand_id, s1_id from wanted union select s1_id, s1_id from truth union select cand_id, cand_id from wanted),
reach as (with recursive walk(node, reached) as (select u, v from linked union select w.node, l.v from walk w join linked l on l.u = w.reached) select * from walk)"""


def _landmarks(c: str) -> str:
    found = rf"regexp_extract_all({c}, '\b(?:{'|'.join(V.LANDMARKS)}) ([\p{{L}}\p{{N}}_]+(?: [\p{{L}}\p{{N}}_]+)?)', 1)"
    return f"list_distinct(flatten(list_transform({found}, lambda t: string_split(t, ' '))))"


def _recall(pairs: str) -> str:
    return f"""select round(case when count(w.cand_id) = 0 then 1.0 else count(r.cand_id)::double / count(w.cand_id) end, 6) recall, count(r.cand_id) captured, count(w.cand_id) total_true,
  (select round(count(*)::double / (select count(distinct s1_id) from truth), 6) from {pairs} where s1_id in (select s1_id from truth)) avg_candidates from wanted w left join {pairs} r using (s1_id, cand_id)"""


def _keyed(rows: str) -> str:
    """Pairs of records ``met`` with one further key, a run of 75 of each block."""
    return f"""k as (select * from ({rows}) where key <> ''),
  r as (select *, row_number() over (partition by country, key order by md5(entity_id), entity_id) - 1 as pos, count(*) over (partition by country, key) n from k where side = 2)
  select distinct l.entity_id s1_id, r.entity_id cand_id from k l join r using (country, key) where l.side = 1 and (r.pos - {DIGEST.format('l.entity_id')} % r.n + r.n) % r.n < 75"""


def _soundex(t: str) -> str:
    """Four-letter sound of a word: letters of one code in a row, or with H and W between, count once; others part them."""
    codes = f"translate(regexp_replace(upper({t}), '[^A-Z]', '0', 'g'), 'AEIOUYBFPVCGJKQSXZDTLMNRHW', '00000011112222222233455677')"
    out = f"replace({codes}, '7', '')"
    for digit in "123456":
        out = f"regexp_replace({out}, '{digit}+', '{digit}', 'g')"
    first = f"upper({t})[1]"
    rest = f"replace(case when {first} in ('H', 'W') then {out} else {out}[2:] end, '0', '')"
    return f"case when regexp_matches({first}, '[A-Z]') then left({first} || {rest} || '000', 4) else {t} end"


def statements() -> dict[str, str]:
    n, s, t, c = NORMAL, SCORED, TRUTH, COUNTRIES
    w = lambda *parts: "with " + ",".join(parts)
    indian = _case(V.INDIAN_WORDS, "t", "t")
    out = {
        "normalize_names": f"{w(n)} select entity_id, has_name, name_norm, name_sorted, legal_suffix, name_core, core_sorted, name_len, name_ntoken from nrm",
        "normalize_addresses": f"{w(n)} select entity_id, has_address, address_norm, pincode, has_pincode, street_num, has_landmark, addr_token1, country_norm from nrm",
        "normalize_addresses_indian": f"{w(n)} select entity_id, array_to_string(list_transform(string_split(address_norm, ' '), lambda t: {indian}), ' ') address_norm from nrm",
        "retrieval_text": f"{w(n, c, REPS)} select entity_id, text as text_rep from reps",
        "parsed_truth": f"{w(t)} select s1_id, len(targets)::int n_targets, array_to_string(list_sort(targets), ',') targets from truth",
        "block_union_capped": f"{w(n, c, KEYS, RULES)} select * from ruled",
        "candidate_lists": f"{w(n, c, KEYS, RULES)} select entity_id source1_entity_id, coalesce(string_agg(cand_id, ',' order by cand_id), '') candidate_entity_ids from (select distinct entity_id from nrm where side = 1) left join ruled on s1_id = entity_id group by entity_id",
        "hybrid_candidates": f"{w(n, c, KEYS, RULES, REPS, TFIDF, HYBRID)} select * from hybrid",
        "blocking_recall": f"{w(n, c, KEYS, RULES, t)} {_recall('ruled')}",
        "hybrid_recall": f"{w(n, c, KEYS, RULES, REPS, TFIDF, HYBRID, t)} {_recall('hybrid')}",
        "reduction_ratio": f"{w(n, c, KEYS, RULES)} select count(*) pairs, round(1 - count(*)::double / ((select count(*) from nrm where side = 1) * (select count(*) from nrm where side = 2)), 8) reduction_ratio from ruled",
        "fn_mining": f"""{w(n, s, t)} select a.name_core = b.name_core same_core, a.pincode = b.pincode and a.pincode <> '' same_pincode, a.country_norm = b.country_norm same_country, a.has_address = 1 and b.has_address = 1 both_addresses, count(*) missed
  from wanted w join nrm a on a.side = 1 and a.entity_id = s1_id join nrm b on b.side = 2 and b.entity_id = cand_id where (s1_id, cand_id) not in (select (s1_id, cand_id) from scored) group by all""",
        "tfidf_top20": f"{w(n, c, REPS, TFIDF)} select s1_id, cand_id, round(score, 6) score, rank from top where rank <= 20",
        "bm25_top20": f"""{w(n, c, REPS)}, g as (select country, side, entity_id, unnest({_char_grams(3)}) term from reps),
  d as (select country, entity_id, term, count(*) tf from g where side = 2 group by all), l as (select country, entity_id, sum(tf) len from d group by all), st as (select country, count(*) n, avg(len) avg_len from l group by all),
  df as (select country, term, count(*) df from d group by all),
  ix as (select d.country, term, entity_id cand_id, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len)) w from d join df using (country, term) join l using (country, entity_id) join st using (country)),
  sums as (select s1_id, cand_id, round(sum(w), 9) score from (select distinct country, term, entity_id s1_id from g where side = 1) a join ix using (country, term) group by all),
  top as (select *, row_number() over (partition by s1_id order by score desc, cand_id) as rank from sums where score > 0) select s1_id, cand_id, round(score, 6) score, rank from top where rank <= 20""",
        "minhash_candidates": f"""{w(n)}, g as (select side, entity_id, {_grams('name_norm')} g from nrm where length(name_norm) >= 3),
  {_keyed(f"select side, entity_id, '' country, unnest([{', '.join(f"'{b}:' || " + ' || '.join(_least(b * 2 + r, 'g') for r in range(2)) for b in range(6))}]) as key from g")}""",
        "block_place": rf"""{w(n, c, KEYS)}, {_keyed(rf"select side, entity_id, country, list_filter({_words('address_norm')}, lambda t: not regexp_matches(t, '\d'))[-1] as key from met")}""",
        "block_sound": f"""{w(n, c, KEYS)}, {_keyed(f"select side, entity_id, country, array_to_string(list_transform(list_sort({_words('name_core')}), lambda t: {_soundex('t')}), ' ') as key from met")}""",
        "tfidf_cosine_pairs": f"""{w(n, s, c, REPS, _weights('wg', _WORD_GRAMS, 1_000_000_000))}, c as (select s1_id, cand_id, sum(a.u * b.u) v from scored join wg a on a.side = 1 and a.entity_id = s1_id join wg b on b.side = 2 and b.entity_id = cand_id and b.term = a.term and b.country = a.country group by all)
  select s1_id, cand_id, round(coalesce(v, 0), 6) cosine from scored left join c using (s1_id, cand_id)""",
        "record_flags": rf"""{w(n)} select entity_id, (regexp_matches(business_name, '\p{{Cc}}') or regexp_matches(business_address, '\p{{Cc}}'))::int has_control,
  (regexp_matches(name_norm, '\b\d{{5,6}}\b') and not regexp_matches(address_norm, '\d'))::int fields_swapped, list_has_any(string_split(address_norm, ' '), {STATES.split()!r})::int has_state,
  (street_num <> '')::int has_street_number, (length(name_core) < 3)::int low_information from nrm""",
        "raw_suffix_pairs": f"""{w(n, s, PAIRS)}, f as (select s1_id, cand_id, {_form('name_norm_1')} x, {_form('name_norm_2')} y from pairs) select s1_id, cand_id, (x <> '' and x = y)::int raw_suffix_agreement from f""",
        "idf_table": f"{w(ALL_NAMES)} select token, df, round(idf, 6) idf from idf",
        "token_jaccard_pairs": f"{w(n, s, PAIRS)}, x as (select s1_id, cand_id, {SETS} from pairs) select s1_id, cand_id, round(name_set, 6) name_set, round(core_set, 6) core_set, round(addr_set, 6) addr_set from x",
        "char3_jaccard_pairs": f"{w(n, s, GRAMS)} select s1_id, cand_id, round(name_char3, 6) name_char3, round(addr_char3, 6) addr_char3 from char3",
        "len_ratios": f"""{w(n, s, PAIRS)} select s1_id, cand_id, round({_ratio('length(name_norm_1)', 'length(name_norm_2)')}, 6) name_len_ratio, round({_ratio('length(name_core_1)', 'length(name_core_2)')}, 6) core_len_ratio,
  round((2 * greatest(least(name_ntoken_1, name_ntoken_2), 1) - 1)::double / (2 * greatest(name_ntoken_1, name_ntoken_2, 1) - 1), 6) name_ntoken_ratio from pairs""",
        "structured_pair_features": f"{w(n, s, PAIRS)} select s1_id, cand_id, {STRUCTURED} from pairs",
        "landmark_pairs": rf"""{w(n, s, PAIRS)}, x as (select s1_id, cand_id, {_landmarks('address_norm_1')} a, {_landmarks('address_norm_2')} b from pairs)
  select s1_id, cand_id, round({_jaccard('a', 'b')} * (len(a) > 0 and len(b) > 0)::int, 6) landmark_overlap from x""",
        "interaction_flags": f"""{w(n, s, PAIRS, GRAMS, ALL_NAMES, WEIGHED)}, x as (select p.*, {SETS}, name_char3, addr_char3, coalesce(j, 0) name_idf, {STRUCTURED} from pairs p join char3 using (s1_id, cand_id)
    left join shares h on h.c = 'name_norm' and h.s1_id = p.s1_id and h.cand_id = p.cand_id)
  select s1_id, cand_id, round(name_set * addr_set, 6) name_addr_prod, round(name_idf * addr_set, 6) name_idf_addr_prod, round(name_set * country_match, 6) name_country_prod, round(name_set * both_has_pincode, 6) name_has_pincode_prod, round(name_char3 * addr_char3, 6) name_addr_char_prod,
  (name_set > 0.8 and both_has_pincode = 1 and pincode_exact_match = 0)::int high_name_pin_mismatch, (name_set > 0.7 and addr_set < 0.2)::int name_match_addr_mismatch, (addr_set > 0.8 and name_set < 0.2)::int same_address_other_name,
  (len(list_intersect(regexp_extract_all(name_norm_1, '(\\d+)', 1), regexp_extract_all(name_norm_2, '(\\d+)', 1))) > 0)::int same_branch_number, (length(name_core_1) < 3 or length(name_core_2) < 3)::int low_information_name from x""",
        # The engine compares bytes, so letters beyond ASCII are put in the place of capitals and signs, which normalized names don't have.
        "jaro_winkler_pairs": f"""{w(n, s, PAIRS)}, odd as (select coalesce(string_agg(distinct ch, '' order by ch), '') o from (select unnest(string_split(name_norm, '')) ch from nrm) where unicode(ch) > 126),
  x as (select s1_id, cand_id, translate(name_norm_1, o, {quoted(_SPARE)}) a, translate(name_norm_2, o, {quoted(_SPARE)}) b from pairs cross join odd)
  select s1_id, cand_id, round(case when a = '' or b = '' then 0.0 else jaro_winkler_similarity(a, b) end, 6) jaro_winkler from x""",
        "seed_averaged_f05": f"""{w(s, t, ASSIGNED, SCORES)}, each as (select seed, count(*) records, avg(f05) f from f05s cross join (values ('42'), ('43'), ('44')) v(seed) where {DIGEST.format("s1_id || '|' || seed")} / 16777216 < 0.2 group by seed)
  select seed, records, round(f, 6) macro_f05 from each union all select 'mean', sum(records)::bigint, round(avg(f), 6) from each""",
        "cluster_split": f"{w(t)}, {REACHED} select s1_id, component, {DIGEST.format(chr(99) + 'omponent || ' + quoted('|42'))} / 16777216 < 0.2 is_val from (select node s1_id, min(reached) component from reach group by node) where s1_id in (select s1_id from truth)",
        "weighted_jaccard_pairs": f"""{w(n, s, PAIRS, ALL_NAMES, WEIGHED)}
  select p.s1_id, p.cand_id, round(coalesce(a.j, 0), 6) name_idf_jaccard, round(coalesce(b.j, 0), 6) core_idf, round(coalesce(d.j, 0), 6) addr_idf_jaccard from pairs p
  left join shares a on a.c = 'name_norm' and a.s1_id = p.s1_id and a.cand_id = p.cand_id left join shares b on b.c = 'name_core' and b.s1_id = p.s1_id and b.cand_id = p.cand_id left join shares d on d.c = 'address_norm' and d.s1_id = p.s1_id and d.cand_id = p.cand_id""",
        "rank_window_features": f"""{w(s)}, x as (select *, rank() over (partition by s1_id order by score desc) r, max(score) over (partition by s1_id) hi, min(score) over (partition by s1_id) lo, avg(score) over (partition by s1_id) av, count(*) over (partition by s1_id) c from scored)
  select s1_id, cand_id, r cand_rank, c cand_count_for_s1, round(hi, 6) max_sim_for_s1, round(lo, 6) min_sim_for_s1, round(av, 6) mean_sim_for_s1, round(hi - score, 6) sim_gap_to_best, round(r / c, 6) sim_percentile, round((hi - score) / (hi - lo + 1e-8), 6) sim_gap_norm from x""",
        "gap_to_second": f"""{w(s)}, x as (select *, nth_value(score, 2) over w2 s2, first(score) over w2 s1 from scored window w2 as (partition by s1_id order by score desc, cand_id rows between unbounded preceding and unbounded following))
  select s1_id, cand_id, round(s2, 6) second_best, round(s1 - s2, 6) lead_of_best from x""",
        "translit_rewrite": f"{w(n, s, PAIRS)}, indian as (select * from pairs where country_norm_1 = 'INDIA' or country_norm_2 = 'INDIA'),\n{_rewritten()} select s1_id, cand_id, z{len(V.VARIANTS) - 1} as rewritten from v{len(V.VARIANTS) - 1}",
        "translit_pattern_counts": f"""{w(n, t)}, p as (select a.name_norm x, b.name_norm y from wanted join nrm a on a.side = 1 and a.entity_id = s1_id and a.country_norm = 'INDIA' join nrm b on b.side = 2 and b.entity_id = cand_id where a.name_norm <> b.name_norm and a.name_norm <> '' and b.name_norm <> ''),
  v(a, b) as (values {', '.join(f"('{a}', '{b}')" for a, b, _ in V.VARIANTS)}) select a, b, count(x) n from v left join p on contains(x, a) and contains(y, b) group by all""",
        "greedy_assignment": f"{w(s, ASSIGNED)} select s1_id, cand_id, score from assigned",
        "confidence_propagation": f"""{w(s)}, k as (select *, row_number() over (partition by cand_id order by score desc, s1_id) as pos from scored where score >= 0.5), l as (select *, sum((pos > 1)::int) over (partition by s1_id) losses from k)
  select s1_id, cand_id, score, losses::bigint losses from l where pos = 1 and score >= 0.5::double + case when losses > 0 then 0.05::double else 0 end""",
        "matching_lists": f"{w(s, ASSIGNED)} select entity_id source1_entity_id, coalesce(string_agg(cand_id, ',' order by cand_id), '') matched_entity_ids from (select distinct {clean('entity_id')} entity_id from train_source1) left join assigned on s1_id = entity_id group by entity_id",
        "match_counts": f"{w(s, ASSIGNED)} select count(*) filter (n > 0) matched, count(*) filter (n = 0) single from (select entity_id, count(cand_id) n from (select distinct entity_id from train_source1) left join assigned on s1_id = entity_id group by entity_id)",
        "entity_f05": f"{w(s, t, ASSIGNED, SCORES)} select s1_id, n_pred::bigint n_pred, n_true::int n_true, n_hit::bigint n_hit, round(f05, 6) f05 from f05s",
        "macro_f05": f"{w(s, t, ASSIGNED, SCORES)} select round(coalesce(avg(f05), 0), 6) macro_f05 from f05s",
        "singleton_report": f"{w(s, t, ASSIGNED, SCORES)} select count(*) filter (n_true = 0 and n_pred = 0) correct_singles, count(*) filter (n_true = 0) true_singles, count(*) filter (n_pred = 0) predicted_singles from f05s",
        "threshold_curve": f"{w(s, t, GRID, CURVE)} select round(t, 4) threshold, round(f, 6) macro_f05 from curve",
        "best_threshold": f"{w(s, t, GRID, CURVE)} select round(t, 4) threshold, round(f, 6) macro_f05 from curve order by round(f, 12) desc, t limit 1",
        "bucket_thresholds": f"""{w(n, s, t, GRID, CURVE)}, b as (select entity_id s1_id, case when has_address = 1 then 'address' else 'no address' end bucket from nrm where side = 1),
  c as (select bucket, t, avg({F05}) f, count(*) records from at_t join b using (s1_id) group by all), top as (select *, row_number() over (partition by bucket order by round(f, 12) desc, t) k from c),
  o as (select t from curve order by round(f, 12) desc, t limit 1) select bucket, records, round(case when records < 30 then (select t from o) else t end, 4) threshold from top where k = 1""",
        "training_pairs": f"{w(s, t, LABELLED)} select * from training",
        "class_balance": f"{w(s, t, LABELLED)} select count(*) filter (label = 1) positives, count(*) filter (label = 0) negatives, round(count(*) filter (label = 0) / greatest(count(*) filter (label = 1), 1), 6) positive_weight from training",
        "val_split": f"select distinct {clean('entity_id')} s1_id, {DIGEST.format(clean('entity_id') + chr(124) * 2 + quoted('|42'))} / 16777216 < 0.2 is_val from train_source1",
        "sampled_records": "select entity_id from (select distinct entity_id from train_source1) order by md5(entity_id || '|42'), entity_id limit 500",
        "hard_negatives": f"""{w(s, t)}, x as (select s.*, row_number() over (partition by s1_id order by score desc, cand_id) k from scored s where s1_id in (select s1_id from truth) and (s1_id, cand_id) not in (select (s1_id, cand_id) from wanted)) select s1_id, cand_id, score from x where k <= 5""",
        "validate_rules": f"{w(LINES)} select distinct rule, offender from broken",
        "validate_summary": f"{w(LINES)} select rule, count(*) n, array_to_string(list_sort(list(offender))[1:5], ',') examples from (select distinct rule, offender from broken) group by rule",
        "outside_candidates": f"{w(s, t)} select distinct s1_id from wanted where (s1_id, cand_id) not in (select (s1_id, cand_id) from scored)",
        "gt_components": f"{w(t)}, {REACHED} select node, min(reached) component from reach group by node",
        "country_label_clusters": r"""with recursive l as (select trim(country) as label, count(*) n, lower(regexp_replace(trim(country), '[^\p{L}]', '', 'g')) x from
    (select country from train_source1 union all select country from train_source2 union all select country from train_source3) where trim(coalesce(country, '')) <> '' group by all),
  e as (select a.label as u, b.label as v from l a join l b on a.x = b.x or greatest(length(a.x), length(b.x)) > 3 and levenshtein(a.x, b.x) <= 1),
  r as (select u, v from e union select r.u, e.v from r join e on e.u = r.v),
  t as (select u, arg_max(label, (n, label)) c from r join l on l.label = r.v group by u) select label, n, c as "cluster" from l join t on t.u = l.label""",
        "embedding_topk_cosine": """with v as (select vec_id, embedding::double[] e from embeddings), p as (select a.vec_id query_id, b.vec_id, round(list_cosine_similarity(a.e, b.e), 9) score from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0),
  r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p) select query_id, vec_id, round(score, 5) score, rank from r where rank <= 10""",
    }
    for kind in ("pincode", "prefix4", "prefix6", "token", "bigram", "addr_token", "pin_prefix"):
        out[f"block_{kind}"] = f"{w(n, c, KEYS)} select s1_id, cand_id, key from capped where key_type = '{kind}'"
    return out
