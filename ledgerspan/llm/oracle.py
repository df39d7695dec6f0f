"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)


def _matches(kind: int, name: str, pattern: str, group: int, least: int) -> str:
    """Places follow from what lies between matches: marks put around each match split the text."""
    return f"""
  select doc_id, {kind} as kind, '{name}' as name, start_at as s, start_at + length(m) as e, v
  from (
    select doc_id, m, v, sum(length(gap) + length(m)) over (partition by doc_id order by i) - length(m) as start_at
    from (
      select doc_id, unnest(range(1, len(ms) + 1)) as i, unnest(ms) as m, unnest(vs) as v, unnest(gaps[1:len(ms)]) as gap
      from (
        select doc_id, regexp_extract_all(t, '{pattern}') as ms, regexp_extract_all(t, '{pattern}', {group}) as vs,
          string_split(regexp_replace(t, '{pattern}', chr(1), 'g'), chr(1)) as gaps
        from docs
      )
    )
  )
  where length(v) >= {least}"""


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_secret_scan"] = f"""
with docs as (select doc_id, source, replace(coalesce(text, ''), chr(1), chr(2)) as t from documents),
found as ({_matches(0, "assign", _ASSIGN, 2, 8)}
  union all {_matches(1, "access", "AKIA[A-Z0-9]+", 0, 16)}
  union all {_matches(2, "hex", "[0-9a-f]+", 0, 32)}),
owned as (
  select v, count(distinct source) >= 5 and count(distinct doc_id) >= 10 as example
  from found join docs using (doc_id) group by v),
one as (
  select doc_id, count_if(kind = 0) as n_assign, count_if(kind = 1) as n_access, count_if(kind = 2) as n_hex,
    string_agg(name || ':' || s || ':' || e, ',' order by s, kind) as spans,
    count_if(not example) as n_live, count_if(example) as n_example
  from found join owned using (v) group by doc_id)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
  sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans,
  coalesce(n_live, 0)::bigint as n_live, coalesce(n_example, 0)::bigint as n_example
from docs left join one using (doc_id)"""

ORACLE_SQL["op2_mixing"] = """
with recursive counts as (select coalesce(source, '') as s, count(*) as n from documents group by 1),
exact as (
  select s, row_number() over (order by s) - 1 as i, count(*) over () as k,
    sqrt(n) / sum(sqrt(n)) over () * (1000 - count(*) over ()) as x from counts),
ordered as (
  select *, row_number() over (order by floor(x) - x, s) as place, 1000 - sum(1 + floor(x)) over () as spare from exact),
parts as (select s, i, k, 1 + floor(x)::bigint + (place <= spare)::bigint as p from ordered),
lists as (select list(p order by i) as ps, max(k) as k from parts),
edf(t, done, pick) as (
  select 0::bigint, [0::bigint for x in ps], -1::bigint from lists
  union all
  select t + 1, list_transform(done, lambda d, j: d + (j - 1 = q)::bigint), q
  from (
    select t, done, list_min(list_transform(done, lambda d, j:
      case when d < ps[j] and d * 1000 // ps[j] <= t then ((d + 1) * 1000 + ps[j] - 1) // ps[j] * k + j - 1 end)) % k as q
    from edf, lists where t < 1000)),
cycle as (select t - 1 as slot, pick, row_number() over (partition by pick order by t) - 1 as turn from edf where t > 0),
ranked as (
  select doc_id, coalesce(source, '') as s, row_number() over (partition by coalesce(source, '') order by md5(doc_id::varchar)) - 1 as rk
  from documents)
select doc_id, s as source, block, slot, row_number() over (order by slot, rk) - 1 as position
from (
  select doc_id, s, rk, rk // 16 as block, rk // 16 // p * 1000 + c.slot as slot
  from ranked join parts using (s) join cycle c on c.pick = i and c.turn = rk // 16 % p)"""

ORACLE_SQL["op3_embedding_dedup"] = """
with recursive usable as (
  select row_number() over (order by vec_id) as i, vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len([x for x in embedding if x <> 0]) > 0),
links as (
  select x.i as a, y.i as b from usable x join usable y on x.label = y.label and len(x.e) = len(y.e) and x.i <> y.i
  where list_cosine_similarity(x.e, y.e) >= 0.98),
reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a, min(vec_id) as id from reach join usable on usable.i = reach.b group by a),
counts as (select a, count(*) as n from links group by a),
known as (
  select usable.vec_id, coalesce(n, 0)::bigint as n_links, least(usable.vec_id, coalesce(id, usable.vec_id)) as component_id
  from usable left join counts on counts.a = i left join least on least.a = i)
select vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id,
  vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join known using (vec_id)"""

ORACLE_SQL["op5_ngram_join"] = f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[pos:pos + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as pos from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select a, b
  from (select x.doc_id as a, y.doc_id as b, count(*) as common
        from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all)
  join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 7 * common >= 3 * (p.n + q.n)),
sym as (select a, b from links union all select b, a from links),
reach as (select a, b from sym union select reach.a, sym.b from reach join sym on reach.b = sym.a),
least as (select a as doc_id, min(b) as b from reach group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(b, doc_id)) as component_id
from documents left join sizes using (doc_id) left join least using (doc_id)"""

_ESCAPE = r"regexp_replace({}, '<(\\*)\|', '<\\\1|', 'g')"

ORACLE_SQL["op7_chat_format"] = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations
  union all select -7, 0, 'user', '\\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
named as (
  select conv_id, turn, t, case r when 'human' then 'user' when 'gpt' then 'assistant' when 'bot' then 'assistant'
    when 'model' then 'assistant' else r end as r from rows)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, r, t)) as turns_sha256,
  sum(case when r = 'assistant' then length(t) else 0 end)::bigint as loss_chars,
  sha256(string_agg(case when r = 'assistant' then t else '' end, '' order by turn nulls first, r, t)) as loss_sha256,
  sum(8 + 8 + 7 + length({_ESCAPE.format("r")}) + length({_ESCAPE.format("t")}))::bigint as formatted_chars
from named group by conv_id"""


def _rules() -> str:
    from ledgerspan.llm.quality_rules import RULES

    return " and ".join(
        f"not coalesce({rule.metric} {rule.fails_if} {rule.threshold!r}::double and n_words >= {rule.words}, false)" for rule in RULES
    )


def _stop_words() -> str:
    from ledgerspan.llm.quality_rules import STOP_WORDS

    return ", ".join(f"'{word}'" for word in STOP_WORDS)


ORACLE_SQL["op9_quality_rules"] = f"""
with docs as (select doc_id, coalesce(text, '') as t from documents),
split as (select doc_id, t, regexp_extract_all(t, '{WORD}') as w, string_split(t, chr(10)) as l from docs),
lines as (select *, [x for x in l if regexp_matches(x, '{WORD}')] as full_lines from split),
windows as (
  select doc_id, pos, array_to_string(w[pos:pos + 4], ' ') as win from (select doc_id, w, unnest(range(1, len(w) - 3)) as pos from split where len(w) >= 5)),
repeated as (select doc_id, pos from windows qualify count(*) over (partition by doc_id, win) > 1),
covered as (select doc_id, count(distinct word) as n from (select doc_id, unnest(range(pos, pos + 5)) as word from repeated) group by doc_id),
base as (
  select doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '{BLANK}', '', 'g'))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    len([x for x in w if lower(x) in ({_stop_words()})])::bigint as n_stop_words,
    len(l)::bigint as n_lines, len(full_lines)::bigint as n_full_lines,
    (len(full_lines) - len(list_distinct(full_lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
  from lines left join covered using (doc_id)),
ratios as (
  select *, word_chars / nullif(n_words, 0)::double as mean_word_chars, n_symbols / nullif(word_chars, 0)::double as symbol_ratio,
    n_stop_words / nullif(n_words, 0)::double as stop_word_ratio, n_dup_lines / nullif(n_full_lines, 0)::double as dup_line_ratio,
    1 - n_full_lines / n_lines::double as blank_line_ratio,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed
  from base)
select *, not base_failed and {_rules()} as kept from ratios"""

ORACLE_SQL["op12_filter_audit"] = f"""
with docs as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
split as (select *, regexp_extract_all(t, '{WORD}') as w, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as capitals from docs),
failing as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    [x[1] for x in [['A', (len(w) < 100)::varchar], ['B', (100 * len(list_distinct(w)) < 80 * len(w))::varchar],
      ['C', (100 * capitals > 10 * length(t))::varchar], ['D', regexp_matches(t, '[#$%&*|]')::varchar],
      ['E', coalesce(doc_id > min(doc_id) over (partition by t), false)::varchar]] if x[2] = 'true'] as fails
  from split left join marks using (doc_id)),
counters as (select part, good, toxic, fails, count(*) as n from failing group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
permuted as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select filter_order, step::integer as step, filter_order[step] as f, string_split(filter_order[1:step - 1], '') as earlier
  from permuted, range(1, 6) as s(step)),
cells as (
  select *, list_contains(fails, f) as here, len(list_intersect(fails, earlier)) > 0 as gone
  from counters, steps),
sums as (
  select part, filter_order, step, f,
    sum(n) filter (not here and not gone) as kept, sum(n) filter (here and not gone) as removed, sum(n) filter (here and gone) as redundant,
    sum(n) filter (here and len(fails) = 1) as unique_fails, sum(n) filter (here and not gone and good) as good_lost,
    sum(n) filter (here and not gone and toxic) as toxic_lost
  from cells group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
  coalesce(toxic_lost, 0)::bigint as toxic_lost, coalesce(sum(removed) over (partition by part, f), 0)::bigint as shapley
from sums"""


def _plus(value: str, cost: str, edit: str) -> str:
    """A cost of nine digits and an audit as one string: its order is that of cost, then audit."""
    return f"(lpad((substr({value}, 1, 9)::bigint + {cost})::varchar, 9, '0') || '{edit}' || substr({value}, 10))"


def _insertions(v0: str, vs: str, vu: str, va: str) -> list[str]:
    return [f"least({v}, {_plus(after, '3', 'I')})" for v, after in ((v0, vu), (vs, vu), (vu, va), (va, vu))]


def _consumed(state: int) -> str:
    after = ["n0", "ns", "nu", "na"]
    kept = [{"s": "ns", "u": "nu"}, {"u": "nu"}, {"a": "na"}, {"u": "nu"}][state]
    given = ["nu", "nu", "na", "nu"][state]
    keeps = " ".join(f"when initial = '{i}' then {_plus(v, 'late', 'K')}" for i, v in kept.items())
    return f"""least({_plus(after[state], "4", "D")}, case when not gone then {_plus(given, "3 + late", "R")} end,
      case when gone then null {keeps} end)"""


_BYTES = "list_transform(range(1, length(x) + 1), lambda i: ascii(x[i])::bigint)"
_CRC = f"""xor(4294967295, list_reduce({_BYTES}, lambda c, b: list_reduce(range(8), lambda d, i: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)), 4294967295))"""
_OPTIONS = [f"{_consumed(i)} as v{c}" for i, c in enumerate("0sua")]
_ROUND = ", ".join(f"{e} as {v}" for e, v in zip(_insertions("v0", "vs", "vu", "va"), ("v0", "vs", "vu", "va")))

ORACLE_SQL["op11_conversation_repair"] = f"""
with recursive source as (
  select conv_id, turn, coalesce(role, ' ') as r, coalesce(text, ' ') as t, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as x
  from conversations),
fates as (select * exclude (x), {_CRC} % 20 as fate from source),
rows as (
  select coalesce(conv_id::varchar, ' ') as k, turn, case when fate = 4 then 'user' else r end as r,
    case fate when 1 then '' when 2 then translate(t, '.!?', '') else t end as t, unnest(range(case when fate = 3 then 2 else 1 end)) as copy
  from fates where fate <> 0),
numbered as (select *, row_number() over (partition by k order by turn nulls first, r, sha256(t)) as i from rows),
seen as (
  select *, r[1] as initial, regexp_extract(t, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1, 's') as ending,
    row_number() over (partition by k, r, t order by i) > 1 as again, lag(r[1]) over (partition by k order by i) as former
  from numbered),
faults as (
  select *, ending = '' as blank, ending <> '' and again as duplicate, ending <> '' and not again and ending not in ('.', '!', '?') as truncated,
    ending = '' or again as gone
  from seen),
symbols as (select *, 3 * truncated::bigint as late from faults),
counts as (
  select k, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank, count_if(duplicate) as duplicate,
    count_if(truncated) as truncated, count_if(former is not null and former || initial not in ('su', 'ua', 'au')) as illegal, max(i) as n
  from symbols group by k),
dp(k, i, v0, vs, vu, va) as (
  select k, n, '000000000', '000000006II', '000000003I', '000000000' from counts
  union all
  select k, i - 1, {_ROUND} from (select k, i, {_ROUND} from (
    select k, i, {", ".join(_OPTIONS)}
    from (select dp.k, dp.i, v0 as n0, vs as ns, vu as nu, va as na, initial, gone, late from dp join symbols s on s.k = dp.k and s.i = dp.i where dp.i > 0)))),
best as (select k, substr(v0, 1, 9)::bigint as cost, substr(v0, 10) as audit from dp where i = 0),
edits as (select k, unnest(range(1, length(audit) + 1)) as pos, audit from best),
placed as (
  select k, pos, audit[pos] as edit, count_if(audit[pos] <> 'I') over (partition by k order by pos) as i,
    count_if(audit[pos] <> 'D') over (partition by k order by pos) as e
  from edits),
told as (
  select p.k, pos, edit, e, r, t, bool_or(edit = 'K' and e = 1 and initial = 's') over (partition by p.k)::bigint as opening
  from placed p left join symbols s on s.k = p.k and s.i = p.i and edit in ('K', 'R')),
texts as (
  select k, string_agg(case when edit = 'K' then r when (e - opening) % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(t, ''), chr(10)
    order by pos) as repaired
  from told where edit <> 'D' group by k)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
  coalesce(audit, '') as audit, sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id, coalesce(conv_id::varchar, ' ') as k from conversations)
left join counts using (k) left join best using (k) left join texts using (k)"""
