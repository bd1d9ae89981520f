"""DuckDB SQL for the numbered queries that SQL can express, step by step."""

from __future__ import annotations

from labeltext.llm import secrets

SPACE = r"[\x20\x09\x0a\x0b\x0c\x0d]+"
WORDS = "list_filter(string_split_regex(coalesce({}, ''), '" + SPACE + "'), lambda x: x <> '')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def spans(place: int, rule: secrets.Rule) -> str:
    """List of ``{s, k, e}`` of a rule; what lies between the matches gives the places."""
    pattern = "[0-9a-f]{24,}" if rule.kind == "hex" else rule.pattern
    pattern = "'" + pattern.replace("'", "''") + "'"
    lengths = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    start = lengths.format("gaps[1:i]") + " + " + lengths.format("whole[1:i - 1]")
    return f"""(select list_filter(list_transform(range(1, len(whole) + 1), lambda i: {{
            's': ({start})::bigint, 'k': {place}, 'e': ({start} + length(whole[i]))::bigint,
            'n': length(part[i])}}), lambda x: x.n >= {rule.least})
        from (select string_split_regex(t, {pattern}) as gaps, regexp_extract_all(t, {pattern}, 0) as whole,
            regexp_extract_all(t, {pattern}, {rule.group}) as part))"""


def joined(spans_: str, names: tuple[str, ...]) -> str:
    kinds = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    kept = f"list_sort(list_filter({spans_}, lambda x: x.k < {len(names)}))"
    return f"array_to_string(list_transform({kept}, lambda x: {kinds}[x.k + 1] || ':' || x.s || ':' || x.e), ',')"


KINDS = tuple(r.kind for r in secrets.RULES)
SECRETS = f"""with docs as (select doc_id, coalesce(text, '') as t from documents),
found as (select doc_id, {" || ".join(spans(i, r) for i, r in enumerate(secrets.RULES))} as f from docs)
select doc_id,
    {", ".join(f"len(list_filter(f, lambda x: x.k = {i}))::bigint as n_{k}" for i, k in enumerate(KINDS[:3]))},
    sha256({joined("f", KINDS[:3])}) as base_sha256, {joined("f", KINDS)} as spans
from found"""

REPEATS = f"""with docs as (select doc_id, {WORDS.format("text")} as w from documents),
starts as (select doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) as i from docs),
windows as (select doc_id, i, array_to_string(w[i:i + 49], ' ') as g from starts),
firsts as (select g, min(doc_id) as m from windows group by g),
covered as (select distinct doc_id, unnest(range(i, i + 50)) as p
    from windows join firsts using (g) where m < doc_id),
places as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from docs),
kept as (select doc_id, count(covered.p) as gone,
    string_agg(x, ' ' order by places.p) filter (covered.p is null) as k
    from places left join covered using (doc_id, p) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(gone, 0)::bigint as n_removed,
    sha256(coalesce(k, '')) as kept_sha256
from docs left join kept using (doc_id)"""

NEAR_COPIES = f"""with recursive docs as (select doc_id, {WORDS.format(LOWER)} as w from documents),
sets as (select doc_id, list_sort(case when len(w) = 0 then []
    when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end) as s from docs),
classes as (select s, min(doc_id) as rep, len(s) as n from sets where len(s) > 0 group by s),
grams as (select rep, n, unnest(s) as g from classes),
pairs as (select a.rep as a, b.rep as b, a.n + b.n - count(*) as all_, count(*) as k
    from grams a join grams b on a.g = b.g and a.rep < b.rep group by a.rep, b.rep, a.n, b.n),
links as (select a, b from pairs where 100 * k >= 80 * all_),
sides as (select a as u, b as v from links union all select b, a from links),
reached as (select rep, rep as r from classes
    union select reached.rep, sides.v from reached join sides on reached.r = sides.u),
components as (select rep, min(r) as c from reached group by rep)
select doc_id, len(sets.s)::bigint as n_shingles, coalesce(c, doc_id) as component_id,
    doc_id = coalesce(c, doc_id) as kept
from sets left join classes on sets.s = classes.s left join components using (rep)"""

# products are added as the search adds them: eight running sums, then those in pairs
_SUMS = [f"list_reduce(p[{i}:len(p):8], lambda a, b: a + b)" for i in range(1, 9)]
_TOTAL = "(({0} + {1}) + ({2} + {3})) + (({4} + {5}) + ({6} + {7}))".format(*_SUMS)
NEAREST = f"""with vectors as (select vec_id, embedding::double[] as e from embeddings),
fine as (select * from vectors where vec_id is not null and len(list_filter(e, lambda x: x <> 0)) > 0
    and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0),
pairs as (select q.vec_id as query_id, c.vec_id, list_transform(list_zip(q.e, c.e), lambda x: x[1] * x[2]) as p
    from fine q join fine c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
scored as (select query_id, vec_id, {_TOTAL} as score from pairs),
ranked as (select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank,
    vec_id, score from scored)
select * from ranked where rank <= 20"""

TERMS = f"regexp_extract_all({LOWER}, '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+')"

RANKED = f"""with docs as (select doc_id, {TERMS} as w from documents where {TERMS} <> []),
sizes as (select count(*) as all_docs, sum(len(w))::hugeint as all_terms from docs),
queries as (select row_number() over () as q, item_id, list_distinct({TERMS}) as w from benchmark),
wanted as (select q, item_id, unnest(w) as t from queries),
words as (select doc_id, len(w) as n, unnest(w) as t from docs),
counts as (select doc_id, n, t, count(*)::bigint as tf from words where t in (select t from wanted) group by all),
weights as (select t, floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1)))::bigint as w
    from counts, sizes group by t),
impacts as (select doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n::hugeint * all_docs) // all_terms)))::bigint as s
    from counts join weights using (t), sizes),
scores as (select q, item_id, doc_id, sum(s)::bigint as score from wanted join impacts using (t) group by all),
ranked as (select *, row_number() over (partition by q order by score desc, doc_id)::int as rank from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10"""

#: CRC-32 of a text of ASCII characters: the table of its bytes by rule, then byte by byte.
CRC_TABLE = """(select list(v order by i) from (select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(i)))"""


def crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''),
        lambda x: ascii(x)::bigint)), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])))"""


def _repairs() -> str:
    """Cheapest repairs row by row: of each state of the turn order the least (cost, edits), a struct."""
    best = lambda *xs: "list_sort([" + ", ".join(xs) + "])[1]"
    edit = lambda s, cost, letter, turn="": (
        f"{{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 't': " + (f"list_append({s}.t, {turn})" if turn else f"{s}.t") + "}")
    sure = lambda s, ok, cost, letter, turn: edit(s, f"case when {ok} then {cost} else 1000000000 end", letter, turn)
    free = "fault not in ('blank', 'duplicate')"
    more = "(case fault when 'truncated' then 5 else 0 end)"
    keep = lambda s, x: sure(s, f"{free} and x = '{x}'", more, "K", "role || ':' || text")
    rerole = lambda s, role: sure(s, free, f"1 + {more}", "R", f"'{role}:' || text")
    insert = lambda s, role: edit(s, 5, "I", f"'{role}:'")
    delete = lambda s: edit(s, 2, "D")
    none = "{'c': 1000000000::bigint, 'a': '', 't': []::varchar[]}"
    return f"""with recursive hit as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as k
    from conversations, (select {CRC_TABLE} as crc_table)),
lines as (select conv_id, turn, case k when 4 then 'user' else role end as role,
    case k when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case k when 0 then [] when 3 then [0, 1] else [0] end) as copy from hit),
seen as (select *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
    row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as p,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again from lines),
placed as (select *, role[1] as x, case when body = '' then 'blank' when again then 'duplicate'
    when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
    lag(role[1]) over (partition by conv_id order by p) as y from seen),
convs as (select distinct conv_id from conversations),
counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (p > 1 and y || x not in ('su', 'ua', 'au')) as illegal, count(*) as n from placed group by conv_id),
steps as (
    select conv_id, 0::bigint as p, {{'c': 0::bigint, 'a': '', 't': []::varchar[]}} as s0,
        {none} as s1, {none} as s2, {none} as s3 from convs
    union all
    select conv_id, p, {delete("s0")}, {best(delete("s1"), keep("s0", "s"))},
        {best(delete("s2"), *(f(s, u) for s in ("s0", "s1", "s3") for f, u in ((keep, "u"), (rerole, "user"))))},
        {best(delete("s3"), keep("s2", "a"), rerole("s2", "assistant"))}
    from (select v.conv_id, v.p, role, text, x, fault, s0, s1,
            {best("s2", insert("s0", "user"), insert("s1", "user"), insert("s3", "user"))} as s2,
            {best("s3", insert("s2", "assistant"))} as s3
        from steps join placed v on v.conv_id is not distinct from steps.conv_id and v.p = steps.p + 1)),
ends as (select s.conv_id, {best("s0", "s3", insert("s2", "assistant"))} as s
    from steps s left join counts c on s.conv_id is not distinct from c.conv_id where s.p = coalesce(c.n, 0))
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
    coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
    coalesce(illegal, 0)::bigint as illegal, s.c::bigint as cost, s.a as audit,
    sha256(array_to_string(s.t, chr(10))) as repaired_sha256
from ends e left join counts c on e.conv_id is not distinct from c.conv_id"""


REPAIRS = _repairs()

ORACLE: dict[str, str] = {
    "op4_secret_ledger": SECRETS,
    "op5_recompression": REPEATS,
    "op6_lsh_forest": NEAR_COPIES,
    "op8_vp_trees": NEAREST,
    "op11_norm_buckets": RANKED,
    "op12_turn_repair": REPAIRS,
}
