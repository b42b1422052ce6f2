"""DuckDB twins of the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

NEAR_DUPLICATES = f"""
with recursive texts as (
    select doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w
    from documents),
sets as (
    select doc_id, case
        when len(w) >= 5 then list_distinct(
            list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
    from texts),
classes as (
    select s, min(doc_id) as c, len(s) as n, list(doc_id) as members
    from (select doc_id, list_sort(coalesce(s, [])) as s from sets) where len(s) > 0 group by s),
each as (select c, n, unnest(s) as x from classes),
links as (
    select a.c as a, b.c as b from each a join each b on a.x = b.x and a.c <> b.c
    group by a.c, b.c, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(c, r) as (
    select c, c from classes union select reach.c, links.b from reach join links on reach.r = links.a),
comps as (select c, min(r) as component_id from reach group by c),
placed as (
    select unnest(members) as doc_id, n, component_id from classes join comps using (c))
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, d.doc_id) as component_id,
    d.doc_id = coalesce(component_id, d.doc_id) as kept
from documents d left join placed using (doc_id)
"""

_MARKS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ANS]", "</s>", "[ROLE]", "[/ROLE]", "[END]", "<s>"]

#: Signs that escaping adds: one for each escape sign or control string.
_SIGNS = " + ".join(
    f"(length(text) - length(replace(text, '{mark}', ''))) // {len(mark)}" for mark in ["\\", *_MARKS]
)

CHATS = f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values
        (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
ordered as (
    select *, row_number() over (partition by conv_id order by turn nulls last, role, text) as n,
        length(text) + {_SIGNS} as escaped_chars
    from turns),
before as (
    select *, lag(role, 1, '') over (partition by conv_id order by n) as previous from ordered)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
    (3 + sum(escaped_chars + case role when 'system' then 15 when 'user' then 13 when 'assistant' then 9
        else 18 + length(role) end))::bigint as formatted_chars,
    coalesce(bool_and(case previous when '' then role in ('system', 'user') when 'system' then role = 'user'
        when 'user' then role = 'assistant' when 'assistant' then role = 'user' else false end), false)
        and arg_max(role, n) = 'assistant' as valid
from before group by conv_id
"""

#: Letter k of 32: five bits of the digest, from two of its hexadecimal digits.
WARC = """
with payloads as (select page_id, coalesce(html, '') as html from pages),
digests as (select page_id, strlen(html) as payload_bytes, sha1(html) as sha from payloads),
coded as (
    select *, array_to_string(list_transform(range(32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
            (('0x' || rpad(substr(sha, 5 * k // 4 + 1, 2), 2, '0'))::int >> (3 - 5 * k % 4)) & 31), 1)), '')
        as payload_digest
    from digests),
firsts as (select *, min(page_id) over (partition by payload_digest) as head from coded)
select page_id, payload_bytes, payload_digest,
    case when page_id = head then 'response' else 'revisit' end as record_type,
    case when page_id <> head then head end as refers_to
from firsts
"""

MIXING = f"""
with sizes as (
    select doc_id, coalesce('s' || source, 't') as src,
        coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
        md5('mix:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as key
    from documents),
sources as (
    select src, sum(size)::bigint as source_size,
        [3.0, 1.0, 2.0][(row_number() over (order by src) - 1) % 3 + 1]::double as weight
    from sizes group by src),
limits as (select *, source_size * 2.0::double as most from sources),
levels as (
    select *, (sum(source_size) over () * 1.5::double - coalesce(sum(most) over (
            order by most / weight, src rows between unbounded preceding and 1 preceding), 0))
        / sum(weight) over (order by most / weight, src rows between current row and unbounded following)
        as level
    from limits),
targets as (select src, source_size, least(most, max(level) over () * weight) as target from levels),
placed as (
    select s.*, t.source_size, t.target, floor(t.target + 0.5)::bigint as budget,
        coalesce(sum(size) over (partition by s.src order by key, doc_id
            rows between unbounded preceding and 1 preceding), 0)::bigint as before
    from sizes s join targets t using (src)),
rounds as (
    select *, case when source_size > 0 then budget // source_size else 0 end as epochs from placed)
select doc_id, size, source_size, target,
    (epochs * size + least(greatest(budget - epochs * source_size - before, 0), size))::bigint as taken
from rounds
"""


def _spend(value: str, cost: str, edit: str) -> str:
    """A value is nine digits of cost and then the audit, so that the least string is the best."""
    return f"lpad((substr({value}, 1, 9)::bigint + {cost})::varchar, 9, '0') || substr({value}, 10) || {edit}"


def _put(value: str, initial: str) -> str:
    """A row kept or reroled as `initial`; null where it has to go."""
    kept = _spend(value, "more", "'K'")
    reroled = _spend(value, "1 + more", "'R'")
    return f"case when gone then null when initial = '{initial}' then {kept} else {reroled} end"


def _insert(value: str) -> str:
    return _spend(value, "5", "'I'")


#: One row further: v0 to v3 are the best repairs that end in each position of (s?(ua)+)?.
_STEP = f"""
select c, n, w0 as v0, w1 as v1, x2 as v2, least(w3, {_insert("x2")}) as v3 from (
    select *, least(w2, {_insert("w0")}, {_insert("w1")}, {_insert("w3")}) as x2 from (
        select r.c, r.n, {_spend("v0", "2", "'D'")} as w0,
            least({_spend("v1", "2", "'D'")},
                case when not gone and initial = 's' then {_spend("v0", "more", "'K'")} end) as w1,
            least({_spend("v2", "2", "'D'")}, {_put("v0", "u")}, {_put("v1", "u")}, {_put("v3", "u")}) as w2,
            least({_spend("v3", "2", "'D'")}, {_put("v2", "a")}) as w3
        from reach join marked r on r.c = reach.c and r.n = reach.n + 1))
"""

#: The checksum bit by bit: the reversed polynomial goes in where a one falls out.
_CRC32 = """
xor(4294967295::bigint, list_reduce(
    [4294967295::bigint] || list_transform(string_split(key, ''), lambda x: ascii(x)::bigint),
    lambda crc, byte: list_reduce([xor(crc, byte)] || range(8), lambda rest, bit:
        case when rest & 1 = 1 then xor(rest >> 1, 3988292384::bigint) else rest >> 1 end)))
"""

REPAIR = f"""
with recursive given as (
    select dense_rank() over (order by conv_id) as c, conv_id, turn, coalesce(role, ' ') as role,
        coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
    from conversations),
hits as (select *, {_CRC32} % 20 as hit from given),
rows as (
    select c, turn, case hit when 4 then 'user' else role end as role,
        case hit when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(range(case hit when 3 then 2 else 1 end)) as copy
    from hits where hit <> 0),
ordered as (
    select *, left(role, 1) as initial,
        row_number() over (partition by c order by turn nulls first, role, sha256(text), copy) as n
    from rows),
judged as (
    select *, not regexp_matches(text, '{WORD}') as blank,
        row_number() over (partition by c, role, text order by n) > 1 as again,
        not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') as cut,
        lag(initial) over (partition by c order by n) || initial as pair
    from ordered),
marked as (
    select *, blank or again as gone, case when cut then 5 else 0 end as more from judged),
reach(c, n, v0, v1, v2, v3) as (
    select distinct c, 0::bigint, '000000000', null::varchar, '000000005I', '000000010II' from given
    union all {_STEP}),
ends as (
    select c, arg_max(least(v0, v3), n) as best from reach group by c),
edits as (
    select c, i, substr(best, 9 + i, 1) as edit,
        i - length(replace(substr(best, 10, i), 'I', '')) as put_in
    from (select c, best, unnest(range(1, length(best) - 8)) as i from ends)),
placed as (
    select e.c, e.i, e.edit, m.role, m.initial, m.text, row_number() over (partition by e.c order by e.i) as j
    from edits e left join marked m on m.c = e.c and m.n = e.i - e.put_in and e.edit <> 'I'
    where e.edit <> 'D'),
named as (
    select *, j + max(case when j = 1 and edit = 'K' and initial = 's' then 1 else 0 end) over (partition by c) as k
    from placed),
texts as (
    select c, sha256(string_agg(case edit when 'K' then role else ['assistant', 'user'][1 + k % 2] end
        || ':' || coalesce(text, ''), chr(10) order by i)) as sha, count(*) as rows_left
    from named group by c),
counts as (
    select c, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (blank) as blank,
        count(*) filter (again and not blank) as duplicate,
        count(*) filter (cut and not gone) as truncated,
        count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
    from marked group by c)
select g.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank,
    coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
    substr(best, 1, 9)::bigint as cost, substr(best, 10) as audit,
    coalesce(sha, sha256('')) as repaired_sha256, coalesce(rows_left, 0) as repaired_rows
from (select distinct c, conv_id from given) g join ends using (c) left join texts using (c) left join counts using (c)
"""


_DISTANCE = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
_FLOOR = "((s - ((s % n) + n) % n) // n)::bigint"


def _codebook_round(step: int) -> str:
    """near: each part's nearest entry; book: entries moved to the floors of their means."""
    return f"""
near{step} as (
    select vec_id, label, p, x, min(({_DISTANCE}, e)) as best
    from parts join book{step} using (p) group by all),
book{step + 1} as (
    select p, e, coalesce(m, c) as c from book{step} left join (
        select p, e, list({_FLOOR} order by i) as m from (
            select p, best[2] as e, i, sum(x[i])::bigint as s, count(*)::bigint as n
            from (select *, unnest(range(1, len(x) + 1)) as i from near{step}) group by all)
        group by p, e) using (p, e))"""


VECTOR_CODES = f"""
with kept as (
    select vec_id, label, list_transform(embedding, lambda v: floor(4096 * v::double)::bigint) as v
    from embeddings where embedding is not null
        and len(list_filter(embedding, lambda v: v is not null and isfinite(v))) = len(embedding)),
parts as (
    select vec_id, label, p, v[p * len(v) // 8 + 1 : (p + 1) * len(v) // 8] as x
    from kept, range(8) positions(p)),
book0 as (
    select p, row_number() over (partition by p order by vec_id) - 1 as e, x as c
    from parts where vec_id in (select vec_id from kept order by vec_id limit 16)),
{",".join(_codebook_round(step) for step in range(7))},
codes as (
    select vec_id, label, string_agg(printf('%02x', best[2]), '' order by p) as code, sum(best[1])::bigint as error
    from near6 group by all)
select vec_id, label, code, error, sum(error) over (partition by label)::bigint as label_error,
    (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) from book6) as codebooks_sha256
from codes
"""
