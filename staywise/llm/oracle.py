"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from .rules import STOP_WORDS

ORACLES: dict[str, str] = {}

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

ORACLES["op8_quality_rules"] = rf"""
with d as (select doc_id, coalesce(text, '') as text from documents),
w as (
    select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from d
),
g as (
    select doc_id, unnest(range(1, len(words) - 1)) as i, words from w where len(words) > 2
),
h as (select doc_id, i, count(*) over (partition by doc_id, words[i], words[i + 1], words[i + 2]) as n from g),
r as (
    select doc_id, count(distinct p) as n_repeat_words
    from (select doc_id, unnest([i, i + 1, i + 2]) as p from h where n > 1) group by doc_id
),
m as (
    select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
        len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words,
        len(list_filter(words, lambda x: lower(x) in ({_STOP}))) as n_stop_words,
        length(text) - length(regexp_replace(text, '[\x21-\x40\x5B-\x60\x7B-\x7E]', '', 'g')) as n_marks,
        length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) as n_capitals
    from w left join r using (doc_id)
),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
    not (base_failed or coalesce(n_symbols / nullif(n_words, 0) > 0.5, false)
        or coalesce(n_dup_lines / nullif(n_lines, 0) > 0.5, false)
        or coalesce(n_stop_words / nullif(n_words, 0) < 0.04, false)
        or coalesce(n_capitals / nullif(word_chars, 0) > 0.4, false)
        or coalesce(word_chars / nullif(n_words, 0) < 2.0, false)
        or coalesce(word_chars / nullif(n_words, 0) > 20.0, false)
        or coalesce(n_marks / nullif(word_chars, 0) > 0.4, false)) as kept
from b
"""

ORACLES["op2_chat_format"] = r"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), ''))
        as loss_sha256,
    sum(24 + length(replace(regexp_replace(role, '<(\|+)', '<|\1', 'g'), chr(10), '<|n|>'))
        + length(regexp_replace(text, '<(\|+)', '<|\1', 'g')))::bigint as formatted_chars
from c group by conv_id
"""


def _raking(sweeps: int) -> str:
    steps, last = [], "k0"
    powers = {"source": 0.7, "lang": 0.7, "topic": 0.5}
    for name, power in powers.items():
        steps.append(
            f"g_{name} as (select {name}, t / sum(t) over () as goal from "
            f"(select {name}, pow(sum(tokens), {power}) as t from cells group by {name}))"
        )
    for k in range(sweeps):
        for name in powers:
            new = f"k{k}_{name}"
            steps.append(
                f"{new} as materialized (select source, lang, topic, tokens, w * goal / sum(w) over (partition by {name}) as w "
                f"from {last} join g_{name} using ({name}))"
            )
            last = new
    return ",\n".join(steps) + f",\nraked as (select * from {last})"


ORACLES["op10_mixture"] = rf"""
with d as (
    select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang,
        case when regexp_matches(coalesce(text, ''), '[Ll]icense|[Cc]opyright|rights reserved') then 'legal'
            when regexp_matches(coalesce(text, ''), '[0-9]{{4}}') then 'data'
            when regexp_matches(coalesce(text, ''), '\n[^\n]*\n[^\n]*\n[^\n]*\n[^\n]*\n') then 'list'
            else 'prose' end as topic,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens
    from documents
),
cells as (select source, lang, topic, sum(n_tokens)::double as tokens from d group by all having sum(n_tokens) > 0),
k0 as (select *, tokens as w from cells),
{_raking(90)},
p as (select source, lang, topic, 0.5 * sum(tokens) over () * w / tokens as e from raked),
j as (
    select doc_id, d.topic, n_tokens, case when n_tokens > 0 then coalesce(e, 0.0) else 0.0 end as e,
        ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 13))::bigint::double / 4503599627370496.0 as u
    from d left join p using (source, lang, topic)
)
select doc_id, topic, n_tokens, round(e, 6) as probability,
    (floor(e) + case when u < e - floor(e) then 1 else 0 end)::bigint as copies
from j
"""

ORACLES["op1_warc_archive"] = r"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html)::bigint as payload_bytes, sha1(html) as payload_digest from p),
k as (select *, max(page_id) over (partition by payload_bytes, payload_digest) as kept from d)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id is distinct from kept then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id is distinct from kept then kept end as refers_to
from k
"""

_CUTS = " union all ".join(
    f"select lang, ws, a, {k} as k, list_slice(ws, 1, {k}) as x, list_slice(ws, {k + 1}, len(ws)) as y from cand where len(ws) > {k}"
    for k in (1, 2, 3)
)
_INSIDE = " union all ".join(
    f"select lang, list_slice(ws, {i}, {i + size - 1}) as ws, a as f from cand where len(ws) >= {max(size + 1, i + size - 1)}"
    for size in (2, 3)
    for i in range(1, 6 - size)
)
_PHRASES = " union all ".join(f"select lang, list_slice(ws, i, i + {k - 1}) as ws from places where i + {k - 1} <= len(ws)" for k in (1, 2, 3, 4))

ORACLES["op12_collocations"] = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents where text is not null
),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
places as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from words),
totals as (select lang, sum(len(ws))::bigint as n from words group by lang),
f as (select lang, ws, count(*) as f from ({_PHRASES}) group by all having count(*) >= 30),
cand as (select lang, ws, f as a from f where len(ws) > 1),
cuts as ({_CUTS}),
scored as (
    select c.lang, c.ws, c.a, c.k, fx.f as l, fy.f as r, ((2000000::hugeint * c.a) // (fx.f + fy.f))::bigint as score
    from cuts c join f fx on fx.lang = c.lang and fx.ws = c.x join f fy on fy.lang = c.lang and fy.ws = c.y
),
best as (select * from scored qualify row_number() over (partition by lang, ws order by score, k) = 1),
inside as (select lang, ws, max(f) as f from ({_INSIDE}) group by all),
kept as (
    select b.lang, array_to_string(b.ws, ' ') as phrase, b.a, b.l, b.r, b.score
    from best b left join inside i on i.lang = b.lang and i.ws = b.ws where i.f is null or 100 * i.f < 80 * b.a
),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

ORACLES["op13_spelling_variants"] = r"""
with recursive steps as (
    select x as b, x as v, 0 as k from range(256) t(x)
    union all
    select b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, k + 1 from steps where k < 8
),
crc as (select list(v order by b) as t from steps where k = 8),
runs as (
    select coalesce(doc_id::varchar, '') as id,
        translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from documents
),
one as (select id, run, count(*) as times from runs where length(run) >= 7 group by all),
hashed as (
    select run, times, xor(4294967295, list_reduce(
        list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda c: ('0x' || c)::bigint),
        lambda acc, c: xor(acc >> 8, t[(xor(acc, c) & 255) + 1]), 4294967295::bigint)) as h
    from one, crc
),
noisy as (
    select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, times
    from hashed
),
w as (select word, sum(times)::bigint as n from noisy where length(word) >= 7 group by word having sum(times) >= 2),
gone as (
    select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as i from w)
),
near as (
    select distinct a.word, b.word as other, b.n as other_n from gone a join gone b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union
    select distinct a.word, b.word, b.n from gone a join w b on a.rest = b.word
    union
    select distinct b.word, a.word, a.n from gone a join w b on a.rest = b.word
),
ranked as (
    select *, count(*) over (partition by word) as n_near, row_number() over (partition by word order by other_n desc, encode(other)) as place from near
),
best as (select word, n_near, other, other_n from ranked where place = 1),
forms as (
    select w.word, w.n, coalesce(n_near, 0)::bigint as n_near,
        case when best.other_n >= 10 * w.n then best.other end as form, case when best.other_n >= 10 * w.n then best.other_n end as form_n
    from w left join best using (word)
),
chain as (
    select word, form as at from forms where form is not null
    union all
    select chain.word, forms.form from chain join forms on forms.word = chain.at where forms.form is not null
),
ends as (select chain.word, chain.at as root from chain join forms on forms.word = chain.at where forms.form is null)
select word, form, coalesce(root, word) as root, n, n_near, form_n from forms left join ends using (word)
"""
