"""The corpus queries as DuckDB SQL."""

from __future__ import annotations

from studytrail.llm import linededup, mixing, quality

WORD = r"[^\x20\x09-\x0D]+"

WARC = """
with d as (
    select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), m as (
    select payload_digest, min(page_id) as first from d where payload_bytes >= 100 group by 1
)
select page_id, payload_bytes, payload_digest,
       case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
       case when first <> page_id then first end as refers_to
from d left join m using (payload_digest)
"""

NEAR_DEDUP = rf"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as ws
    from documents
), s as (
    select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
        else [array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)] end) as ss
    from w
), x as (
    select doc_id, len(ss) as n, unnest(ss) as sh from s
), p as (
    select a.doc_id as a, b.doc_id as b, count(*) as i, any_value(a.n) as na, any_value(b.n) as nb
    from x a join x b on a.sh = b.sh and a.doc_id <> b.doc_id and a.n * 100 >= b.n * 75 and b.n * 100 >= a.n * 75
    group by 1, 2
), l as (
    select a, b from p where 100 * i >= 75 * (na + nb - i)
), c(root, doc_id) as (
    select doc_id, doc_id from s
    union
    select c.root, l.b from c join l on l.a = c.doc_id
)
select doc_id, cast(any_value(n) as bigint) as n_shingles, min(root) as component_id, min(root) = doc_id as kept
from (select c.root, c.doc_id, len(s.ss) as n from c join s using (doc_id)) group by doc_id
"""

_COPIES = rf"""
    select doc_id, count(distinct p + k.range) as n_repeat_words
    from (select doc_id, p, count(*) over (partition by doc_id, g) as c from (
        select doc_id, unnest(range(len(ws) - 4)) as p,
               unnest([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)]) as g
        from w where len(ws) >= 5))
    cross join range(5) k where c > 1 group by doc_id
"""


def _chars(pattern: str) -> str:
    """Code points of the text that belong to a class."""
    return f"length(regexp_replace(t, '[^{pattern}]', '', 'g'))"


def quality_rules(rounds: int = quality.ROUNDS) -> str:
    """The measures, the votes, the rounds of expectation-maximisation as one table each, and
    the verdict."""
    bits = range(len(quality.RULES))
    mask = " + ".join(f"case when {c} then {1 << b} else 0 end" for b, (_, _, c) in enumerate(quality.RULES))
    start = quality.fit({})

    def odds(model: str) -> str:
        terms = [f"ln({model}.prior / (1 - {model}.prior))"]
        for b in bits:
            g, x = f"{model}.g{b}", f"{model}.b{b}"
            terms.append(f"case when v & {1 << b} <> 0 then ln({g} / {x}) else ln((1 - {g}) / (1 - {x})) end")
        return " + ".join(terms)

    first = ", ".join(f"cast({g!r} as double) as g{b}, cast({x!r} as double) as b{b}" for b, (g, x) in enumerate(zip(start.on_good, start.on_bad)))
    ctes = [f"m0 as materialized (select cast({start.prior!r} as double) as prior, {first})"]
    for r in range(rounds):
        weight = f"select v, n, n / (1 + exp(-({odds('m')}))) as g from pat, m{r} m"
        free, sides, k = [], [], quality.START_WEIGHT
        for b, (_, vote, _) in enumerate(quality.RULES):
            g, x = quality.START[vote]
            spoke_good = f"coalesce(sum(g) filter (where v & {1 << b} <> 0), 0)"
            spoke = f"coalesce(sum(n) filter (where v & {1 << b} <> 0), 0)"
            free.append(f"({spoke_good} + {k * g!r}) / (sum(g) + {k}) as g{b}")
            free.append(f"({spoke} - {spoke_good} + {k * x!r}) / (sum(n) - sum(g) + {k}) as b{b}")
            free.append(f"({spoke} + {k * (g + x)!r}) / (sum(n) + {2 * k}) as p{b}")
            chance = f"g{b} < b{b}" if vote == "good" else f"g{b} >= b{b}"
            sides += [f"case when {chance} then p{b} else {side}{b} end as {side}{b}" for side in "gb"]
        weight_of = quality.PRIOR_WEIGHT
        prior = f"(sum(g) + {weight_of * quality.PRIOR!r}) / (sum(n) + {weight_of}) as prior"
        ctes.append(f"m{r + 1} as materialized (select prior, {', '.join(sides)} from (select {prior}, {', '.join(free)} from ({weight})))")
    return rf"""
with w as materialized (
    select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as ws,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) as ls
    from documents
), copies as ({_COPIES}), measured as materialized (
    select doc_id, len(ws) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
           {_chars("#*$%&|<>")} as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
           coalesce(n_repeat_words, 0) as n_repeat_words, len(ls) as n_lines,
           {_chars(r"\p{L}")} as n_letters, {_chars(r"\p{Lu}")} as n_upper,
           len(list_filter(ws, lambda x: not regexp_matches(x, '[\p{{L}}\p{{N}}]'))) as n_bare,
           {_chars("!")} as n_bangs, len(list_filter(ws, lambda x: regexp_matches(x, '[.!?]\z'))) as n_ends,
           len(list_distinct(ws)) as n_distinct
    from w left join copies using (doc_id)
), votes as materialized (
    select *, {mask} as v, {quality.BASE_FAILED} as base_failed from measured
), pat as materialized (
    select v, count(*) as n from votes where not base_failed group by v
), {", ".join(ctes)}
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       cast(v as integer) as votes, not base_failed and {odds("m")} >= 0 as kept
from votes, m{rounds} m
"""


_BREAK, _MARK = "chr(57344)", "chr(57345)"
_ESCAPED = (
    f"regexp_replace(replace(text, {_BREAK}, {_BREAK} || {_MARK}), "
    r"'(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3' || " + _BREAK + r" || '\2\4', 'g')"
)

CHAT_FORMATTING = f"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('<|role|>' || role || '<|text|>' || {_ESCAPED} || '<|end|>' || chr(10))) as bigint) as formatted_chars
from c group by conv_id
"""

MIXING = f"""
with recursive sizes as (
    select coalesce(source, '') as source, count(*) as n from documents group by 1
), total as (
    select sum(n) as all_n, sum(pow(n, 0.5)) as all_w from sizes
), rates as (
    select source, round(all_n / all_w * pow(n, 0.5) / n, 9) as rate from sizes, total
), terms(source, rate, k, p, c) as (
    select source, rate, 0, exp(-rate), exp(-rate) from rates where rate > 0
    union all
    select source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) from terms
    where k < ceil(rate + 12 * sqrt(rate) + 30)
), drawn as (
    select doc_id, source, length(coalesce(text, '')) as len, text is null as no_text,
           cast('0x' || substr(md5('{mixing.SEED}|' || coalesce(cast(doc_id as varchar), '')), 1, 13) as ubigint) / {1 << 52}.0 as u
    from documents
), counted as (
    select d.doc_id, d.source, d.len, d.no_text, count(*) filter (where t.c <= d.u) as n
    from drawn d join terms t on t.source = coalesce(d.source, '')
    group by all
)
select doc_id, source, unnest(range(n)) as copy, case when no_text then null else len end as n_text from counted where n > 0
"""

_KEY = (
    "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

LINE_DEDUP = f"""
with l as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
    from documents
), k as (
    select doc_id, pos, line, {_KEY} as key from l
), shared as (
    select key from k where length(key) >= {linededup.MIN_CHARS} group by key having count(distinct doc_id) >= {linededup.MIN_DOCS}
)
select doc_id, count(*) as n_lines, count(s.key) as n_dropped,
       sha256(coalesce(string_agg(case when s.key is null then line end, chr(10) order by pos), '')) as kept_sha256
from k left join shared s on k.key = s.key group by doc_id
"""


HARD_NEGATIVES = """
with v as (
    select vec_id, embedding, label from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and coalesce(list_bool_and([coalesce(isfinite(x), false) for x in embedding]), true)
), r as (
    select row_number() over () as n, vec_id,
           case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as q
    from v
), s as (
    select a.n, a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label,
           coalesce(list_sum([a.q[i] * b.q[i] for i in range(1, least(len(a.q), len(b.q)) + 1)]), 0) as score
    from r a, r b where a.vec_id % 100 = 0
), p as (
    select n, anchor_id, anchor_label, vec_id as positive_id, score as positive_score,
           row_number() over (partition by n order by score desc, vec_id) as place
    from s where label = anchor_label and vec_id <> anchor_id
    qualify place <= 5
), f as (
    select p.n, p.place, anchor_id, positive_id, positive_score, s.vec_id as negative_id, score as negative_score,
           row_number() over (partition by p.n, place order by score desc, s.vec_id) as rank
    from p join s using (n, anchor_id)
    where s.label <> s.anchor_label and 100 * score between 80 * positive_score and 100 * positive_score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id,
       cast(positive_score as bigint) as positive_score, cast(negative_score as bigint) as negative_score
from f where rank <= 5
"""

# CRC-32 of the decimal conv_id, a byte at a time, over a table that is made eight bits at a time.
PREFIX_TRIE = """
with k as (
    select [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
            for i in range(256)] as entries
), o as (
    select conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')}
                         order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as own
    from conversations where conv_id is not null group by conv_id
), h as (
    select conv_id, own, conv_id - conv_id % 100 as base,
           xor(list_reduce(list_prepend(4294967295, [cast(ascii(c) as bigint) for c in string_split(cast(conv_id as varchar), '')]),
               lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) % 6 as h
    from o, k
), b as (
    select h.conv_id, list_concat(coalesce(m.own[1:h.h], []), h.own[h.h + 1:]) as seq from h left join o m on m.conv_id = h.base
), n as (
    select seq[1:d] as path, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs,
           sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len(seq) = d), '')) as ends_sha256
    from (select conv_id, seq, unnest(range(len(seq) + 1)) as d from b) group by 1
), c as (
    select path[1:depth - 1] as path, count(*) as n_children from n where depth > 0 group by 1
), w as (
    select n.path, depth, conv_id, n_convs, ends_sha256, coalesce(n_children, 0) as n_children,
           (n_convs - 1) * case when depth = 0 then 0 else length(n.path[depth].x) end as saved
    from n left join c on c.path = n.path
), t as (
    select path[1:d] as path, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens
    from (select path, n_children, saved, unnest(range(depth + 1)) as d from w) group by 1
)
select w.conv_id, w.depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, n_leaves,
       cast(saved_tokens as bigint) as saved_tokens, w.ends_sha256
from w join t on t.path = w.path left join w p on w.depth > 0 and p.path = w.path[1:w.depth - 1]
"""
