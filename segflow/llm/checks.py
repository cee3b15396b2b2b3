"""SQL texts that check queries of this subpackage; nothing is shared with the Spark side
but thresholds and word lists."""

from __future__ import annotations

from segflow.llm.chat import Budget
from segflow.llm.common import WORD
from segflow.llm.quality import RULES, STOP_WORDS, SYMBOLS


def quality_sql() -> str:
    stop = "|".join(sorted({w for some in STOP_WORDS.values() for w in some}))
    bounds = [f"{r.ratio} >= {r.low}" for r in RULES if r.low is not None] + [f"{r.ratio} <= {r.high}" for r in RULES if r.high is not None]
    return rf"""
with d as (select doc_id, coalesce(text, '') as text, row_number() over () as rn from documents),
w as (select rn, unnest(regexp_extract_all(text, '{WORD}')) as word, generate_subscripts(regexp_extract_all(text, '{WORD}'), 1) as i from d),
t as (select rn, i, word, lead(word, 1) over p as w1, lead(word, 2) over p as w2 from w window p as (partition by rn order by i)),
k as (select rn, i, count(*) over (partition by rn, word, w1, w2) as n from t where w2 is not null),
c as (select distinct rn, i + j as i from k, (values (0), (1), (2)) as o(j) where n > 1),
r as (select rn, count(*) as n_repeat_words from c group by rn),
l as (select rn, unnest(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}'))) as line from d),
m as (select rn, count(*) as lines, count(*) - count(distinct line) as n_dup_lines,
  count(*) filter (regexp_matches(line, '^[[:space:]]*[-*•]')) as bullets,
  count(*) filter (regexp_matches(line, '(?:\.\.\.|…)[[:space:]]*$')) as ellipses from l group by rn),
n as (select rn, count(*) as n_words, sum(length(word)) as word_chars, count(*) filter (regexp_matches(word, '\pL')) as letters,
  count(*) filter (regexp_matches(word, '(?i)^(?:{stop})[.,;:!?]*$')) as stops from w group by rn),
f as (select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
  len(regexp_extract_all(text, '{SYMBOLS}'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
  coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(letters, 0) as letters, coalesce(stops, 0) as stops,
  coalesce(lines, 0) as lines, coalesce(bullets, 0) as bullets, coalesce(ellipses, 0) as ellipses
  from d left join n using (rn) left join m using (rn) left join r using (rn)),
g as (select *, n_words as words, word_chars / greatest(n_words, 1) as word_length, n_symbols / greatest(n_words, 1) as symbol_ratio,
  stops / greatest(n_words, 1) as stop_ratio, letters / greatest(n_words, 1) as letter_ratio, bullets / greatest(lines, 1) as bullet_ratio,
  ellipses / greatest(lines, 1) as ellipsis_ratio, n_dup_lines / greatest(lines, 1) as duplicate_line_ratio,
  (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {" and ".join(bounds)} as kept from g
""".replace("\\\\", "\\")


def chat_sql() -> str:
    b = Budget()
    made = r"'\### Assistant: </turn> ok'"
    return rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', {made}), (-7, 1, 'assistant', {made})),
n as (select *, row_number() over w - 1 as seq, (length(text) + 3) // 4 + 4 as size,
  length('<turn:></turn>') + 1 + 2 * length(role || text) - length(translate(role || text, '\<>', '')) as chars
  from c window w as (partition by conv_id order by turn, role, text)),
t as (select *, coalesce(sum(size) over (partition by conv_id order by seq rows between unbounded preceding and 1 preceding), 0)::bigint as b from n),
s as (select conv_id, b // {b.stride} as bin, b + size > (b // {b.stride} + 1) * {b.stride} as crosses, min(seq) as first, min(b) as origin from t group by all),
h as (select s.conv_id, sum(t.chars) as chars from s join t on s.conv_id = t.conv_id and t.seq < s.first
  and (t.b >= s.origin - {b.history} and t.size <= {b.history} or t.seq = 0 and t.role = 'system') group by all)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by seq)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by seq) filter (role = 'assistant'), '')) as loss_sha256,
  (sum(t.chars) + coalesce(any_value(h.chars), 0))::bigint as formatted_chars
from t left join h using (conv_id) group by conv_id
"""


def collocation_sql(support: int = 100, longest: int = 5, first: int = 2000) -> str:
    lengths = range(2, longest + 1)
    leads = ", ".join(f"lead(w, {i}) over p as w{i}" for i in range(1, longest))
    grams = " union all ".join(
        ["select lang, 1 as k, w as phrase from t"]
        + [f"select lang, {k}, concat_ws(' ', w, {', '.join(f'w{i}' for i in range(1, k))}) from t where w{k - 1} is not null" for k in lengths]
    )
    cuts = " union all ".join(
        f"select lang, phrase, k, n as a, {c} as c, array_to_string(string_split(phrase, ' ')[:{c}], ' ') as p1, array_to_string(string_split(phrase, ' ')[{c + 1}:], ' ') as p2 from f where k = {k}"
        for k in lengths
        for c in range(1, k)
    )
    inner = " union all ".join(
        f"select lang, n, array_to_string(string_split(phrase, ' ')[{at}:{at + size - 1}], ' ') as phrase from f where k = {k}"
        for k in range(3, longest + 1)
        for size in range(2, k)
        for at in range(1, k - size + 2)
    )
    return rf"""
with d as (select row_number() over () as rn, coalesce(lang, 'und') as lang,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
s as (select rn, lang, unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')) as piece, generate_subscripts(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+'), 1) as i from d),
x as (select rn, lang, i, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) as w, generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) as j from s),
t as (select lang, w, {leads} from x window p as (partition by rn, i order by j)),
g as ({grams}),
f as (select lang, k, phrase, count(*) as n from g group by all having count(*) >= {support}),
m as (select lang, count(*) as n from x group by lang),
c as ({cuts}),
v as (select c.lang, c.phrase, c.a, l.n as l, r.n as r, m.n, c.c, ((1000::hugeint * c.a * m.n) // (l.n::hugeint * r.n))::bigint as score
  from c join f l on l.lang = c.lang and l.phrase = c.p1 join f r on r.lang = c.lang and r.phrase = c.p2 join m on m.lang = c.lang),
b as (select * from v qualify row_number() over (partition by lang, phrase order by score, c) = 1),
o as (select lang, phrase, max(n) as most from ({inner}) group by all),
k as (select b.* from b left join o using (lang, phrase) where o.most is null or 100 * o.most < 100 * b.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score
from k qualify rank <= {first}
"""


def exact_search_sql(k: int = 5, each: int = 50) -> str:
    return f"""
with e as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::hugeint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, 1 + least(len(q.v), len(c.v))), lambda i: q.v[i] * c.v[i])), 0)::bigint as score
  from e q join e c on c.vec_id <> q.vec_id where q.vec_id % {each} = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score from s qualify rank <= {k}
"""


def lexical_sql(k: int = 50) -> str:
    terms = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
with t as (select rn, doc_id, unnest({terms}) as term from (select row_number() over () as rn, doc_id, text from documents)),
p as (select rn, any_value(doc_id) as doc_id, term, count(*) as tf from t group by rn, term),
n as (select rn, sum(tf)::bigint as n from p group by rn),
g as (select count(*) as docs, sum(n)::bigint as len from n),
q as (select distinct item_id, unnest({terms}) as term from benchmark),
w as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
  from (select term, count(*) as df from p where term in (select term from q) group by term), g),
s as (select q.item_id, p.rn, any_value(p.doc_id) as doc_id,
  sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + ((50 * n.n * g.docs) // g.len)))))::bigint as score
  from q join w using (term) join p using (term) join n on n.rn = p.rn, g group by q.item_id, p.rn)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score from s where score > 0 qualify rank <= {k}
"""
