"""The same answers in plain SQL for another engine, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CHAT = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, n, case n when 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok' from range(2) as t(n)
)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1
           + length(regexp_replace(text, '<\|(\\*)im_(start|end)\|>', '<|\\\1im_\2|>', 'g'))) as bigint) as formatted_chars
from rows
group by conv_id
"""

_EXACT = f"""
with rows as (select doc_id, {_LOWER} as normal from documents),
groups as (select normal, max(doc_id) as keep_id, count(*) as group_size from rows group by normal)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(normal) as text_sha256
from rows join groups using (normal)
"""

_DECONTAMINATE = f"""
with item_words as (
    select item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from benchmark
),
windows as (
    select distinct item_id, least(10, len(words)) as size, array_to_string(words[i + 1 : i + least(10, len(words))], ' ') as gram
    from item_words, range(greatest(len(words) - 9, 1)) as t(i)
    where len(words) > 0
),
doc_words as (
    select doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents
),
places as (
    select doc_id, size, i, array_to_string(words[i + 1 : i + size], ' ') as gram
    from doc_words, (select distinct size from windows), range(len(words) - size + 1) as t(i)
),
hits as (select doc_id, item_id, i, places.size as size from places join windows using (size, gram)),
hit_words as (select doc_id, count(distinct i + j) as n_hit from hits, range(size) as t(j) group by doc_id),
hit_items as (
    select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
    from (select distinct doc_id, cast(item_id as varchar) as name from hits) group by doc_id
)
select doc_id, len(words) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit_words using (doc_id) left join hit_items using (doc_id)
"""

#: CRC-32 of the sixteen nibbles.
_NIBBLES = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, "
    "3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8, four bits a step; bits of a byte come from the lower end."""
    spelled = f"hex(encode({text}))"
    nibbles = f"list_transform(range(length({spelled})), lambda i: instr('0123456789ABCDEF', substr({spelled}, xor(i, 1) + 1, 1)) - 1)"
    step = f"lambda c, x: xor(c >> 4, ({_NIBBLES})[(xor(c, x) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {nibbles}), {step}), 4294967295)"


_RUNS = f"""
with split as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words, {_crc32("cast(doc_id as varchar)")} as h
    from documents
),
cut as (select *, len(words) as n, h // 10 as g, case when len(words) > 0 then (h // 10) % len(words) end as a from split),
aimed as (select *, 1 + (n - a) // (3 + g % 8) as p from cut),
word as (
    select doc_id, i, words[1 + case when h % 10 = 0 and i >= a then a + (i - a) % p else i end] as w
    from aimed, range(n) as t(i)
),
pairs as (select x.doc_id as doc_id, x.i as i, y.i - x.i as q from word x join word y on x.doc_id = y.doc_id and x.w = y.w and y.i > x.i),
islands as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from pairs),
stretches as (
    select doc_id, q, min(i) as start, count(*) + q as length from islands group by doc_id, q, island
    having count(*) + q >= greatest(12, 2 * q)
),
found as (select doc_id, start, length, min(q) as period from stretches group by doc_id, start, length),
told as (
    select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as spelled,
           max(struct_pack(length := length, start := -start, period := -period)) as best
    from found group by doc_id
),
gone as (select distinct doc_id, t.i as i from found, range(start + period, start + length) as t(i)),
kept as (
    select doc_id, string_agg(w, ' ' order by i) as collapsed from word anti join gone using (doc_id, i) group by doc_id
)
select doc_id, coalesce(n_runs, 0) as n_runs, -best.start as start, best.length as length, -best.period as period,
       1000 * best.length // -best.period as exponent_milli, sha256(coalesce(spelled, '')) as runs_sha256,
       sha256(coalesce(collapsed, '')) as collapsed_sha256
from documents left join told using (doc_id) left join kept using (doc_id)
"""

_IMPORTANCE = f"""
with texts as (
    select true as is_doc, doc_id as id, text from documents union all select false, row_number() over (), text from benchmark
),
split as (
    select is_doc, id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from texts
),
spelled as (
    select is_doc, id, array_to_string(words[i + 1 : i + size], ' ') as feature
    from split, range(1, 4) as s(size), range(len(words) - size + 1) as t(i)
),
hashed as (select feature, {_crc32("feature")} % 10000 as bucket from (select distinct feature from spelled)),
counted as (
    select bucket, count(*) filter (where is_doc) as s, count(*) filter (where not is_doc) as t from spelled join hashed using (feature) group by bucket
),
totals as (select coalesce(sum(s), 0) as all_s, coalesce(sum(t), 0) as all_t from counted),
gains as (
    select bucket, cast(floor(1000 * ln((t + 1)::double * (all_s + 10000)::double / ((s + 1)::double * (all_t + 10000)::double))) as bigint) as gain
    from counted, totals
),
weights as (
    select id, cast(count(*) as bigint) as n_features, cast(sum(gain) as bigint) as weight
    from spelled join hashed using (feature) join gains using (bucket) where is_doc group by id
),
scored as (
    select id as doc_id, len(words) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
           coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::bigint + 0.5) / 4294967296))) as bigint) as score
    from split left join weights using (id) where is_doc
),
ranked as (
    select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as eligible from scored where n_words >= 20
)
select doc_id, n_features, weight, score, case when place <= 5 * eligible // 100 then place end as rank
from scored left join ranked using (doc_id)
"""

ORACLES: dict[str, str] = {
    "op5_chat_format": _CHAT, "op6_decontaminate": _DECONTAMINATE, "op8_exact_dedup": _EXACT,
    "op11_periodic_runs": _RUNS, "op13_importance_resampling": _IMPORTANCE,
}
