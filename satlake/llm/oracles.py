"""SQL for the registered queries of this subpackage."""

from __future__ import annotations

from satlake.llm import quality
from satlake.llm.hilbert import BITS, curve_states

ORACLES: dict[str, str] = {}

ORACLES["op5_url_filters"] = """
with parts as (
  select page_id,
         case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), split as (
  select page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts
), judged as (
  select page_id, host, path,
    case
      when (host = 'example.org' or host like '%.example.org') and path like '/en/1%' then 'example.org/en/1'
      when (host = 'example.org' or host like '%.example.org') and path like '/es/%' then 'example.org/es/'
      when (host = 'com' or host like '%.com') and path like '/fr/%' then 'com/fr/'
      when (host = 'com' or host like '%.com') and path like '/de/%' then 'com/de/'
      when (host = 'org' or host like '%.org') and path like '/%' then 'org/'
    end as rule
  from split
)
select page_id, host, path, rule,
       case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block' else 'allow' end as verdict
from judged
"""

ORACLES["op3_chat_formatting"] = """
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, k, case when k = 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok'
  from range(2) t(k)
)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(12 + length(role) + 1 + length(replace(replace(text, '<~', '<~~'), '<|', '<~|')) + 11) as bigint)
         as formatted_chars
from said group by conv_id
"""


def _hilbert_sql() -> str:
    states = ", ".join(
        f"({state}, {corner}, {digit}, {following})"
        for state, row in enumerate(curve_states(3))
        for corner, (digit, following) in enumerate(row)
    )
    steps, last = [], "levels"
    for bit in range(BITS - 1, -1, -1):
        corner = f"((l0 >> {bit}) & 1) | (((l1 >> {bit}) & 1) << 1) | (((l2 >> {bit}) & 1) << 2)"
        steps.append(
            f"s{bit} as (select p.* exclude (idx, state), p.idx * 8 + t.digit as idx, t.following as state"
            f" from {last} p join states t on t.state = p.state and t.corner = ({corner}))"
        )
        last = f"s{bit}"
    return f"""
with states(state, corner, digit, following) as (values {states}),
crc_table as (
  select list(list_reduce([i] || range(8),
           lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as crcs
  from range(256) t(i)
),
docs as (
  select row_number() over () as r, doc_id, lang, source, n_chars, text,
         coalesce(octet_length(encode(text)), 0) + 1 as size, hex(encode(coalesce(text, ''))) as hexed
  from documents
),
sums as (
  select docs.*,
    xor(list_reduce([4294967295::bigint] || list_transform(range(size - 1), lambda i: ('0x' || hexed[2 * i + 1 : 2 * i + 2])::bigint),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32
  from docs, crc_table
),
langs as (
  select lang as v, cast(floor(coalesce(sum(n) over (order by lang nulls first rows between unbounded preceding and 1 preceding), 0) * 32.0 / sum(n) over ()) as int) as l0
  from (select lang, count(*) as n from documents group by lang)
),
sources as (
  select source as v, cast(floor(coalesce(sum(n) over (order by source nulls first rows between unbounded preceding and 1 preceding), 0) * 32.0 / sum(n) over ()) as int) as l1
  from (select source, count(*) as n from documents group by source)
),
levels as (
  select doc_id, size, text_crc32, l0, l1,
         case when n_chars > 0 then least(31, length(ltrim(bin(n_chars), '0'))) else 0 end as l2,
         0::bigint as idx, 0 as state
  from sums join langs on langs.v is not distinct from lang join sources on sources.v is not distinct from source
),
{", ".join(steps)},
placed as (
  select doc_id, size, text_crc32, ntile(8) over w - 1 as shard, row_number() over w as n
  from {last} window w as (order by idx, doc_id, text_crc32, size)
)
select doc_id, cast(size as bigint) as size, cast(text_crc32 as bigint) as text_crc32, 'rows' as law,
       cast(shard as int) as shard, n - min(n) over (partition by shard) as slot, cast(null as int) as grown_shard
from placed
"""


ORACLES["op2_hilbert_sharding"] = _hilbert_sql()


def _quality_sql() -> str:
    votes, names = [], [f"v{i}" for i in range(len(quality.RULES))]
    for rule, v in zip(quality.RULES, names):
        m, b = rule.measure, "1" if rule.base == "one" else rule.base
        votes.append(
            f"case when {b} <= 0 then 0 when {m} * 100 < {b} * {rule.fine[0]} or {m} * 100 > {b} * {rule.fine[1]} then -1"
            f" when {m} * 100 >= {b} * {rule.good[0]} and {m} * 100 <= {b} * {rule.good[1]} then 1 else 0 end as {v}"
        )

    def weight() -> str:
        terms = ["ln(share)"] + [
            f"case {v} when -1 then ln(b{i}) when 1 then ln(1 - b{i}) else 0.0 end" for i, v in enumerate(names)
        ]
        return f"exp({' + '.join(terms)})"

    start = ", ".join(
        f"({kind}, {share}::double, {', '.join(f'{b}::double' for b in rates)})"
        for kind, (share, rates) in enumerate(zip(quality.START.shares, quality.START.bad))
    )
    rates = ", ".join(f"b{i}" for i in range(len(names)))
    models = [f"m0(kind, share, {rates}) as (values {start})"]
    for k in range(1, quality.ROUNDS + 1):
        believed = f"{quality.STRENGTH} * any_value(total) * any_value(s.share)"
        fitted = [f"(sum(mass) + {believed}) / (any_value(total) * (1 + {quality.STRENGTH})) as share"]
        for i, v in enumerate(names):
            fitted.append(
                f"(sum(case when {v} = -1 then mass else 0.0 end) + {believed} * any_value(s.b{i}))"
                f" / (sum(case when {v} <> 0 then mass else 0.0 end) + {believed}) as b{i}"
            )
        models.append(
            f"w{k} as (select kind, pattern, n, total, {', '.join(names)}, {weight()} as w from counts, m{k - 1}),"
            f" p{k} as (select *, n * w / sum(w) over (partition by pattern) as mass from w{k}),"
            f" m{k} as materialized (select p.kind, {', '.join(fitted)} from p{k} p join m0 s on s.kind = p.kind group by p.kind)"
        )
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""
with docs as materialized (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), words as materialized (
  select *, regexp_extract_all(text, '{word}') as w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{word}')) as lines
  from docs
), windows as (
  select r, pos, array_to_string(w[pos:pos + 4], ' ') as said
  from (select r, w, unnest(range(1, len(w) - 3)) as pos from words where len(w) >= 5)
), again as (
  select r, pos from (select r, pos, count(*) over (partition by r, said) as n from windows) where n > 1
), covered as (
  select r, count(distinct pos + k) as n from again, range(5) t(k) group by r
), measures as materialized (
  select words.r, doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(text) - length(regexp_replace(text, '{quality.SYMBOLS}', '', 'g')) as n_symbols,
         len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(covered.n, 0) as n_repeat_words, len(lines) as n_lines,
         length(text) - length(replace(text, '!', '')) as n_exclamations,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as n_capitals,
         length(text) - length(regexp_replace(text, '{quality.STOPS}', '', 'g')) as n_stops
  from words left join covered on covered.r = words.r
), voted as materialized (
  select *, {", ".join(votes)} from measures
), counts as materialized (
  select row_number() over () as pattern, sum(n) over () as total, * from
    (select {", ".join(names)}, count(*)::double as n from voted group by all)
),
{", ".join(models)},
final as (select pattern, {", ".join(names)}, kind, {weight()} as w from counts, m{quality.ROUNDS}),
chances as (
  select {", ".join(names)}, sum(w) filter (kind = 0) / sum(w) as p from final group by all
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words,
       n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and p >= {quality.KEEP_FROM} as kept
from voted join chances using ({", ".join(names)})
"""


ORACLES["op8_weak_supervision"] = _quality_sql()


def _importance_sql() -> str:
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
with crc_table as (
  select list(list_reduce([i] || range(8),
           lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as crcs
  from range(256) t(i)
),
docs as materialized (select row_number() over () as r, doc_id, {words} as w from documents),
said as materialized (select r, unnest(w) as word from docs),
asked as materialized (select unnest({words}) as word from benchmark),
lexicon as materialized (
  select word,
    xor(list_reduce([4294967295::bigint]
          || list_transform(range(octet_length(encode(word))), lambda i: ('0x' || hex(encode(word))[2 * i + 1 : 2 * i + 2])::bigint),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select word from said union select word from asked), crc_table
),
s as (select bucket, count(*) as n from said join lexicon using (word) group by bucket),
t as (select bucket, count(*) as n from asked join lexicon using (word) group by bucket),
totals as (select (select count(*) from said) + 10000 as s_all, (select count(*) from asked) + 10000 as t_all),
gains as materialized (
  select b as bucket,
         cast(floor(1000 * ln((coalesce(t.n, 0) + 1)::double * s_all / ((coalesce(s.n, 0) + 1)::double * t_all))) as bigint) as gain
  from range(10000) k(b) left join s on s.bucket = b left join t on t.bucket = b, totals
),
weights as (
  select r, count(*) as n, cast(floor(sum(gain)::double / count(*)) as bigint) as weight
  from said join lexicon using (word) join gains using (bucket) group by r
),
scored as (
  select docs.r, doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5) / 4294967296.0))) as bigint) as score
  from docs left join weights on weights.r = docs.r
),
able as (
  select r, row_number() over (order by score desc, doc_id nulls last, r) as place, count(*) over () as n_able
  from scored where n_features >= 20
)
select doc_id, n_features, weight, score, case when place <= 10 * n_able // 100 then place end as rank
from scored left join able using (r)
"""


ORACLES["op12_importance"] = _importance_sql()


def _part_codes_sql(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    near = "min(struct_pack(d := list_sum(list_transform(list_zip(part, entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, e := e))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} as materialized (select r, p, any_value(part) as part, {near} as best from parts join b{k} using (p) group by r, p)")
        if k < rounds:
            steps.append(
                f"m{k} as (select p, e, list(mean order by i) as entry from (select p, best.e as e, i,"
                f" cast(floor(sum(part[i])::double / count(*)) as bigint) as mean from a{k}, range(1, len(part) + 1) t(i) group by all) group by p, e),"
                f" b{k + 1} as materialized (select o.p, o.e, coalesce(m.entry, o.entry) as entry from b{k} o left join m{k} m on m.p = o.p and m.e = o.e)"
            )
    return f"""
with kept as materialized (
  select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * x::double) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
parts as materialized (
  select r, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as part from kept, range({parts}) t(p)
),
b0 as materialized (
  select p, e, part as entry
  from parts join (select r, row_number() over (order by vec_id nulls last, v) - 1 as e from kept) using (r) where e < {entries}
),
{", ".join(steps)},
coded as (
  select r, string_agg(lpad(lower(hex(best.e)), 2, '0'), '' order by p) as code, sum(best.d)::bigint as error from a{rounds} group by r
),
books as (select sha256(string_agg(array_to_string(entry, ','), ',' order by p, e)) as codebooks_sha256 from b{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from kept join coded using (r), books
"""


ORACLES["op13_part_codes"] = _part_codes_sql()
