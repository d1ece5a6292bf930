"""DuckDB SQL with the meaning of each registered query, over the same tables."""

from __future__ import annotations

import keyword

from loomline.functions import fixed_values as fv
from loomline.operators import code_style
from loomline.plans.queries import (
    BLOCK,
    CODE_LANGUAGE,
    DATASET_LANGUAGE,
    FILE_NAMES,
    GRID,
    GRID_TARGET,
    PACKED_ROW,
    RUNS,
    SAFE_SHARE,
    TOKENS_PER_STEP,
    UNSAFE_SHARE,
    VAL_RATIO,
)


def h(salt, key: str) -> str:
    return f"('0x' || substring(md5('{salt}:' || ({key})::varchar), 1, 15))::bigint"


def u(salt, key: str) -> str:
    return f"(({h(salt, key)})::double / {float(1 << 60)!r}::double)"


def byte_list(text: str) -> str:
    return (
        f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda z: ('0x' || z)::int)"
    )


def word_list(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+')"


def joined(tokens: str) -> str:
    return f"array_to_string({tokens}, ' ')"


def case(key: str, table: dict, default: str = "null") -> str:
    whens = " ".join(f"when '{k}' then {v!r}" for k, v in table.items())
    return f"case {key} {whens} else {default} end"


SPLIT = f"""
split_docs as (
  select *, case when row_number() over (order by {h(42, 'doc_id')}, doc_id)
      <= greatest(1, floor(count(*) over () * {VAL_RATIO}::double)) then 'val' else 'train' end as split
  from documents)"""

SPANS = f"""{SPLIT},
spans as (
  select *, (sum(len(tokens)) over (partition by split order by {h(42, 'doc_id')}, doc_id)
      - len(tokens))::bigint as start
  from (select doc_id, split, list_append({byte_list('text')}, {fv.EOT}) as tokens from split_docs))"""

STREAM = f"""{SPANS},
stream as (
  select split, start + unnest(range(len(tokens))) as pos, unnest(tokens) as token from spans)"""

DRAWN = f"""{STREAM},
sizes as (select split, count(*) as n from stream group by split),
draws as (
  select doc_id as draw, split, {h('42:block', 'doc_id')} % (n - {BLOCK}) as start
  from documents join sizes on split = case when doc_id % 4 = 0 then 'val' else 'train' end),
wanted as (select draw, split, start, start + unnest(range({BLOCK} + 1)) as pos from draws),
windows as (
  select draw, split, start, list(token order by pos) as tokens
  from wanted join stream using (split, pos) group by draw, split, start)"""

PIECES = f""", numbered as (
  select *, row_number() over (partition by split order by start) - 1 as doc_no from spans),
pieces as (
  select split, doc_no, start + unnest(range(len(tokens))) as pos, unnest(tokens) as token,
    ((start + unnest(range(len(tokens)))) // {BLOCK} - start // {BLOCK}) // 8 as piece_no
  from numbered)"""


def fim(source: str, key: str) -> str:
    """CTEs ending in ``fim(key, mode, tokens)`` over ``source(key, tokens)``."""
    n = "len(tokens)"
    return f"""
cuts as (
  select {key}, tokens,
    case when {n} < 3 or {u('42:fim_apply', key)} >= 0.5 then 'none'
         when {u('42:fim_mode', key)} < 0.5 then 'spm' else 'psm' end as mode,
    1 + {h('42:fim_cut1', key)} % greatest({n} - 1, 1) as c1,
    1 + {h('42:fim_cut2', key)} % greatest({n} - 2, 1) as c2
  from {source}),
ordered as (
  select *, least(c1, c2 + (c2 >= c1)::int) as a, greatest(c1, c2 + (c2 >= c1)::int) as b from cuts),
parts as (
  select *, list_prepend({fv.FIM_PREFIX}, tokens[1:a]) as prefix,
    list_prepend({fv.FIM_MIDDLE}, tokens[a + 1 : b]) as middle,
    list_prepend({fv.FIM_SUFFIX}, tokens[b + 1 :]) as suffix
  from ordered),
fim as (
  select {key}, mode, case mode
    when 'psm' then list_concat(list_concat(prefix, suffix), middle)
    when 'spm' then list_concat(list_concat(suffix, prefix), middle) else tokens end as tokens
  from parts)"""


CODE_DOCS = f"code_docs as (select doc_id, text, {case('lang', CODE_LANGUAGE)} as lang from documents)"
LANG_ID = case("lang", fv.LANGUAGE_IDS)
OPENING = (
    f"case when {LANG_ID} is null then [{fv.CODE_START}] else [{fv.CODE_START}, {LANG_ID}] end"
)

WORDS = f"words as (select *, unnest({word_list('text')}) as word from documents)"
PAIRS = f"""
listed as (select doc_id, lang, {word_list('text')} as w from documents),
occurrences as (
  select lang, unnest(w[1 : len(w) - 1]) as token, unnest(w[2 : len(w)]) as next_token
  from listed where len(w) > 1)"""

SCORED = f"""{SPLIT},
doc_words as (
  select split, doc_id % 20 as batch, unnest({word_list('text')}) as word from split_docs),
by_batch as (select split, batch, word, count(*) as n from doc_words group by all),
overall as (select word, sum(n) as all_n from by_batch group by word),
scored as (
  select split, batch, n, -ln(all_n / (select sum(all_n) from overall)) as nats,
    octet_length(encode(word)) as nbytes
  from by_batch join overall using (word)
  union all
  select split, doc_id % 20, count(*), 1.0, 0 from split_docs group by all)"""

SCORES = f"""{WORDS},
scores as (
  select lang as grp, word as item, ln(count(*)) as logit,
    {h('seen', 'word')} % 10 = 0 as seen
  from words group by lang, word)"""


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def literals(values) -> str:
    return ", ".join(literal(v) for v in values)


def matches(token: str, pattern: str) -> str:
    return f"regexp_matches({token}, {literal(pattern)})"


def n_tokens(condition: str) -> str:
    return f"len(list_filter(t, lambda x: {condition}))"


#: The documents as source texts, and their tokens with the line break before each text.
LEXED = f"""
code_texts as (
  select doc_id, 'import os' || chr(10) || chr(10) || 'def part(a1, name):' || chr(10) || '    \"\"\"Part of '
    || coalesce(lang, '') || '\"\"\"' || chr(10) || '    return f''{{a1}} # {{name}}''' || chr(10)
    || case when {h('print', 'doc_id')} % 2 = 0
      then replace(assigned, '. ', chr(10) || chr(9) || 'print(name, "# none")' || chr(10) || '    ')
      else assigned end as text
  from (select doc_id, lang, regexp_replace(text, '([a-z]{{4,}}) ([a-z]{{4,}})',
    '\\1 = \\2.strip(tmp2)  # \\1', 'g') as assigned from documents)),
lexed as (
  select doc_id, text, regexp_extract_all(chr(10) || coalesce(text, ''), {literal(code_style.LEXER)}) as t
  from code_texts)"""


def candidates(score: str, top_k: int | None, top_p: float) -> str:
    ranked = f"select grp, item, {score} as score from scores"
    if top_k is not None:
        ranked += f" qualify rank() over (partition by grp order by score desc) <= {top_k}"
    return f"""with {SCORES},
ranked as ({ranked}),
weighed as (
  select *, exp(score - max(score) over (partition by grp)) as mass from ranked),
summed as (
  select *, sum(mass) over (partition by grp order by score desc, item
      rows between unbounded preceding and current row) - mass as before,
    sum(mass) over (partition by grp) as total from weighed),
kept as (
  select grp, item, mass, before, sum(mass) over (partition by grp) as total
  from summed where before <= {top_p}::double * total + 1e-9)
select grp, item, round(mass / total, 9) as prob,
  before <= {u('42:draw', 'grp')} * total and {u('42:draw', 'grp')} * total < before + mass as drawn
from kept"""


STEPS = """steps as (
  select user_id as run, value as seconds, value / 3 as loss, value / 7 as mfu,
    row_number() over (partition by user_id order by ts, event_id) - 1 as step
  from events)"""

DAMAGED = f"""damaged as (
  select *, {h('bad', 'doc_id')} % 10 as kind, octet_length(encode(text)) as n_bytes from documents)"""

FITTING = "length(text) > 100 and length(text) < 50000"


def capped(limit: int) -> str:
    return f"""select doc_id, lang from documents
where {FITTING} and lang in ('en', 'de', 'fr')
qualify row_number() over (partition by lang order by doc_id) <= {limit}"""


NOT_BLANK_CHAR = (
    r"[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # --- sources and sinks
    q["scan_code_tree"] = f"""
with named as (
  select source, doc_id, text, {h('tree', 'doc_id')} % 8 as kind,
    octet_length(encode(text)) as size from documents)
select source || '/' || case kind when 0 then 'd' || doc_id || '/__init__.py'
    when 4 then 'tests/test_' || doc_id || '.py' else 'm' || doc_id || '.py' end as path,
  size, md5(text) as content_md5
from named where kind in (0, 4, 6, 7) and size between 100 and 100000"""
    q["scan_samples"] = f"""
select doc_id, case when {h('absent', 'doc_id')} % 10 = 0 then '' else text end as content
from documents"""
    q["select_shards"] = """
with names as (select distinct source from documents where source <> 'src7' order by source limit 5)
select doc_id, source, case when source = 'src7' then 'val' else 'train' end as split
from documents where source = 'src7' or source in (select source from names)"""
    q["combine_sources"] = """
select 'd' || doc_id as id, text, 'local' as origin from documents
union all
select 'c-' || conv_id || '-' || turn, text, 'remote' from conversations"""
    q["write_token_dataset"] = f"""
with {SPLIT}
select split, count(*) as n_docs, sum(octet_length(encode(text)) + 1)::bigint as n_tokens
from split_docs group by split"""
    block_digest = f"""
select split, pos // {{size}} as block_no, count(*)::int as n_tokens,
  md5(string_agg(token::varchar, ' ' order by pos)) as tokens_md5
from stream group by all"""
    q["read_token_dataset"] = f"with {STREAM} {block_digest.format(size=1024)}"
    q["corpus_meta"] = f"""
with {SPLIT}, counted as (select *, octet_length(encode(text)) + 1 as n from split_docs)
select (sum(n) filter (split = 'train'))::bigint as num_train_tokens,
  (sum(n) filter (split = 'val'))::bigint as num_val_tokens,
  count(*) filter (split = 'train') as num_train_docs,
  count(*) filter (split = 'val') as num_val_docs,
  string_agg(distinct lang, ',' order by lang) as languages,
  count(distinct source) filter (split = 'train') as num_train_shards,
  {fv.CODE_VOCAB_SIZE}::int as vocab_size, 'bytes' as tokenizer
from counted"""

    # --- filters, caps, quarantine
    q["filter_paths"] = """
select page_id, url from pages where not contains(url, 'ref=x') and not contains(url, '/fr/')"""
    q["filter_byte_size"] = """
select doc_id, octet_length(encode(text))::int as n_bytes from documents
where octet_length(encode(text)) between 100 and 100000"""
    q["filter_utf8"] = f"""
with {DAMAGED}
select doc_id, (n_bytes + case kind when 1 then 1 when 2 then 2 else 0 end)::int as size,
  md5(regexp_replace(text, '\\r\\n?', chr(10), 'g')) as text_md5
from damaged
where not (kind = 0 or (kind = 1 and n_bytes < {fv.UTF8_PROBE_BYTES})
  or (kind = 2 and n_bytes + 2 <= {fv.UTF8_PROBE_BYTES} and length(text) < 100))"""
    q["filter_char_length"] = f"""
select doc_id, length(text)::int as n_chars from documents where {FITTING}"""
    q["filter_blank"] = f"""
with planted as (
  select doc_id, case {h('blank', 'doc_id')} % 10 when 0 then '   ' || chr(9) || chr(10)
    when 1 then chr(28) || chr(31) || ' ' || chr(11) when 2 then '' when 3 then chr(8203)
    when 4 then null else text end as text
  from documents)
select doc_id, length(text)::int as n_chars from planted
where regexp_matches(text, '{NOT_BLANK_CHAR}')"""
    q["cap_examined"] = f"""
select doc_id, lang from (select * from documents order by doc_id limit 300) where {FITTING}"""
    q["cap_per_language"] = capped(120)
    q["select_languages"] = f"""
with named as (select doc_id, {case('lang', DATASET_LANGUAGE)} as dataset_lang from documents)
select doc_id, dataset_lang, case dataset_lang when 'c++' then 'cpp' else dataset_lang end as lang
from named where dataset_lang in ('python', 'c++', 'haskell', 'perl')"""
    q["quarantine_failures"] = f"""
with {DAMAGED}
select doc_id, case when kind >= 3 then md5({joined(byte_list('text'))}) end as tokens_md5,
  case when kind < 3 then 'UnicodeDecodeError' end as error
from damaged"""
    q["quarantine_report"] = f"""
with {DAMAGED}
select case when kind < 3 then 'UnicodeDecodeError' else 'ok' end as outcome, count(*) as n_rows,
  coalesce(sum(n_bytes) filter (kind >= 3), 0)::bigint as n_tokens
from damaged group by 1"""

    # --- text, tokens, prompts
    endings = "[" + ", ".join(f"'{e}'" for e in FILE_NAMES) + "]"
    q["detect_language"] = f"""
with paths as (
  select doc_id, 'v1.2/' || source || '/' ||
    case when {h('dot', 'doc_id')} % 10 = 0 then '.' else '' end || 'File' || doc_id ||
    {endings}[({h('ext', 'doc_id')} % {len(FILE_NAMES)}) + 1] as path
  from documents),
extended as (select *, lower(regexp_extract(path, '/\\.*[^./][^/]*(\\.[^./]*)$', 1)) as ext from paths)
select doc_id, path, {case('ext', fv.EXTENSION_LANGUAGE, "'other'")} as lang from extended"""
    q["lang_token_id"] = f"""
with {CODE_DOCS}
select doc_id, lang, coalesce({LANG_ID}, {fv.OTHER_LANGUAGE})::int as lang_id from code_docs"""
    q["encode_document"] = f"""
with {CODE_DOCS}, encoded as (
  select doc_id, list_concat(list_concat({OPENING}, {byte_list('text')}),
    [{fv.CODE_END}, {fv.EOT}]) as tokens from code_docs)
select doc_id, len(tokens)::int as n_tokens, {joined('tokens')} as tokens_text from encoded"""
    q["tokenize_corpus"] = f"""
with encoded as (select doc_id, text, {byte_list('text')} as tokens from documents)
select doc_id, len(tokens)::int as n_tokens,
  round(length(text) / len(tokens)::double, 9) as chars_per_token,
  md5({joined('tokens')}) as tokens_md5
from encoded"""
    q["detokenize_audit"] = f"""
with sized as (
  select doc_id, hex(encode(coalesce(text, ''))) as hexed, octet_length(encode(coalesce(text, ''))) as n
  from documents),
cut as (select *, {h('cut', 'doc_id')} % greatest(n, 1) + 1 as spot from sized)
select doc_id, not (spot < n and substring(hexed, (2 * spot + 1)::bigint, 1) in ('8', '9', 'A', 'B'))
    as ok_in_runs, true as ok_raw
from cut"""
    q["build_completion_prompt"] = f"""
with {CODE_DOCS}
select doc_id, {joined(f"list_concat({OPENING}, {byte_list('text')})")} as prompt_text
from code_docs"""
    q["build_fim_prompt"] = f"""
with halves as (
  select doc_id, text[1 : length(text) // 2] as prefix, text[length(text) // 2 + 1 :] as suffix
  from documents),
encoded as (
  select doc_id, list_concat(list_concat(list_concat(list_concat([{fv.FIM_PREFIX}],
    {byte_list('prefix')}), [{fv.FIM_SUFFIX}]), {byte_list('suffix')}), [{fv.FIM_MIDDLE}]) as tokens
  from halves)
select doc_id, {joined('tokens')} as prompt_text from encoded"""
    q["truncate_at_stop"] = f"""
with encoded as (select doc_id, text, {byte_list('text')} as tokens from documents)
select doc_id,
  md5({joined(f"case when {h('open', 'doc_id')} % 4 = 0 then tokens else tokens[1 : {h('cut', 'doc_id')} % (len(tokens) + 1)] end")})
    as kept_md5,
  split_part(replace(text, '. ', '.' || repeat(chr(10), 3)), repeat(chr(10), 3), 1) as kept_text
from encoded"""
    q["conversation_context"] = f"""
with pieces as (
  select *, case when role = 'user' and coalesce(bool_or(text <> '') over (
      partition by conv_id order by turn rows between unbounded preceding and 1 preceding), false)
    then chr(10) || text else text end as piece
  from conversations)
select conv_id, turn, right(string_agg(piece, '') over (partition by conv_id order by turn),
  {3 * BLOCK}) as context
from pieces"""

    # --- sequence assembly
    q["shuffle_documents"] = f"""
select doc_id, row_number() over (order by {h(42, 'doc_id')}, doc_id) - 1 as position, text
from documents"""
    q["split_train_val"] = f"with {SPLIT} select doc_id, split from split_docs"
    q["flatten_token_stream"] = f"""
with {STREAM}
select split, pos // 1024 as stretch, count(*) as n_tokens, sum(token)::bigint as token_sum,
  sum(token * (pos % 1024 + 1))::bigint as weighted_sum
from stream group by all"""
    q["split_stream_at_eot"] = f"""
with {SPANS}
{PIECES}
select split, doc_no, piece_no, count(*)::int as n_tokens,
  md5(string_agg(token::varchar, ' ' order by pos)) as tokens_md5
from pieces group by split, doc_no, piece_no"""
    q["stream_documents"] = f"""
with {SPANS}
{PIECES}
select split, doc_no, count(distinct piece_no) as n_pieces, count(*) as n_tokens
from pieces group by split, doc_no"""
    q["sample_blocks"] = f"""
with {DRAWN} select split, draw, start, {joined('tokens')} as tokens_text from windows"""
    q["lm_pairs"] = f"""
with {DRAWN}
select draw, {joined(f'tokens[1:{BLOCK}]')} as x_text, {joined('tokens[2:]')} as y_text from windows"""
    q["fim_transform"] = f"""
with encoded as (select doc_id, {byte_list('text')} as tokens from documents), {fim('encoded', 'doc_id')}
select doc_id, mode, md5({joined('tokens')}) as tokens_md5 from fim"""
    q["fim_pad_mask"] = f"""
with {STREAM},
packed as (
  select pos // {BLOCK} as block_no, list(token order by pos) as tokens
  from stream where split = 'train' group by 1), {fim('packed', 'block_no')},
fitted as (select block_no, mode, list_resize(tokens, {BLOCK}, {fv.FIM_PAD}) as t from fim)
select block_no, mode, md5({joined(f't[1:{BLOCK - 1}]')}) as x_md5,
  md5({joined(f"list_transform(t[2:], lambda v: case when v = {fv.FIM_PAD} then -1 else v end)")}) as y_md5
from fitted"""
    q["pack_concat"] = f"with {STREAM} {block_digest.format(size=BLOCK)}"

    # --- statistics
    q["corpus_stats"] = f"""
with kept as (
  select *, octet_length(encode(text)) as n from documents
  where regexp_matches(text, '{NOT_BLANK_CHAR}') and {FITTING}
    and octet_length(encode(text)) between 100 and 100000),
split_kept as (
  select *, case when row_number() over (order by {h(42, 'doc_id')}, doc_id)
    <= greatest(1, floor(count(*) over () * {VAL_RATIO}::double)) then 'val' else 'train' end as split
  from kept)
select split, lang, count(*) as n_docs, sum(n)::bigint as n_tokens, sum(n)::bigint as n_bytes
from split_kept group by rollup (split, lang)"""
    q["filter_funnel"] = f"""
with flags as (
  select regexp_matches(text, '{NOT_BLANK_CHAR}') as a,
    octet_length(encode(text)) between 100 and 100000 as b, {FITTING} as c, lang = 'en' as d
  from documents)
select 0::int as stage_no, 'input' as stage, count(*) as rows_left from flags
union all select 1, 'not_blank', count(*) from flags where a
union all select 2, 'byte_size', count(*) from flags where a and b
union all select 3, 'char_length', count(*) from flags where a and b and c
union all select 4, 'english', count(*) from flags where a and b and c and d"""
    q["token_frequency"] = f"""
with {WORDS}
select word as token, count(*) as n, row_number() over (order by count(*) desc, word) as rank
from words group by word"""
    q["dominance_audit"] = f"""
with {SPLIT}, counts as (
  select split, word, count(*) as n
  from (select split, unnest({word_list('text')}) as word from split_docs) group by all),
best as (
  select split, word as top_token, n as top_n from counts
  qualify row_number() over (partition by split order by n desc, word desc) = 1),
totals as (select split, sum(n) as n_tokens from counts group by split)
select split, top_token, top_n, n_tokens::bigint as n_tokens,
  round(top_n / n_tokens::double, 9) as share,
  round(coalesce((select n from counts c where c.split = totals.split and c.word =
    (select top_token from best b where b.split = 'train')), 0) / n_tokens::double, 9) as constant_share
from best join totals using (split)"""
    q["next_token_counts"] = f"""
with {PAIRS} select token, next_token, count(*) as n from occurrences group by all"""
    q["next_token_topk"] = f"""
with {PAIRS}, counts as (select token, next_token, count(*) as n from occurrences group by all)
select token, row_number() over (partition by token order by n desc, next_token)::int as rank,
  next_token, n, round(n / sum(n) over (partition by token), 9) as prob
from counts qualify rank <= 5"""
    q["sample_candidates"] = candidates(
        "case when seen then logit / 0.8::double / 1.2::double else logit / 0.8::double end", 50, 0.9
    )
    q["sample_candidates_open"] = candidates("logit", None, 0.7)
    q["sample_candidates_greedy"] = f"""
with {SCORES} select grp, item from scores
qualify row_number() over (partition by grp order by logit desc, item desc) = 1"""
    q["split_loss"] = f"""
with {SCORED}, per_batch as (
  select split, batch, sum(nats * n) / sum(n) as loss from scored group by all)
select split, round(avg(loss), 9) as loss_nats, count(*) as n_batches from per_batch group by split"""
    q["perplexity_by_class"] = f"""
with {PAIRS},
per_class as (select lang, token, next_token, count(*) as n from occurrences group by all),
pair_n as (select token, next_token, sum(n) as ab from per_class group by all),
context_n as (select token, sum(n) as a from per_class group by token),
vocabulary as (
  select count(distinct word) as v from (select unnest({word_list('text')}) as word from documents)),
scored as (
  select lang, n, -ln((ab + 1) / (a + v)::double) as nats
  from per_class join pair_n using (token, next_token) join context_n using (token), vocabulary)
select lang, sum(n)::bigint as n_pairs, round(sum(n * nats) / sum(n), 8) as mean_nats,
  round(exp(sum(n * nats) / sum(n)), 4) as perplexity
from scored group by lang"""
    q["bits_per_byte"] = f"""
with {SCORED}
select split, sum(nbytes * n)::bigint as total_bytes,
  round(sum(nats * n) filter (nbytes > 0) / (ln(2) * sum(nbytes * n)), 9) as bits_per_byte
from scored group by split"""
    q["compression_report"] = f"""
with {SCORED}, means as (
  select split, sum(n)::bigint as n_tokens, sum(nats * n) / sum(n) / ln(2) as bits
  from scored group by split)
select split, n_tokens, round(bits, 8) as bits_per_token,
  round(log2({fv.CODE_VOCAB_SIZE}), 8) as uniform_bits,
  round(log2({fv.CODE_VOCAB_SIZE}) / bits, 8) as compression_ratio
from means"""
    runs = ", ".join(f"('{name}', {params}::bigint)" for name, params in RUNS)
    q["token_budget"] = f"""
with on_hand as (select sum(len({word_list('text')}))::bigint as n from documents)
select run, n_params, n_params * 20 as tokens_required, n as tokens_on_hand,
  round(n_params * 20 / n::double, 6) as shortfall_factor, n >= n_params * 20 as enough
from (values {runs}) t(run, n_params), on_hand"""

    # --- telemetry
    q["parse_run_log"] = """
select event_id,
  case event_type when 'click' then 'iter' when 'view' then 'eval' when 'purchase' then 'step'
    when 'signup' then case when event_id % 3 <> 1 then 'summary' end end as shape,
  case when event_type in ('click', 'view', 'purchase') then event_id end as step,
  case when event_type in ('click', 'purchase') then value end as loss,
  case when event_type = 'view' then value end as train_loss,
  event_type = 'view' as val_is_nan,
  case event_type when 'click' then value when 'purchase' then 812.0 end as time_ms,
  case event_type when 'click' then 3.25::double when 'purchase' then 9.9::double end as mfu,
  case when event_type = 'purchase' then 1234567::bigint end as tok_per_sec,
  case when event_type = 'purchase' then 2::bigint end as epoch,
  case when event_type = 'signup' then case event_id % 3 when 0 then 'val_bpb' when 2 then 'depth' end end as key,
  case when event_type = 'signup' and event_id % 3 <> 1 then printf('%.4f', value) end as value
from events"""
    q["smoothed_loss"] = f"""
with {STEPS},
alive as (
  select *, loss > 100 as failed from steps
  qualify not coalesce(bool_or(loss > 100) over (
    partition by run order by step rows between unbounded preceding and 1 preceding), false)),
folded as (
  select t.run, t.step, t.failed, sum((1 - 0.9::double) * s.loss * pow(0.9::double, t.step - s.step)) as ema
  from alive t join alive s on s.run = t.run and s.step <= t.step group by all)
select run, step, failed,
  case when not failed then round(ema / (1 - pow(0.9::double, step + 1)), 6) end as smoothed
from folded"""
    q["smoothed_mfu"] = f"""
with {STEPS}
select t.run, t.step, case when t.step < 5 then -1.0::double else
  round(sum(s.mfu * pow(0.9::double, t.step - s.step)
    * case when s.step = 5 then 1.0::double else 1 - 0.9::double end) filter (s.step >= 5), 6) end as running_mfu
from steps t join steps s on s.run = t.run and s.step <= t.step group by t.run, t.step"""
    q["best_checkpoint"] = f"""
with {STEPS}, scanned as (
  select run, step, known as val_loss, min(known) over (partition by run order by step
    rows between unbounded preceding and 1 preceding) as before
  from (select run, step, case when step % 10 <> 0 then loss end as known from steps))
select run, step, coalesce(val_loss, -1.0::double) as val_loss, least(val_loss, before) as best_val_loss,
  coalesce(val_loss is not null and (before is null or val_loss < before), false) as improved,
  coalesce(val_loss is not null and (before is null or val_loss < before), false) and step > 0 as saved
from scanned"""
    q["throughput"] = f"""
with {STEPS}
select run, count(*) as n_steps, count(*) filter (step > 10) as timed_steps,
  round(sum(seconds) filter (step > 10), 6) as timed_seconds,
  round(count(*) filter (step > 10) * {TOKENS_PER_STEP}
    / nullif(sum(seconds) filter (step > 10), 0), 4) as tokens_per_second
from steps group by run"""
    q["run_comparison"] = f"""
with wide as (
  select user_id as run, avg(value / 30) filter ({h('split', 'event_id')} % 5 <> 0) as t,
    avg(value / 30) filter ({h('split', 'event_id')} % 5 = 0) as v
  from events group by 1)
select run, round(t, 7) as train_loss, round(v, 7) as val_loss, round(v - t, 7) as gap,
  round(exp(t), 7) as train_perplexity, round(exp(v), 7) as val_perplexity
from wide"""

    # --- instruction data and prompts
    q["dedup_exact"] = """
select min(doc_id) as doc_id, arg_min(lang, doc_id) as lang from documents group by text"""
    q["chat_template"] = """
select conv_id, turn, '<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) as piece
from conversations
union all
select conv_id, max(turn) + 1, '<|im_start|>assistant' || chr(10) from conversations group by conv_id"""
    q["sft_examples"] = f"""
with coded as (select conv_id, turn, role, {byte_list("coalesce(text, '')")} as tokens from conversations),
pairs as (
  select a.conv_id, a.turn, list_concat(a.tokens, b.tokens) as tokens,
    list_concat(list_transform(a.tokens, lambda t: -1), b.tokens) as labels
  from coded a join coded b on a.conv_id = b.conv_id and b.turn = a.turn + 1
  where a.role = 'user' and b.role = 'assistant')
select conv_id, turn, len(tokens)::int as n_tokens, md5({joined('tokens')}) as tokens_md5,
  md5({joined('labels')}) as labels_md5 from pairs"""
    q["best_worst_pairs"] = """
with scored as (
  select source, doc_id, len(string_split(text, ' '))::double / len(string_split(text, chr(10))) as score
  from documents),
placed as (
  select *, row_number() over (partition by source order by score desc, doc_id) as b,
    row_number() over (partition by source order by score, doc_id) as w from scored)
select x.source, x.doc_id as chosen, y.doc_id as rejected, x.score as best_score, y.score as worst_score
from placed x join placed y on x.source = y.source and x.b = 1 and y.w = 1 where x.score > y.score"""
    q["stratified_holdout"] = f"""
select doc_id, lang, row_number() over (
  partition by lang order by {h('42:holdout', 'doc_id')}, doc_id) <= 50 as holdout from documents"""
    q["chunk_sliding"] = f"""
with coded as (select doc_id, {byte_list('text')} as tokens from documents where text <> ''),
cut as (select doc_id, tokens, unnest(range(0, len(tokens), 256)) as start from coded),
chunks as (select doc_id, start, tokens[start + 1 : start + 512] as chunk from cut)
select doc_id, (start // 256)::int as chunk_no, start::int as start, len(chunk)::int as n_tokens,
  md5({joined('chunk')}) as chunk_md5 from chunks"""
    retrieved = f"""
worded as (select source, doc_id, string_split(text, ' ') as words from documents),
chunks as (
  select source, doc_id, (start // 32)::int as chunk_no, words[start + 1 : start + 64] as chunk
  from (select *, unnest(range(0, len(words), 32)) as start from worded)),
ranked as (
  select source, doc_id, chunk_no, array_to_string(chunk, ' ') as chunk, len(chunk) as length,
    row_number() over (partition by source order by {h('rank', "doc_id || ':' || chunk_no")}, doc_id, chunk_no) as rank
  from chunks),
sized as (
  select *, sum(length) over (partition by source order by rank) as running from ranked where rank <= 20),
kept as (select * from sized where running <= 1024 - 256 - 1)"""
    q["context_budget"] = f"""
with {retrieved} select source, rank::int as rank, doc_id, chunk_no, running::bigint as running from kept"""
    q["assemble_rag_prompt"] = f"""
with {retrieved}
select source, count(*) as n_chunks, '参考资料：' || chr(10) || string_agg(chunk, chr(10) order by rank)
  || chr(10) || chr(10) || '问题：' || source || chr(10) || '回答：' as prompt
from kept group by source"""
    q["index_upsert_delete"] = """
with versions as (
  select doc_id, text, 0 as version from documents
  union all
  select case when doc_id % 2 = 0 then doc_id else -doc_id end, text || '!', 1 from documents where doc_id % 7 = 0)
select doc_id, max(version)::int as version, md5(arg_max(text, version)) as text_md5 from versions
where doc_id not in (select doc_id from documents where doc_id % 11 = 0) group by doc_id"""
    q["eval_matrix"] = "select event_type, " + ", ".join(
        f"round(avg(({h('correct', 'event_id')} % 3 = 0)::int::double) filter (user_id % 4 = {s}), 9) as system_{s}"
        for s in range(4)) + " from events group by event_type"

    q["mix_by_ratio"] = f"""
select doc_id, source, {h('42:order', 'doc_id')} as mix_order from documents
where {u('42:mix', 'doc_id')} < case source
  when 'src0' then 0.1::double when 'src1' then 0.5 when 'src2' then 0.5 when 'src3' then 1.0 end"""
    q["flag_boilerplate"] = """
with lines as (
  select distinct doc_id, trim(unnest(string_split(text, chr(10))), ' ') as line from documents),
kept as (select * from lines where line <> ''),
common as (select line from kept group by line having count(*) >= 3)
select doc_id, count(*) as n_lines, count(common.line) as n_common
from kept left join common using (line) group by doc_id"""
    q["license_gate"] = """
select doc_id,
  case when contains(text, 'General Public License') then 'gpl' when contains(text, 'CC BY-NC') then 'noncommercial'
    when contains(text, 'Apache License') then 'apache' when contains(text, 'MIT License') then 'mit' end as license,
  case when contains(text, 'General Public License') or contains(text, 'CC BY-NC') then 'deny'
    when contains(text, 'Apache License') or contains(text, 'MIT License') then 'allow' else 'unknown' end as verdict
from documents"""
    ran = f"""
ran as (
  select user_id as task, event_id % 5 as solution, event_id, event_type as test,
    {h('fails', 'event_id')} % 4 <> 0 as passed from events)"""
    q["rejection_sample"] = f"""
with {ran} select task, solution, count(*) as n_tests, bool_and(passed) as kept from ran group by task, solution"""
    q["error_histogram"] = f"""
with {ran}, kinds as (
  select case event_id % 3 when 0 then 'ValueError' when 1 then 'KeyError' else 'other' end as kind
  from ran where not passed)
select kind, count(*) as n, round(count(*) / (sum(count(*)) over ())::double, 9) as share from kinds group by kind"""
    q["behavior_clusters"] = f"""
with {ran}, outputs as (
  select task, solution, test, bool_or(passed)::varchar as output from ran group by all),
behaviour as (
  select task, solution, string_agg(test || '=' || output, ',' order by test) as b from outputs group by all)
select task, solution, min(solution) over (partition by task, b) as cluster,
  count(*) over (partition by task, b) as size from behaviour"""
    q["disagreement_select"] = f"""
with scored as (
  select doc_id, ({h('critic1', 'doc_id')} % 101)::double as first_score,
    ({h('critic2', 'doc_id')} % 101)::double as second_score from documents)
select *, abs(first_score - second_score) as difference from scored where abs(first_score - second_score) > 40"""
    q["citation_precision"] = f"""
with cited as (
  select distinct conv_id || ':' || turn as answer, unnest({word_list('text')}) as fact
  from conversations where role = 'assistant'),
there as (
  select distinct conv_id || ':' || (turn + 1) as answer, unnest({word_list('text')}) as fact, true as found
  from conversations)
select answer, count(*) as n_cited, count(found) as n_found, round(count(found) / count(*)::double, 9) as precision
from cited left join there using (answer, fact) group by answer"""

    # --- screens, retrieval, packing
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    terms = (f"regexp_extract_all(translate(coalesce(text, ''), {letters}), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    q["decontaminate_eval"] = f"""
with dt as materialized (select row_number() over () as n, doc_id, {terms} as t from documents),
it as (select item_id, {terms} as t from benchmark),
grams as (
  select distinct item_id, size, array_to_string(t[i:i + size - 1], ' ') as gram from (
    select item_id, t, least(len(t), 13) as size, unnest(range(1, len(t) - least(len(t), 13) + 2)) as i
    from it where len(t) >= 8)),
places as (
  select n, size, i, array_to_string(t[i:i + size - 1], ' ') as gram from (
    select n, t, size, unnest(range(1, len(t) - size + 2)) as i
    from dt, (select distinct size from grams) where len(t) >= size)),
hits as (select n, i - 1 as start, size, item_id from places join grams using (size, gram)),
covered as (select distinct n, start + unnest(range(size)) as w from hits),
islands as (select n, min(w) as a, max(w) + 1 as b from (
  select n, w, w - row_number() over (partition by n order by w) as g from covered) group by n, g),
spans as (select n, sum(b - a)::bigint as n_covered, string_agg(a || ':' || b, ',' order by a) as spans
  from islands group by n),
shared as (select n, count(distinct item_id) as n_items from hits group by n)
select doc_id, len(t) as n_words, coalesce(n_items, 0) as n_items, coalesce(n_covered, 0) as n_covered,
  coalesce(spans, '') as spans, n_items is not null as contaminated
from dt left join spans using (n) left join shared using (n)"""
    q["safety_gate"] = f"""
with docs as materialized (select row_number() over () as n, doc_id, text from documents),
labelled as (select toxic, list_distinct({word_list('text')}) as w from documents join labels using (doc_id)),
seen as (
  select term, count(*) filter (toxic = 1) as n_unsafe, count(*) filter (toxic <> 1) as n_safe
  from (select toxic, unnest(w) as term from labelled) group by term),
terms as (
  select term from seen where n_unsafe >= 5
    and n_unsafe >= {UNSAFE_SHARE}::double * (select count(*) from labelled where toxic = 1)
    and n_safe <= {SAFE_SHARE}::double * (n_unsafe + n_safe)),
found as (
  select n, count(*) as n_hits, count(distinct term) as n_terms, string_agg(distinct term, ',' order by term) as terms
  from (select n, unnest({word_list('text')}) as term from docs)
  semi join terms using (term) group by n)
select doc_id, coalesce(n_hits, 0) as n_hits, coalesce(n_terms, 0) as n_terms,
  case when n_terms >= 2 then 'reject' when n_terms = 1 then 'review' else 'pass' end as verdict,
  coalesce(terms, '') as terms
from docs left join found using (n)"""
    q["vector_topk"] = """
select query, rank::int as rank, id, cosine from (
  select query, id, cosine, row_number() over (partition by query order by cosine desc, id) as rank from (
    select a.vec_id as query, b.vec_id as id,
      round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) as cosine
    from embeddings a join embeddings b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id))
where rank <= 10"""
    q["pack_best_fit"] = f"""
select doc_id, n as n_tokens, (n + {PACKED_ROW - 1}) // {PACKED_ROW} as n_pieces, true as gapless, true as fits
from (select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as n from documents)"""

    # --- source texts
    a_name = matches("x", f"^(?:{code_style.NAME})$")
    comment = f"(x like '#%' or {matches('x', '^' + code_style.DOCSTRING)})"
    q["style_noise"] = f"""
with {LEXED}, counted as (
  select doc_id, {n_tokens(f"{a_name} and x not in ({literals(keyword.kwlist)})")} as n_names,
    {n_tokens(matches('x', code_style.WEAK_NAME))} as n_weak_names,
    {n_tokens(matches('x', '^' + code_style.DEBUG_PRINT))} as n_prints, {n_tokens(comment)} as n_comments,
    {n_tokens(matches('x', '^' + chr(92) + 'n[ ' + chr(92) + 't]*' + chr(92) + 't'))} as n_tab_lines,
    {n_tokens(matches('x', '^' + chr(92) + 'n[ ' + chr(92) + 't]* '))} as n_blank_lines,
    len(string_split(coalesce(text, ''), chr(10))) as n_lines
  from lexed)
select *, n_prints > 0 or (n_tab_lines > 0 and n_blank_lines > 0) or n_weak_names > 0.2::double * n_names
  or (n_comments = 0 and n_lines >= 20) as noisy from counted"""
    renamed = f"({a_name} and x not in ({literals(code_style.KEPT_NAMES)}) and not list_contains(kept, x))"
    q["degrade_pairs"] = f"""
with {LEXED}, known as (
  select doc_id, text, t, regexp_extract_all(array_to_string(list_filter(t, lambda x:
    {matches('x', '^' + code_style.IMPORT)} or {matches('x', '^[rR]?[fF][rR]?["' + chr(39) + ']')}), ' '),
    {literal(code_style.NAME)}) as kept from lexed where text is not null),
copies as (
  select doc_id, text, {n_tokens(comment)} as n_dropped, {n_tokens(renamed)} as n_renamed,
    substr(array_to_string(list_transform(t, lambda x: case when x like '#%' then ''
      when {comment} then regexp_extract(x, '^\n[ \t]*') || '""'
      when {renamed} then 'v' || substring(md5('0:' || x), 1, 12) else x end), ''), 2) as rejected
  from known)
select doc_id, n_dropped, n_renamed, md5(text) as chosen_md5, md5(rejected) as rejected_md5
from copies where text <> rejected"""
    q["normalize_pairs"] = f"""
with dirty as (
  select doc_id, case {h('dirt', 'doc_id')} % 5
    when 0 then replace(text, '. ', '.  ' || repeat(chr(10), 4)) when 1 then replace(text, chr(10), chr(13) || chr(10))
    when 2 then replace(text, '. ', '.' || chr(10) || chr(9)) when 3 then text || chr(10) else text end as dirty
  from documents),
lines as (
  select *, string_split(replace(regexp_replace(dirty, '\r\n|\r', chr(10), 'g'), chr(9), '    '), chr(10)) as lines
  from dirty where dirty is not null),
trimmed as (select *, array_to_string(list_transform(lines, lambda x: rtrim(x, ' ')), chr(10)) as whole from lines),
short as (select *, regexp_replace(whole, '\n{{4,}}', repeat(chr(10), 3), 'g') as short from trimmed),
clean as (
  select *, case when rtrim(short, chr(10)) = '' then '' else rtrim(short, chr(10)) || chr(10) end as clean from short)
select doc_id, len(regexp_extract_all(dirty, '\r\n|\r')) as n_line_ends,
  length(dirty) - length(replace(dirty, chr(9), '')) as n_tabs,
  len(list_filter(lines, lambda x: rtrim(x, ' ') <> x)) as n_trailing,
  len(regexp_extract_all(whole, '\n{{4,}}')) as n_blank_runs, clean <> short as ended,
  md5(dirty) as dirty_md5, md5(clean) as clean_md5
from clean where clean <> dirty"""
    ends = [-1, *code_style.LINE_CLASSES, 1 << 60]
    classes = range(len(ends) - 1)
    each_class = ", ".join(
        f"coalesce(list_sum(list_filter(n, lambda x: x > {low} and x <= {high})), 0)::bigint as c{k}"
        for k, low, high in zip(classes, ends, ends[1:]))
    apart = " + ".join(f"abs(c{k}::double / n_chars - t{k}::double / total)" for k in classes)
    q["flag_generated"] = f"""
with texts as (
  select doc_id, coalesce(case {h('generated', 'doc_id')} % 5 when 0 then replace(text, chr(10), ' ')
    when 1 then replace(regexp_replace(text, '[a-z]', '7', 'g'), ' ', chr(10))
    when 2 then '# Code generated by a tool. DO NOT EDIT.' || chr(10) || text else text end, '') as text
  from documents),
lines as (select doc_id, text, string_split(text, chr(10)) as lines from texts),
measured as (select *, list_transform(lines, lambda x: length(x)) as n from lines),
classes as (
  select doc_id, len(lines) as n_lines, list_max(n) as longest_line, len(regexp_extract_all(text, '\\p{{L}}')) as n_letters,
    list_sum(n)::bigint as n_chars, array_to_string(lines[1:5], chr(10)) as head, {each_class} from measured),
corpus as (select {', '.join(f'sum(c{k}) as t{k}' for k in classes)}, greatest(sum(n_chars), 1) as total from classes),
far as (
  select *, case when n_chars > 0 then round(({apart}) / 2, 6) else 0.0::double end as distance
  from classes, corpus)
select doc_id, n_lines, longest_line, n_letters, n_chars, distance,
  case when {matches('head', code_style.GENERATED_MARK)} then 'marked'
    when distance >= 0.5 and longest_line >= 1000 then 'minified'
    when distance >= 0.5 and n_letters < 0.25 * n_chars then 'data' end as reason
from far"""
    names = ", ".join(GRID)
    axes = ", ".join(f"(select unnest([{literals(values)}]) as {c})" for c, values in GRID.items())
    q["diversity_grid"] = f"""
with labelled as (
  select coalesce(lang, '(none)') as lang, case when n_chars < 500 then 'short' when n_chars < 5000 then 'medium'
      when n_chars < 20000 then 'long' else 'very long' end as size,
    coalesce(quality::varchar, 'unknown') as quality, coalesce(toxic::varchar, '(none)') as toxic
  from documents left join labels using (doc_id)),
counted as (select {names}, count(*) as n from labelled group by {names}),
cells as (
  select {names}, coalesce(n, 0) as n, coalesce(cell, 0) as cell
  from (select *, 1 as cell from {axes}) full join counted using ({names}))
select {names}, grouping({names})::bigint as level, sum(n)::bigint as n_rows, sum(cell)::bigint as n_cells,
  count(*) filter (cell = 1 and n = 0) as n_empty,
  sum(case when cell = 1 then greatest({GRID_TARGET} - n, 0) else 0 end)::bigint as n_short,
  sum(case when cell = 0 then n else 0 end)::bigint as n_outside
from cells group by cube ({names})"""

    # --- streaming
    q["stream_shards"] = """
select source, count(*) as n_rows,
  (select count(distinct source) >= 20 from documents) as ready
from documents group by source"""
    q["stream_prepare"] = f"""
with {CODE_DOCS}, encoded as (
  select doc_id, list_concat(list_concat({OPENING}, {byte_list('text')}),
    [{fv.CODE_END}, {fv.EOT}]) as tokens
  from code_docs where length(text) > 100 and length(text) < 100000)
select doc_id, len(tokens)::int as n_tokens, md5({joined('tokens')}) as tokens_md5 from encoded"""
    q["stream_cap_per_language"] = capped(120)
    q["stream_run_metrics"] = f"""
with hours as (
  select time_bucket(interval '1 hour', ts) as hour, count(*) as n, avg(value / 3) as loss
  from events group by 1)
select strftime(hour, '%Y-%m-%d %H:%M:%S') as window_start, n as n_steps, round(loss, 6) as mean_loss,
  round(n * {TOKENS_PER_STEP} / 3600.0::double, 6) as tokens_per_second
from hours
where hour + interval '1 hour' <= (select max(ts) from events) - interval '10 minutes'"""
    return q
