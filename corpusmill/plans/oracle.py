"""DuckDB SQL for each registered query (same column names and types).

Built from the same fixture definitions (FIXTURES.md) as the Spark side; every
statement reads the whole tables.
"""

# Fixed texts (must equal the renderer's constants, see functions/prompts.py).
N = "chr(10)"
IM_START = "'<|im_start|>'"
IM_END = "'<|im_end|>'"
ALPACA_HEAD = "'Below is an instruction that describes a task. Write a response.'"

# Instruction rows (FIXTURES.md section 3), their resolved fields, user turn.
R_CTE = f"""
p as (select conv_id, turn, role, text as ins,
        lead(text) over w as nxt, lead(role) over w as nr,
        max(case when role = 'system' then text end) over (partition by conv_id) as sys
      from conversations window w as (partition by conv_id order by turn)),
r as (select conv_id, turn,
        case when conv_id % 2 = 0 then ins end as instruction,
        case when conv_id % 2 = 1 then ins end as instr,
        coalesce(sys, '') as input,
        case when turn % 4 < 2 then nxt end as output,
        case when turn % 4 >= 2 then nxt end as response
      from p where role = 'user' and nr = 'assistant'),
f as (select conv_id, turn,
        coalesce(nullif(instruction, ''), nullif(instr, ''), '') as inst,
        coalesce(nullif(input, ''), '') as inp,
        coalesce(nullif(output, ''), nullif(response, ''), '') as outp
      from r),
u as (select *, case when inp = '' then inst else inst || {N} || inp end as usr from f)
"""

# Conversations rendered with ChatML (FIXTURES.md section 2).
C_CTE = f"""
c as (select conv_id, count(*) as n_msgs,
        string_agg({IM_START} || role || {N} || text || {IM_END} || {N}, '' order by turn) as txt,
        arg_max(role, turn) as last_role
      from conversations group by conv_id)
"""

# Preference triples (FIXTURES.md section 4).
D_CTE = """
cc as (select conv_id, role, text,
         row_number() over (partition by conv_id, role order by turn) as a,
         row_number() over (partition by conv_id, role order by turn desc) as z
       from conversations),
d0 as (select conv_id,
         max(case when role = 'user' and a = 1 then text end) as prompt,
         max(case when role = 'assistant' and a = 1 then text end) as chosen,
         max(case when role = 'assistant' and z = 1 then text end) as rejected
       from cc group by conv_id),
d as (select * from d0 where prompt is not null and chosen is not null and rejected is not null)
"""

# Stand-in run log (FIXTURES.md section 6) and its run numbers.
E_CTE = """
e as (select user_id as log_id, event_id, ts, event_type as phase,
        event_id % 2 = 1 as isfin, event_id % 7 = 0 as is_total_start,
        case event_type when 'error' then 'fail' when 'purchase' then 'success' else 'running' end as status
      from events),
er as (select *, (sum(case when is_total_start then 1 else 0 end)
        over (partition by log_id order by ts, event_id rows between unbounded preceding and current row))::bigint as run_no
      from e)
"""

GEN_HEADER = f"{IM_START} || 'assistant' || {N}"


def chat_inst(user: str, out: str | None) -> str:
    s = f"{IM_START} || 'user' || {N} || {user} || {IM_END} || {N}"
    if out is None:
        return f"{s} || {GEN_HEADER}"
    return f"{s} || {IM_START} || 'assistant' || {N} || {out} || {IM_END} || {N}"


def alpaca(inst: str, inp: str, out: str) -> str:
    return (
        f"{ALPACA_HEAD} || {N} || {N} || '### Instruction:' || {N} || {inst}"
        f" || case when {inp} <> '' then {N} || {N} || '### Input:' || {N} || {inp} else '' end"
        f" || {N} || {N} || '### Response:' || {N} || {out}"
    )


def plain(user: str, out: str | None) -> str:
    s = f"'User:' || {N} || {user} || {N} || {N} || 'Assistant:' || {N}"
    return s if out is None else f"{s} || {out} || {N}"


def first_words(x: str, k: int = 8) -> str:
    return rf"array_to_string(list_filter(regexp_split_to_array({x}, '[ \t\n\r]+'), lambda w: w <> '')[1:{k}], ' ')"


def ids(x: str) -> str:
    return f"(case when {x} = '' then []::integer[] else list_transform(string_split({x}, ''), lambda ch: unicode(ch)) end)"


def digest(x: str) -> str:
    """md5 of an id list, the ids joined by spaces."""
    return f"md5(array_to_string({x}, ' '))"


def cut_ids(x: str, n: str) -> str:
    """Columns ``n`` and ``ids_md5`` of the first ``n`` ids of a text."""
    return f"least(length({x}), {n})::bigint as n, {digest(f'({ids(x)})[1:{n}]')} as ids_md5"


def pref_ids(max_len: int, max_prompt: int, max_target: int, left: bool = False) -> str:
    """Columns of the three id lists of ``d`` under a budget."""
    size = f"least(length(prompt), {min(max_prompt, max_len)})"
    room = f"greatest(0, least({max_target}, {max_len} - {size}))"
    out = []
    for k, name, n in (("p", "prompt", size), ("c", "chosen", room), ("r", "rejected", room)):
        part = f"({ids(name)})[greatest(length({name}) - {n}, 0) + 1:]" if left else f"({ids(name)})[1:{n}]"
        out.append(f"least(length({name}), {n})::bigint as n{k}, {digest(part)} as h{k}")
    return ", ".join(out)


def rate_split(table: str, key: str, rate: str, where: str = "") -> str:
    return f"""
h as (select {key}, row_number() over (order by md5('42:' || {key}::varchar), {key}) as rn,
        count(*) over () as n from {table} {where})
select {key}, case when rn <= ceil({rate}::decimal(10,6) * n) then 'eval' else 'train' end as split from h
"""


LANG_ORD = "(case lang when 'de' then 0 when 'en' then 1 when 'es' then 2 else 3 end)::bigint"

FLAGSHIP = f"""
with c as (select conv_id, string_agg({IM_START} || role || {N} || text || {IM_END} || {N}, '' order by turn) as text
           from conversations group by conv_id),
h as (select conv_id, text, row_number() over (order by md5('42:' || conv_id::varchar), conv_id) as rn,
        count(*) over () as n from c)
select conv_id, case when rn <= ceil(0.1::decimal(10,6) * n) then 'eval' else 'train' end as split,
       least(length(text), 2048)::bigint as n_tokens, text
from h
"""

ORACLE: dict[str, str] = {
    "flagship": FLAGSHIP,
    "jsonl_scan": "select doc_id, length(text)::bigint as n, md5(text) as h, n_chars from documents",
    "json_dataset": "select item_id, md5(text) as h from benchmark",
    "mixture": f"""
with d as (select doc_id, text, lang, row_number() over (partition by lang order by doc_id) as place from documents)
select doc_id, length(text)::bigint as n, {LANG_ORD} as spec_ord, place from d
union all
select doc_id, length(text)::bigint as n, 4::bigint as spec_ord, place from d where lang = 'de'
""",
    "whole_text": f"select item_id, md5(regexp_replace(text || {N}, chr(13) || {N} || '?', {N}, 'g')) as h from benchmark",
    "prompt_file": f"""
with {R_CTE}, {C_CTE}
select conv_id, -1::bigint as turn, n_msgs::bigint as n_msgs, '' as inst, 'conv_id,messages,turn' as keys from c where last_role = 'user'
union all
select f.conv_id, f.turn, 0::bigint as n_msgs, f.inst,
       case when r.instruction is not null then 'conv_id,turn,instruction,input' else 'conv_id,turn,instr,input' end as keys
from f join r using (conv_id, turn)
""",
    "union_chunks": f"""
select md5(text) as h, doc_id from documents
union all
select md5(text || {N}) as h, null::bigint as doc_id from benchmark
""",
    "has_messages": f"""
with {R_CTE}
select conv_id, -1::bigint as turn, true as has_messages from conversations group by conv_id
union all
select conv_id, turn, false as has_messages from r
""",
    "project_only": f"with {R_CTE} select {chat_inst('usr', 'outp')} as text from u",
    "drop_text": "select doc_id, lang, source, n_chars, least(length(text), 2048)::bigint as n_tokens from documents",
    "pass_through": f"with {D_CTE} select conv_id, prompt, chosen, rejected, 'train' as split from d",
    "append_field": f"""
with {C_CTE}
select conv_id, n_msgs::bigint as n_msgs, {first_words(f"txt || {GEN_HEADER}")} as prediction from c where last_role = 'user'
""",
    "eval_source": """
select 'train' as split, doc_id, null::bigint as item_id, md5(text) as h from documents
union all
select 'eval' as split, null::bigint as doc_id, item_id, md5(text) as h from benchmark
""",
    "rate_split": "with " + rate_split("documents", "doc_id", "0.1"),
    "rate_split_by_lang": """
with h as (select lang, text, row_number() over (order by md5('42:' || lang), md5('42:' || to_json({'lang': lang, 'text': text})::varchar)) as rn,
        count(*) over () as n from documents)
select lang, md5(text) as h, case when rn <= ceil(0.1::decimal(10,6) * n) then 'eval' else 'train' end as split from h
""",
    "split_fallthrough": "with " + rate_split("documents", "doc_id", "0.07"),
    "split_train_only": "select doc_id, 'train' as split from documents",
    "alias_coalesce": f"with {R_CTE} select conv_id, turn, inst, inp, outp as out from f",
    "render_dispatch": f"""
with {R_CTE}, {C_CTE}
select conv_id, -1::bigint as turn, txt as text from c
union all
select conv_id, turn, {alpaca('inst', 'inp', 'outp')} as text from f
""",
    "alpaca_train": f"with {R_CTE} select conv_id, turn, {alpaca('inst', 'inp', 'outp')} as text from f",
    "alpaca_prompt": f"with {R_CTE} select conv_id, turn, {alpaca('inst', 'inp', chr(39) * 2)} as text from f",
    "user_merge": f"with {R_CTE} select conv_id, turn, usr as user from u",
    "to_messages": f"with {R_CTE} select conv_id, turn, 'user,assistant' as roles, usr || '|||' || outp as contents from u",
    "chat_train": f"with {C_CTE} select conv_id, txt as text from c",
    "chat_prompt": f"with {C_CTE} select conv_id, txt || {GEN_HEADER} as text from c",
    "plain_train": f"with {R_CTE} select conv_id, turn, {plain('usr', 'outp')} as text from u",
    "plain_prompt": f"with {R_CTE} select conv_id, turn, {plain('usr', None)} as text from u",
    "tokenize": f"select doc_id, {cut_ids('text', '1000000000')} from documents",
    "truncate": f"""
select doc_id, least(len(ids), 16)::bigint as n_left, {digest('ids[greatest(len(ids) - 16, 0) + 1:]')} as left_ids,
       least(len(ids), 2048)::bigint as n_right, {digest('ids[1:2048]')} as right_ids
from (select doc_id, {ids('text')} as ids from documents)
""",
    "labels_copy": f"select doc_id, true as same, {cut_ids('text', '2048')}, least(length(text), 2048)::bigint as mask_ones from documents",
    "pretrain_tokens": f"select doc_id, lang, {cut_ids('text', '2048')} from documents",
    "sft_tokens": f"""
with {R_CTE}, {C_CTE},
t as (select txt as text from c union all select {chat_inst('usr', 'outp')} as text from u)
select md5(text) as h, {cut_ids('text', '2048')} from t
""",
    "offline_sft": f"""
with {R_CTE}, t as (select {chat_inst('usr', 'outp')} as text from u)
select {cut_ids('text', '8192')}, true as same_labels, true as mask_ok,
       'sft' as task, 'codepoints' as tokenizer, null::varchar as model_type, 'chatml' as prompt_type, 'right' as truncation_side
from t
""",
    "pref_load": f"with {D_CTE}, " + rate_split("d", "conv_id", "0.2"),
    "pref_tokens": f"with {D_CTE} select conv_id, {pref_ids(2048, 512, 1536)} from d",
    "pref_budget": f"with {D_CTE} select conv_id, {pref_ids(257, 128, 129, left=True)} from d",
    "pref_tokens_tight": f"with {D_CTE} select conv_id, {pref_ids(256, 512, 1536)} from d",
    "generate": f"with {R_CTE} select conv_id, turn, {first_words(chat_inst('usr', None))} as prediction from u",
    "strip_prediction": f"with {R_CTE} select conv_id, turn, {first_words(chat_inst('usr', None))} as prediction from u",
    "row_passthrough": f"""
with {R_CTE}, {C_CTE}
select conv_id, -1::bigint as turn, n_msgs::bigint as n_msgs, null::varchar as inst, null::varchar as input,
       {first_words(f"txt || {GEN_HEADER}")} as prediction
from c where last_role = 'user'
union all
select conv_id, turn, 0::bigint as n_msgs, inst, inp as input, {first_words(chat_inst('usr', None))} as prediction from u
""",
    "output_order": f"""
with {R_CTE}, {C_CTE}
select conv_id, -1::bigint as turn, {first_words(f"txt || {GEN_HEADER}")} as prediction, true as in_order
from c where last_role = 'user'
union all
select conv_id, turn, {first_words(chat_inst('usr', None))} as prediction, true as in_order from u
""",
    "dataset_sink": FLAGSHIP.replace("least(length(text), 2048)::bigint as n_tokens, text", "least(length(text), 2048)::bigint as n_tokens, md5(text) as h"),
    "prediction_sink": f"with {R_CTE} select conv_id, turn, {first_words(chat_inst('usr', None))} as prediction from u",
    "prediction_sink_lossless": f"""
with {R_CTE}, {C_CTE}
select conv_id, -1::bigint as turn, {first_words(f"txt || {GEN_HEADER}")} as prediction,
       'conv_id,messages,turn,prediction' as keys
from c where last_role = 'user'
union all
select conv_id, turn, {first_words(chat_inst('usr', None))} as prediction,
       case when instruction is not null then 'conv_id,turn,instruction,input,prediction'
            else 'conv_id,turn,instr,input,prediction' end as keys
from (select u.*, r.instruction from u join r using (conv_id, turn))
""",
    "manifest": f"""
select {LANG_ORD} as spec_ord, count(*)::bigint as rows, 'hf_jsonl' as backend, 1::bigint as n_missing
from documents group by 1
union all
select 4::bigint as spec_ord, count(*)::bigint as rows, 'hf_jsonl' as backend, 1::bigint as n_missing
from documents where lang = 'de'
""",
    "batch_map": r"""
select doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda w: w <> ''))::bigint as n_words
from documents
""",
    "worker_init": f"select doc_id, {cut_ids('text', '1000000000')} from documents",
    "custom_render": f"with {C_CTE} select conv_id, txt as text from c",
    "run_job": f"""
with {R_CTE}, {C_CTE},
t as (select 'train' as split, {chat_inst('usr', 'outp')} as text from u
      union all select 'eval' as split, txt as text from c)
select split, md5(text) as h, least(length(text), 2048)::bigint as n_tokens from t
""",
    "run_job_custom": f"""
with {R_CTE}, {C_CTE},
t as (select 'eval' as split, {chat_inst('usr', 'outp')} as text from u
      union all select 'train' as split, txt as text from c)
select split, md5(text) as h, {cut_ids('text', '2048')} from t
""",
    "mixed_layouts": f"""
with {C_CTE}
select conv_id, null::bigint as item_id, 0::bigint as part, md5(txt) as h from c
union all
select null::bigint as conv_id, item_id, part, md5({alpaca('text', "''", "''")}) as h
from benchmark, (select unnest([1, 2])::bigint as part)
""",
    "nested_empty": """
select doc_id,
       case when doc_id % 5 = 0 or doc_id % 7 = 0 or doc_id % 3 = 0 then null else length(text)::bigint end as n,
       case when doc_id % 5 = 0 or doc_id % 7 = 0 then null when doc_id % 2 = 0 then '' else 'x' end as t,
       doc_id % 5 = 0 or doc_id % 7 = 0 as no_m,
       case when doc_id % 6 = 0 then null when doc_id % 11 = 0 then 0 else 3 end::bigint as n_items,
       case when doc_id % 6 = 0 then null when doc_id % 11 = 0 then ''
            else doc_id || ',' || case when doc_id % 4 = 0 then 'gone' else (doc_id * 2)::varchar end || ',null' end as items,
       case when doc_id % 2 = 0 then doc_id::varchar else '1234567890123456789' || lpad(doc_id::varchar, 9, '0') end as w
from documents
""",
    "run_job_dpo": f"with {D_CTE} select conv_id, 'train' as split, {pref_ids(1024, 512, 1536)} from d",
    "run_job_pretrain": f"select doc_id, 'train' as split, {cut_ids('text', '512')} from documents",
    "run_job_test": f"""
with {R_CTE}, {C_CTE}
select conv_id, -1::bigint as turn, {first_words(f"txt || {GEN_HEADER}")} as prediction from c where last_role = 'user'
union all
select conv_id, turn, {first_words(chat_inst('usr', None))} as prediction from u
""",
    "log_scan": f"with {E_CTE} select log_id as user_id, event_id, phase, status, isfin, is_total_start from e",
    "log_runs": f"""
with {E_CTE}
select log_id, run_no, count(*)::bigint as n, sum(case when isfin then 1 else 0 end)::bigint as fins
from er group by log_id, run_no
""",
    "phase_durations": f"""
with {E_CTE},
n as (select *, lead(isfin) over w as nf, lead(ts) over w as nt from er
      window w as (partition by log_id, run_no, phase order by ts, event_id))
select log_id, run_no, phase, event_id, case when nf then 'closed' else 'open' end as state,
       case when nf then date_diff('microsecond', ts, nt) end::bigint as micros
from n where not isfin
""",
    "run_outcomes": f"""
with {E_CTE}
select log_id, run_no,
       case when max(case when phase = 'end' or status = 'success' then 1 else 0 end) = 1 then 'success'
            when max(case when status = 'fail' then 1 else 0 end) = 1 then 'fail'
            else 'incomplete' end as outcome,
       count(*)::bigint as n_events
from er group by log_id, run_no
""",
}
