"""Templates of tokenizers as column expressions."""

from __future__ import annotations

import json

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from corpusmill.functions.chat_templates import TemplateError, compile_template
from corpusmill.functions.prompts import render
from corpusmill.operators.conversations import conversation_messages
from corpusmill.plans.jobs import run_job
from corpusmill.sources.json_corpus import read_json_corpus

CHAT = (
    "{% if not add_generation_prompt is defined %}{% set add_generation_prompt = false %}{% endif %}"
    "{% for message in messages %}{% if loop.first and messages[0]['role'] != 'system' %}"
    "{{ '<|im_start|>system\\nYou are helpful.<|im_end|>\\n' }}{% endif %}"
    "{{ '<|im_start|>' + message['role'] + '\\n' + message['content'] + '<|im_end|>' + '\\n' }}{% endfor %}"
    "{% if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}"
)


def chat(messages, gen):
    out = ""
    for i, m in enumerate(messages):
        if i == 0 and m["role"] != "system":
            out += "<|im_start|>system\nYou are helpful.<|im_end|>\n"
        out += f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n"
    return out + ("<|im_start|>assistant\n" if gen else "")


INST = """{%- if messages[0]['role'] == 'system' -%}
    {%- set system_message = messages[0]['content'] | trim -%}
    {%- set loop_messages = messages[1:] -%}
{%- else -%}
    {%- set system_message = false -%}
    {%- set loop_messages = messages -%}
{%- endif -%}
{# turns #}
{%- for message in loop_messages -%}
    {%- if (message['role'] == 'user') != (loop.index0 % 2 == 0) -%}
        {{ raise_exception('Conversation roles must alternate') }}
    {%- endif -%}
    {%- if loop.first and system_message != false -%}
        {%- set content = '<<SYS>>\\n' + system_message + '\\n<</SYS>>\\n\\n' + message['content'] -%}
    {%- else -%}
        {%- set content = message['content'] -%}
    {%- endif -%}
    {%- if message['role'] == 'user' -%}
        {{ bos_token + '[INST] ' + content.strip() + ' [/INST]' }}
    {%- elif message['role'] == 'assistant' -%}
        {{ ' ' + content.strip() + ' ' + eos_token }}
    {%- endif -%}
{%- endfor -%}
"""


def inst(messages, gen):
    system, turns = None, messages
    if messages and messages[0]["role"] == "system":
        system, turns = messages[0]["content"].strip(), messages[1:]
    out = ""
    for i, m in enumerate(turns):
        if (m["role"] == "user") != (i % 2 == 0):
            return None
        content = m["content"]
        if i == 0 and system is not None:
            content = f"<<SYS>>\n{system}\n<</SYS>>\n\n{content}"
        if m["role"] == "user":
            out += f"<s>[INST] {content.strip()} [/INST]"
        elif m["role"] == "assistant":
            out += f" {content.strip()} </s>"
    return out


LINES = """{{ bos_token }}
{% for m in messages %}
  {% if m.role in ['user', 'system'] %}
<|{{ m.role }}|>
{{ m.content }}{{ eos_token }}
  {% else %}
<|{{ 'bot' if m.role == 'assistant' else m.role | upper }}|>
{{ m['content'] ~ eos_token }}
  {% endif %}
  {% if loop.last and add_generation_prompt %}
<|bot|>
  {% endif %}
{% endfor %}
"""


TOKENS = {"bos_token": "<s>", "eos_token": "</s>"}


def conversations(spark):
    return conversation_messages(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))


@pytest.mark.parametrize(("source", "python"), [(CHAT, chat), (INST, inst)], ids=["chat", "inst"])
@pytest.mark.parametrize("mode", ["train", "prompt"])
def test_templates_equal_python_on_all_conversations(spark, source, python, mode):
    df = conversations(spark)
    template = compile_template(source, **TOKENS)
    from corpusmill.functions.chat_templates import message_fields

    fields = message_fields(df.schema["messages"].dataType.elementType)
    out = df.select("conv_id", "messages", template.text(F.col("messages"), fields, mode == "prompt").alias("t"))
    got = out.collect()
    assert len(got) >= 20 and any(r.t is not None for r in got)
    for r in got:
        assert r.t == python([m.asDict() for m in r.messages], mode == "prompt")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_line_layout_and_inline_choices(spark):
    msgs = [[("user", "hi"), ("assistant", "a\nb"), ("tool", "x")], [("system", "s"), ("user", "")], []]
    df = spark.createDataFrame([(i, [dict(role=r, content=c) for r, c in m]) for i, m in enumerate(msgs)], "i int, messages array<struct<role:string,content:string>>")
    for gen in (False, True):
        text = compile_template(LINES, **TOKENS).text(F.col("messages"), {"role": None, "content": None}, gen)
        got = dict(rows(df.select("i", text), order=["i"]))
        # a tag takes the line break after it, an expression does not
        want = {
            0: "<s>\n<|user|>\nhi</s>\n<|bot|>\na\nb</s>\n<|TOOL|>\nx</s>\n" + ("<|bot|>\n" if gen else ""),
            1: "<s>\n<|system|>\ns</s>\n<|user|>\n</s>\n" + ("<|bot|>\n" if gen else ""),
            2: "<s>\n",
        }
        assert got == want


def test_a_template_that_raises(spark):
    """A conversation fails its row; an instruction row falls back to the plain text."""
    strict = compile_template("{{ raise_exception('no') if messages | length > 1 else messages[0]['content'] }}")
    df = spark.createDataFrame([("q", "a")], "instruction string, output string")
    assert rows(render(df, template=strict, keep=())) == [("User:\nq\n\nAssistant:\na\n",)]
    assert rows(render(df, mode="prompt", template=strict, keep=())) == [("q",)]
    chats = spark.createDataFrame([([("user", "x")],), ([("user", "x"), ("user", "y")],)], "messages array<struct<role:string,content:string>>")
    assert rows(render(chats.limit(1), template=strict, keep=())) == [("x",)]
    with pytest.raises(Exception, match="the chat template raises"):
        render(chats, template=strict, keep=()).collect()


def test_fields_besides_role_and_content(spark, write):
    p = write("m.jsonl", json.dumps({"messages": [
        {"role": "user", "content": "q", "name": "Ann"},
        {"role": "assistant", "content": None, "tool_calls": [{"id": "1", "fn": {"name": "f"}}, {"id": "2", "fn": {"name": "g"}}]},
    ]}) + "\n")
    source = (
        "{% for m in messages %}{{ m.role }}{% if m.name is defined %}({{ m.name }}){% endif %}:{% if m['tool_calls'] %}"
        "{% for c in m.tool_calls %}{{ c.fn.name }}{% if not loop.last %},{% endif %}{% endfor %}{% else %}{{ m.content }}{% endif %};{% endfor %}"
    )
    df = read_json_corpus(spark, p)
    assert rows(render(df, template=compile_template(source), keep=())) == [("user(Ann):q;assistant:f,g;",)]

    def python(messages, gen):
        assert "name" not in messages[1] and messages[1]["content"] is None
        return f"{messages[0]['name']} {messages[1]['tool_calls'][1]['fn']['name']}"

    assert rows(render(df, custom=python, keep=())) == [("Ann g",)]
    bare = spark.createDataFrame([("q", "a")], "instruction string, output string")
    assert rows(render(bare, template=compile_template(source), keep=())) == [("user:q;assistant:a;",)]


@pytest.mark.parametrize("source", ["{% macro f() %}{% endmacro %}", "{{ messages | tojson }}", "{% for x in messages %}", "{{ 1 + }}", "{{ messages }}", "{% endif %}", "{% include 'x' %}"])
def test_what_has_no_native_form_is_named(source):
    with pytest.raises(TemplateError):
        compile_template(source).text(F.col("messages"), {"role": None, "content": None}, False)


def test_jobs_take_a_compiled_template(spark, write):
    tr = write("tr.jsonl", json.dumps({"instruction": "q", "output": "a"}) + "\n")
    out = run_job(spark, {"task": "train", "train_data_path": tr}, template=compile_template(INST, **TOKENS))
    assert rows(out, "text") == [("<s>[INST] q [/INST] a </s>",)]
