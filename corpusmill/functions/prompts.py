"""Prompt rendering as native column expressions.

One renderer serves training text (``mode='train'``) and generation prompts
(``mode='prompt'``). Precedence per row: a non-empty ``messages`` list goes
through the chat template; otherwise the instruction fields are rendered as
Alpaca text when ``prompt_type == 'alpaca'`` and as a two-turn (train) or
one-turn (prompt) chat for any other value. With no template the plain
``User:`` / ``Assistant:`` fallback is used for instruction rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.chat_templates import ROLE_AND_CONTENT, CompiledTemplate, message_fields
from corpusmill.functions.schema import has_messages, truthy_string, with_optional_columns

# These texts must be byte-identical to the reference's output.
ALPACA_HEADER = "Below is an instruction that describes a task. Write a response.\n\n"
ALPACA_INSTRUCTION = "### Instruction:\n"
ALPACA_INPUT = "\n\n### Input:\n"
ALPACA_RESPONSE = "\n\n### Response:\n"
PLAIN_USER = "User:\n"
PLAIN_ASSISTANT = "\n\nAssistant:\n"
PLAIN_END = "\n"
INSTRUCTION_ALIASES = ("instruction", "instr")
INPUT_ALIASES = ("input",)
ANSWER_ALIASES = ("output", "response")


@dataclass(frozen=True)
class ChatTemplate:
    """A marker-style chat template: per message
    ``prefix + role + role_sep + content + suffix``; the generation prompt is
    ``prefix + 'assistant' + role_sep``. ``default_system`` is inserted first
    when the conversation does not open with a system turn."""

    prefix: str
    role_sep: str
    suffix: str
    default_system: str | None = None
    name: str = "custom"

    def generation_prompt(self) -> str:
        return f"{self.prefix}assistant{self.role_sep}"


CHATML = ChatTemplate(prefix="<|im_start|>", role_sep="\n", suffix="<|im_end|>\n", name="chatml")


def instruction_fields(df: DataFrame) -> tuple[Column, Column, Column]:
    """First truthy of ``instruction``/``instr``, of ``input``, of
    ``output``/``response``; ``''`` when none is."""
    def pick(names):
        return F.coalesce(*[truthy_string(F.col(n)) for n in names], F.lit(""))

    return pick(INSTRUCTION_ALIASES), pick(INPUT_ALIASES), pick(ANSWER_ALIASES)


def with_instruction_columns(df: DataFrame) -> DataFrame:
    return with_optional_columns(df, INSTRUCTION_ALIASES + INPUT_ALIASES + ANSWER_ALIASES)


def alpaca_text(inst: Column, inp: Column, out: Column | None) -> Column:
    """Alpaca text; the ``### Input:`` block only when input is non-empty.
    ``out=None`` ends the text at ``### Response:\\n`` (prompt form)."""
    return F.concat(
        F.lit(ALPACA_HEADER + ALPACA_INSTRUCTION),
        inst,
        F.when(inp != "", F.concat(F.lit(ALPACA_INPUT), inp)).otherwise(F.lit("")),
        F.lit(ALPACA_RESPONSE),
        out if out is not None else F.lit(""),
    )


def user_turn(inst: Column, inp: Column) -> Column:
    return F.when(inp == "", inst).otherwise(F.concat(inst, F.lit("\n"), inp))


def message(role: str | Column, content: Column) -> Column:
    role_c = F.lit(role) if isinstance(role, str) else role
    return F.struct(content.alias("content"), role_c.alias("role"))


def instruction_messages(inst: Column, inp: Column, out: Column | None) -> Column:
    """User turn (and assistant turn when ``out`` is given) as a chat list."""
    turns = [message("user", user_turn(inst, inp))]
    if out is not None:
        turns.append(message("assistant", out))
    return F.array(*turns)


def chat_text(messages: Column, template: ChatTemplate = CHATML, add_generation_prompt: bool = False) -> Column:
    """Render a chat list with a marker template; null content renders empty."""
    body = F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.lit(template.prefix),
                F.coalesce(m["role"], F.lit("")),
                F.lit(template.role_sep),
                F.coalesce(m["content"], F.lit("")),
                F.lit(template.suffix),
            ),
        ),
        "",
    )
    if template.default_system is not None:
        sys_block = F.lit(f"{template.prefix}system{template.role_sep}{template.default_system}{template.suffix}")
        body = F.when(
            F.coalesce(F.get(messages, 0)["role"], F.lit("")) == "system", body
        ).otherwise(F.concat(sys_block, body))
    if add_generation_prompt:
        body = F.concat(body, F.lit(template.generation_prompt()))
    return body


def plain_text(user: Column, out: Column | None) -> Column:
    if out is None:
        return F.concat(F.lit(PLAIN_USER), user, F.lit(PLAIN_ASSISTANT))
    return F.concat(F.lit(PLAIN_USER), user, F.lit(PLAIN_ASSISTANT), out, F.lit(PLAIN_END))


def render_column(
    df: DataFrame,
    prompt_type: str = "chatml",
    mode: str = "train",
    template: ChatTemplate | CompiledTemplate | None = CHATML,
    custom: Callable | None = None,
) -> tuple[DataFrame, Column]:
    """The rendering expression for ``df`` (after adding absent alias columns).

    ``template`` is a marker template or a tokenizer's own one
    (``chat_templates.compile_template``). ``custom`` is a user chat renderer ``(messages, add_generation_prompt) ->
    str`` run as an Arrow-batched UDF (see ``functions.udf.custom_chat``); it
    replaces ``template`` for both branches."""
    if mode not in ("train", "prompt"):
        raise ValueError("mode must be 'train' or 'prompt'")
    gen = mode == "prompt"
    df = with_instruction_columns(df)
    inst, inp, out = instruction_fields(df)
    answer = None if gen else out
    if custom is not None:
        from corpusmill.functions.udf import custom_chat

        chat = lambda msgs, fallback, fields: custom_chat(custom, gen)(msgs, fallback)
    elif isinstance(template, CompiledTemplate):
        # null where the template raises: the fallback, and without one the row fails
        failed = F.raise_error(F.lit("the chat template raises on this conversation")).cast("string")
        chat = lambda msgs, fallback, fields: F.coalesce(template.text(msgs, fields, gen), fallback, failed)
    elif template is not None:
        chat = lambda msgs, fallback, fields: chat_text(msgs, template, gen)
    else:
        chat = None
    if prompt_type == "alpaca":
        instr_branch = alpaca_text(inst, inp, answer)
    elif chat is None:
        instr_branch = plain_text(user_turn(inst, inp), answer)
    else:
        instr_branch = chat(instruction_messages(inst, inp, answer), plain_text(user_turn(inst, inp), answer), ROLE_AND_CONTENT)
    # A ``messages`` column that is not a list (e.g. all-null, inferred as a
    # string) holds no usable chat: empty values are absent, others fail. A list whose items
    # are not {role, content} objects (only ``[]`` seen: inferred as strings)
    # is usable only when empty; a non-empty one fails its row.
    mtype = df.schema["messages"].dataType if "messages" in df.columns else None
    chat_rows = isinstance(mtype, T.ArrayType)
    shaped = chat_rows and isinstance(mtype.elementType, T.StructType) and {"role", "content"} <= set(
        mtype.elementType.fieldNames()
    )
    cond = has_messages(df)
    if chat_rows and (chat is None or not shaped):
        # Only rows that do carry messages fail (when they are computed).
        why = "rows with messages need a chat template" if shaped else "messages must be a list of {role, content}"
        fail = F.raise_error(F.lit(why)).cast("string")
        return df, F.when(cond, fail).otherwise(instr_branch)
    if chat_rows:
        # Template failures on messages rows are not caught: no fallback text.
        msg_branch = chat(F.col("messages"), F.lit(None).cast("string"), message_fields(mtype.elementType))
        return df, F.when(cond, msg_branch).otherwise(instr_branch)
    if mtype is not None:
        return df, F.when(cond, F.lit(None).cast("string")).otherwise(instr_branch)
    return df, instr_branch


def render(
    df: DataFrame,
    prompt_type: str = "chatml",
    mode: str = "train",
    template: ChatTemplate | CompiledTemplate | None = CHATML,
    custom: Callable | None = None,
    column: str = "text",
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Add the rendered ``column``. ``keep=()`` replaces all source columns by
    it (plus the listed ones), as a batched map with all columns removed does;
    ``keep=None`` keeps every column."""
    df2, expr = render_column(df, prompt_type, mode, template, custom)
    if keep is None:
        return df.withColumn(column, expr) if df2 is df else df2.withColumn(column, expr).select(*df.columns, column)
    return df2.select(*[c for c in keep if c in df2.columns], expr.alias(column))
