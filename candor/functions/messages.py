"""Messages as ARRAY<STRUCT<role, content, channel, recipient, content_type>>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candor.functions import jsontext as J
from candor.functions.text import bind, blank_to_null, boxed, non_empty, strip, tag_body

MESSAGE = "struct<role:string,content:string,channel:string,recipient:string,content_type:string>"
MESSAGES = f"array<{MESSAGE}>"
JSON_OPTIONS = {"ignoreNullFields": "false"}


def message(role: Column | str, content: Column, channel: Column | str | None = None) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    channel = F.lit(channel) if not isinstance(channel, Column) else channel
    return F.struct(
        role.alias("role"), content.alias("content"), channel.alias("channel"),
        F.lit(None).alias("recipient"), F.lit(None).alias("content_type"),
    ).cast(MESSAGE)


def from_json_text(text: Column) -> Column:
    """Stored JSON text -> messages; NULL when unreadable."""
    return F.from_json(text, MESSAGES)


def to_json_text(messages: Column) -> Column:
    return F.to_json(messages, JSON_OPTIONS)


def first_content(messages: Column, keep) -> Column:
    """Content of the first message for which `keep(message)` holds; NULL if none."""
    return F.get(F.filter(messages, keep), F.lit(0))["content"]


def usable_question(messages: Column, min_length: int = 5) -> Column:
    """First user message (any role case) that is not blank, not '-' and long enough."""

    def keep(m: Column) -> Column:
        body = strip(m["content"])
        return (F.lower(m["role"]) == "user") & (body != "") & (body != "-") & (F.length(body) >= min_length)

    return strip(first_content(messages, keep))


def first_user_question(messages: Column) -> Column:
    """First user message only; NULL when it is blank or '-'."""
    body = strip(first_content(messages, lambda m: m["role"] == "user"))
    return F.when((body != "") & (body != "-"), body)


def first_user_text(messages: Column) -> Column:
    """First user message, stripped, without the placeholder rule."""
    return strip(first_content(messages, lambda m: m["role"] == "user"))


def question_of(messages: Column) -> Column:
    """Content of the first user message as is, '' if there is none."""
    return F.coalesce(first_content(messages, lambda m: m["role"] == "user"), F.lit(""))


def stored_question(text: Column) -> Column:
    """Question from stored JSON text; '' on bad JSON."""
    return question_of(from_json_text(text))


def assistant_truth(messages: Column) -> Column:
    """Truth held in the messages: the first non-blank assistant content, reduced to its boxed part if any."""
    content = first_content(messages, lambda m: (m["role"] == "assistant") & non_empty(m["content"]))
    return F.coalesce(blank_to_null(boxed(content)), content)


def ground_truth(messages: Column, *columns: Column) -> Column:
    """First non-NULL truth column, else the truth held in the messages."""
    return F.coalesce(*columns, assistant_truth(messages))


def record_answer(messages: Column) -> Column:
    """First final-channel content, reduced to its answer tag if it has one; '' without a final message."""
    content = first_content(messages, lambda m: m["channel"] == "final")
    return F.coalesce(blank_to_null(tag_body(content, "answer")), content, F.lit(""))


def analysis_tag(messages: Column, tag: str) -> Column:
    """Tag body in the first analysis-channel message; '' if absent."""
    content = first_content(messages, lambda m: m["channel"] == "analysis")
    return F.coalesce(tag_body(content, tag), F.lit(""))


def answer_text(final_answer: Column, structured: Column) -> Column:
    """Text that gets scored: structured answers as they are, others reduced to their answer tag."""
    return F.when(structured, final_answer).otherwise(
        F.coalesce(blank_to_null(tag_body(final_answer, "answer")), final_answer)
    )


def full_text(messages: Column) -> Column:
    """All contents joined by newline, '' for no messages."""
    contents = F.transform(messages, lambda m: F.coalesce(m["content"], F.lit("")))
    return F.coalesce(F.array_join(contents, "\n"), F.lit(""))


def final_text(messages: Column) -> Column:
    """First final-channel content, '' if there is none."""
    return F.coalesce(first_content(messages, lambda m: m["channel"] == "final"), F.lit(""))


def total_length(messages: Column) -> Column:
    """Sum of all content lengths."""
    lengths = F.transform(messages, lambda m: F.coalesce(F.length(m["content"]), F.lit(0)))
    return F.coalesce(F.aggregate(lengths, F.lit(0), lambda total, n: total + n), F.lit(0))


def fill_template(template: str, question: Column) -> Column:
    """`template` with `{question}` filled in and doubled braces made single."""
    head, _, tail = template.partition("{question}")
    pieces = [F.lit(part.replace("{{", "{").replace("}}", "}")) for part in (head, tail)]
    return F.concat(pieces[0], question, pieces[1])


def prompt_for(split: Column, question: Column, templates: dict[str, str], default: str) -> Column:
    """Prompt text from the template of the split."""
    prompt = fill_template(default, question)
    for name, template in templates.items():
        prompt = F.when(split == name, fill_template(template, question)).otherwise(prompt)
    return prompt


# Fixed value: system text used when no persona is set.
DEFAULT_SYSTEM = "You are a helpful assistant."


def input_messages(prompt: Column, persona: Column | None = None, developer: bool = False) -> Column:
    """system [+ developer] + user. The persona replaces the system text unless it has its own developer turn."""
    default = F.lit(DEFAULT_SYSTEM)
    user = message("user", prompt)
    if persona is None:
        return F.array(message("system", default), user)
    if not developer:
        return F.array(message("system", F.coalesce(blank_to_null(persona), default)), user)
    with_developer = F.array(message("system", default), message("developer", persona), user)
    return F.when(non_empty(persona), with_developer).otherwise(F.array(message("system", default), user))


def _step_json(step: Column, index: Column) -> Column:
    body = F.struct(
        (index + 1).alias("step"),
        F.coalesce(step["explanation"], F.lit("")).alias("explanation"),
        F.coalesce(step["output"], F.lit("")).alias("output"),
    )
    return F.to_json(body)


def step_messages(steps: Column, final_answer: Column) -> Column:
    """One reasoning message per step, then the final answer if there is one."""
    reasoning = F.transform(steps, lambda s, i: message("assistant", _step_json(s, i), "reasoning"))
    final = F.when(non_empty(final_answer), F.array(message("assistant", final_answer, "final"))).otherwise(
        F.array().cast(MESSAGES)
    )
    return F.concat(F.coalesce(reasoning, F.array().cast(MESSAGES)), final)


def steps_text(steps: Column) -> Column:
    """`Step k: ...` blocks separated by a blank line, '' without steps."""
    blocks = F.transform(
        steps,
        lambda s, i: F.concat(F.lit("Step "), (i + 1).cast("string"), F.lit(": "), s["explanation"], F.lit("\n"), s["output"]),
    )
    return F.coalesce(F.array_join(blocks, "\n\n"), F.lit(""))


def steps_json(steps: Column) -> Column:
    """JSON form of the steps, as stored for the analysis text."""
    return F.to_json(F.struct(F.lit("reasoning_steps").alias("type"), steps.alias("steps")))


TURNS = "array<struct<role:string,content:string,tool_call_id:string,name:string,tool_calls:array<struct<id:string,name:string,arguments:string>>>>"


def conversation_messages(turns: Column, tools_json: Column | None = None) -> Column:
    """Tool conversation -> output messages: tool calls, tool results and the final answer; user turns drop out."""

    def convert(turn: Column) -> Column:
        calls = F.coalesce(turn["tool_calls"], F.array().cast("array<struct<id:string,name:string,arguments:string>>"))
        result = F.to_json(F.struct(
            F.coalesce(turn["tool_call_id"], F.lit("")).alias("tool_call_id"),
            F.coalesce(turn["name"], F.lit("unknown")).alias("name"),
            F.coalesce(turn["content"], F.lit("")).alias("result"),
        ))
        request = F.to_json(F.struct(F.coalesce(turn["content"], F.lit("")).alias("thinking"), calls.alias("tool_calls")))
        return (
            F.when(turn["role"] == "tool", message("tool", result, "tool_result"))
            .when(F.size(calls) > 0, message("assistant", request, "tool_call"))
            .otherwise(message("assistant", F.coalesce(turn["content"], F.lit("")), "final"))
        )

    kept = F.transform(F.filter(turns, lambda t: t["role"].isin("tool", "assistant")), convert)
    if tools_json is None:
        return kept
    tools = F.array(message("system", tools_json, "tools"))
    return F.when(non_empty(tools_json), F.concat(tools, kept)).otherwise(kept)


#: What is read of a block. A cast to these members makes no map of all members.
BLOCKS = "array<struct<type:string,text:variant,id:variant,name:variant,input:variant,tool_use_id:variant,content:variant>>"


def block_conversation_messages(turns_json: Column, tools_json: Column | None = None) -> Column:
    """Same for the block layout: content is text or a list of text, tool_use and tool_result blocks.

    The first turn, the prompt itself, drops out.
    """
    nothing = F.array().cast(MESSAGES)

    def of_type(blocks: Column, block_type: str) -> Column:
        return F.filter(blocks, lambda b: b["type"] == block_type)

    def text_field(block: Column, name: str) -> Column:
        return F.coalesce(J.text_of(block[name]), J.canonical(block[name]), F.lit(""))

    def tool_results(blocks: Column) -> Column:
        def result(block: Column) -> Column:
            body = F.struct(text_field(block, "tool_use_id").alias("tool_use_id"), text_field(block, "content").alias("content"))
            return message("tool", F.to_json(body), "tool_result")

        return F.transform(of_type(blocks, "tool_result"), result)

    def assistant_message(parts: Column) -> Column:
        call = F.to_json(F.struct(parts["texts"].alias("thinking"), parts["calls"].alias("tool_calls")))
        return F.when(F.size(parts["calls"]) > 0, message("assistant", call, "tool_call")).otherwise(
            message("assistant", F.coalesce(parts["plain"], parts["texts"]), "final")
        )

    def assistant_parts(blocks: Column, plain: Column) -> Column:
        texts = F.transform(of_type(blocks, "text"), lambda b: text_field(b, "text"))
        calls = F.transform(
            of_type(blocks, "tool_use"),
            lambda b: F.struct(
                text_field(b, "id").alias("id"), text_field(b, "name").alias("name"),
                F.coalesce(b["input"], F.parse_json(F.lit("{}"))).alias("input"),
            ),
        )
        return F.struct(F.coalesce(F.array_join(texts, "\n"), F.lit("")).alias("texts"), calls.alias("calls"), plain.alias("plain"))

    def convert(turn: Column) -> Column:
        def by_role(role: Column) -> Column:
            blocks = turn["content"].try_cast(BLOCKS)
            # Only what is no list can be text.
            answer = bind(bind(blocks, lambda b: assistant_parts(b, F.when(b.isNull(), J.text_of(turn["content"])))), assistant_message)
            return (
                F.when(role == "user", F.coalesce(bind(blocks, tool_results), nothing))
                .when(role == "assistant", F.array(answer))
                .otherwise(nothing)
            )

        return by_role(turn["role"])

    turns = J.parse(turns_json).try_cast("array<struct<role:string,content:variant>>")
    kept = bind(turns, lambda t: F.flatten(F.transform(F.slice(t, F.lit(2), F.greatest(F.size(t), F.lit(1))), convert)))
    if tools_json is None:
        return kept
    tools = F.array(message("system", tools_json, "tools"))
    return F.when(non_empty(tools_json), F.concat(tools, kept)).otherwise(kept)


TOOLS = "array<struct<name:string,description:string,parameters:variant>>"


def tools_in(metadata: Column) -> Column:
    """`tools[]` of a metadata JSON text, its three definition shapes unified; NULL when there are none."""


    def definition(chosen: Column) -> Column:
        return F.struct(
            F.coalesce(J.text_of(J.field(chosen, "name")), F.lit("")).alias("name"),
            F.coalesce(J.text_of(J.field(chosen, "description")), F.lit("")).alias("description"),
            F.coalesce(J.field(chosen, "input_schema"), J.field(chosen, "parameters"), F.parse_json(F.lit("{}"))).alias("parameters"),
        )

    def chosen_part(top: Column) -> Column:
        """The nested function object, unless the definition is flat."""
        is_flat = F.map_contains_key(top, "input_schema") | F.map_contains_key(top, "name")
        return F.when(is_flat, top).otherwise(F.coalesce(J.as_object(J.field(top, "function")), top))

    def unify(item: Column) -> Column:
        return bind(bind(J.as_object(item), chosen_part), definition)

    items = J.as_items(J.field(J.as_object(J.parse(metadata)), "tools"))
    return bind(items, lambda i: F.when(F.size(i) > 0, F.transform(i, unify)))


def conversation(inputs: Column, outputs: Column) -> Column:
    """Input messages followed by output messages."""
    return F.concat(inputs, outputs)
