"""Prompt templates as single ``concat`` expressions."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Template texts and prompt frames whose wording decides the result.
INSTRUCTION_TEMPLATE = (
    "Below is an instruction that describes a task. Write a response that appropriately completes the request.\n"
    "\n### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n"
)
NO_INPUT_TEMPLATE = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n \n### Instruction:\n{instruction}\n\n### Response:\n"
)
TRAIN_TEMPLATE = "{instruction}\n{input}\n{output}"
COMPARE_TEMPLATE = "{background}{chat_history}{question}"
STUFF_TEMPLATE = (
    "Below is an instruction that describes a task. Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{context}\n{question}\n\n### Response: "
)
FIRST_ANSWER_TEMPLATE = (
    "Below is an instruction that describes a task. Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n以下为背景知识：\n{context_str}\n请根据以上背景知识, 回答这个问题：{question}。\n\n### Response: "
)
REFINE_TEMPLATE = (
    "Below is an instruction that describes a task. Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n这是原始问题: {question}\n已有的回答: {existing_answer}\n"
    "现在还有一些文字，（如果有需要）你可以根据它们完善现有的回答。\n\n{context_str}\n\\nn"
    "请根据新的文段，进一步完善你的回答。\n\n### Response: "
)
RATING_TEMPLATE = "Rate the following answer on a scale of 1 to 10 (10 being the highest): {answer}"
IMPORTANCE_TEMPLATE = (
    "On the scale of 1 to 10, where 1 is not important at all (e.g., 小队休整, 招募队员) and 10 is"
    " extremely important (e.g., 保护猎人队长, 与龙兽战斗 acceptance), rate the importance of the"
    " following piece of memory. You must respond with a single integer."
    "\nMemory: 雪莉受伤了，需要治疗\nRating: 9\nMemory: 招募新的队员\nRating: 5\nMemory: {memory_content}\nRating: "
)
ENTITY_FRAME = "Extract the entity from the following observation without explanation.\nObservation: {observation}\n"
ACTION_FRAME = "What is the {entity} doing in the following observation?\nObservation: {observation}\n"
RELATION_FRAME = (
    "What is the relationship between {name} and {entity}?\nContext from memory:\n{relevant_memories}\nRelevant context:"
)
SPEAKER_FRAME = (
    "what is the most possible relationship between {name} and {speaker} in the following observation? "
    "Do not embellish if you don't know. Do not return a list.\nObservation: {relevant_memories}\n"
)
SELF_FRAME = (
    "Summarize {name}'s core characteristics given the following input. Do not embellish if you don't know. "
    "Do not return a list.\nInput: {relevant_memories}\n"
)
DIALOGUE_FRAME = (
    "{summary}\nIt is {current_time}.\n{name}'s status: {status}\n"
    "Summary of relevant context from {name}'s memory:\n{relevant_memories}\n"
    "Most recent observations: {most_recent_memories}\nObservation: {speaker} says {observation}\n\n"
    "What would {name} say? To end the conversation, write: GOODBYE: \"what to say\". "
    "Otherwise to continue the conversation, write: SAY: \"what to say next\"\n\n"
)
TIME_FORMAT = "MMMM dd, yyyy, hh:mm a"


def template_fields(template: str) -> list[str]:
    return [field for _, field, _, _ in Formatter().parse(template) if field is not None]


def fill_template(template: str, fields: Mapping[str, Column]) -> Column:
    """``template.format(**fields)`` as one pass over the row; a null field prints as ``''``.

    A field the template needs and ``fields`` lacks is an error when the plan is built.
    """
    parts: list[Column] = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if field is not None:
            if field not in fields:
                raise KeyError(f"template needs {field!r}")
            parts.append(F.coalesce(fields[field].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def fill_template_optional_input(
    fields: Mapping[str, Column], with_input: str = INSTRUCTION_TEMPLATE, without_input: str = NO_INPUT_TEMPLATE
) -> Column:
    """Another template where ``input`` is empty; only the fields a template names must be there."""
    empty = F.coalesce(fields["input"], F.lit("")) == ""
    return F.when(empty, fill_template(without_input, fields)).otherwise(fill_template(with_input, fields))


def persona_prompt(template: Column, user: Column, ai: Column, at: Column) -> Column:
    """Replace the four ``[[...]]`` marks literally; single brackets stay."""
    out = F.replace(template, F.lit("[[USER_NAME]]"), user)
    out = F.replace(out, F.lit("[[AI_NAME]]"), ai)
    out = F.replace(out, F.lit("[[DATE_TIME]]"), F.date_format(at, "HH:mm"))
    return F.replace(out, F.lit("[[DATE_YEAR]]"), F.date_format(at, "yyyy"))


def compare_prompt(
    question: Column,
    background: Column,
    history: Column,
    *,
    template: str | None = None,
    use_background: Column | None = None,
    use_history: Column | None = None,
) -> Column:
    """Prompt of one answering system; an absent or empty template means plain concatenation."""
    on = F.lit(True)
    return fill_template(
        template or COMPARE_TEMPLATE,
        {
            "question": question,
            "background": F.when(on if use_background is None else use_background, background).otherwise(""),
            "chat_history": F.when(on if use_history is None else use_history, history).otherwise(""),
        },
    )


def agent_prompts(fields: Mapping[str, Column], system: str = "### {task}\n### Response:") -> dict[str, Column]:
    """The six prompt frames of a game character, by name.

    ``system`` wraps the four task frames; relation and dialogue frames stand alone.
    """
    head, tail = (fill_template(s, {}) for s in system.split("{task}"))

    def framed(frame: str) -> Column:
        return F.concat(head, fill_template(frame, fields), tail)

    return {
        "entity": framed(ENTITY_FRAME),
        "action": framed(ACTION_FRAME),
        "relation": fill_template(RELATION_FRAME, fields),
        "speaker": framed(SPEAKER_FRAME),
        "self": framed(SELF_FRAME),
        "dialogue": fill_template(DIALOGUE_FRAME, fields),
    }
