"""Prompts for, and typed records from, the three annotation tasks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliosift import values
from foliosift.functions.json_values import is_json_object

PLACEHOLDER = "{input}"


@dataclass(frozen=True)
class Task:
    """An annotation task: its prompt, its answer fields and their allowed values."""

    name: str
    output: str
    template: str
    fields: tuple[tuple[str, str], ...]
    enums: tuple[tuple[str, tuple[str, ...]], ...]

    @property
    def error(self) -> str:
        return values.FAILURE_MESSAGES[self.name]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.fields)

    def json_schema(self) -> dict:
        """The answer format as a JSON schema, for backends that take one."""
        enums = dict(self.enums)
        properties = {}
        for name, kind in self.fields:
            text = {"type": "string"} | ({"enum": list(enums[name])} if name in enums else {})
            properties[name] = {"type": "array", "items": text} if kind.startswith("array") else text
        return {
            "type": "object",
            "properties": properties,
            "required": [name for name, _ in self.fields],
        }


DIFFICULTY = Task(
    name="difficulty",
    output="difficulty_rating",
    template=(
        "Read the request between the markers and judge how hard it is to answer.\n"
        "<request>\n{input}\n</request>\n"
        "Say what the person wants (intent) and what one must know (knowledge). Grade the\n"
        "difficulty as one of: very easy, easy, medium, hard, very hard.\n"
        'Answer with one JSON object: {"intent": ..., "knowledge": ..., "difficulty": ...}\n'
    ),
    fields=(("intent", "string"), ("knowledge", "string"), ("difficulty", "string")),
    enums=(("difficulty", values.DIFFICULTY_LEVELS),),
)
QUALITY = Task(
    name="quality",
    output="quality_rating",
    template=(
        "Read the request between the markers and judge how well it is put: is it clear,\n"
        "specific and coherent?\n"
        "<request>\n{input}\n</request>\n"
        "Explain its strong and weak points first. Then grade it as one of: very poor (cannot\n"
        "be understood), poor (needs much clarification), average (some context missing), good\n"
        "(well formed), excellent (complete and precise).\n"
        'Answer with one JSON object: {"explanation": ..., "quality": ...}\n'
    ),
    fields=(("explanation", "string"), ("quality", "string")),
    enums=(("quality", values.QUALITY_LEVELS),),
)
CLASSIFICATION = Task(
    name="classification",
    output="classification",
    template=(
        "Read the request between the markers and sort it by the kind of work it asks for.\n"
        "<request>\n{input}\n</request>\n"
        "Choose one main tag, and list every further tag that applies, from: "
        + ", ".join(values.TASK_TAGS)
        + ".\n"
        'Answer with one JSON object: {"primary_tag": ..., "other_tags": [...]}\n'
    ),
    fields=(("primary_tag", "string"), ("other_tags", "array<string>")),
    enums=(("primary_tag", values.TASK_TAGS), ("other_tags", values.TASK_TAGS)),
)
TASKS = {task.name: task for task in (DIFFICULTY, QUALITY, CLASSIFICATION)}


def build_prompt(col: Column, task: Task) -> Column:
    """The task's prompt with the text put in; braces in the text are kept as they are."""
    return F.replace(F.lit(task.template), F.lit(PLACEHOLDER), col)


def parse_annotation(response: Column, task: Task) -> Column:
    """The answer as a struct; null for an empty, missing or malformed answer."""
    record = F.from_json(response, task.ddl, {"mode": "PERMISSIVE"})
    fields = [record[name].alias(name) for name, _ in task.fields]
    return F.when(is_json_object(response), F.struct(*fields))


def validate_annotation(record: Column, task: Task) -> Column:
    """True if every field is there and every enum field holds allowed values."""
    checks = record.isNotNull()
    kinds = dict(task.fields)
    for name in kinds:
        checks = checks & record[name].isNotNull()
    for name, allowed in task.enums:
        if kinds[name].startswith("array"):
            inside = F.forall(record[name], lambda tag: F.coalesce(tag.isin(*allowed), F.lit(False)))
        else:
            inside = record[name].isin(*allowed)
        checks = checks & inside
    return F.coalesce(checks, F.lit(False))


def with_error_placeholder(record: Column, task: Task, valid: Column | None = None) -> Column:
    """The record with a null ``error``, or only the task's error message."""
    valid = validate_annotation(record, task) if valid is None else valid
    good = [record[name].alias(name) for name, _ in task.fields]
    none = [F.lit(None).cast(kind).alias(name) for name, kind in task.fields]
    return F.when(
        valid, F.struct(*good, F.lit(None).cast("string").alias("error"))
    ).otherwise(F.struct(*none, F.lit(task.error).alias("error")))


def annotation(response: Column, task: Task) -> Column:
    """Response text to checked record, in one step."""
    return with_error_placeholder(parse_annotation(response, task), task)
