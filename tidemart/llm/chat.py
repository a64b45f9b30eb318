"""Chat formatting: records of many layouts to canonical turns, and turns to training text with a loss mask.

A row's layout is known by its schema fingerprint: a hash over the sorted paths of its non-null fields (fields of
structures and of the elements of arrays included). The fingerprint selects a declarative mapping; rows without one keep
their place with layout null and no turns, so that nothing is lost unseen. DataFrame functions only.

The template writes a turn as ``<s>[ROLE] role [/ROLE] text</s>``. Control strings inside roles and texts are broken by
a backslash after their first sign, and backslashes are doubled, so the original comes back exactly. The mask gives,
for each turn, the span of its own segment that counts for the loss (the assistant's text).

Defined cases: null text or role is empty; rows of one conversation and turn follow by role and text; a conversation's
rows need not be together; a table without rows gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: strings that mark turns in this or other common templates
CONTROL = ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
OPEN, CLOSE, END = "<s>[ROLE] ", " [/ROLE] ", "</s>"
LEARNED = "assistant"


# --- layouts


@dataclass(frozen=True)
class Mapping:
    """``turns``: (role, path) for one field each, or ``array``: path of an array with its role and text fields."""

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    array: tuple[str, str, str] | None = None

    def paths(self) -> list[str]:
        if self.array:
            path, role, text = self.array
            return [path, f"{path}[].{role}", f"{path}[].{text}"]
        return [p for role, path in self.turns for p in ((path, role[1:]) if role.startswith("$") else (path,))]


# "$field" takes the role from that field
MAPPINGS = (
    Mapping("turn", (("$role", "text"),)),
    Mapping("turn_content", (("$role", "content"),)),
    Mapping("prompt_response", (("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", (("user", "prompt"), ("assistant", "completion"))),
    Mapping("question_answer", (("user", "question"), ("assistant", "answer"))),
    Mapping("system_question_response", (("system", "system_prompt"), ("user", "question"), ("assistant", "response"))),
    Mapping("instruction_output", (("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input_output", (("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("nested_dialog", (("user", "dialog.prompt"), ("assistant", "dialog.response"))),
    Mapping("messages", array=("messages", "role", "content")),
    Mapping("conversations", array=("conversations", "from", "value")),
)
# fixed values: names of one role in other layouts
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def present_paths(schema: T.StructType, only: Iterable[str]) -> Column:
    """The sorted paths of a row's non-null fields, below the columns ``only``, as one string."""
    found: list[tuple[str, Column]] = []

    def in_elements(value: Column, name: str) -> Column:
        return F.coalesce(F.exists(value, lambda x: x[name].isNotNull()), F.lit(False))

    def walk(path: str, value: Column, kind: T.DataType) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f"{path}.{f.name}", value[f.name], f.dataType)
            return
        found.append((path, value.isNotNull()))
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            for f in kind.elementType.fields:
                found.append((f"{path}[].{f.name}", in_elements(value, f.name)))

    for f in schema.fields:
        if f.name in set(only):
            walk(f.name, F.col(f"`{f.name}`"), f.dataType)
    return F.concat_ws("\n", *[F.when(has, F.lit(path)) for path, has in sorted(found, key=lambda x: x[0])])


def fingerprint(paths: Column) -> Column:
    return F.sha2(paths, 256)


def canonical(rows: DataFrame, mappings: Iterable[Mapping] = MAPPINGS, fields: Iterable[str] | None = None) -> DataFrame:
    """``rows`` with ``layout`` and ``turns`` (array of ``role, text``) by the mapping that their fingerprint selects.

    ``fields`` names the columns that make up the record (default: all that some mapping uses).
    """
    mappings = list(mappings)
    roots = {p.split(".")[0].split("[")[0] for m in mappings for p in m.paths()}
    own = [f for f in (fields or rows.columns) if f in roots]
    kind = "array<struct<role:string,text:string>>"
    names = {f.name for f in rows.schema.fields}
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(kind)
    seen = F.col("_fingerprint")
    for m in mappings:
        if not {p.split(".")[0].split("[")[0] for p in m.paths()} <= names & set(own):
            continue
        hit = seen == fingerprint(F.lit("\n".join(sorted(m.paths()))))
        layout = F.when(hit, F.lit(m.name)).otherwise(layout)
        turns = F.when(hit, _turns(m).cast(kind)).otherwise(turns)
    marked = rows.withColumn("_fingerprint", fingerprint(present_paths(rows.schema, own)))
    return marked.withColumn("layout", layout).withColumn("turns", turns).drop("_fingerprint")


def _role(value: Column) -> Column:
    """A role as this library names it, for layouts that use other names."""
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, value), value, F.lit(""))


def _turns(m: Mapping) -> Column:
    if m.array:
        path, role, text = m.array
        return F.transform(
            F.col(path),
            lambda x: F.struct(_role(x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")),
        )
    # a role that is a field of the row stays as it is
    return F.array(
        *[
            F.struct((F.col(role[1:]) if role.startswith("$") else F.lit(role)).alias("role"), F.col(path).alias("text"))
            for role, path in m.turns
        ]
    )


# --- template


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    for c in reversed(CONTROL):
        text = F.replace(text, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def formatted(turns: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``key, formatted, loss_mask`` from rows ``key, *order, role, text``: one row for each conversation.

    ``loss_mask`` has a ``start`` and a ``length`` for each turn, in characters of the turn's segment; length 0 where
    nothing is learned. Segments are made row by row; a conversation's row is its text, put together at the end.
    """
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(CLOSE))
    body = escaped(F.col("text"))
    learned = F.when(F.col("role") == LEARNED, F.length(body)).otherwise(0)
    segment = F.struct(
        *order, "role", "text", F.concat(head, body, F.lit(END)).alias("segment"), F.length(head).alias("start"),
        learned.alias("length"),
    )
    gathered = turns.groupBy(key).agg(F.array_sort(F.collect_list(segment)).alias("_all"))
    return gathered.select(
        key,
        F.array_join(F.transform("_all", lambda x: x["segment"]), "").alias("formatted"),
        F.transform("_all", lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_mask"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """Adds ``turns`` (``role, text`` as they were) and ``loss_text`` (all text under the mask), from the output alone."""
    inside = F.expr(f"substring(formatted, 1, length(formatted) - {len(END)})")
    segments = F.split(inside, "</s>", -1)
    body = lambda s: F.substring(s, F.lit(len(OPEN) + 1), F.length(s))
    turn = lambda s: F.struct(
        unescaped(F.substring_index(body(s), CLOSE, 1)).alias("role"),
        unescaped(F.substring(body(s), F.length(F.substring_index(body(s), CLOSE, 1)) + len(CLOSE) + 1, F.length(s))).alias("text"),
    )
    learned = F.zip_with(segments, "loss_mask", lambda s, m: unescaped(F.substring(s, m["start"] + 1, m["length"])))
    return chats.withColumn("turns", F.transform(segments, turn)).withColumn("loss_text", F.array_join(learned, ""))


def digests(chats: DataFrame, key: str) -> DataFrame:
    """``key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read back from formatted text."""
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(chats).select(
        key,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
