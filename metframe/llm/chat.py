"""Chat records of many layouts as canonical turns, and their formatting with a loss mask.

A layout is declared: which nested field paths a record of it has, and which turns they make. The paths that a record
has are hashed to a fingerprint of its schema, and the fingerprint selects the layout. Everything is done by
DataFrame functions. A conversation is one row, as its formatted text is.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

TURNS = "array<struct<role:string,text:string>>"
ESCAPE = "\\"

# Strings that templates and tokenizers in wide use read as control marks.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

# Other names of the roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Say:
    """One turn of a fixed role; left out where the field is missing. Several paths are joined by an empty line."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Each:
    """A turn for every entry of an array of objects."""

    array: str
    role: str
    text: str
    names: dict[str, str] | None = None  # canonical names of roles


@dataclass(frozen=True)
class InTurn:
    """An array of texts whose speakers take turns."""

    array: str
    roles: tuple[str, ...] = ("user", "assistant")


@dataclass(frozen=True)
class Layout:
    name: str
    turns: tuple[Say | Each | InTurn, ...]
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        out = []
        for turn in self.turns:
            if isinstance(turn, Say):
                out += turn.paths
            elif isinstance(turn, Each):
                out += [f"{turn.array}[].{turn.role}", f"{turn.array}[].{turn.text}"]
            else:
                out.append(f"{turn.array}[]")
        return out


LAYOUTS = [
    Layout("prompt", (Say("system", ("system",)), Say("user", ("prompt",)), Say("assistant", ("response",))), ("system", "response")),
    Layout("completion", (Say("user", ("prompt",)), Say("assistant", ("completion",))), ("completion",)),
    Layout("instruction", (Say("system", ("system",)), Say("user", ("instruction", "input")), Say("assistant", ("output",))), ("system", "input", "output")),
    Layout("question", (Say("user", ("question",)), Say("assistant", ("answer",))), ("answer",)),
    Layout("messages", (Each("messages", "role", "content"),), ("messages[].content",)),
    Layout("conversations", (Each("conversations", "from", "value", ROLES),), ("conversations[].value",)),
    Layout("request", (Say("system", ("request.system",)), Each("request.messages", "role", "content"), Say("assistant", ("reply.text",))), ("request.system", "reply.text")),
    Layout("dialog", (InTurn("dialog"),)),
]


def record_schema(paths: Sequence[str]) -> str:
    """The schema of all paths together; whatever else a record has is not read."""
    heads: dict[str, list[str]] = {}
    for path in sorted(set(paths)):
        head, _, rest = path.partition(".")
        heads.setdefault(head, []).append(rest)
    fields = []
    for head, rests in heads.items():
        inner = [r for r in rests if r]
        if inner and len(inner) < len(rests) or f"{head}[]" in heads:
            raise ValueError(f"{head} has more than one shape")
        kind = f"struct<{record_schema(inner)}>" if inner else "string"
        fields.append(f"`{head.removesuffix('[]')}`:" + (f"array<{kind}>" if head.endswith("[]") else kind))
    return ",".join(fields)


def at(record: Column, path: str) -> Column:
    for name in path.split("."):
        record = record.getField(name)
    return record


def present(record: Column, path: str) -> Column:
    """Does the record have the path, in one entry at least where it leads through an array?"""
    head, through, rest = path.partition("[]")
    if not through:
        return at(record, path).isNotNull()
    return F.coalesce(F.exists(at(record, head), lambda e: present(e, rest.removeprefix(".")) if rest else e.isNotNull()), F.lit(False))


def hashed(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def fingerprint(record: Column, layouts: Sequence[Layout]) -> Column:
    """The hash of those declared paths, in order of their names, that the record has. A JSON null is no field."""
    paths = sorted({p for layout in layouts for p in layout.paths()})
    return hashed(F.array_compact(F.array(*[F.when(present(record, p), F.lit(p)) for p in paths])))


def schemas_of(layout: Layout) -> list[list[str]]:
    """The sets of paths by which a layout is known: with and without each of the optional ones."""
    fixed = [p for p in layout.paths() if p not in layout.optional]
    return [
        sorted({*fixed, *extra}) for n in range(len(layout.optional) + 1) for extra in itertools.combinations(layout.optional, n)
    ]


def turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def turns_of(record: Column, layout: Layout) -> Column:
    none, parts = F.array().cast(TURNS), []
    for part in layout.turns:
        if isinstance(part, Say):
            texts = F.array_compact(F.array(*[at(record, p) for p in part.paths]))
            parts.append(F.when(F.size(texts) > 0, F.array(turn(F.lit(part.role), F.array_join(texts, "\n\n")))).otherwise(none))
        elif isinstance(part, Each):
            parts.append(F.coalesce(F.transform(at(record, part.array), lambda e: turn(named(e.getField(part.role), part.names or {}), e.getField(part.text))), none))
        else:
            speakers = F.array(*map(F.lit, part.roles))
            parts.append(F.coalesce(F.transform(at(record, part.array), lambda e, i: turn(F.get(speakers, i % F.size(speakers)), e)), none))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def named(role: Column, names: dict[str, str]) -> Column:
    for name, known in names.items():
        role = F.when(role == name, known).otherwise(role)
    return role


def canonical(records: DataFrame, record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """The rows with the columns ``fingerprint``, ``layout`` and ``turns`` (an array of role and text).

    ``record`` is a JSON text. Fields that no layout declares are not looked at; values that are no text, where a text
    is declared, are taken as their JSON. Records that are null, no JSON or of a schema that no layout has get a null
    layout and no turns, and stay. Missing roles and texts inside an array are empty. Of two layouts with one schema
    the first counts. Columns of the three names are replaced, all others kept; rows are looked at each for itself.
    """
    schema = record_schema([p for layout in layouts for p in layout.paths()])
    parsed = records.withColumn("turns", F.from_json(F.col(f"`{record}`").cast("string"), f"struct<{schema}>", {"mode": "PERMISSIVE"}))
    marked = parsed.withColumn("fingerprint", fingerprint(F.col("turns"), layouts))
    name, turns = None, None
    for layout in layouts:
        fits = F.col("fingerprint").isin([hashed(F.array(*map(F.lit, paths))) for paths in schemas_of(layout)])
        name = (F if name is None else name).when(fits, F.lit(layout.name))
    marked = marked.withColumn("layout", name)
    for layout in layouts:
        turns = (F if turns is None else turns).when(F.col("layout") == layout.name, turns_of(F.col("turns"), layout))
    return marked.withColumn("turns", turns.otherwise(F.array().cast(TURNS)))


@dataclass(frozen=True)
class Template:
    """The marks before a role, between role and text, and after a text. Each starts with a control string."""

    start: str = "<|im_start|>"
    says: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    control: tuple[str, ...] = tuple(CONTROL)

    def escaped(self, text: Column) -> Column:
        """The text without control strings: an escape stands after the first sign of each, and before each escape."""
        firsts = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.control)
        return F.regexp_replace(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2)), f"({firsts})", r"$1\\")

    def plain(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(df: DataFrame, turns: str = "turns", template: Template = Template(), learn: Sequence[str] = ("assistant",)) -> DataFrame:
    """The rows with the columns ``formatted``, one text of all turns, and ``loss``: for each turn the start and the
    length, in code points from the turn's own start, of the text that a model learns from, which is that of the
    roles ``learn`` without any marks. The length is 0 for other turns. No turns (or null) give an empty text."""
    head = F.lit(len(template.start) + len(template.says))
    safe = F.transform(F.coalesce(F.col(f"`{turns}`"), F.array().cast(TURNS)), lambda t: F.struct(
        template.escaped(F.coalesce(t.role, F.lit(""))).alias("role"), template.escaped(F.coalesce(t.text, F.lit(""))).alias("text"),
        F.coalesce(t.role.isin(list(learn)), F.lit(False)).alias("learnt")))
    text = F.array_join(F.transform("formatted", lambda t: F.concat(F.lit(template.start), t.role, F.lit(template.says), t.text, F.lit(template.end))), "")
    loss = F.transform("formatted", lambda t: F.struct(
        (head + F.length(t.role)).alias("start"), F.when(t.learnt, F.length(t.text)).otherwise(0).alias("length")))
    return df.withColumn("formatted", safe).withColumns({"formatted": text, "loss": loss})


def read_back(df: DataFrame, template: Template = Template()) -> DataFrame:
    """The rows with ``turns`` and ``learnt`` (the text under the mask) as the columns ``formatted`` and ``loss`` have them."""
    parts = F.split("formatted", re.escape(template.end))
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def parsed(part: Column) -> Column:
        body = F.substring(part, F.lit(len(template.start) + 1), F.length(part))
        role = F.substring_index(body, template.says, 1)
        return F.struct(template.plain(role).alias("role"), template.plain(F.substring(body, F.length(role) + len(template.says) + 1, F.length(body))).alias("text"))

    learnt = F.zip_with(parts, "loss", lambda part, span: template.plain(F.substring(part, span.start + 1, span.length)))
    return df.withColumns({"turns": F.transform(parts, parsed), "learnt": F.array_join(learnt, "")})


def records_of(rows: DataFrame, conv_id: str = "conv_id", turn_no: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One JSON record per conversation (``conv_id``, ``record``) of a table with a row per turn.

    Turns go by their number, null ones first, those of one number by role and text; repeated rows stay. Null roles
    and texts are empty; rows without a conversation are one conversation. A record has the layout that fits its
    roles: prompt and response, instruction and output, a list of who says what, or else messages.
    """
    said = F.struct(F.col(f"`{turn_no}`").alias("turn"), *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))))
    grouped = rows.groupBy(F.col(f"`{conv_id}`").alias("conv_id")).agg(F.sort_array(F.collect_list(said)).alias("said"))
    roles, one = F.transform("said", lambda t: t.role), lambda i, name: F.get("said", F.lit(i)).text.alias(name)
    back = {known: name for name, known in reversed(ROLES.items())}
    listed = F.transform("said", lambda t: F.struct(named(t.role, back).alias("from"), t.text.alias("value")))
    record = (
        F.when(roles == F.array(F.lit("user"), F.lit("assistant")), F.to_json(F.struct(one(0, "prompt"), one(1, "response"))))
        .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), F.to_json(F.struct(one(0, "system"), one(1, "instruction"), one(2, "output"))))
        .when(F.forall(roles, lambda r: r.isin("system", "user", "assistant")), F.to_json(F.struct(listed.alias("conversations"))))
        .otherwise(F.to_json(F.struct(F.transform("said", lambda t: F.struct(t.role, t.text.alias("content"))).alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))
