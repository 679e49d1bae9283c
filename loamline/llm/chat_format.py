"""Chat formatting: records of many layouts to canonical turns, then to one marked-up text.

1. Schema fingerprinting. A record's nested field paths, whatever its values, make its shape
   (``OBJECT<messages: ARRAY<OBJECT<content: ?, role: ?>>>``); the SHA-256 of the shape is its
   fingerprint. A layout is declared by the paths it has and may have, and by where its turns
   are. Fingerprints of all layouts are worked out once; a record's fingerprint selects the
   layout whose declaration reads it. JSON records are fingerprinted one by one; so are the
   rows of a typed frame, whose NULL or empty lists change their shape.
2. Canonical turns (conv, place, role, text), one row a turn.
3. The template writes ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn. Inside texts and
   roles every ``<|`` gets a backslash in the middle (and each ``<\\|`` one more), so markers
   stand only where the template puts them and the text can be restored exactly. Roles also
   have ``%`` and line feeds as ``%25`` and ``%0A``. The loss mask of a turn is the span of its
   text in the formatted turn, for the roles that are learnt.
4. The output is a table in the shared folder, range-partitioned by conversation and place, one
   row a turn: a conversation's rows in order, put together, are its formatted text. So a
   conversation of any length is spread over tasks and never held whole.
5. Reading back parses the formatted turns and restores texts; hashes are carried from turn to
   turn. A hash over a whole conversation is sequential, so one conversation's turns pass one
   task, a row at a time.

Fingerprints, mappings and formatting are DataFrame expressions; only reading back is Python.

Defined results: null text and null role are empty. A record whose shape no layout declares, or
that is no JSON, has no layout and no turns; ``profiled`` lists such shapes with their counts.
Records without turns give no rows. Null conversation ids are one conversation; turns with equal
ids and places are ordered by role and text; null places come first. Columns of the input beyond
those named take no part. An empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamline.llm.shared import scratch_uri

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNT = ("assistant",)
#: Names of roles in other layouts.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Listed:
    """Turns are the items of a list."""

    path: str
    role: str
    text: str
    #: Field of the items of a text that is itself a list of parts.
    part: str | None = None


@dataclass(frozen=True)
class Fields:
    """Turns are fields of the record: (role, paths put together by blank lines)."""

    turns: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Single:
    """The record is one turn of a conversation."""

    place: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    """``paths`` every record has; ``also`` are paths it may have. ``[]`` marks items of a list."""

    name: str
    turns: Listed | Fields | Single
    paths: tuple[str, ...]
    also: tuple[str, ...] = ()
    conv: str = "conv_id"
    roles: dict[str, str] = field(default_factory=lambda: ROLES, hash=False)

    def shapes(self) -> list[str]:
        found = []
        for n in range(len(self.also) + 1):
            for more in combinations(self.also, n):
                paths = [*self.paths, *more]
                found.append(shape_of(paths))
                if isinstance(self.turns, Listed):
                    # The list may be null or empty.
                    inside = self.turns.path + "[]"
                    others = [p for p in paths if not p.startswith(inside)]
                    found += [shape_of([*others, self.turns.path]), shape_of([*others, inside])]
        return list(dict.fromkeys(found))


_ID = ("conv_id", "id")


LAYOUTS = (
    Layout("turn rows", Single("turn", "role", "text"), ("conv_id", "turn", "role", "text"), roles={}),
    *(
        layout
        for name in _ID
        for layout in (
            Layout("messages", Listed("messages", "role", "content"), (name, "messages[].role", "messages[].content"), ("source",), name),
            Layout(
                "messages in parts", Listed("messages", "role", "content", "text"),
                (name, "messages[].role", "messages[].content[].type", "messages[].content[].text"), ("source",), name,
            ),
            Layout(
                "conversations", Listed("conversations", "from", "value"),
                (name, "conversations[].from", "conversations[].value"), ("source",), name,
            ),
            Layout(
                "instruction", Fields((("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
                (name, "instruction", "output"), ("input", "system"), name,
            ),
            Layout("prompt and completion", Fields((("user", ("prompt",)), ("assistant", ("completion",)))), (name, "prompt", "completion"), (), name),
            Layout("prompt and response", Fields((("user", ("prompt",)), ("assistant", ("response",)))), (name, "prompt", "response"), (), name),
            Layout(
                "question and answer", Fields((("user", ("context", "question")), ("assistant", ("answer",)))),
                (name, "question", "answer"), ("context",), name,
            ),
        )
    ),
)


def shape_of(paths: list[str]) -> str:
    """The shape with these nested field paths, fields in the order of their names."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in path.replace("[]", ".[]").split("."):
            node = node.setdefault(step, {})

    def written_out(node: dict) -> str:
        if not node:
            return "?"
        if "[]" in node:
            return f"ARRAY<{written_out(node['[]'])}>"
        return f"OBJECT<{', '.join(f'{k}: {written_out(v)}' for k, v in sorted(node.items()))}>"

    return written_out(tree)


def fingerprint(shape: str) -> str:
    return hashlib.sha256(shape.encode()).hexdigest()


_SCALAR = r"\b(?:VOID|VARIANT|BOOLEAN|BIGINT|STRING|DOUBLE|FLOAT|BINARY|UUID|DATE|TIMESTAMP_NTZ|TIMESTAMP|DECIMAL\(\d+,\d+\))(?=[,>]|$)"


def _shape(value: Column) -> Column:
    """Shape of a variant: its type with all scalar types alike."""
    return F.regexp_replace(F.schema_of_variant(value), _SCALAR, "?")


def _selected(shape: Column, layouts: tuple[Layout, ...]) -> Column:
    """Number of the layout that the fingerprint selects, or null."""
    known: dict[str, int] = {}
    for number, layout in enumerate(layouts):
        for s in layout.shapes():
            known.setdefault(fingerprint(s), number)
    pairs = [x for k, v in known.items() for x in (F.lit(k), F.lit(v))]
    return F.element_at(F.create_map(*pairs), F.sha2(shape, 256))


_TURN = "struct<place:bigint,role:string,text:string>"


def _turn(place: Column, role: Column, text: Column, roles: dict[str, str]) -> Column:
    if roles:
        names = F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])
        role = F.coalesce(F.element_at(names, F.lower(role)), role)
    return F.struct(
        place.cast("bigint").alias("place"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")
    )


def _turns(layout: Layout, get) -> Column:
    """Array of turns that the layout's declaration reads; ``get(path, type)`` is a value."""
    turns = layout.turns
    if isinstance(turns, Single):
        return F.array(_turn(get(turns.place, "bigint"), get(turns.role, "string"), get(turns.text, "string"), layout.roles))
    if isinstance(turns, Fields):
        # A field the record does not have gives no turn; of several, those with a text are joined.
        made = []
        for role, paths in turns.turns:
            own = [get(p, "string") for p in paths]
            texts = F.concat_ws("\n\n", *[F.when(v != "", v) for v in own])
            there = F.coalesce(*own).isNotNull()
            made.append((F.lit(role), F.when(there, texts)))
        kept = F.filter(F.array(*[F.struct(r.alias("role"), t.alias("text")) for r, t in made]), lambda x: x["text"].isNotNull())
        return F.transform(kept, lambda x, i: _turn(i, x["role"], x["text"], {}))
    text = f"array<struct<{turns.part}:string>>" if turns.part else "string"
    items = get(turns.path, f"array<struct<`{turns.role}`:string,`{turns.text}`:{text}>>")

    def of(x: Column) -> Column:
        if turns.part:
            return F.concat_ws("", F.transform(x[turns.text], lambda p: p[turns.part]))
        return x[turns.text]

    return F.coalesce(
        F.transform(items, lambda x, i: _turn(i, x[turns.role], of(x), layout.roles)), F.array().cast(f"array<{_TURN}>")
    )


def _chosen(layouts: dict[int, Layout], get) -> tuple[Column, Column, Column]:
    """(layout's name, conversation, turns) by the column ``layout``."""
    nothing = F.array().cast(f"array<{_TURN}>")

    def by_layout(value, default: Column) -> Column:
        found = None
        for number, layout in layouts.items():
            when = F.when if found is None else found.when
            found = when(F.col("layout") == number, value(layout))
        return default if found is None else found.otherwise(default)

    name = by_layout(lambda x: F.lit(x.name), F.lit(None).cast("string"))
    conv = by_layout(lambda x: get(x.conv, "bigint"), F.lit(None).cast("bigint"))
    turns = by_layout(lambda x: _turns(x, get).cast(f"array<{_TURN}>"), nothing)
    return name.alias("layout"), conv.alias("conv"), turns.alias("turns")


def canonical_json(records: DataFrame, json_col: str = "json", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(shape, layout, conv, turns) of each JSON record."""
    value = records.select(F.try_parse_json(json_col).alias("value")).withColumn("shape", _shape(F.col("value")))

    def get(path: str, kind: str) -> Column:
        return F.try_variant_get("value", f"$.{path}", kind)

    picked = value.withColumn("layout", _selected(F.col("shape"), layouts))
    return picked.select("shape", *_chosen(dict(enumerate(layouts)), get))


def _paths(kind: T.DataType, prefix: str = "") -> set[str]:
    if isinstance(kind, T.StructType):
        dot = f"{prefix}." if prefix else ""
        return {prefix}.union(*[_paths(f.dataType, dot + f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return {prefix} | _paths(kind.elementType, prefix + "[]")
    return {prefix}


def canonical_rows(
    records: DataFrame, columns: tuple[str, ...], layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """(shape, layout, conv, turns) of each row of a typed frame, its record being ``columns``."""
    rows = records.select(F.struct(*columns).alias("record"))
    there = _paths(rows.schema["record"].dataType)
    # Only layouts whose fields the frame has can be the layout of one of its rows.
    fit = {n: x for n, x in enumerate(layouts) if set(x.paths) <= there}

    def get(path: str, kind: str) -> Column:
        if path not in there:
            return F.lit(None).cast(kind)
        value = F.col(f"record.{path}")
        if not kind.startswith("array<struct<"):
            return value.cast(kind)
        names = re.findall(r"`(\w+)`", kind)
        return F.transform(value, lambda x: F.struct(*[x[n].alias(n) for n in names])).cast(kind)

    # A shape needs no more than the first sign of a text, so long texts are not copied.
    short = [F.left(c, F.lit(1)).alias(c) if dict(records.dtypes)[c] == "string" else F.col(c) for c in columns]
    shapes = records.select(_shape(F.to_variant_object(F.struct(*short))).alias("shape"), F.struct(*columns).alias("record"))
    picked = shapes.withColumn("layout", _selected(F.col("shape"), layouts))
    return picked.select("shape", *_chosen(fit, get))


def profiled(canonical: DataFrame) -> DataFrame:
    """(shape, fingerprint, layout, records): what was read by which layout, and what by none."""
    return canonical.groupBy("shape", "layout").agg(F.count("*").alias("records")).withColumn(
        "fingerprint", F.sha2("shape", 256)
    )


def turns_of(canonical: DataFrame) -> DataFrame:
    """(conv, place, role, text), one row a turn."""
    turns = canonical.select("conv", F.explode("turns").alias("turn"))
    return turns.select("conv", "turn.place", "turn.role", "turn.text")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def restored(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role: Column) -> Column:
    return escaped(F.regexp_replace(F.regexp_replace(role, "%", "%25"), "\n", "%0A"))


def restored_role(role: str) -> str:
    return restored(role).replace("%0A", "\n").replace("%25", "%")


_FORMATTED = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text."""
    found, at = [], 0
    while at < len(formatted):
        turn = _FORMATTED.match(formatted, at)
        if not turn:
            raise ValueError("not a formatted conversation")
        found.append((restored_role(turn[1]), restored(turn[2])))
        at = turn.end()
    return found


def formatted(turns: DataFrame, learnt: tuple[str, ...] = LEARNT) -> DataFrame:
    """(conv, at, formatted, loss_start, loss_end) in the order of the output.

    The span counts code points from 0 in the formatted turn, end exclusive; it is null for
    turns that are not learnt. ``at`` grows along the output.
    """
    role, text = escaped_role(F.col("role")), escaped(F.col("text"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    made = turns.select(
        "*", head.alias("head"), text.alias("body"), F.col("role").isin(*learnt).alias("learn")
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("place"), F.asc("role"), F.asc("text")]
    # Texts tell repeated places apart, so equal ids do not gather in one range.
    placed = made.repartitionByRange(*order).sortWithinPartitions(*order)
    start = F.length("head")
    return placed.select(
        "conv", F.monotonically_increasing_id().alias("at"),
        F.concat("head", "body", F.lit(CLOSE + "\n")).alias("formatted"),
        F.when(F.col("learn"), start).alias("loss_start"),
        F.when(F.col("learn"), start + F.length("body")).alias("loss_end"),
    )


def write_formatted(turns: DataFrame, learnt: tuple[str, ...] = LEARNT) -> str:
    """Writes the formatted conversations; returns their folder."""
    uri = scratch_uri(turns.sparkSession, "chats")
    formatted(turns, learnt).write.parquet(uri)
    return uri


_READ = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(spark: SparkSession, uri: str) -> DataFrame:
    """What the output holds of each conversation: turns, learnt text, sizes and digests."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, False, []
        turns = chars = learnt = 0
        whole = loss = None

        def batch_of() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*out)) or [()] * len(kinds)
            names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                conv, text, start, stop = row
                if not held or conv != now:
                    if held:
                        out.append((now, turns, whole.hexdigest(), learnt, loss.hexdigest(), chars))
                    now, held, turns, chars, learnt = conv, True, 0, 0, 0
                    whole, loss = hashlib.sha256(), hashlib.sha256()
                for role, body in parsed(text):
                    whole.update(f"{role}\n{body}\n".encode())
                    turns += 1
                chars += len(text)
                if start is not None:
                    body = restored(text[start:stop])
                    loss.update(body.encode())
                    learnt += len(body)
            if len(out) >= 1000:
                yield batch_of()
                out.clear()
        if held:
            out.append((now, turns, whole.hexdigest(), learnt, loss.hexdigest(), chars))
        yield batch_of()

    rows = spark.read.parquet(uri)
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "at")
    return ordered.select("conv", "formatted", "loss_start", "loss_end").mapInArrow(digest, _READ)
