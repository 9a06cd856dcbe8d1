"""Chat formatting: records of any known layout become canonical turns, then one marked text.

A record's layout is the hash of its nested field paths. Mappings are declared by the paths that they
read; a record takes the mapping with its fingerprint, so no record is guessed at. Unknown layouts
keep null turns and can be counted by fingerprint.

The template writes each turn as ``<turn>role<turn/>text</turn>`` and a line end. Inside roles and
texts, ``<turn`` and ``</turn`` get a backslash behind the ``<`` (one more if there are some already),
so no content can form a mark, and reading back removes exactly one.

Nulls: a null role or text is empty, turns with a null number come first, a null conversation id is a
conversation of its own, a null record has null turns. Ties in the turn number are ordered by role and
text. An empty table gives no conversations; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"

OPEN, SPLIT, CLOSE = "<turn>", "<turn/>", "</turn>\n"


@dataclass(frozen=True)
class Mapping:
    """A layout: ``fields`` are (role, path) pairs in order; or ``items`` names an array whose
    elements have the role at ``role`` and the text at ``text``. ``ignored`` are paths that may exist."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = "role"
    text: str = "content"
    roles: dict[str, str] = field(default_factory=dict)
    ignored: tuple[str, ...] = ()

    def paths(self) -> tuple[str, ...]:
        read = [f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"] if self.items else []
        return tuple(read) + tuple(path for _, path in self.fields)

    def fingerprints(self) -> list[Column]:
        """Of the layout with every subset of the ignored paths."""
        chosen: list[tuple[str, ...]] = [()]
        for path in self.ignored:
            chosen += [(*some, path) for some in chosen]
        return [_hash_paths(F.array(*map(F.lit, (*self.paths(), *some)))) for some in chosen]


#: The layouts known so far.
MAPPINGS = (
    Mapping("messages", items="messages", ignored=("id",)),
    Mapping("turns", items="turns", text="text", ignored=("id",)),
    Mapping(
        "exchange", items="conversations", role="from", text="value", ignored=("id",),
        roles={"human": "user", "gpt": "assistant"},
    ),
    Mapping("prompt", fields=(("user", "prompt"), ("assistant", "completion")), ignored=("id",)),
    Mapping("prompt_response", fields=(("user", "prompt"), ("assistant", "response")), ignored=("id", "system")),
    Mapping("system_prompt", fields=(("system", "system_prompt"), ("user", "question"), ("assistant", "response"))),
    Mapping("instruction", fields=(("user", "instruction"), ("assistant", "output")), ignored=("id",)),
    Mapping(
        "instruction_input", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output")),
        ignored=("id",),
    ),
)


def _hash_paths(paths: Column) -> Column:
    return F.sha2(F.concat_ws("\n", F.array_sort(F.array_distinct(paths))), 256)


def field_paths(record: Column) -> Column:
    """The leaf paths of a JSON text, two levels of arrays or objects deep; deeper ones count as leaves.

    ``a.b`` is a field of an object, ``a[].b`` one of the objects in an array.
    """
    top = F.json_object_keys(record)

    def below(key: Column) -> Column:
        path = F.concat(F.lit("$['"), key, F.lit("']"))
        value = F.call_function("get_json_object", record, path)
        items = F.from_json(value, "array<string>")
        keys = F.when(value.startswith("["), F.flatten(F.transform(items, F.json_object_keys))).otherwise(
            F.json_object_keys(value)
        )
        mark = F.when(value.startswith("["), F.lit("[].")).otherwise(F.lit("."))
        nested = F.transform(F.array_distinct(F.filter(keys, lambda k: k.isNotNull())), lambda k: F.concat(key, mark, k))
        return F.when(F.size(nested) > 0, nested).otherwise(F.array(key))

    return F.flatten(F.transform(top, below))


def fingerprint(record: Column) -> Column:
    """Hash of the record's field paths, whatever their order and values."""
    return _hash_paths(field_paths(record))


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _turns(mapping: Mapping, record: Column) -> Column:
    if mapping.items:
        element = f"struct<`{mapping.role}`:string,`{mapping.text}`:string>"
        whole = F.from_json(record, f"struct<`{mapping.items}`:array<{element}>>")
        names = F.create_map(*[F.lit(x) for pair in mapping.roles.items() for x in pair]) if mapping.roles else None

        def turn(item: Column) -> Column:
            role = _text(item.getField(mapping.role))
            if names is not None:
                role = F.coalesce(names[role], role)
            return F.struct(role.alias("role"), _text(item.getField(mapping.text)).alias("text"))

        return F.transform(F.coalesce(whole.getField(mapping.items), F.from_json(F.lit("[]"), f"array<{element}>")), turn)
    whole = F.from_json(record, "struct<" + ",".join(f"`{path}`:string" for _, path in mapping.fields) + ">")
    return F.array(*[
        F.struct(F.lit(role).alias("role"), _text(whole.getField(path)).alias("text")) for role, path in mapping.fields
    ])


def canonical_turns(
    records: DataFrame, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS
) -> DataFrame:
    """Adds ``layout`` (fingerprint), ``mapping`` (its name) and ``turns`` to rows with a JSON text."""
    known = records.withColumn("layout", fingerprint(F.col(record)))
    turns, name = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for mapping in mappings:
        fits = F.lit(False)
        for print_ in mapping.fingerprints():
            fits = fits | (F.col("layout") == print_)
        turns = F.when(fits, _turns(mapping, F.col(record)).cast(TURNS)).otherwise(turns)
        name = F.when(fits, F.lit(mapping.name)).otherwise(name)
    return known.withColumns({"mapping": name, "turns": turns})


def records_of_turns(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows by turn as one JSON record per conversation (columns ``conversation``, ``record``)."""
    item = F.struct(
        F.col(turn).alias("number"), _text(F.col(role)).alias("role"), _text(F.col(text)).alias("content")
    )
    grouped = rows.groupBy(F.col(conversation).alias("conversation")).agg(
        F.sort_array(F.collect_list(item)).alias("items")
    )
    messages = F.transform("items", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return grouped.select("conversation", F.to_json(F.struct(messages.alias("messages"))).alias("record"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", r"<$1$2")


def format_turns(turns: Column, trained: str = "assistant") -> Column:
    """A struct of the marked text ``formatted`` and the loss mask ``loss``: (start, length) in code
    points of every text of the trained role, in order."""
    pieces = F.transform(
        turns,
        lambda x: F.struct(
            F.concat(F.lit(OPEN), escape(x["role"]), F.lit(SPLIT)).alias("head"),
            escape(x["text"]).alias("body"),
            (x["role"] == trained).alias("trained"),
        ),
    )
    empty = F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")

    def step(state: Column, piece: Column) -> Column:
        body_at = state["at"] + F.length(piece["head"])
        span = F.struct(body_at.cast("long").alias("start"), F.length(piece["body"]).cast("long").alias("length"))
        spans = F.when(piece["trained"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        after = body_at + F.length(piece["body"]) + F.lit(len(CLOSE))
        return F.struct(after.cast("long").alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
    return F.struct(
        F.array_join(F.transform(pieces, lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate(pieces, start, step, lambda state: state["spans"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns that a marked text was made of."""
    parts = F.split(formatted, CLOSE, -1)
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role_text = F.split(F.substr(part, F.lit(len(OPEN) + 1)), SPLIT, -1)
        return F.struct(unescape(role_text[0]).alias("role"), unescape(role_text[1]).alias("text"))

    return F.transform(whole, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    cut = lambda span: F.substr(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int"))
    return F.transform(loss, lambda span: unescape(cut(span)))


def format_records(records: DataFrame, record: str = "record", trained: str = "assistant") -> DataFrame:
    """Rows with ``layout``, ``mapping``, ``turns``, ``formatted`` and ``loss``."""
    turned = canonical_turns(records, record)
    done = turned.withColumn("_chat", format_turns(F.col("turns"), trained))
    return done.withColumns({"formatted": F.col("_chat.formatted"), "loss": F.col("_chat.loss")}).drop("_chat")
