"""Chat formatting: layouts recognised by a hash of their field paths, mapped to canonical turns.

Everything here is Spark SQL functions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- layouts -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """A record layout: its field paths, and where the turns are.

    ``fields`` lists (role, field) in order for flat layouts. ``turns`` names (array, role field,
    text field) for message lists, and ``roles`` renames the layout's roles.
    """

    name: str
    paths: tuple[str, ...]
    fields: tuple[tuple[str, str], ...] = ()
    turns: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256("\n".join(sorted(self.paths)).encode()).hexdigest()[:16]


def _flat(name: str, *fields: tuple[str, str]) -> Layout:
    return Layout(name, tuple(f for _, f in fields), fields)


LAYOUTS = (
    _flat("prompt_response", ("user", "prompt"), ("assistant", "response")),
    _flat("prompt_completion", ("user", "prompt"), ("assistant", "completion")),
    _flat("question_answer", ("user", "question"), ("assistant", "answer")),
    _flat("system_question_answer", ("system", "system"), ("user", "question"), ("assistant", "answer")),
    _flat("instruction", ("user", "instruction"), ("assistant", "output")),
    _flat("instruction_input", ("system", "instruction"), ("user", "input"), ("assistant", "output")),
    Layout("messages", ("messages[].content", "messages[].role"), turns=("messages", "role", "content")),
    Layout(
        "conversations", ("conversations[].from", "conversations[].value"), turns=("conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
)


#: Texts of any length a row can hold; the parser stops at 20 million characters otherwise.
_WHOLE = {"maxStringLen": str((1 << 31) - 1)}


def skeleton(record: Column) -> Column:
    """The JSON text with empty strings for its values, which its field paths do not depend on."""
    # no quote or backslash is left inside a string, so every second part between quotes is one
    plain = F.replace(F.replace(record, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    kept = lambda z: F.when((z["i"] % 2 == 0) | F.ltrim(z["after"]).startswith(":"), z["part"]).otherwise("")

    def parts(p: Column) -> Column:
        after = F.concat(F.slice(p, 2, F.size(p)), F.array(F.lit("")))
        numbers = F.sequence(F.lit(0), F.size(p) - 1)
        zipped = F.arrays_zip(p.alias("part"), after.alias("after"), numbers.alias("i"))
        return F.array_join(F.transform(zipped, kept), '"')

    return F.transform(F.array(F.split(plain, '"', -1)), parts)[0]


def field_paths(record: Column) -> Column:
    """Sorted distinct paths of a JSON object: ``a``, ``a.b`` in objects, ``a[]`` and ``a[].b`` in lists.

    A string is a leaf whatever it looks like. Null for anything but an object.
    """
    record = skeleton(record)
    kind = F.schema_of_variant(F.try_parse_json(record))
    fields = F.map_entries(F.when(kind.startswith("OBJECT"), F.from_json(record, "map<string,variant>")))
    keys = lambda text: F.json_object_keys(text)

    def below(field: Column) -> Column:
        key, text, own = field["key"], field["value"].cast("string"), F.schema_of_variant(field["value"])
        items = F.from_json(F.when(own.startswith("ARRAY<OBJECT"), text), "array<string>")
        inner = F.array_distinct(F.flatten(F.transform(F.filter(items, lambda x: x.isNotNull()), keys)))
        return F.coalesce(
            F.transform(inner, lambda x: F.concat(key, F.lit("[]."), x)),
            F.when(own.startswith("ARRAY"), F.array(F.concat(key, F.lit("[]")))),
            F.transform(keys(F.when(own.startswith("OBJECT<"), text)), lambda x: F.concat(key, F.lit("."), x)),
            F.array(key),
        )

    return F.array_sort(F.array_distinct(F.flatten(F.transform(fields, below))))


def schema_fingerprint(record: Column) -> Column:
    return F.substring(F.sha2(F.array_join(field_paths(record), "\n"), 256), 1, 16)


def _renamed(role: Column, layout: Layout) -> Column:
    out = role
    for theirs, ours in layout.roles:
        out = F.when(role == theirs, ours).otherwise(out)
    return out


def canonical_turns(df: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``df`` with ``layout`` and ``turns`` (array of role and text) of the JSON objects in ``record``.

    The fingerprint of the field paths selects the layout, so a text that looks like JSON never
    changes how its record is read below the layout's own fields; nor does its length. Records of unknown layout, broken
    JSON and null give a null layout and null turns. Null roles and texts become empty strings.
    """
    kinds = {}
    for layout in layouts:
        if layout.turns:
            array, role, text = layout.turns
            kinds[array] = f"`{array}` array<struct<`{role}`:string,`{text}`:string>>"
        else:
            kinds |= {f: f"`{f}` string" for _, f in layout.fields}
    values = F.from_json(F.col(record), ", ".join([*kinds.values(), "`_corrupt_record` string"]), _WHOLE)
    df = df.withColumn("__llm_values", values).withColumn("__llm_fingerprint", schema_fingerprint(F.col(record)))

    def turn(role: Column, text: Column) -> Column:
        return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))

    def listed(layout: Layout) -> Column:
        array, role, text = layout.turns
        return F.transform(f"__llm_values.{array}", lambda x: turn(_renamed(x[role], layout), x[text]))

    name, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        if layout.turns:
            found = listed(layout)
        else:
            found = F.array(*[turn(F.lit(r), F.col(f"__llm_values.{f}")) for r, f in layout.fields])
        hit = (F.col("__llm_fingerprint") == layout.fingerprint) & F.col("__llm_values._corrupt_record").isNull()
        name, turns = F.when(hit, layout.name).otherwise(name), F.when(hit, found).otherwise(turns)
    return df.withColumns({"layout": name, "turns": turns}).drop("__llm_values", "__llm_fingerprint")


def records(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn gathered into one JSON record ``(key, record)`` per conversation.

    Pairs of user and assistant become prompt and response; system, user and assistant become
    instruction, input and output; conversations that open with a system turn and know no other
    roles become a list of from and value; all others become messages. Turns are in order of
    ``turn``, nulls first, ties by role and text; repeated rows are repeated turns.
    """
    at = F.array_sort(F.collect_list(F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ), ))
    rows = conversations.groupBy(F.col(key).alias(key)).agg(at.alias("_t"))
    roles = F.col("_t.role")
    is_of = lambda *names: roles == F.array(*map(F.lit, names))
    text_at = lambda i: F.col("_t")[i]["text"]
    back = F.create_map(*[F.lit(x) for x in ("user", "human", "assistant", "gpt", "system", "system")])
    known = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    record = (
        F.when(is_of("user", "assistant"), F.to_json(F.struct(text_at(0).alias("prompt"), text_at(1).alias("response"))))
        .when(
            is_of("system", "user", "assistant"),
            F.to_json(F.struct(text_at(0).alias("instruction"), text_at(1).alias("input"), text_at(2).alias("output"))),
        )
        .when(
            known & (roles[0] == "system"),
            F.to_json(F.struct(F.transform("_t", lambda x: F.struct(back[x["role"]].alias("from"), x["text"].alias("value"))).alias("conversations"))),
        )
        .otherwise(F.to_json(F.struct(F.transform("_t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))))
    )
    return rows.select(key, record.alias("record"))


# ---- template ------------------------------------------------------------------------------

#: Marks of the template and what stands for them inside texts; the backslash comes first.
HEAD, BREAK, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"), (": ", "\\c"))
LABELS = (("user", "User"), ("assistant", "Assistant"), ("system", "System"), ("tool", "Tool"))


def escape(c: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES[:3]) -> Column:
    for raw, mark in pairs:
        c = F.replace(c, F.lit(raw), F.lit(mark))
    return c


def unescape(c: Column, pairs: tuple[tuple[str, str], ...] = ESCAPES[:3]) -> Column:
    for raw, mark in reversed(pairs):
        c = F.replace(c, F.lit(mark), F.lit(raw))
    return c


def _label(role: Column) -> Column:
    out = F.concat(F.lit("="), escape(role, ESCAPES))
    for name, label in LABELS:
        out = F.when(role == name, label).otherwise(out)
    return out


def _role(label: Column) -> Column:
    out = unescape(F.substring(label, 2, 1 << 30), ESCAPES)
    for name, shown in LABELS:
        out = F.when(label == shown, name).otherwise(out)
    return out


def format_turns(df: DataFrame, turns: str = "turns", loss_role: str = "assistant") -> DataFrame:
    """``df`` with ``formatted`` and ``loss_spans``.

    A turn is ``### Role: text</turn>`` and a line end; in texts (and role names) the marks are
    escaped, which :func:`parse_formatted` undoes. ``loss_spans`` are code point ranges of
    ``formatted`` with the texts of ``loss_role``, one per turn, with the number of the turn and
    where it starts. Null turns give nulls, no turns an empty text.
    """
    pieces = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(HEAD), _label(t["role"]), F.lit(BREAK)).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss"),
    ))
    df = df.withColumn("__llm_pieces", pieces)
    df = df.withColumn("formatted", F.array_join(F.transform("__llm_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), ""))
    lengths = F.transform("__llm_pieces", lambda p: F.char_length(p["head"]) + F.char_length(p["body"]) + len(END))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(
        lengths, zero,
        lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts")),
        lambda a: a["starts"],
    )
    spans = F.transform(F.arrays_zip("__llm_pieces", starts.alias("s")), lambda z, i: F.when(z["__llm_pieces"]["loss"], F.struct(
        i.alias("turn"), z["s"].alias("turn_start"), (z["s"] + F.char_length(z["__llm_pieces"]["head"])).alias("start"),
        (z["s"] + F.char_length(z["__llm_pieces"]["head"]) + F.char_length(z["__llm_pieces"]["body"])).alias("end"),
    )))
    return df.withColumn("loss_spans", F.array_compact(spans)).drop("__llm_pieces")


def parse_formatted(df: DataFrame, formatted: str = "formatted") -> DataFrame:
    """``df`` with ``pieces`` (the turns as formatted, without their end) and ``read_turns``."""
    cut = F.split(formatted, END, -1)
    pieces = F.slice(cut, 1, F.greatest(F.size(cut) - 1, F.lit(0)))

    def read(p: Column) -> Column:
        body = F.substring(p, len(HEAD) + 1, 1 << 30)
        at = F.instr(body, BREAK)
        return F.struct(
            _role(body.substr(F.lit(1), at - 1)).alias("role"),
            unescape(body.substr(at + len(BREAK), F.lit(1 << 30))).alias("text"),
        )

    return df.withColumn("pieces", pieces).withColumn("read_turns", F.transform("pieces", read))


def loss_text(pieces: str = "pieces", spans: str = "loss_spans") -> Column:
    """Unescaped text under the loss mask, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.get(F.col(pieces), s["turn"]).substr(s["start"] - s["turn_start"] + 1, s["end"] - s["start"])
    )), "")
