"""Chat formatting by schema fingerprints.

Records of chat data come in many layouts. The names and nesting of a record's fields, without types or values, are
its shape; the hash of the shape selects a declarative mapping that turns the record into turns of a role and a text.
Turns are written with one template, in which control strings inside texts are escaped reversibly, together with the
spans of all texts and whether they count for the loss. Everything is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearbrook.llm.common import running_sums

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Control strings that never appear in a formatted text unless the template wrote them, and what texts have instead.
#: A backslash comes first, so that every one in a formatted text begins such a pair.
ESCAPES = (
    ("\\", "\\e"), (OPEN, "\\l|im_start|>"), (CLOSE, "\\l|im_end|>"), ("<s>", "\\ls>"), ("</s>", "\\l/s>"),
    ("<|endoftext|>", "\\l|endoftext|>"), ("<<SYS>>", "\\l<SYS>>"), ("<</SYS>>", "\\l</SYS>>"),
    ("[INST]", "\\bINST]"), ("[/INST]", "\\b/INST]"),
)
LOSS_ROLE = "assistant"
TURNS = "array<struct<role:string,text:string>>"

#: Roles by the names that layouts use.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant", "prompter": "user"}


def escape(text: Column) -> Column:
    for control, written in ESCAPES:
        text = F.replace(text, F.lit(control), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    """The inverse: the pairs are disjoint, and the backslash itself comes last."""
    for pair, plain in (("\\l", "<"), ("\\b", "["), ("\\n", "\n"), ("\\e", "\\")):
        text = F.replace(text, F.lit(pair), F.lit(plain))
    return text


# --- layouts ------------------------------------------------------------------


def shape_of(kind: T.DataType) -> str:
    """Nested field names of a type, sorted; every scalar is an underscore."""
    if isinstance(kind, T.StructType):
        return "{" + ",".join(f"{f.name}:{shape_of(f.dataType)}" for f in sorted(kind.fields, key=lambda f: f.name)) + "}"
    return f"[{shape_of(kind.elementType)}]" if isinstance(kind, T.ArrayType) else "_"


def shape_in(record: Column) -> Column:
    """The same of a VARIANT value, whose field names are sorted already; both closing signs are written >."""
    names = F.schema_of_variant(record)
    for found, written in ((r"OBJECT<", "{"), (r"ARRAY<", "["), (r"\b(?:STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|BINARY|DATE|TIMESTAMP(?:_NTZ)?|DECIMAL\([0-9]+,[0-9]+\))(?=[,>]|$)", "_"), (r": ", ":"), (r", ", ",")):
        names = F.regexp_replace(names, found, written)
    return names


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.cast("string").alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _known(role: Column) -> Column:
    folded = F.coalesce(F.lower(role), F.lit(""))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair]), folded), folded)


def _single(user: tuple[str, ...], answer: str, system: str | None = None):
    """A record that is one exchange. Several user fields are joined by an empty line, empty ones left out."""

    def make(get) -> Column:
        parts = [F.nullif(get(f, "string"), F.lit("")) for f in user]
        turns = [_turn(F.lit("user"), F.concat_ws("\n\n", *parts)), _turn(F.lit("assistant"), get(answer, "string"))]
        whole = F.array(*turns)
        if system:
            said = F.nullif(get(system, "string"), F.lit(""))
            whole = F.when(said.isNull(), whole).otherwise(F.concat(F.array(_turn(F.lit("system"), said)), whole))
        return whole.cast(TURNS)

    return make


def _list(field: str, role: str, text: str):
    """A record with a list of messages."""

    def make(get) -> Column:
        messages = get(field, f"array<struct<{role}:string,{text}:string>>")
        return F.transform(messages, lambda m: _turn(_known(m[role]), m[text])).cast(TURNS)

    return make


def _row(role: str, text: str):
    """A record that is one turn of a longer conversation."""
    return lambda get: F.array(_turn(F.coalesce(get(role, "string"), F.lit("")), get(text, "string"))).cast(TURNS)


#: Shapes and what makes turns of them.
LAYOUTS = (
    ("turn row", "{role:_,text:_}", _row("role", "text")),
    ("message row", "{content:_,role:_}", _row("role", "content")),
    ("prompt and completion", "{completion:_,prompt:_}", _single(("prompt",), "completion")),
    ("prompt and response", "{prompt:_,response:_}", _single(("prompt",), "response")),
    ("question and answer", "{answer:_,question:_}", _single(("question",), "answer")),
    ("system, prompt and response", "{prompt:_,response:_,system:_}", _single(("prompt",), "response", "system")),
    ("instruction and output", "{instruction:_,output:_}", _single(("instruction",), "output")),
    ("instruction, input and output", "{input:_,instruction:_,output:_}", _single(("instruction", "input"), "output")),
    ("instruction, context and response", "{context:_,instruction:_,response:_}", _single(("instruction", "context"), "response")),
    ("messages", "{messages:[{content:_,role:_}]}", _list("messages", "role", "content")),
    ("conversations", "{conversations:[{from:_,value:_}]}", _list("conversations", "from", "value")),
    ("dialog", "{dialog:[{speaker:_,text:_}]}", _list("dialog", "speaker", "text")),
)


def turns_in(record: Column) -> tuple[Column, Column]:
    """Of a VARIANT record: the name of its layout and its turns; null where the shape is not known."""
    fingerprint = F.xxhash64(shape_in(record))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for name, shape, make in LAYOUTS:
        hit = fingerprint == F.xxhash64(F.lit(shape.replace("}", ">").replace("]", ">")))
        made = make(lambda field, kind: F.try_variant_get(record, f"$.{field}", kind))
        layout, turns = F.when(hit, name).otherwise(layout), F.when(hit, made).otherwise(turns)
    return layout, turns


def turns_of_json(records: DataFrame, *keys: str, json: str = "record") -> DataFrame:
    """The key columns, ``layout`` and ``turns`` of records in JSON; both are null for text of an unknown layout."""
    parsed = records.select(*keys, F.try_parse_json(json).alias("__record"))
    layout, turns = turns_in(F.col("__record"))
    return parsed.select(*keys, layout.alias("layout"), turns.alias("turns"))


def turns_of_table(rows: DataFrame, *keys: str, fields: tuple[str, ...]) -> DataFrame:
    """The key columns and ``turns`` of a table whose ``fields`` have the shape of a layout.

    All rows of a table share one shape, so its hash is compared once, while the plan is made.
    """
    shape = shape_of(T.StructType([rows.schema[f] for f in fields]))
    found = [make for _, known, make in LAYOUTS if hash(known) == hash(shape) and known == shape]
    if not found:
        raise ValueError(f"no layout has the shape {shape}")
    return rows.select(*keys, found[0](lambda field, kind: rows[field].cast(kind)).alias("turns"))


# --- template -----------------------------------------------------------------


def format_chats(turns: DataFrame, conversation: str, order: str) -> DataFrame:
    """One row per conversation: ``formatted``, and ``spans`` (start, stop, loss) of its texts, one for each turn.

    ``turns`` has a record's turns per row; rows come in the order of ``order`` (null first), rows of one place by role
    and text, and repeated rows stay. A null role is written as the empty string. Places are code points, the end
    exclusive. A conversation is one training text, so it is put together in one task; rows without an id are one
    conversation with a null id, as the SQL counterpart groups them. The rows of a conversation are one array and its
    text one string, so each is bounded by what one value holds (2 GB) and by a task's memory; beyond that the query
    ends with an error. An empty table gives no rows.
    """
    flat = turns.select(conversation, F.col(order).alias("__order"), F.posexplode("turns").alias("__at", "__turn")).select(
        conversation, "__order", F.col("__turn.role").alias("__role"), F.col("__turn.text").alias("__text"), "__at"
    )
    gathered = flat.groupBy(conversation).agg(F.sort_array(F.collect_list(F.struct("__order", "__at", "__role", "__text"))).alias("__all"))
    written = gathered.select(conversation, F.transform("__all", lambda t: F.struct(
        F.concat(F.lit(OPEN), F.replace(escape(F.coalesce(t["__role"], F.lit(""))), F.lit("\n"), F.lit("\\n")), F.lit("\n")).alias("head"),
        escape(t["__text"]).alias("text"),
        (F.coalesce(t["__role"], F.lit("")) == LOSS_ROLE).alias("loss"),
    )).alias("__parts"))
    ending = CLOSE + "\n"
    lengths = F.transform("__parts", lambda p: (F.length(p["head"]) + F.length(p["text"]) + len(ending)).cast("long"))
    placed = written.select(conversation, "__parts", running_sums(lengths).alias("__starts"))
    return placed.select(
        conversation,
        F.array_join(F.transform("__parts", lambda p: F.concat(p["head"], p["text"], F.lit(ending))), "").alias("formatted"),
        F.zip_with("__parts", "__starts", lambda p, s: F.struct(
            (s + F.length(p["head"])).alias("start"), (s + F.length(p["head"]) + F.length(p["text"])).alias("stop"), p["loss"].alias("loss")
        )).alias("spans"),
    )


def read_back(formatted: DataFrame, conversation: str) -> DataFrame:
    """What the formatted texts say: their turns, and the text under the loss mask.

    A span under the mask counts only where it begins and ends exactly where a text of the output does; the places are
    those of the output's own pieces, so a shifted span loses its text.
    """
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, "\n", 1), F.lit(len(OPEN) + 1), F.length(p))).alias("role"),
        F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p)).alias("text"),
    ))
    whole = F.slice(pieces, 1, F.size(pieces) - 1)
    ends = F.transform(whole, lambda p: (F.length(p) + len(CLOSE) + 1).cast("long"))
    parsed = formatted.select(conversation, "formatted", "spans", turns.alias("turns"), whole.alias("pieces"), running_sums(ends).alias("begins"))
    texts = F.zip_with("turns", F.zip_with("pieces", "begins", lambda p, b: b + F.length(p)), lambda t, stop: F.struct(
        t["text"].alias("text"), (stop - F.length(t["text"])).alias("start"), stop.alias("stop")
    ))
    masked = F.filter(
        F.zip_with(texts, "spans", lambda t, s: F.when(s["loss"] & (s["start"] == t["start"]) & (s["stop"] == t["stop"]), unescape(t["text"]))),
        lambda x: x.isNotNull(),
    )
    parsed = parsed.select(conversation, "formatted", "turns", F.array_join(masked, "").alias("loss"))
    return parsed.select(
        conversation,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), unescape(t["text"]), F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
