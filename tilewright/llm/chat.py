"""Chat formatting by schema fingerprints, as native SQL.

A record is a JSON object in one of several layouts. The paths of its fields, nested ones
included, are hashed; the hash selects a declarative mapping, which says where the turns
are. Canonical turns are then written with a template, each as::

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Control strings inside a role or text are escaped: ``<\\`` becomes ``<\\\\`` and then
``<|`` becomes ``<\\|``, so that ``<|`` never stands in a text, and reading backwards
gives the text again. A line feed in a role becomes ``<\\n``.

Defined cases: a null text or role is empty; turns of one conversation are ordered by
turn, then role, then text, repeated rows stay repeated; a record whose fingerprint is
unknown gives no turns (``unknown`` lists such records); a conversation without turns
isn't in the output; extra fields of a layout give another fingerprint, which the caller
may map. A conversation is one output value, so its turns meet in one row: nothing else
is ever gathered. Texts may be as long as a string can be: records of more than LONG
characters, whose strings the VARIANT parser may refuse, are told by parsing them as each
layout in turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"

TURN = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: the tree of field paths that identifies it, and where its turns are.

    turns: (path of an array, field of the role, field of the text); or pairs: fixed turns
    as (role, paths of parts, joined by an empty line); or row: one turn a record, as
    (path of the turn's number, of the role, of the text). conv: path of the id.
    """

    name: str
    shape: str
    conv: str | None = None
    turns: tuple[str, str, str] | None = None
    pairs: tuple[tuple[str, tuple[str, ...]], ...] = ()
    row: tuple[str, str, str] | None = None


LAYOUTS = (
    Mapping("turn_row", "OBJECT<conv_id, role, text, turn>", conv="$.conv_id", row=("$.turn", "$.role", "$.text")),
    Mapping("messages", "OBJECT<id, messages: ARRAY<OBJECT<content, role>>>", conv="$.id", turns=("$.messages", "role", "content")),
    Mapping("from_value", "OBJECT<conversations: ARRAY<OBJECT<from, value>>, id>", conv="$.id", turns=("$.conversations", "from", "value")),
    Mapping("instruction", "OBJECT<id, input, instruction, output>", conv="$.id", pairs=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Mapping("prompt", "OBJECT<id, prompt, response>", conv="$.id", pairs=(("user", ("$.prompt",)), ("assistant", ("$.response",)))),
)

#: Roles of other layouts, by their canonical names.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant"}


def fingerprint_of(shape: str) -> str:
    import hashlib

    return hashlib.sha256(shape.encode()).hexdigest()


def shape(record: Column) -> Column:
    """The nested field paths of a JSON text as one tree, names sorted, types of plain values left out."""
    typed = F.schema_of_variant(F.try_parse_json(record))
    return F.regexp_replace(typed, r": (STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|DECIMAL\(\d+,\d+\))(?=[,>])", "")


#: Records of more characters may hold strings of more than 20 million, which parsers refuse unless told otherwise.
LONG = 10_000_000
_ANY = {"maxStringLen": str(2**31 - 1)}


def _fields(tree: str) -> dict[str, str]:
    """Names and what is behind them ("" for plain values) of the outermost object of a shape."""
    body, out, depth, start = tree[len("OBJECT<") : -1], {}, 0, 0
    for i, c in enumerate(body + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            name, _, inner = body[start:i].strip().partition(": ")
            out[name] = inner
            start = i + 1
    return out


def _fits(m: Mapping, record: Column) -> Column:
    """Whether a record parses as the layout, and as nothing else."""
    names = lambda keys: F.array(*[F.lit(k) for k in sorted(keys)])
    parsed = lambda kind: F.from_json(record, kind, _ANY)
    of = _fields(m.shape)
    ok = F.coalesce(F.array_sort(F.map_keys(parsed("map<string,string>"))) == names(of), F.lit(False))
    for name, inner in of.items():
        if inner.startswith("ARRAY<OBJECT<"):
            items = parsed(f"struct<`{name}`:array<map<string,string>>>")[name]
            ok = ok & F.coalesce(F.forall(items, lambda x: F.array_sort(F.map_keys(x)) == names(_fields(inner[len("ARRAY<") : -1]))), F.lit(False))  # noqa: B023
        else:
            ok = ok & parsed(f"struct<`{name}`:map<string,string>>")[name].isNull() & parsed(f"struct<`{name}`:array<string>>")[name].isNull()
    return ok


def fingerprint(record: Column, layouts: tuple[Mapping, ...] | None = None) -> Column:
    """The hash of a record's shape; null where it doesn't parse. Of long records, that of the layout they fit."""
    long = F.lit(None).cast("string")
    for m in reversed(LAYOUTS if layouts is None else layouts):
        long = F.when(_fits(m, record), F.lit(fingerprint_of(m.shape))).otherwise(long)
    return F.when(F.char_length(record) > LONG, long).otherwise(F.sha2(shape(record), 256))


def _text(record: Column, path: str) -> Column:
    name = path.removeprefix("$.")
    return F.from_json(record, f"struct<`{name}`:string>", _ANY)[name] if "." not in name and "[" not in name else F.get_json_object(record, path)


def _role(role: Column) -> Column:
    out = role
    for k, v in ROLES.items():
        out = F.when(role == k, F.lit(v)).otherwise(out)
    return F.coalesce(out, F.lit(""))


def _turns(m: Mapping, r: Column) -> Column:
    if m.row:
        # one parse for all fields
        names = [p.removeprefix("$.") for p in m.row]
        whole = F.from_json(r, "struct<" + ",".join(f"`{n}`:string" for n in names) + ">", _ANY)
        turn, role, text = (whole[n] for n in names)
        return F.array(F.struct(turn.cast("long").alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))).cast(TURN)
    if m.turns:
        path, role, text = m.turns
        name = path.removeprefix("$.")
        items = F.from_json(r, f"struct<`{name}`:array<struct<`{role}`:string,`{text}`:string>>>", _ANY)[name]
        return F.transform(items, lambda x, i: F.struct(i.cast("long").alias("turn"), _role(x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))).cast(TURN)
    fixed = []
    for i, (role, parts) in enumerate(m.pairs):
        joined = F.array_join(F.filter(F.array(*[_text(r, p) for p in parts]), lambda x: x.isNotNull() & (x != "")), "\n\n")
        fixed.append(F.struct(F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"), joined.alias("text")))
    return F.array(*fixed).cast(TURN)


def to_turns(records: DataFrame, record: str = "record", layouts: tuple[Mapping, ...] = LAYOUTS) -> DataFrame:
    """Rows (conv_id string, turn, role, text) of JSON records in any known layout."""
    known = records.select(F.col(record).alias("tw_r"), fingerprint(F.col(record), layouts).alias("tw_f"))
    turns, conv = F.lit(None).cast(TURN), F.lit(None).cast("string")
    r = F.col("tw_r")
    for m in layouts:
        hit = F.col("tw_f") == fingerprint_of(m.shape)
        turns = F.when(hit, _turns(m, r)).otherwise(turns)
        conv = F.when(hit, _text(r, m.conv)).otherwise(conv) if m.conv else conv
    return known.select(conv.alias("conv_id"), F.explode(turns).alias("t")).select("conv_id", "t.turn", "t.role", "t.text")


def unknown(records: DataFrame, record: str = "record", layouts: tuple[Mapping, ...] = LAYOUTS) -> DataFrame:
    """Records of no known layout, those that don't parse among them."""
    return records.where(~F.coalesce(fingerprint(F.col(record), layouts).isin([fingerprint_of(m.shape) for m in layouts]), F.lit(False)))


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\([\\|])", "<$1")


def unescape_role(role: Column) -> Column:
    """``<\\n`` is a line feed; one inside ``<\\\\n`` isn't, as what it follows is an escape of its own."""
    return unescape(F.regexp_replace(role, r"<\\n", "\n"))


def render(turns: DataFrame) -> DataFrame:
    """One row a conversation: formatted, and loss_spans, the (start, length) in code points of assistant texts in it."""
    t = turns.select("conv_id", F.struct("turn", "role", "text").alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    pieces = F.transform("ts", lambda x: F.struct(F.concat(F.lit(START), escape_role(x["role"]), F.lit("\n")).alias("head"), escape(x["text"]).alias("body"), (x["role"] == "assistant").alias("loss")))
    t = t.select("conv_id", pieces.alias("ps"))
    whole = F.array_join(F.transform("ps", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n"))), "")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,len:bigint>>").alias("spans"))

    def step(a: Column, p: Column) -> Column:
        start = a["at"] + F.char_length(p["head"])
        n = F.char_length(p["body"]).cast("long")
        span = F.array(F.struct(start.cast("long").alias("start"), n.alias("len")))
        return F.struct((start + n + len(END) + 1).cast("long").alias("at"), F.when(p["loss"], F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return t.select("conv_id", whole.alias("formatted"), F.aggregate("ps", zero, step)["spans"].alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped: array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda x: x != "")
    body = lambda x: F.substring(x, F.lit(len(START) + 1), F.char_length(x))
    return F.transform(
        parts,
        lambda x: F.struct(
            unescape_role(F.substring_index(body(x), "\n", 1)).alias("role"),
            unescape(F.substring(body(x), F.char_length(F.substring_index(body(x), "\n", 1)) + 2, F.char_length(x))).alias("text"),
        ),
    )


def masked(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["len"].cast("int")))), "")
