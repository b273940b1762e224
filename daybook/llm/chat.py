"""Chat formatting by schema fingerprint.

Tables of conversations come in many layouts. The nested field paths of a table
(or of a row of JSON) that mappings know are sorted and hashed; the hash selects
a declarative mapping, written as SQL expressions, that turns the layout into
canonical turns: an array of (role, text). A system text and a history of
earlier turns belong to the layouts that may have them. Fields that no mapping
knows don't count, whatever they are called, but are told (``unmapped_fields``,
and a column for rows of JSON), so that no text is left out silently.

The template writes each turn as

    ### role: text</turn>\\n

Inside roles and texts a backslash becomes two, ``#`` becomes ``\\#``, a colon of
a role ``\\:``, and ``</turn>`` becomes ``<\\/turn>``; dropping one backslash
before any character reads them back. So neither ``###`` nor ``</turn>`` occurs
but as a control string.

The loss mask is a run-length list with one pair for each turn: characters to
skip from the turn's start, then characters under the loss, the text of
assistant turns (0 for others).

DataFrame functions only.

Defined cases: null texts and roles are empty; turns that share a number are
ordered by role, then text, and a null number comes first; rows with a null
conversation id form one conversation; repeated rows are turns of their own; a
layout without a mapping is an error for a table and a null list of turns for a
row of JSON; a null list of turns formats as an empty text; an empty table gives
no conversations.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

END = "</turn>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """``paths``: the known field paths of the layout; ``turns``: SQL for its turns.

    ``order`` marks a layout with a row for each turn, sorted by this SQL within a
    conversation; ``turns`` is then the SQL of one turn.
    """

    name: str
    paths: tuple[str, ...]
    turns: str
    order: str | None = None


_ALIAS = "CASE lower({0}) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' WHEN 'model' THEN 'assistant' ELSE {0} END"
_PAIR = "array(named_struct('role', 'user', 'text', {0}), named_struct('role', 'assistant', 'text', {1}))"
_ASKED = "concat_ws('\\n\\n', instruction, nullif(input, ''))"
_NO_TURNS = "CAST(array() AS array<struct<role:string,text:string>>)"
#: A system text and earlier (question, answer) pairs come before the layout's own turns, if there are any.
_SYSTEM = f"IF(coalesce(system, '') = '', {_NO_TURNS}, array(named_struct('role', 'system', 'text', system)))"
_HISTORY = f"flatten(transform(coalesce(history, array()), h -> {_PAIR.format('get(h, 0)', 'get(h, 1)')}))"

#: Layouts of one question and one answer: name, fields, SQL of both.
_ASKING = [
    ("prompt", ("prompt", "response"), "prompt", "response"),
    ("completion", ("prompt", "completion"), "prompt", "completion"),
    ("question", ("question", "answer"), "question", "answer"),
    ("instruction", ("instruction", "output"), "instruction", "output"),
    ("instruction with input", ("instruction", "input", "output"), _ASKED, "output"),
]


def _asking() -> list[Mapping]:
    out = []
    for name, fields, asked, said in _ASKING:
        pair = _PAIR.format(asked, said)
        out.append(Mapping(name, fields, pair))
        out.append(Mapping(f"{name} with system", (*fields, "system"), f"concat({_SYSTEM}, {pair})"))
        out.append(Mapping(f"{name} with history", (*fields, "history[][]"), f"concat({_HISTORY}, {pair})"))
        out.append(Mapping(f"{name} with system and history", (*fields, "system", "history[][]"), f"concat({_SYSTEM}, {_HISTORY}, {pair})"))
    return out


def _listed(name: str, field: str, role: str, text: str) -> list[Mapping]:
    turns = f"transform({field}, m -> named_struct('role', {_ALIAS.format('m.' + role) if role == 'from' else 'm.' + role}, 'text', m.{text}))"
    paths = (f"{field}[].{role}", f"{field}[].{text}")
    return [Mapping(name, paths, turns), Mapping(f"{name} with system", (*paths, "system"), f"concat({_SYSTEM}, {turns})")]


MAPPINGS = [
    Mapping("turn rows", ("turn", "role", "text"), "named_struct('role', role, 'text', text)", order="turn"),
    *_listed("messages", "messages", "role", "content"),
    *_listed("conversations", "conversations", "from", "value"),
    *_asking(),
]

#: Types that the nested fields of JSON rows are read as; other fields are strings.
JSON_TYPES = {"history": "array<array<string>>"}
#: What a list of turns may be called in JSON, and the names of an element's role and text, whichever it has.
JSON_LISTS = ("messages", "conversations")
JSON_ROLES, JSON_TEXTS = ("role", "from"), ("content", "value", "text")

KNOWN = sorted({p for m in MAPPINGS for p in m.paths})


def fingerprint(paths: list[str] | tuple[str, ...]) -> str:
    """Hash of the known paths among ``paths``."""
    return hashlib.sha256("\n".join(sorted(set(paths) & set(KNOWN))).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(m.paths): m for m in MAPPINGS}


def field_paths(kind: DataType, at: str = "") -> list[str]:
    """Nested field paths of a type: ``a.b`` for structs, ``a[].b`` for arrays of them."""
    if isinstance(kind, ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    if isinstance(kind, StructType):
        return [p for f in kind for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    return [at]


def _clean(turn: Column) -> Column:
    return F.struct(F.coalesce(turn["role"], F.lit("")).alias("role"), F.coalesce(turn["text"], F.lit("")).alias("text"))


def canonical(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, turns) of a table in any layout that a mapping knows."""
    paths = field_paths(df.schema)
    mapping = BY_FINGERPRINT.get(fingerprint(paths))
    if mapping is None:
        raise ValueError(f"no mapping for the field paths {sorted(set(paths) & set(KNOWN))}")
    if mapping.order is None:
        return df.select(id_col, F.transform(F.expr(mapping.turns), _clean).cast(TURNS).alias("turns"))
    rows = df.select(id_col, F.expr(mapping.order).alias("at"), F.expr(mapping.turns).alias("t"))
    rows = rows.select(id_col, F.struct("at", F.coalesce("t.role", F.lit("")).alias("role"), F.coalesce("t.text", F.lit("")).alias("text")).alias("t"))
    sorted_rows = F.sort_array(F.collect_list("t"))
    return rows.groupBy(id_col).agg(F.transform(sorted_rows, lambda t: F.struct(t["role"], t["text"])).cast(TURNS).alias("turns"))


def _json_turns(items: Column) -> Column:
    """Turns of a list of variants: each element by the names it has itself; null if one has no text."""

    def one(m: Column) -> Column:
        first = lambda names: F.coalesce(*[F.try_variant_get(m, f"$.{n}", "string") for n in names])
        role = first(JSON_ROLES)
        alias = F.create_map(*[F.lit(x) for x in ("human", "user", "gpt", "assistant", "bot", "assistant", "model", "assistant")])
        return F.struct(F.coalesce(F.try_element_at(alias, F.lower(role)), role).alias("role"), first(JSON_TEXTS).alias("text"))

    def named(m: Column, names) -> Column:
        """The element has one of the names (its value may be null)."""
        return F.arrays_overlap(_keys(m), F.array(*[F.lit(n) for n in names]))

    good = F.forall(items, lambda m: F.coalesce(named(m, JSON_ROLES) & named(m, JSON_TEXTS), F.lit(False)))
    return F.when(good, F.transform(items, one).cast(TURNS))


def _keys(v: Column) -> Column:
    return F.coalesce(F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")), F.array().cast("array<string>"))


def canonical_json(df: DataFrame, id_col: str = "conv_id", json_col: str = "record") -> DataFrame:
    """(id_col, layout, turns, unmapped) of rows of JSON text, each in its own layout (null: none known).

    The elements of a list of turns may name their roles and texts differently;
    a list with an element that names no role or no text has no layout.
    ``unmapped`` are the row's fields, and its elements' (``messages[].name``),
    that aren't in the turns: all of them where there is no layout.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("__id"), F.expr(f"try_parse_json(`{json_col}`)").alias("v"))
    mappings = [m for m in MAPPINGS if m.order is None and not m.name.startswith(JSON_LISTS)]
    fields = sorted({p.split("[")[0] for m in mappings for p in m.paths})
    lists = [F.try_variant_get("v", f"$.{n}", "array<variant>").alias(f"__{n}") for n in JSON_LISTS]
    rows = rows.select("__id", "v", _keys(F.col("v")).alias("__names"), *lists, *[F.try_variant_get("v", f"$.{f}", JSON_TYPES.get(f, "string")).alias(f) for f in fields])
    has = lambda n: F.array_contains("__names", n)
    known = F.array(*[F.lit(n) for n in (*fields, *JSON_LISTS)])
    # the known fields a row has, as a mapping names them
    present = F.array_sort(F.array_intersect("__names", known))
    layout, turns, used = F.lit(None).cast("string"), F.lit(None).cast(TURNS), F.array().cast("array<string>")

    def take(mine: Column, name: str, what: Column, names: list[str]) -> None:
        nonlocal layout, turns, used
        mine = F.coalesce(mine & what.isNotNull(), F.lit(False))
        layout, turns = F.when(mine, F.lit(name)).otherwise(layout), F.when(mine, what).otherwise(turns)
        used = F.when(mine, F.array(*[F.lit(n) for n in names])).otherwise(used)

    for m in mappings:
        names = sorted({p.split("[")[0] for p in m.paths})
        # a field of another type than the mapping's isn't read, so the row has no layout
        whole = F.lit(True)
        for n in names:
            null = F.is_variant_null(F.try_variant_get("v", f"$.{n}", "variant"))
            whole = whole & (F.col(n).isNotNull() | F.coalesce(null, F.lit(False)))
        take((present == F.array(*[F.lit(n) for n in names])) & whole, m.name, F.expr(m.turns).cast(TURNS), names)
    for n in JSON_LISTS:
        own, system = _json_turns(F.col(f"__{n}")), F.expr(_SYSTEM).cast(TURNS)
        take(present == F.array(F.lit(n)), n, own, [n])
        text = F.col("system").isNotNull() | F.is_variant_null(F.try_variant_get("v", "$.system", "variant"))
        take((present == F.array(*[F.lit(x) for x in sorted((n, "system"))])) & text, f"{n} with system", F.concat(system, own), [n, "system"])
    rows = rows.select("*", layout.alias("__layout"), turns.alias("__turns"), used.alias("__used"))
    inner = []
    for n in JSON_LISTS:
        extra = F.array_except(F.array_distinct(F.flatten(F.transform(f"__{n}", _keys))), F.array(*[F.lit(x) for x in (*JSON_ROLES, *JSON_TEXTS)]))
        inner.append(F.when(F.array_contains("__used", n) & F.col(f"__{n}").isNotNull(), F.transform(extra, lambda x: F.concat(F.lit(f"{n}[]."), x))))
    none = F.array().cast("array<string>")
    unmapped = F.concat(F.array_except("__names", "__used"), *[F.coalesce(x, none) for x in inner])
    return rows.select(
        F.col("__id").alias(id_col), F.col("__layout").alias("layout"), F.transform("__turns", _clean).cast(TURNS).alias("turns"),
        F.array_sort(unmapped).alias("unmapped"),
    )


def unmapped_fields(df: DataFrame) -> list[str]:
    """The field paths of a table that its mapping leaves out of the turns."""
    paths = field_paths(df.schema)
    mapping = BY_FINGERPRINT.get(fingerprint(paths))
    return [p for p in paths if mapping is None or p not in mapping.paths]


# ------------------------------------------------------------------ template


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\#")), F.lit(END), F.lit("<\\/turn>"))
    return F.replace(out, F.lit(":"), F.lit("\\:")) if role else out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, formatted, mask) of (id_col, turns)."""
    written = F.transform(
        F.coalesce("turns", F.array().cast(TURNS)),
        lambda t: F.struct(
            F.concat(F.lit("### "), escape(t["role"], role=True), F.lit(": ")).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("loss"),
        ),
    )
    mask = F.transform(
        "written", lambda w: F.struct(F.length(w["head"]).alias("skip"), F.when(w["loss"], F.length(w["body"])).otherwise(0).alias("length"))
    )
    formatted = F.array_join(F.transform("written", lambda w: F.concat(w["head"], w["body"], F.lit(END + "\n"))), "")
    return df.select(id_col, written.alias("written")).select(id_col, formatted.alias("formatted"), mask.alias("mask"))


def read_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id_col, turns, loss_text, formatted_chars) read back from (id_col, formatted, mask)."""
    parts = F.split("formatted", END + "\n", -1)
    rows = df.select(id_col, F.slice(parts, 1, F.size(parts) - 1).alias("parts"), "mask", F.length("formatted").cast("long").alias("formatted_chars"))
    head = r"(?s)^### ((?:[^\\:]++|\\.)*+): "
    turn = lambda p: F.struct(
        unescape(F.regexp_extract(p, head, 1)).alias("role"), unescape(F.regexp_replace(p, head, "")).alias("text")
    )
    loss = F.zip_with("parts", "mask", lambda p, m: unescape(F.substring(p, m["skip"] + 1, m["length"])))
    return rows.select(id_col, F.transform("parts", turn).cast(TURNS).alias("turns"), F.array_join(loss, "").alias("loss_text"), "formatted_chars")


def digest(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Counts and digests of what ``read_turns`` reads back from formatted conversations."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_turns(formatted, id_col).select(
        id_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars",
    )
