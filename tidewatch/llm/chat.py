"""Chat formatting: nested schemas are fingerprinted, and the fingerprint selects the mapping into canonical turns.

Everything is DataFrame expressions. A fingerprint is the SHA-256 of the sorted field paths (arrays as `[]`) of all columns that a layout may use,
nested fields that no mapping asks for included; other columns don't matter. The registry has the fingerprint of each set of these columns and the mapping that
it selects. Where a table holds rows of several layouts, as files read together do, each row is fingerprinted by its columns that are not
null. Canonical form: conv_id and `turns`, an array of (role, text).

The template writes a turn as `### role:` and a line end, the text, and `</turn>` and a line end. Inside roles and texts `\\`, `<`, `#` and, in
roles, `:` are written as `\\b`, `\\l`, `\\h` and `\\c`, so no control string can occur in them and each can be read back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, AFTER_ROLE, CLOSE = "### ", ":\n", "</turn>\n"


def paths(schema: T.DataType, at: str = "") -> list[str]:
    """The paths of all leaves of a schema."""
    if isinstance(schema, T.StructType):
        return sorted(p for f in schema.fields for p in paths(f.dataType, f"{at}.{f.name}" if at else f.name))
    if isinstance(schema, T.ArrayType):
        return paths(schema.elementType, f"{at}[]")
    return [at]


def fingerprint(found: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """A layout: the field paths that it needs and may have, and its turns as an expression of the columns there (an array of role and text), or rows by turn."""

    name: str
    needs: tuple[str, ...]
    turns: Callable[[frozenset[str]], Column] | None = None
    may: tuple[str, ...] = ()

    def columns(self) -> set[str]:
        return {p.split("[")[0] for p in self.needs + self.may}


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _listed(column: str, role: str, text: str) -> Column:
    names = F.create_map(*[F.lit(x) for pair in (("human", "user"), ("gpt", "assistant"), ("bot", "assistant")) for x in pair])
    turns = F.transform(F.col(column), lambda x: _turn(F.coalesce(F.try_element_at(names, x[role]), x[role]), x[text]))
    return F.coalesce(turns, F.array().cast("array<struct<role:string,text:string>>"))


def _instructed(have: frozenset[str]) -> Column:
    more = F.when(F.col("input") != "", F.col("input")) if "input" in have else F.lit(None)
    return F.array(_turn(F.lit("user"), F.concat_ws("\n", F.col("instruction"), more)), _turn(F.lit("assistant"), F.col("output")))


#: Mappings by preference: of those whose paths a schema or row has, the first is taken.
MAPPINGS = (
    Mapping("messages", ("messages[].content", "messages[].role"), lambda _: _listed("messages", "role", "content")),
    Mapping("from-value", ("conversations[].from", "conversations[].value"), lambda _: _listed("conversations", "from", "value")),
    Mapping("instruction", ("instruction", "output"), _instructed, ("input",)),
    Mapping("prompt-response", ("prompt", "response"), lambda _: F.array(_turn(F.lit("user"), F.col("prompt")), _turn(F.lit("assistant"), F.col("response")))),
    Mapping("rows by turn", ("role", "text", "turn")),
)


def known_columns(schema: T.StructType) -> dict[str, list[str]]:
    """The columns that a mapping may use, each with all of its field paths."""
    own = {f.name: paths(T.StructType([f])) for f in schema.fields}
    every = {p for found in own.values() for p in found}
    fit = [m for m in MAPPINGS if every.issuperset(m.needs)]
    return {c: own[c] for c in sorted(own) if any(c in m.columns() for m in fit)}


def registry(columns: dict[str, list[str]]) -> dict[str, Mapping]:
    """Fingerprint of each set of the columns, and the mapping that it selects.

    That is the first whose needs the set has; failing that the first that uses any of the set, with what is absent empty.
    """
    found = {}
    for n in range(1, len(columns) + 1):
        for some in combinations(columns, n):
            have = [p for c in some for p in columns[c]]
            whole = [m for m in MAPPINGS if set(have).issuperset(m.needs)]
            part = [m for m in MAPPINGS if m.columns().intersection(some)]
            found[fingerprint(have)] = (whole or part)[0]
    return found


def layout(schema: T.StructType) -> Mapping:
    """The mapping that the fingerprint of the schema's known columns selects."""
    columns = known_columns(schema)
    if not columns:
        raise ValueError(f"no mapping for the fields {paths(schema)}")
    return registry(columns)[fingerprint([p for c in columns.values() for p in c])]


def _whole(schema: T.StructType) -> list[Mapping]:
    """The layouts that the schema holds whole."""
    have = frozenset(known_columns(schema))
    return [m for m in MAPPINGS if have.issuperset(m.columns() - {p.split("[")[0] for p in m.may})]


def _row_layout(schema: T.StructType, whole: list[Mapping]) -> Column:
    """The name of the layout that each row's fingerprint selects; null where it selects none."""
    columns = {c: p for c, p in known_columns(schema).items() if any(c in m.columns() for m in whole)}
    names = {p: m.name for p, m in registry(columns).items()}
    present = F.flatten(F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.array(*map(F.lit, p))) for c, p in columns.items()])))
    own = F.sha2(F.array_join(F.array_sort(present), "\n").cast("binary"), 256)
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), own)


def canonical(df: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """conv_id and turns of every conversation of a known layout.

    Null texts and roles are empty. Rows by turn are ordered by turn (null first), then role, then text; rows that repeat are
    turns of their own. A conversation is one row by nature: its turns are gathered by its id; in a table of several layouts, rows by turn are gathered so
    and the others stay rows of their own, also where they share an id. There, a row whose fields no layout knows has null turns, unlike an
    empty conversation; in a table of one layout it has what that makes of nulls. Other columns are left out, whatever their names.
    """
    m = layout(df.schema)
    whole = _whole(df.schema)
    if len(whole) == 1 or m.turns is None:
        listed, by_turn = (df, None) if m.turns else (None, df)
        turns = m.turns and m.turns(frozenset(known_columns(df.schema)))
    else:
        name, have = _row_layout(df.schema, whole), frozenset(known_columns(df.schema))
        gathers = any(x.turns is None for x in whole)
        by_turn = df.where(name == "rows by turn") if gathers else None
        listed = df.where(F.coalesce(name != "rows by turn", F.lit(True))) if gathers else df
        turns = F.coalesce(*[F.when(name == x.name, x.turns(have)) for x in whole if x.turns])
    out = []
    if listed is not None:
        out.append(listed.select(F.col(conv_id).cast("long").alias("conv_id"), turns.alias("turns")))
    if by_turn is not None:
        rows = by_turn.select(F.col(conv_id).cast("long").alias("conv_id"), "turn", _turn(F.col("role"), F.col("text")).alias("x"))
        gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "x.role", "x.text"))).alias("t"))
        out.append(gathered.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns")))
    return out[0] if len(out) == 1 else out[0].union(out[1])


def _replace(c: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape(text: Column) -> Column:
    return _replace(text, (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")))


def unescape(text: Column) -> Column:
    return _replace(text, (("\\l", "<"), ("\\h", "#"), ("\\c", ":"), ("\\b", "\\")))


def format_chat(turns: DataFrame, learn: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss: the written conversation and the spans (start, length in code points) that a loss covers.

    A span is the whole escaped text of one turn of the role `learn`. A conversation without turns is an empty text, null turns are a null text.
    """
    escaped = F.transform("turns", lambda t: F.struct(F.replace(escape(t["role"]), F.lit(":"), F.lit("\\c")).alias("r"), escape(t["text"]).alias("x"), (t["role"] == learn).alias("l")))
    marks = len(OPEN) + len(AFTER_ROLE)
    written = turns.select("conv_id", escaped.alias("e")).select(
        "conv_id",
        F.array_join(F.transform("e", lambda t: F.concat(F.lit(OPEN), t["r"], F.lit(AFTER_ROLE), t["x"], F.lit(CLOSE))), "").alias("formatted"),
        F.transform("e", lambda t: F.struct((F.char_length(t["r"]) + marks).alias("h"), F.char_length(t["x"]).alias("n"), t["l"].alias("l"))).alias("s"),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    spans = F.aggregate(
        "s",
        empty,
        lambda a, t: F.struct(
            (a["at"] + t["h"] + t["n"] + len(CLOSE)).alias("at"),
            F.when(t["l"], F.concat(a["spans"], F.array(F.struct((a["at"] + t["h"]).alias("start"), t["n"].alias("length"))))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return written.select("conv_id", "formatted", spans.alias("loss"))


def read_chat(formatted: Column) -> Column:
    """The turns (role, text) of a written conversation."""
    parts = F.filter(F.split(formatted, CLOSE), lambda p: p != "")

    def turn(p: Column) -> Column:
        role = F.substring_index(p, AFTER_ROLE, 1)
        text = F.substr(p, F.char_length(role) + (len(AFTER_ROLE) + 1))
        return F.struct(unescape(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts that the loss mask covers, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"])))


def digest(chats: DataFrame) -> DataFrame:
    """What can be read back from the written conversations, as digests.

    Rows that repeat an id are conversations of their own; a null text has null digests and no turns; an empty table gives an empty one.
    """
    read = chats.select("conv_id", read_chat(F.col("formatted")).alias("t"), F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("x"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    lines = F.array_join(F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.coalesce(F.size("t"), F.lit(0)).cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("x").cast("long").alias("loss_chars"),
        F.sha2(F.col("x").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


# the added conversation's turns both say this text
TRICKY = "\\### Assistant: </turn> ok"

ORACLE_SQL = """
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(14 + length(role) + length(text)
           + length(role) - length(replace(replace(replace(replace(role, '\\', ''), '<', ''), '#', ''), ':', ''))
           + length(text) - length(replace(replace(replace(text, '\\', ''), '<', ''), '#', '')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
