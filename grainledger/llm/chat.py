"""Chat formatting in Spark expressions: sort the turns, merge neighbours of one role, join; and reading it back."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """A turn is written as open, role, body, its texts with joint between them, close.

    Texts of neighbouring turns of one role share a turn. All these strings, and those in `foreign` (marks of other
    templates), are escaped inside roles and texts.
    """

    open: str = "<|turn|>"
    body: str = "<|text|>"
    joint: str = "<|next|>"
    close: str = "<|end|>"
    foreign: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")
    learned: str = "assistant"

    def __post_init__(self) -> None:
        marks = self.marks
        for a in marks:
            if len(a) < 2 or _ESCAPE in a:
                raise ValueError(f"a control string has two characters at least and no {_ESCAPE!r}: {a!r}")
            for b in marks:
                if any(a.endswith(b[:n]) for n in range(1, len(b))) or (a != b and a in b):
                    raise ValueError(f"control strings must not overlap: {a!r}, {b!r}")

    @property
    def marks(self) -> tuple[str, ...]:
        return (self.open, self.body, self.joint, self.close, *self.foreign)


def escape(text: Column, template: Template) -> Column:
    """Double every escape sign, and put one into every control string, after its first character."""
    out = F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE * 2))
    for mark in template.marks:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + _ESCAPE + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _running(values: Column) -> Column:
    """What stands before each value of an array of longs, summed; in blocks, so long arrays stay cheap."""

    def plain(some: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("out"))
        add = lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")
        )
        return F.aggregate(some, start, add, lambda acc: acc["out"])

    size = 256
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / size).cast("int")), lambda i: F.slice(values, i * size + 1, size))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda acc, x: acc + x))
    return F.flatten(F.zip_with(blocks, plain(totals), lambda b, at: F.transform(plain(b), lambda x: x + at)))


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, formatted, loss_spans, n_merged for every conversation.

    Turns are ordered by turn (null first), role and text; neighbours of one role become one turn. loss_spans are
    (start, length) in UTF-8 bytes of formatted: the texts of the learned role, each once, without any mark.

    A null role or text is an empty one. Repeated rows are turns of their own. Rows without conv_id are one
    conversation. A conversation is one row of the result, so it must fit into one. Extra columns are not looked at;
    an empty table gives no rows.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    t = F.col("turns")
    # where runs of one role begin, counted from 1, and one place behind the end
    begins = F.filter(
        F.sequence(F.lit(1), F.size(t)),
        lambda i: (i == 1) | (F.get(t, i - 1)["role"] != F.get(t, i - 2)["role"]),
    )
    chats = chats.select("conv_id", "turns", begins.alias("begins"))
    begin = F.col("begins")
    merged = F.transform(
        begin,
        lambda at, k: F.struct(
            F.get(t, at - 1)["role"].alias("role"),
            F.transform(
                F.slice(t, at, F.coalesce(F.get(begin, k + 1), F.size(t) + 1) - at), lambda x: escape(x["text"], template)
            ).alias("texts"),
        ),
    )
    chats = chats.select("conv_id", merged.alias("merged"))
    # pieces: a mark, then a text
    pieces = F.flatten(
        F.transform(
            F.col("merged"),
            lambda m, k: F.transform(
                m["texts"],
                lambda x, i: F.struct(
                    F.when(i > 0, F.lit(template.joint)).otherwise(
                        F.concat(F.when(k > 0, F.lit(template.close)).otherwise(F.lit("")), F.lit(template.open),
                                 escape(m["role"], template), F.lit(template.body))
                    ).alias("mark"),
                    x.alias("text"),
                    (m["role"] == template.learned).alias("learned"),
                ),
            ),
        )
    )
    chats = chats.select("conv_id", F.size("merged").alias("n_merged"), pieces.alias("pieces"))
    lengths = F.transform("pieces", lambda p: (F.octet_length(p["mark"]) + F.octet_length(p["text"])).cast("long"))
    chats = chats.select("conv_id", "n_merged", "pieces", _running(lengths).alias("at"))
    spans = F.transform(
        F.filter(F.arrays_zip("pieces", "at"), lambda z: z["pieces"]["learned"]),
        lambda z: F.struct(
            (z["at"] + F.octet_length(z["pieces"]["mark"])).alias("start"),
            F.octet_length(z["pieces"]["text"]).cast("long").alias("length"),
        ),
    )
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["text"])), "")
    return chats.select(
        "conv_id", F.concat(text, F.lit(template.close)).alias("formatted"), spans.alias("loss_spans"), "n_merged"
    )


def _split(text: Column, mark: str) -> Column:
    return F.split(text, "\\Q" + mark + "\\E", -1)


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The (role, text) turns that a formatted conversation was made from."""
    blocks = F.transform(
        F.filter(_split(formatted, template.close), lambda b: b != ""),
        lambda b: _split(F.substr(b, F.lit(len(template.open) + 1)), template.body),
    )
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                _split(F.get(b, F.lit(1)), template.joint),
                lambda x: F.struct(unescape(F.get(b, F.lit(0))).alias("role"), unescape(x).alias("text")),
            ),
        )
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    data = F.encode(formatted, "UTF-8")
    piece = lambda s: F.decode(F.substring(data, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")
    return F.array_join(F.transform(spans, lambda s: unescape(piece(s))), "")


def chat_digests(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """What formatted conversations hold, read back from them."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = chats.select(
        "conv_id", "formatted", read_turns(F.col("formatted"), template).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def digests_sql(turns: str, template: Template = Template()) -> str:
    """The same in SQL over a relation of turns."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def escaped(x: str) -> str:
        out = f"replace({x}, {quote(_ESCAPE)}, {quote(_ESCAPE * 2)})"
        for mark in template.marks:
            out = f"replace({out}, {quote(mark)}, {quote(mark[0] + _ESCAPE + mark[1:])})"
        return out

    head = len(template.open) + len(template.body) + len(template.close)
    return f"""
WITH rows_of AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {turns}
), placed AS (
  SELECT *, lag(role) OVER w AS before, row_number() OVER w AS place FROM rows_of
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS turns,
    coalesce(string_agg(CASE WHEN role = {quote(template.learned)} THEN text END, '' ORDER BY place), '') AS loss,
    sum(length({escaped('text')}) + CASE WHEN before = role THEN {len(template.joint)}
        ELSE {head} + length({escaped('role')}) END) AS formatted_chars
  FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM whole
"""
