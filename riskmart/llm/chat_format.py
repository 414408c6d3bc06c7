r"""Chat formatting with a grammar round trip.

Grammar (deterministic, one token of look-ahead)::

    conversation = { turn } ;
    turn         = "### " role ": " text "</turn>\n" ;
    role         = "System" | "User" | "Assistant" | "@" { role character | "\" any } ;
    text         = { character | "\" ( "\" | "### " | "</turn>" ) } ;

A text is first rendered as it is and the turn is parsed again. While what comes back is not the turn that
went in, the text is escaped further: first its control strings, then its backslashes too, which always
comes back. Most texts thus stay unchanged. The rendered conversation as a whole is parsed once more and
must give all turns back; anything else is an error, never a silent loss.

Turns of a conversation are brought together by its id, sorted, and rendered as a stream; a task holds
one conversation at a time (its formatted text is one value of the result).

Defined cases: null text and null role are empty; roles other than system, user and assistant are
rendered after ``@`` and come back exactly; a null turn sorts first; ties go by role and text and are all
kept; a null conversation id is one conversation; other columns are not returned; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.common import tidy

OPEN, END = "### ", "</turn>"
LOSS_ROLE = "assistant"
_NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {v: k for k, v in _NAMES.items()}
_HEADER = re.compile(r"### (?:(System|User|Assistant)|@((?:[^\\:]|\\.)*)): ", re.S)
_MARK = re.compile(r"\\(\\|### |</turn>)|### |</turn>")
_CONTROL = re.compile(r"### |</turn>")
_ESCAPED = re.compile(r"\\(\\|### |</turn>)")
_ANY = re.compile(r"\\|### |</turn>")

#: A conversation that contains the template's own control strings.
CONFLICT_ID = -7
CONFLICT_TEXT = r"\### Assistant: </turn> ok"


class GrammarError(ValueError):
    pass


def _escape(text: str, level: int) -> str:
    if level == 0:
        return text
    return (_CONTROL if level == 1 else _ANY).sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _render(role: str, text: str, level: int) -> tuple[str, str, str]:
    name = _NAMES.get(role)
    if name is None:
        name = "@" + re.sub(r"[\\:]", lambda m: "\\" + m[0], role)
    return f"{OPEN}{name}: ", _escape(text, level), f"{END}\n"


def parse(formatted: str, start: int = 0) -> list[tuple[str, str]]:
    """Formatted text -> turns (role, text)."""
    turns, at = [], start
    while at < len(formatted):
        header = _HEADER.match(formatted, at)
        if not header:
            raise GrammarError(f"no turn at {at}")
        role = _ROLES[header[1]] if header[1] else re.sub(r"\\(.)", r"\1", header[2], flags=re.S)
        parts, from_ = [], header.end()
        for mark in _MARK.finditer(formatted, header.end()):
            parts.append(formatted[from_:mark.start()])
            from_ = mark.end()
            if mark[1] is not None:
                parts.append(mark[1])
            elif mark[0] == END:
                break
            else:
                raise GrammarError(f"a turn begins inside a turn at {mark.start()}")
        else:
            raise GrammarError(f"the turn at {at} does not end")
        if formatted[from_:from_ + 1] != "\n":
            raise GrammarError(f"no line end at {from_}")
        turns.append((role, "".join(parts)))
        at = from_ + 1
    return turns


def render_turn(role: str | None, text: str | None) -> tuple[str, str, str, int]:
    """Header, body, end and the level of escaping that brings the turn back."""
    role, text = role or "", text or ""
    for level in range(3):
        pieces = _render(role, text, level)
        try:
            if parse("".join(pieces)) == [(role, text)]:
                return *pieces, level
        except GrammarError:
            continue
    raise GrammarError("the turn cannot be rendered")


def format_conversation(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]], int]:
    """Formatted text, the spans under the loss mask and the number of escaped turns; checked by parsing."""
    pieces, spans, at, escaped = [], [], 0, 0
    for role, text in turns:
        header, body, end, level = render_turn(role, text)
        if role == LOSS_ROLE:
            spans.append((at + len(header), at + len(header) + len(body)))
        pieces += [header, body, end]
        at += len(header) + len(body) + len(end)
        escaped += level > 0
    formatted = "".join(pieces)
    if parse(formatted) != [(r or "", t or "") for r, t in turns]:
        raise GrammarError("the conversation does not come back")
    return formatted, spans, escaped


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _formatter(id_type: pa.DataType):
    schema = pa.schema([("conv_id", id_type), ("formatted", pa.string()), ("loss_spans", _SPANS), ("n_escaped", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        current, turns, begun = None, [], False

        def close():
            nonlocal held
            formatted, spans, escaped = format_conversation(turns)
            out.append((current, formatted, [{"start": a, "end": b} for a, b in spans], escaped))
            held += len(formatted)

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for rows in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in rows.columns)):
                if begun and conv != current:
                    close()
                    turns = []
                    if held > 4_000_000:
                        yield batch()
                        out, held = [], 0
                current, begun = conv, True
                turns.append((role, text))
        if begun:
            close()
        if out:
            yield batch()

    return run


def format_chats(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start, end in code points), n_escaped."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = conversations.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("conv_id", id_type), T.StructField("formatted", T.StringType()),
        T.StructField("loss_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("n_escaped", T.LongType()),
    ])
    turns = (
        conversations.select(F.col(id_col).alias("c"), F.col(turn_col).alias("t"), F.col(role_col).alias("r"), F.col(text_col).alias("x"))
        .repartition("c").sortWithinPartitions("c", "t", "r", "x").select("c", "r", "x")
    )
    return turns.mapInArrow(tidy(_formatter(to_arrow_type(id_type))), schema)


def _reader(id_type: pa.DataType):
    schema = pa.schema([
        ("conv_id", id_type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, formatted, spans in zip(*(c.to_pylist() for c in batch.columns)):
                turns = parse(formatted)
                every, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, text in turns:
                    every.update(f"{role}\n{text}\n".encode())
                for span in spans:
                    text = unescape(formatted[span["start"]:span["end"]])
                    loss.update(text.encode())
                    chars += len(text)
                rows.append((conv, len(turns), every.hexdigest(), chars, loss.hexdigest(), len(formatted)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations again: turns, and the text under the loss mask, as digests."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = formatted.schema["conv_id"].dataType
    schema = T.StructType([
        T.StructField("conv_id", id_type), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    ])
    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(tidy(_reader(to_arrow_type(id_type))), schema)


def with_conflict(conversations: DataFrame) -> DataFrame:
    """The table's conversations and one that is made of the template's control strings."""
    types = dict(conversations.dtypes)
    extra = conversations.sparkSession.range(2).select(
        F.lit(CONFLICT_ID).cast(types["conv_id"]).alias("conv_id"), F.col("id").cast(types["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONFLICT_TEXT).alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def op7_format_chats(spark, sf_dir: str) -> DataFrame:
    return read_back(format_chats(with_conflict(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP7_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
levels AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '\\(\\|### |</turn>)|### |</turn>|\\$') THEN text
                 WHEN NOT regexp_matches(text, '\\(\\|### |</turn>)|\\$') THEN regexp_replace(text, '(### |</turn>)', '\\\1', 'g')
                 ELSE regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g') END AS body
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(body) + 4 + length(CASE WHEN role IN ('system', 'user', 'assistant') THEN role
           ELSE '@' || regexp_replace(role, '([\\:])', '\\\1', 'g') END) + 2 + 8)::BIGINT AS formatted_chars
FROM levels GROUP BY conv_id
"""
