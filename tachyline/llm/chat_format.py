"""Event-sourced chat formatting: logs of messages, deltas, edits and regenerations are folded and rendered.

A log has one row per event: conversation, sequence number, kind, message, role, text.

- ``message``: the message begins with this role and text, in place of what it was;
- ``delta``: the text is appended (streamed output); a first delta begins the message;
- ``edit``: the text replaces the message's;
- ``regenerate``: the message and all that come after it are dropped; with text, the message begins anew with it.

Logs are dealt out by conversation and sorted by sequence; a sorted partition is read event by event. A window from the
end says for each event how far back later events still reach, so messages before that are rendered and forgotten at once:
a conversation of any length streams through, and what is held are the messages that may still change. Rendered output
is one piece per message, in order.

The template marks turns with control strings; the same strings inside texts are escaped by a marker character
and read back by dropping it, so the text between control strings is always recovered exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import map_batches

#: Control strings of the template.
BEGIN = {"system": "<s>[SYS] ", "user": "<s>[INST] ", "assistant": "<s>[OUT] "}
OTHER = "<s>[ROLE "  # followed by the escaped role and "] "
END = {"system": " [/SYS]", "user": " [/INST]", "assistant": " </s>"}
OTHER_END = " [/ROLE]"
MARK = "\u2063"  # invisible separator; stands after the first character of an escaped control string
_CONTROL = re.compile(r"(<|\[)(" + MARK + r"*)(?=/?s>|/?(?:SYS|INST|OUT|ROLE)\b)")
_ESCAPED = re.compile(r"(<|\[)" + MARK + r"(" + MARK + r"*)(?=/?s>|/?(?:SYS|INST|OUT|ROLE)\b)")


def escape(text: str) -> str:
    """One more marker within each control string, so none is left; ones that held markers get one more."""
    return _CONTROL.sub(lambda m: m[1] + MARK + m[2], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] + m[2], text)


def render(role: str | None, text: str) -> tuple[str, int, int]:
    """(piece, start, end): the turn, and the escaped text's place in it."""
    role = role or ""
    head = BEGIN[role] if role in BEGIN else f"{OTHER}{_quote(role)}] "
    body = escape(text)
    return head + body + (END[role] if role in END else OTHER_END), len(head), len(head) + len(body)


def _quote(role: str) -> str:
    return escape(role.replace("&", "&amp;").replace("]", "&rsb;"))


def read_piece(piece: str) -> tuple[str, str, str]:
    """(role, text, escaped text) of a rendered turn."""
    for role, head in BEGIN.items():
        if piece.startswith(head) and piece.endswith(END[role]):
            body = piece[len(head) : len(piece) - len(END[role])]
            return role, unescape(body), body
    close = piece.index("] ", len(OTHER))
    role = unescape(piece[len(OTHER) : close]).replace("&rsb;", "]").replace("&amp;", "&")
    body = piece[close + 2 : len(piece) - len(OTHER_END)]
    return role, unescape(body), body


def _sorted_rows(parts: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


class _Batches:
    """Gathers rows into record batches of bounded bytes."""

    def __init__(self, types: list[tuple[str, pa.DataType]], limit: int = 4 << 20):
        self.types, self.limit, self.rows, self.size = types, limit, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size > self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*self.rows, strict=True), self.types, strict=True)], [n for n, _ in self.types])
        self.rows, self.size = [], 0


PIECES = [("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("piece", pa.string()), ("start", pa.int64()), ("end", pa.int64())]


def _fold(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events in order -> pieces. ``born`` is the place of a message's first event, ``reach`` the smallest one that
    later events have: messages born before it can't change any more."""
    out, conv, at, position = _Batches(PIECES), None, {}, 0

    def give(messages: list[tuple[str | None, list[str], int]]) -> Iterator[pa.RecordBatch]:
        nonlocal position
        for role, text, _ in messages:
            piece, a, b = render(role, "".join(text))
            yield from out.add((conv, position, role or "", piece, a, b), 4 * len(piece))
            position += 1

    for conv_id, kind, message, role, text, born, reach in _sorted_rows(parts, ("conv_id", "kind", "message", "role", "text", "born", "reach")):
        if conv_id != conv:
            yield from give(list(at.values()))
            conv, at, position = conv_id, {}, 0
        text = text or ""
        if kind == "delta" and message in at:
            at[message][1].append(text)
        elif kind == "edit" and message in at:
            at[message] = (at[message][0], [text], born)
        elif kind == "regenerate" and message in at:
            old, drop = at[message][0], False
            for k in list(at):
                drop = drop or k == message
                if drop:
                    del at[k]
            if text:
                at[message] = (role or old, [text], born)
        elif kind in ("message", "delta"):
            at[message] = (role, [text], born)
        settled = []
        for k, (*_, first) in at.items():
            if reach is not None and first >= reach:
                break
            settled.append(k)
        yield from give([at.pop(k) for k in settled])
    yield from give(list(at.values()))
    yield from out.flush()


def format_events(events: DataFrame) -> DataFrame:
    """``events`` (conv_id, seq, kind, message, role, text, ...) -> pieces: conv_id, position, role, piece, start, end.

    ``piece`` is the rendered turn and [start, end) the place of its escaped text in code points. Edits and
    regenerations of unknown messages, and unknown kinds, do nothing; null text is empty, null role is the role with no
    name; rows without conv_id are left out; a null sequence comes first; rows of equal sequence come in the order of
    kind, message, role and text. Other columns are ignored.
    """
    rows = events.where("conv_id is not null").select("conv_id", "seq", "kind", "message", "role", "text")
    order = ["seq", "kind", "message", "role", "text"]
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    rows = rows.withColumn("born", F.min("at").over(Window.partitionBy("conv_id", "message")))
    rows = rows.withColumn("reach", F.min("born").over(Window.partitionBy("conv_id").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)))
    return rows.sortWithinPartitions("conv_id", "at").select("conv_id", "kind", "message", "role", "text", "born", "reach").transform(map_batches, _fold, "conv_id long, position long, role string, piece string, start long, end long")


def event_log(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) -> a log that folds to them, as a chat service would have kept it.

    A turn of the assistant is streamed in part, then a question follows that is dropped with it when it's regenerated, and
    is streamed again to its end. Any other is first a draft, then edited. A conversation's rows come in the order of turn (null
    last), role and text; its events leave this in no order.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), "role", "text")).cast("long"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    begin, rest, none = F.substring("text", F.lit(1), half), F.expr("substring(text, int(floor(char_length(text) / 2)) + 1)"), F.lit(None).cast("string")

    def event(k: int, kind: str, role: Column, text: Column, other: int = 0) -> Column:
        return F.struct((F.col("at") * 8 + k).alias("seq"), F.lit(kind).alias("kind"), (F.col("at") * 2 + other).alias("message"), role.alias("role"), text.alias("text"))

    streamed = F.array(event(4, "delta", none, rest), event(3, "delta", F.col("role"), begin), event(1, "message", F.lit("user"), F.lit("Again, please."), 1), event(0, "delta", F.col("role"), begin), event(2, "regenerate", none, none))
    edited = F.array(event(1, "edit", none, F.col("text")), event(0, "message", F.col("role"), begin))
    return rows.select("conv_id", F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(edited)).alias("e")).select("conv_id", "e.*")


DIGEST = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]


def _read_back(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> per conversation what they say; only running digests are held."""
    out, conv, started = _Batches(DIGEST), None, False
    turns = loss = hashlib.sha256()
    n = loss_chars = chars = 0
    for conv_id, piece, role_of, start, end in _sorted_rows(parts, ("conv_id", "piece", "role", "start", "end")):
        if not started or conv_id != conv:
            if started:
                yield from out.add((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars), 200)
            conv, started, turns, loss, n, loss_chars, chars = conv_id, True, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        role, text, body = read_piece(piece)
        turns.update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            masked = unescape(piece[start:end])
            loss.update(masked.encode())
            loss_chars += len(masked)
        n += 1
        chars += len(piece)
    if started:
        yield from out.add((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars), 200)
    yield from out.flush()


def digests(pieces: DataFrame) -> DataFrame:
    """What the rendered pieces say, read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    return pieces.transform(map_batches, _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op5_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """Per conversation, and for -1, which consists of control strings: what its formatted text says."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(format_events(event_log(rows.unionByName(extra))))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '(<|\[)\x{2063}*(/?s>|/?(SYS|INST|OUT|ROLE)\b)'))
    + CASE role WHEN 'system' THEN length('<s>[SYS]  [/SYS]') WHEN 'user' THEN length('<s>[INST]  [/INST]') WHEN 'assistant' THEN length('<s>[OUT]  </s>') ELSE length('<s>[ROLE ]  [/ROLE]') + length(role) END AS chars FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
