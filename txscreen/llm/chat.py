"""Chat formatting with a grammar round trip.

Template of a turn: ``<s>`` role ``[INST]`` text ``[/INST]</s>``. The four marks and the escape
character ``\\`` are the control strings. A turn is first rendered as it is, reparsed by the
deterministic parser and compared with its source; where they differ the content is escaped (a
backslash before each control string) and rendered again, until the parse returns the source.

No mark contains ``<`` or ``[`` after its first character, so no mark can begin in one text and end
in the next mark; a conversation is therefore the concatenation of its turns in order and each turn
can be checked by itself, before any shuffle.

Defined cases: a null role or text is the empty string; a null conv_id is a conversation of its own;
turns are ordered by (turn, role, text), a null turn first, and repeated rows are repeated turns; an
empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

#: Marks of the template, in the order in which a turn has them.
BOS, INST, END_INST, EOS = "<s>", "[INST]", "[/INST]", "</s>"
ESCAPE = "\\"
_CONTROL = re.compile(r"<s>|</s>|\[INST\]|\[/INST\]|\\", re.DOTALL)
_TOKEN = re.compile(r"\\(<s>|</s>|\[INST\]|\[/INST\]|\\)|<s>|</s>|\[INST\]|\[/INST\]", re.DOTALL)
#: The roles whose text is under the loss mask.
LOSS_ROLES = ("assistant",)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: ESCAPE + m[0], text)


def render(role: str, text: str) -> str:
    return f"{BOS}{role}{INST}{text}{END_INST}{EOS}"


class GrammarError(ValueError):
    """The text isn't a sequence of turns."""


def parse(rendered: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin, end) of each turn; begin and end bound the text as it stands in `rendered`.

    One pass, one state: the mark that must come next. Any other mark is an error.
    """
    expected = (BOS, INST, END_INST, EOS)
    state, at, role, text, begin, end = 0, 0, "", "", 0, 0
    pieces: list[str] = []
    for m in _TOKEN.finditer(rendered):
        pieces.append(rendered[at : m.start()])
        at = m.end()
        if m[1] is not None:
            pieces.append(m[1])
            continue
        content, pieces = "".join(pieces), []
        if m[0] != expected[state] or (content and state in (0, 3)):
            raise GrammarError(f"{m[0]} at {m.start()}")
        if state == 1:
            role, begin = content, m.end()
        elif state == 2:
            text, end = content, m.start()
        elif state == 3:
            yield role, text, begin, end
        state = (state + 1) % 4
    if state or at != len(rendered):
        raise GrammarError(f"ends within a turn at {at}")


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and the bounds of its text, escaped as far as the round trip needs."""
    source = (role, text)
    for content in (source, (escape(role), escape(text))):
        rendered = render(*content)
        try:
            found = list(parse(rendered))
        except GrammarError:
            continue
        if len(found) == 1 and found[0][:2] == source:
            return rendered, found[0][2], found[0][3]
    raise AssertionError("an escaped turn always parses to its source")


def _format(batches: Iterator[pa.RecordBatch], loss_roles: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        roles = [x or "" for x in b.column("role").to_pylist()]
        texts = [x or "" for x in b.column("text").to_pylist()]
        done = [format_turn(r, t) for r, t in zip(roles, texts, strict=True)]
        loss = [r in loss_roles for r in roles]
        yield pa.RecordBatch.from_arrays(
            [
                b.column("conv_id"), b.column("turn"), b.column("role"), b.column("text"), pa.array([x[0] for x in done], pa.string()),
                pa.array([x[1] if k else None for x, k in zip(done, loss, strict=True)], pa.int64()), pa.array([x[2] if k else None for x, k in zip(done, loss, strict=True)], pa.int64()),
            ],
            ["conv_id", "turn", "role", "text", "segment", "loss_begin", "loss_end"],
        )


def format_turns(turns: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(conv_id, turn, segment, loss_begin, loss_end), a row for each turn, in order within each conversation.

    The text of a conversation is its segments one after another. The loss mask of a segment is
    [loss_begin, loss_end) in code points, null where the turn has no loss. Rows of a conversation
    stand together in one partition, sorted on disk; no conversation is ever held in memory.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role"), empty("text"))
    schema = "conv_id long, turn long, role string, text string, segment string, loss_begin long, loss_end long"
    formatted = rows.mapInArrow(lambda it: _format(it, loss_roles), schema)
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("role", "text")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads segments only: parses them, and hashes what it finds turn by turn."""
    none = object()
    conv, n, chars, loss_n, turns, loss = none, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    out: list[tuple] = []

    def close() -> None:
        if conv is not none:
            out.append((conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

    def batch() -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    for b in slices(batches):
        for key, segment, begin, end in zip(*(b.column(c).to_pylist() for c in ("conv_id", "segment", "loss_begin", "loss_end")), strict=True):
            if key != conv:
                close()
                conv, n, chars, loss_n, turns, loss = key, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            chars += len(segment)
            for role, text, text_begin, text_end in parse(segment):
                n += 1
                turns.update(f"{role}\n{text}\n".encode())
                if begin is not None:
                    if (begin, end) != (text_begin, text_end):
                        raise GrammarError("the loss mask isn't the turn's text")
                    loss_n += len(text)
                    loss.update(text.encode())
        yield batch()
        out.clear()
    close()
    yield batch()


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from the segments of format_turns().

    The SHA-256 of a conversation runs over its turns in sequence, so one task reads a conversation;
    its state is two hash states, however long the conversation is.
    """
    return formatted.select("conv_id", "segment", "loss_begin", "loss_end").mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


#: Conversation -1 of the query.
PROBE = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return conversation_digests(format_turns(given.unionByName(probe)))


#: A turn is escaped where a part of it has a mark, two escape characters in a row, or one at its end.
_NEEDS = r"""regexp_matches({}, '<s>|</s>|\[INST\]|\[/INST\]|\\\\|\\$')"""
_ESC = r"""regexp_replace({}, '(<s>|</s>|\[INST\]|\[/INST\]|\\)', '\\\1', 'g')"""
SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(CASE WHEN {_NEEDS.format("role")} OR {_NEEDS.format("text")} THEN length({_ESC.format("role")}) + length({_ESC.format("text")}) ELSE length(role) + length(text) END + {len(BOS + INST + END_INST + EOS)}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
