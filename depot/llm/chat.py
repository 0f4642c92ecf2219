r"""Chat formatting with a grammar round trip.

Template (a conversation is ``<s>`` followed by its turns):

    user         [INST] text [/INST]
    assistant    a space, the text, `` </s>``
    system       [SYS] text [/SYS]
    other roles  [ROLE]role[/ROLE]text[/TURN]

In a text or role, ``\`` takes the next character literally, and a control
string that is not escaped ends the field.  Every turn is rendered plainly
first and read again by the deterministic parser; while what comes back is
not the source, the conflicting content is escaped further (level 1: control
strings, level 2: control strings and the escape character) and it is read
again.  At level 2 the grammar is unambiguous, so the loop ends.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depot.llm.common import map_arrow

BEGIN = "<s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[/TURN]")
ESCAPE = "\\"
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_BOTH = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROL))))
_STOP = re.compile(r"\\(.)|(%s)" % _CONTROL.pattern, re.S)
#: role: (before the text, after the text, the control string that ends it)
_FRAMES = {"user": ("[INST] ", " [/INST]", "[/INST]"), "assistant": (" ", " </s>", "</s>"), "system": ("[SYS] ", " [/SYS]", "[/SYS]")}


class Conflict(ValueError):
    """The text does not follow the grammar."""


def escape(text: str, level: int) -> str:
    return text if not level else (_CONTROL if level == 1 else _BOTH).sub(lambda m: ESCAPE + m[0], text)


def render(role: str, text: str, level: int = 0) -> str:
    if role in _FRAMES:
        before, after, _ = _FRAMES[role]
        return before + escape(text, level) + after
    return f"[ROLE]{escape(role, level)}[/ROLE]{escape(text, level)}[/TURN]"


def _field(s: str, at: int, end: str) -> tuple[str, int, int]:
    """Unescaped content from ``at`` up to the control string ``end``: (content, where it ends, where the next field begins)."""
    parts, last = [], at
    for m in _STOP.finditer(s, at):
        parts.append(s[last:m.start()])
        if m[2] is None:
            parts.append(m[1])
            last = m.end()
        elif m[2] != end:
            raise Conflict(f"{m[2]} at {m.start()}")
        else:
            return "".join(parts), m.start(), m.end()
    raise Conflict(f"no {end}")


def parse(s: str) -> list[tuple[str, str, int, int]]:
    """Turns of rendered text: (role, text, start and end of the text's span)."""
    out, at = [], 0
    while at < len(s):
        if s.startswith("[ROLE]", at):
            role, _, start = _field(s, at + 6, "[/ROLE]")
            text, end, at = _field(s, start, "[/TURN]")
            if role in _FRAMES:
                raise Conflict(f"{role} has a frame of its own")
        else:
            role = next((r for r, (before, _, _) in _FRAMES.items() if s.startswith(before, at)), None)
            if role is None:
                raise Conflict(f"no turn at {at}")
            before, _, stop = _FRAMES[role]
            start = at + len(before)
            text, end, at = _field(s, start, stop)
            if not text.endswith(" "):
                raise Conflict(f"no space before {stop}")
            text, end = text[:-1], end - 1
        out.append((role, text, start, end))
    return out


def round_trip(role: str, text: str) -> tuple[str, int]:
    """The rendered turn that reads back identical, and the escape level it took."""
    for level in range(3):
        s = render(role, text, level)
        try:
            if [(r, t) for r, t, _, _ in parse(s)] == [(role, text)]:
                return s, level
        except Conflict:
            pass
    raise Conflict(f"no level makes it identical: {role!r}")


def format_turns(conversations: DataFrame) -> DataFrame:
    """Render every turn: one row per input row with ``conv_id``, ``turn``,
    ``role``, ``piece`` (the rendered turn) and ``escape_level``.

    A conversation's formatted text is ``<s>`` and its pieces by turn, then
    role, then piece (ties and repeated rows so have one order; null turns
    first).  Null role or text: empty.  Null conv_id: one conversation of its
    own.  Rendering is row by row before any shuffle; further columns are
    ignored; an empty table gives an empty result."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "conv_id long, turn long, role string, piece string, escape_level int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [round_trip(r, t) for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id").cast(pa.int64()), b.column("turn").cast(pa.int64()), b.column("role"),
                 pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32())],
                ["conv_id", "turn", "role", "piece", "escape_level"])

    return map_arrow(rows, run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted conversations again: one row per conversation with
    ``n_turns``, ``turns_sha256`` (role, \\n, text, \\n of each turn),
    ``loss_chars`` and ``loss_sha256`` (the unescaped assistant texts, which
    are what the loss mask covers) and ``formatted_chars``.

    The pieces stream through a task in order and only running digests are
    kept, so a conversation of any length needs the memory of one turn (the
    digest of one text is sequential by nature)."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = [c.split()[0] for c in schema.split(", ")]
    pieces = formatted.select("conv_id", "turn", "role", "piece").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, done = object(), None, []

        def end() -> None:
            if state:
                done.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for b in batches:
            for conv, piece in zip(b.column("conv_id").to_pylist(), b.column("piece").to_pylist()):
                if state is None or conv != current:
                    end()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), len(BEGIN)]
                for role, text, _, _ in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(piece)
            if len(done) >= 4096:
                yield _rows(done, columns)
                done = []
        end()
        if done:
            yield _rows(done, columns)

    return map_arrow(pieces, run, schema)


def _rows(done: list[tuple], columns: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], columns)
