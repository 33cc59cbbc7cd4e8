"""Conversations as training text, from a declarative template.

A `Template` names the marks around a turn, the allowed order of roles as a finite-state
machine, and the roles whose text is trained on.  `format_chats` emits text segments in
order, each with its loss flag; `read_chats` reads conversations back from them.

Texts cannot forge a mark: in `<|`, `<\\|`, `<\\\\|` ... one backslash is added before the
bar (and taken out again on reading), and a role's line breaks are escaped as well.

Turns are ordered by turn, then role, then text, nulls first; repeated rows are repeated
turns.  Null role and null text count as empty; rows with null conv_id form one
conversation.  A turn out of order does not stop the output: it and the rest of its
conversation are marked `valid = false`.  An empty table gives an empty result.  Only the
four named columns are read.  Sorted partitions are streamed, so a conversation of any
length needs one turn's memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = (
    "conv_id long, turn_no long, segment_no int, text string, loss boolean, valid boolean"
)
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
    "loss_sha256 string, formatted_chars long, valid boolean"
)


@dataclass(frozen=True)
class Template:
    """Marks, role order and trained roles.

    `order` maps each state to the roles that may follow and the state each leads to.
    Marks must begin with `<|`, which is what escaping keeps out of texts.
    """

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_turn: str = "\n"
    trained: frozenset[str] = frozenset({"assistant"})
    first: str = "begin"
    order: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "begin": {"system": "ask", "user": "answer"},
            "ask": {"user": "answer"},
            "answer": {"assistant": "ask"},
        }
    )

    def __post_init__(self):
        if not (self.start.startswith("<|") and self.end.startswith("<|")):
            raise ValueError("marks must begin with <|")


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Three segments a turn: mark with role, text, closing mark.

    Rows of a conversation stay together and in order within a partition.
    """
    rows = turns.select(
        turns["conv_id"].cast("long").alias("conv_id"),
        turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"], F.lit("")).alias("role"),
        F.coalesce(turns["text"], F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, turn_no, state, valid, started = None, 0, template.first, True, False
        for batch in batches:
            out = []
            ids = [None if pd.isna(x) else int(x) for x in batch["conv_id"]]
            for conv_id, role, text in zip(ids, batch["role"], batch["text"], strict=True):
                if not started or conv_id != conv:
                    conv, turn_no, state, valid = conv_id, 0, template.first, True
                    started = True
                following = template.order.get(state, {}).get(role) if valid else None
                valid = following is not None
                state = following or state
                head = f"{template.start}{escape_role(role)}{template.after_role}"
                tail = f"{template.end}{template.after_turn}"
                trained = role in template.trained
                out.append((conv, turn_no, 0, head, False, valid))
                out.append((conv, turn_no, 1, escape(text), trained, valid))
                out.append((conv, turn_no, 2, tail, False, valid))
                turn_no += 1
            names = ["conv_id", "turn_no", "segment_no", "text", "loss", "valid"]
            frame = pd.DataFrame(out, columns=names)
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            yield frame

    return rows.mapInPandas(run, SEGMENTS)


class _Reader:
    """One conversation, read from its formatted text as it comes."""

    def __init__(self, conv_id: int | None, template: Template):
        self.conv_id, self.template = conv_id, template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0
        self.pending = ""
        self.valid = True
        close = re.escape(template.end + template.after_turn)
        self.turn = re.compile(
            f"(?s){re.escape(template.start)}(.*?){re.escape(template.after_role)}"
            f"(.*?){close}"
        )

    def feed(self, text: str, loss: bool, valid: bool) -> None:
        self.formatted += len(text)
        self.valid = self.valid and valid
        if loss:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.pending += text
        if not text.startswith(self.template.end):
            return
        while found := self.turn.match(self.pending):
            role, said = unescape_role(found[1]), unescape(found[2])
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n_turns += 1
            self.pending = self.pending[found.end() :]

    def row(self) -> tuple:
        if self.pending:
            raise ValueError(f"conversation {self.conv_id} does not end with a turn")
        return (
            self.conv_id,
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.formatted,
            self.valid,
        )


def read_chats(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Counts and digests of each conversation, read back from `format_chats` output.

    Segments may come in any order; their numbers put them back in their place.
    """
    order = "conv_id", "turn_no", "segment_no"
    segments = segments.repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in DIGESTS.split(", ")]
        reader = None
        for batch in batches:
            out = []
            ids = [None if pd.isna(x) else int(x) for x in batch["conv_id"]]
            columns = batch["turn_no"], batch["text"], batch["loss"], batch["valid"]
            for conv_id, turn_no, text, loss, valid in zip(ids, *columns, strict=True):
                if reader is None or reader.conv_id != conv_id:
                    if reader is not None:
                        out.append(reader.row())
                    reader = _Reader(conv_id, template)
                reader.feed(text, bool(loss), bool(valid))
            yield _frame(out, names)
        if reader is not None:
            yield _frame([reader.row()], names)

    return segments.mapInPandas(run, DIGESTS)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame
