"""Format conversations into training windows of a token budget.

Turns of a conversation are walked in order, spread over tasks by conversation and sorted by Spark, so that a task holds
one window and a few turns at a time however long a conversation is.  Prefix sums of turn tokens say how many turns fit.
A window starts with the system turn and a limited number of turns that came just before; these are repeated without
being learned again.  Every assistant text is under the loss mask of exactly one window.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_slices

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of public chat templates.  None of them occurs in an escaped text.
CONTROL = (START, SEP, END, "<|endoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
_REST = "(?=" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"
_PLAIN, _ESCAPED = re.compile(r"([<\[]\\*)" + _REST), re.compile(r"([<\[])\\(\\*)" + _REST)
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.DOTALL)

WINDOWS = (
    "conv_id long, window_no long, first_turn long, n_turns long, n_repeated long, tokens long, text string, "
    "loss array<struct<start: long, end: long>>"
)


def escape(text: str) -> str:
    """A backslash more after the first character of whatever looks like a control string, escaped before or not."""
    return _PLAIN.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def quarter_bytes(text: Column) -> Column:
    """A plain estimate of tokens: a quarter of the UTF-8 bytes, rounded up."""
    return F.ceil(F.octet_length(text) / 4)


def parsed(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a formatted window; start and end bound the escaped text in it."""
    turns, at = [], 0
    for turn in _TURN.finditer(text):
        if turn.start() != at:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(turn[1]), unescape(turn[2]), turn.start(2), turn.end(2)))
        at = turn.end()
    if at != len(text):
        raise ValueError(f"no turn at {at}")
    return turns


class _Conversation:
    """The turns of one conversation on their way into windows."""

    def __init__(self, conv_id: int | None, budget: int, history: int):
        self.conv_id, self.budget = conv_id, budget
        self.system: tuple | None = None
        self.recent: deque[tuple] = deque(maxlen=history)
        self.head: list[tuple] = []
        self.new: list[tuple] = []
        self.prefix = self.number = self.windows = 0

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """Take a turn; the window before it, if that is full."""
        full = None
        turn = (role, text, self.prefix, self.prefix + tokens)
        if self.new and self._size(self.head, self.new[0][2], turn[3]) > self.budget:
            full = self.flush()
        if not self.new:
            self.head = [self.system] if self.system else []
            recent = list(self.recent)
            while recent and self._size([*self.head, *recent], turn[2], turn[3]) > self.budget:
                recent.pop(0)
            self.head += recent
        self.new.append(turn)
        if not self.number and role == "system":
            self.system = turn
        else:
            self.recent.append(turn)
        self.prefix, self.number = turn[3], self.number + 1
        return full

    @staticmethod
    def _size(head: list[tuple], start: int, end: int) -> int:
        return sum(t[3] - t[2] for t in head) + end - start

    def flush(self) -> dict:
        parts, loss, at = [], [], 0
        for place, (role, text, _, _) in enumerate([*self.head, *self.new]):
            lead, body = f"{START}{escape(role)}{SEP}", escape(text)
            if role == "assistant" and place >= len(self.head) and body:
                loss.append({"start": at + len(lead), "end": at + len(lead) + len(body)})
            parts += [lead, body, END]
            at += len(lead) + len(body) + len(END)
        window = {
            "conv_id": self.conv_id,
            "window_no": self.windows,
            "first_turn": self.number - len(self.new),
            "n_turns": len(self.new),
            "n_repeated": len(self.head),
            "tokens": self._size(self.head, self.new[0][2], self.prefix),
            "text": "".join(parts),
            "loss": loss,
        }
        self.new, self.windows = [], self.windows + 1
        return window


_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "window_no", "first_turn", "n_turns", "n_repeated", "tokens")]
    + [("text", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
)


def _formatted(budget: int, history: int):
    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for part in text_slices(batches):
            out = []
            for row in part.to_pylist():
                if now is None or row["conv_id"] != now.conv_id:
                    if now:
                        out.append(now.flush())
                    now = _Conversation(row["conv_id"], budget, history)
                out.append(now.add(row["role"], row["text"], row["tokens"]))
            yield pa.RecordBatch.from_pylist([w for w in out if w], _ARROW)
        if now:
            yield pa.RecordBatch.from_pylist([now.flush()], _ARROW)

    return form


def format_windows(
    turns: DataFrame,
    budget: int = 512,
    history: int = 2,
    tokens: Callable[[Column], Column] = quarter_bytes,
) -> DataFrame:
    """Windows of conversations given as rows (conv_id, turn, role, text).

    A window has ``n_repeated`` turns seen before (the system turn, if the conversation starts with one, and up to
    ``history`` turns, fewer if they would not fit) and ``n_turns`` new ones from ``first_turn`` on, counted from 0.
    ``loss`` holds the code points of ``text`` that are new assistant texts.  No turn is cut: one above the budget is the
    only new turn of its window.

    Null texts and roles are empty.  Turns are ordered by ``turn`` (nulls first), ties by role and text; repeated rows are
    turns of their own.  Rows without conv_id are one conversation.  Other columns are ignored; an empty table has no
    windows.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", tokens(F.col("text")).cast("long"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.drop("turn").mapInArrow(_formatted(budget, history), WINDOWS)


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_windows long"
)


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.windows = 0

    def add(self, window: dict) -> None:
        new = parsed(window["text"])[window["n_repeated"] :]
        for role, text, _, _ in new:
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in window["loss"]:
            text = unescape(window["text"][span["start"] : span["end"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.n_turns += len(new)
        self.chars += len(window["text"])
        self.windows += 1

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
            "n_windows": self.windows,
        }


_DIGEST_ARROW = pa.schema(
    [
        (c, pa.string() if c.endswith("sha256") else pa.int64())
        for c in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows")
    ]
)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Digest | None = None
    for part in text_slices(batches):
        out = []
        for row in part.to_pylist():
            if now is None or row["conv_id"] != now.conv_id:
                if now:
                    out.append(now.row())
                now = _Digest(row["conv_id"])
            now.add(row)
        yield pa.RecordBatch.from_pylist(out, _DIGEST_ARROW)
    if now:
        yield pa.RecordBatch.from_pylist([now.row()], _DIGEST_ARROW)


def digests(windows: DataFrame) -> DataFrame:
    """What the formatted windows of each conversation say, parsed from their text: counts and digests."""
    read = windows.select("conv_id", "window_no", "n_repeated", "text", "loss")
    return read.repartition("conv_id").sortWithinPartitions("conv_id", "window_no").mapInArrow(_digested, DIGEST)


def format_and_read(turns: DataFrame, **options) -> DataFrame:
    """Format, write the windows, read them again and digest them."""
    return digests(stored(format_windows(turns, **options)))
