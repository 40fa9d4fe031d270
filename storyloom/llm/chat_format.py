"""Chat formatting by budgeted windows.

Turns of a conversation get prefix sums of their tokens, counted by a tokenizer's file on the turn as written. A window is a
span of whole turns within the budget: the system turn first if the conversation begins with one, then a limited history of
turns that earlier windows have shown, then new turns, as many as fit. Only what is new in a window is a target: assistant
text in the history is under no loss. Turns are never cut: one that alone exceeds the budget has a window of its own, whole.
The system turn is left out of a window where it doesn't fit beside the first new turn; there only, and in the others it stays.

Template. A turn is written as

    ### Role: text </turn>\n

with the role's first letter in upper case. Within role and text, each backslash, `###` and `</turn>` is preceded by a
backslash, so control strings of the template never arise from content, and unescaping gives back every content as it was.

Conversations stream through tasks sorted by (conv_id, turn): a conversation of any length needs the memory of one window
and its digests' state. Digests are read back from the formatted windows by a parser of the template.

Defined results: a null text or role is an empty string; null turns come first, equal turns in the order of role and text;
rows without conv_id are one conversation of null id. An empty table gives no rows. Other columns are ignored."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storyloom.llm import scratch
from storyloom.llm.packing import encoder_of

OPEN, CLOSE = "### ", " </turn>\n"
_CONTROL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(\\|###|</turn>)")
WINDOW_SCHEMA = "conv_id long, window long, text string, loss array<struct<start:int,end:int>>, n_tokens long, n_repeated long"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _role_name(role: str) -> str:
    """Reversible: roles in lower case get a capital, any other is marked by a leading equals sign."""
    return role[0].upper() + role[1:] if role and role == role.lower() and role[0].isascii() and role[0].isalpha() else "=" + role


def _role_of(name: str) -> str:
    return name[1:] if name[:1] == "=" else name[:1].lower() + name[1:]


def render(role: str, text: str) -> tuple[str, int]:
    """The turn as written, and where its text begins."""
    # A colon in a role would end it early.
    head = OPEN + escape(_role_name(role)).replace(":", "\\:") + ": "
    return head + escape(text) + CLOSE, len(head)


def parse(window: str) -> Iterator[tuple[str, int, int]]:
    """(role, text start, text end) of each turn of a window."""
    at = 0
    while at < len(window):
        if not window.startswith(OPEN, at):
            raise ValueError(f"no turn begins at {at}")
        i = at + len(OPEN)
        while not window.startswith(": ", i):
            i += 2 if window[i] == "\\" and window[i + 1] in "\\:" else 1
        role = unescape(window[at + len(OPEN) : i].replace("\\:", ":"))
        begin = i + 2
        end = _close_at(window, begin)
        yield _role_of(role), begin, end
        at = end + len(CLOSE)


_NEXT = re.compile(r"\\(?:\\|###|</turn>)| </turn>\n")


def _close_at(window: str, at: int) -> int:
    for m in _NEXT.finditer(window, at):
        if m[0] == CLOSE:
            return m.start()
    raise ValueError("a turn doesn't end")


@dataclass
class Windows:
    """The windows of one conversation, turn by turn. Each is (text, loss spans, tokens, turns shown again)."""

    count: Callable[[str], int]
    budget: int = 2048
    history_budget: int = 512
    made: int = 0
    system: tuple | None = None
    shown: bool = False  # whether the open window has the system turn
    history: deque = field(default_factory=deque)
    new: list = field(default_factory=list)
    sums: list = field(default_factory=lambda: [0])  # prefix sums of the tokens of history and new turns

    def add(self, role: str, text: str):
        """Yields the open window if this turn doesn't fit into it."""
        written, begin = render(role, text)
        turn = (role, written, begin, self.count(written))
        if self.new and self._taken() + self.sums[-1] + turn[3] > self.budget:
            yield self._close()
        if not self.new:
            self.shown = self.system is not None and self.system[3] + turn[3] <= self.budget
        while self.history and not self.new and self._taken() + self.sums[-1] + turn[3] > self.budget:
            # The history gives way, oldest first, to the turn that opens the window.
            n = self.history.popleft()[3]
            self.sums = [x - n for x in self.sums[1:]]
        self.new.append(turn)
        self.sums.append(self.sums[-1] + turn[3])

    def _taken(self) -> int:
        return self.system[3] if self.shown else 0

    def _close(self):
        shown = [*([self.system] if self.shown else []), *self.history]
        text, loss, at = [], [], 0
        for k, (role, written, begin, _) in enumerate([*shown, *self.new]):
            if role == "assistant" and k >= len(shown):
                loss.append((at + begin, at + len(written) - len(CLOSE)))
            text.append(written)
            at += len(written)
        n = self._taken() + self.sums[-1]
        turns = [*self.history, *self.new]
        if not self.made and turns[0][0] == "system":
            self.system = turns.pop(0)
        # The last turns, as many as their sums allow, are what the next window repeats.
        self.history, room = deque(), self.history_budget
        for turn in reversed(turns):
            room -= turn[3]
            if room < 0:
                break
            self.history.appendleft(turn)
        self.new, self.made, self.sums = [], self.made + 1, [0]
        for turn in self.history:
            self.sums.append(self.sums[-1] + turn[3])
        return "".join(text), loss, n, len(shown)

    def finish(self):
        if self.new:
            yield self._close()


def _turns(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist(), strict=True)


def _by_conversation(batches, count: Callable[[str], int], budget: int, history_budget: int) -> Iterator[tuple]:
    """(conv_id, window number, text, loss, tokens, repeated turns) of sorted turns."""
    windows, conv, first = None, None, True
    for c, role, text in _turns(batches):
        if first or c != conv:
            if windows:
                yield from ((conv, windows.made - 1, *w) for w in windows.finish())
            windows, conv, first = Windows(count, budget, history_budget), c, False
        yield from ((conv, windows.made - 1, *w) for w in windows.add(role or "", text or ""))
    if windows:
        yield from ((conv, windows.made - 1, *w) for w in windows.finish())


def _sorted(conversations: DataFrame) -> DataFrame:
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def format_windows(spark: SparkSession, conversations: DataFrame, tokenizer: str, budget: int = 2048, history_budget: int = 512) -> DataFrame:
    """One row a window: its text, the spans of it under loss, its tokens, and how many turns it shows again first."""
    scratch.bound_batches(spark)

    def run(batches):
        held, size = [], 0
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.int64(), pa.int64()]
        give = lambda: pa.record_batch([pa.array([[{"start": a, "end": b} for a, b in x[k]] if k == 3 else x[k] for x in held], kind) for k, kind in enumerate(kinds)], names=["conv_id", "window", "text", "loss", "n_tokens", "n_repeated"])
        for w in _by_conversation(batches, lambda t: len(encoder_of(tokenizer).encode(t)), budget, history_budget):
            held.append(w)
            size += len(w[2])
            if size > 2_000_000:
                yield give()
                held, size = [], 0
        if held:
            yield give()

    return _sorted(conversations).mapInArrow(run, WINDOW_SCHEMA)


def read_back(spark: SparkSession, windows: DataFrame) -> DataFrame:
    """Per conversation, what its windows (format_windows, in any order) hold, by parsing their texts alone."""
    scratch.bound_batches(spark)

    def run(batches):
        rows, state = [], None
        for b in batches:
            for conv, number, text, loss, new in zip(*(b.column(c).to_pylist() for c in ("conv_id", "window", "text", "loss", "n_repeated")), strict=True):
                if state is None or number == 0:
                    if state:
                        rows.append(state.row())
                    state = _Digest(conv)
                state.add(text, [(x["start"], x["end"]) for x in loss], new)
            if len(rows) > 5000:
                yield _digests(rows)
                rows = []
        if state:
            rows.append(state.row())
        if rows:
            yield _digests(rows)

    return windows.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(run, DIGEST_SCHEMA)


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def _digests(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in DIGEST_SCHEMA.split(", ")])


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.all, self.loss = conv, 0, hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.chars = self.windows = 0

    def add(self, text: str, loss, new_from: int) -> None:
        for k, (role, begin, end) in enumerate(parse(text)):
            if k >= new_from:
                self.all.update(f"{role}\n{unescape(text[begin:end])}\n".encode())
                self.turns += 1
        for begin, end in loss:
            plain = unescape(text[begin:end])
            self.loss.update(plain.encode())
            self.loss_chars += len(plain)
        self.chars += len(text)
        self.windows += 1

    def row(self):
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.windows
