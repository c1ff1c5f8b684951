"""Chat formatting by incremental black-box rendering.

A template is any function from turns to text. Successive prefixes of a conversation are rendered and consecutive outputs compared: what the
longer one adds is the turn's span; a longer output that does not begin with the shorter one has rewritten history, and is marked.
A second rendering with the turn's text left out locates the text inside the span. Prefixes are whole, from the first turn on, so the cost of
a conversation grows with the square of its turns. A template that is declared ``turn_local`` (what it puts for a turn depends on no turn before it) is
given prefixes of the last ``window`` turns only (moved on by half); at its end such a conversation is rendered once as a whole, and where that
differs from the joined pieces, its last turn is marked as rewritten. The turns of one conversation are held in memory.

Defined cases. Null text or role: as empty. Turns are ordered by number, then role, then text; null numbers first. Repeated rows: a turn
each. Null conv_id: rows of one conversation without id. Empty table: no rows. Texts with the template's control strings are escaped and come
back unchanged. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
WINDOW = 64
ROWS = 2000

# Fixed values of the production template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[TURN]", "[/TURN]", "[ROLE]", "[/ROLE]")
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(\\?)")
_TURN = re.compile(r"\[SYS\] (.*?) \[/SYS\]|\[INST\] (.*?) \[/INST\]|\[TURN\] (.*?) \[ROLE\] (.*?) \[/TURN\]| ?<s>| (.*?) </s>", re.S)


def turn_local(template: Callable[[Turns], str]) -> Callable[[Turns], str]:
    """Declares that a template puts for each turn what depends on no turn before it."""
    template.turn_local = True
    return template


def escape(text: str) -> str:
    """Backslashes are doubled, and one is put into every control string; ``unescape`` takes both back."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@turn_local
def instruct(turns: Turns) -> str:
    """The production template: every role in its own marks, roles other than the usual three by name."""
    out = ["<s>"]
    for role, text in turns:
        text = escape(text)
        if role == "system":
            out.append(f"[SYS] {text} [/SYS]")
        elif role == "user":
            out.append(f"[INST] {text} [/INST]")
        elif role == "assistant":
            out.append(f" {text} </s>")
        else:
            out.append(f"[TURN] {escape(role)} [ROLE] {text} [/TURN]")
    return "".join(out)


def read_turns(formatted: str) -> Turns:
    """Roles and texts out of text that ``instruct`` has made (the whole of it or the span of a turn)."""
    out = []
    for match in _TURN.finditer(formatted):
        system, user, role, other, assistant = match.groups()
        if system is not None:
            out.append(("system", unescape(system)))
        elif user is not None:
            out.append(("user", unescape(user)))
        elif role is not None:
            out.append((unescape(role), unescape(other)))
        elif assistant is not None:
            out.append(("assistant", unescape(assistant)))
    return out


def common(a: str, b: str) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Renderer:
    """Renders the prefixes of one conversation and tells each turn's part of the output."""

    def __init__(self, template: Callable[[Turns], str], window: int = WINDOW):
        self.template, self.window, self.turns = template, max(2, window) if getattr(template, "turn_local", False) else None, []
        self.last = template([])
        self.dropped: Turns = []
        self.joined = hashlib.sha256()

    def add(self, role: str, text: str) -> tuple[str, int, int, bool]:
        """(piece, text start, text end within the piece, rewritten). The first piece also holds what the template puts before all turns."""
        first = not self.turns
        if self.window is not None and len(self.turns) >= self.window:
            self.dropped += self.turns[:-(self.window // 2)]
            self.turns = self.turns[-(self.window // 2):]
            self.last = self.template(self.turns)
        before = 0 if first else len(self.last)
        self.turns.append((role, text))
        now = self.template(self.turns)
        kept = common(self.last, now)
        rewritten = kept < len(self.last)
        bare = self.template([*self.turns[:-1], (role, "")])
        length, shared = len(now) - len(bare), common(now, bare)
        start = self.locate(now, bare, length, shared, escape(text))
        begin = before if not rewritten else min(kept, before)
        piece = now[begin:]
        self.last = now
        if self.window is not None:
            self.joined.update(piece.encode("utf-8", "surrogatepass"))
        return piece, max(0, start - begin), max(0, start + length - begin), rewritten

    def whole(self) -> bool:
        """Whether the joined pieces are the output of the whole conversation; only where turns were dropped they may not be."""
        if not self.dropped:
            return True
        full = self.template([*self.dropped, *self.turns])
        return hashlib.sha256(full.encode("utf-8", "surrogatepass")).digest() == self.joined.digest()

    @staticmethod
    def locate(now: str, bare: str, length: int, shared: int, written: str) -> int:
        """Where the text stands: of the places whose removal gives the bare output, the one that reads as the text."""
        at = shared
        while at >= 0 and now[at:at + length] != written and now[at - 1:at] == now[at + length - 1:at + length] and at:
            at -= 1
        return at if now[at:at + length] == written else shared


def format_turns(conversations: DataFrame, template: Callable[[Turns], str] = instruct, window: int = WINDOW) -> DataFrame:
    """One row per turn: conv_id, position, role, piece, start (of the piece in the conversation's output), text_start, text_end, loss, rewritten.

    The pieces of a conversation, in order of position, joined are its output (of a template that rewrites, from the last
    rewritten turn's start on; of one that is wrongly declared turn-local they are not, and the last turn is marked). Rows of a conversation stand together, in order, in one partition.
    """
    def render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, renderer, position, offset = object(), None, 0, 0
        out = []

        def end():
            # The last row waits for the end of its conversation.
            if renderer is not None and not renderer.whole():
                out[-1] = (*out[-1][:-1], True)

        def flush(kept: int) -> pd.DataFrame:
            ready = out[:len(out) - kept]
            del out[:len(ready)]
            frame_out = pd.DataFrame(ready, columns=["conv_id", "position", "role", "piece", "start", "text_start", "text_end", "loss", "rewritten"])
            frame_out["conv_id"] = frame_out["conv_id"].astype("Int64")
            return frame_out

        for frame in frames:
            for begin in range(0, len(frame), ROWS):
                part = frame.iloc[begin:begin + ROWS]
                for conv, role, text in zip(part["conv_id"], part["role"], part["text"]):
                    conv = None if pd.isna(conv) else int(conv)
                    if conv != current:
                        end()
                        current, renderer, position, offset = conv, Renderer(template, window), 0, 0
                    piece, a, b, rewritten = renderer.add(role or "", text or "")
                    out.append((conv, position, role or "", piece, offset, offset + a, offset + b, role == "assistant", rewritten))
                    position, offset = position + 1, offset + len(piece)
                yield flush(1)
        end()
        yield flush(0)

    return (conversations.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInPandas(render, "conv_id long, position long, role string, piece string, start long, text_start long, text_end long, loss boolean, rewritten boolean"))


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests read back from the output of ``format_turns`` with the production template, one row per conversation.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewritten). The rows stream in the order that ``format_turns``
    leaves; a conversation is not held as a whole here.
    """
    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, out = object(), None, []

        def done():
            if state is not None:
                n, turns, chars, loss, size, rewritten = state
                out.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size, rewritten))

        def flush():
            found = pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewritten"])
            found["conv_id"] = found["conv_id"].astype("Int64")
            out.clear()
            return found

        for frame in frames:
            for conv, piece, start, a, b, loss_on, rewritten in zip(frame["conv_id"], frame["piece"], frame["start"], frame["text_start"], frame["text_end"], frame["loss"], frame["rewritten"]):
                conv = None if pd.isna(conv) else int(conv)
                if conv != current:
                    done()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                for role, text in read_turns(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if loss_on:
                    text = unescape(piece[a - start:b - start])
                    state[2] += len(text)
                    state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
                state[5] |= bool(rewritten)
            if len(out) >= ROWS:
                yield flush()
        done()
        yield flush()

    return pieces.mapInPandas(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten boolean")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose texts are control strings."""
    spark = conversations.sparkSession
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(extra)
