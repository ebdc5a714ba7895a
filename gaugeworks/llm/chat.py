"""Chat formatting by a finite-state machine over roles.

A :class:`Template` says how turns are marked, which roles are learned and which role may
follow which. Rows are dealt by conversation, sorted by turn and streamed: the machine
keeps only the state of the conversation at hand, so one with a third of all rows needs
no more memory than a short one. Output is one row per segment of the formatted text, in
order, with its loss flag; segments of a conversation put together are its text.

Control strings inside texts and role names are escaped with a backslash, so that the
formatted text can be read back into the same turns (:func:`read_back`).

Defined results: a null text or role counts as empty; rows of a conversation with the
same turn are ordered by role, then text, and repeated rows stay; null turns come first;
null conversation ids form one conversation; an empty table gives an empty table; other
columns are not read. A conversation that breaks the order of roles is formatted all the
same, with ``valid`` false from the first wrong turn on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Template:
    """How turns are written. ``after`` maps a state (``start`` or the role before) to the roles that may follow."""

    open: str = "<|im_start|>"
    name_end: str = "\n"
    close: str = "<|im_end|>"
    between: str = "\n"
    learned: frozenset[str] = frozenset({"assistant"})
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
    after: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )

    def escape(self, text: str) -> str:
        return self._special.sub(r"\\\g<0>", text)

    def escape_name(self, role: str) -> str:
        return self.escape(role).replace(self.name_end, "\\" + self.name_end)

    @property
    def _special(self) -> regex.Pattern:
        # One compiled pattern per set of strings: the library keeps them.
        return regex.compile("|".join(map(regex.escape, ("\\", *sorted(self.controls, key=len, reverse=True)))))

    def may_follow(self, state: str, role: str) -> bool:
        return role in self.after.get(state, ())

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """One turn as pieces of text, each with its loss flag."""
        head = f"{self.open}{self.escape_name(role)}{self.name_end}"
        return [(head, False), (self.escape(text), role in self.learned), (self.close + self.between, False)]


def _ordered(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", *keys)


def format_conversations(
    df: DataFrame, template: Template, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """Segments (conversation, position, text, loss, valid), sorted by position within each conversation and partition."""
    source = df.select(
        F.col(conv_column).alias("conv"),
        F.col(turn_column).alias("turn"),
        F.coalesce(F.col(role_column), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    kind = dict(source.dtypes)["conv"]

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at: object = write  # no conversation yet
        state, valid, position = START, True, 0
        for frame in frames:
            out: list[tuple] = []
            convs = frame["conv"].astype(object).where(frame["conv"].notna(), None)
            for conv, role, text in zip(convs, frame["role"], frame["text"], strict=True):
                if conv != at:
                    at, state, valid, position = conv, START, True, 0
                valid = valid and template.may_follow(state, role)
                state = role
                for piece, loss in template.segments(role, text):
                    out.append((conv, position, piece, loss, valid))
                    position += 1
            yield pd.DataFrame(out, columns=["conv", "position", "segment", "loss", "valid"])

    schema = f"conv {kind}, position long, segment string, loss boolean, valid boolean"
    return _ordered(source, "turn", "role", "text").mapInPandas(write, schema).withColumnRenamed("conv", conv_column)


class _Reader:
    """Reads formatted text piece by piece and keeps digests of what it means."""

    def __init__(self, template: Template):
        self.template = template
        controls = "|".join(map(regex.escape, (template.open, template.close)))
        self._token = regex.compile(rf"\\(.)|({controls})", regex.DOTALL)
        self.turns, self.said = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.first_wrong: int | None = None
        self._inside = False
        self._text: list[str] = []

    def _plain(self, text: str) -> str:
        return regex.sub(r"\\(.)", r"\1", text, flags=regex.DOTALL)

    def read(self, segment: str, loss: bool, valid: bool) -> None:
        self.chars += len(segment)
        if loss:
            text = self._plain(segment)
            self.loss_chars += len(text)
            self.said.update(text.encode("utf-8"))
        if not valid and self.first_wrong is None:
            self.first_wrong = self.n_turns
        done = 0
        for found in self._token.finditer(segment):
            if found[2] is None:
                continue
            if self._inside:
                self._text.append(segment[done : found.start()])
                if found[2] == self.template.close:
                    self._turn("".join(self._text))
            self._inside, self._text = found[2] == self.template.open, []
            done = found.end()
        if self._inside:
            self._text.append(segment[done:])

    def _turn(self, written: str) -> None:
        """``written``: name, its end, text, all escaped."""
        end = regex.escape(self.template.name_end)
        name = regex.match(rf"(?:\\.|(?!{end}).)*", written, flags=regex.DOTALL)[0]
        text = written[len(name) + len(self.template.name_end) :]
        self.turns.update(f"{self._plain(name)}\n{self._plain(text)}\n".encode())
        self.n_turns += 1


def read_back(segments: DataFrame, template: Template, conv_column: str = "conv_id") -> DataFrame:
    """Per conversation what its formatted text says: turns, text under the loss mask, first wrong turn.

    Takes segments as :func:`format_conversations` leaves them, sorted within partitions
    with no conversation in two of them.
    """
    kind = dict(segments.dtypes)[conv_column]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def row(conv: object, r: _Reader) -> tuple:
            return conv, r.n_turns, r.turns.hexdigest(), r.loss_chars, r.said.hexdigest(), r.chars, r.first_wrong is None, r.first_wrong

        names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "first_wrong_turn"]
        at, reader = None, None
        for frame in frames:
            out = []
            convs = frame["conv"].astype(object).where(frame["conv"].notna(), None)
            for conv, position, segment, loss, valid in zip(convs, frame["position"], frame["segment"], frame["loss"], frame["valid"], strict=True):
                if position == 0:
                    if reader:
                        out.append(row(at, reader))
                    at, reader = conv, _Reader(template)
                reader.read(segment, loss, valid)
            yield pd.DataFrame(out, columns=names).astype({"first_wrong_turn": "Int64"})
        if reader:
            yield pd.DataFrame([row(at, reader)], columns=names).astype({"first_wrong_turn": "Int64"})

    schema = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, first_wrong_turn long"
    return segments.withColumnRenamed(conv_column, "conv").mapInPandas(read, schema).withColumnRenamed("conv", conv_column)
