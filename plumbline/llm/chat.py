"""Chat formatting by a finite-state machine over roles and a declarative template.

A template names, for each role, the text before and after a turn, whether its text is trained on, and
the roles that may follow. The machine walks a conversation's turns in order; a turn that its state
doesn't allow, or of a role the template doesn't know, is formatted all the same and marked invalid.
Each turn becomes segments with a loss flag; a conversation is the concatenation of its turns. Texts are
escaped so that no control string of the template appears in them bare, and can be unescaped.

Turns are ordered by turn, role and text; rows stream through a task in that order, so a conversation
of any length is never held. Null texts and roles are empty; a null conv_id is a conversation of its own
(all such rows together). An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import numbered, ready, unnumbered

TURNS = "conv_id long, number long, valid boolean, segments array<string>, loss array<boolean>"


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool
    then: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    first: tuple[str, ...]
    turns: dict[str, Turn]
    mark: str = "### "
    end: str = "</turn>"


PLAIN = Template(
    first=("system", "user"),
    turns={
        "system": Turn("### System: ", "</turn>\n", False, ("user",)),
        "user": Turn("### User: ", "</turn>\n", False, ("assistant",)),
        "assistant": Turn("### Assistant: ", "</turn>\n", True, ("user",)),
    },
)


class Machine:
    """The state of one conversation: the roles that may come next."""

    def __init__(self, template: Template):
        self.template, self.allowed = template, template.first

    def step(self, role: str) -> bool:
        turn = self.template.turns.get(role)
        fits = turn is not None and role in self.allowed
        if turn is not None:
            self.allowed = turn.then
        return fits


class Writer:
    def __init__(self, template: Template):
        self.template = template
        self.control = re.compile("|".join(map(re.escape, ("\\", template.mark, template.end))))
        self.in_role = re.compile("|".join(map(re.escape, ("\\", ":", template.mark, template.end))))
        self.closing = re.compile(r"\\.|" + re.escape(template.end), re.DOTALL)
        self.other = re.compile(re.escape(template.mark) + r"@((?:\\.|[^\\:])*): ", re.DOTALL)

    def escape(self, text: str) -> str:
        return self.control.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        turn = self.template.turns.get(role)
        if turn is None:
            before, after, loss = f"{self.template.mark}@{self.in_role.sub(lambda m: chr(92) + m[0], role)}: ", self.template.end + "\n", False
        else:
            before, after, loss = turn.before, turn.after, turn.loss
        return [(before, False), (self.escape(text), loss), (after, False)]

    def parse(self, written: str) -> tuple[str, str]:
        """Role and text of one written turn."""
        for role, turn in self.template.turns.items():
            if written.startswith(turn.before):
                at = len(turn.before)
                break
        else:
            found = self.other.match(written)
            if not found:
                raise ValueError("not a written turn")
            role, at = self.unescape(found[1]), found.end()
        end = next(m.start() for m in self.closing.finditer(written, at) if m[0] == self.template.end)
        return role, self.unescape(written[at:end])


def formatted(conversations: DataFrame, template: Template = PLAIN) -> DataFrame:
    """One row per turn: conv_id, number (from 0), valid, and its segments with their loss flags."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, conv, machine, number = Writer(template), None, Machine(template), 0
        for batch in batches:
            rows = []
            for conv_id, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                if conv_id != conv:
                    conv, machine, number = conv_id, Machine(template), 0
                parts = writer.segments(role, text)
                rows.append((conv_id, number, machine.step(role), [p for p, _ in parts], [x for _, x in parts]))
                number += 1
            yield pd.DataFrame(rows, columns=["conv_id", "number", "valid", "segments", "loss"])

    ready(conversations.sparkSession)
    empty = F.lit("")
    rows = conversations.select(numbered("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return unnumbered(rows.mapInPandas(run, TURNS), "conv_id")


DIGESTS = "conv_id long, n_turns long, valid boolean, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(written: DataFrame, template: Template = PLAIN) -> DataFrame:
    """What the written turns say when they are parsed again, per conversation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, held = Writer(template), None

        def closed(rows: list) -> pd.DataFrame:
            out = [(c, n, ok, a.hexdigest(), chars, b.hexdigest(), size) for c, n, ok, a, chars, b, size in rows]
            return pd.DataFrame(out, columns=[c.split()[0] for c in DIGESTS.split(", ")])

        for batch in batches:
            done = []
            for conv_id, valid, segments, loss in zip(batch["conv_id"], batch["valid"], batch["segments"], batch["loss"]):
                if held is None or held[0] != conv_id:
                    if held:
                        done.append(held)
                    held = [conv_id, 0, True, hashlib.sha256(), 0, hashlib.sha256(), 0]
                whole = "".join(segments)
                role, text = writer.parse(whole)
                trained = "".join(writer.unescape(s) for s, flag in zip(segments, loss) if flag)
                held[1] += 1
                held[2] &= bool(valid)
                held[3].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                held[4] += len(trained)
                held[5].update(trained.encode("utf-8", "surrogatepass"))
                held[6] += len(whole)
            yield closed(done)
        if held:
            yield closed([held])

    ready(written.sparkSession)
    rows = written.withColumn("conv_id", numbered("conv_id")).repartition("conv_id").sortWithinPartitions("conv_id", "number")
    return unnumbered(rows.select("conv_id", "valid", "segments", "loss").mapInPandas(run, DIGESTS), "conv_id")
