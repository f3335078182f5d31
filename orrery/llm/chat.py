"""Chat formatting: a finite-state machine over roles, a declarative template,
segments with loss flags, and the way back.

A template states what is written before and after a turn's text, which parts
of it are trained on for which roles, and the legal turn order. Texts and roles
may hold any characters: the escape character and the first character of each
control string inside them are escaped, so that the formatted text can be read
back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orrery.llm.common import mapped


@dataclass(frozen=True)
class Template:
    """before_role + role + after_role + text + after_text for each turn.

    ``order`` maps the state (the role before; ``start`` at the beginning) to
    the roles that may follow; ``ends`` are the roles that may come last."""

    before_role: str = "### "
    after_role: str = ":\n"
    after_text: str = "</turn>\n"
    escape: str = "\\"
    trained: tuple[str, ...] = ("assistant",)
    start: str = "<start>"
    order: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "<start>": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user",)})
    ends: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.before_role, self.after_role, self.after_text)

    def check(self) -> None:
        if len(self.escape) != 1 or not all(self.controls) or any(self.escape in c for c in self.controls):
            raise ValueError("controls must be non-empty and free of the one-character escape")


DEFAULT = Template()


def escaped(col, t: Template):
    """Column expression: every escape character and every first character of
    a control string is preceded by the escape character."""
    firsts = {c[0] for c in t.controls}
    out = F.replace(col, F.lit(t.escape), F.lit(t.escape * 2))
    for c in sorted(firsts):
        out = F.replace(out, F.lit(c), F.lit(t.escape + c))
    return out


def unescape(text: str, t: Template = DEFAULT) -> str:
    return re.sub(re.escape(t.escape) + "(.)", r"\1", text, flags=re.S)


def format_turns(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per turn of ``turns(conv_id, turn, role, text)``: conv_id, seq
    (its place in the conversation from 1), segments (array of struct<text,
    loss>: role header, text, end mark) and legal (the turn order up to here,
    and the role of a conversation's last turn, obey the template).

    Turns are ordered by turn, then role and text; null turns come first.
    Null texts and roles are empty. A null conv_id is a conversation of its
    own. Repeated turns stay, each as a turn. An empty table gives an empty
    result; other columns are not read."""
    template.check()
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = (t.withColumn("seq", F.row_number().over(w).cast("long"))
         .withColumn("state", F.coalesce(F.lag("role").over(w), F.lit(template.start)))
         .withColumn("last", F.lead("role").over(w).isNull()))
    moves = [(F.col("state") == s) & F.col("role").isin(*to) for s, to in template.order.items()]
    legal = F.lit(False)
    for m in moves:
        legal = legal | m
    legal = legal & (~F.col("last") | F.col("role").isin(*template.ends))
    trained = F.col("role").isin(*template.trained)
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    return t.select(
        "conv_id", "seq", legal.alias("legal"),
        F.array(segment(F.concat(F.lit(template.before_role), escaped(F.col("role"), template),
                                 F.lit(template.after_role)), F.lit(False)),
                segment(escaped(F.col("text"), template), trained),
                segment(F.lit(template.after_text), F.lit(False))).alias("segments"))


class Reader:
    """Reads the formatted text of one conversation, given in pieces that end
    where a segment ends, and keeps its digests only."""

    def __init__(self, t: Template):
        self.t = t
        self.mark = re.compile(
            re.escape(t.escape) + ".|" + "|".join(f"({re.escape(c)})" for c in t.controls), re.S)
        self.turns, self.all = 0, hashlib.sha256()
        self.loss_chars, self.loss = 0, hashlib.sha256()
        self.formatted = 0

    def turn(self, segments: Iterable[tuple[str, bool]]) -> None:
        text = "".join(s for s, _ in segments)
        self.formatted += len(text)
        cuts = [(m.lastindex, m.start(), m.end()) for m in self.mark.finditer(text) if m.lastindex]
        if [c[0] for c in cuts] != [1, 2, 3] or cuts[0][1] or cuts[2][2] != len(text):
            raise ValueError("this is not one formatted turn")
        role = unescape(text[cuts[0][2]:cuts[1][1]], self.t)
        said = unescape(text[cuts[1][2]:cuts[2][1]], self.t)
        self.turns += 1
        self.all.update(f"{role}\n{said}\n".encode())
        for s, loss in segments:
            if loss:
                plain = unescape(s, self.t)
                self.loss_chars += len(plain)
                self.loss.update(plain.encode())


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Read the formatted segments back: one row per conversation with the
    digests of the turns that were read and of the text under the loss mask.

    Conversations are streamed in order, a turn at a time: a hash over a whole
    conversation is sequential, but none is held in memory."""
    src = formatted.select("conv_id", "seq", "segments")
    src = src.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    schema = T.StructType([src.schema["conv_id"]]).add("n_turns", "long").add("turns_sha256", "string").add(
        "loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long")

    def run(it):
        now, reader, out = None, None, []

        def flush():
            if reader is not None:
                out.append((now, reader.turns, reader.all.hexdigest(), reader.loss_chars,
                            reader.loss.hexdigest(), reader.formatted))

        def rows(kind):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], kind), *(pa.array([r[k] for r in out]) for k in range(1, 6))],
                names=schema.names)

        kind = None
        for b in it:
            kind = b.schema.field(0).type
            for conv, seq, segments in zip(*(c.to_pylist() for c in b.columns)):
                if seq == 1:
                    flush()
                    now, reader = conv, Reader(template)
                reader.turn([(s["text"], s["loss"]) for s in segments])
            if len(out) > 4096:
                yield rows(kind)
                out.clear()
        flush()
        if out:
            yield rows(kind)

    return src.transform(mapped, run, schema)
