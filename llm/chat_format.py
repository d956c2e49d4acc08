"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to one string. Nothing
of its inside is read: a conversation is rendered turn by turn, each output is
compared with the one before, and what was added is the turn's span. Where an
output does not continue the one before, the template rewrites history (it
folds a system turn into the next one, drops earlier reasoning, closes the
last turn in another way); such turns are reported.

Within a turn the text is found by a second rendering of the same prefix in
which a character that occurs nowhere in the conversation stands for the
text: what precedes and follows it are the turn's marks. Where history was
rewritten, every text is looked for in the whole output in the same way. A
text that the template drops, repeats or changes has no exact place, and is
no part of the loss mask.

Control strings inside texts are broken by a backslash after their first
character; where backslashes stand there already, one more is added, so that
removing one gives back the text whatever it holds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import table

Turn = tuple[str, str]


class Controls:
    """Control strings and their reversible escape."""

    def __init__(self, strings: Iterable[str]):
        self.strings = tuple(strings)
        for a in self.strings:
            if len(a) < 2 or "\\" in a:
                raise ValueError(f"a control string has two characters or more and no backslash: {a!r}")
            for b in self.strings:
                if (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"control strings overlap: {a!r}, {b!r}")
        forms = [re.escape(c[0]) + r"\\{}" + re.escape(c[1:]) for c in self.strings]
        self._any = re.compile("|".join(f.replace("{}", "*") for f in forms))
        self._escaped = re.compile("|".join(f.replace("{}", "+") for f in forms))

    def escape(self, text: str) -> str:
        return self._any.sub(lambda m: m[0][0] + "\\" + m[0][1:], text) if self.strings else text

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0] + m[0][2:], text) if self.strings else text


@dataclass(frozen=True)
class Template:
    """``render`` is the black box; ``controls`` undoes its escapes and ``read``,
    if there is one, parses an output back to (role, text)."""

    name: str
    render: Callable[[list[Turn]], str]
    controls: Controls = field(default_factory=lambda: Controls(()))
    read: Callable[[str], list[Turn]] | None = None


INST_CONTROLS = Controls(("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"))
CHATML_CONTROLS = Controls(("<|im_start|>", "<|im_end|>"))
_INST = re.compile(r"<<SYS>>\n(.*?)\n<</SYS>>\n|<s>\[INST\] (.*?) \[/INST\]| (.*?) </s>|<s>\[ROLE\] (.*?) \[/ROLE\](.*?)</s>", re.DOTALL)


def render_inst(turns: list[Turn]) -> str:
    """Bracketed instructions; roles other than the three usual ones are named."""
    out = []
    for role, text in turns:
        text = INST_CONTROLS.escape(text)
        if role == "system":
            out.append(f"<<SYS>>\n{text}\n<</SYS>>\n")
        elif role == "user":
            out.append(f"<s>[INST] {text} [/INST]")
        elif role == "assistant":
            out.append(f" {text} </s>")
        else:
            out.append(f"<s>[ROLE] {INST_CONTROLS.escape(role)} [/ROLE]{text}</s>")
    return "".join(out)


def read_inst(output: str) -> list[Turn]:
    """The turns of an output of ``render_inst``; anything else is an error."""
    turns, at, un = [], 0, INST_CONTROLS.unescape
    while at < len(output):
        m = _INST.match(output, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        kind = m.lastindex
        turns.append((un(m[4]), un(m[5])) if kind == 5 else (("system", "user", "assistant")[kind - 1], un(m[kind])))
        at = m.end()
    return turns


def render_chatml(turns: list[Turn]) -> str:
    esc = CHATML_CONTROLS.escape
    return "".join(f"<|im_start|>{esc(role)}\n{esc(text)}<|im_end|>\n" for role, text in turns)


def render_folded(turns: list[Turn]) -> str:
    """As ``render_inst``, but a system turn waits for the user turn after it and
    stands within it: the output for a prefix that ends in a system turn is
    rewritten by the next turn."""
    out, waiting = [], None
    for role, text in turns:
        if role == "system" and waiting is None:
            waiting = text
            continue
        if waiting is not None:
            system = f"<<SYS>>\n{INST_CONTROLS.escape(waiting)}\n<</SYS>>\n"
            out.append(f"<s>[INST] {system}{INST_CONTROLS.escape(text)} [/INST]" if role == "user" else system + render_inst([(role, text)]))
            waiting = None
        else:
            out.append(render_inst([(role, text)]))
    return "".join(out) + (render_inst([("system", waiting)]) if waiting is not None else "")


INST = Template("inst", render_inst, INST_CONTROLS, read_inst)
CHATML = Template("chatml", render_chatml, CHATML_CONTROLS)
FOLDED = Template("folded", render_folded, INST_CONTROLS)


@dataclass
class Place:
    """Offsets in code points: the turn's span, its text's span, and whether the
    text is exactly what stands there. A span that is not known is None."""

    span: tuple[int, int] | None
    text: tuple[int, int] | None
    exact: bool


def _stand_in(turns: list[Turn]) -> str:
    """A private-use character that occurs in no role and no text."""
    for c in map(chr, chain(range(0xE000, 0xF900), range(0xF0000, 0x10FFFE))):
        if not any(c in role or c in text for role, text in turns):
            return c
    raise ValueError("every private-use character occurs")


def _text_place(template: Template, before: list[Turn], turn: Turn, after: list[Turn], out: str, mark: str) -> tuple[tuple[int, int] | None, bool]:
    probe = template.render([*before, (turn[0], mark), *after])
    at = probe.find(mark)
    if at < 0 or probe.find(mark, at + 1) >= 0:
        return None, False
    to = len(out) - (len(probe) - at - 1)
    if to < at:
        return None, False
    return (at, to), template.controls.unescape(out[at:to]) == turn[1]


def locate(template: Template, turns: list[Turn]) -> tuple[str, list[Place], list[int]]:
    """(output, place of each turn, turns that rewrote what stood before them).

    Every prefix is rendered twice, so a conversation of n turns costs about
    n renderings of its whole length.
    """
    mark, places, rewrites = _stand_in(turns), [], []
    prev = out = template.render([])
    for k, turn in enumerate(turns):
        out = template.render(turns[:k + 1])
        if not out.startswith(prev):
            rewrites.append(k)
        text, exact = _text_place(template, turns[:k], turn, [], out, mark)
        places.append(Place((len(prev), len(out)), text, exact))
        prev = out
    if rewrites:
        for k, turn in enumerate(turns):
            text, exact = _text_place(template, turns[:k], turn, turns[k + 1:], out, mark)
            # spans before the first rewriting turn's prefix moved; later ones continue the output
            places[k] = Place(places[k].span if k > rewrites[-1] else None, text, exact)
    return out, places, rewrites


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_TURN = pa.struct([("role", pa.string()), ("span", _SPAN), ("text", _SPAN), ("exact", pa.bool_())])
_OUT = "conv_id bigint, formatted string, turns array<struct<role:string,span:struct<start:int,end:int>,text:struct<start:int,end:int>,exact:boolean>>, loss array<struct<start:int,end:int>>, rewrites array<int>"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, msgs array<struct<turn,role,text>>), one row a conversation."""
    rows = turns.select(F.col(id_col).cast("bigint").alias("conv_id"), F.struct(
        F.col(turn_col).cast("bigint").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).alias("msg"))
    known = rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("msg")).alias("msgs"))
    return known.unionByName(rows.where("conv_id is null").select("conv_id", F.array("msg").alias("msgs")))


def format_chats(convs: DataFrame, template: Template = INST, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, turns, loss, rewrites) of ``conversations``.

    ``turns``: role, span of the turn, span of its text and whether the text
    reads back from there; ``loss``: spans of the exact texts of
    ``loss_roles``, in order; ``rewrites``: turns (from 0) at which the
    template changed what it had written. Offsets are code points, ends
    exclusive.

    Turns stand by number, null first, then by role and text; repeated rows
    all count. Null roles and texts are empty. Rows with a null id are
    conversations of one turn each. An empty table gives no rows. A
    conversation is one string, so it has to fit in a task; texts are whole.
    """

    def run(batches):
        for b in batches:
            out, places, loss, rewrites = [], [], [], []
            for msgs in b["msgs"].to_pylist():
                said = [(m["role"], m["text"]) for m in msgs]
                text, found, changed = locate(template, said)
                out.append(text)
                rewrites.append(changed)
                places.append([{"role": role, "span": _span(p.span), "text": _span(p.text), "exact": p.exact}
                               for (role, _), p in zip(said, found)])
                loss.append([_span(p.text) for (role, _), p in zip(said, found) if role in loss_roles and p.exact])
            yield pa.RecordBatch.from_arrays(
                [b["conv_id"], pa.array(out, pa.string()), pa.array(places, pa.list_(_TURN)), pa.array(loss, pa.list_(_SPAN)),
                 pa.array(rewrites, pa.list_(pa.int32()))], names=["conv_id", "formatted", "turns", "loss", "rewrites"])

    return convs.select("conv_id", "msgs").mapInArrow(run, _OUT)


def _span(at):
    return None if at is None else {"start": at[0], "end": at[1]}


def read_back(formatted: DataFrame, template: Template = INST) -> DataFrame:
    """What a reader of the formatted strings finds: (conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars). The input turns are not used."""

    def run(batches):
        for b in batches:
            cols = {c: [] for c in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, loss in zip(b["formatted"].to_pylist(), b["loss"].to_pylist()):
                said = template.read(text)
                learnt = "".join(template.controls.unescape(text[s["start"]:s["end"]]) for s in loss)
                cols["n_turns"].append(len(said))
                cols["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest())
                cols["loss_chars"].append(len(learnt))
                cols["loss_sha256"].append(hashlib.sha256(learnt.encode()).hexdigest())
                cols["formatted_chars"].append(len(text))
            yield pa.RecordBatch.from_arrays([b["conv_id"], *map(pa.array, cols.values())], names=["conv_id", *cols])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def op12_chat_format(spark, sf_dir):
    convs = conversations(table(spark, sf_dir, "conversations"))
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(1).select(F.lit(-1).cast("bigint").alias("conv_id"), F.array(*(
        F.struct(F.lit(k).cast("bigint").alias("turn"), F.lit(role).alias("role"), F.lit(said).alias("text"))
        for k, role in enumerate(("user", "assistant")))).alias("msgs"))
    return read_back(format_chats(convs.unionByName(probe)))


ORACLE_OP12 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x, CASE WHEN conv_id IS NULL THEN CAST(uuid() AS VARCHAR) END AS alone FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'planted' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'planted'),
p AS (SELECT '<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>|\[\\*ROLE\]|\[\\*/ROLE\]' AS controls)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
       CAST(coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(x) + len(regexp_extract_all(x, controls)) + CASE WHEN r IN ('system', 'user') THEN 18 WHEN r = 'assistant' THEN 6
            ELSE 22 + length(r) + len(regexp_extract_all(r, controls)) END) AS BIGINT) AS formatted_chars
FROM t, p GROUP BY conv_id, alone
"""
