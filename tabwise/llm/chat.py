"""Chat formatting: where each turn stands is found by rendering, not by knowing the template.

A template is a function from turns to text. Rendering the first 1, 2, 3, ...
turns and comparing each output with the one before shows what every turn added.
If an output doesn't begin with the one before it, the template rewrites history,
and the turn that made it do so is reported. Rendering a turn with an empty text,
and just its opening, shows which part of its span is the text: that of assistant
turns is the loss mask. Where history was rewritten, every text is looked for again
in the final output, by rendering all turns with a mark in place of that text.

All prefixes are rendered, a number of renderings that grows with the turns and
output that grows with their square. A template whose author declares it
``prefix_stable`` (an attribute of the function) is rendered from the turn before
only, and the parts must add up to the whole output.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwise.llm.common import table

Turn = tuple[str, str]
#: render(turns, opening): ``opening`` adds the beginning of a turn of that role.
Template = Callable[[list[Turn], str | None], str]

#: Stands in for a text: private-use characters, one that the conversation doesn't hold.
_MARKS = "\ue000\ue001\uf8ff"
ASSISTANT = "assistant"

_CONTROL = re.compile(r"\\|###|</turn>")
_CONTROL_IN_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\(?:\\|###|</turn>|:))*):\n((?:[^\\]|\\(?:\\|###|</turn>))*?)\n</turn>\n", re.S)


def escape(text: str) -> str:
    """Put a backslash before every control string and backslash."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked_turns(turns: list[Turn], opening: str | None = None) -> str:
    """The template of this package: ``### role:``, the escaped text, ``</turn>``."""
    start = lambda role: f"### {_CONTROL_IN_ROLE.sub(lambda m: chr(92) + m.group(), role)}:\n"
    out = "".join(f"{start(role)}{escape(text)}\n</turn>\n" for role, text in turns)
    return out if opening is None else out + start(opening)


marked_turns.prefix_stable = True


def read_back(formatted: str) -> list[Turn]:
    """The turns of an output of ``marked_turns``."""
    return [(unescape(m.group(1)), unescape(m.group(2))) for m in _TURN.finditer(formatted)]


@dataclass
class Rendered:
    text: str
    #: Per turn: start and end of its span, and of the text within; None where the
    #: template leaves no place that can be told to be this turn's.
    spans: list[tuple[int, int, int, int] | None]
    #: Turns whose addition changed what was already there.
    rewrites: list[int]


def _around(before: list[Turn], turn: Turn, base: str, render: Template) -> tuple[str, str]:
    """What a template puts before and behind the text of a turn."""
    opened, empty = render(before, turn[0]), render([*before, (turn[0], "")], None)
    opening = opened[len(base):] if opened.startswith(base) else ""
    if empty.startswith(base + opening):
        return opening, empty[len(base + opening):]
    return opening, empty[empty.rfind(opening) + len(opening):] if opening in empty else ""


def _again(turns: list[Turn], j: int, whole: str, around: tuple[str, str], render: Template) -> tuple[int, int, int, int] | None:
    """The span of turn j in the whole output: rendered with a mark for its text, all else has to be the same."""
    mark = next((m for m in _MARKS if m not in whole), None)
    marked = "" if mark is None else render([*turns[:j], (turns[j][0], mark), *turns[j + 1:]], None)
    if mark is None or marked.count(mark) != 1:
        return None
    head, tail = marked.split(mark)
    if len(head) + len(tail) > len(whole) or not (whole.startswith(head) and whole.endswith(tail)):
        return None
    low, high = len(head), len(whole) - len(tail)
    opening, closing = around
    start = low - len(opening) if head.endswith(opening) else low
    return start, high + len(closing) if tail.startswith(closing) else high, low, high


def locate(turns: list[Turn], render: Template = marked_turns) -> Rendered:
    """Render, and find each turn's span by comparing the outputs of successive prefixes."""
    whole, stable = render(turns, None), getattr(render, "prefix_stable", False)
    spans, around, rewrites, at, base = [], [], [], 0, render([], None)
    for i, turn in enumerate(turns):
        before = turns[max(0, i - 1):i] if stable else turns[:i]
        if stable:
            base = render(before, None)
        grown = render([*before, turn], None)
        opening, closing = _around(before, turn, base, render)
        around.append((opening, closing))
        if grown.startswith(base):
            added = grown[len(base):]
            fits = added.startswith(opening) and added.endswith(closing) and len(opening) + len(closing) <= len(added)
            low, high = (len(opening), len(added) - len(closing)) if fits else (0, len(added))
            at = at or len(base)
            spans.append((at, at + len(added), at + low, at + high))
            at += len(added)
        else:
            rewrites.append(i)
            spans.append(None)
        base = grown
    if rewrites or at != len(whole):
        if stable and not rewrites:
            rewrites = [len(turns) - 1]  # declared stable, but the parts are not the whole
        spans = [_again(turns, j, whole, around[j], render) for j in range(len(turns))]
    return Rendered(whole, spans, rewrites)


def _format(render: Template):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 200):
                part = pdf.iloc[at : at + 200]
                rows = []
                for key, roles, texts in zip(part["conv_id"], part["roles"], part["texts"]):
                    found = locate(list(zip(roles, texts)), render)
                    masked = [s[2:] for role, s in zip(roles, found.spans) if role == ASSISTANT and s]
                    rows.append((key, found.text, [s and s[:2] for s in found.spans], masked, found.rewrites))
                out = pd.DataFrame(rows, columns=["conv_id", "formatted", "turn_spans", "loss_spans", "rewrites"])
                out["conv_id"] = out["conv_id"].astype("Int64")
                yield out

    return run


def format_conversations(conversations: DataFrame, render: Template = marked_turns) -> DataFrame:
    """conv_id, formatted, turn_spans, loss_spans (code points), rewrites (numbers of turns).

    One row per conversation; rows of a null conv_id are one conversation. Turns
    go by ``turn`` (null first), ties by role, then text; repeated rows are
    repeated turns. Null roles and texts are empty. A conversation is one output
    string, so it has to fit into a value. A turn whose place the template leaves open
    has a null in ``turn_spans`` and no loss span. An empty table gives an empty result.
    """
    turns = F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))))
    grouped = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(turns.alias("turns")).select(
        "conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    span = "array<struct<start:long,end:long>>"
    return grouped.mapInPandas(_format(render), f"conv_id long, formatted string, turn_spans {span}, "
                                                f"loss_spans {span}, rewrites array<long>")


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
    for pdf in batches:
        rows = []
        for key, text, spans, rewrites in zip(pdf["conv_id"], pdf["formatted"], pdf["loss_spans"], pdf["rewrites"]):
            turns = read_back(text)
            loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
            rows.append((key, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                         len(text), len(rewrites)))
        out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                          "formatted_chars", "n_rewrites"])
        out["conv_id"] = out["conv_id"].astype("Int64")
        yield out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return format_conversations(turns).mapInPandas(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                  "formatted_chars long, n_rewrites long")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(role) + len(regexp_extract_all(role, '\\|###|</turn>|:')) + 2
                + length(text) + len(regexp_extract_all(text, '\\|###|</turn>')) + 9) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_rewrites
FROM c GROUP BY conv_id
"""
