"""Chat formatting with a black-box template: spans of turns are found from rendered prefixes.

The template is any function from a list of (role, text) to a string. The conversation is rendered
turn by turn; as long as each rendering begins with the one before, the new part is the turn's span.
A template that changes what it has written already (it rewrites history) is recognised by that, and
its conversations get no spans and no loss mask. Within a span the text is found by rendering the
turn once more with a marker in its place. The loss mask covers the texts of assistant turns.

``chat_markup`` is such a template: it marks turns and escapes control strings in roles and texts,
so that no text can open or close a turn and everything can be read back.

Defined results: rows are put in order by turn, then role, then text, nulls first; a null role or
text is an empty one, and equal rows are turns of their own. A null conv_id is a conversation. Extra
columns are ignored. An empty table gives an empty result. Rendering prefixes takes time with the
square of a conversation's length; a conversation is one row of the result and is held by one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillback.llm.frames import visible

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# The marks of a turn, and how control strings are escaped inside roles and texts.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
MARKER = "\ue000"
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def chat_markup(turns: list[Turn]) -> str:
    return "".join(f"{OPEN}{escaped(role).replace('\n', '\\\n')}\n{escaped(text)}{CLOSE}" for role, text in turns)


def header(span: str) -> tuple[str, str]:
    """Role and text of one turn of ``chat_markup``, read back."""
    inner = span[len(OPEN) : -len(CLOSE)]
    end = re.match(r"(?:[^\\\n]|\\.)*", inner, re.DOTALL).end()
    return unescaped(inner[:end]), unescaped(inner[end + 1 :])


@dataclass
class Formatted:
    """A rendered conversation with, per turn, its span and the place of its text; empty if history is rewritten."""

    output: str
    spans: list[tuple[int, int]] = field(default_factory=list)
    texts: list[tuple[int, int]] = field(default_factory=list)
    rewrites: bool = False


def formatted(turns: list[Turn], template: Template) -> Formatted:
    before, result = template([]), Formatted("")
    for k, (role, _) in enumerate(turns):
        after = template(turns[: k + 1])
        if not after.startswith(before):
            return Formatted(template(turns), rewrites=True)
        marker = MARKER
        while marker in after:
            marker += MARKER
        marked = template([*turns[:k], (role, marker)])
        place = marked.find(marker, len(before)) if marked.startswith(before) else -1
        if place < 0 or marked[:place] != after[:place]:
            return Formatted(template(turns), rewrites=True)
        tail = len(marked) - place - len(marker)
        result.spans.append((len(before), len(after)))
        result.texts.append((place, len(after) - tail))
        before = after
    result.output = before
    return result


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order."""
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce(F.col("role"), empty).alias("role"), F.coalesce(F.col("text"), empty).alias("text"))
    return visible(rows).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


SCHEMA = """conv_id bigint, output string, spans array<struct<start: bigint, end: bigint>>,
    loss array<struct<start: bigint, end: bigint>>, rewrites boolean"""
PLACE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def formatted_chats(rows: DataFrame, template: Template = chat_markup, *, trained_role: str = "assistant") -> DataFrame:
    """conv_id, output, spans of turns, loss mask and ``rewrites`` for every conversation (conv_id, turn, role, text)."""
    def places(found: list[tuple[int, int]]) -> list[dict]:
        return [{"start": a, "end": b} for a, b in found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for turns in batch.column("turns").to_pylist():
                own = [(turn["role"], turn["text"]) for turn in turns]
                result = formatted(own, template)
                loss = [place for place, (role, _) in zip(result.texts, own) if role == trained_role]
                made.append((result.output, places(result.spans), places(loss), result.rewrites))
            columns = list(zip(*made)) or [(), (), (), ()]
            yield pa.record_batch({
                "conv_id": batch.column("conv_id"), "output": pa.array(columns[0], pa.string()),
                "spans": pa.array(columns[1], PLACE), "loss": pa.array(columns[2], PLACE), "rewrites": pa.array(columns[3], pa.bool_()),
            })

    return conversations_of(rows).mapInArrow(run, SCHEMA)


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def chat_digest(chats: DataFrame) -> DataFrame:
    """What a reader of the outputs of ``chat_markup`` gets back: turns and the text under the loss mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {name: [] for name in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for output, spans, loss in zip(*(batch.column(name).to_pylist() for name in ("output", "spans", "loss"))):
                read = "".join("\n".join((*header(output[s["start"] : s["end"]]), "")) for s in spans)
                learned = "".join(unescaped(output[s["start"] : s["end"]]) for s in loss)
                rows["n_turns"].append(len(spans))
                rows["turns_sha256"].append(hashlib.sha256(read.encode()).hexdigest())
                rows["loss_chars"].append(len(learned))
                rows["loss_sha256"].append(hashlib.sha256(learned.encode()).hexdigest())
                rows["formatted_chars"].append(len(output))
            kinds = {"turns_sha256": pa.string(), "loss_sha256": pa.string()}
            yield pa.record_batch({"conv_id": batch.column("conv_id")} | {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()})

    return chats.select("conv_id", "output", "spans", "loss").mapInArrow(run, DIGESTS)
