"""Conversations as token sequences with loss masks aligned to character offsets."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Characters of conversations encoded at a time (one conversation at least).
CHUNK = 200_000


@dataclass(frozen=True)
class ChatTemplate:
    """Each turn is ``open``, its role, ``middle``, its text, ``close``.

    Markers must begin with ``<|`` and end with ``|>`` (white space may follow). Inside
    roles and texts, one backslash more is put between a ``<``, any backslashes and a
    ``|``, so no text can hold a marker, and taking one out again gives the text back."""

    open: str = "<|turn|>"
    middle: str = "<|says|>"
    close: str = "<|over|>\n"

    def __post_init__(self):
        for marker in (self.open, self.middle, self.close):
            if not re.fullmatch(r"<\|[^<>|\\]+\|>\s*", marker):
                raise ValueError(f"{marker!r} could not be kept out of texts")

    @staticmethod
    def escape(text: str) -> str:
        return re.sub(r"<(\\*)\|", r"<\1\\|", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"<(\\*)\\\|", r"<\1|", text)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The conversation, and where in it the text of each turn stands."""
        parts, spans, at = [], [], 0
        for role, text in turns:
            head = self.open + self.escape(role) + self.middle
            body = self.escape(text)
            spans.append((at + len(head), at + len(head) + len(body)))
            parts += [head, body, self.close]
            at = spans[-1][1] + len(self.close)
        return "".join(parts), spans

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a rendered conversation."""
        turns, at = [], 0
        while at < len(formatted):
            if not formatted.startswith(self.open, at):
                raise ValueError(f"no turn begins at {at}")
            middle = formatted.index(self.middle, at)
            close = formatted.index(self.close, middle)
            role = formatted[at + len(self.open) : middle]
            turns.append((self.unescape(role), self.unescape(formatted[middle + len(self.middle) : close])))
            at = close + len(self.close)
        return turns


def overlap(token_start: np.ndarray, token_end: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(token, from, to)`` of every stretch that a token and a span share.

    Both are sorted and spans are disjoint, so the spans that a token meets are found by
    two binary searches: the first that ends after its start, the last that starts
    before its end. A token over a span's edge gives the part inside."""
    first = np.searchsorted(spans[:, 1], token_start, "right")
    last = np.searchsorted(spans[:, 0], token_end, "left")
    n = np.maximum(last - first, 0)
    token = np.repeat(np.arange(len(token_start)), n)
    span = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.maximum(token_start[token], spans[span, 0])
    end = np.minimum(token_end[token], spans[span, 1])
    some = begin < end
    return token[some], begin[some], end[some]


_FORMATTED = (
    "n_turns long, formatted string, ids array<int>, token_start array<int>, token_end array<int>, "
    "loss_token array<int>, loss_start array<int>, loss_end array<int>"
)


def _formatter(file: str, template: ChatTemplate, learned: frozenset[str]):
    names = [n.split() for n in _FORMATTED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}

    def formatted(tokenizer, ids: list, conversations: list[list[dict]], like: pa.DataType) -> pa.RecordBatch:
        out: dict[str, list] = {n: [] for n, _ in names}
        spans = []
        for turns in conversations:
            text, at = template.render([(t["role"] or "", t["text"] or "") for t in turns])
            out["formatted"].append(text)
            out["n_turns"].append(len(turns))
            spans.append([s for s, t in zip(at, turns) if (t["role"] or "") in learned and s[0] < s[1]])
        for own, e in zip(spans, tokenizer.encode_batch(out["formatted"], add_special_tokens=False)):
            at = np.array(e.offsets, np.int64).reshape(-1, 2)
            token, begin, end = overlap(at[:, 0], at[:, 1], np.array(own, np.int64).reshape(-1, 2))
            out["ids"].append(np.array(e.ids, np.int32))
            for name, values in (
                ("token_start", at[:, 0]),
                ("token_end", at[:, 1]),
                ("loss_token", token),
                ("loss_start", begin),
                ("loss_end", end),
            ):
                out[name].append(values.astype(np.int32))
        columns = [pa.array(ids, like), *(pa.array(out[n], kinds[k]) for n, k in names)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", *out])

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(file)
        tokenizer.encode_special_tokens = True  # a special token's string in a text is text
        for batch in batches:
            key, turns = batch.column(0), batch.column(1)
            ids, found, size = [], [], 0
            for i in range(batch.num_rows):
                ids.append(key[i].as_py())
                found.append(turns[i].as_py())
                size += sum(len(t["text"] or "") for t in found[-1])
                if size >= CHUNK:
                    yield formatted(tokenizer, ids, found, key.type)
                    ids, found, size = [], [], 0
            if found:
                yield formatted(tokenizer, ids, found, key.type)

    return form


def format_conversations(
    turns: DataFrame,
    file: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: ChatTemplate = ChatTemplate(),
    learned: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted``, the token ids ``ids`` with the
    code points ``token_start`` to ``token_end`` of each, and the loss mask: the tokens
    ``loss_token`` count, for the code points ``loss_start`` to ``loss_end`` of theirs.

    A conversation is rendered whole and encoded once. Turns are in order of ``turn`` (NULL
    first), then role, then text, so ties and repeated rows have one order and all
    stay. A NULL role or text is empty; empty texts of learned roles add nothing to
    the mask. A row with a NULL id is a conversation of its own. Bytes that are
    no UTF-8 become U+FFFD. Other columns are not looked
    at; no rows, no rows. The rows of one conversation meet in one task, as it is one
    sequence; what conversations have in common plays no part."""
    said = [F.make_valid_utf8(F.col(c)).alias(n) for c, n in ((role, "role"), (text, "text"))]
    turn_of = F.struct(F.col(turn).alias("turn"), *said)
    alone = F.when(F.col(conv_id).isNull(), F.monotonically_increasing_id())
    whole = turns.groupBy(F.col(conv_id).alias("conv_id"), alone.alias("alone"))
    whole = whole.agg(F.sort_array(F.collect_list(turn_of)).alias("turns")).drop("alone")
    kind = turns.schema[conv_id].dataType.simpleString()
    form = _formatter(file, template, frozenset(learned))
    return whole.mapInArrow(form, f"conv_id {kind}, {_FORMATTED}")


def masked_texts(formatted: str, begin: np.ndarray, end: np.ndarray, template: ChatTemplate) -> list[str]:
    """What the mask covers, unescaped, a text for each stretch without a gap."""
    if not len(begin):
        return []
    # A character of several tokens is covered by each of them.
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    stops = np.concatenate([reach[:-1][new[1:]], reach[-1:]])
    return [template.unescape(formatted[b:e]) for b, e in zip(begin[new].tolist(), stops.tolist())]


def digests(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """What is read back from formatted conversations: ``conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars``."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {n.split()[0]: [] for n in schema.split(", ")[1:]}
            for i in range(batch.num_rows):
                text, begin, end = (batch.column(n)[i] for n in ("formatted", "loss_start", "loss_end"))
                text = text.as_py()
                turns = template.parse(text)
                loss = "".join(masked_texts(text, *(x.values.to_numpy() for x in (begin, end)), template))
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(hashlib.sha256(said.encode()).hexdigest())
                out["loss_chars"].append(len(loss))
                out["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
                out["formatted_chars"].append(len(text))
            kinds = {"long": pa.int64(), "string": pa.string()}
            columns = [pa.array(out[n], kinds[k]) for n, k in (x.split() for x in schema.split(", ")[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], ["conv_id", *out])

    return formatted.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(read, schema)
