"""Chat formatting of typed content parts: a visitor flattens them into text with placeholders."""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART = "kind string, text string, ref string, width int, height int, seconds double, pages int"
PARTS = f"array<struct<{PART}>>"
#: Tokens that a placeholder stands for: one for each image patch, audio second and document page.
PATCH, AUDIO_TOKENS, PAGE_TOKENS = 28, 25, 1024

_OPENS = re.compile(r"<(\\*)(n?)\|")
_OPENED = re.compile(r"<\\(\\*)(n?)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def escaped(text: str) -> str:
    r"""The text without ``<|`` and ``<n|``: one more backslash between each ``<`` and its ``|``."""
    return _OPENS.sub(r"<\\\1\2|", text)


def unescaped(text: str) -> str:
    return _OPENED.sub(r"<\1\2|", text)


def escaped_role(role: str) -> str:
    """As ``escaped``, on one line."""
    return escaped(role).replace("\n", "<n|")


def unescaped_role(role: str) -> str:
    return unescaped(role.replace("<n|", "\n"))


class Flattener:
    """Visits parts in order; ``pieces`` become the text, ``attachments`` say what the placeholders stand for."""

    def __init__(self):
        self.pieces: list[str] = []
        self.held: list[str] = []
        self.attachments: list[dict] = []
        self.length = self.tokens = 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part['kind'] or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        # neighbours are escaped together, so that no control string arises between them
        self.held.append(part["text"] or "")
        self.tokens += len((part["text"] or "").encode())

    def visit_image(self, part: dict) -> None:
        width, height = (max(part[side] or 0, 0) for side in ("width", "height"))
        self.place(part, max(1, math.ceil(width / PATCH) * math.ceil(height / PATCH)))

    def visit_audio(self, part: dict) -> None:
        self.place(part, max(1, math.ceil(max(part["seconds"] or 0.0, 0.0) * AUDIO_TOKENS)))

    def visit_document(self, part: dict) -> None:
        self.place(part, max(1, max(part["pages"] or 0, 0) * PAGE_TOKENS))

    def visit_other(self, part: dict) -> None:
        raise ValueError(f"unknown kind of content part: {part['kind']}")

    def place(self, part: dict, tokens: int) -> None:
        self.flush()
        mark = f"<|{part['kind']}|>"
        self.attachments.append({"kind": part["kind"], "ref": part["ref"], "at": self.length, "tokens": tokens})
        self.add(mark)
        self.tokens += tokens

    def flush(self) -> None:
        if self.held:
            self.add(escaped("".join(self.held)))
            self.held = []

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ATTACHED = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("formatted", pa.string()), ("loss", _SPANS), ("attachments", _ATTACHED), ("n_tokens", pa.int64())])


def format_turn(role: str | None, parts: list[dict] | None) -> dict:
    """One turn as text, with the spans (code points) that the loss covers, its attachments and its tokens."""
    opening = f"{START}{escaped_role(role or '')}\n"
    flat = Flattener()
    flat.length = len(opening)
    for part in parts or []:
        if part is not None:
            flat.visit(part)
    flat.flush()
    spans = []
    if role == "assistant":
        at = len(opening)
        marks = {a["at"] for a in flat.attachments}
        for piece in flat.pieces:
            if at not in marks and piece:
                spans.append({"start": at, "end": at + len(piece)})
            at += len(piece)
    text = opening + "".join(flat.pieces) + END + "\n"
    return {"formatted": text, "loss": spans, "attachments": flat.attachments, "n_tokens": flat.tokens}


def formatted(turns: DataFrame) -> DataFrame:
    r"""One row per turn (conv_id, turn, role, parts): conv_id, turn, formatted, loss, attachments, n_tokens.

    ``parts`` is an ``PARTS`` column; texts are kept as they are, images, audio and documents become a placeholder
    such as ``<|image|>`` and a row in ``attachments`` (kind, ref, at: code point of the placeholder, tokens it
    expands to). ``loss`` has the spans of an assistant's text, without placeholders. Control strings
    in texts and roles are escaped by a backslash after the ``<``; ``read_turns`` undoes it. ``n_tokens`` counts
    UTF-8 bytes of texts and expanded placeholders. Null roles and texts are empty, null parts are none. A turn is
    formatted where it lies; the conversation is its turns in order.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for conv_id, turn, role, parts in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append({"conv_id": conv_id, "turn": turn} | format_turn(role, parts))
            yield pa.RecordBatch.from_pylist(rows, _FORMATTED)

    chosen = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "parts")
    spans = "array<struct<start:long,end:long>>"
    attached = "array<struct<kind:string,ref:string,at:long,tokens:long>>"
    return chosen.mapInArrow(run, f"conv_id long, turn long, formatted string, loss {spans}, attachments {attached}, n_tokens long")


def text_turns(conversations: DataFrame) -> DataFrame:
    """Plain conversations (conv_id, turn, role, text) with each text as one part."""
    nothing = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(F.lit("text").alias("kind"), "text", *(F.lit(None).cast(k).alias(n) for n, k in nothing.items()))
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn in formatted text; placeholders stay as they are."""
    found = [(unescaped_role(role), unescaped(body)) for role, body in _TURN.findall(text)]
    if sum(map(len, (m[0] for m in _TURN.finditer(text)))) != len(text):
        raise ValueError("not formatted text")
    return found


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_attachments", pa.int64()), ("n_tokens", pa.int64())])


class Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss = conv_id, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_attachments = self.n_tokens = 0

    def add(self, text: str, spans: list[dict], n_attachments: int, n_tokens: int) -> None:
        self.n_attachments += n_attachments
        self.n_tokens += n_tokens
        for role, body in read_turns(text):
            self.turns.update(f"{role}\n{body}\n".encode())
            self.n_turns += 1
        for span in spans:
            trained = unescaped(text[span["start"] : span["end"]])
            self.loss.update(trained.encode())
            self.loss_chars += len(trained)
        self.chars += len(text)

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars, "n_attachments": self.n_attachments, "n_tokens": self.n_tokens}


def read_back(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``formatted`` turns: counts and digests of what its text and loss mask hold.

    Turns come by turn, those of one number by their text; a null turn is first, and a null conv_id is one
    conversation. A task reads its conversations in order and holds one turn at a time, however long they are.
    """

    def run(batches):
        now = None
        for batch in batches:
            done = []
            for conv_id, _, *turn in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv_id != now.conv_id:
                    done.extend([now.row()] if now else [])
                    now = Digest(conv_id)
                now.add(*turn)
            yield pa.RecordBatch.from_pylist(done, _DIGESTS)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], _DIGESTS)

    rows = turns.select("conv_id", "turn", "formatted", "loss", F.size("attachments").cast("long"), "n_tokens").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "turn", "formatted")
    counts = "loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, n_tokens long"
    return rows.mapInArrow(run, f"conv_id long, n_turns long, turns_sha256 string, {counts}")
