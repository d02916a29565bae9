"""Chat formatting with typed content parts.

A message is a role and a list of parts (text, image, audio, document). A visitor flattens the parts into one body in
their order: text is escaped, any other part becomes a placeholder, its reference is recorded and its expanded tokens
are counted. The template marks turns with control strings. Inside texts and roles every ``<`` + backslashes + ``|``
gets one backslash more, which takes control strings and placeholders out of texts and is undone exactly.

A turn is formatted by itself, so a conversation of any length is a run of rows, never one value.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("image", "audio", "document")
# Tokens that one unit of an attachment is expanded to; a part's own ``tokens`` takes precedence.
TOKENS = {"image": 256, "audio": 128, "document": 512}
PART = "struct<kind:string,text:string,ref:string,tokens:bigint>"
FORMATTED = ("conv_id bigint, turn bigint, formatted string, loss_start bigint, loss_end bigint, "
             "attachments array<struct<at:bigint,kind:string,ref:string,tokens:bigint>>, expanded_tokens bigint")

_TO_ESCAPE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_PLACEHOLDER = re.compile(r"<\|(image|audio|document):(\d+)\|>")


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Flattener:
    """Visits the parts of one message in order; ``body`` is the text so far."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.attachments: list[tuple[int, str, str | None, int]] = []
        self.length = 0

    def visit(self, part) -> None:
        kind = part["kind"] or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def visit_text(self, part) -> None:
        self._add(escape(part["text"] or ""))

    def visit_image(self, part) -> None:
        self._attach(part)

    visit_audio = visit_document = visit_image

    def visit_unknown(self, part) -> None:
        raise ValueError(f"a part of kind {part['kind']!r}; known are text and {', '.join(KINDS)}")

    def _attach(self, part) -> None:
        tokens = part["tokens"] if part["tokens"] is not None else TOKENS[part["kind"]]
        self.attachments.append((self.length, part["kind"], part["ref"], int(tokens)))
        self._add(f"<|{part['kind']}:{len(self.attachments) - 1}|>")

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    @property
    def body(self) -> str:
        return "".join(self.pieces)


def format_turn(role: str | None, parts: Iterable, learned_role: str = "assistant"):
    """(formatted text, loss start, loss end, attachments, expanded tokens); the span is empty for other roles."""
    role = role or ""
    flat = Flattener()
    for part in parts if parts is not None else ():
        if part is not None:
            flat.visit(part)
    head = f"{START}{_escape_role(role)}\n"
    text = f"{head}{flat.body}{END}\n"
    span = (len(head), len(head) + flat.length) if role == learned_role else (len(head), len(head))
    attached = [{"at": len(head) + at, "kind": k, "ref": r, "tokens": n} for at, k, r, n in flat.attachments]
    return text, *span, attached, sum(a["tokens"] for a in attached)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and body (unescaped, placeholders kept) of one formatted turn."""
    if not formatted.startswith(START) or not formatted.endswith(f"{END}\n"):
        raise ValueError("not a formatted turn")
    role, _, body = formatted[len(START):-len(END) - 1].partition("\n")
    return _unescape_role(role), unescape(body)


def read_parts(formatted: str, attachments) -> list[dict]:
    """The parts that a turn was made of; neighbouring texts come back as one, empty ones not at all."""
    body = formatted[len(START):-len(END) - 1].partition("\n")[2]
    parts, at = [], 0
    for found in _PLACEHOLDER.finditer(body):
        if found.start() > at:
            parts.append({"kind": "text", "text": unescape(body[at:found.start()]), "ref": None, "tokens": None})
        own = attachments[int(found[2])]
        parts.append({"kind": found[1], "text": None, "ref": own["ref"], "tokens": own["tokens"]})
        at = found.end()
    if at < len(body):
        parts.append({"kind": "text", "text": unescape(body[at:]), "ref": None, "tokens": None})
    return parts


def format_conversations(turns: DataFrame) -> DataFrame:
    """One formatted row per turn of ``turns`` (conv_id, turn, role, parts), in no order; a conversation's text is its
    rows by turn, put together.

    Null role, null parts, null part and null text count as empty. Repeated rows are repeated turns. Columns besides
    the four are not looked at.
    """
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [format_turn(role, parts) for role, parts in zip(batch["role"], batch["parts"])]
            yield pd.DataFrame({
                "conv_id": batch["conv_id"], "turn": batch["turn"], "formatted": [m[0] for m in made],
                "loss_start": [m[1] for m in made], "loss_end": [m[2] for m in made],
                "attachments": [m[3] for m in made], "expanded_tokens": [m[4] for m in made]})

    needed = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "parts")
    return needed.mapInPandas(rows, FORMATTED)


DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from its formatted turns (by turn, then formatted text; nulls first).

    Conversations stream through their tasks row by row; no conversation is held as a whole.
    """
    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, done = None, None, []

        def close():
            if state is not None:
                done.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, missing, text, start, end in zip(batch["conv_id"], batch["missing"], batch["formatted"],
                                                       batch["loss_start"], batch["loss_end"]):
                key = None if missing else int(conv)
                if state is None or key != current:
                    close()
                    current, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = read_turn(text)
                learned = unescape(text[start:end])
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(text)
            if done:
                yield pd.DataFrame(done, columns=_NAMES).astype({"conv_id": "Int64"})
                done = []
        close()
        yield pd.DataFrame(done, columns=_NAMES).astype({"conv_id": "Int64"})

    runs = (
        formatted.select(F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("missing"),
                         "turn", "formatted", "loss_start", "loss_end")
        .repartition("conv_id", "missing").sortWithinPartitions("conv_id", "missing", "turn", "formatted")
    )
    return runs.mapInPandas(digests, DIGESTS)


_NAMES = [part.split()[0] for part in DIGESTS.split(", ")]
