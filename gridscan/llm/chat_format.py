"""Chat formatting over typed content parts.

A visitor flattens the parts of a turn into one string: text is escaped, and each image, audio clip or
document becomes a numbered placeholder, with its reference and the number of tokens it expands to
recorded in order. A turn reads ``<|role|>``, a line break, the flattened parts, ``<|end|>`` and a line
break. Control strings inside texts and roles are replaced by a backslash and a letter, and backslashes
are doubled, so that no text can forge a turn or a placeholder and everything can be read back.

Turns are sorted within partitions and streamed, so a long conversation needs no memory of its own; its
output is cut into parts of bounded length that hold whole turns.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import input_partitions

#: Control strings, each with the letter that stands for it after a backslash.
CONTROLS = {"<|": "a", "|>": "b", "</s>": "c", "<s>": "d", "[INST]": "e", "[/INST]": "f", "<<SYS>>": "g", "<</SYS>>": "h"}
_ESCAPE = {"\\": "\\\\", **{c: "\\" + k for c, k in CONTROLS.items()}}
_UNESCAPE = {v: k for k, v in _ESCAPE.items()}
_FIND = re.compile("|".join(map(re.escape, _ESCAPE)))
_BACK = re.compile(r"\\.", re.S)
_TURN = re.compile(r"<\|((?:[^<]|<(?!\|))*?)\|>\n((?:[^<]|<(?!\|end\|>))*)<\|end\|>\n")
#: Characters of formatted text after which a conversation's next turn opens a new part.
PART_CHARS = 1 << 20

IMAGE_PATCH = 28
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 256
#: Widths, seconds and numbers of pages from here on are no sizes.
MOST_SIZE = 1e9


def escape(text: str) -> str:
    return _FIND.sub(lambda m: _ESCAPE[m[0]], text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: _UNESCAPE[m[0]], text)


def whole_text(text: str) -> str:
    """text with lone surrogates, which no encoding can hold, replaced by U+FFFD."""
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


class Flatten:
    """Visitor over the typed parts of one conversation; attachments are numbered across its turns.

    Nothing raises. A part of unknown kind or one that is no object becomes escaped text, its own JSON, and counts as
    bad; so does text that is no JSON list where one is expected. Sizes that are missing count as one patch, second or
    page; sizes that are no positive numbers do too, and their part counts as bad.
    """

    def __init__(self) -> None:
        self.attachments: list[dict] = []
        self.first = self.bad = 0

    def taken(self) -> list[dict]:
        """The attachments since the last call; their numbers go on."""
        got, self.attachments = self.attachments, []
        self.first += len(got)
        return got

    def json(self, raw: str | None) -> str:
        """The flattened string of a JSON list of parts, or of a JSON string; null and empty give none."""
        if not raw:
            return ""
        try:
            parts = json.loads(raw)
        except (ValueError, RecursionError):
            parts = 0
        if parts is None or isinstance(parts, (str, list)):
            return self.parts(parts)
        self.bad += 1
        return escape(whole_text(raw))

    def parts(self, parts: list | str | None) -> str:
        """The flattened string of a list of parts; a plain string is one text part, null none."""
        if parts is None:
            return ""
        if isinstance(parts, str):
            return self.text({"text": parts})
        return "".join(self.part(p) for p in parts)

    def part(self, part) -> str:
        kind = part.get("type") if isinstance(part, dict) else None
        if kind in ("image", "audio", "document"):
            return getattr(self, kind)(part)
        if kind == "text" and isinstance(part.get("text", ""), (str, type(None))):
            return self.text(part)
        self.bad += 1
        return escape(whole_text(json.dumps(part, ensure_ascii=False)))

    def text(self, part: dict) -> str:
        return escape(whole_text(part.get("text") or ""))

    def image(self, part: dict) -> str:
        (across, down), bad = self._sizes(part, "width", "height")
        return self._attach("image", part, math.ceil(across / IMAGE_PATCH) * math.ceil(down / IMAGE_PATCH), bad)

    def audio(self, part: dict) -> str:
        (seconds,), bad = self._sizes(part, "seconds")
        return self._attach("audio", part, math.ceil(seconds * AUDIO_TOKENS_PER_SECOND), bad)

    def document(self, part: dict) -> str:
        (pages,), bad = self._sizes(part, "pages")
        return self._attach("document", part, math.ceil(pages) * DOCUMENT_TOKENS_PER_PAGE, bad)

    def _sizes(self, part: dict, *names: str) -> tuple[list[float], bool]:
        got = [part.get(n) for n in names]
        good = [type(v) in (int, float) and 0 < v < MOST_SIZE for v in got]
        return [v if ok else 1 for v, ok in zip(got, good)], any(v is not None and not ok for v, ok in zip(got, good))

    def _attach(self, kind: str, part: dict, tokens: int, bad: bool) -> str:
        n, ref = self.first + len(self.attachments), part.get("ref")
        known = ref is None or isinstance(ref, str)
        self.bad += bad or not known
        ref = whole_text(ref if known else json.dumps(ref, ensure_ascii=False)) if ref is not None else None
        self.attachments.append({"number": n, "kind": kind, "ref": ref, "tokens": tokens})
        return f"<|{kind}:{n}|>"


def format_turn(role: str | None, flat: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of its content)."""
    head = f"<|{escape(role or '')}|>\n"
    return f"{head}{flat}<|end|>\n", len(head), len(head) + len(flat)


def read_turns(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the escaped text) of each turn; placeholders stay in the text as they are."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("not a formatted conversation")
        out.append((unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    return out


_ATTACHMENT = pa.struct([("number", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_PARTS = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(_SPAN)), ("attachments", pa.list_(_ATTACHMENT)), ("expanded_tokens", pa.int64()), ("bad_parts", pa.int64())]
)
PARTS_DDL = (
    "conv_id long, part long, formatted string, loss_spans array<struct<start:long,end:long>>, "
    "attachments array<struct<number:long,kind:string,ref:string,tokens:long>>, expanded_tokens long, bad_parts long"
)


def format_conversations(turns: DataFrame, loss_role: str = "assistant", parts_json: bool = False, part_chars: int = PART_CHARS) -> DataFrame:
    """Conversations from rows (conv_id, turn, role, text): formatted parts in order, the spans under the loss mask, attachments.

    ``text`` is plain, or with ``parts_json`` a JSON list of typed parts; ``bad_parts`` counts those that are none (see ``Flatten``). Turns
    come in order of turn (null first), then role, then text; null roles and texts are empty; repeated rows are turns of their own; rows
    without a conv_id form one conversation; an empty table gives none. Spans count code points from the start of their part. Other columns are not read.
    """

    def run(batches):
        rows: list[dict] = []
        state = {"conv": object(), "part": 0, "chars": 0, "text": [], "spans": [], "flat": Flatten()}

        def close():
            if state["text"]:
                got = state["flat"].taken()
                bad, state["flat"].bad = state["flat"].bad, 0
                rows.append(
                    {"conv_id": state["conv"], "part": state["part"], "formatted": "".join(state["text"]), "loss_spans": state["spans"], "attachments": got, "expanded_tokens": sum(a["tokens"] for a in got), "bad_parts": bad}
                )
                state.update(part=state["part"] + 1, chars=0, text=[], spans=[])

        for b in batches:
            for conv, role, text in zip(*(b.column(c).to_pylist() for c in (0, 2, 3))):
                if conv != state["conv"]:
                    close()
                    state.update(conv=conv, part=0, flat=Flatten())
                flat = state["flat"].json(text) if parts_json else state["flat"].parts(text)
                whole, lo, hi = format_turn(role, flat)
                if role == loss_role:
                    state["spans"].append({"start": state["chars"] + lo, "end": state["chars"] + hi})
                state["text"].append(whole)
                state["chars"] += len(whole)
                if state["chars"] >= part_chars:
                    close()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)
                rows.clear()
        close()
        yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)

    narrow = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return narrow.repartition(input_partitions(turns), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, PARTS_DDL)


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted parts and loss spans alone.

    The parts of a conversation must follow each other in one partition, as they leave ``format_conversations``.
    """

    def run(batches):
        rows: list[dict] = []
        now, turns, loss, n, chars, whole = object(), hashlib.sha256(), hashlib.sha256(), 0, 0, 0

        def close():
            if n:
                rows.append({"conv_id": now, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": whole})

        for b in batches:
            for conv, text, spans in zip(*(b.column(c).to_pylist() for c in (0, 2, 3))):
                if conv != now:
                    close()
                    now, turns, loss, n, chars, whole = conv, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for role, said, _, _ in read_turns(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for s in spans:
                    under = unescape(text[s["start"] : s["end"]])
                    loss.update(under.encode())
                    chars += len(under)
                whole += len(text)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_DIGEST)
                rows.clear()
        close()
        yield pa.RecordBatch.from_pylist(rows, schema=_DIGEST)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
