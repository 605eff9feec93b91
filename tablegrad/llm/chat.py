"""Chat formatting by schema fingerprints.

A record is a JSON object in any of several layouts (messages, prompt and completion, instruction and output, ...). Its
fingerprint is a hash of its sorted nested field paths (array positions left out, so it doesn't depend on the number
of turns). A table of declarative mappings, keyed by fingerprint, turns the record into canonical turns; a record whose
fingerprint no mapping has gets no turns and ``mapping`` null, so that new layouts can be counted and mapped.

The template writes a turn as ``### role:`` line feed, text, ``</turn>`` line feed. Inside roles and texts a backslash
stands before every backslash, ``###`` and ``</turn>`` (and ``:`` in roles), so no text can imitate a control string and
reading the output back gives exactly the same turns.

Conversations given turn by turn are formatted and digested as streams, so one of them may hold any share of the rows.

Defined results: null text or role counts as empty; rows without a conversation are one conversation; turns with equal numbers are ordered by role, then text, and
repeated rows stay repeated; an empty table gives no rows; columns besides the named ones are never read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column

END = "</turn>\n"


def paths(value: Any, prefix: str = "") -> set[str]:
    """Nested field paths; elements of arrays share ``[]``. Keys are escaped, so distinct layouts stay distinct."""
    if isinstance(value, dict):
        out = set()
        for k, v in value.items():
            out |= paths(v, f"{prefix}.{json.dumps(k)}")
        return out or {prefix + "{}"}
    if isinstance(value, list):
        out = set()
        for v in value:
            out |= paths(v, prefix + "[]")
        return out or {prefix + "[]"}
    return {prefix}


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


def _layout(*names: str) -> str:
    """The fingerprint of a layout written as dotted paths, such as ``messages[].role``."""
    quoted = [".".join(json.dumps(p.rstrip("[]")) + "[]" * p.endswith("[]") for p in n.split(".")) for n in names]
    return fingerprint({"." + q for q in quoted})


def _messages(key: str, role: str, text: str, **names: str) -> dict:
    return {"each": key, "role": role, "text": text, "names": names}


def _single(role: str, text: str) -> dict:
    """One turn a record; dotted paths, ``[]`` joins the elements of a list by blank lines."""
    return {"one": (role, text)}


def _fields(*pairs: tuple[str, tuple[str, ...]]) -> dict:
    return {"turns": pairs}


#: Layout fingerprint -> (name, mapping). ``each``: one turn for each element; ``turns``: fixed roles from fields,
#: joined by a blank line where several are named and not empty; a system turn without text is left out. ``one``: role and text.
MAPPINGS: dict[str, tuple[str, dict]] = {
    _layout("messages[].role", "messages[].content"): ("messages", _messages("messages", "role", "content")),
    _layout("messages[]"): ("messages", _messages("messages", "role", "content")),
    _layout("conversations[].from", "conversations[].value"): (
        "from_value", _messages("conversations", "from", "value", human="user", gpt="assistant")),
    _layout("prompt", "completion"): ("completion", _fields(("user", ("prompt",)), ("assistant", ("completion",)))),
    _layout("prompt", "response"): ("response", _fields(("user", ("prompt",)), ("assistant", ("response",)))),
    _layout("system", "prompt", "response"): ("system_response", _fields(
        ("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    _layout("instruction", "output"): ("instruction", _fields(("user", ("instruction",)), ("assistant", ("output",)))),
    _layout("instruction", "input", "output"): ("instruction_input", _fields(
        ("user", ("instruction", "input")), ("assistant", ("output",)))),
    _layout("question", "answer"): ("question", _fields(("user", ("question",)), ("assistant", ("answer",)))),
    _layout("role", "content"): ("turn", _single("role", "content")),
    _layout("author.role", "content.parts[]"): ("parts", _single("author.role", "content.parts[]")),
}


def _text(v: Any) -> str:
    return "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def _at(value: Any, path: str) -> str:
    for name in path.removesuffix("[]").split("."):
        value = value[name]
    return "\n\n".join(map(_text, value)) if path.endswith("[]") else _text(value)


def canonical(record: dict, mappings: dict[str, tuple[str, dict]] = MAPPINGS) -> tuple[str, str | None, list[tuple[str, str]]]:
    """(fingerprint, name of the mapping or None, turns as (role, text))."""
    print_ = fingerprint(paths(record))
    if print_ not in mappings:
        return print_, None, []
    name, m = mappings[print_]
    if "one" in m:
        return print_, name, [tuple(_at(record, p) for p in m["one"])]
    if "each" in m:
        names = m["names"]
        return print_, name, [(names.get(r := _text(x.get(m["role"])), r), _text(x.get(m["text"]))) for x in record[m["each"]]]
    turns = [(role, "\n\n".join(t for f in fields if (t := _text(record.get(f))))) for role, fields in m["turns"]]
    return print_, name, [(r, t) for r, t in turns if r != "system" or t]


_IN_TEXT = re.compile(r"\\|###|</turn>")
_IN_ROLE = re.compile(r"\\|###|</turn>|:|\n")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*):\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)


def escape(text: str) -> str:
    return _IN_TEXT.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], trained: frozenset[str] = frozenset({"assistant"})) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, loss mask as [start, end) code points: the escaped texts of the trained roles)."""
    out, at, mask = [], 0, []
    for role, text in turns:
        head = "### " + _IN_ROLE.sub(lambda m: "\\" + m[0], role) + ":\n"
        body = escape(text)
        if role in trained:
            mask.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), mask


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def format_records(records: DataFrame, id_col: str, json_col: str, mappings: dict[str, tuple[str, dict]] = MAPPINGS,
                   trained: frozenset[str] = frozenset({"assistant"})) -> DataFrame:
    """id, fingerprint, mapping, formatted (string) and loss_mask (array of start, end) of each JSON record."""
    kind = records.schema[id_col].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints, names, texts, masks = [], [], [], []
            for s in column(b, "_json").to_pylist():
                record = json.loads(s) if s else {}
                p, name, turns = canonical(record if isinstance(record, dict) else {"": record}, mappings)
                text, mask = render(turns, trained)
                prints.append(p)
                names.append(name)
                texts.append(text)
                masks.append([{"start": x, "end": y} for x, y in mask])
            yield pa.RecordBatch.from_arrays(
                [column(b, "_id"), pa.array(prints, pa.string()), pa.array(names, pa.string()), pa.array(texts, pa.string()),
                 pa.array(masks, spans)], ["_id", "fingerprint", "mapping", "formatted", "loss_mask"])

    out = records.select(F.col(id_col).alias("_id"), F.col(json_col).alias("_json")).mapInArrow(
        run, f"_id {kind}, fingerprint string, mapping string, formatted string, "
             "loss_mask array<struct<start:bigint,end:bigint>>")
    return out.withColumnRenamed("_id", id_col)


def records_from_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, record): rows (conv_id, turn, role, text) gathered into one JSON record of the messages layout each conversation,
    for conversations that fit a value; ``turn_records`` has no such bound."""
    x = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    gathered = x.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "content"))).alias("t"))
    only = F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return gathered.select("conv_id", F.to_json(F.struct(only.alias("messages"))).alias("record"))


def turn_records(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, content, record): one JSON record a turn, in one of four layouts by the hash of the conversation
    (from / value renames the usual roles, so it isn't used for roles of those names)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    x = turns.select("conv_id", "turn", role.alias("role"), text.alias("content"))
    r, t = F.col("role"), F.col("content")
    which = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    renamed = F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    nested = F.struct(F.struct(r.alias("role")).alias("author"), F.struct(F.array(t).alias("parts")).alias("content"))
    record = (F.when((which == 0) & ~r.isin("human", "gpt"), F.to_json(F.struct(F.array(F.struct(renamed.alias("from"), t.alias("value"))).alias("conversations"))))
              .when(which == 1, F.to_json(F.struct(r.alias("role"), t.alias("content")))).when(which == 2, F.to_json(nested))
              .otherwise(F.to_json(F.struct(F.array(F.struct(r.alias("role"), t.alias("content"))).alias("messages")))))
    return x.withColumn("record", record)


def format_turns(records: DataFrame, mappings: dict[str, tuple[str, dict]] = MAPPINGS, trained: frozenset[str] = frozenset({"assistant"})) -> DataFrame:
    """(conv_id, start, fingerprint, mapping, formatted, loss_mask) of each record, in the order of conversations, turn, role and content.

    The pieces of a conversation, one after another, are its formatted text; ``start`` is a piece's place there in code points, and its
    loss mask counts from its own beginning. One shuffle by conversation; a task holds one batch of records, however long a conversation.
    """
    kind = records.schema["conv_id"].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["conv_id", "start", "fingerprint", "mapping", "formatted", "loss_mask"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, begun = None, 0, False
        for b in batches:
            rows = []
            for conv, s in zip(column(b, "conv_id").to_pylist(), column(b, "record").to_pylist()):
                if not begun or conv != now:
                    now, at, begun = conv, 0, True
                record = json.loads(s) if s else {}
                print_, name, turns = canonical(record if isinstance(record, dict) else {"": record}, mappings)
                text, mask = render(turns, trained)
                rows.append((at, print_, name, text, [{"start": x, "end": y} for x, y in mask]))
                at += len(text)
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), spans]
            yield pa.RecordBatch.from_arrays([column(b, "conv_id"), *(pa.array(list(c), k) for c, k in zip(cols, kinds))], names)

    parts = records.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "content").select("conv_id", "record")
    return parts.mapInArrow(run, f"conv_id {kind}, start bigint, fingerprint string, mapping string, formatted string, "
                                 "loss_mask array<struct<start:bigint,end:bigint>>")


def digests(formatted: DataFrame) -> DataFrame:
    """The check columns of formatted conversations, read back from ``formatted`` and ``loss_mask`` alone. Pieces of one conversation
    stand together and in order, as ``format_turns`` gives them (or are whole conversations); digests run on from piece to piece."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_mappings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, id_type = None, None  # (id, turns, their digest, characters under the mask, their digest, characters, mappings)

        def done(rows: list[list]) -> pa.RecordBatch:
            rows = [[r[0], r[1], r[2].hexdigest(), r[3], r[4].hexdigest(), r[5], len(r[6])] for r in rows]
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

        for b in batches:
            ended, id_type = [], column(b, "conv_id").type
            cols = [column(b, c).to_pylist() for c in ("conv_id", "formatted", "loss_mask", "mapping")]
            for conv, text, mask, mapping in zip(*cols):
                if now is None or conv != now[0]:
                    if now is not None:
                        ended.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, set()]
                turns = read_back(text)
                loss = "".join(unescape(text[m["start"]:m["end"]]) for m in mask)
                now[1] += len(turns)
                now[2].update("".join(f"{r}\n{t}\n" for r, t in turns).encode())
                now[3] += len(loss)
                now[4].update(loss.encode())
                now[5] += len(text)
                now[6].add(mapping)
            if ended:
                yield done(ended)
        if now is not None:
            yield done([now])

    return formatted.select("conv_id", "formatted", "loss_mask", "mapping").mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_mappings bigint")
