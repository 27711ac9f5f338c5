"""Chat formatting by schema fingerprints.

Conversations come in many layouts: one row a turn, lists of messages,
instruction and output, prompt and response.  The nested field paths of a
record (``messages[].role``) are sorted and hashed; the hash selects a
declarative ``Layout``, which says where roles and texts are.  Typed tables
have one fingerprint, that of their schema, and become columns expressions;
JSON records are fingerprinted one by one.  A record with further fields takes
the first layout of which it has most paths; one with none has no turns.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside
texts and roles a backslash is put into ``<|`` (and one more into ``<\\|`` and so
on), so no control string can occur there and removing one gives the text back;
line breaks and backslashes of a role are spelt ``\\n`` and ``\\\\``.  The loss mask
holds the text of every assistant turn.

A conversation is formatted as one row a turn, with its place in the
conversation, so that one of any length is never held whole: rows are dealt by
conversation, sorted by turn and streamed.

Edge cases: a null text or role is empty; a null conversation id is one
conversation of its own; turns of one number are ordered by role and text, and
repeated rows stay repeated; an empty table has no rows; other columns of the
input are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


# ---------------------------------------------------------------- layouts

@dataclass(frozen=True)
class Turn:
    """One turn, or one for each element of the array ``each``: its role and its text paths, joined by a blank line."""

    text: tuple[str, ...]
    role: str | None = None
    role_path: str | None = None
    each: str | None = None
    optional: bool = False       # left out where its text is empty


@dataclass(frozen=True)
class Layout:
    name: str
    turns: tuple[Turn, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)   # names of roles that the layout spells otherwise
    row_paths: tuple[str, ...] = ()                       # conversation, turn, role, text of a layout of one row a turn

    def paths(self) -> frozenset[str]:
        out = set(self.row_paths)
        for t in self.turns:
            prefix = f"{t.each}[]." if t.each else ""
            out.update(prefix + p for p in (*t.text, *([t.role_path] if t.role_path else [])))
        return frozenset(out)


LAYOUTS = (
    Layout("turn rows", row_paths=("conv_id", "turn", "role", "text")),
    Layout("messages", (Turn(("content",), role_path="role", each="messages"),)),
    Layout("from and value", (Turn(("value",), role_path="from", each="conversations"),),
           {"human": "user", "gpt": "assistant"}),
    Layout("instruction", (Turn(("instruction", "input"), role="user"), Turn(("output",), role="assistant"))),
    Layout("bare instruction", (Turn(("instruction",), role="user"), Turn(("output",), role="assistant"))),
    Layout("system prompt", (Turn(("system",), role="system", optional=True), Turn(("prompt",), role="user"),
                             Turn(("response",), role="assistant"))),
    Layout("prompt and response", (Turn(("prompt",), role="user"), Turn(("response",), role="assistant"))),
    Layout("prompt and completion", (Turn(("prompt",), role="user"), Turn(("completion",), role="assistant"))),
    Layout("question and answer", (Turn(("question",), role="user"), Turn(("answer",), role="assistant"))),
)


def fingerprint(paths: Iterable[str]) -> str:
    """The hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def select_layout(paths: frozenset[str], layouts: Sequence[Layout] = LAYOUTS) -> Layout | None:
    """The layout of this fingerprint; else the first of those wholly contained that has most paths; else None."""
    by_print = {fingerprint(x.paths()): x for x in reversed(layouts)}
    if (hit := by_print.get(fingerprint(paths))) is not None:
        return hit
    inside = [x for x in layouts if x.paths() <= paths]
    return max(inside, key=lambda x: len(x.paths()), default=None)


def schema_paths(kind: T.DataType, at: str = "") -> set[str]:
    if isinstance(kind, T.StructType):
        return set().union(*[schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return {at}


def value_paths(value, at: str = "") -> set[str]:
    """The same of a parsed JSON value; an empty list or object has no fields."""
    if isinstance(value, dict):
        return set().union(*[value_paths(v, f"{at}.{k}" if at else k) for k, v in value.items()])
    if isinstance(value, list):
        return set().union(*[value_paths(v, f"{at}[]") for v in value])
    return {at}


# ---------------------------------------------------------------- canonical turns

TURNS = "conv_id bigint, turn bigint, role string, text string"


def canonical_turns(table: DataFrame, id_col: str = "conv_id", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, turn, role, text of a typed table; its schema's fingerprint selects the layout.

    Layouts of whole records take the conversation's id from ``id_col``.
    """
    layout = select_layout(frozenset(schema_paths(table.schema)), layouts)
    if layout is None:
        raise ValueError(f"no layout for the field paths {sorted(schema_paths(table.schema))}")

    def named(role: Column) -> Column:
        for old, new in layout.roles.items():
            role = F.when(role == old, new).otherwise(role)
        return F.coalesce(role.cast("string"), F.lit(""))

    if layout.row_paths:
        conv, turn, role, text = layout.row_paths
        return table.select(F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                            named(F.col(role)).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def one(t: Turn, get) -> Column:
        role = F.lit(t.role) if t.role else named(get(t.role_path))
        texts = [F.nullif(get(p).cast("string"), F.lit("")) for p in t.text]
        return F.struct(role.alias("role"), F.concat_ws("\n\n", *texts).alias("text"), F.lit(t.optional).alias("optional"))

    def several(t: Turn) -> Column:
        none = F.array().cast("array<struct<role:string,text:string,optional:boolean>>")
        return F.coalesce(F.transform(F.col(t.each), lambda e: one(t, lambda p: e[p])), none)

    parts = [several(t) if t.each else F.array(one(t, F.col)) for t in layout.turns]
    turns = F.filter(F.concat(*parts), lambda t: ~t["optional"] | (t["text"] != ""))
    return (table.select(F.col(id_col).cast("bigint").alias("conv_id"), F.posexplode(turns).alias("turn", "t"))
            .select("conv_id", F.col("turn").cast("bigint").alias("turn"), "t.role", "t.text"))


def _at(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _spelt(value) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def record_turns(record, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of one parsed record of whole-record layout."""
    out = []
    for t in layout.turns:
        for e in (_at(record, t.each) or []) if t.each else [record]:
            role = t.role or _spelt(_at(e, t.role_path))
            text = "\n\n".join(x for x in (_spelt(_at(e, p)) for p in t.text) if x)
            if text or not t.optional:
                out.append((layout.roles.get(role, role), text))
    return out


def canonical_json(records: DataFrame, id_col: str = "conv_id", json_col: str = "record",
                   layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, turn, role, text of JSON records, each of its own layout.

    Records that are null, no JSON object or of no layout have no turns; ``layout_report`` counts them.
    """
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: dict[frozenset, Layout | None] = {}  # one entry a layout that a task meets, up to a bound
        for batch in batches:
            rows: list[tuple] = []
            if len(chosen) > 10_000:
                chosen.clear()
            for conv, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                record = _parsed(text)
                paths = frozenset(value_paths(record)) if isinstance(record, dict) else frozenset()
                if paths not in chosen:
                    chosen[paths] = select_layout(paths, layouts)
                layout = chosen[paths]
                if layout is None:
                    continue
                if layout.row_paths:
                    c, n, role, said = (_at(record, p) for p in layout.row_paths)
                    rows.append((c, n, layout.roles.get(_spelt(role), _spelt(role)), _spelt(said)))
                else:
                    rows += [(conv, i, r, s) for i, (r, s) in enumerate(record_turns(record, layout))]
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["conv_id", "turn", "role", "text"])

    rows = records.select(F.col(id_col).cast("bigint").alias("conv_id"), F.col(json_col).cast("string").alias("record"))
    return rows.mapInArrow(convert, TURNS)


def _parsed(text: str | None):
    try:
        return json.loads(text) if text is not None else None
    except ValueError:
        return None


def layout_report(records: DataFrame, json_col: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """fingerprint, layout (null for none), n_records of JSON records."""
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                record = _parsed(text)
                paths = frozenset(value_paths(record)) if isinstance(record, dict) else None
                layout = None if paths is None else select_layout(paths, layouts)
                found.append((None if paths is None else fingerprint(paths), layout.name if layout else None))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)],
                                             ["fingerprint", "layout"])

    rows = records.select(F.col(json_col).cast("string").alias("record"))
    return (rows.mapInArrow(prints, "fingerprint string, layout string")
            .groupBy("fingerprint", "layout").agg(F.count(F.lit(1)).alias("n_records")))


# ---------------------------------------------------------------- the template

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "|" in text else text


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin and end of the text as written) of whole turns in the template."""
    out, at = [], 0
    while at < len(formatted):
        head = formatted.find("\n", at)
        stop = formatted.find(END + "\n", head + 1)
        if not formatted.startswith(START, at) or head < 0 or stop < 0:
            raise ValueError(f"no whole turn at character {at}")
        out.append((_role_in(formatted[at + len(START):head]), unescape(formatted[head + 1:stop]), head + 1, stop))
        at = stop + len(END) + 1
    return out


FORMATTED = "conv_id bigint, seq bigint, begin bigint, formatted string, loss_begin bigint, loss_end bigint"
ROWS = 1000  # of an output batch


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, seq, begin = object(), 0, 0
    for whole in batches:
        for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
            out: list[tuple] = []
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if c != conv:
                    conv, seq, begin = c, 0, 0
                head = f"{START}{_role_out(role)}\n"
                body = escape(text)
                turn = f"{head}{body}{END}\n"
                loss = (begin + len(head), begin + len(head) + len(body)) if role == LOSS_ROLE else (None, None)
                out.append((c, seq, begin, turn, *loss))
                seq, begin = seq + 1, begin + len(turn)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            names = ["conv_id", "seq", "begin", "formatted", "loss_begin", "loss_end"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def format_turns(turns: DataFrame) -> DataFrame:
    """The conversations in the template, one row a turn: conv_id, seq, begin, formatted, loss_begin, loss_end.

    ``begin`` and the loss mask's bounds count code points of the whole formatted conversation, which is its
    rows in the order of ``seq``.  One shuffle; the rows of a conversation come in order in one partition.
    """
    rows = (turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text"))
    return rows.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED)


DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
          "formatted_chars bigint")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, started = None, None, False

    def fresh():
        return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

    def row(done):
        return [(c, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]) for c, s in done]

    def packed(rows):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for whole in batches:
        for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
            done = []
            for c, begin, text, low, high in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if not started or c != conv:
                    if started:
                        done.append((conv, state))
                    conv, state, started = c, fresh(), True
                for role, said, _, _ in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if low is not None:
                    learned = unescape(text[low - begin:high - begin])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            if done:
                yield packed(row(done))
    if started:
        yield packed(row([(conv, state)]))


def read_back(formatted: DataFrame, stored: bool = True) -> DataFrame:
    """One row a conversation, from its formatted text and loss mask: counts and digests of what they hold.

    ``stored=False`` is for the result of ``format_turns`` itself, whose rows are in order already.
    """
    rows = formatted.select("conv_id", "seq", "begin", "formatted", "loss_begin", "loss_end")
    if stored:
        rows = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "seq")
    return rows.drop("seq").mapInArrow(_read, DIGEST)


#: The same in DuckDB, for the table of one row a turn.
CHAT_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'
)
select conv_id::bigint as conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(length('<|im_start|>') + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
           + length('<|im_end|>') + 2)::bigint as formatted_chars
from turns group by conv_id
"""
