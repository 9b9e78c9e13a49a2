"""Chat formatting: schema fingerprints select declarative mappings to canonical turns."""

from __future__ import annotations

import hashlib
import itertools
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hotrank.llm.common import pick, read, small, texts

#: Layouts by field paths. ``turns``: either ("each", list path, role field, text field), or one
#: ("turn", role, paths of the text's parts) per turn, where a role that starts with "." is a path.
#: Each set of paths made of ``required`` and any of ``optional`` has a fingerprint of its own.
LAYOUTS = (
    {"name": "row", "required": ("role", "text"), "optional": (),
     "turns": (("turn", ".role", ("text",)),)},
    {"name": "messages", "required": ("messages[].role", "messages[].content"),
     "optional": ("messages[].name",), "turns": (("each", "messages", "role", "content"),)},
    {"name": "conversations", "required": ("conversations[].from", "conversations[].value"),
     "optional": (), "turns": (("each", "conversations", "from", "value"),)},
    {"name": "instruction", "required": ("instruction", "output"), "optional": ("input", "system"),
     "turns": (("turn", "system", ("system",)), ("turn", "user", ("instruction", "input")),
               ("turn", "assistant", ("output",)))},
    {"name": "prompt-response", "required": ("prompt", "response"), "optional": ("system",),
     "turns": (("turn", "system", ("system",)), ("turn", "user", ("prompt",)),
               ("turn", "assistant", ("response",)))},
    {"name": "prompt-completion", "required": ("prompt", "completion"), "optional": ("system",),
     "turns": (("turn", "system", ("system",)), ("turn", "user", ("prompt",)),
               ("turn", "assistant", ("completion",)))},
    {"name": "nested", "required": ("prompt.text", "answer.text"), "optional": (),
     "turns": (("turn", "user", ("prompt.text",)), ("turn", "assistant", ("answer.text",)))},
)
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

#: Marks before and after a turn's text by role; other roles are written out.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"),
}
OTHER, OTHER_TEXT, OTHER_END = "[ROLE]", "[:]", "[/ROLE]"
_CONTROLS = [*itertools.chain(*MARKS.values()), OTHER, OTHER_TEXT, OTHER_END]
_SPECIAL = re.compile("|".join(map(re.escape, ["\\", *_CONTROLS])))
_TURN = re.compile(
    "|".join(
        f"{re.escape(a)}(?P<{role}>.*?){re.escape(b)}" for role, (a, b) in MARKS.items()
    ) + f"|{re.escape(OTHER)}(?P<role>.*?){re.escape(OTHER_TEXT)}(?P<other>.*?){re.escape(OTHER_END)}",
    re.S,
)


def escape(text: str) -> str:
    """Doubles backslashes and puts one behind the first character of each control string."""
    return _SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def paths(value, at: str = "") -> set[str]:
    """Nested field paths of a parsed record; ``[]`` stands for any element."""
    found: set[str] = set()
    todo = [(value, at)]
    while todo:
        value, at = todo.pop()
        if isinstance(value, dict) and value:
            todo.extend((v, f"{at}.{k}" if at else k) for k, v in value.items())
        elif isinstance(value, list) and value:
            todo.extend((v, f"{at}[]") for v in value)
        else:
            found.add(at)
    return found


def fingerprint(found: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:16]


def _catalog(layouts):
    known, used = {}, set()
    for layout in layouts:
        used.update(layout["required"], layout["optional"])
        for n in range(len(layout["optional"]) + 1):
            for extra in itertools.combinations(layout["optional"], n):
                known[fingerprint({*layout["required"], *extra})] = layout
    return known, used


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _text(value) -> str:
    if isinstance(value, str):
        return value
    return "" if value is None else json.dumps(value, ensure_ascii=False)


def turns(record, layout) -> list[tuple[str, str]]:
    made = []
    for kind, *rule in layout["turns"]:
        if kind == "each":
            made += [
                (_text(_at(x, rule[1])), _text(_at(x, rule[2]))) for x in _at(record, rule[0])
            ]
        else:
            role = _text(_at(record, rule[0][1:])) if rule[0][:1] == "." else rule[0]
            parts = [_text(_at(record, p)) for p in rule[1]]
            if rule[0] != "system" or parts[0]:
                made.append((role, "\n\n".join(parts if len(parts) == 1 else filter(None, parts))))
    return [(ROLES.get(role, role), text) for role, text in made]


def canonical_turns(
    records: DataFrame, key_cols: tuple[str, ...], record_col: str = "record", layouts=LAYOUTS
) -> DataFrame:
    """``keys, pos, role, text, layout``: the turns of JSON records of different layouts.

    The paths of a record are hashed and the fingerprint selects the mapping; a fingerprint not
    known is taken again without the paths that no layout names. Records of no known layout,
    null, empty or broken ones give one row with null ``pos`` and the reason in ``layout``
    (``unknown:`` and the fingerprint, or ``broken``). Null texts and roles are empty. Key
    columns may be of any type Arrow carries.
    """
    rows = pick(records, **{k: k for k in key_cols}, record=record_col)
    out = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in key_cols)

    def run(batches):
        known, used = _catalog(layouts)
        for batch in small(batches):
            of, made = [], []
            for i, raw in enumerate(texts(batch.column("record"))):
                try:
                    record = json.loads(raw)
                except (ValueError, RecursionError):
                    of.append(i)
                    made.append((None, None, None, "broken"))
                    continue
                found = paths(record)
                layout = known.get(fingerprint(found)) or known.get(fingerprint(found & used))
                each = turns(record, layout) if layout else []
                of += [i] * max(1, len(each))
                made += [(n, *turn, layout["name"]) for n, turn in enumerate(each)] or [
                    (None, None, None, layout["name"] if layout else f"unknown:{fingerprint(found)}")
                ]
            columns = [pa.array(c, t) for c, t in zip(
                zip(*made), (pa.int32(), pa.string(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(pa.array(of)) for k in key_cols] + columns,
                names=[*key_cols, "pos", "role", "text", "layout"],
            )

    return rows.mapInArrow(run, f"{out}, pos int, role string, text string, layout string")


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where in it the text under the loss mask starts and ends."""
    body = escape(text)
    if role in MARKS:
        begin, end = MARKS[role]
    else:
        begin, end = f"{OTHER}{escape(role)}{OTHER_TEXT}", OTHER_END
    learnt = len(begin) if role == "assistant" else 0
    return begin + body + end, learnt, learnt + len(body) if learnt else 0


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from formatted turns."""
    found = []
    for m in _TURN.finditer(formatted):
        role, group = (m["role"], "other") if m["role"] is not None else (m.lastgroup, m.lastgroup)
        found.append((unescape(role), unescape(m[group])))
    return found


def format_turns(turns: DataFrame, key_cols: tuple[str, ...]) -> DataFrame:
    """Adds ``formatted, loss_start, loss_end`` (code points) to canonical turns.

    A conversation's text is its turns' ``formatted`` one after another. Turns without ``pos``
    are left out.
    """
    rows = turns.where("pos is not null")
    out = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in (*key_cols, "pos"))

    def run(batches):
        for batch in small(batches):
            made = [
                format_turn(role or "", text or "")
                for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())
            ]
            columns = [pa.array([x[i] for x in made], t) for i, t in enumerate(
                (pa.string(), pa.int32(), pa.int32()))]
            names = [*key_cols, "pos"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in names] + columns,
                names=[*names, "formatted", "loss_start", "loss_end"],
            )

    return rows.mapInArrow(run, f"{out}, formatted string, loss_start int, loss_end int")


class _Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, formatted: str, start: int, end: int) -> None:
        for role, text in read_turns(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        learnt = unescape(formatted[start:end])
        self.loss.update(learnt.encode())
        self.loss_chars += len(learnt)
        self.formatted_chars += len(formatted)

    def row(self, key):
        return (key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
                self.formatted_chars)


def _read_back(batches):
    """Rows come sorted by conversation; its state goes on from batch to batch."""
    key, state = None, None
    for batch in small(batches):
        rows = []
        for k, *turn in zip(*(batch.column(c).to_pylist()
                              for c in ("conv_id", "formatted", "loss_start", "loss_end"))):
            if state is None or k != key:
                if state is not None:
                    rows.append(state.row(key))
                key, state = k, _Digest()
            state.add(*turn)
        yield _batch(rows)
    if state is not None:
        yield _batch([state.row(key)])


def _batch(rows):
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names
    )


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Digests of conversations (conv_id, turn, pos, formatted, ...), read back from the output.

    A conversation may have any number of turns: they are sorted on disk and pass one by one;
    only hash states are held. The chain of one conversation's hash is sequential by its meaning.
    Equal turn numbers follow in order of their text; null ids are a conversation of their own.
    """
    order = ["conv_id", "turn", "pos", "formatted"]
    return (
        formatted.repartition("conv_id").sortWithinPartitions(*order)
        .mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, "
                    "loss_chars long, loss_sha256 string, formatted_chars long")
    )


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and -1, whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    rows = pick(read(spark, folder, "conversations"), conv_id="conv_id", turn="turn", role="role",
                text="text").unionByName(extra)
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    records = rows.select("conv_id", "turn", record.alias("record"))
    keys = ("conv_id", "turn")
    return chat_digests(format_turns(canonical_turns(records, keys), keys))
