"""Chat formatting: records of many layouts become canonical turns by the fingerprint of their field paths."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from xxhash import xxh64_intdigest


@dataclass(frozen=True)
class Layout:
    """A declarative mapping. ``fields``: JSON paths that must be there, ``optional``: that may be. Either ``turns`` is an
    array with ``role`` and ``text`` inside, or ``fixed`` gives a role for each of some text fields, or the record is a turn."""

    name: str
    fields: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    turn: str | None = None


LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), turns="messages", role="role", text="content"),
    Layout("conversations", ("conversations[].from", "conversations[].value"), ("system",), turns="conversations", role="from", text="value"),
    Layout("prompt_completion", ("completion", "prompt"), ("system",), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", ("prompt", "response"), ("system",), fixed=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question_answer", ("answer", "question"), ("context",), fixed=(("user", ("context", "question")), ("assistant", ("answer",)))),
    Layout("instruction", ("instruction", "output"), ("input", "system"), fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("turn_rows", ("role", "text", "turn"), role="role", text="text", turn="turn"),
)
# Names of roles that other layouts use.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}

# The seed of Spark's own hash, so that fingerprints taken on either side are equal.
SEED = 42
_TURNS = "array<struct<turn: bigint, role: string, text: string>>"
_TYPES = r"VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|STRING|BINARY|DATE|TIMESTAMP(?:_NTZ)?|DECIMAL\(\d+,\s*\d+\)|VARIANT"


def _shape(fields: tuple[str, ...]) -> str:
    """The paths as the nested form in which a record's schema is written, without types."""
    nested: dict[str, set[str]] = {}
    for path in fields:
        top, _, inner = path.partition("[].")
        nested.setdefault(top, set()).update([inner] if inner else [])
    return "OBJECT<" + ", ".join(f"{k}: ARRAY<OBJECT<{', '.join(sorted(v))}>>" if v else k for k, v in sorted(nested.items())) + ">"


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant; values and their scalar types do not matter."""
    return F.xxhash64(F.regexp_replace(F.schema_of_variant(record), rf": (?:{_TYPES})(?=[,>])", ""))


def _shapes(layout: Layout) -> list[str]:
    out = [layout.fields]
    for extra in layout.optional:
        out += [(*f, extra) for f in out]
    return [_shape(f) for f in out]


def _numbered(given: Column, layout: Layout) -> Column:
    return F.transform(given, lambda t, i: F.struct(i.cast("bigint").alias("turn"), t[layout.role].alias("role"), t[layout.text].alias("text")))


def canonical_turns(records: DataFrame, key: str, payload: str) -> DataFrame:
    """(_id, layout, turn, role, text) from one JSON record per row.

    A record whose field paths fit no layout, or that is null or not JSON, gives one row with a null layout, so nothing
    is lost unseen. A null role or text is empty. Absent or null fixed fields and empty arrays give no turn.
    """
    parsed = records.select(F.col(f"`{key}`").alias("_id"), F.try_parse_json(F.col(f"`{payload}`")).alias("_record")).withColumn("_print", fingerprint(F.col("_record")))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURNS)
    for layout in LAYOUTS:
        fits = F.col("_print").isin([F.xxhash64(F.lit(s)) for s in _shapes(layout)])
        made = _turns(layout, lambda path, kind: F.try_variant_get("_record", f"$.{path}", kind), layout.optional)
        name, turns = F.when(fits, layout.name).otherwise(name), F.when(fits, made).otherwise(turns)
    return _named(parsed.select("_id", name.alias("layout"), turns.alias("_turns")))


def canonical_table(table: DataFrame, key: str) -> DataFrame:
    """The same from a table with typed columns beside ``key``: all its rows have the paths of its schema.

    Raises if no layout has them.
    """
    paths = []
    for f in table.drop(key).schema:
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else None
        paths += [f"{f.name}[].{g.name}" for g in inner] if isinstance(inner, T.StructType) else [f.name]
    prints = {xxh64_intdigest(s, seed=SEED): layout for layout in LAYOUTS for s in _shapes(layout)}
    layout = prints.get(xxh64_intdigest(_shape(tuple(paths)), seed=SEED))
    if layout is None:
        raise ValueError(f"no layout has the fields {sorted(paths)}")
    there = tuple(p for p in layout.optional if p in paths)

    def get(path: str, kind: str) -> Column:
        plain = F.col(f"`{path}`") if path in table.columns else F.lit(None)
        return plain if kind.startswith("array") else plain.cast(kind)

    return _named(table.select(F.col(f"`{key}`").alias("_id"), F.lit(layout.name).alias("layout"), _turns(layout, get, there).alias("_turns")))


def _turns(layout: Layout, get: Callable[[str, str], Column], optional: tuple[str, ...]) -> Column:
    """The turns of one record by a layout; ``get`` reads a path as a type."""
    turn = lambda i, role, text: F.struct(i.cast("bigint").alias("turn"), role.cast("string").alias("role"), text.cast("string").alias("text"))
    if layout.turns:
        made = _numbered(get(layout.turns, f"array<struct<{layout.role}: string, {layout.text}: string>>"), layout)
        if "system" in optional:
            system = get("system", "string")
            made = F.concat(F.when(system.isNotNull(), F.array(turn(F.lit(-1), F.lit("system"), system))).otherwise(F.array().cast(_TURNS)), made.cast(_TURNS))
    elif layout.fixed:
        every = []
        for i, (role, fields) in enumerate(layout.fixed):
            parts = [get(f, "string") for f in fields]
            text = F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), "\n\n")
            every.append(turn(F.lit(i), F.when(F.coalesce(*parts).isNotNull(), F.lit(role)), text))
        made = F.filter(F.array(*every), lambda t: t["role"].isNotNull())
    else:
        made = F.array(turn(get(layout.turn, "bigint"), get(layout.role, "string"), get(layout.text, "string")))
    return made.cast(_TURNS)


def _named(held: DataFrame) -> DataFrame:
    """One row per turn with the roles' own names; a record without a layout is one row."""
    known = held.filter("layout IS NOT NULL").select("_id", "layout", F.explode("_turns").alias("_t")).select("_id", "layout", "_t.*")
    role = F.coalesce("role", F.lit(""))
    for other, own in ROLE_NAMES.items():
        role = F.when(F.col("layout").isin("conversations", "messages") & (F.col("role") == other), own).otherwise(role)
    lost = held.filter("layout IS NULL").select("_id", "layout", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"))
    return known.select("_id", "layout", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text")).unionByName(lost)


OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates, none of which may come out of a text.
CONTROLS = [OPEN, CLOSE, "<|endoftext|>", "<|im_sep|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL = "|".join(re.escape(c) for c in CONTROLS)


def escape(text: Column) -> Column:
    """Backslashes doubled, then one put after the first character of every control string."""
    java = "|".join(rf"\Q{c[0]}\E(?=\Q{c[1:]}\E)" for c in CONTROLS)
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), f"({java})", r"$1\\")


def unescape(text: str) -> str:
    """The exact inverse: a doubled backslash is one, a single one is none."""
    return re.sub(r"\\(\\?)", r"\1", text)


def format_turns(turns: DataFrame) -> DataFrame:
    """``turns`` with ``formatted`` (one line break after each marker) and the span of it under the loss mask.

    A conversation's text is the formatted turns one after another. loss_start and loss_length are code points within
    ``formatted`` and cover the escaped text of an assistant's turn; for other roles the length is zero.
    """
    role = F.regexp_replace(F.regexp_replace(escape(F.col("role")), "%", "%25"), "\n", "%0A")
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    body = escape(F.col("text"))
    loss = F.when(F.col("role") == "assistant", F.length(body)).otherwise(0)
    return turns.withColumn("formatted", F.concat(head, body, F.lit(CLOSE + "\n"))).withColumn("loss_start", F.length(head)).withColumn("loss_length", loss)


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    role, _, rest = formatted[len(OPEN) :].partition("\n")
    return unescape(role.replace("%0A", "\n").replace("%25", "%")), unescape(rest[: -len(CLOSE) - 1])


DIGEST_DDL = "n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, formatted_chars BIGINT"


def read_back(formatted: DataFrame) -> DataFrame:
    """_id and digests of what the formatted turns say, a row per conversation.

    Turns are sorted within partitions and hashed as they stream by: a conversation of any length needs no memory.
    One digest runs over a whole conversation in order, so that much of it is sequential by nature.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun = None, False
        n = loss_chars = chars = 0
        said, learned = hashlib.sha256(), hashlib.sha256()
        done: list[tuple] = []
        names = ["_id", *[x.split()[0] for x in DIGEST_DDL.split(", ")]]

        def out(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*done)) or [[] for _ in names]
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        kind = None
        for batch in batches:
            kind, done = batch.column(0).type, []
            for one, turn, start, length in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if begun and one != now:
                    done.append((now, n, said.hexdigest(), loss_chars, learned.hexdigest(), chars))
                    n = loss_chars = chars = 0
                    said, learned = hashlib.sha256(), hashlib.sha256()
                now, begun = one, True
                role, text = parse_turn(turn)
                said.update(f"{role}\n{text}\n".encode())
                loss = unescape(turn[start : start + length])
                learned.update(loss.encode())
                n, loss_chars, chars = n + 1, loss_chars + len(loss), chars + len(turn)
            yield out(kind)
        if begun:
            done = [(now, n, said.hexdigest(), loss_chars, learned.hexdigest(), chars)]
            yield out(kind)

    kind = formatted.schema["_id"].dataType.simpleString()
    ordered = formatted.repartition("_id").sortWithinPartitions("_id", "turn", "role", "text")
    return ordered.select("_id", "formatted", "loss_start", "loss_length").mapInArrow(run, f"_id {kind}, {DIGEST_DDL}")


def conversation_digests(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Digests per conversation of a table with a row per turn, formatted and read back.

    Turns go by number (null first), then role, then text, so ties and repeated rows have one order; all of them count.
    Null roles and texts are empty; rows without a key are one conversation; other columns are ignored; an empty table
    gives an empty result.
    """
    plain = rows.select(F.col(key).alias("_key"), F.col(turn).cast("bigint").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    return read_back(format_turns(canonical_table(plain, "_key"))).withColumnRenamed("_id", key)
