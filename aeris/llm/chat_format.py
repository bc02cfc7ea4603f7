"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context, the reply as target, and only
the reply's characters trainable. Turns after the last reply make one more record without a target, so that the
records of a conversation hold all its turns. A turn is written as

    ### role<newline>text</turn><newline>

and the control strings ``### `` and ``</turn>``, the backslash and (in roles) the newline are escaped with a
backslash, which ``parse`` undoes.

A conversation of ordinary length is dealt to one task and all its examples are written whole. The expansion of a long
one (``long_chars`` characters or ``long_turns`` turns) would grow with the square of its length, so it is cut into
blocks of turns, in ranges over many tasks: an example then carries the context of its own block, and the blocks before
it, each of which one record holds whole, are context by reference (``context_chars``). A task holds one block.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from aeris.llm.common import map_rows, stored, table

OPEN, CLOSE = "### ", "</turn>"
TARGET_ROLE = "assistant"
_IN_TEXT = re.compile(r"\\|### |</turn>")
_IN_ROLE = re.compile(r"\\|### |</turn>|\n")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\\n])*+)\n((?:\\.|(?!</turn>)[^\\])*+)</turn>\n", re.DOTALL)
#: Characters of examples that a task gathers before it hands them on.
_FLUSH = 1 << 22
#: A conversation with more characters or turns is cut into blocks of at most so many turns, and of so many characters
#: where a turn is not longer by itself.
LONG_CHARS, LONG_TURNS = 1 << 20, 1024
#: Characters of role and text by which the ranges of long conversations are told; turns that agree in them, and in
#: conv_id and turn, meet in one task, which reads them one by one.
_RANGE_CHARS = 64


def escape(text: str | None) -> str:
    return _IN_TEXT.sub(lambda m: "\\" + m[0], text or "")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def header(role: str | None) -> str:
    return OPEN + _IN_ROLE.sub(lambda m: "\\" + m[0], role or "") + "\n"


def examples_of(turns: list[tuple[str | None, str | None]]) -> Iterator[tuple[int, str, int, int]]:
    """(target turn's place or -1, formatted text, start and end of the trainable characters)."""
    done: list[str] = []
    replied = 0
    for place, (role, text) in enumerate(turns):
        head, body = header(role), escape(text)
        if role == TARGET_ROLE:
            context = "".join(done)
            done = [context]  # joined once, so that each example costs one copy of its context
            start = len(context) + len(head)
            yield place, f"{context}{head}{body}{CLOSE}\n", start, start + len(body)
            replied = place + 1
        done.append(f"{head}{body}{CLOSE}\n")
    if replied < len(turns):
        yield -1, "".join(done), 0, 0


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted text; fails on text that the format can't have made."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def _expand_sorted(dealt: DataFrame, long_chars: int | None, long_turns: int | None) -> DataFrame:
    """Examples of the blocks that a task meets, one after the other; without limits a block is a whole conversation.
    Blocks are numbered by task and place, so in the order of the rows where the tasks hold ranges."""
    kind = dealt.schema["conv_id"].dataType
    schema = (f"conv_id {kind.simpleString()}, block long, place int, formatted string, loss_start long, loss_end long, whole boolean")
    types = [to_arrow_type(kind), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
    names = ["conv_id", "block", "place", "formatted", "loss_start", "loss_end", "whole"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks_of():
            now, turns, chars = None, [], 0
            for batch in batches:
                ids, roles, texts = (batch.column(n) for n in ("conv_id", "role", "text"))
                for i in range(batch.num_rows):
                    key, turn = (ids[i].as_py(),), (roles[i].as_py(), texts[i].as_py())
                    size = len(turn[0] or "") + len(turn[1] or "")
                    full = long_turns and (len(turns) >= long_turns or chars + size > long_chars)
                    if turns and (key != now or full):
                        yield now[0], turns
                        turns, chars = [], 0
                    now = key
                    turns.append(turn)
                    chars += size
            if turns:
                yield now[0], turns

        rows, size = [], 0
        first = TaskContext.get().partitionId() << 32 if long_turns else 0
        for n, (conv, turns) in enumerate(blocks_of()):
            for example in examples_of(turns):
                rows.append((conv, first + n if long_turns else 0, *example, example[0] in (-1, len(turns) - 1)))
                size += len(example[1])
                if size >= _FLUSH or len(rows) >= 4096:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return dealt.mapInArrow(run, schema)


def _same_conversation(left: DataFrame, right: DataFrame) -> Column:
    return left["conv_id"].eqNullSafe(right["conv_id"])


def expand(conversations: DataFrame, long_chars: int = LONG_CHARS, long_turns: int = LONG_TURNS) -> DataFrame:
    """(conv_id, block, place, formatted, loss_start, loss_end, whole, context_chars, last, parted) of every example and
    of each block's rest (place -1). The trainable characters are formatted[loss_start:loss_end], place is the turn's in
    its block, and whole marks the record with all turns of its block.

    An ordinary conversation is one block: parted is false, context_chars 0, and formatted the whole example. A long one
    is parted: the context_chars characters before ``formatted`` are the whole records of the conversation's earlier
    blocks, joined in order; a rest counts as a record of its own only in the last block.

    ``conversations`` has conv_id, turn, role, text; other columns are ignored. Turns are ordered by turn (nulls
    first), ties by role and text; repeated rows are repeated turns. Null roles and texts count as empty; a null
    conv_id is one conversation. Empty tables give empty tables."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    chars = F.sum(F.coalesce(F.length("role"), F.lit(0)) + F.coalesce(F.length("text"), F.lit(0)))
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("turns"), chars.alias("chars"))
    long_ones = stored(sizes.where((F.col("turns") > long_turns) | (F.col("chars") > long_chars)).select("conv_id"), "long_conversations")
    short = (rows.join(long_ones, _same_conversation(rows, long_ones), "left_anti").repartition("conv_id")
             .sortWithinPartitions("conv_id", "turn", "role", "text"))
    short = _expand_sorted(short, None, None).withColumns({"context_chars": F.lit(0).cast("long"), "last": F.lit(True), "parted": F.lit(False)})

    order = ["conv_id", "turn", "role", "text"]
    long_rows = (rows.join(long_ones, _same_conversation(rows, long_ones), "left_semi")
                 .repartitionByRange("conv_id", "turn", *[F.substring(c, 1, _RANGE_CHARS) for c in ("role", "text")])
                 .sortWithinPartitions(*order))
    parts = stored(_expand_sorted(long_rows, long_chars, long_turns), "long_examples")
    blocks = parts.where("whole").select("conv_id", "block", F.length("formatted").alias("chars"))
    by_block = Window.partitionBy("conv_id").orderBy("block")
    before = F.coalesce(F.sum("chars").over(by_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    blocks = blocks.select(F.col("block").alias("_block"), before.alias("context_chars"),
                           F.lead("block").over(by_block).isNull().alias("last"))
    # a block's number is its own in the whole table
    parts = parts.join(blocks, parts["block"] == blocks["_block"]).drop("_block").withColumn("parted", F.lit(True))
    return short.unionByName(parts)


def _stream_digests(blocks: DataFrame, kind: str) -> DataFrame:
    """Digests over the blocks of each conversation, in order; a task holds one block, however long the conversation. A
    digest is a chain, so its blocks can only be read one after the other."""
    fields = ["n_turns", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row_of(key, turns, loss, n_loss, sums):
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], conv_type), pa.array([sums[0]], pa.int64()), pa.array([turns.hexdigest()]), pa.array([n_loss], pa.int64()),
                 pa.array([loss.hexdigest()]), pa.array([sums[1]], pa.int64())],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        now = None
        for batch in batches:
            columns = {n: batch.column(n) for n in ("conv_id", "turns_text", "loss", *fields)}
            for i in range(batch.num_rows):
                key = (columns["conv_id"][i].as_py(),)
                if key != now:
                    if now:
                        yield row_of(now, turns, loss, n_loss, sums)
                    now, turns, loss, n_loss, sums = key, hashlib.sha256(), hashlib.sha256(), 0, [0, 0]
                said = columns["loss"][i].as_py()
                turns.update(columns["turns_text"][i].as_py().encode())
                loss.update(said.encode())
                n_loss += len(said)
                sums = [s + columns[f][i].as_py() for s, f in zip(sums, fields)]
        if now:
            yield row_of(now, turns, loss, n_loss, sums)

    conv_type = to_arrow_type(blocks.schema["conv_id"].dataType)
    return (blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block")
            .mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples alone: n_turns and turns_sha256 of the records that hold every turn,
    loss_chars and loss_sha256 of all trainable text unescaped and in order, formatted_chars over its records with the
    context they refer to. The examples are parsed where they are made; of conversations in one block only what is
    trainable is shuffled, of the others every turn once."""
    kind = examples.schema["conv_id"].dataType.simpleString()

    def run(c):
        turns = [parse(t) if whole else None for t, whole in zip(c["formatted"], c["whole"])]
        texts = [None if t is None else "".join(f"{r}\n{x}\n" for r, x in t) for t in turns]
        return {
            "conv_id": c["conv_id"], "block": c["block"], "place": c["place"], "parted": c["parted"],
            "n_turns": [None if t is None else len(t) for t in turns],
            "turns_sha256": [None if t is None else hashlib.sha256(t.encode()).hexdigest() for t in texts],
            "turns_text": [t if parted else None for t, parted in zip(texts, c["parted"])],
            "loss": [unescape(t[a:b]) for t, a, b in zip(c["formatted"], c["loss_start"], c["loss_end"])],
            "formatted_chars": [before + len(t) if place >= 0 or last else 0
                                for t, before, place, last in zip(c["formatted"], c["context_chars"], c["place"], c["last"])],
        }

    def blocks_of(part: DataFrame, *more: Column) -> DataFrame:
        read = map_rows(part, run, f"conv_id {kind}, block long, place int, parted boolean, n_turns long, turns_sha256 string, "
                        "turns_text string, loss string, formatted_chars long", slice_rows=16)
        loss = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("place") >= 0, F.struct("place", "loss")))),
                                        lambda x: x["loss"]), "")
        return read.groupBy("conv_id", "block").agg(F.max("n_turns").alias("n_turns"), loss.alias("loss"),
                                                    F.sum("formatted_chars").alias("formatted_chars"), *more)

    whole = blocks_of(examples.where("not parted"), F.max("turns_sha256").alias("turns_sha256")).select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
    parted = blocks_of(examples.where("parted"), F.max("turns_text").alias("turns_text"))
    return whole.union(_stream_digests(parted, kind))


#: The conversation that the query adds (fixed value): a user's and an assistant's turn with control strings.
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(expand(rows.union(spark.createDataFrame(PLANTED, rows.schema))))
