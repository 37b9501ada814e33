"""Chat formatting by token-level assembly.

Every turn is put together from segments that are encoded one by one: a reserved id that opens the turn, the ordinary
ids of its escaped text, and a reserved id that closes it. Ordinary encoding never gives a reserved id, so no text can
forge a mark in the ids; control strings inside texts are escaped as well, so none can in the rendered string either.
Where a segment lies in its conversation, and which ids the loss counts, follow from running sums of segment lengths.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenlake.llm.bpe import encode_text, encoding
from greenlake.llm.common import map_batches, written

# Fixed values of the template: the mark that opens and the mark that closes a turn of each role.
START = "<s>"
ROLES = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "</s>")}
#: A turn of any other role names it: opening mark, role, mark, text, closing mark.
OTHER = ("[ROLE]", "[SAYS]", "[END]")
CONTROLS = (START, *(m for pair in ROLES.values() for m in pair), *OTHER)

_TAILS = {c: "|".join(re.escape(m[1:]) for m in CONTROLS if m[0] == c) for c in "<["}
_FORGED = re.compile("|".join(rf"{re.escape(c)}\\*(?={t})" for c, t in _TAILS.items()))
_ESCAPED = re.compile("|".join(rf"{re.escape(c)}\\+(?={t})" for c, t in _TAILS.items()))


def escape(text: str) -> str:
    r"""Put one more ``\`` after the first character of every control string, and of every one that is escaped already."""
    return _FORGED.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][:-1], text)


def segments(role: str | None, text: str | None, first: bool) -> list[tuple[str, bool, bool]]:
    """(string, whether it is a mark, whether the loss counts it) of one turn; the loss counts assistants' texts and their closing marks."""
    open_, close = ROLES.get(role, OTHER[::2])
    learned = role == "assistant"
    named = [] if role in ROLES else [(escape(role or ""), False, False), (OTHER[1], True, False)]
    return [(START, True, False)] * first + [(open_, True, False), *named, (escape(text or ""), False, learned), (close, True, learned)]


def assemble(parts: list[tuple[str, bool, bool]], encode, reserved: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the segments in a row, and the loss mask from running sums of their lengths."""
    ids = [[reserved[s]] if mark else encode(s) for s, mark, _ in parts]
    ends = np.cumsum([len(x) for x in ids])
    turns = np.zeros(ends[-1] + 1, np.int8)  # +1 where the loss begins to count, -1 where it stops
    learned = np.array([0] + [p[2] for p in parts] + [0], np.int8)
    np.add.at(turns, np.concatenate([[0], ends]), np.diff(learned))
    return np.concatenate([np.asarray(x, np.int32) for x in ids]), np.cumsum(turns[:-1]).astype(np.int8)


def read_turn(ids: list[int], mask: list[int], decode, marks: dict[int, str]) -> tuple[str, str, str, int]:
    """Role, text, text under the loss mask and rendered code points of one formatted turn, from its ids alone."""
    cuts = [i for i, t in enumerate(ids) if t in marks]
    opened = {pair[0]: role for role, pair in ROLES.items()}
    texts, rendered = [], 0
    for a, b in zip(cuts, [*cuts[1:], len(ids)]):
        said = decode(ids[a + 1 : b]) if b > a + 1 else ""
        rendered += len(marks[ids[a]]) + len(said)
        texts.append((marks[ids[a]], unescape(said)))
    if texts[0][0] == START:
        del texts[0]
    role = opened[texts[0][0]] if texts[0][0] in opened else texts.pop(0)[1]
    counted = [t for t, m in zip(ids, mask) if m and t not in marks]
    return role, texts[0][1], unescape(decode(counted)) if counted else "", rendered


def _vocabulary(spark, rank_file: str, pattern: str):
    """(maker of encode, decode, reserved ids) for the tasks; the marks take the ids after the vocabulary's."""
    with open(rank_file, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())  # one vocabulary's ranks

    def load():
        enc = encoding(sent.value, pattern)
        top = enc.n_vocab
        return lambda s: encode_text(s, enc), lambda ids: enc.decode_bytes(ids).decode("utf-8", "replace"), {m: top + i for i, m in enumerate(CONTROLS)}

    return load


def format_conversations(rows: DataFrame, rank_file: str, pattern: str, parts: int | None = None) -> DataFrame:
    """Token ids and loss masks of conversations given as (conv_id, turn, role, text).

    Returns a row for each turn, whose ids in order of turn_no are the conversation's: conv_id, turn_no (from 1),
    role, token_ids, loss_mask (0 or 1 for each id), first_id (place of the turn's first id in its conversation),
    n_ids. Turns go by ``turn``, then role, then a hash of the text, nulls first, so rows that are repeated whole
    keep one turn each. A null text is empty; a null role counts as the role of no letters; rows with a null
    conv_id are one conversation. Other columns are not read. An empty table gives an empty one.

    Rows are dealt by ranges of (conversation, turn), so a conversation with a third of all rows is cut over tasks;
    what a task must know of the one before is a pair of sums, one for each task.
    """
    spark = rows.sparkSession
    load = _vocabulary(spark, rank_file, pattern)
    kind = rows.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "_turn", "_role", "_tie"]
    keyed = rows.select("conv_id", F.col("turn").alias("_turn"), F.col("role").alias("_role"), F.xxhash64("text").alias("_tie"), F.col("text").alias("_text"))
    dealt = keyed.repartitionByRange(parts, *order) if parts else keyed.repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())

    def make():
        encode, _, reserved = load()
        at = {"conv": None, "turn": 0, "ids": 0, "any": False}

        def fn(convs, roles, texts, part):
            out = ([], [], [], [], [], [])
            for conv, role, text in zip(convs, roles, texts):
                if not at["any"] or conv != at["conv"]:
                    at.update(conv=conv, turn=0, ids=0, any=True)
                # The start mark is put before each task's first turn of a conversation here, and cut off again where the conversation had begun before.
                ids, mask = assemble(segments(role, text, at["turn"] == 0), encode, reserved)
                at["turn"] += 1
                for col, x in zip(out, (at["turn"], role or "", ids, mask, at["ids"], len(ids))):
                    col.append(x)
                at["ids"] += len(ids)
            return [convs, *out, part]

        return fn

    schema = f"conv_id {kind}, turn_no bigint, role string, token_ids array<int>, loss_mask array<tinyint>, first_id bigint, n_ids bigint, _part int"
    made = written(map_batches(dealt.select("conv_id", "_role", "_text", "_part"), make, schema), "chat")
    # One row for each task: the last conversation and what the task has of it.
    ends = made.groupBy("_part").agg(F.max_by(F.struct("conv_id", "turn_no", (F.col("first_id") + F.col("n_ids")).alias("ids")), F.struct(F.col("conv_id").isNotNull(), "conv_id", "turn_no")).alias("e"))
    carry, last = [], None
    for r in sorted(ends.collect(), key=lambda r: r["_part"]):
        if last:
            carry.append((r["_part"], *last))
        conv, turns, ids = r["e"]["conv_id"], r["e"]["turn_no"], r["e"]["ids"]
        # A task whose last conversation is the one carried over holds nothing else; its start mark counts once.
        last = (conv, turns + last[1], ids + last[2] - 1) if last and last[0] == conv else (conv, turns, ids)
    before = spark.createDataFrame(carry, f"_part int, _conv {kind}, _turns bigint, _ids bigint")
    joined = made.join(F.broadcast(before), (made["_part"] == before["_part"]) & made["conv_id"].eqNullSafe(before["_conv"]), "left")
    begun, again = F.col("_turns").isNotNull(), F.col("_turns").isNotNull() & (F.col("turn_no") == 1)
    cut = lambda c: F.when(again, F.slice(c, F.lit(2), F.size(c))).otherwise(F.col(c)).alias(c)
    return joined.select(
        "conv_id", (F.col("turn_no") + F.coalesce("_turns", F.lit(0))).alias("turn_no"), "role", cut("token_ids"), cut("loss_mask"),
        (F.col("first_id") + F.when(begun, F.col("_ids") - F.when(F.col("turn_no") == 1, 0).otherwise(1)).otherwise(0)).alias("first_id"),
        (F.col("n_ids") - again.cast("int")).alias("n_ids"),
    )


def read_back(formatted: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Turns read from the ids and masks of :func:`format_conversations`: conv_id, turn_no, role, text, loss_text, rendered_chars."""
    load = _vocabulary(formatted.sparkSession, rank_file, pattern)

    def make():
        _, decode, reserved = load()
        marks = {i: m for m, i in reserved.items()}

        def fn(convs, turns, ids, masks):
            read = [read_turn(i, m, decode, marks) for i, m in zip(ids, masks)]
            return [convs, turns, *(list(x) for x in zip(*read))] if read else [[]] * 6

        return fn

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return map_batches(formatted.select("conv_id", "turn_no", "token_ids", "loss_mask"), make, f"conv_id {kind}, turn_no bigint, role string, text string, loss_text string, rendered_chars bigint")


def digests(turns: DataFrame) -> DataFrame:
    """Digests of each conversation's turns and of its text under the loss mask, from the rows of :func:`read_back`.

    A digest of a whole conversation is sequential by nature: its turns pass through one task in order, one turn at
    a time, and only the state of the digest is kept.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")

    def make():
        at: dict = {}

        def close():
            row = [at["conv"], at["n"], at["turns"].hexdigest(), at["chars"], at["loss"].hexdigest(), at["all"]]
            at.clear()
            return row

        def fn(convs, roles, texts, losses, chars):
            done = []
            for conv, role, text, loss, n in zip(convs, roles, texts, losses, chars):
                if at and at["conv"] != conv:
                    done.append(close())
                if not at:
                    at.update(conv=conv, n=0, turns=hashlib.sha256(), loss=hashlib.sha256(), chars=0, all=0)
                at["turns"].update(f"{role}\n{text}\n".encode())
                at["loss"].update(loss.encode())
                at.update(n=at["n"] + 1, chars=at["chars"] + len(loss), all=at["all"] + n)
            return [list(x) for x in zip(*done)] if done else [[]] * 6

        return fn, lambda: [[x] for x in close()] if at else [[]] * 6

    return map_batches(ordered.select("conv_id", "role", "text", "loss_text", "rendered_chars"), make, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
