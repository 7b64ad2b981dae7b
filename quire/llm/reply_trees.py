r"""Reply trees as training conversations.

Messages point to the message that they answer. Iterative self-joins follow the
pointers: a round joins the table with itself and doubles the length of every
pointer, so a tree of depth d takes log2(d) rounds; on the way each message sums up
the scores between itself and its root. The branches of a tree (its root-to-leaf
paths) are ranked by that score, and the same tables, joined once more in their order,
list the messages of the chosen branches. Each branch is formatted as one conversation.

Defined results. A message whose parent is null or not in its tree is a root.
Messages on or below a cycle have no root and are on no branch. Of rows with the
same (tree, id) the one with the least (parent, role, text, score) counts, nulls
first; rows without an id count for nothing. A null score is 0, a null role or text
is empty. Ties of scores go to the smaller leaf id. A null tree is a tree of its own. An empty table
gives no rows, further columns are ignored, texts of any length are taken whole.

Template: every turn is `<|turn|>role<|says|>text<|end|>`. A backslash behind the first
character keeps control strings (ours and those of common chat formats) out of roles and
texts, and a backslash of the text is doubled, so that reading back is exact. The
loss mask is a list of spans that hold the (escaped) texts of assistant turns. A conversation
of more than `part_chars` characters is written as several parts of whole turns,
so no task holds more of one conversation than a part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stage
from quire.operators.ids import dense_ids

TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
# --- fixed values: control strings of common chat formats ----------------------
FOREIGN = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
           "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>"]
# ---------------------------------------------------------------------------------
CONTROL = [TURN, SAYS, END, *FOREIGN]
LEARNED = "assistant"
PART_CHARS = 1_000_000

_STARTS = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(r"(?s)\\(.)")
_TURN = re.compile(f"(?s){re.escape(TURN)}(.*?){re.escape(SAYS)}(.*?){re.escape(END)}")

SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
PARTS_SQL = "leaf long, part long, start long, text string, loss array<struct<start:long,end:long>>"
PARTS = pa.schema([("leaf", pa.int64()), ("part", pa.int64()), ("start", pa.int64()), ("text", pa.string()), ("loss", SPANS)])
READ_SQL = ("leaf long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


# --- template --------------------------------------------------------------------

def escape(text: str | None) -> str:
    return _STARTS.sub(lambda m: m[0] + "\\", (text or "").replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted part."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


# --- branches --------------------------------------------------------------------

def thread(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as messages (tree, id, parent, role,
    text, score): each row answers the one before it by turn, ties by role and text,
    nulls first. Ids come from a range sort over all rows, so that a conversation that holds
    many of them is not sorted in one task."""
    rows = dense_ids(conversations.select("conv_id", "turn", "role", "text"), ["conv_id", "turn", "role", "text"]).frame
    before = rows.select((F.col("id") + 1).alias("id"), F.col("conv_id").alias("prior"), F.lit(True).alias("some"))
    return rows.join(before, "id", "left").select(
        F.col("conv_id").alias("tree"), "id",
        F.when(F.col("some") & F.col("prior").eqNullSafe(F.col("conv_id")), F.col("id") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


def _single(messages: DataFrame) -> DataFrame:
    """One row per (tree, id), numbered by `node` where ids of different trees are alike."""
    rest = F.struct("parent", "role", "text", "score")
    return messages.where("id IS NOT NULL").groupBy("tree", "id").agg(F.min(rest).alias("m")) \
        .select("tree", "id", "m.parent", F.coalesce("m.role", F.lit("")).alias("role"), F.coalesce("m.text", F.lit("")).alias("text"),
                F.coalesce(F.col("m.score").cast("double"), F.lit(0.0)).alias("score"))


def _pointers(nodes: DataFrame) -> list[DataFrame]:
    """Tables (node, up, score, length): in the k-th, `up` is the 2^k-th message above, null
    beyond the root, with the score and number of the messages from `node` up to before it. In
    the last one all have arrived, but for those on or below a cycle."""
    out, open_before = [stage(nodes.select("node", "up", "score", F.lit(1).cast("long").alias("length")), "up")], None
    while True:
        now = out[-1]
        still = now.where("up IS NOT NULL").count()
        if still in (0, open_before):
            return out
        open_before = still
        above = now.select(F.col("node").alias("at"), F.col("up").alias("next"), F.col("score").alias("s"), F.col("length").alias("n"))
        on = now.where("up IS NOT NULL").join(above, F.col("up") == F.col("at")) \
            .select("node", F.col("next").alias("up"), (F.col("score") + F.col("s")).alias("score"),
                    (F.col("length") + F.col("n")).alias("length"))
        out.append(stage(now.where("up IS NULL").unionByName(on), "up"))


def branches(messages: DataFrame, keep: int | None = 1, unique: bool = False) -> DataFrame:
    """The chosen branches of messages (tree, id long, parent, role, text, score), one row per message:
    tree, leaf (node number of its last message), leaf_id, branch_rank, branch_score, place (0 at the
    root), id, role, text. `keep` branches of each tree stay, all without it.
    `unique` says that ids are unique over the whole table, which saves the reduction of repeated rows."""
    if unique:
        nodes = stage(messages.select("tree", "id", F.col("parent").alias("up"), "role", "text", "score", F.col("id").alias("node")), "nodes")
    else:
        named = stage(dense_ids(_single(messages), ["tree", "id"], "node").frame, "named")
        over = named.select(F.col("tree").alias("t"), F.col("id").alias("i"), F.col("node").alias("up"))
        nodes = stage(named.join(over, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("i")), "left").drop("t", "i"), "nodes")
    jumps = _pointers(nodes)
    ends = jumps[-1].where("up IS NULL").join(nodes.select(F.col("up").alias("node")).where("node IS NOT NULL"), "node", "left_anti") \
        .join(nodes.select("node", "tree", "id"), "node") \
        .select("tree", F.col("node").alias("leaf"), F.col("id").alias("leaf_id"), "length", F.col("score").alias("branch_score"))
    ranked = ends.withColumn("branch_rank", F.row_number().over(
        Window.partitionBy("tree").orderBy(F.col("branch_score").desc(), "leaf_id")))
    if keep is not None:
        ranked = ranked.where(F.col("branch_rank") <= keep)  # a limit per task first, then per tree
    chosen = stage(ranked, "branches")
    # from the longest pointers down: a message `2^k` above another one is listed in round k, each of them once
    found = [chosen.select("leaf", F.col("leaf").alias("node"), (F.col("length") - 1).alias("place"))]
    for k in range(len(jumps) - 2, -1, -1):
        path = reduce(DataFrame.unionByName, found)
        far = path.where(F.col("place") >= 2 ** k).join(jumps[k].where("up IS NOT NULL").select("node", "up"), "node")
        found.append(stage(far.select("leaf", F.col("up").alias("node"), (F.col("place") - 2 ** k).alias("place")), "path"))
    path = reduce(DataFrame.unionByName, found)
    return path.join(chosen.drop("length"), "leaf").join(nodes.select("node", "id", "role", "text"), "node").drop("node")


# --- formatting --------------------------------------------------------------------

def _format(part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Turns, sorted by (leaf, place), as parts of conversations."""
        rows: list[tuple] = []
        size = 0  # characters in `rows`
        leaf, part, start, at, texts, loss = None, 0, 0, 0, [], []

        def cut() -> None:
            nonlocal part, start, texts, loss, size
            rows.append((leaf, part, start, "".join(texts), loss))
            size += at - start
            part, start, texts, loss = part + 1, at, [], []

        def block() -> pa.RecordBatch:
            nonlocal size
            columns = list(zip(*rows))
            rows.clear()
            size = 0
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, PARTS)], schema=PARTS)

        for batch in batches:
            for to, role, text in zip(*(batch[c].to_pylist() for c in ("leaf", "role", "text"))):
                head, body = TURN + escape(role) + SAYS, escape(text)
                if texts and (to != leaf or at - start + len(head) + len(body) + len(END) > part_chars):
                    cut()
                if to != leaf:
                    leaf, part, start, at = to, 0, 0, 0
                if size > part_chars or len(rows) > 10_000:
                    yield block()
                if role == LEARNED:
                    loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
                texts.append(head + body + END)
                at += len(texts[-1])
        if texts:
            cut()
        if rows:
            yield block()

    return run


def formatted(path: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """Branches (leaf, place, role, text) as parts of conversations: leaf, part (from 0), start (characters
    before it), text, loss (spans of learned text as offsets in the whole conversation)."""
    return path.select("leaf", "place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")) \
        .repartition("leaf").sortWithinPartitions("leaf", "place").select("leaf", "role", "text").mapInArrow(_format(part_chars), PARTS_SQL)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts, sorted by (leaf, part), read back: their turns and the text under the loss mask."""
    leaf, now, done = None, None, []

    def close() -> None:
        if now is not None:
            done.append((leaf, now["n"], now["turns"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["size"]))

    def block() -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        columns = list(zip(*done)) or [[]] * len(names)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        for to, start, text, loss in zip(*(batch[c].to_pylist() for c in ("leaf", "start", "text", "loss"))):
            if now is None or to != leaf:
                close()
                leaf, now = to, {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "size": 0}
            for role, said in turns(text):
                now["n"] += 1
                now["turns"].update(f"{role}\n{said}\n".encode())
            for span in loss:
                learned = unescape(text[span["start"] - start:span["end"] - start])
                now["chars"] += len(learned)
                now["loss"].update(learned.encode())
            now["size"] += len(text)
        if len(done) > 10_000:
            yield block()
            done.clear()
    close()
    yield block()


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation, from its formatted parts: leaf, n_turns, turns_sha256 (role, newline, text, newline
    of each turn), loss_chars and loss_sha256 (the unescaped text under the loss mask), formatted_chars."""
    return parts.repartition("leaf").sortWithinPartitions("leaf", "part").select("leaf", "start", "text", "loss").mapInArrow(_read, READ_SQL)


def conversation_digests(conversations: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """One row per conversation: conv_id and the figures of `read_back`."""
    path = stage(branches(thread(conversations), unique=True), "paths")
    parts = stage(formatted(path, part_chars), "parts")
    of = path.where("place = 0").select("leaf", F.col("tree").alias("conv_id"))
    return read_back(parts).join(of, "leaf").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
