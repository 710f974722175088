"""Chat formatting of reply trees.

A table of messages with parents is a forest.  Root-to-leaf paths come from
iterative self-joins that double the distance of an ancestor pointer (1, 2,
4, ... replies up), so a thread of n replies takes log2(n) joins.  A branch is
scored by the sum of its messages' scores; the best branch of each tree, or
all branches, are written as one conversation each.

The template puts ``<|im_start|>role\\n`` before and ``<|im_end|>\\n`` after a
text.  Inside texts a backslash follows every ``<``, ``[`` and backslash, so
no control string of this or of the bracketed kind (``</s>``, ``[INST]``)
can stand there, and taking those backslashes out gives the text back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tessera.llm.common import emit, stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_ESCAPE, _PLAIN = re.compile(r"([<\[\\])"), re.compile(r"([<\[\\])\\")
_FORMATTED = pa.schema([("conv", pa.string()), ("leaf", pa.int64()), ("formatted", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _PLAIN.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points) under the loss
    mask: the text of each turn of the trained role."""
    pieces, loss, at = [], [], 0
    for role, text in turns:
        head = OPEN + escape(role).replace("\n", "<n") + "\n"  # "<n" can't come from a text
        body = escape(text)
        if role == trained:
            loss.append((at + len(head), at + len(head) + len(body)))
        pieces += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(pieces), loss


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for piece in formatted.split(CLOSE)[:-1]:
        role, text = piece.removeprefix(OPEN).split("\n", 1)
        turns.append((unescape(role.replace("<n", "\n")), unescape(text)))
    return turns


def reply_paths(messages: DataFrame, keep: str = "best") -> DataFrame:
    """``(conv, leaf, place, node)``: the chosen root-to-leaf paths of
    ``messages(conv, node, parent, score)``, ``place`` counted up from the
    leaf at 0.

    ``conv`` and ``node`` together name a message and must be unique and not
    null.  A null or unknown parent makes a root; a null score counts 0; a
    message that leads back to itself has no root and its branch is left out.
    ``keep`` is ``best`` (by score, then length, then smallest leaf) or
    ``all``.  An empty table gives no path.
    """
    nodes = stored(messages.select("conv", "node", "parent", F.coalesce(F.col("score").cast("double"),
                                                                       F.lit(0.0)).alias("score")), "replies")
    known = nodes.select("conv", F.col("node").alias("parent"), F.lit(True).alias("known"))
    hop = stored(nodes.join(known, ["conv", "parent"], "left").select(
        "conv", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("score").alias("total"),
        F.lit(1).cast("long").alias("length"), F.col("node").alias("top")), "hops")
    hops, most = [hop], max(1, nodes.count()).bit_length()
    while not hops[-1].where("up IS NOT NULL").isEmpty() and len(hops) <= most:
        low = hops[-1]
        high = low.select("conv", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"),
                          F.col("length").alias("length2"), F.col("top").alias("top2"))
        ended = low.where("up IS NULL")
        moved = low.where("up IS NOT NULL").join(high, ["conv", "up"]).select(
            "conv", "node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"),
            (F.col("length") + F.col("length2")).alias("length"), F.col("top2").alias("top"))
        hops.append(stored(ended.unionByName(moved), "hops"))
    parents = nodes.select("conv", F.col("parent").alias("node")).where("node IS NOT NULL").distinct()
    leaves = hops[-1].where("up IS NULL").join(parents, ["conv", "node"], "left_anti")
    if keep == "best":
        best = F.max(F.struct("total", "length", (-F.col("node")).alias("least"))).alias("b")
        leaves = leaves.groupBy("conv", "top").agg(best).select("conv", (-F.col("b.least")).alias("node"))
    elif keep != "all":
        raise ValueError(keep)
    paths = leaves.select("conv", F.col("node").alias("leaf"), F.lit(0).cast("long").alias("place"), "node")
    for k in range(len(hops) - 2, -1, -1):  # the last hop has no pointers
        up = hops[k].where("up IS NOT NULL").select("conv", "node", "up")
        further = paths.join(up, ["conv", "node"]).select("conv", "leaf", (F.col("place") + (1 << k)).alias("place"),
                                                         F.col("up").alias("node"))
        paths = stored(paths.unionByName(further), "paths")  # else the plan doubles each time
    return paths


def format_trees(messages: DataFrame, keep: str = "best", trained: str = "assistant") -> DataFrame:
    """``(conv, leaf, formatted, loss)``: each chosen path of
    ``messages(conv, node, parent, score, role, text)`` as one conversation.
    Null roles and texts are empty.  A conversation is one value, so it must
    fit in a task; other columns are ignored."""
    chosen = reply_paths(messages, keep)
    turns = (chosen.join(messages.select("conv", "node", "role", "text"), ["conv", "node"])
             .groupBy("conv", "leaf")
             .agg(F.sort_array(F.collect_list(F.struct((-F.col("place")).alias("at"), "role", "text"))).alias("t")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for b in batches:
                for conv, leaf, rows in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    text, loss = format_turns([(r["role"] or "", r["text"] or "") for r in rows], trained)
                    yield (conv, leaf, text, [{"start": s, "end": e} for s, e in loss]), len(text)
        yield from emit(_FORMATTED, out())

    return turns.select("conv", "leaf", "t").mapInArrow(
        write, "conv string, leaf long, formatted string, loss array<struct<start:long,end:long>>")


def linear_messages(conversations: DataFrame) -> DataFrame:
    """Conversations of plain turns as reply trees: each row answers the one
    before it by (turn, role, text); a null turn comes last, a null ``conv_id``
    is a conversation of its own.  ``conv`` is the id as text behind ``v``."""
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("null")).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return rows.select("conv", F.row_number().over(order).cast("long").alias("node"), "role", "text").select(
        "conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"),
        "role", "text")


def conversation_digest(conversations: DataFrame) -> DataFrame:
    """Formats ``conversations(conv_id, turn, role, text)``, stores the output
    and digests what is read back: ``conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars``."""
    messages = stored(linear_messages(conversations), "messages")
    output = stored(format_trees(messages), "formatted")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for b in batches:
                for conv, _, text, loss in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    turns = read_turns(text)
                    said = "".join(unescape(text[s["start"]:s["end"]]) for s in loss)
                    yield (None if conv == "null" else int(conv[1:]), len(turns),
                           _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), _sha(said), len(text)), 200
        yield from emit(schema, out())

    return output.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
