"""Chat formatting with a prefix tree: turns shared by conversations are emitted once, depth first.

Tokens are the code points of the formatted text. Conversations are chained hashes of their turns, so a turn after the same
turns is one node, however many conversations share it. All conversations that begin with the same turn are one tree. A tree
that fits into a row is one pack. Of a larger one the turns that many conversations share are a pack, its trunk; what hangs on
the trunk are packs of their own, which begin where a turn of the trunk ends and refer to it. Within a pack the tree
is laid out depth first, largest subtree first, which keeps the list of attended intervals short.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.session import cut_lineage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"
#: Different conversations that share a turn of a branch at most, and characters of a tree that is not split.
PACK, WHOLE = 256, 1 << 20

_INTERVALS = "array<struct<start: int, end: int>>"
PACK_SCHEMA = (
    f"pack binary, trunk binary, above binary, text string, loss {_INTERVALS}, "
    f"nodes array<struct<node: binary, parent: int, start: int, end: int, position: int, attends: {_INTERVALS}>>"
)


def escaped(text: str | None) -> str:
    """Text in which no control string can start: backslashes are doubled and ``<|`` becomes ``<\\|``."""
    return (text or "").replace("\\", "\\\\").replace("<|", "<\\|")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


def turn_text(role: str | None, text: str | None) -> str:
    return f"{OPEN}{escaped(role).replace(chr(10), chr(92) + 'n')}\n{escaped(text)}{CLOSE}\n"


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(CLOSE, line)
        out.append((unescaped(formatted[at + len(OPEN) : line]), unescaped(formatted[line + 1 : end])))
        at = end + len(CLOSE) + 1
    return out


def _chain(batches):
    """Rows sorted by conversation and turn, with the hash of the conversation up to each turn; state passes batches.

    Beside it the hash up to the turn above, that of the first turn, and the position of the turn's first character.
    """
    conversation, started, rank, node, tree, position = None, False, 0, b"", b"", 0
    for batch in batches:
        rows = []
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if not started or conv_id != conversation:
                conversation, started, rank, node, position = conv_id, True, 0, b"", 0
            piece, above = turn_text(role, text), node
            node = hashlib.blake2b(node + piece.encode(), digest_size=16).digest()
            tree = tree if rank else node
            rows.append((conv_id, rank, node, above, tree, position, piece, role == TRAINED))
            rank, position = rank + 1, position + len(piece)
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.string(), pa.bool_())
            names = ["conv_id", "rank", "node", "above", "tree", "position", "piece", "trained"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _layout(pack: bytes, turns: list[tuple[bytes, bytes, bytes, int, str, bool]]) -> dict:
    """One pack: its text, loss intervals, and nodes with positions and the intervals each may attend to.

    ``turns``: (node, above, tree, position, piece, trained), each node once, parents before children.
    """
    known = {node: (piece, trained, position) for node, _, _, position, piece, trained in turns}
    children: dict[bytes, list[bytes]] = {node: [] for node in known}
    for node, above, *_ in turns[1:]:
        children[above].append(node)
    weight = dict.fromkeys(known, 1)
    for node, above, *_ in reversed(turns[1:]):
        weight[above] += weight[node]
    text, loss, nodes, at = [], [], [], 0
    root, before, tree = turns[0][:3]
    stack: list[tuple[bytes, int, list]] = [(root, -1, [])]
    while stack:
        node, parent, attends = stack.pop()
        piece, trained, position = known[node]
        end = at + len(piece)
        nodes.append({"node": node, "parent": parent, "start": at, "end": end, "position": position, "attends": attends})
        if trained:
            loss.append({"start": at + piece.index("\n") + 1, "end": end - len(CLOSE) - 1})
        if attends and attends[-1]["end"] == at:
            below = [*attends[:-1], {"start": attends[-1]["start"], "end": end}]
        else:
            below = [*attends, {"start": at, "end": end}]
        text.append(piece)
        me = len(nodes) - 1
        stack += [(c, me, below) for c in sorted(children[node], key=lambda c: weight[c])]
        at = end
    return {"pack": pack, "trunk": tree if before else None, "above": before or None, "text": "".join(text), "loss": loss, "nodes": nodes}


def _packs(batches):
    schema = pa.schema(
        [
            *((c, pa.binary()) for c in ("pack", "trunk", "above")),
            ("text", pa.string()),
            ("loss", pa.list_(kind := pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ("nodes", pa.list_(pa.struct([("node", pa.binary()), ("parent", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("position", pa.int32()), ("attends", pa.list_(kind))]))),
        ]
    )
    pack, held = None, []
    for batch in batches:
        for own, *turn in zip(*(batch.column(c).to_pylist() for c in ("pack", "node", "above", "tree", "position", "piece", "trained"))):
            if own != pack:
                if held:
                    yield pa.RecordBatch.from_pylist([_layout(pack, held)], schema)
                pack, held = own, []
            held.append(turn)
    if held:
        yield pa.RecordBatch.from_pylist([_layout(pack, held)], schema)


def format_chats(conversations: DataFrame, pack: int = PACK) -> tuple[DataFrame, DataFrame]:
    """(packs, membership) of ``conversations`` (conv_id, turn, role, text; more is ignored).

    packs: one row per pack with its text, loss intervals and nodes depth first, every node in one pack only; a node's ``position``
    is the position id of its first token and ``attends`` the intervals of its ancestors in the pack. A tree of up to ``WHOLE``
    characters is one pack. Of a larger tree the turns shared by more than ``pack`` different conversations are one pack, and a
    subtree below them is another one, whose nodes also attend to the node ``above`` of the pack ``trunk`` and to what
    that node attends to; both are null for trees and trunks.
    membership: (conv_id, pack, node) with the node that ends each conversation.
    Turns are ordered by turn, then role and text, so repeated turns all stay. Null roles and texts are empty; rows without
    conv_id form one conversation of their own. One conversation, and the turns of a trunk, have to fit into a task.
    """
    rows = (
        conversations.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(_chain, "conv_id bigint, rank int, node binary, above binary, tree binary, position int, piece string, trained boolean")
    )
    rows = cut_lineage(rows)
    ends = rows.groupBy("conv_id").agg(F.max_by("node", "rank").alias("end"))
    ends = cut_lineage(ends)
    first = ends.groupBy("end").agg(F.min("conv_id").alias("conv_id"))
    some = rows.select("conv_id", "rank", "node", "tree", F.length("piece").alias("chars")).alias("r")
    some = cut_lineage(some.join(first.alias("f"), F.col("r.conv_id").eqNullSafe(F.col("f.conv_id"))).select("r.*", "f.end").drop("conv_id"))
    shared = some.groupBy("node", "tree", "chars").agg(F.count("*").alias("sharing"))
    large = shared.groupBy("tree").agg(F.sum("chars").alias("size")).where(F.col("size") > WHOLE)
    hot = cut_lineage(shared.where(F.col("sharing") > pack).join(large, "tree").select("node", F.lit(True).alias("hot")))
    marked = some.join(hot, "node", "left")
    roots = cut_lineage(marked.groupBy("end", "tree").agg(F.min_by(F.when(F.col("hot").isNull(), F.col("node")), F.when(F.col("hot").isNull(), F.col("rank"))).alias("root")))
    placed = marked.where(F.col("hot").isNull()).join(roots.select("end", "root"), "end").groupBy("node").agg(F.min("root").alias("pack"))
    packs = (
        rows.drop("conv_id")
        .dropDuplicates(["node"])
        .join(placed, "node", "left")
        .withColumn("pack", F.coalesce("pack", "tree"))
        .repartition("pack")
        .sortWithinPartitions("pack", "rank", "node")
        .select("pack", "node", "above", "tree", "position", "piece", "trained")
        .mapInArrow(_packs, PACK_SCHEMA)
    )
    own = roots.select("end", F.coalesce("root", "tree").alias("pack"))
    return packs, ends.join(own, "end").select("conv_id", "pack", F.col("end").alias("node"))


def _spoken(text: str, loss: list[dict], node: dict) -> tuple[str, str]:
    """The text that a node attends to, itself included, and what of it is trained on."""
    spans = [*node["attends"], {"start": node["start"], "end": node["end"]}]
    said = (unescaped(text[m["start"] : m["end"]]) for m in loss if any(s["start"] <= m["start"] and m["end"] <= s["end"] for s in spans))
    return "".join(text[s["start"] : s["end"]] for s in spans), "".join(said)


def _until(batches):
    """(above, before, said): what a conversation has said in the trunk up to a node."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("text", "loss", "nodes"))
        rows = [(n["node"], *_spoken(text, loss, n)) for text, loss, nodes in zip(*columns) for n in nodes]
        if rows:
            kinds = (pa.binary(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["above", "before", "said"])


def _read_back(batches):
    for batch in batches:
        rows = []
        for pack, text, loss, nodes, before, earlier in zip(*(batch.column(c).to_pylist() for c in ("pack", "text", "loss", "nodes", "before", "said"))):
            for n in nodes:
                formatted, said = map(str.__add__, (before or "", earlier or ""), _spoken(text, loss, n))
                turns = parsed(formatted)
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((pack, n["node"], len(turns), digest, len(said), hashlib.sha256(said.encode()).hexdigest(), len(formatted)))
        if rows:
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["pack", "node", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _only(packs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Packs that have nodes in ``wanted`` (pack, node), with these nodes only."""
    wanted = wanted.groupBy("pack").agg(F.collect_set("node").alias("wanted"))
    return packs.join(wanted, "pack").withColumn("nodes", F.filter("nodes", lambda n: F.array_contains("wanted", n["node"]))).drop("wanted")


def read_back(packs: DataFrame, membership: DataFrame) -> DataFrame:
    """Digests of every conversation, read from the packed text through the intervals its last node attends to."""
    packs = cut_lineage(packs)
    trunks = _only(packs, packs.where("above is not null").select(F.col("trunk").alias("pack"), F.col("above").alias("node")))
    until = trunks.select("text", "loss", "nodes").mapInArrow(_until, "above binary, before string, said string")
    ends = _only(packs, membership).join(until, "above", "left")
    shape = "pack binary, node binary, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    read = ends.select("pack", "text", "loss", "nodes", "before", "said").mapInArrow(_read_back, shape)
    return membership.join(read, ["pack", "node"]).drop("pack", "node")
