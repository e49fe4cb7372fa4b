"""A turn is emitted once, however many conversations share it, also where a tree is too large for one pack."""

import random

from quadrata.llm import chat_tree


def test_hot_turns_are_emitted_once(spark, monkeypatch):
    monkeypatch.setattr(chat_tree, "WHOLE", 400)
    rng = random.Random(3)
    rows = []
    for c in range(150):
        rows += [(c, 0, "system", "common"), (c, 1, "assistant", f"<|a{c % 3}\n"), (c, 2, "user", f"q{c % 40}"), (c, 3, "assistant", f"{c}")]
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["x", None, "y"])) for t in range(4, 4 + c % 3)]
    for c in range(150, 155):  # end within what others share, at its root or below it; equal ones, too
        rows += [(c, 0, "system", "common"), *([(c, 1, "assistant", "<|a1\n")] if c % 2 else [])]
    rows += [(c, 0, "user", "rare") for c in range(160, 200)] + [(200, t, "user", "long " * 40) for t in range(5)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    said = {}
    for c, _, role, text in sorted(rows, key=lambda r: r[:2]):
        said.setdefault(c, []).append((role, text or ""))
    packs, membership = chat_tree.format_chats(frame, 8)
    packed, members = {bytes(p.pack): p for p in packs.collect()}, membership.collect()
    different = {tuple(turns[: i + 1]) for turns in said.values() for i in range(len(turns))}
    assert sum(len(p.text) for p in packed.values()) == sum(len(chat_tree.turn_text(*turns[-1])) for turns in different)
    nodes = [bytes(n.node) for p in packed.values() for n in p.nodes]
    assert len(nodes) == len(set(nodes)) == len(different)
    assert sum(p.above is not None for p in packed.values()) > 20

    def chain(pack, node):
        found = next(n for n in pack.nodes if n.node == node)
        text = "".join(pack.text[s.start : s.end] for s in [*found.attends, found])
        text = text if pack.above is None else chain(packed[bytes(pack.trunk)], pack.above) + text
        assert found.position + found.end - found.start == len(text)
        return text

    assert sorted(m.conv_id for m in members) == sorted(said)
    for m in members:
        assert chat_tree.parsed(chain(packed[bytes(m.pack)], m.node)) == said[m.conv_id]
    back = {r.conv_id: r for r in chat_tree.read_back(packs, membership).collect()}
    assert {c: (r.n_turns, r.loss_chars) for c, r in back.items()} == {c: (len(v), sum(len(t) for r, t in v if r == "assistant")) for c, v in said.items()}
    plain = {r.conv_id: r for r in chat_tree.read_back(*chat_tree.format_chats(frame, 1000)).collect()}
    assert back == plain
