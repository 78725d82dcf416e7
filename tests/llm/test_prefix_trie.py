"""The prefix trie and its radix trees against plain Python."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from patina.llm import art, prefix_trie
from patina.llm.queries import op11_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, id string, chars int"


@given(st.lists(st.binary(max_size=6), max_size=60), st.booleans())
@settings(max_examples=300, deadline=None)
def test_radix_tree_holds_what_was_put_in(keys, dense):
    keys += [bytes([i]) for i in range(256)] + [bytes([7, i]) for i in range(0, 256, 5)] if dense else []
    tree = art.RadixTree()
    for n, key in enumerate(keys):
        tree.insert(key, (key, n))
    found = {}
    for node, length in tree.bottom_up():
        count = len(list(node.children.items())) if node.children else 0
        if node.children is not None:
            assert isinstance(node.children, art.Sorted | art.Indexed | art.Direct) and count <= node.children.room
            assert [b for b, _ in node.children.items()] == sorted(b for b, _ in node.children.items())
            assert count > 1 or node.value is not None or not length
        if node.value is not None:
            assert len(node.value[0]) == length
            found[node.value[0]] = node.value[1]
    assert found == {k: n for n, k in enumerate(keys)}


def test_layouts_grow():
    node = art.Node(b"")
    sizes = []
    for i in range(256):
        node.add(art.Node(bytes([255 - i])))
        sizes.append(node.children.room)
    assert [sizes[i] for i in (0, 3, 4, 15, 16, 47, 48, 255)] == [4, 4, 16, 16, 48, 48, 256, 256]
    assert [b for b, _ in node.children.items()] == list(range(256)) and node.children.find(9).path == b"\x09"


def sequences(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            told = f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()
            own.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.sha256(told).hexdigest()[:32], len(text or ""), role or "", text or ""))
    return {c: [(r[4], r[5]) for r in sorted(turns)] for c, turns in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        out[c] = base[:h] + turns[h:]
    return out


def brute(convs):
    """One row per distinct sequence of first turns."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in nodes:
        if node:
            children.setdefault(node[:-1], []).append(node)
    saved = {n: (len(m) - 1) * (len(n[-1][1]) if n else 0) for n, m in nodes.items()}
    rows = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        ends = sorted(c for c in members if len(convs[c]) == len(node))
        rows.append(
            (
                min(members),
                len(node),
                min(nodes[node[:-1]]) if node else None,
                len(members),
                len(children.get(node, [])),
                sum(n not in children for n in below),
                sum(saved[n] for n in below),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(rows, key=str)


def messages():
    pick = random.Random(11)
    rows = []
    for c in [*range(0, 260), *range(-130, -100), 1000, 1001, 1099, 2050]:
        for t in range(pick.randrange(1, 8)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", pick.choice(["hi", "no", "é" * 9, "", None]), "x", 3))
    rows += [(900 + i, t, "user", f"same {t}", "x", 3) for i in range(60) for t in range(3)]
    rows += [(3000, t, None if t % 3 else "user", f"t{t}", "x", 3) for t in range(300)]
    rows += [(3001, t, None if t % 3 else "user", f"t{t}", "x", 3) for t in range(290)]
    rows += [(None, 0, "user", "lost", "x", 3), (4000, None, "user", "null turn", "x", 3), (4000, 1, "user", "b", "x", 3)]
    rows += [(4001, 1, "user", "b", "x", 3), (4001, 1, "user", "b", "x", 3), (4001, 1, None, None, None, None)]
    return rows


def table(found):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert found.columns == names
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("block, chunk", [(4_000_000, 4096), (1, 2), (3_000, 7)])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, block, chunk):
    monkeypatch.setattr(prefix_trie, "BLOCK_BYTES", block)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", chunk)
    spark.createDataFrame(messages(), SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that ranges meet
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert table(op11_prefix_trie(spark, str(tmp_path))) == brute(rebuilt(sequences(messages())))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_small_blocks_give_the_same():
    """Blocks cut anywhere, also right after a key that the next one continues."""
    pick = random.Random(2)
    convs = {c: [("u", pick.choice("abc")) for _ in range(pick.randrange(6))] for c in range(80)}
    name = lambda turn: hashlib.sha256(repr(turn).encode()).digest()[:16]
    keys = {}
    for c, turns in convs.items():
        keys.setdefault(b"".join(map(name, turns)), []).append(c)
    ordered = sorted(keys)
    for cut in range(1, len(ordered)):
        rows = []
        for part, start in ((ordered[:cut], -1), (ordered[cut:], art.common_length(ordered[cut - 1], ordered[cut]) // 16)):
            block = prefix_trie._Block(start)
            for key in part:
                turns = convs[keys[key][0]]
                block.add(key, [len(t[1]) for t in turns], len(keys[key]), min(keys[key]), "")
            stop, goes_on = prefix_trie._onward(ordered[cut - 1], ordered[cut]) if start == -1 else (-1, False)
            rows += block.nodes(stop, goes_on)
        root = [r for r in rows if r[1] == 0]
        want = next(r for r in brute(convs) if r[1] == 0)
        assert (min(r[0] for r in root), *(sum(r[k] for r in root) for k in (3, 4, 5)), sum(r[6] - r[7] for r in root)) == (want[0], *want[3:7])
        assert len([r for r in rows if r[9] is None]) + len({r[9] for r in rows if r[9]}) == len(brute(convs))


def test_empty_table_has_no_nodes(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert op11_prefix_trie(spark, str(tmp_path)).count() == 0


def test_conversations_without_turns_belong_to_the_root(spark):
    rows = spark.createDataFrame([(5, []), (3, []), (4, [("aa" * 16, 7)])], "conv_id long, turns array<struct<id:string,chars:long>>")
    got = table(prefix_trie.prefix_trie(rows))
    assert got == sorted(
        [
            (3, 0, None, 3, 1, 1, 0, hashlib.sha256(b"3,5").hexdigest()),
            (4, 1, 3, 1, 0, 1, 0, hashlib.sha256(b"4").hexdigest()),
        ],
        key=str,
    )
    assert rows.where(F.size("turns") == 0).count() == 2
