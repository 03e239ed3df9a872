import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from cases import rows_of
from fieldmart.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
KIND = "conv_id long, turn long, role string, text string, node string, parent string, position string"


def ordered(rows):
    """conv_id -> list of (role, text)."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(turns)] for c, turns in convs.items()}


def plain_trie(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def saved(node):
        return (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0

    leaves, total = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        total[node] = saved(node) + sum(total[k] for k in kids[node])
    return sorted(((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(kids[n]), leaves[n], total[n],
                    hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(n)).encode()).hexdigest()) for n, m in members.items()), key=repr)


def frame_of(spark, rows):
    """With columns of clashing names."""
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], KIND)


def some_rows(seed, convs=60, turns=6):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(rng.randint(1, turns)):
            rows.append((c * 3, turn, rng.choice(("user", "assistant")), rng.choice(("a", "é", "", "word"))))
    rows += [(1, None, None, None), (1, 0, "user", None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "lost"), (-7, 5, "", "x" * 100_000), rows[0], rows[0]]
    return rows


def test_same_as_plain_trie(spark):
    for seed in (1,):
        rows = some_rows(seed)
        assert rows_of(prefix_trie.prefix_trie(frame_of(spark, rows)), *COLUMNS) == plain_trie(ordered(rows))


def test_long_chain_and_many_equal_conversations(spark):
    chain = [(5, t, "user", f"t{t}") for t in range(400)]
    rows = chain + [(6, *r[1:]) for r in chain[:390]] + [(c, 0, "user", "hello") for c in range(100, 3200)]
    assert rows_of(prefix_trie.prefix_trie(frame_of(spark, rows)), *COLUMNS) == plain_trie(ordered(rows))


def test_totals_of_random_trees_and_forests(spark):
    rng = random.Random(3)
    parent = {0: None, 1: None, **{v: rng.randrange(v) if rng.random() < 0.3 else v - 1 for v in range(2, 400)}}
    own = {v: rng.randint(-5, 9) for v in parent}
    total = dict(own)
    for v in sorted(parent, reverse=True):
        if parent[v] is not None:
            total[parent[v]] += total[v]
    tree = spark.createDataFrame([(v, p, own[v]) for v, p in parent.items()], "node long, parent long, w long")
    assert rows_of(prefix_trie.subtree_totals(tree, ["w"]), "node", "w") == sorted(total.items(), key=repr)


def test_empty_and_turnless(spark):
    nothing = frame_of(spark, [])
    assert prefix_trie.prefix_trie(nothing).count() == 0
    found = prefix_trie.trie(prefix_trie.numbered(nothing), spark.createDataFrame([(4,), (3,)], "conv_id long"))
    assert rows_of(found, *COLUMNS) == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,4").hexdigest())]


@pytest.mark.parametrize("seed", [9])
def test_query_on_rebuilt_conversations(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(c, t, "user", rng.choice(("a", "b", "c d"))) for c in range(80) if c % 15 for t in range(rng.randint(1, 12))] + [(75, 0, None, None), (None, 1, "user", "x")]
    frame_of(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    turns = ordered(rows)
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
    assert rows_of(queries.RUNS["op12_prefix_trie"](spark, str(tmp_path)), *COLUMNS) == plain_trie(rebuilt)
