"""The trie of conversations against brute force, in one shard and in many levels of shards."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from siteloom.llm import prefixtrie, queries

SCHEMA = "conv_id long, turn long, role string, text string, path string, shard int, n_convs long, _shard long"


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    own = {c: [t for *_, t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        left = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        path = tuple(own.get(left, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, some in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(some) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (
            min(some),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(some),
            kids[path],
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
        )
        for path, some in members.items()
    )


def got(df):
    return sorted(tuple(r) for r in df.select(*prefixtrie.RESULT).collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, 3) for r in rows], SCHEMA)


def odd_rows():
    rng = random.Random(3)
    rows = []
    for conv in [*range(0, 60), *range(100, 160), -5, -105, -200, 777, 2**62]:
        for turn in range(rng.choice([1, 1, 2, 3, 6, 9, 25])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "", "long text 中"])))
    rows += [(900, None, "user", "first"), (900, 0, None, None), (900, 0, "", "x"), (900, 0, "", "x"), (901, 3, "us", "er")]
    rows += [(None, 0, "user", "no conversation"), (1000, 0, "user", "a" * 3_000_000), (1001, 5, "u", None)]
    rows += [(4000 + k, t, "user", "same") for k in range(40) for t in range(8)]
    rows += [(5000 + k, 0, "user", "one") for k in range(40)]
    rows += [(6000, t, "user", str(t % 3)) for t in range(300)] + [(6100, t, "user", str(t % 3)) for t in range(290)]
    return rows


@pytest.mark.parametrize(("rows", "turns"), [(10**6, 10**9), (40, 10**9), (7, 10**9), (3, 100)])
def test_against_brute_force(spark, rows, turns):
    made = odd_rows()
    paths = prefixtrie.rebuilt(table(spark, made))
    assert got(prefixtrie.nodes(paths, rows, turns)) == brute(made)


def test_all_alike_and_random(spark):
    alike = [(k, t, "user", f"turn {t}") for k in range(300) for t in range(7)]
    assert got(prefixtrie.nodes(prefixtrie.rebuilt(table(spark, alike)), 11)) == brute(alike)
    rng = random.Random(8)
    for _ in range(2):
        made = [(k, t, "u", rng.choice("ab")) for k in range(120) for t in range(rng.randint(1, 40))]
        assert got(prefixtrie.nodes(prefixtrie.rebuilt(table(spark, made)), 9)) == brute(made)


def test_empty(spark):
    assert got(prefixtrie.trie(table(spark, []))) == []


def test_query(spark, tmp_path):
    made = odd_rows()
    table(spark, made).write.parquet(str(tmp_path / "conversations.parquet"))
    found = queries.QUERIES["op13_prefix_trie"](spark, str(tmp_path))
    assert found.dtypes == [(c, "string" if c == "ends_sha256" else "bigint") for c in prefixtrie.RESULT]
    assert got(found) == brute(made)
