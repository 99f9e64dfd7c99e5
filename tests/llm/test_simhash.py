"""SimHash classes against brute force, and the covering argument itself."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from cohortline.llm.common import connected_components, local_components, tile_hot_keys
from cohortline.llm.simhash import PARTS, Part, covers, fingerprint, keep_one, near_duplicates

SCHEMA = "doc_id long, text string, id string, anchor int"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, bits=4):
    """Smallest index reachable over links of at most ``bits`` bits."""
    out = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(range(len(values)), 2):
            if bin(values[a] ^ values[b]).count("1") <= bits and out[a] != out[b]:
                out[a] = out[b] = min(out[a], out[b])
                changed = True
    return out


def test_every_close_pair_meets():
    assert covers(PARTS, 4) and not covers(PARTS, 5)
    rng = random.Random(0)
    part = Part(0, 24, 1, 15)
    for _ in range(200):
        x = rng.getrandbits(24)
        y = x ^ (1 << rng.randrange(24))
        home = int(part.home(np.array([x], np.uint64))[0])
        assert bin(home ^ x).count("1") <= 1
        reached = {int(a) for _, anchors in part.reached(np.array([y], np.uint64)) for a in anchors}
        assert home in reached and int(part.home(np.array([y], np.uint64))[0]) in reached


def test_classes_match_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [[word() for _ in range(rng.randint(1, 150))] for _ in range(25)]
    texts = [None, "", " \n", "one", "One", "a b c"]
    for words in base:
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 6)):
            near = list(words)
            near[rng.randrange(len(near))] = word()
            texts.append(rng.choice([" ", "\n"]).join(near).title())
    texts += [texts[20]] * 40
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = {r.id: r for r in near_duplicates(df).collect()}
    values = [plain_fingerprint(t) for t in texts]
    assert [got[i].fp & (2 ** 64 - 1) for i in range(len(texts))] == values
    assert [got[i].component_id for i in range(len(texts))] == classes(values)
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes(values)))


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(3, "a b c d e", "x", 1), (3, "a b c d e", "x", 1), (7, "A b c d e", "x", 1),
                                (None, "a b c d e", "x", 1), (None, "zz", "x", 1)], SCHEMA)
    got = sorted(((r.id, r.component_id) for r in near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 3), (3, 3), (7, 3), (None, 3), (None, None)], key=str)
    kept = [(r.doc_id, r.text) for r in keep_one(df).collect()]  # one row of each class, a named one if there is any
    assert sorted(kept, key=str) == [(3, "a b c d e"), (None, "zz")]
    assert near_duplicates(df.limit(0)).collect() == []


def test_rows_are_kept_by_class_not_by_id(spark):
    near = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(3, near, "x", 1), (3, "quite another text about nothing at all", "x", 1), (3, near, "x", 0),
                                (9, "a third text that nobody else has written", "x", 1), (9, near.upper(), "x", 1)]
                               + [(None, "zz top of the hill", "x", 1)] * 50 + [(None, "ZZ top of the hill", "x", 1)], SCHEMA)
    got = [(r.doc_id, (r.text or "").split()[0].lower(), r[3]) for r in keep_one(df).collect()]
    assert sorted(got, key=str) == sorted([(3, "one", 0), (3, "quite", 1), (9, "a", 1), (None, "zz", 1)], key=str)


def test_hot_keys_are_tiled_without_losing_a_pair(spark):
    rows = spark.createDataFrame([(1, i, i % 3 == 0) for i in range(50)] + [(2, 99, True)], "k long, m long, home boolean")
    tiles = tile_hot_keys(rows, "k", "m", "home", tile=8).collect()
    assert max(sum(1 for _ in g) for _, g in itertools.groupby(sorted((t.k, t.ti, t.tj) for t in tiles))) < 50
    met = [(a.k, a.m, b.m) for a in tiles for b in tiles
           if (a.k, a.ti, a.tj) == (b.k, b.ti, b.tj) and a.is_left and b.is_right]
    want = [(1, a, b) for a in range(0, 50, 3) for b in range(50)] + [(2, 99, 99)]
    assert sorted(met) == sorted(want)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    edges += [(500, 500 + i) for i in range(1, 40)] + [(7, 7)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(5)
    got = {r.id: r.component_id for r in connected_components(df).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(100):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    assert got == {x: c for x, c in label.items() if any(x in e and e[0] != e[1] for e in edges)}
    u, v = local_components(np.array([5, 4, 9]), np.array([4, 3, 8]))
    assert sorted(zip(u.tolist(), v.tolist())) == [(4, 3), (5, 3), (9, 8)]


@pytest.mark.parametrize("text", ["", "a", "a b c d", "é É"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)
