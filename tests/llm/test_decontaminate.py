"""Edit matching against the plain dynamic programme."""

import random

from cohortline.llm.decontaminate import Matcher, decontaminate, find_matches, normalise

SCHEMA = "doc_id long, text string, items string, t int"


def distance(item, text):
    """Edits between ``item`` and the nearest stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


def edited(rng, text, n, letters):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        what = rng.random()
        if what < .34:
            out[k] = rng.choice(letters)
        elif what < .67:
            del out[k]
        else:
            out.insert(k, rng.choice(letters))
    return "".join(out)


def test_matcher_against_dynamic_programme():
    rng = random.Random(1)
    for _ in range(250):
        item = normalise("".join(rng.choice("abc ") for _ in range(rng.randint(5, 70)))) or "a"
        around = lambda: "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 40)))
        text = around() + edited(rng, item + "a", rng.randint(0, 9), "abc ") + around()
        for rate in (.08, .15, .3):
            budget = int(len(item) * rate)
            best, found = distance(item, text), Matcher([(1, item)], rate)(text)
            assert bool(found) == (best <= budget)
            if found:
                d, a, b = found[1]
                assert best <= d <= budget and 0 <= a <= b <= len(text)


def test_queries_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("aeiknrst") for _ in range(rng.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randint(4, 25))) for i in range(12)] + [(50, None), (51, " !!"), (None, "x y"), (52, "Twice told"), (53, "twice, TOLD")]
    docs = [None, "", prose(80)]
    for i, t in items[:12]:
        docs += [prose(20) + "\n" + t.upper().replace(" ", ",  ") + "! " + prose(9),
                 prose(10) + " " + edited(rng, t, 2, "aeint ") + " " + prose(10),
                 prose(10) + " " + edited(rng, t, len(t) // 3, "aeint ") + " " + prose(10)]
    docs += ["it was twice told", docs[3], prose(3000) + " " + items[0][1]]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], SCHEMA).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1_000_000, 200):
        got = {r.id: [x.item_id for x in r["items"]] for r in find_matches(df, bench, block_chars=block).collect()}
        for i, t in enumerate(docs):
            want = [k for k, x in items if k is not None and normalise(x)
                    and (len(t or "") < 9000 and distance(normalise(x), normalise(t)) <= int(len(normalise(x)) * .08)
                         or normalise(x) in normalise(t))]
            assert got[i] == want, i
    clean = decontaminate(df, bench)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, w in got.items() if not w)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", "x", 1)], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(df, none).count() == 1
    assert find_matches(df, none).first()["items"] == []
    assert find_matches(df.limit(0), none).collect() == []
