"""Mixing against plain Python: targets, the queue, and odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from tideline.llm import mixing

DOCS = "doc_id bigint, text string, source string, size string, target int, taken boolean, name string, position int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, True, "n", 9) for i, t, s in rows], DOCS)


def plain_targets(sizes, share=1.5, repeats=2):
    """As the contract says it: share by weight, stop at the limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    open_, budget, target = set(names), share * sum(sizes.values()), {}
    while open_:
        per = budget / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * per >= repeats * sizes[s]}
        for s in full:
            target[s] = float(repeats * sizes[s])
            budget -= target[s]
        if not full:
            target |= {s: weight[s] * per for s in open_}
            break
        open_ -= full
    return target


def plain_mix(rows, share=1.5, repeats=2):
    sized = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    sizes = defaultdict(int)
    for _, n, s in sized:
        sizes[s] += n
    target = plain_targets(sizes, share, repeats)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    copies = []
    for place, s in enumerate(order):
        mine = [k for k, r in enumerate(sized) if r[2] == s]
        number = lambda k: int(hashlib.md5(str(sized[k][0]).encode()).hexdigest()[:15], 16) if sized[k][0] is not None else -1
        mine.sort(key=lambda k: (number(k), sized[k][0] is not None, sized[k][0] or 0, sized[k][1]))
        sent = 0
        for k in mine:
            sent += sized[k][1]
            if sized[k][1]:
                copies += [((r * sizes[s] + sent) / target[s], place, r, sent, k) for r in range(repeats)]
    total, taken = 0, Counter()
    for *_, k in sorted(copies):
        total += sized[k][1]
        if total > share * sum(sizes.values()):
            break
        taken[k] += sized[k][1]
    return Counter((i, n, sizes[s], round(target[s], 6), taken[k]) for k, (i, n, s) in enumerate(sized)), target


def mixed(docs, **more):
    out = mixing.mix(docs, **more).select("doc_id", "size", "source_size", "target", "taken").collect()
    return Counter((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in out)


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_python(spark, seed):
    rnd = random.Random(seed)
    names = ["b", "a", "é", "𝄞", "ｚ", None, "", "z"][: rnd.randint(2, 8)]
    hot = [names[0]] * len(names)
    rows = [(rnd.choice([k, k, 7]), " ".join(["w"] * rnd.choice([0, 1, 3, 40])), rnd.choice(names + hot)) for k in range(120)]
    want, target = plain_mix(rows)
    assert mixed(frame(spark, rows).repartition(5)) == want
    total = sum(k[1] * n for k, n in want.items())
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6


def test_odd_rows(spark):
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "one two", None), (3, "one two", None), (None, "x \t\n y z", "b"),
        (5, "word " * 30_000, "b"), (6, "é ü", "c"), (7, None, None), (8, " ", "empty"),
    ]
    want, _ = plain_mix(rows)
    got = mixed(frame(spark, rows))
    assert got == want
    assert all(k[4] <= 2 * k[1] for k in got) and got[(8, 0, 0, 0.0, 0)] == 1


def test_none_and_sources_without_words(spark):
    assert mixed(frame(spark, [])) == Counter()
    assert mixed(frame(spark, [(1, None, "a"), (2, "", None)])) == {(1, 0, 0, 0.0, 0): 1, (2, 0, 0, 0.0, 0): 1}


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    rows = [(k, "w " * (1 + k % 50), f"s{min(k % 9, 4)}") for k in range(3000)]
    first = mixed(frame(spark, rows))
    assert first == mixed(frame(spark, rows[::-1]).repartition(7))
    out = mixing.mix(frame(spark, rows)).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert len(out) == 5
    for r in out:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 50


def test_other_weights_and_rounds(spark):
    rows = [(k, "w " * (k % 7), "abc"[k % 3]) for k in range(60)]
    out = mixing.mix(frame(spark, rows), weights=(1, 5), share=2.5, repeats=4).collect()
    assert all(r["taken"] <= 4 * r["size"] for r in out)
    assert abs(sum(r["taken"] for r in out) - 2.5 * sum(r["size"] for r in out)) <= 7


def test_rows_stay_in_the_engine(spark):
    plan = mixing.mix(frame(spark, [(1, "a b", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
