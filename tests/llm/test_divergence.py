"""Transducers against lists, the audit against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tideline.llm import divergence
from tideline.llm.transducer import Shelf, Transducer

DOCS = "doc_id bigint, text string, lang string, source string, term string, ordinal int, item string, rank int"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def number(term):
    return int.from_bytes(term[:8].ljust(8, b"\0"), "big")


@pytest.mark.parametrize("seed", range(20))
def test_transducer(seed):
    rnd = random.Random(seed)
    terms = sorted({"".join(rnd.choice("abé日") for _ in range(rnd.randint(1, 14))).encode() for _ in range(rnd.randint(1, 60))})
    machine = Transducer.from_bytes(Transducer.of(terms).to_bytes())
    assert [machine.term(i) for i in range(len(terms))] == terms
    cut = rnd.randint(0, len(terms))
    while 0 < cut < len(terms) and number(terms[cut]) == number(terms[cut - 1]):
        cut += 1
    shelf = Shelf.of([(number(p[0]), b, Transducer.of(p)) for p, b in ((terms[:cut], 0), (terms[cut:], cut)) if p])
    asked = [*terms, *(t + b"a" for t in terms), *(t[:-1] for t in terms if len(t) > 1)]
    length = np.array([len(t) for t in asked])
    begin = np.cumsum([0, *(length[:-1] + 1)])
    got = shelf.ordinals(np.frombuffer(b"\0".join(asked), np.uint8), begin, length)
    assert got.tolist() == [terms.index(t) if t in terms else -1 for t in asked]
    assert [shelf.term(i) for i in range(len(terms))] == terms


def test_transducer_is_minimal():
    """Equal endings are stored once: 3 ** 6 words need one state for each length of the rest."""
    words = sorted("".join("abc"[k // 3**i % 3] for i in range(6)).encode() for k in range(3**6))
    assert len(Transducer.of(words).final) == 7
    with pytest.raises(ValueError):
        Transducer.of([b"b", b"a"])


def plain_audit(rows, least=3, top=200):
    found = [(l or "", s or "", [m.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for m in TERM.findall(t or "")]) for t, l, s in rows]
    documents, count, groups = Counter(), Counter(), defaultdict(set)
    for lang, source, terms in found:
        groups[lang].add(source)
        documents.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted((t for l, t in documents if l == lang and documents[l, t] >= least), key=str.encode)

        def shares(counts):
            total = sum(counts.get(t, 0) for t in kept)
            return {t: 1 + 10**9 * (counts.get(t, 0) + 1) // (total + len(kept)) for t in kept}

        own = {s: {t: count[lang, s, t] for t in kept} for s in sources}
        p = {s: shares(own[s]) for s in sources}
        q = shares({t: sum(own[s][t] for s in sources) for t in kept})
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(items[:most])]
    return sorted(out)


def audited(spark, rows, **more):
    docs = spark.createDataFrame([(k, t, l, s, "x", 1, "y", 2) for k, (t, l, s) in enumerate(rows)], DOCS)
    return sorted(map(tuple, divergence.divergence_report(docs.repartition(3), **more).collect()))


def some_rows(seed, n=90):
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "BETA", "Ärger", "ärger", "日本", "a", "ab", "abc", "internationalisation", "internationalisations", "𝄞", "x1y"]
    hot = ["h"] * 3
    return [
        (" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))), rnd.choice(["de", "de", "en", None, ""]), rnd.choice([*hot, "b", "ä", None]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_python(spark, seed):
    rows = some_rows(seed)
    assert audited(spark, rows) == plain_audit(rows)


def test_blocks_ranges_and_groups_of_ordinals_change_nothing(spark, monkeypatch):
    rows = some_rows(5)
    monkeypatch.setattr(divergence, "ORDINALS", 4)
    monkeypatch.setattr(divergence, "HELD", 3)
    assert audited(spark, rows, range_terms=2, block_bytes=1, top=2) == plain_audit(rows, top=2)


def test_odd_rows(spark):
    rows = [
        (None, None, None), ("", "de", "a"), ("1 2 3 _", "de", "b"), ("same same", "en", "a"), ("same same", "en", "a"),
        ("Same", "en", "b"), ("long " * 30_000, "en", "b"), ("rare", "fr", "a"), ("x" * 50_000, "en", "c"),
    ]
    assert audited(spark, rows) == plain_audit(rows)
    assert audited(spark, []) == []
    assert audited(spark, [("one", "de", "a")]) == []
