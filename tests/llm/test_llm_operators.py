"""Operators on small fixtures: nulls, empty and long texts, ties, repeats, clashing columns, no rows."""

import hashlib
import itertools
import json
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.llm import (
    bpe, chat, exact_dedup, langid, packing, quality, simhash, token_rollup, toxicity, url_rules,
)
from tideline.llm.queries import tokenizer_path

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, digest int, fp string, score string"
PATH = tokenizer_path()


def rows_of(texts):
    return [(i, t, "en", "s", 0, True, 7, "x", "y") for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    long = "word " * 20_000
    texts = [
        (3, "a  b\tc d"), (1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (None, "ab cd"),
        (5, None), (6, ""), (7, " \n\t"), (8, long), (9, "é" * 50_000), (10, "x<|endoftext|>y"), (11, "日本語 ǅ"),
    ]
    return spark.createDataFrame(rows_of(texts), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id bigint, quality int, toxic int, text string"


# Exact duplicates


def plain_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join((t or "").split(" ")).translate({9: "", 10: "", 11: "", 12: "", 13: ""}), []).append((i, t or ""))
    out = []
    for key, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        sha = hashlib.sha256(key.encode()).hexdigest()
        first = True
        for i, t in sorted(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0)):
            out.append((i, best[0], len(members), first, sha))
            first = False
    return Counter(out)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.length(c).cast("string").cast("binary")])
def test_exact_groups(spark, odd, digest):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    out = exact_dedup.duplicate_report(odd, digest=digest).collect()
    want = plain_groups(rows)
    drop = slice(0, 4)
    assert Counter(tuple(r)[drop] for r in out) == sum((Counter({k[drop]: v}) for k, v in want.items()), Counter())
    if digest is exact_dedup.sha256:
        assert Counter(map(tuple, out)) == want
    kept = exact_dedup.drop_duplicates(odd, digest=digest)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(k[0] for k in want.elements() if k[3])


def test_exact_none(none):
    assert exact_dedup.duplicate_report(none).count() == 0
    assert exact_dedup.drop_duplicates(none).count() == 0


# BPE and packing


def test_bpe_round_trip(odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for row in odd.collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want[row["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.round_trip_report(odd, PATH).collect())) == want


def test_bpe_joins():
    codec, rng = bpe.codec(PATH), random.Random(5)
    alphabets = ["aeiou th'sre", "  \n\t\u3000x", "日本語é", "ha", "'lld ve", "12 !?", "<|endoftext|>"]
    for _ in range(400):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 120)))
        parts = bpe.halves(text, rng.randint(1, 9))
        whole = codec.tokenizer.encode(text, add_special_tokens=False).ids
        assert codec.joined([codec.encode(p) for p in parts]).tolist() == whole


def test_bpe_other_file(spark, odd):
    path = tokenizer_path("word_bpe_49k.json")
    assert bpe.codec(path).fast is None
    got = {r["doc_id"]: r["ids"] for r in bpe.encode_documents(odd.where("doc_id IN (1, 8, 11)"), path).collect()}
    for row in odd.where("doc_id IN (1, 8, 11)").collect():
        ids = bpe.codec(path).tokenizer.encode(row["text"], add_special_tokens=False).ids
        assert np.frombuffer(got[row["doc_id"]], "<u4").tolist() == ids


def test_packing(odd, none):
    ids = bpe.encode_documents(odd, PATH)
    want = Counter((r["doc_id"], bytes(r["ids"]) + b"\1\0\0\0") for r in ids.collect())
    pieces = packing.decompose(ids, 64).toPandas()
    assert pieces["sequence_id"].is_unique and (pieces["offset"] == 0).all()
    assert (pieces["length"] == 2 ** pieces["bucket"]).all() and (pieces["length"] <= 64).all()
    assert (pieces["piece_ids"].map(len) == 4 * pieces["length"]).all()
    got = Counter()
    for (doc, n), part in pieces.fillna({"doc_id": -1}).groupby(["doc_id", "doc_tokens"]):
        copies = (part["start"] == 0).sum()
        part = part.sort_values("start", kind="stable").iloc[::copies] if copies > 1 else part.sort_values("start")
        assert part["start"].tolist() == [0, *part["length"].cumsum().tolist()[:-1]]
        got[None if doc == -1 else doc, b"".join(map(bytes, part["piece_ids"]))] += copies
    assert got == want
    assert packing.packing_report(none, PATH).count() == 0


def test_packing_buckets(spark, odd, tmp_path):
    report = packing.packing_report(odd, PATH).toPandas()
    assert (report["length"] == 2 ** report["bucket"]).all()
    packing.write_buckets(packing.pack_documents(odd, PATH), str(tmp_path / "buckets"))
    folders = {f.name for f in (tmp_path / "buckets").glob("bucket=*")}
    assert folders == {f"bucket={k}" for k in report["bucket"]}
    for folder in folders:
        part = spark.read.parquet(str(tmp_path / "buckets" / folder))
        length = 2 ** int(folder.removeprefix("bucket="))
        assert {tuple(r) for r in part.select("length", F.length("piece_ids")).distinct().collect()} == {(length, 4 * length)}
        assert part.count() == (report["length"] == length).sum()


# Conversations


def test_reply_trees(spark):
    rows = [
        ("t", 1, None, "user", "q <|im_end|> 100%", 0.0), ("t", 2, 1, "assistant", "a<\\|x", 1.0),
        ("t", 3, 1, "assistant", "b", 5.0), ("t", 4, 3, "us%0Aer\n", None, 5.0), ("t", 5, 2, "user", "z", 1.0),
        ("t", 5, 2, "user", "z", 1.0), (None, 1, 99, "assistant", "", None), (None, None, 1, None, "\n<|", None),
    ]
    frame = spark.createDataFrame(rows, "tree string, node int, parent int, role string, text string, score double")
    out = chat.format_reply_trees(frame)
    told = {
        r["tree"]: ([tuple(t) for t in r["turns"]], r["loss"])
        for r in out.select("tree", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    }
    assert told["t"] == ([("user", "q <|im_end|> 100%"), ("assistant", "b"), ("us%0Aer\n", "")], ["b"])
    assert told[None] == ([("assistant", ""), ("", "\n<|")], [""])
    assert all(r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") for r in out.collect())


def test_reply_cycle(spark):
    frame = spark.createDataFrame([("t", 1, 2, "user", "a", 0.0), ("t", 2, 1, "user", "b", 0.0)], "tree string, node int, parent int, role string, text string, score double")
    with pytest.raises(ValueError):
        chat.format_reply_trees(frame).collect()


def test_chat_edges(spark):
    rows = spark.createDataFrame(
        [(1, 2, "user", "b", 9), (1, 0, "assistant", "a", 9), (1, 2, "user", "b", 9), (None, None, None, None, 9)],
        "conv_id bigint, turn bigint, role string, text string, tree int",
    )
    out = {r["conv_id"]: r for r in chat.chat_report(spark, rows).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert out[1]["turns_sha256"] == sha("assistant\na\nuser\nb\nuser\nb\n") and out[1]["loss_sha256"] == sha("a")
    assert out[-1]["n_turns"] == 2 and out[-1]["loss_chars"] == len("<|im_end|><|im_start|>assistant ok")
    assert out[None]["turns_sha256"] == sha("\n\n")
    assert [r["conv_id"] for r in chat.chat_report(spark, rows.limit(0)).collect()] == [-1]


# SimHash


def linked(fps):
    root = {i: i for i in range(len(fps))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("bucket", [4096, 3])
def test_fingerprint_links(spark, bucket):
    rng = random.Random(3)
    fps = [0, 0]
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 40])):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5)))
            fps.append(base)
    want = linked(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    prints = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint")
    groups = {r["fp"]: r["component_id"] for r in simhash.fingerprint_groups(prints, bucket).collect()}
    assert [groups[f] for f in signed] == want


def test_components_of_a_hub(spark):
    star = [(i, 0) for i in range(1, 4000)]
    late = [(9000, i) for i in range(5000, 8000)]  # the largest node is the hub
    chain = [(i + 1, i) for i in range(10_000, 10_040)]
    pairs = spark.createDataFrame([*star, *late, *chain], "a bigint, b bigint")
    out = simhash.components(pairs).collect()
    want = {i: 0 for i in range(4000)} | {i: 5000 for i in [*range(5000, 8000), 9000]} | {i: 10_000 for i in range(10_000, 10_041)}
    assert len(out) == len(want) and {r["node"]: r["root"] for r in out} == want


def test_simhash_edges(odd, none):
    out = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicate_report(odd).collect()}
    assert {r[2] for r in out if r[0] in (5, 6, 7)} == {5} and {r[1] for r in out if r[0] == 5} == {"0" * 16}
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 3 not in ids and len(ids) == len(set(ids)) == len({r[2] for r in out})
    assert simhash.near_duplicate_report(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


# Language


def test_code_lengths():
    texts = {"aa": "the cat sat on the mat", "bb": "der hund und die maus"}
    counts = []
    for lang, text in texts.items():
        counts += [(lang, int(c), 1) for c in langid._codes(text)]
    model = langid.ByteTrees.of(pd.DataFrame(counts, columns=["lang", "code", "n"]))

    def plain(lang, text):
        raw, new = (b"\n\n\n" + t.encode() for t in (texts[lang], text))
        seen = {}
        for i in range(3, len(raw)):
            for k in range(4):
                seen.setdefault(raw[i - k : i], Counter())[raw[i]] += 1
        bits = 0.0
        for i in range(3, len(new)):
            for k in range(3, -1, -1):
                after = seen.get(new[i - k : i])
                if after is None:
                    continue
                whole = sum(after.values()) + len(after)
                if new[i] in after:
                    bits -= math.log2(after[new[i]] / whole)
                    break
                bits -= math.log2(len(after) / whole)
            else:
                bits += 8
        return bits

    for text in ("the dog", "die maus", "zz ü", ""):
        got = model.code_lengths(text)
        assert got == pytest.approx([plain("aa", text), plain("bb", text)])


def test_language_edges(spark, odd, none):
    model = langid.train(spark.createDataFrame([(1, "der hund", "de"), (2, "the dog", "en"), (3, None, "fr"), (4, "x", None)], "doc_id bigint, text string, lang string"))
    assert model.languages == ["de", "en"]
    out = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()]
    assert {r[1:] for r in out if r[0] in (5, 6, 7)} == {("und", 0.0)}
    assert all(r[1] in model.languages and 0 <= r[2] <= 1 for r in out if r[0] in (1, 8, 9, 11))
    assert langid.language_report(spark, none).count() == 0
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}


def test_rare_language(spark):
    """One short text beside several hundred thousand counts of other languages keeps its whole tree."""
    rng = random.Random(2)
    many = [(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789 ", k=2000)), f"l{i % 5}") for i in range(400)]
    rare = "жук и рак"
    frame = spark.createDataFrame([*many, (400, rare, "zz")], "doc_id bigint, text string, lang string")
    model = langid.train(frame)
    assert model.languages == ["l0", "l1", "l2", "l3", "l4", "zz"]
    assert len(np.unique(np.concatenate([langid._codes(t) for _, t, _ in many]))) > 400_000
    found = langid.predict(frame.where("doc_id = 400"), model).first()
    assert found["lang_pred"] == "zz" and found["score"] > 0.99
    # Blocks give what one table of all languages gives.
    counts = pd.DataFrame([(lang, int(c), 1) for _, t, lang in [*many[:10], (400, rare, "zz")] for c in langid._codes(t)], columns=["lang", "code", "n"])
    blocks, one = langid.Languages.of(counts), langid.ByteTrees.of(counts)
    assert len(blocks.blocks) == 2 and blocks.languages == one.languages
    for text in (rare, "abc 012", "ü"):
        assert blocks.code_lengths(text) == pytest.approx(one.code_lengths(text))


# Toxicity


def test_toxicity(spark, odd, none):
    rng = random.Random(1)
    plain = [f"w{i}" for i in range(60)]
    rows, marks = [], []
    for i in range(300):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["awful", "nasty"])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad), "clash"))
    docs = spark.createDataFrame(rows_of(rows), DOCS)
    out = toxicity.toxicity_report(docs, spark.createDataFrame([*marks, (0, None, None, None), (None, 1, 1, "")], LABELS)).collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == 300 and all(0 <= r["score"] <= 1 for r in out)
    bad, good = ([r["score"] for r in held if (r["doc_id"] % 4 == 0) == k] for k in (True, False))
    assert sum(b > g for b in bad for g in good) > 0.95 * len(bad) * len(good)
    empty = spark.createDataFrame([], LABELS)
    assert {r["predicted"] for r in toxicity.toxicity_report(odd, empty).collect()} == {0}
    assert toxicity.toxicity_report(none, empty).count() == 0
    model = toxicity.train_on_folds(docs, spark.createDataFrame(marks, LABELS))
    assert model.score(None) == model.score("") and toxicity.scored(odd, model).count() == odd.count()


# Quality


def test_quality_list(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        symbols, upper = rng.random() * 0.3, rng.random()
        bad = int(symbols > 0.2 or upper > 0.9)
        rows.append((bad, i % 3, symbols, 0.0, 0.0, rng.random(), rng.random(), upper, 0.0, 5.0))
    stats = spark.createDataFrame(rows, "bad int, fold int, " + ", ".join(f"{f} double" for f in quality.FEATURES))
    learned = quality.learn(stats)
    assert {c.feature for rule in learned.rules for c in rule} <= {"symbols", "upper"} and learned.rules
    judged = stats.select("bad", learned.kept().alias("kept"), learned.reason().alias("why")).collect()
    assert sum(r["kept"] != (r["bad"] == 0) for r in judged) < 0.1 * len(judged)
    assert all((r["why"] is None) == r["kept"] for r in judged)


def test_quality_edges(spark, odd, none):
    empty = spark.createDataFrame([], LABELS)
    out = {r["doc_id"]: r for r in quality.quality_report(odd, empty).collect()}
    assert [out[5][c] for c in quality.BASE] == [0] * 5 and out[5]["base_failed"] and not out[5]["kept"]
    assert out[8]["n_words"] == out[8]["n_repeat_words"] == 20_000 and out[8]["base_failed"]
    assert quality.quality_report(none, empty).count() == 0
    kept = quality.drop_bad(odd, quality.DecisionList())
    assert kept.columns == odd.columns and kept.count() == 0


# URLs


def test_url_rules(spark):
    urls = [
        ("http://a.example.org/en/12?x", "a.example.org", "/en/12", "example.org/en/1", "block"),
        ("HTTP://EXAMPLE.org", "example.org", "", None, "allow"),
        ("x://y.com/fr/#k", "y.com", "/fr/", "com/fr/", "allow"),
        ("x://com/de/", "com", "/de/", "com/de/", "block"),
        ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("a://b\nc/d\n://e/f", "b\nc", "/d\n://e/f", None, "allow"),
    ]
    spam = [(f"http://spam{i % 3}.net/buy/{i}.html", None, None, None, "block") for i in range(60)]
    good = [(f"http://fine{i % 3}.net/read/{i}.html", None, None, None, "allow") for i in range(60)]
    rows = [(i, u[0], 1) for i, u in enumerate([*urls, *spam, *good])]
    pages = spark.createDataFrame([*rows, (None, "x://com/de/", 1)], "page_id bigint, url string, host int")
    labels = spark.createDataFrame([(i, int(not 8 <= i < 68), 0, "") for i in range(128)] + [(None, 0, 0, "")], LABELS)
    out = {r["page_id"]: r for r in url_rules.judge_urls(pages, labels).collect()}
    assert len(out) == 129 and out[None]["verdict"] == "block"
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert tuple(out[i])[:5] == (i, host, path, rule, verdict)
    assert {out[i]["verdict"] for i in range(8, 68)} == {"block"} and {out[i]["verdict"] for i in range(68, 128)} == {"allow"}
    assert all(out[i]["mined_rule"] for i in range(8, 68))
    assert url_rules.judge_urls(pages.limit(0), labels).count() == 0
    assert url_rules.judge_urls(pages, labels.limit(0)).count() == 129


def test_url_deep_segments(spark):
    """Third and further segments tell bad from good, beside paths with many common ones."""
    common = "/".join(f"part{chr(97 + k)}" for k in range(24))
    urls = [f"http://x{i % 3}.net/a/b/{'casino' if i % 2 else 'garden'}/{i}" for i in range(80)]
    urls += [f"http://x.net/a/b/{common}/{'dice' if i % 2 else 'tree'}" for i in range(80)]
    pages = spark.createDataFrame([*enumerate(urls), (160, "http://new.net/c/d/e/casino/7")], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0, "") for i in range(160)], LABELS)
    out = {r["page_id"]: r for r in url_rules.judge_urls(pages, labels).collect()}
    assert {out[i]["verdict"] for i in range(1, 160, 2)} == {"block"} and out[160]["verdict"] == "block"
    assert {out[i]["verdict"] for i in range(0, 160, 2)} == {"allow"}
    assert out[160]["confidence"] == 1.0 and "p=casino" in out[160]["mined_rule"]


def test_url_rules_of_many_deep_segments(spark):
    """Only all five segments together tell bad from good, whatever lies between them."""
    five = ["red", "blue", "green", "pink", "grey"]
    urls = [f"http://x.net/a/b/{'/'.join(five)}/{'qrstuv'[i % 6]}/end" for i in range(60)]
    urls += [f"http://x.net/a/b/{'/'.join(w for w in five if w != five[i % 5])}/{'qrstuv'[i % 6]}/end" for i in range(300)]
    pages = spark.createDataFrame([*enumerate(urls), (360, "http://y.net/c/d/" + "/".join(reversed(five)))], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, int(i >= 60), 0, "") for i in range(360)], LABELS)
    out = {r["page_id"]: r for r in url_rules.judge_urls(pages, labels).collect()}
    assert {i for i, r in out.items() if r["verdict"] == "block"} == {*range(60), 360}
    assert out[360]["mined_rule"] == " ".join(f"p={w}" for w in sorted(five)) and out[360]["confidence"] == 1.0


def test_deep_rules_against_all_combinations(spark):
    """The best rule of each set of tokens is as good as the best of all combinations, listed one by one."""
    rng = random.Random(5)
    names = ["p=a", "p=b", "p=c", "p=d", "p=e", "p0=s", "h0=t"]
    rows = []
    for _ in range(300):
        held = sorted({rng.choice(names[:5])} | {t for t in names if rng.random() < 0.6})
        rows.append((held, rng.random() < (0.9 if {"p=a", "p=c", "p=d", "h0=t"} <= set(held) else 0.4)))
    frame = spark.createDataFrame([(h + ["label=block"] * b,) for h, b in rows], "items array<string>")
    got = {tuple(r["tokens"]): (r["confidence"], r["support"]) for r in url_rules.deep_rules(frame, 300, 0.02, 0.5).collect()}
    every = {}
    for size in range(1, 8):
        for tokens in itertools.combinations(sorted(names), size):
            hits = [b for h, b in rows if set(tokens) <= set(h)]
            if any(t.startswith("p=") for t in tokens) and sum(hits) >= 6 and sum(hits) / len(hits) >= 0.5:
                every[tokens] = (sum(hits) / len(hits), sum(hits) / 300)
    assert got.items() <= every.items() and max(map(len, got)) > 3
    best = lambda rules, held: max((v for k, v in rules.items() if set(k) <= set(held)), default=None)
    assert all(best(got, h) == best(every, h) for h, _ in rows)


# Token counts


def test_rollup(spark, odd, none, tmp_path):
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "rollup"))
    assert rollup.totals().count() == 0
    counts = token_rollup.counted(odd, PATH, "v1")
    assert counts.count() == odd.count()
    assert rollup.commit("1", token_rollup.inserts(counts)) and not rollup.commit("1", token_rollup.inserts(counts))
    whole = rollup.totals().first()
    assert (whole["documents"], whole["tokens"]) == (odd.count(), counts.agg(F.sum("tokens")).first()[0])
    part = counts.where("doc_id = 8")
    rollup.commit("2", token_rollup.revisions(part, part.withColumn("version", F.lit("v2"))))
    assert {r["version"]: r["documents"] for r in rollup.totals().collect()} == {"v1": odd.count() - 1, "v2": 1}
    # A writer that was lost before its commit leaves sums that nobody reads.
    part.limit(1).select("source", "lang", "version", F.lit(5).cast("bigint").alias("documents"), "tokens").write.parquet(str(tmp_path / "rollup/sums/attempt=lost"))
    rollup.commit("3", token_rollup.deletes(counts.where("doc_id IS DISTINCT FROM 8")))
    rollup.commit("4", token_rollup.deletes(part.withColumn("version", F.lit("v2"))))
    rollup.commit("5", token_rollup.inserts(token_rollup.counted(none, PATH, "v1")))
    assert rollup.totals().count() == 0
    assert json.dumps(token_rollup.KEYS)


def test_rollup_report_ids(spark, tmp_path):
    """Rows that share an id, or have none, are revised each by itself."""
    texts = [(7, "a#b"), (7, "plain"), (None, "c#d|e"), (None, "none"), (8, "x#y"), (8, "bad"), (9, None), (10, "w# " * 20_000), (10, "long " * 20_000)]
    labels = spark.createDataFrame([(8, 1, 1, ""), (None, 1, 1, "")], LABELS)
    out = token_rollup.rollup_report(spark, spark.createDataFrame(rows_of(texts), DOCS), labels, PATH, str(tmp_path / "ids"))
    tokenizer = bpe.codec(PATH).tokenizer
    left = ["".join(c for c in t or "" if c not in "#*$%&|<>") for i, t in texts if i != 8]
    want = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) for t in left)
    assert [(r["documents"], r["tokens"]) for r in out.collect()] == [(len(left), want)]
