"""Each operator on odd tables, on empty ones, and against a brute-force version."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import bpe, bytecnn, licenses, lm, naming, nearness, packing, rules, sharding, templates

from .conftest import ODD, WORD, lower

SCHEMA = "doc_id long, text string, source string"


def table(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, source) for i, t in enumerate(texts)], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


LETTERS = str.maketrans("0123456789", "abcdefghij")


def words(n, seed, vocabulary=200):
    """Words of letters only."""
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}".translate(LETTERS) for _ in range(n)]


# 1 ------------------------------------------------------------------------------------------------


def check_shards(got, docs, shards):
    assert len(got) == len(docs)
    size = Counter()
    for shard in {r["shard"] for r in got}:
        inside = sorted((r for r in got if r["shard"] == shard), key=lambda r: r["slot"])
        assert [r["slot"] for r in inside] == list(range(len(inside)))
        size[shard] = sum(r["size"] for r in inside)
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in docs)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want
    largest = max(s for s, _ in want)
    mean = sum(s for s, _ in want) / shards
    assert all(abs(size[k] - mean) <= largest for k in range(shards))
    # One order over all records: by crc and id, cut at the bytes.
    key = lambda r: (r["text_crc32"], -(2**63) if r["doc_id"] is None else r["doc_id"])
    assert [key(r) for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))] == sorted(map(key, got))


def test_shards(spark, odd):
    check_shards(rows(sharding.shard(odd, shards=3)), ODD, 3)


def test_shards_of_a_hot_text(spark):
    docs = [(i, "same text here") if i % 3 else (i, " ".join(words(i % 50, i))) for i in range(1500)]
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], SCHEMA)
    got = rows(sharding.shard(df, samples_per_cell=4))
    check_shards(got, docs, 24)
    check_shards(rows(sharding.shard(df, shards=4, cells_per_shard=2, cell_rows=40)), docs, 4)
    kept = sharding.shard(df, keep_record=True).first()
    assert kept["record"]["source"] == "s"


# 2 ------------------------------------------------------------------------------------------------


def brute_licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    at, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        hits = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        at += hits
        if hits:
            labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_licenses(spark, odd):
    got = rows(licenses.scan_licenses(odd))
    keys = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert sorted(map(str, (tuple(r[k] for k in keys) for r in got))) == sorted(str(brute_licenses(t)) for _, t in ODD)
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0 (the \"License\")", "apache"), ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl"), ("GNU Affero General Public License v3", "agpl,gpl"),
        ("Redistribution and use in source and binary forms, with or without modification", "bsd"), ("Copyright (c) 2020. All rights reserved.", "copyright,proprietary"), ("nothing", ""),
    ],
)
def test_license_rules(text, labels):
    assert licenses.scan(text.encode())["labels"] == labels


def test_contained_detections_give_way():
    spans = licenses.scan(b"released under the terms of the Mozilla Public License, version 2.0")["spans"]
    assert [(s["label"], s["priority"]) for s in spans] == [("mpl", 80)]
    assert len(licenses.build_rules()) > 200


def sample(tree, r):
    """A string that a parsed pattern matches."""
    out = ""
    for op, x in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(x)
        elif op == "ANY":
            out += r.choice("ab ")
        elif op == "IN":
            kind, v = r.choice(x)
            out += chr(v if str(kind) == "LITERAL" else r.randint(*v))
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(sample(x[2], r) for _ in range(r.randint(x[0], min(int(x[1]), x[0] + 2))))
        elif op == "SUBPATTERN":
            out += sample(x[3], r)
        elif op == "BRANCH":
            out += sample(r.choice(x[1]), r)
        else:
            assert op == "ASSERT_NOT", op
    return out


def brute_spans(text, rules):
    """Every rule searched without keywords; intervals taken one by one against all taken before."""
    flat = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))) + " "
    hits = [(-x.priority, m.start() - m.end(), m.start(), k, m.end(), x.label) for k, x in enumerate(rules) for m in re.finditer(f"(?<= )(?:{x.pattern})(?= )", flat)]
    kept = []
    for h in sorted(hits):
        if not any(k[2] <= h[2] and h[4] <= k[4] for k in kept):
            kept.append(h)
    place = lambda p: flat.count(" ", 0, p) - 1
    return sorted((place(h[2]), place(h[4]) + 1, h[5], -h[0]) for h in kept)


def test_signatures_against_brute_force():
    """Samples of all signatures among other words and each other: keywords hide nothing, and spans,
    labels and scores are those of a plain search."""
    import re._parser as parser

    r, rules = random.Random(4), licenses.build_rules()
    made = []
    for x in rules:
        for _ in range(6):
            text = sample(parser.parse(x.pattern), r)
            if re.fullmatch(x.pattern, text) and re.search(f"(?<= )(?:{x.pattern})(?= )", f" {text} "):
                assert x.keyword.decode() in text, x
                made.append(text)
    assert len(made) > 5 * len(rules)
    for _ in range(150):
        text = " ".join(r.choice(made) if r.random() < 0.4 else r.choice(["the", "license", "gnu", "1.0", "Copyright 2020,", "world\n"]) for _ in range(r.randrange(40)))
        got, want = licenses.scan(text.encode()), brute_spans(text, rules)
        assert [tuple(s.values()) for s in got["spans"]] == want
        n_words, n_base, first, last, base = brute_licenses(text)
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == (n_words, n_base, first, last, base)
        assert got["labels"] == ",".join(sorted({s[2] for s in want} | set(filter(None, base.split(",")))))
        assert got["score"] == max([s[3] / 100 for s in want] + [0.6 if n_base else 0.0])


def test_licenses_of_very_long_texts():
    """Twice the text takes about twice the time."""
    import time

    unit, took = b"Licensed under the MIT License, see the GNU General Public License v3. All rights reserved. ", []
    for n in (4_000, 16_000):
        start = time.process_time()
        got = licenses.scan(unit * n)
        took.append(time.process_time() - start)
        assert got["n_base"] == 2 * n and len(got["spans"]) >= 3 * n
    assert took[1] < 10 * took[0] + 0.5


# 3 ------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TRICKY = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n a\n", "don't we'll I'M", "x y　z  ", "  \x1c a", "12345 67a8", "!!! ?? --a", "🙂🙂 é é", "aaaa aaaaaaaa", "ababababa", "<|endoftext|>", "\x00\x01 b", "\t\ttab  x"]


def test_bpe_equals_tiktoken(reference):
    c = bpe.codec()
    r = random.Random(4)
    pool = TRICKY + ["".join(r.choice(" \n\tab'sté世1!.") for _ in range(r.randrange(40))) for _ in range(400)]
    for ids, text in zip(c.encode_batch(pool), pool, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), repr(text)
        assert c.decode(ids) == text.encode()
        starts, ends = c.offsets(ids)
        assert all(text[a:b] or True for a, b in zip(starts, ends, strict=True)) and (not ends or ends[-1] == len(text))


def test_offsets_of_split_characters():
    c = bpe.codec()
    ids = c.encode_batch(["a🫠"])[0]
    starts, ends = c.offsets(ids)
    assert starts[0] == 0 and set(starts[1:]) == {1} and ends[-1] == 2


def test_bpe_digests(spark, odd, reference):
    got = rows(bpe.digests(odd))
    want = [reference.encode_ordinary(t or "") for _, t in ODD]
    assert sorted((r["n_tokens"], r["ids_sha256"]) for r in got) == sorted((len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest()) for i in want)
    assert sorted(r["decoded_sha256"] for r in got) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in ODD)
    back = bpe.decode(bpe.encode(odd, offsets=True))
    assert sorted(r["text"] for r in rows(back)) == sorted(t or "" for _, t in ODD)


# 4 ------------------------------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    often, covered, seen, again = Counter(grams), set(), set(), 0
    for k, g in enumerate(grams):
        if often[g] > 1:
            covered |= {k, k + 1, k + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(covered), failed


def test_rules(spark, odd):
    got = rows(rules.quality_rules(odd))
    keys = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(tuple(r[k] for k in keys) for r in got) == sorted(brute_counts(t) for _, t in ODD)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_lines_are_judged_first(spark):
    good = "\n".join(" ".join(words(9, k, 10**6)) + "." for k in range(12))
    junk = "\n".join("home | about | login | help | contact | imprint | terms" for _ in range(12))
    docs = [good, good + "\nClick here to subscribe!", junk + "\n" + good[:200], good.replace(" ", "*** ")]
    got = {r["doc_id"]: r for r in rows(rules.quality_rules(table(spark, docs), keep_columns=True))}
    assert [got[k]["kept"] for k in range(4)] == [True, True, False, False]
    assert got[1]["n_lines_removed"] == 1 and got[1]["clean_text"] == good and got[0]["record"]["text"] == good


# 5 ------------------------------------------------------------------------------------------------


def test_classifier_learns_and_chunks_cover_all():
    r = random.Random(0)
    clean = [" ".join(words(r.randrange(20, 200), k)) for k in range(160)]
    junk = [t.replace(" ", "*** ") if k % 2 else t.replace("w", "| ") for k, t in enumerate(clean)]
    texts, labels = [t.encode() for t in clean[:120] + junk[:120]], [1] * 120 + [0] * 120
    net = bytecnn.Net().train(texts, labels, epochs=6).freeze()
    right = sum((net.score(t.encode()) >= bytecnn.THRESHOLD) == good for good, ts in ((True, clean[120:]), (False, junk[120:])) for t in ts)
    assert right >= 76
    whole = net.pool(b"ab " * 5000 + b"*** " * 3)
    assert (whole[: bytecnn.FILTERS] >= net.pool(b"ab " * 5000)[: bytecnn.FILTERS] - 1e-6).all()
    f, _ = net._step(b"some text " * 900)
    assert np.allclose(f, net.pool(b"some text " * 900), atol=1e-3)
    assert 0 <= net.score(b"") <= 1


def test_classifier_against_plain_loops(monkeypatch):
    """The network's score place by place, tap by tap and chunk by chunk."""
    monkeypatch.setattr(bytecnn, "CHUNK", 50)
    net = bytecnn.Net(seed=3)
    r = np.random.default_rng(2)
    net.p["b"] = r.normal(0, 0.3, bytecnn.FILTERS).astype(np.float32)
    net.p["c"] = np.array([0.2], np.float32)
    net.freeze()
    p = {k: v.astype(float) for k, v in net.p.items()}
    for text in (b"", b"a", b"abcd", bytes(r.integers(0, 256, 47).tolist()), bytes(r.integers(0, 256, 400).tolist()), "naïve 世界 ".encode() * 40):
        x = list(text) + [0] * max(0, bytecnn.WIDTH - len(text))
        places = range(len(x) - bytecnn.WIDTH + 1)
        out = [[max(0.0, p["b"][f] + sum(p["E"][x[at + k]] @ p["W"][k][:, f] for k in range(bytecnn.WIDTH))) for f in range(bytecnn.FILTERS)] for at in places]
        chunks = [out[a : a + bytecnn.CHUNK - bytecnn.WIDTH + 1] for a in range(0, len(out), bytecnn.CHUNK - bytecnn.WIDTH + 1)]
        best = [[max(row[f] for row in c) for f in range(bytecnn.FILTERS)] for c in chunks]
        features = [max(b[f] for b in best) for f in range(bytecnn.FILTERS)] + [sum(b[f] for b in best) / len(best) for f in range(bytecnn.FILTERS)] + [sum(row[f] for row in out) / len(out) for f in range(bytecnn.FILTERS)]
        z = sum(v * f for v, f in zip(p["V"], features, strict=True)) + p["c"][0]
        assert net.score(text) == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5)


def test_classifier_on_tables(spark, odd):
    docs = table(spark, [" ".join(words(80, k)) if k % 2 else "*** | " * 60 for k in range(300)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    drawn = bytecnn.labelled_sample(docs, labels, 1000, 10_000)
    assert len(drawn) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(300))
    assert len(bytecnn.labelled_sample(docs, labels, 20, 10_000)) == 20
    net = bytecnn.fit(docs, labels, most_rows=200)
    got = rows(bytecnn.score(docs, net))
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in got) >= 295
    assert len(rows(bytecnn.score(odd, net))) == len(ODD)
    assert bytecnn.fit(docs, labels.limit(0)) is None and rows(bytecnn.score(odd, None))[0]["score"] == 0.5
    assert bytecnn.keep_good(docs, net).columns == docs.columns


def test_classifier_learns_from_long_texts(spark):
    docs = table(spark, [("word " if k % 2 else "*|* ") * 2000 for k in range(40)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    drawn = bytecnn.labelled_sample(docs, labels, 100, 4096)
    assert len(drawn) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(40)) and all(len(x) >= 8000 for x, _ in drawn)
    assert len(bytecnn.labelled_sample(docs, labels, 100, 1)) == 1
    net = bytecnn.fit(docs, labels)
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in rows(bytecnn.score(docs, net))) == 40


def test_classifier_steps_do_not_depend_on_spans(monkeypatch):
    texts = [" ".join(words(3000, k)).encode() for k in range(4)]
    whole = bytecnn.Net().train(texts, [0, 1, 0, 1], epochs=2)
    monkeypatch.setattr(bytecnn, "SPAN", 1)
    parts = bytecnn.Net().train(texts, [0, 1, 0, 1], epochs=2)
    assert all(np.allclose(whole.p[k], parts.p[k], atol=1e-3) for k in whole.p)


# 6 ------------------------------------------------------------------------------------------------


def brute_exact(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        stays = ids.index(keep)  # one row, though its id and text may repeat
        out += [(i, keep, len(ids), k == stays, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def test_exact(spark, odd):
    assert sorted((tuple(r.values()) for r in rows(naming.exact_groups(odd))), key=str) == brute_exact(ODD)


def test_exact_names_long_and_hot_texts(spark, monkeypatch):
    monkeypatch.setattr(naming, "BLOCK", 16)
    monkeypatch.setattr(naming, "HOT_SHARE", 20)
    long = " ".join(words(60, 1))
    docs = [long] * 150 + [long + " x"] * 3 + [long[:-1]] * 2 + ["short"] * 60 + [" ".join(words(k % 40, k)) for k in range(200)]
    got = sorted((tuple(r.values()) for r in rows(naming.exact_groups(table(spark, docs)))), key=str)
    assert got == brute_exact(list(enumerate(docs)))


def test_names_do_not_depend_on_hashes(spark, monkeypatch):
    """Blocks whose hashes fall together are told apart by their content."""
    monkeypatch.setattr(naming, "BUCKETS", 1)
    docs = [" ".join(words(k % 7, k % 11)) for k in range(60)]
    assert sorted((tuple(r.values()) for r in rows(naming.exact_groups(table(spark, docs)))), key=str) == brute_exact(list(enumerate(docs)))


# 7 ------------------------------------------------------------------------------------------------


def check_bins(got, capacity):
    bins = defaultdict(list)
    for r in got:
        bins[r["bin_id"]].append(r)
    for held in bins.values():
        assert sum(r["n_tokens"] for r in held) == held[0]["bin_tokens"] <= capacity
        assert len({r["source"] for r in held}) == len(held) == len({r["cluster"] for r in held})
        assert sorted(r["place"] for r in held) == list(range(len(held)))
    return bins


def test_packing(spark, odd):
    got = rows(packing.best_fit(odd, capacity=64, group_rows=5))
    check_bins(got, 64)
    tokens = defaultdict(int)
    for r in got:
        tokens[r["doc_id"]] += r["n_tokens"]
    want = defaultdict(int)
    for i, t in ODD:
        want[i] += len(WORD.findall(t or "")) + 1
    assert tokens == want


def test_packing_finds_the_tightest_compatible_bin():
    # 6 and 5 open bins; 4 fits the first exactly but for its source, so it goes to the next tightest.
    assert packing.pack([(6, 0, 0), (5, 1, 1), (4, 0, 2), (3, 2, 3)], 10) == [0, 1, 1, 0]
    assert packing.pack([(5, 0, 0), (5, 1, 0), (5, 2, 1)], 10) == [0, 1, 0]


def naive_bins(items, capacity):
    """Every bin looked at for every piece."""
    bins, out = [], [None] * len(items)
    for k in sorted(range(len(items)), key=lambda k: -items[k][0]):
        size, source, cluster = items[k]
        fits = [(b["room"], n) for n, b in enumerate(bins) if b["room"] >= size and source not in b["sources"] and cluster not in b["clusters"]]
        if fits:
            out[k] = min(fits)[1]
        else:
            out[k] = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        b = bins[out[k]]
        b["room"] -= size
        b["sources"].add(source)
        b["clusters"].add(cluster)
    return out


def test_packing_against_every_bin():
    r = random.Random(6)
    for _ in range(60):
        items = [(r.randrange(1, 41), r.randrange(r.choice([2, 9])), r.randrange(30)) for _ in range(r.randrange(120))]
        assert packing.pack(items, 40) == naive_bins(items, 40)


def test_packing_with_a_hot_source(spark):
    df = spark.createDataFrame([(k, " ".join(words(k % 30, k)), "hot" if k % 3 == 0 else f"s{k % 17}") for k in range(900)], SCHEMA)
    bins = check_bins(rows(packing.best_fit(df, capacity=64, group_rows=200)), 64)
    assert sum(len(b) for b in bins.values()) == 900


# 8 ------------------------------------------------------------------------------------------------


def test_lm(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 300)  # leaves words to the join
    r = random.Random(1)
    texts = [" ".join(x for _ in range(r.randrange(5, 60)) for x in (("The", f"n{r.randrange(400)}") if r.random() < 0.8 else ("is", "so"))) for _ in range(400)] + ["", None]
    docs = table(spark, texts)
    got = {x["doc_id"]: x for x in rows(lm.score_corpus(docs))}
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    toks = {i: WORD.findall(lower(t or "")) + [None] for i, t in enumerate(texts)}
    c = Counter(w for i, ws in toks.items() if not out(i) for w in ws)
    total, distinct = sum(c.values()), len(c)
    for i, ws in toks.items():
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws)
        g = got[i]
        assert (g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (out(i), len(ws), sum(c[w] > 0 for w in ws), total)
        assert g["base_score"] == pytest.approx(base) and g["score"] <= 0
    assert sum(g["score"] for g in got.values() if g["held_out"]) > sum(g["base_score"] for g in got.values() if g["held_out"])


def test_lm_is_normalised(monkeypatch):
    """Every context's probabilities add up to one, and the scores are those of a plain softmax."""
    monkeypatch.setattr(lm, "HEADS", 20)
    n, r = 160, np.random.default_rng(1)
    model = lm.LogBilinear(np.arange(n, 0, -1, dtype=float))
    for _ in range(30):
        model.step(*r.integers(0, n, (3, 512)), r)
    second, first = (np.repeat(r.integers(0, n, 40), n) for _ in range(2))
    w = np.tile(np.arange(n), 40)
    got = model.log10(second, first, w)
    assert np.allclose((10 ** got.reshape(-1, n)).sum(axis=1), 1, atol=1e-4)
    p = {k: v.astype(float) for k, v in model.p.items()}
    for k in r.integers(0, len(w), 200):
        h = p["R"][first[k]] @ p["C1"] + p["R"][second[k]] @ p["C2"]
        kinds = np.exp(p["K"] @ h + p["a"])
        c = model.kind[w[k]]
        inside = np.arange(model.starts[c], model.starts[c + 1])
        own = np.exp(p["Q"][inside] @ h + p["b"][inside])
        want = kinds[c] / kinds.sum() * (own[w[k] - inside[0]] / own.sum() if len(inside) > 1 else 1)
        assert got[k] == pytest.approx(math.log10(want), abs=1e-4)


def test_lm_step_follows_the_gradient(monkeypatch):
    """A step's move of each weight has the sign of the loss's slope, taken by differences."""
    monkeypatch.setattr(lm, "HEADS", 4)
    n, r = 30, np.random.default_rng(3)
    second, first, w = r.integers(0, n, (3, 64))

    class Fixed:
        """Draws that repeat."""

        def __init__(self):
            self.r = np.random.default_rng(8)

        def random(self, shape):
            return np.random.default_rng(8 + int(np.prod(shape))).random(shape)

    model = lm.LogBilinear(np.arange(n, 0, -1, dtype=float))

    def loss(p):
        h = p["R"][first] @ p["C1"] + p["R"][second] @ p["C2"]
        c = model.kind[w]
        log = lambda x: np.log(1 / (1 + np.exp(-x)))
        drawn = np.minimum(np.searchsorted(model.class_run, Fixed().random(lm.SHARED) * model.class_run[-1]), len(model.class_noise) - 1)
        total = -log((h * p["K"][c]).sum(axis=1) + p["a"][c] - model.class_bar[c]).sum() - log(-(h @ p["K"][drawn].T + p["a"][drawn] - model.class_bar[drawn])).sum()
        kinds = np.unique(c[w >= 4])
        u = model.run[model.starts[kinds]][:, None] + model.class_noise[kinds][:, None] * Fixed().random((len(kinds), lm.NOISE))
        others = np.clip(np.searchsorted(model.run, u, side="right") - 1, model.starts[kinds][:, None], model.starts[kinds + 1][:, None] - 1)
        for t in np.flatnonzero(w >= 4):
            o = others[np.searchsorted(kinds, c[t])]
            total += -log(h[t] @ p["Q"][w[t]] + p["b"][w[t]] - model.bar[w[t]]) - log(-(p["Q"][o] @ h[t] + p["b"][o] - model.bar[o])).sum()
        return total

    before = {k: v.astype(float).copy() for k, v in model.p.items()}
    model.step(second, first, w, Fixed())
    for name in ("R", "K", "a", "C1", "C2"):
        moved = model.p[name] - before[name]
        for at in zip(*(r.integers(0, s, 12) for s in moved.shape), strict=True):
            up, down = ({k: v.copy() for k, v in before.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            assert abs(slope) < 1e-3 or np.sign(moved[at]) == -np.sign(slope)


def test_lm_tells_words_apart_beyond_the_most_frequent(spark):
    """Pairs of 400 words of equal count: each word is known by the one before it."""
    r = random.Random(2)
    pairs = [(f"a{k}", f"b{k}") for k in range(400)]
    texts = [" ".join(x for _ in range(25) for x in pairs[r.randrange(400)]) for _ in range(1200)]
    scorer, counts = lm.fit(table(spark, texts).select(F.col("text").cast("binary").alias("text")))
    assert len(scorer.shares) > 800
    right, wrong = (rows(lm.score(table(spark, [" ".join(f"a{k} b{(k + by) % 400}" for k in range(0, 400, 9))]), scorer, counts))[0]["score"] for by in (0, 7))
    assert right > wrong + 20


def test_lm_scores_whole_texts(spark):
    """A text of over a million words is scored to its end; its end's words count."""
    unit = "alpha beta gamma "
    docs = [unit * 200 for _ in range(20)] + [unit * 400_000 + tail for tail in ("", "zeta")]
    got = {r["doc_id"]: r for r in rows(lm.score_corpus(table(spark, docs)))}
    a, b = got[20], got[21]
    assert (a["n_tokens"], b["n_tokens"]) == (1_200_001, 1_200_002) and b["score"] < a["score"] and b["base_score"] < a["base_score"]


def test_lm_on_odd_and_empty_tables(spark, odd):
    assert len(rows(lm.score_corpus(odd.select("doc_id", "text", "name")))) == len(ODD)
    assert rows(lm.score_corpus(odd.limit(0))) == []


# 9 ------------------------------------------------------------------------------------------------


def brute_near(docs, k, percent):
    sets = {}
    for i, t in docs:
        w = WORD.findall(lower(t or ""))
        sets[i] = {tuple(w)} if 0 < len(w) < k else {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def changed(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize(("k", "percent", "turns"), [(5, 80, 2), (3, 85, 1), (3, 60, 2)])
def test_near(spark, monkeypatch, k, percent, turns):
    monkeypatch.setattr(nearness, "ROUNDS", turns)
    monkeypatch.setattr(nearness, "BLOCK", 5)
    monkeypatch.setattr(nearness, "SENT", turns)
    docs, r = [], random.Random(percent + k)
    for g in range(4):
        base = " ".join(words(150, g, 5000))
        docs += [base] + [changed(base, r.randrange(0, 9), 100 * g + j) for j in range(12)]
        step = base
        for j in range(6):  # a chain whose ends are far apart
            step = changed(step, 3, 1000 * g + j)
            docs.append(step)
    docs += [docs[0]] * 5 + [docs[0].upper(), "a b", "A  B", "a", "", None, "one two three"]
    r.shuffle(docs)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"], x["kept"]) for x in rows(nearness.near_groups(table(spark, docs), k=k, percent=percent))}
    assert got == brute_near(list(enumerate(docs)), k, percent)


def test_near_on_odd_and_empty_tables(spark, odd):
    got = rows(nearness.near_groups(odd))
    assert len(got) == len(ODD) and next(r for r in got if r["doc_id"] is None)["kept"] is False
    assert rows(nearness.near_groups(odd.limit(0))) == []


def test_signatures_estimate_jaccard():
    base = words(400, 1, 10**6)
    for share in (0.5, 0.9):
        other = base[: int(400 * share)] + words(400 - int(400 * share), 2, 10**6)
        data = [" ".join(x).encode() for x in (base, other)]
        s, at = nearness.shingle_sets(np.frombuffer(b"".join(data), np.uint8), np.array([0, len(data[0]), len(data[0]) + len(data[1])]), 1)
        sig = nearness.super_minhash(s, at)
        a, b = set(s[at[0] : at[1]].tolist()), set(s[at[1] : at[2]].tolist())
        assert abs((sig[0] == sig[1]).mean() - len(a & b) / len(a | b)) < 0.15


def test_blocks_of_a_large_group_and_others(spark, monkeypatch):
    """What is grouped meets the others' blocks only, and every link to and among these is found."""
    monkeypatch.setattr(nearness, "BLOCK", 3)
    r = random.Random(9)
    sets = {i: sorted(r.sample(range(60), 20)) for i in range(30)}
    sets |= {i: sets[i - 30][:19] + [100 + i] for i in range(30, 45)}
    group = {i: 0 if i < 20 else i for i in sets}
    members = spark.createDataFrame([(i, 7, g) for i, g in group.items()] + [(500, 8, 500), (501, 8, 500)], "doc long, cluster long, group long")
    held = spark.createDataFrame([*sets.items(), (500, [1]), (501, [2])], "doc long, hashes array<long>")
    found = [(x["hi"], x["lo"]) for x in rows(nearness.block_links(members, held, 60))]
    root = {i: group[i] for i in group}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        assert 100 * len(set(sets[a]) & set(sets[b])) >= 0 and a != b
        root[max(find(a), find(b))] = min(find(a), find(b))
    want = {i: group[i] for i in group}

    def find_want(x):
        while want[x] != x:
            x = want[x]
        return x

    for a in sets:
        for b in sets:
            x, y = set(sets[a]), set(sets[b])
            if a < b and 100 * len(x & y) >= 60 * len(x | y):
                p, q = find_want(a), find_want(b)
                want[max(p, q)] = min(p, q)
    assert {i: find(i) for i in sets} == {i: find_want(i) for i in sets}


# 10 -----------------------------------------------------------------------------------------------


def brute_templates(docs, least):
    leaves, places = defaultdict(set), []
    for row, (i, t) in enumerate(docs):
        for k, line in enumerate((t or "").encode().split(b"\n")):
            m = templates.masked(line)
            if m:
                key = (len(m), tuple(m[: templates.DEPTH]))
                leaves[key].add(b" ".join(m))
                places.append((row, k, key, b" ".join(m)))
    name = {(key, line): (key, t) for key, lines in leaves.items() for line, t in zip(sorted(lines), templates.parse([x.split() for x in sorted(lines)]), strict=True)}
    held = defaultdict(set)
    for row, _, key, line in places:
        held[name[key, line]].add(row)
    gone = defaultdict(list)
    for row, k, key, line in places:
        if len(held[name[key, line]]) >= least:
            gone[row].append(k)
    return sorted((len((t or "").split("\n")), gone[row]) for row, (_, t) in enumerate(docs))


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_templates(spark, monkeypatch, sent):
    monkeypatch.setattr(templates, "SENT", sent)
    docs = [f"Posted by user{k} on 2024-01-{k % 28 + 1:02d} at the {w} desk today\n" + " ".join(words(12, k)) + f"\nShared words of the {w} page are here" for k, w in enumerate(words(40, 3, 8))]
    docs += ["unique " + " ".join(words(9, 99)), "", None]
    got = rows(templates.recurring_lines(table(spark, docs)))
    assert sorted((r["n_lines"], r["dropped_lines"]) for r in got) == brute_templates(list(enumerate(docs)), 3)
    first = next(r for r in got if r["doc_id"] == 0)
    assert first["dropped_lines"] == [0, 2]


def test_templates_of_a_large_leaf(spark):
    """A template with over 5,000 fillings of its fourth token is still one."""
    name = lambda k: str(k).translate(LETTERS)
    docs = [f"Thanks for reading {name(k)} from {name(k % 90)} and come back very soon" for k in range(5200)]
    got = rows(templates.recurring_lines(table(spark, docs)))
    assert all(r["dropped_lines"] == [0] for r in got)
    assert sorted((r["n_lines"], r["dropped_lines"]) for r in got) == brute_templates(list(enumerate(docs)), 3)


def test_templates_on_odd_and_empty_tables(spark, odd):
    got = rows(templates.recurring_lines(odd, least_docs=2))
    assert sorted((r["n_lines"], r["dropped_lines"]) for r in got) == brute_templates(ODD, 2)
    assert rows(templates.recurring_lines(odd.limit(0))) == []
    df = spark.createDataFrame([("a\nb\nc", [1])], "t string, d array<int>")
    assert df.select(templates.without_lines(F.col("t"), F.col("d")).alias("x")).first()["x"] == "a\nc"


def test_template_fields_generalise():
    lines = [x.split() for x in ("a b c one d", "a b c two d", "z y x w v")]
    assert templates.parse([[t.encode() for t in x] for x in lines]) == [0, 0, 1]


# all ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("f", [sharding.shard, licenses.scan_licenses, bpe.digests, rules.quality_rules, naming.exact_groups, packing.best_fit], ids=lambda f: f.__name__)
def test_empty_tables(odd, f):
    assert rows(f(odd.limit(0))) == []


def test_shares_of_sets():
    r = random.Random(3)
    sets = [np.array(sorted(r.sample(range(60_000), r.choice([0, 1, 40, 3000]))), dtype=np.int64) for _ in range(9)]
    got = nearness.shares(sets[:4], sets[3:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[3:]] for a in sets[:4]]
