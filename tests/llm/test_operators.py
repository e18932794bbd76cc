"""Operators on small tables against brute force, with nulls, ties, repeated rows, empty tables
and extra columns of clashing names."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import (bit_sliced, html_extract, line_dedup, mixing, near_dedup, order_minhash, packing, quality, url_filter,
                          warc)
from feedloom.llm.components import components
from tests.llm.test_kernels import plain_shingles

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("", "/*/private/", "block"), ("org", "", "block")]


def words(rng, n, vocabulary=2000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# URL filters

def test_url_rules(spark):
    urls = ["http://example.com/en/x?q=/de/", "https://WWW.Example.COM/en/", "http://notexample.com/en/", "http://a.net/es/", "http://a.net/es",
            "http://x.org", "http://é.org?x://y/", None, "", "no scheme/en/", "ftp://b.c/a/private/z", "http://com/", "http://com", "a://b\nc.com/x\ny#z"]
    df = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)] + [(0, urls[0], "mine")], "page_id long, url string, Host string")
    got = url_filter.judge_urls(df, url_filter.rules_frame(spark, RULES)).collect()
    assert len(got) == len(urls) + 1
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert [by[i][2:] for i in range(len(urls))] == [
        ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("com/", "allow"), ("net/es/", "block"), (None, "allow"),
        ("org", "block"), ("org", "block"), (None, "allow"), (None, "allow"), (None, "allow"), ("/*/private/", "block"),
        ("com/", "allow"), (None, "allow"), ("com/", "allow")]
    assert by[13][:2] == ("b\nc.com", "/x\ny") and by[7][:2] == ("", "") and by[1][0] == "www.example.com"
    assert url_filter.judge_urls(df.limit(0), url_filter.rules_frame(spark, RULES)).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(df, url_filter.rules_frame(spark, [])).collect()} == {"allow"}


def test_rules_are_filed_under_the_rarest_token(spark):
    urls = spark.createDataFrame([("a.example.com", "/en/x")] * 3 + [("b.com", "/fr/")], "host string, path string")
    index = {r["rule"]: r["token"] for r in url_filter.rule_index(urls, url_filter.rules_frame(spark, RULES)).collect()}
    assert index["example.com/en/"] in ("h:example", "p:en") and index["com/"] == "h:com" and index["org"] == "h:org"
    assert index["/*/private/"] == "p:private"


# Order MinHash

def test_neighbours_are_compared_in_order_of_id(spark, docs_of):
    rng = random.Random(4)
    rows = [(i * 37 % 1009 * 10**12, " ".join(words(rng, rng.randint(0, 30))), "s") for i in range(300)]
    rows += [(5, None, "s"), (6, "", "s"), (7, "same text here", "s"), (7, "same text here", "s"), (8, "é" * 9, None)]
    got = order_minhash.compare_neighbours(docs_of(rows)).collect()
    order = sorted(((i, t or "") for i, t, _ in rows))
    s, o = order_minhash.sketch, order_minhash
    want = []
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        e = t[:len(t) - len(t) // 4] + n[:len(t) // 4]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), o.fingerprint(s(t)), o.fingerprint(s(e)),
                     o.likeness(s(t), s(e)), o.likeness(s(t), s(n))))
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert order_minhash.compare_neighbours(docs_of(rows[:1])).count() == 1
    assert order_minhash.compare_neighbours(docs_of(rows).limit(0)).count() == 0
    nulls = order_minhash.compare_neighbours(docs_of([(None, "abc", "s"), (1, "abcd", "s")])).collect()
    assert sorted((r["doc_id"] or -1, r["n_chars"]) for r in nulls) == [(-1, 3), (1, 4)]


# Near-duplicates

def brute_components(rows):
    sets = [(i, plain_shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(a), root(i)) for i, a in sets}


def near_rows():
    rng = random.Random(8)
    base, rows = words(rng, 150), []
    for i in range(120):  # one group with edits of all strengths: hubs, chains and outsiders
        w = list(base)
        for _ in range(rng.randint(0, 12)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(40)}"
        rows.append(" ".join(w[rng.randint(0, 6):]))
    for _ in range(25):  # small groups and pairs near the limit
        w = words(rng, rng.randint(20, 80))
        for _ in range(rng.randint(1, 4)):
            rows.append(" ".join(w))
            w = list(w)
            w[rng.randrange(len(w))] = "new"
    rows += ["", None, " ", "a b", "A B", "a b c", "a b c d e", "A b c d e", rows[0], rows[0].upper()]
    ids = rng.sample(range(10**6), len(rows))
    return list(zip(ids, rows, strict=True))


def test_near_duplicates_equal_brute_force(spark, docs_of):
    rows = near_rows()
    got = near_dedup.near_duplicates(docs_of([(i, t, "s") for i, t in rows], "sig"))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    have = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()}
    want = brute_components(rows)
    assert have == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())
    assert len(set(want.values())) < len(rows) and max(Counter(c for _, c in want.values()).values()) > 20


def test_keep_one_of_each_group(spark, docs_of):
    rows = [(1, "a b c d e f", "s"), (2, "a b c d e f", "t"), (1, "a b c d e f", "s"), (3, "", "s"), (4, None, None), (None, "a b c d e f", "s")]
    df = docs_of(rows, "kept")
    assert sorted(map(str, near_dedup.keep_one(df).collect())) == sorted(
        str(r) for r in df.where("doc_id <> 2 OR doc_id IS NULL").distinct().collect())
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0
    assert near_dedup.keep_one(df.limit(0)).columns == df.columns


def test_one_id_with_different_texts_loses_no_text(spark, docs_of):
    a, b, c = "a b c d e f g", "k l m n o p q", "r s t u v w x"
    rows = [(1, a, "s"), (5, a, "s"), (5, b, "s"), (5, b, "s"), (5, "", "s"), (7, b, "t"), (8, c, "s"), (8, b, "s"), (9, None, "s"), (None, a, "s")]
    got = near_dedup.keep_one(docs_of(rows)).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, a), (5, b), (5, ""), (8, c), (9, None), (None, a)]))


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(3, 3), (7, 8)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Quality classifier

def test_classifier_agrees_with_held_out_labels(spark, sf_dir):
    big = "/root/testdata/sf0.01"
    out = quality.classify(spark.read.parquet(f"{big}/documents.parquet")).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id")
    rows = out.select("quality", "rejected").collect()
    bad = [r["rejected"] for r in rows if r["quality"] == 0]
    good = [r["rejected"] for r in rows if r["quality"] == 1]
    assert np.mean(bad) > 0.9 and np.mean(good) < 0.01


def test_rare_bad_documents_are_rejected(spark, monkeypatch):
    big = "/root/testdata/sf0.01"
    labelled = spark.read.parquet(f"{big}/documents.parquet").join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id")
    # the sample of least hashes of all texts holds no bad one
    few = labelled.where("quality = 0").orderBy(F.xxhash64("text").desc()).limit(3)
    docs = labelled.where("quality = 1").unionByName(few)
    monkeypatch.setattr(quality, "TRAIN_ROWS", 100)
    rows = quality.classify(docs).select("quality", "rejected").collect()
    assert len(rows) > 300 and Counter((r["quality"], r["rejected"]) for r in rows if r["quality"] == 0 or r["rejected"]) == {(0, True): 3}


def test_sample_holds_both_classes():
    assert quality.sample_sizes(1, 10**9) == (1, 3999) and quality.sample_sizes(10**9, 10**6) == (3000, 1000)
    assert quality.sample_sizes(10**6, 10**6) == (2000, 2000) and quality.sample_sizes(5, 70) == (5, 70)


def test_classifier_edges(spark, docs_of):
    df = docs_of([(1, None, "s"), (2, "", "s"), (3, "Short text.", None), (None, " \n", "s")], "Rejected")
    out = quality.classify(df)
    assert [r["rejected"] for r in out.collect()] == [False] * 4 and out.columns.count("rejected") == 1
    assert quality.classify(df.limit(0)).count() == 0


# WARC

def test_capture_history_equals_brute_force(spark):
    big = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(5, "http://b.com/x", "<p>1</p>"), (3, "http://a.com/y", "<p>1</p>"), (9, "http://b.com/", None), (2, None, ""),
            (7, "http://b.com/x y", big), (4, "http://a.com/z", big), (3, "http://a.com/y", "<p>1</p>"), (None, "http://q.com/", "<p>1</p>"), (11, "u://v", "<p>only")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, sha1 string").repartition(3)
    for least in (0, 5):
        got = warc.capture_history(df.select("page_id", "url", "html"), min_bytes=least)
        keys = [(r["url_key"], r["captured_at"]) for r in got.collect()]
        assert keys == sorted(keys) and keys[0][0] == ")"
        first = {}
        for i, _, h in rows:
            if i is not None:
                first[h or ""] = min(first.get(h or "", i), i)
        want = []
        for i, _, h in rows:
            data, f = (h or "").encode(), first[h or ""]
            again = len(data) >= least and f != i
            want.append((i, len(data), warc._base32(hashlib.sha1(data).hexdigest()), "revisit" if again else "response", f if again else None))
        have = [tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
        assert sorted(have, key=str) == sorted(want, key=str)
    assert warc.capture_history(df.limit(0)).count() == 0


# Line dedup

def test_boilerplate_equals_exact_counts(spark, docs_of):
    rng = random.Random(6)
    lines = [f"line {k} " + "z" * 5 for k in range(30)]
    rows = []
    for i in range(400):
        site = rng.choice([f"s{k}" for k in range(14)] + [None])
        picked = [lines[k] for k in range(30) if rng.random() < k / 400]
        body = [f"own {i} {j} " + "q" * 40 for j in range(rng.randint(0, 6))]
        rows.append((i, "\n".join(body + picked + ([""] if i % 7 == 0 else [])), site))
    rows += [(900, None, "s1"), (901, "", None), (902, lines[29], "s2"), (3, rows[3][1], rows[3][2])]
    for need in (3, 9, 12):
        sites = {}
        for _, t, s in rows:
            for x in set((t or "").split("\n")) - {""}:
                sites.setdefault(x, set()).add(s)
        bad = {x for x, s in sites.items() if len(s) >= need}
        got = line_dedup.remove_boilerplate(docs_of(rows, "N_Lines"), min_sites=need).collect()
        want = []
        for i, t, _ in rows:
            gone = [x for x in (t or "").split("\n") if x in bad]
            whole = bool(gone) and not any(x.strip() and x not in bad for x in t.split("\n"))
            cut = bool(gone) and not whole
            want.append((i, "\n".join(x for x in t.split("\n") if x not in bad) if cut else t,
                         0 if t is None else len(t.split("\n")), len(gone) if cut else 0, whole))
        assert sorted(((r["doc_id"], r["text"], r["n_lines"], r["removed_lines"], r["only_boilerplate"]) for r in got), key=str) == sorted(want, key=str)
    assert line_dedup.remove_boilerplate(docs_of(rows).limit(0)).count() == 0


def test_pipeline_removes_boilerplate_of_any_share(spark, docs_of):
    import corpus_pipeline
    menu, note = "menu " * 10, "notice " * 10
    rows = [(i, f"{menu}\n{note}", f"s{i}") for i in range(12)]
    rows += [(20, f"{menu}\n{'own ' * 15}\n{note}", "s1"), (21, f"{menu}\nown", "s2"), (22, f"{menu}\n \t\n", "s3"), (23, "own", "s4"),
             (24, None, "s5"), (25, "", None)]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_boilerplate(spark, docs_of(rows), "").collect()}
    want = {i: t for i, t, _ in rows} | {20: "own " * 15, 21: "own"}
    assert got == {i: (t, len(t or "")) for i, t in want.items()}


# HTML

def test_extract_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>a &amp; b</p>", "old"), (1, "u", "<p>a &amp; b</p>", "old"), (2, None, None, "old")],
                               "page_id long, url string, html string, TEXT string")
    got = html_extract.extract(df)
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in got.collect()) == [(1, "a & b", 5), (1, "a & b", 5), (2, "", 0)]
    assert html_extract.extract(df.limit(0)).count() == 0


# Top-k

def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 6)]) for i in rng.permutation(400)]
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1020, None), (1040, [1.0, None]), (1060, [float("nan")]), (1061, [float("inf"), 1.0]),
             (None, [1.0]), (1080, [2.0, 1.0]), (20, rows[5][1]), (1100, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    fine = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    want = []
    for i, v in fine:
        if i % 20 == 0:
            best = sorted(((-dot(v, w), j) for j, w in fine if j != i))[:7]
            want += [(i, j, -s) for s, j in best]
    got = bit_sliced.top_k(df.where("vec_id <> 20 OR vec_id IS NULL"), F.col("vec_id") % 20 == 0, k=7).collect()
    want = [x for x in want if x[0] != 20]
    fine20 = [x for x in fine if x[0] != 20]
    want = [(i, j, -s) for i, v in fine20 if i % 20 == 0 for s, j in sorted((-dot(v, w), j) for j, w in fine20 if j != i)[:7]]
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in got) == sorted(want)
    assert all(sorted(r["rank"] for r in got if r["query_id"] == i) == list(range(1, 8)) for i in {w[0] for w in want})
    assert bit_sliced.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert bit_sliced.top_k(df.where("vec_id = 40"), F.col("vec_id") % 20 == 0).count() == 0


# Packing

def test_pieces_cover_every_token_once(spark, docs_of):
    rng = random.Random(9)
    texts = [" ".join(words(rng, rng.choice([0, 3, 40, 900]))) for _ in range(150)] + ["same words here"] * 60 + [None, "", "x " * 9000]
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    got = packing.pack(docs_of([(i, t, "s") for i, t in enumerate(texts)], "ids"), path).collect()
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    next_start, per = Counter(), {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["start"] == next_start[r["doc_id"]] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        next_start[r["doc_id"]] += r["length"]
        per.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert next_start == {i: len(x) for i, x in ids.items()}
    for pieces in per.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0  # full, or a power of two: no padding
    assert packing.pack(docs_of([(1, "x", "s")]).limit(0), path).count() == 0
    assert packing.pack(docs_of([(None, "x", "s"), (1, "x", "s"), (1, "x", "s")]), path).count() == 3


# Mixing

def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > 2 * sizes[s]}
        for s in full or free:
            target[s] = 2 * sizes[s] if full else level * w[s]
        if not full:
            break
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    return target


def test_mix_meets_targets_and_is_stable(spark, docs_of):
    rng = random.Random(11)
    rows = [(i, " ".join(words(rng, int(rng.lognormvariate(4, 1)))), rng.choice(["a", "b", "é", "B", "z", None, "hot", "hot", "hot"])) for i in range(6000)]
    rows += [(10**6, None, "a"), (10**6 + 1, "", "empty"), (7, rows[7][1], rows[7][2])]
    df = docs_of(rows, "target")
    sized = df.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    got = mixing.decide(sized, mixing.mix(df)).collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    for r in got:
        assert 0 <= r["n"] <= 2 and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["n"] * r["size"]
    target = brute_targets(dict(sizes))
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]])
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(3, 0.005 * t), (s, taken[s], t)
    again = mixing.decide(sized, mixing.mix(df.repartition(5))).collect()
    key = lambda r: (r["doc_id"], str(r["source"]), r["size"], r["n"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixture(df.limit(0)).columns == df.columns
    assert mixing.mixture(df).count() == sum(r["n"] for r in got)
