"""Prefix trie, whitening and byte-level BPE against brute force, numpy and tiktoken."""

import hashlib
import math
import random
import zlib
from collections import defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from feedloom.llm import bpe, prefix_trie, queries, whitening

EMPTY = hashlib.sha256(b"").hexdigest()


# Prefix trie

def rebuilt(rows):
    """conv_id -> list of (role, text), as the query's contract rebuilds conversations."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    return out


def plain_nodes(convs):
    members = defaultdict(list)
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        todo = [p]
        for q in todo:
            todo += children[q]
        return todo

    out = set()
    for p, m in members.items():
        sub = below(p)
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), sum(not children[q] for q in sub),
                 sum((len(members[q]) - 1) * (len(q[-1][1]) if q else 0) for q in sub), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversation_rows(rng, n, letters="ab", longest=7):
    rows = []
    for i in range(n):
        c = rng.choice([i, i * 7, 10**15 + i, -i])
        rows += [(c, k, rng.choice(["user", None]), rng.choice(letters) * rng.randint(0, 2)) for k in range(rng.randint(1, longest))]
    return rows


def record(role, text):
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
    return digest + len(text).to_bytes(8, "big")


@pytest.mark.parametrize("seed", range(30))
def test_blocks_merge_to_the_whole_trie(seed):
    rng = random.Random(seed)
    convs = {c: [("u", rng.choice("ab") * rng.randint(0, 2)) for _ in range(rng.randint(0, 6))] for c in range(rng.randint(1, 60))}
    groups = defaultdict(list)
    for c, v in convs.items():
        groups[b"".join(record(*t) for t in v)].append(c)
    keys = sorted(groups)
    shared = [-1, *(prefix_trie.common_turns(a, b) for a, b in pairwise(keys)), -1]
    rows = [(k, len(groups[k]), min(groups[k]), hashlib.sha256(",".join(map(str, sorted(groups[k]))).encode()).hexdigest(), a, b)
            for k, a, b in zip(keys, shared, shared[1:], strict=False)]
    cuts = sorted({0, len(rows), *(rng.randrange(len(rows)) for _ in range(rng.randint(0, 8)))})
    closed, partial = [], defaultdict(list)
    for lo, hi in pairwise(cuts):
        for r in prefix_trie.Forest(rows[lo:hi]).write():
            (partial[r[1]] if r[0] else closed).append(r)
    merged = [(True, k, v[0][2], v[0][3], min(r[4] for r in v), None, *(sum(r[i] for r in v) for i in range(6, 10)),
               max((r[10] for r in v if r[10]), default=None)) for k, v in partial.items()]
    least = {r[1]: r[4] for r in merged}
    got = {(r[4], r[3], least.get(r[2]) if r[2] else r[5], *r[6:10], r[10] or EMPTY) for r in closed + merged}
    assert len(closed) + len(merged) == len(got) and got == plain_nodes(convs)


def test_trie_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "BROADCAST_NODES", 3)
    rng = random.Random(3)
    rows = conversation_rows(rng, 300)
    rows += [(c, k, "user", "hot") for c in range(5000, 5200) for k in range(6)]  # copies of one conversation
    rows += [(7, None, None, "é€😀"), (7, 0, "", "x"), (7, 0, "", "x"), (None, 1, "u", "nobody"), (77, 5, "us", "erx"), (78, 5, "user", "x"),
             (9999, None, None, None)]
    rows += [(6001, k, "u", f"t{k % 3}") for k in range(150)]  # a long one
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, depth string, N_CONVS int")
    # turns of equal number, role and different text are ordered by hash, so none stand in the rows above
    seen = defaultdict(set)
    for c, turn, role, text in rows:
        seen[c, turn, role or ""].add(text)
    rows = [r for r in rows if len(seen[r[0], r[1], r[2] or ""]) == 1]
    df = df.join(spark.createDataFrame([(c, t, o) for (c, t, o), v in seen.items() if len(v) > 1], "c long, t long, o string"),
                 F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.coalesce("role", F.lit("")) == F.col("o")), "left_anti")
    want = plain_nodes(rebuilt(rows))
    for block in (5, 10**6):
        got = prefix_trie.trie(prefix_trie.rebuild(prefix_trie.records(df)), block_turns=block).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_trie_of_little(spark):
    kinds = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], kinds)
    assert prefix_trie.trie(prefix_trie.rebuild(prefix_trie.records(empty))).count() == 0
    one = spark.createDataFrame([(101, 0, None, None)], kinds)  # all its turns are replaced by none
    got = prefix_trie.trie(prefix_trie.rebuild(prefix_trie.records(one))).collect()
    assert {tuple(r) for r in got} == plain_nodes(rebuilt([(101, 0, None, None)]))


# Whitening

@pytest.mark.parametrize("shape", [(1, 3, -5, 5), (100, 4, -10, 10), (1000, 5, -2**40, 2**40), (777, 6, 0, 1), (70, 3, -2**61, 2**61), (130, 2, 5, 6)])
def test_planes_give_exact_cross_products(shape):
    rows, d, lo, hi = shape
    y = np.random.default_rng(rows).integers(lo, hi, (rows, d))
    sums, inner = whitening.cross_products(y)
    o = y.astype(object)
    assert (sums == o.sum(axis=0)).all() and (inner == o.T @ o).all()
    assert all(sum(low << (32 * k) for k, low in whitening.limbs(int(v))) == v for v in inner.ravel())


def check_whitened(got, ids, vectors, k=32):
    x = np.floor(np.array(vectors, float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    kept = min(k, int((e > e.sum() * 1e-13).sum()))
    assert len(got) == n * kept and {r["n"] for r in got} == {n}
    w = defaultdict(list)
    for r in got:
        w[r["component"]].append((r["vec_id"], r["whitened"]))
        assert abs(r["explained"] - e[r["component"] - 1] / e.sum()) <= 1e-9 and r["identity_error"] < 1e-6
    deviations = sorted((r["vec_id"] is None, r["vec_id"] or 0, int(r["deviation"])) for r in got if r["component"] == 1)
    exact = [int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True))) for row in x]
    assert deviations == sorted((i is None, i or 0, t) for i, t in zip(ids, exact, strict=True))
    for c in range(1, kept + 1):
        if c < kept and e[c - 1] - e[c] < 1e-3 * e[0] or c > 1 and e[c - 2] - e[c - 1] < 1e-3 * e[0]:
            continue  # nearly equal eigenvalues leave the directions open
        mine = np.array([s for _, s in sorted(w[c], key=lambda t: (t[0] is None, t[0] or 0, t[1]))])
        plain = centred @ v[:, c - 1] / np.sqrt(e[c - 1])
        both = [np.array([s for _, s in sorted(zip(ids, sign * plain, strict=True), key=lambda t: (t[0] is None, t[0] or 0, t[1]))]) for sign in (1, -1)]
        assert min(np.abs(mine - b).max() for b in both) < 1e-6


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(400, 6)) * np.array([5, 3, 2, 1, 0.5, 0.1])
    good = [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(base)]
    good += [(3, good[3][1]), (None, good[5][1])] + [(500 + i, good[0][1]) for i in range(300)]
    bad = [(900, None), (901, []), (902, [1.0, None, 1, 1, 1, 1]), (903, [1.0, math.nan, 1, 1, 1, 1]), (904, [1.0, math.inf, 1, 1, 1, 1]),
           (905, [3e38, 1, 1, 1, 1, 1]), (906, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], "x", 2) for i, v in good + bad],
                               "vec_id long, embedding array<float>, component string, W int").repartition(5)
    got = whitening.whiten(df).collect()
    check_whitened(got, [i for i, _ in good], [v for _, v in good])
    assert len({r["component"] for r in whitening.whiten(df, components=2).collect()}) == 2
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.limit(0)).columns == whitening.whiten(df).columns
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).count() == 0
    with pytest.raises(ValueError, match="must not be named"):
        whitening.whiten(df, id="component")


def test_whitening_of_far_values(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([1e12, -1e12, 0.5]), rng.random(), rng.random() * 1e6]) for i in range(200)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    y = [[math.floor(c * 64) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*y, strict=True)]
    want = {i: sum((200 * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in enumerate(y)}
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want


def test_whitening_query_on_given_vectors(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.op12_whitening(spark, sf_dir).collect()
    assert got[0].asDict().keys() >= {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    check_whitened(got, [r[0] for r in rows], [r[1] for r in rows])


# Byte-level BPE

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return bpe.Vocabulary(f.read(), PATTERN)


@pytest.fixture(scope="module")
def plain(vocabulary):
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def odd_texts(step):
    rng = random.Random(1)
    alphabet = " \n\t\r  aAbz'sté0９²,.! \u0085  　 ᠎​\x1c\x1f\x0b\x00世界😀ñ'll've"
    texts = ["", " ", "\n\n a", "a" * 3_000, "é" * 999, " " * 5_000 + "x", None, "<|endoftext|>"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    every = [chr(c) for c in range(0, 0x110000, step) if not 0xD800 <= c < 0xE000]
    return texts + ["".join(f"a{c} {c}1\n" for c in every[i:i + 500]) for i in range(0, len(every), 500)]


def test_perfect_hash_is_minimal(vocabulary):
    keys = bpe.mix64(np.arange(10_000, dtype=np.uint64))
    assert sorted(bpe.PerfectHash(keys).slots(keys).tolist()) == list(range(10_000))
    assert sorted(vocabulary.id_at.tolist()) == list(range(len(vocabulary.ranks)))
    entries = sorted(vocabulary.ranks)
    assert vocabulary.whole(entries).tolist() == [vocabulary.ranks[e] for e in entries]
    assert set(vocabulary.whole([b"no such entry", b"\xff\xff\xff", b"zzzzzzzzzzzzz"]).tolist()) == {-1}
    with pytest.raises(ValueError, match="distinct"):
        bpe.PerfectHash(np.zeros(2, np.uint64))


@pytest.mark.parametrize(("piece", "remember", "step"), [(4 << 20, 300_000, 3), (997, 50, 37)])
def test_ids_are_those_of_tiktoken(vocabulary, plain, monkeypatch, piece, remember, step):
    monkeypatch.setattr(bpe, "PIECE", piece)
    monkeypatch.setattr(bpe, "REMEMBER", remember)
    texts = odd_texts(step)
    got = vocabulary.encode_column(pa.array(texts).slice(2))
    for text, ids in zip(texts[2:], got.to_pylist(), strict=True):
        assert ids == plain.encode_ordinary(text or ""), repr(text)[:100]
    assert vocabulary.decode_column(got).to_pylist() == [(t or "").encode() for t in texts[2:]]
    assert vocabulary.decode_column(got.slice(3, 50)).to_pylist() == [(t or "").encode() for t in texts[5:55]]


def test_encode_and_decode_tables(spark, plain):
    rows = [(1, "Hello wörld", "x"), (1, "Hello wörld", "x"), (2, None, None), (None, "", "x"), (3, "long " * 100_000, "x")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, Ids string, units int")
    encoded = bpe.encode(df, PATH, PATTERN)
    assert encoded.columns == ["doc_id", "text", "units", "ids"]
    assert sorted(r["ids"] for r in encoded.collect()) == sorted(plain.encode_ordinary(t or "") for _, t, _ in rows)
    back = bpe.decode(encoded, PATH, PATTERN).select("text", "decoded").collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back) and len(back) == len(rows)
    odd = spark.createDataFrame([(None,), ([],), ([None, 15496],), ([-1, 50256, 2**31 - 1],)], "ids array<int>")
    assert [r["decoded"] and bytes(r["decoded"]) for r in bpe.decode(odd, PATH, PATTERN).collect()] == [
        None, b"", "�Hello".encode(), "���".encode()]
    assert bpe.encode(df.limit(0), PATH, PATTERN).count() == 0
    invalid = spark.sql("SELECT cast(unhex('61FF2062') AS string) AS text")
    assert bpe.encode(invalid, PATH, PATTERN).first()["ids"] == plain.encode_ordinary("a� b")


def test_bpe_query_on_given_texts(spark, sf_dir, plain):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op13_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = plain.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
