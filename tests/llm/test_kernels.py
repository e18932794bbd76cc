"""Per-row kernels against plain versions written for clarity."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from feedloom.llm import bit_sliced, html_extract, mixing, order_minhash, packing, quality, shingles, warc

ODD = ["", None, " \t\n", "a", "a b c d", "A b C d E", "é À z w v u", "x" * 5000 + " y", "a\x1cb", "a b c d e f"]


def plain_shingles(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_shingles_count_like_plain_sets():
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice("ab cd ef".split()) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    row, h = shingles.shingles(pa.array(texts))
    assert np.bincount(row, minlength=len(texts)).tolist() == [len(plain_shingles(t)) for t in texts]
    sets = [set(h[row == i].tolist()) for i in range(len(texts))]
    for i in range(0, 60):
        for j in range(i):
            assert len(sets[i] & sets[j]) == len(plain_shingles(texts[i]) & plain_shingles(texts[j]))


def test_words_do_not_depend_on_pieces():
    texts = pa.array(ODD + ["lorem ipsum dolor " * 50, "z" * 300 + " q"])
    for piece in (1, 7, 64, 1 << 20):
        for a, b in zip(shingles.words(texts), shingles.words(texts, piece), strict=True):
            assert a.tolist() == b.tolist()
    a, b = shingles.words(texts.slice(3, 4)), shingles.words(pa.array(texts.to_pylist()[3:7]))
    assert a[1].tolist() == b[1].tolist()


def plain_sketch_places(text):
    """Selected places per hash function, straight from the definition."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    h = order_minhash._kmers(codes)
    items = order_minhash._numbered(h)
    out = []
    for j in range(order_minhash.M):
        v = (items ^ order_minhash._FLIP[j]) * order_minhash._MULTIPLY[j]
        out.append(sorted(sorted(range(len(v)), key=lambda i: (int(v[i]), i))[:order_minhash.L]))  # noqa: B023
    return out, h


@pytest.mark.parametrize("text", ["", "abc", "abcdef", "abcdefg", "aaaaaaaaaaaaaaaaaa", "the cat sat on the mat " * 30, "é日本" * 3000])
def test_order_minhash_selects_least_in_text_order(text):
    places, h = plain_sketch_places(text)
    acc = np.full(order_minhash.M, len(places[0]), np.uint64)
    for j in range(len(places[0])):
        acc = shingles.mix64(acc * np.uint64(31) + h[np.array([p[j] for p in places])])
    assert (acc >> np.uint64(48)).astype(np.uint16).tolist() == order_minhash.sketch(text).tolist()


def test_order_minhash_sees_order_and_edits():
    rng = random.Random(3)
    w = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    a, moved = " ".join(w), " ".join(w[150:] + w[:150])
    edited = order_minhash.edited(a, " ".join(reversed(w)))
    s = order_minhash.sketch
    assert order_minhash.likeness(s(a), s(a)) == 1
    assert 0.2 < order_minhash.likeness(s(a), s(edited)) < 0.9
    assert order_minhash.likeness(s(a), s(moved)) < 0.8  # plain MinHash would give nearly 1
    assert order_minhash.edited("abcdefgh", "X") == "abcdefX" and order_minhash.edited("", "x") == ""


def test_occurrences_are_numbered():
    h = order_minhash._kmers(np.frombuffer(("ab" * 40).encode("utf-32-le"), np.uint32).astype(np.uint64))
    assert len(set(h.tolist())) == 2 and len(set(order_minhash._numbered(h).tolist())) == len(h)


def test_bit_slices_give_exact_scores_and_top():
    rng = np.random.default_rng(0)
    for n, d, spread in ((1, 3, 5), (70, 8, 20), (300, 5, 2), (200, 4, 0)):
        ids = rng.permutation(n * 3)[:n].astype(np.int64)
        values = rng.integers(-spread, spread + 1, (n, d))
        block = bit_sliced.SlicedBlock.unpacked(**bit_sliced.SlicedBlock.build(ids, values).packed())
        for k in (1, 5, 400):
            q, own = rng.integers(-9, 10, d), int(ids[0])
            got = sorted(zip(*(x.tolist() for x in block.top(q, k, own)), strict=True), key=lambda x: (-x[1], x[0]))
            want = sorted(((int(i), int(v @ q)) for i, v in zip(ids, values, strict=True) if i != own), key=lambda x: (-x[1], x[0]))
            assert got == want[:k]


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        n = 1 << bits
        cells = np.array(np.meshgrid(*[np.arange(n)] * dims)).reshape(dims, -1).T
        key = packing.hilbert(cells, bits)
        assert sorted(key.tolist()) == list(range(n**dims))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_encoder_equals_the_tokenizer_on_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = ODD + ["Don't 'S I'LL 12 34 #$% <|endoftext|> x<|startoftext|>y", "İstanbul ΣΑΣ ß ẞ", "日本 語 한국어", "étude, a,, b..."]
    got = packing.Encoder(path).encode_all(texts, chars=20)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_flight_keeps_totals_and_landing_is_nearest():
    rng = np.random.default_rng(5)
    a = np.column_stack([np.ones(400), np.sort(rng.integers(0, 900, 400))[::-1]]).astype(float)
    p = rng.random(400)
    out = mixing._flight(p, a, np.random.default_rng(1))
    open_ = (out > 0) & (out < 1)
    assert open_.sum() <= 2
    np.testing.assert_allclose(out @ a, p @ a, rtol=1e-9)
    landed = mixing._land(mixing._flight(p, a, np.random.default_rng(1), 11), a)
    assert set(landed.tolist()) <= {0.0, 1.0} and abs((landed - p) @ a[:, 1]) < 40
    same = np.column_stack([np.ones(10), np.full(10, 7.0)])
    assert mixing._flight(np.full(10, 0.5), same, np.random.default_rng(2)).sum() == pytest.approx(5)


def test_warc_records_round_trip():
    import hashlib
    for payload in (b"", b"<p>x</p>", b"a\r\n\r\nWARC/1.1\r\nb" * 3, "é\r\n\r\nWARC/1.1\r\n".encode(), b"\x00 0\r\n\r\n"):
        sha = hashlib.sha1(payload).hexdigest()
        for first in (None, 3):
            data = warc.record(7, "http://a.b/c d\r\ne", payload, sha, first, "2026-01-01T00:00:07Z")
            assert warc.BETWEEN.encode() not in data
            got = warc.parse((data + warc.END.encode()).removeprefix(b"WARC/1.1\r\n"))
            assert got == (7, "http://a.b/c%20d%0D%0Ae", "2026-01-01T00:00:07Z", "response" if first is None else "revisit",
                           first, len(payload), warc._base32(sha))
    broken = warc.record(1, "", b"abc", "00" * 20, None, "x")
    with pytest.raises(ValueError):
        warc.parse(broken.removeprefix(b"WARC/1.1\r\n"))


def test_loser_tree_merges_like_sorting():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 8):
        runs = [sorted(rng.randint(0, 30) for _ in range(rng.randint(0, 20))) for _ in range(k)]
        got = [(r, i) for r, i in warc.LoserTree(runs)]
        assert got == sorted(((r, i) for r, x in enumerate(runs) for i in range(len(x))), key=lambda y: (runs[y[0]][y[1]], y[0], y[1]))


PAGES = [
    (None, ""), ("", ""), ("no tags &amp; text", "no tags & text"), ("<p>a<p>b", "a\nb"), ("<script>x<p>y</script>", ""),
    ("<body><nav><p>Menu, long; text. Here!</p></nav><article><h1>T</h1><p>One <b>bold<br>two</b></p><p>x&nbsp;&lt;y</article>"
     "<footer>foot</footer>", "T\nOne bold two\nx <y"),
    ('<body class="has-sidebar"><header><h1>Site</h1></header><main><header><h1>Head</h1></header><p>A, b. C!</p>'
     '<aside>side</aside><div class="cookie-notice">We use, yes.</div><ul><li>i<li>j</ul><form>f<input></form>'
     '<section id="comments"><p>Nice, indeed. Really!</p></section></main><div class=sidebar>links</div>', "Head\nA, b. C!\ni\nj"),
    ("<div class=content><p>A, b; c. D!<p>short</div><div class='ad'>Buy, now!</div><!-- <p>c</p> -->", "A, b; c. D!\nshort"),
    ("<article><p>x <a href='a>b'>l</a> y</p><div hidden>z</div><p style='display: none'>w</p></article>", "x l y"),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


LONG = "<p>A sentence, with marks; and more of it. Then another one!</p>"
WHOLE = "A sentence, with marks; and more of it. Then another one!"


@pytest.mark.parametrize("page,text", [
    (f"<article><h1>T</h1><p>lead</p><div class=body>{LONG * 9}</div></article>", ["T", "lead", *[WHOLE] * 9]),
    (f"<div><h1>T</h1><p>lead</p><div class=body>{LONG * 9}</div></div>", ["T", "lead", *[WHOLE] * 9]),
    (f"<div><div><h1>T</h1></div><div class=body><h2>S</h2>{LONG * 9}</div></div>", ["T", "S", *[WHOLE] * 9]),
    (f"<article><section>{LONG * 17}</section><section>{LONG * 3}</section></article>", [WHOLE] * 20),
    (f"<div><section>{LONG * 17}</section><section><h2>S</h2>{LONG * 3}</section></div>", [*[WHOLE] * 17, "S", *[WHOLE] * 3]),
    (f"<article><p>lead</p><ul>{'<li>' + WHOLE}{('<li>' + WHOLE) * 9}</ul><p>end</p></article>", ["lead", *[WHOLE] * 10, "end"]),
    (f"<div><p>lead</p><blockquote>{LONG * 9}</blockquote><p>end</p></div>", ["lead", *[WHOLE] * 9, "end"]),
    (f"<div><p>lead</p><table>{f'<tr><td>{WHOLE}' * 9}</table><p>end</p></div>", ["lead", *[WHOLE] * 9, "end"]),
])
def test_articles_are_kept_whole(page, text):
    assert html_extract.main_text(f"<body><nav>Menu</nav>{page}<footer>foot</footer>").split("\n") == text


NINE = "T\n" + "\n".join([WHOLE] * 9)


@pytest.mark.parametrize("page,text", [
    (f"<article class='post category-social'><h1>T</h1>{LONG * 9}</article>", NINE),
    (f"<div id=content class='layout-sidebar'><h1>T</h1>{LONG * 9}</div>", NINE),
    (f"<div id=content class='layout-sidebar'><article><h1>T</h1>{LONG * 9}</article></div><div class=widget>{LONG * 4}</div>", NINE),
    (f"<form action=x><div class=menu>m</div><div><h1>T</h1>{LONG * 9}<input></div></form>", NINE),
    (f"<form><article class=social><h1>T</h1>{LONG * 9}<div class=share>Share, now!</div></article></form>", NINE),
    (f"<main><div class='entry no-ads social'><article><h1>T</h1>{LONG * 9}</article></div></main>", NINE),
    (f"<main><div class='entry social'><h1>T</h1>{LONG * 9}</div><div class=related>{LONG}</div></main>", NINE),
    (f"<div class=post><h1>T</h1>{LONG * 9}</div><section id=comments><article class=comment>{LONG * 3}</article></section>", NINE),
    (f"<article><h1>T</h1>{LONG * 9}</article><section id=comments>{f'<article>{LONG * 3}</article>' * 4}</section>", NINE),
    (f"<div class=social><h1>T</h1>{LONG * 5}</div><div class=social>{LONG * 4}</div>", NINE),
    (f"<article><h1>T</h1>{LONG * 9}<form>{LONG * 2}</form><p class=ad>{WHOLE}</p></article>", NINE),
    (f"<div class=ad>{LONG * 9}</div><article><h1>T</h1><p>Short.</article>", "T\nShort."),
    (f"<div class=social hidden>{LONG * 9}</div><div role=form><h1>T</h1>{LONG * 9}</div>", NINE),
])
def test_names_do_not_remove_the_article(page, text):
    assert html_extract.main_text(f"<body><nav>Menu</nav>{page}<footer>foot</footer>") == text


def test_long_pages_are_read_whole():
    body = "".join(f"<p>Sentence {i}, and more.</p>" for i in range(20000))
    assert html_extract.main_text(f"<body><div class=nav>m</div><article>{body}</article>").count("\n") == 19999
    assert html_extract.main_text("<" * 3000 + "a b" + "<i \"" * 2000) is not None


def test_estimate_finds_accuracies_of_labellers():
    rng = np.random.default_rng(0)
    bad = rng.random(4000) < 0.2
    votes = np.ones((4000, 4), int)
    for k, accuracy in enumerate((0.95, 0.9, 0.85, 0.8)):
        says = np.where(rng.random(4000) < accuracy, bad, ~bad)
        votes[:, k] = np.where(rng.random(4000) < 0.8, np.where(says, 0, 2), 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, post = quality.estimate(patterns, counts.astype(float))
    assert abs(share - 0.2) < 0.05
    of = {tuple(p): x for p, x in zip(patterns.tolist(), post, strict=True)}
    assert np.mean([(of[tuple(v)] > 0.5) == b for v, b in zip(votes.tolist(), bad, strict=True)]) > 0.93


def test_crc_is_over_little_endian_words():
    ids = np.array([1, 49407, 300], "<u2")
    assert zlib.crc32(ids.astype("<u4").tobytes()) == zlib.crc32(b"\x01\0\0\0\xff\xc0\0\0\x2c\x01\0\0")
