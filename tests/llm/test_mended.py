"""Inputs that the operators once answered wrongly: clashing columns, hot units, named parts of pages."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from feedloom.llm import html_extract, line_dedup, mixing, near_dedup, packing, url_filter
from tests.llm.test_operators import brute_components

LONG = "This is a sentence of the article, with commas, and full stops. It goes on for a while. " * 4


@pytest.mark.parametrize(("page", "want"), [
    # a section of the article whose id its heading gave it
    (f"<article><h1>T</h1><p>{LONG}</p><section id='discussion'><h2>Discussion</h2><p>{LONG}</p></section></article>",
     ["T", LONG, "Discussion", LONG]),
    # ids on headings, as Markdown and Sphinx write them
    (f"<article><h1 id='social-impact'>Social</h1><p>{LONG}</p><h2 id='related-work'>Related work</h2><p>{LONG}</p></article>",
     ["Social", LONG, "Related work", LONG]),
    # a short post with long comments, one article element each
    (f"<div class='post'><h1>Short</h1><p>A short post, but the article.</p></div><div id='comments'><h2>Comments</h2>"
     + f"<article class='comment-body'><p>{LONG}</p></article>" * 9 + "</div>", ["Short", "A short post, but the article."]),
    # comments hold most of the text of main
    (f"<main><h1>Post</h1><p>{LONG}</p><section class='comments'>" + f"<p>{LONG}</p>" * 30 + "</section></main>", ["Post", LONG]),
    # comment words that name no comments
    (f"<body class='comments-open'><div class='post no-comments comment-status-open'><h1>P</h1><p>{LONG}</p></div></body>", ["P", LONG]),
    # a page of comments alone is read
    (f"<div class='comments'><p>{LONG}</p></div>", [LONG]),
    # very long attributes with markup in them
    (f"<article><h1>T</h1><p title='{'x > y ' * 20_000}'>{LONG}</p><p data-x=\"{'<p>' * 40_000}\">{LONG}</p></article>", ["T", LONG, LONG]),
    # a quote that is never closed ends with its tag
    (f"<article><h1>T</h1><p>{LONG}</p><p title=\"open>{LONG}</p></article>", ["T", LONG, LONG]),
])
def test_parts_of_pages(page, want):
    assert html_extract.main_text(page) == "\n".join(" ".join(w.split()) for w in want)


def test_a_page_of_documentation():
    page = (f"<html><body><div class='sphinxsidebar'><ul><li>Contents</li></ul></div><div class='body' role='main'><section id='notice'><h1>Notice</h1><p>{LONG}</p>"
            f"<section id='related'><h2>Related</h2><ul><li>one</li><li>two</li></ul></section></section></div><footer>x</footer></body></html>")
    assert html_extract.main_text(page).split("\n")[-2:] == ["one", "two"]


def test_columns_named_like_those_of_the_work(spark, docs_of):
    names = ["best", "row", "bad", "_bad", "_cut", "lines", "whole", "key", "k", "s", "z", "u", "kept", "_kept", "own", "place", "rn", "copies", "extra", "body", "given"]
    docs = docs_of([(i, f"same line\nown line {i} " + "word " * i, f"s{i % 12}") for i in range(60)] + [(3, "same line", "s1")])
    for i, n in enumerate(names):
        docs = docs.withColumn(n, F.lit(i))
    out = line_dedup.remove_boilerplate(docs, min_sites=10)
    assert out.columns == [*docs.columns, "n_lines", "removed_lines", "only_boilerplate"] and out.count() == 61
    assert out.where("removed_lines = 1").count() == 60 and out.where("only_boilerplate").count() == 1
    one = near_dedup.keep_one(docs)
    assert one.columns == docs.columns and one.count() <= 61
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns and mixed.select(*names).distinct().collect() == [tuple(range(len(names)))]
    urls = docs.withColumn("url", F.lit("http://a.example.com/en/"))
    judged = url_filter.judge_urls(urls, url_filter.rules_frame(spark, [("example.com", "/en/", "block")]))
    assert judged.columns == [*urls.columns, "host", "path", "rule", "verdict"] and {r["verdict"] for r in judged.collect()} == {"block"}


def test_boilerplate_of_most_of_a_document_goes(docs_of):
    shared = "\n".join(f"shared line {k} of every site" for k in range(5))
    rows = [(i, f"{shared}\nown {i}", f"s{i}") for i in range(12)] + [(50, shared, "s1"), (51, shared + "\n \t", "s2")]
    got = {r["doc_id"]: r for r in line_dedup.remove_boilerplate(docs_of(rows)).collect()}
    assert got[3]["text"] == "own 3" and got[3]["removed_lines"] == 5 and not got[3]["only_boilerplate"]
    assert got[50]["text"] == shared and got[50]["removed_lines"] == 0 and got[50]["only_boilerplate"] and got[51]["only_boilerplate"]


def test_a_repeated_document_meets_its_share(docs_of):
    rows = [(7, "ten words " * 5, "a")] * 900 + [(1000 + i, "ten words " * 5, "a") for i in range(100)]
    docs = docs_of(rows)
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    got = mixing.decide(sized, mixing.mix(docs)).collect()
    assert len(got) == 1000 and {r["n"] for r in got} <= {1, 2}
    assert abs(sum(r["n"] * r["size"] for r in got) - got[0]["target"]) <= 0.005 * got[0]["target"]
    assert mixing.mixture(docs).count() == sum(r["n"] for r in got)


def test_ranges_grow_beyond_a_fixed_sample(spark, docs_of):
    docs = docs_of([(i, f"word{i * 7919 % 5003} text {i}", "s") for i in range(6000)]).select("doc_id", "text")
    bounds = packing._bounds(docs, public_tokenizers.path("word_bpe_49k.json"), 2500)
    assert len(bounds) == 2499 and bounds == sorted(bounds) and len(set(bounds)) == 2499


def test_near_misses_of_one_template_are_not_paired(spark, docs_of, monkeypatch):
    template = [f"b{i}" for i in range(120)]

    def variant(name, run):
        return template[:50] + [f"{name}_{j}" for j in range(run)] + template[50 + run:]

    rows = [(i, " ".join(variant(i, 16))) for i in range(300)]  # 96 of 116 shingles in common: 0.706
    rows += [(1000 + i, " ".join(variant(i, 16)[:-1] + ["end"])) for i in range(0, 300, 30)]  # links to some
    rows += [(2000 + i, " ".join(variant(f"few{i}", 8))) for i in range(5)]  # 104 of 116: links among themselves and to the others
    made, real = [], near_dedup.saved

    def counted(df, name):
        out = real(df, name)
        if name == "pairs":
            made.append(out.count())
        return out
    monkeypatch.setattr(near_dedup, "saved", counted)
    for some in (rows[:310], rows):
        made.clear()
        got = near_dedup.near_duplicates(docs_of([(i, t, "s") for i, t in some])).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(some)
        assert sum(made) <= 8 * len(some)
