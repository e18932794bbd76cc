"""The pipeline's stages one after another on small documents, each against brute force, and
the registered queries that have SQL against DuckDB."""

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from feedloom.llm import SQL
from feedloom.llm.quality import Shapes, _pieces
from feedloom.plans.tables import TABLES
from tests.conftest import SMOKE
from tests.llm.test_operators import brute_components, brute_targets
from tests.test_oracle import _digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, con, key):
    df = entry.queries()[key](spark, SMOKE)
    got = _digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(SQL[key])
    assert got == _digest([d[0] for d in cur.description], cur.fetchall())


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], SMOKE)
        path = str(tmp_path / f"{i}")
        out.write.parquet(path)
        frames.append(spark.read.parquet(path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
    rows = [[(r["doc_id"], r["text"], r["source"]) for r in f.collect()] for f in frames[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMOKE}/labels.parquet").collect()}
    kept = {r[0] for r in rows[1]}
    assert all((i in kept) == (labels[i] == 1) for i, _, _ in rows[0] if i in labels)
    # line dedup
    sites = {}
    for _, t, s in rows[1]:
        for x in set((t or "").split("\n")) - {""}:
            sites.setdefault(x, set()).add(s)
    cleaned = {}
    for i, t, _ in rows[1]:
        lines = (t or "").split("\n")
        gone = [x for x in lines if len(sites.get(x, ())) >= 10]
        cleaned[i] = "\n".join(x for x in lines if x not in gone) if gone and sum(map(len, gone)) <= 0.5 * len(t) else t
    assert {i: t for i, t, _ in rows[2]} == cleaned
    # near-duplicates
    groups = brute_components([(i, t) for i, t, _ in rows[2]])
    assert sorted(i for i, _, _ in rows[3]) == sorted(i for i, (_, c) in groups.items() if i == c)
    # mix: whole documents, at most twice, near the targets
    size = {i: len((t or "").split()) for i, t, _ in rows[3]}
    sizes, taken, times = Counter(), Counter(), Counter(i for i, _, _ in rows[4])
    for i, _, s in rows[3]:
        sizes[s] += size[i]
        taken[s] += size[i] * times[i]
    assert set(times) <= set(size) and max(times.values()) <= 2
    target = brute_targets(dict(sizes))
    assert all(abs(taken[s] - t) <= max(size[i] for i, _, x in rows[3] if x == s) for s, t in target.items())
    # packing: every token of every copy once
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, t, _ in rows[4]:
        want[i] += len(whole.encode(t or "", add_special_tokens=False).ids) + 1
    pieces = frames[-1].collect()
    have = Counter()
    for r in pieces:
        have[r["doc_id"]] += r["length"]
    assert have == want
    assert max(sum(r["length"] for r in pieces if r["sequence_id"] == s) for s in {r["sequence_id"] for r in pieces}) <= 2048
    total = Counter()
    for r in corpus_pipeline.run(spark, SMOKE).collect():
        total[r["doc_id"]] += r["length"]
    assert total == want


def test_votes_see_the_whole_text():
    import pyarrow as pa
    text = "Plain words of prose, all fine. " * 30 + "#$% " * 4000
    assert Shapes(pa.array([text])).votes()[0, 0] == -1
    assert sum(Shapes(p).rows for p in _pieces(pa.array(["a"] * 1500))) == 1500
    assert np.isfinite(Shapes(pa.array([text, "", None])).features()).all()
