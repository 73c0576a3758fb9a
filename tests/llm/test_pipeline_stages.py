"""The pipeline against a plain version of it, and the registered queries."""

import random

import numpy as np
import public_tokenizers as P
import pytest
from helpers import docs
from test_models import corpus
from test_text_dedup import brute_lines
from tokenizers import Tokenizer

import corpus_pipeline as C
from telemetry_qc.llm import order_minhash as O
from telemetry_qc.llm import surrogates as S
from telemetry_qc.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with junk, repeated lines, near copies and personal data."""
    rnd = random.Random(7)
    good, bad = corpus(rnd, 150)
    rows = [(i, t, "en") for i, t in good + bad]
    block = "\n".join(good[k][1] for k in (0, 1, 2))
    for i in range(300, 312):  # a passage of three lines in many
        rows.append((i, good[i - 250][1] + "\n" + block + "\n" + good[i - 200][1], "en"))
    for i in range(320, 340):  # near copies
        w = good[5][1].split()
        w[i % len(w)] = "changed"
        rows.append((i, " ".join(w), "en"))
    rows += [(350, good[7][1] + " write to some.one@mail.example.com", "en"), (351, None, "en"), (352, "", "en")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in good[:100]] + [(i, 0, 0) for i, _ in bad[:20]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, {i for i, _ in bad}


def test_stages_against_a_plain_version(spark, folder):
    path, rows, bad = folder
    kept = C.quality(spark, docs(spark, rows), path)
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & bad and len({r[0] for r in rows} - bad - ids) <= 2
    plain = [(i, t) for i, t, _ in rows if i in ids]

    after = [(i, t) for i, t, _, _ in brute_lines(plain)]
    lines = C.lines(spark, kept, path)
    assert sorted(lines.select("doc_id", "text").collect()) == sorted(after)

    # Classes by comparing all pairs.
    number = {}
    words = {i: np.array([number.setdefault(w, len(number)) for w in t.split()], "<u4") for i, t in after}
    first = {}
    for i, _ in after:
        first[i] = next((first[j] for j in sorted(first) if O.near(words[j], words[i])), i)
    one = C.near_duplicates(spark, lines, path)
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(first.values()))

    safe = C.private(spark, one, path)
    text = dict(after)
    for r in safe.collect():
        found = S.detect(text[r["doc_id"]], "@A=:0T")
        assert (r["text"] == text[r["doc_id"]]) == (not found)
    assert not safe.where("text like '%some.one@mail%'").count()
    for stage in (kept, lines, one, safe):
        assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in safe.collect()}
    packed = C.run(spark, path).collect()
    got = {}
    for r in packed:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_registered_queries():
    import __spark_entry__ as E

    numbers = sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES)
    assert numbers == list(range(1, 14))
    assert {*LLM_QUERIES, "pipeline"} <= set(E.queries())
    assert len(C.STAGES) == 5


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    import duckdb
    from conftest import SF_SMALL
    from oracle_check import TABLES, compare

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    r = compare(spark, con, name, LLM_QUERIES[name], LLM_ORACLE_SQL[name], SF_SMALL)
    assert r["cols_match"] and r["types_match"] and r["hash_match"], r
