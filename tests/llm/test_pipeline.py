"""The pipeline's stages, each against a plain version on its own input."""

import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from dialtide.llm.queries import LLM_ORACLES, LLM_QUERIES  # noqa: E402
from dialtide.session import materialize  # noqa: E402


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, sorted(tuple(r) for r in docs.collect())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash", "suffix_dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        texts = [r[1] for r in rows]
        docs = materialize(stage(spark, docs, sf_dir), name)
        if name == "packing":
            break
        if name == "quality_rules":
            rows = [r for r, kept in zip(rows, brute.quality_kept([(r[1], r[3]) for r in rows])) if kept]
        elif name == "minhash":
            rows = [r for i, (r, c) in enumerate(zip(rows, brute.near_classes(texts))) if i == c]
        else:
            new = brute.lines_kept(texts) if name == "line_dedup" else [x[2] for x in brute.passages_removed(texts, 51)]
            rows = [(r[0], t, r[2], r[3], len(t)) for r, t in zip(rows, new)]
        assert docs.columns == columns, name
        assert sorted(tuple(r) for r in docs.collect()) == rows, name
    ids = {r[0]: brute.encoded("word_bpe_49k.json", r[1], (2,)) for r in rows}
    pieces = docs.collect()
    own = {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        own.setdefault(p["doc_id"], []).extend(np.frombuffer(bytes(p["ids"]), "<u4").tolist())
    assert own == ids
    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.columns == docs.columns and whole.count() == docs.count()


def test_passages_of_51_words_in_two_documents_go(documents, spark, sf_dir):
    import random

    rng = random.Random(5)
    own = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    passage, short = " ".join(own(1)[:4] for _ in range(51)), own(30)
    assert len(passage) < 400
    texts = [f"{own(200)}\n{passage}\n{own(200)}" for _ in range(2)] + [f"{own(200)} {short} {own(200)}" for _ in range(2)]
    kept = dict(corpus_pipeline.suffix_dedup_stage(spark, documents(list(enumerate(texts))), sf_dir).select("doc_id", "text").collect())
    assert all(passage not in kept[i] and len(kept[i]) <= len(texts[i]) - len(passage) for i in (0, 1))
    assert all(kept[i] == texts[i] for i in (2, 3))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    expected = dict(zip(texts, [x[2] for x in brute.passages_removed(list(texts.values()), 51)]))
    assert dict(corpus_pipeline.suffix_dedup_stage(spark, docs, sf_dir).select("doc_id", "text").collect()) == expected


CLASHING = ["n_lines", "n_dropped", "kept", "n_bytes", "n_removed", "n_spans", "n_passages", "label", "class_id", "row_key", "_row", "fp", "text_left"]


def test_values_of_clashing_columns_pass_through_every_stage(documents, spark, sf_dir):
    own = lambda i, n: " ".join(f"w{i}.{j}" for j in range(n))
    line = "a line that many documents share"
    texts = [f"{own(i, 40)}\n{line}\n{own(100 + i, 30)}" for i in range(12)] + [own(50, 60), own(50, 60) + " end", own(60, 80) + " " + own(70, 55), own(70, 55) + " " + own(80, 80)]
    docs = documents(list(enumerate(texts))).selectExpr("*", *[f"concat('{c}-', doc_id) AS {c}" for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, columns = docs.count(), docs.columns
        docs = materialize(stage(spark, docs, sf_dir), f"clash-{name}")
        assert docs.columns == columns and docs.count() == before - (name == "minhash")
        for r in docs.collect():
            assert [r[c] for c in CLASHING] == [f"{c}-{r['doc_id']}" for c in CLASHING], name
            assert r["n_chars"] == len(r["text"])
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(line not in t for t in left.values()) and own(70, 55) not in left[14] + left[15]


def test_odd_rows_pass_through_every_stage(odd_documents, spark, sf_dir):
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"odd-{name}")
        assert docs.columns == odd_documents.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()
    empty = odd_documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)


def test_oracles(spark, sf_dir):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from oracle import compare, connect

    con = connect(sf_dir)
    for name, sql in LLM_ORACLES.items():
        assert compare(LLM_QUERIES[name](spark, sf_dir), con, sql) == [], name
