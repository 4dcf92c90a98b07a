"""The pipeline stage by stage, and the registered queries."""

import base64
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken
from llm.test_duplicates import components_by_hand, exact_by_hand, fingerprint_by_hand, passages_by_hand, rows_of
from pyspark.sql import functions as F

from tidemark.llm import queries


def test_stages_do_what_their_operators_do(spark, small):
    folder = "/root/testdata/sf0.001"
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    calm = stages["toxicity"](spark, small, folder)
    assert calm.columns == small.columns and calm.count() <= small.count()

    unique = corpus_pipeline.written(stages["exact_dedup"](spark, small, folder))
    kept = {row[0] for row in exact_by_hand(rows_of(small)) if row[4]}
    assert unique.columns == small.columns
    assert sorted(i for i, _ in rows_of(unique)) == sorted(kept)

    single = corpus_pipeline.written(stages["simhash_near_dedup"](spark, unique, folder))
    roots = components_by_hand([(i, fingerprint_by_hand(t)) for i, t in rows_of(unique)])
    assert single.columns == small.columns
    assert sorted(i for i, _ in rows_of(single)) == sorted(i for i, r in roots.items() if i == r)

    cut = corpus_pipeline.written(stages["suffix_array_dedup"](spark, single, folder))
    assert cut.columns == small.columns
    expected = {i: kept.decode("utf-8", "ignore") for i, _, _, kept in passages_by_hand(rows_of(single))}
    assert {i: t.decode() for i, t in rows_of(cut)} == expected

    with open(public_tokenizers.path(corpus_pipeline.RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokens = defaultdict(dict)
    for r in stages["best_fit_packing"](spark, cut, folder).collect():
        ids = np.frombuffer(r["ids"], "<u2").tolist()
        assert len(ids) == r["size"] <= corpus_pipeline.SEQUENCE and r["doc_ids"] == [p["doc_id"] for p in r["pieces"]]
        for p in r["pieces"]:
            tokens[p["doc_id"]][p["start"]] = ids[p["at"] : p["at"] + p["size"]]
    whole = {i: [t for _, part in sorted(parts.items()) for t in part] for i, parts in tokens.items()}
    assert whole == {i: [*library.encode_ordinary(t), corpus_pipeline.SEPARATOR] for i, t in expected.items()}


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert 0 < rows.selectExpr("explode(doc_ids) AS doc_id").distinct().count() < 200


def test_stages_take_odd_documents(spark, odd):
    named = odd.select("*", *(F.lit(name).alias(name) for name in ("_kept", "_id", "text_sha256", "row", "group", "number", "id", "digest", "words")))
    for frame in (named, named.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.written(stage(spark, frame, "/root/testdata/sf0.001"))
            assert name == "best_fit_packing" or frame.columns == named.columns


def test_each_operator_has_a_query():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)
