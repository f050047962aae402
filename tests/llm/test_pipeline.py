"""The pipeline's stages on the smallest tables: each one's decisions hold on what the one before it kept."""

import pytest

import corpus_pipeline
from promolens.llm.common import materialise, table
from promolens.llm.secrets import base_spans
from tests.llm import brute
from tests.llm.test_operators import empty, odd  # noqa: F401  (fixtures)

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs, kept = table(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SMALL), f"test-{name}")
        kept[name] = docs.collect()
    good = kept["quality_rules"]
    assert good and not any(brute.quality(r["text"])[-1] for r in good)
    parts = brute.near([(r["doc_id"], r["text"]) for r in good], 5)
    assert {r["doc_id"] for r in kept["near_duplicates"]} == {d for d, (_, c) in parts.items() if d == c}
    assert len(kept["secret_scans"]) == len(kept["near_duplicates"]) and not any(base_spans(r["text"]) for r in kept["secret_scans"])
    assert {r["doc_id"] for r in kept["source_mix"]} <= {r["doc_id"] for r in kept["secret_scans"]}
    assert len(kept["token_ids"]) == len(kept["source_mix"])


def test_one_row_of_each_group(spark):
    say = lambda name: " ".join(f"{name}{k}" for k in range(60))
    rows = [(5, say("a")), (5, say("a")), (7, say("a") + " end"), (None, say("a")), (None, say("b")), (None, say("b")), (9, say("c")), (9, say("d")), (3, say("d")), (None, ""), (None, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()]
    assert sorted(got, key=str) == sorted([(5, say("a")), (None, say("b")), (9, say("c")), (3, say("d")), (None, ""), (None, None)], key=str)


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_stages_take_awkward_tables(spark, which, request, tmp_path):
    docs = request.getfixturevalue(which)
    columns = list(corpus_pipeline.COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        before = docs.select(*columns).collect()
        out = stage(spark, docs, "unused")
        if name == "token_ids":
            got = out.collect()
            assert len(got) == len(before) and all(r["n_tokens"] == len(r["ids"]) for r in got)
            continue
        assert out.columns == columns
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        if name == "quality_rules":
            # texts of fewer than twenty words go, empty and null ones among them; of the rest nothing here is junk but repeats
            assert all(r["text"] and len(r["text"].split()) >= 20 for r in after) and len(after) <= len(before)
        if name == "near_duplicates":
            assert len({" ".join((r["text"] or "").lower().split()) for r in after}) == len(after)
            assert {" ".join((r["text"] or "").lower().split()) for r in after} <= {" ".join((r["text"] or "").lower().split()) for r in before}
        if name == "secret_scans":
            assert len(after) == len(before)
