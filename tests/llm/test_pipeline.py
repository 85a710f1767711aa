"""The pipeline, stage by stage, against plain versions of each stage."""

from __future__ import annotations

import random
import re

from conftest import DATA
from pyspark.sql import functions as F
from test_operators import deduped, grouped, sha, texts

import corpus_pipeline
from terrazzo.llm.common import table


def test_stages(spark):
    docs = table(spark, DATA, "documents")
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language ID"](spark, docs, DATA)
    assert known.columns == docs.columns and known.count() == docs.count()
    lines = stages["line dedup"](spark, known, DATA).cache()
    assert sorted((r.doc_id, sha(r.text)) for r in lines.collect()) == sorted((i, h) for i, n, gone, h in deduped(texts(known)) if gone < n)
    near = stages["MinHash near-dedup"](spark, lines, DATA).cache()
    assert {r.doc_id for r in near.collect()} == {i for i, _, _, kept in grouped(texts(lines), 5) if kept}
    clean = stages["benchmark decontamination"](spark, near, DATA).cache()
    flat = lambda t: " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t.lower())) + " "
    items = [flat(r.text) for r in table(spark, DATA, "benchmark").collect()]
    kept = {r.doc_id for r in clean.collect()}
    assert kept <= {i for i, t in texts(near) if not any(b in flat(t) for b in items)}
    assert clean.columns == docs.columns
    out = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id for r in out} == kept and all(r.round_trip for r in out)
    assert {r.doc_id: r.decoded_sha256 for r in out} == {i: sha(t) for i, t in texts(clean)}


def test_odd_documents(spark):
    """Nulls, repeats, clashing columns, junk that language ID rejects, an empty table."""
    own = table(spark, DATA, "documents")
    plain = own.limit(40).withColumns({c: F.lit("k") for c in ("score", "uid", "lines", "n_lines", "lang_pred", "whole", "bits_per_byte")})
    r = random.Random(1)
    odd = [(-1, None), (-2, ""), (-3, "1234 5678 !!"), (None, "re an at by are this with be as"), (-4, "".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(400))), (-5, "a" * 200_000), (-6, "the of and in to a is that it for on was\nthe of and in to a is that it for on was"), (-6, "the of and in to a is that it for on was\nthe of and in to a is that it for on was")]
    rows = spark.createDataFrame([(i, t, None, None, None, *"kkkkkkk") for i, t in odd], plain.schema)
    docs = plain.unionByName(rows)
    stages = dict(corpus_pipeline.STAGES)
    for name in ("language ID", "line dedup", "MinHash near-dedup", "benchmark decontamination"):
        docs = stages[name](spark, docs, DATA).cache()
        assert docs.columns == plain.columns and {tuple(x) for x in docs.select("score", "uid", "lines", "n_lines", "whole").distinct().collect()} == {tuple("kkkkk")}
        ids = {x.doc_id for x in docs.collect()}
        assert not ids & {-1, -2, -3, -4} and None in ids
    assert [x.text for x in docs.where("doc_id = -6").collect()] == ["the of and in to a is that it for on was"] * 2
    assert stages["byte-level BPE"](spark, docs, DATA).count() == docs.count()
    none = own.where("false")
    for stage in stages.values():
        none = stage(spark, none, DATA)
        assert none.count() == 0
