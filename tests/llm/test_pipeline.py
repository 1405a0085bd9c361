"""Each stage against what it must keep of its own input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from laborlake.llm import decontaminate, quality_classifier
from laborlake.llm.common import written

from test_dedup import dedup_lines, groups  # isort: skip
from test_text import check_packs, tokens  # isort: skip

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, made = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        made[name] = (docs, written(stage(spark, docs, SF_DIR), name))
        docs = made[name][1]
    assert all(after.columns == columns for name, (_, after) in made.items() if name != "packing")
    rows = {name: [frame.collect() for frame in frames] for name, frames in made.items()}

    before, after = rows["quality_classifier"]
    scored = quality_classifier.score(made["quality_classifier"][0], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = {r.doc_id for r in scored.filter("kept").collect()}
    assert Counter(after) == Counter(r for r in before if r.doc_id in kept)

    before, after = rows["line_dedup"]
    want = dedup_lines([(r.doc_id, r.text) for r in before])
    assert {r.doc_id: r.text for r in after} == {key[0]: value[0] for key, value in want.items()}
    assert all(r.n_chars == len(r.text) for r in after)

    before, after = rows["near_duplicates"]
    first = {d for d, _, component in groups([(r.doc_id, r.text) for r in before]) if d == component}
    assert Counter(after) == Counter(r for r in before if r.doc_id in first)

    before, after = rows["decontamination"]
    items = [decontaminate.plain(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in before if any(i in decontaminate.plain(r.text) for i in items)}
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == leaked

    before, after = rows["packing"]
    lengths = dict(zip([r.doc_id for r in before], map(len, tokens([r.text for r in before])), strict=True))
    packed = Counter()
    for r in after:
        packed[r.doc_id] += r.length
    assert packed == lengths
    check_packs(after)


def test_run_is_its_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "near_duplicates", "decontamination", "packing",
    ]
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    check_packs(rows)
    assert rows


def test_odd_documents_go_through(spark, odd):
    rows = corpus_pipeline.run(spark, odd).collect()
    check_packs(rows)
    assert None in {r.doc_id for r in rows}
