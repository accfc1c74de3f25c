from __future__ import annotations

from conftest import SF_DIR, rows

import corpus_pipeline
from tarmac.llm import decontaminate, minhash, packing, quality, secrets
from tarmac.llm.common import keep
from tarmac.llm.queries import VOCABULARY


def test_stages(spark):
    docs = given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = keep(stage(spark, docs, SF_DIR))
        assert docs.schema == given.schema, name
        kept.append((before, docs))
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    before, after = kept[0]
    assert ids(after) == {r[0] for r in rows(quality.quality(before), "row.doc_id", "kept") if r[1]}
    before, after = kept[1]
    assert ids(after) == {i for i, k in rows(minhash.near_duplicates(before, minhash.PIPELINE_RULE), "doc_id", "kept") if k}
    before, after = kept[2]
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert ids(after) == ids(before) - ids(decontaminate.contaminated(before, bench))
    before, after = kept[3]
    assert ids(after) == ids(before)
    assert all(secrets.base_findings(t or "") == [] for (t,) in rows(after, "text"))
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert rows(packing.pack(after, VOCABULARY), *columns) == rows(corpus_pipeline.run(spark, SF_DIR), *columns)
