"""The stages of the pipeline, each held against its own input."""

import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from phasewise.llm import decontaminate, minhash, registry
from phasewise.llm.common import cut, table

DATA = Path("/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def stages(spark):
    out = {"documents": table(spark, str(DATA), "documents")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = cut(stage(spark, docs, str(DATA)), name)
    return out


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mix", "tokens"]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_one_of_each_group_and_no_contaminated_document_stays(spark, stages):
    groups = minhash.duplicate_groups(stages["quality"]).collect()
    assert ids(stages["near_duplicates"]) == {r.doc_id for r in groups if r.kept}
    found = decontaminate.contamination(stages["near_duplicates"], table(spark, str(DATA), "benchmark")).collect()
    assert ids(stages["decontamination"]) == {r.doc_id for r in found if not r.contaminated}


def test_the_mix_repeats_no_document_more_than_twice(stages):
    before = {r.doc_id: len(WORD.findall(r.text or "")) for r in stages["decontamination"].collect()}
    mixed = Counter()
    for r in stages["mix"].collect():
        mixed[r.doc_id] += len(WORD.findall(r.text))
    assert all(n <= 2 * before[i] for i, n in mixed.items())
    assert abs(sum(mixed.values()) - 1.5 * sum(before.values())) <= stages["mix"].select("source").distinct().count()


def test_the_token_files_hold_the_mix(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(registry.vocabulary()[0])
    expected = Counter()
    for r in stages["mix"].collect():
        coded = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
        expected[r.doc_id, len(coded), zlib.crc32(np.array(coded, "<u4").tobytes())] += 1
    rows = stages["tokens"].collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    last = max(rows, key=lambda r: r.start)
    assert last.start + last.n_tokens == stages["tokens"].agg(F.sum("n_tokens")).first()[0]


def test_the_quality_stage_keeps_clean_documents(spark, stages):
    labels = {r.doc_id: (r.quality, r.toxic) for r in table(spark, str(DATA), "labels").collect()}
    kept = ids(stages["quality"])
    clean = [i for i in ids(stages["documents"]) if labels.get(i) == (1, 0)]
    assert sum(i in kept for i in clean) >= 0.9 * len(clean)
