"""The pipeline's stages against brute-force versions on a small table."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

from test_llm_operators import none_stays, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.cache()]
    for _, stage in pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], SF).cache())
        assert seen[-1].columns == docs.columns
    start, known, deduped, cut, clean = ({r.doc_id: r for r in x.collect()} for x in seen)
    assert set(known) <= set(start) and len(known) >= 0.99 * len(start)
    # near-dedup: the least of each group of fingerprints within two bits
    fp = {i: slow_fingerprint(r.text) for i, r in known.items()}
    least = {i: i for i in fp}
    for _ in range(10):
        for a in fp:
            for b in fp:
                if (fp[a] ^ fp[b]).bit_count() <= 2:
                    least[a] = least[b] = min(least[a], least[b])
    assert set(deduped) == set(least.values())
    # repeated strings: bytes, but for characters that are cut
    expected = none_stays(sorted((i, r.text) for i, r in deduped.items()))
    assert set(cut) == set(deduped)
    for i, r in cut.items():
        left = expected[i][0] - expected[i][1]
        assert 0 <= left - len(r.text.encode()) <= 6 * max(1, expected[i][2]) and r.n_chars == len(r.text)
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {i for i in cut if i not in clean} >= {i for i, r in cut.items() if any(x in " ".join(r.text.lower().split()) for x in items)}
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = {r.doc_id: r for r in pipeline.run(spark, SF).collect()}
    assert set(last) == set(clean)
    for i, r in last.items():
        assert np.array_equal(r.ids, t.encode(clean[i].text, add_special_tokens=False).ids) and r.text == clean[i].text


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
