"""The pipeline's stages against the operators and brute force."""

from pathlib import Path

import pytest

import corpus_pipeline
from gaugeworks.llm import packing, quality
from tests.llm.conftest import WORD_BPE
from tests.llm.test_ngram_join import _set

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


def test_stages(spark, odd):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).toPandas(), docs.schema)
        assert docs.columns == columns
        kept.append(docs.toPandas())
    start, good, known, single = kept

    wanted = quality.quality(spark.createDataFrame(start)).where("keep").toPandas()["doc_id"]
    assert set(good["doc_id"]) == set(wanted) and len(good) < len(start)
    assert set(known["doc_id"]) <= set(good["doc_id"]) and len(known) >= 0.99 * len(good)

    sets = {i: _set(t) for i, t in zip(known["doc_id"], known["text"], strict=True)}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if sets[a] and least[b] < least[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    least[a], changed = least[b], True
    assert set(single["doc_id"]) == {i for i in sets if least[i] == i}

    packed = packing.pack(packing.pieces(docs, WORD_BPE)).toPandas()
    run = corpus_pipeline.run(spark, FOLDER).toPandas()
    order = ["doc_id", "piece"]
    same = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert run.sort_values(order)[same].to_numpy().tolist() == packed.sort_values(order)[same].to_numpy().tolist()
    assert set(run["doc_id"]) == set(single["doc_id"])


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    for df in (odd, empty):
        docs = df.selectExpr("doc_id", "text", "id as lang", "key as source", "n as n_chars", "node")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, FOLDER)
            assert kept.columns == docs.columns and kept.count() <= docs.count()
        assert corpus_pipeline.packing_stage(spark, docs, FOLDER).count() >= docs.count()
