"""Every operator on odd rows and on an empty table: nothing crashes, no row is lost, results are as stated."""

import numpy as np
import pyarrow as pa
import pytest

from caseloom.llm import adscan, bagminhash, bpe, gearchunks, imatch, mixing, ordinal, ppm, prefixfree, spans, templates
from caseloom.llm import blocks as B

from .conftest import ODD, words

PER_ROW = {
    "imatch": imatch.op1_imatch, "bpe": lambda d: bpe.op2_bpe(d.sparkSession, d), "templates": templates.op4_templates, "ppm": ppm.op5_ppm,
    "mixing": mixing.op6_mixing, "prefixfree": prefixfree.op8_prefix_free, "bagminhash": bagminhash.op9_bagminhash, "gearchunks": gearchunks.op10_gear_chunks,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_every_document(odd, name):
    found = PER_ROW[name](odd).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in ODD)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(none, name):
    assert PER_ROW[name](none).count() == 0


def test_classifier(odd, none, ratings):
    found = ordinal.op7_ordinal(odd, ratings).collect()
    assert len(found) == len(ODD) and all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in found)
    assert ordinal.op7_ordinal(none, ratings).count() == 0
    unrated = ordinal.classified(odd, ratings.limit(0)).collect()
    assert {r["tail_probability"] for r in unrated} == {0.5} and all(r["keep"] for r in unrated)


@pytest.mark.parametrize("step", [templates.cleaned, gearchunks.cleaned, bagminhash.kept_documents, mixing.mixed_documents])
def test_filters_return_the_columns_of_their_input(odd, none, step):
    found = step(odd)
    assert found.columns == odd.columns and [t for _, t in found.dtypes] == [t for _, t in odd.dtypes]
    assert found.count() > 0
    assert step(none).count() == 0


def test_classifier_keeps_columns(odd, ratings):
    found = ordinal.kept_documents(odd, ratings)
    assert found.dtypes == odd.dtypes and found.count() <= len(ODD)


def test_stated_results(odd):
    encoded = {(r["doc_id"], r["n_tokens"]) for r in bpe.op2_bpe(odd.sparkSession, odd).collect()}
    assert {(1, 0), (2, 0)} <= encoded
    same = [r for r in imatch.op1_imatch(odd).collect() if r["doc_id"] in (7, 8)]
    assert same[0]["fingerprint"] == same[1]["fingerprint"]
    classes = [(r["doc_id"], r["class_id"]) for r in bagminhash.op9_bagminhash(odd).collect()]
    assert (8, 7) in classes and (7, 7) in classes and (3, 1) in classes and (2, 1) in classes and (None, None) in classes
    removed = {r["doc_id"]: r["n_removed"] for r in prefixfree.op8_prefix_free(odd).collect()}
    assert removed[4] == 30_000 - 100 + 99 and removed[7] == 0  # all but the first window, from its second byte on
    scored = {r["doc_id"]: r for r in ppm.op5_ppm(odd).collect()}
    assert scored[1]["n_tokens"] == 1 and scored[6]["n_tokens"] == len(words(ODD[8][1])) + 1


def test_vectors(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0])]
    good = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [1.0, 0.5]), (9, [0.0, 1.0]), (8, [0.0, 1.0])]
    frame = spark.createDataFrame(bad + good, "vec_id long, embedding array<float>")
    found = [(r["query_id"], r["rank"], r["vec_id"]) for r in adscan.op3_adscan(frame).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 100), (0, 2, 7), (0, 3, 8), (0, 4, 9), (100, 1, 0), (100, 2, 7), (100, 3, 8), (100, 4, 9)]
    assert adscan.op3_adscan(frame.limit(0)).count() == 0
    assert adscan.op3_adscan(spark.createDataFrame(bad, frame.schema)).count() == 0


def test_many_texts_under_one_id_have_different_tags():
    texts = pa.array([b"text %d" % k for k in range(200_000)], pa.large_binary())
    tags = np.concatenate([spans.tags_of(B.prefix_sums(data), offsets) for _, data, offsets in B.blocks(texts)])
    assert len(np.unique(tags)) == len(texts) and tags.max() < 1 << 63
