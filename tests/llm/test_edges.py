"""Cases that large corpora hold: short benchmark items, clashing columns, many frames and bundles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import prose
from tillmetrics.llm import decontaminate, language, licenses, warc
from tillmetrics.llm.queries import QUERIES
from tillmetrics.llm.tables import in_fold


def test_short_items_count_as_whole_words_only(spark):
    items = [(1, "The answer is"), (2, "42"), (3, "naïve Ü"), (4, "!!"), (5, None), (6, "The  ANSWER, is"), (7, "a" * 29)]
    texts = [
        "Here the answer issue is open.",  # no: the last word goes on
        "So the answer\nis 42. The answer is: 420",
        "NAÏVE ü",
        "thean sweris 4 2",
        "a" * 30,
        "say " + "A" * 29,
        None,
    ]
    bench = spark.createDataFrame(items, "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaked_rows(docs, bench).collect()}
    assert set(found) == {(1, 1), (1, 2), (1, 6), (2, 3), (5, 7)}
    first = found[1, 1]
    assert (texts[1][first["start"] : first["end"]], first["edits"], first["windows"]) == ("the answer\nis", 0, 2)
    blocks = decontaminate.indexes(bench, short_items=False)
    assert docs.filter(F.size(decontaminate.leaks(blocks, F.col("text"))) > 0).count() == 0


def test_short_and_long_items_together(spark):
    long = prose(60, 900)
    bench = spark.createDataFrame([(1, long), (2, "kato haen")], "item_id int, text string")
    text = prose(20, 1) + " " + long + " kato haen"
    docs = spark.createDataFrame([(1, text), (2, prose(50, 2))], "doc_id int, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaked_rows(docs, bench).collect()} == {(1, 1), (1, 2)}


def test_every_labelled_language_is_learned(spark):
    rows = [(i, f"{chr(0x4E00 + i % 300)} " * 40, f"l{i % 300}") for i in range(600)]
    net = language.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert len(net.languages) == 300


def test_windows_convolved_one_by_one(spark):
    """The network's forward pass against a plain one: each filter at each place of a window."""
    rng = np.random.default_rng(1)
    rows = [(i, prose(40, i), "a") for i in range(12)] + [(i, prose(40, i).upper(), "b") for i in range(12, 24)]
    net = language.fit(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    data = bytes(rng.integers(32, 127, 700).astype(np.uint8))
    windows = language.windows_of(data)
    got = language.probabilities(net, windows)
    for w, p in zip(windows, got):
        inputs = net.vectors[w]  # place x VECTOR
        pooled = []
        for f in range(net.filters.shape[1]):
            width = language.WIDTHS[f // language.FILTERS]
            kernel = net.filters[: width * language.VECTOR, f].reshape(width, language.VECTOR)
            ends = len(w) - width + 1
            sums = [float((inputs[i : i + width] * kernel).sum()) for i in range(ends)]
            pooled.append(max(0.0, max(sums) + float(net.bias[f])))
        logits = np.array(pooled) @ net.output + net.output_bias
        e = np.exp(logits - logits.max())
        assert np.allclose(p, e / e.sum(), atol=1e-3)


@pytest.mark.parametrize("name, modulus, remainder, least", [("op6_language", 3, 1, 0.97), ("op9_quality", 4, 2, 0.95)])
def test_held_out_accuracy(spark, name, modulus, remainder, least):
    folder = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, folder).filter("held_out")
    assert found.filter(~in_fold(F.col("doc_id"), modulus, remainder)).count() == 0
    if name == "op6_language":
        known = spark.read.parquet(f"{folder}/documents.parquet").filter("lang is not null and text is not null")
        right = F.col("lang_pred") == F.col("lang")
        found = found.join(known.select("doc_id", "lang"), "doc_id").filter("lang_pred <> 'und'")
    else:
        found = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
        right = F.col("predicted") == F.col("quality")
    share, n = found.agg(F.avg(right.cast("double")), F.count("*")).first()
    assert n > 50 and share >= least


def test_the_pipeline_keeps_columns_of_any_name(spark):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, round_trip int, found int, row int, ids_2 int"
    docs = spark.createDataFrame([(1, "the text", "en", "s", 8, "mine", 2, 3, 4, 5), (2, None, None, None, None, None, None, None, None, None)], columns)
    out = corpus_pipeline.sentencepiece(spark, docs, "")
    assert out.columns == [*docs.columns, "ids_3", "round_trip_2"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert (rows[1]["ids"], rows[1]["row"], rows[1]["found"], rows[1]["round_trip_2"]) == ("mine", 4, 3, True)


def test_only_ascii_letters_are_lowered(spark):
    df = spark.createDataFrame([("The KK MIT İx",)], "text string")
    assert df.select(licenses.words_of(F.col("text")).alias("w")).first()["w"] == ["the", "kK", "mit", "İx"]


def test_several_frames_and_bundles_are_read_by_several_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FRAME_BYTES", 3000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 6000)
    monkeypatch.setattr(warc, "READ_BYTES", 4000)
    rows = [(i, f"http://x/{i}", prose(200, i // 2)) for i in range(60)] + [(7, None, prose(200, 99)), (7, "u", "small"), (None, None, None)]
    pages = spark.createDataFrame(rows, "key bigint, target_uri string, payload string")
    index = warc.archive(pages, str(tmp_path / "no scheme".replace(" ", "_")))
    assert index.select("bundle").distinct().count() > 3
    assert index.select("bundle", "frame").distinct().count() > 10
    back = warc.read_bundles(spark, index)
    assert back.rdd.getNumPartitions() > 3
    found = back.collect()
    assert len(found) == len(rows)
    assert sorted((r["key"] is None, r["key"] or 0, r["payload_bytes"]) for r in found) == sorted(
        (k is None, k or 0, len((p or "").encode())) for k, _, p in rows
    )
    assert {r["bundle"][:8] for r in index.select("bundle").collect()} == {"file:///"}
