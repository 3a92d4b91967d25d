"""Every stage of the pipeline on what the one before it kept."""

import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from clickloom.llm import pii, quality
from clickloom.sinks import scratch
from tests.llm.test_jaccard import _brute
from tests.llm.test_packing import _check
from tests.llm.test_pii import masks
from tests.llm.test_quality import _posteriors

SF = "/root/testdata/sf0.01"
OTHER = "doc_id long, text string, lang string, source string, n_chars long, digest string, leaf int"


def _rows(frame):
    return {row["doc_id"]: row for row in frame.collect()}


@pytest.fixture(scope="module")
def kept(spark):
    """What goes into each stage, and comes out of the last."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(scratch.written(stage(spark, docs[-1], SF), name))
    return docs


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "pii", "packing"]


def test_columns_stay(kept):
    assert all(docs.schema.names == kept[0].schema.names for docs in kept[1:4])


def test_quality_rejects_bad_and_keeps_clean_documents(spark, kept):
    before, after = _rows(kept[0]), _rows(kept[1])
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i in before if i in labels and labels[i]["quality"] and not labels[i]["toxic"]]
    bad = [i for i in before if i in labels and not labels[i]["quality"]]
    assert sum(i in after for i in clean) > 0.98 * len(clean)
    assert sum(i in after for i in bad) < 0.1 * len(bad)
    assert all(after[i] == before[i] for i in after)


def test_one_of_each_near_duplicate_stays(kept):
    before, after = _rows(kept[1]), _rows(kept[2])
    classes = _brute([(i, row["text"]) for i, row in before.items()])
    assert set(after) == {class_id for class_id, _ in classes.values()}
    assert all(after[i] == before[i] for i in after)


def test_personal_data_is_replaced_and_nothing_else(kept):
    before, after = _rows(kept[2]), _rows(kept[3])
    assert set(before) == set(after)
    changed = 0
    for i, row in after.items():
        assert row["n_chars"] == len(row["text"]) and pii.base_spans(row["text"]) == []
        if pii.base_spans(before[i]["text"]):
            changed += 1
            assert row["text"] != before[i]["text"]
        elif 'token = "' not in before[i]["text"]:
            assert row == before[i]
    assert changed


def test_everything_is_packed(spark, kept):
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    rows = [row.asDict() for row in kept[4].collect()]
    lengths = defaultdict(int)
    for row in rows:
        lengths[row["doc_id"]] += row["length"]
    wanted = {
        i: len(library.encode(row["text"], add_special_tokens=False).ids) + 1 for i, row in _rows(kept[3]).items()
    }
    assert lengths == wanted
    assert _check(rows) <= 1.02 * math.ceil(sum(wanted.values()) / 2048) + 1
    run = [tuple(row) for row in corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect()]
    assert sorted(run) == sorted((row["doc_id"], row["piece"], row["ids_crc32"]) for row in rows)


def test_odd_documents(spark):
    good = " ".join(f"Sentence {n} of a good text is here." for n in range(30))
    rows = [(1, good), (1, good), (2, None), (3, ""), (None, good + " more"), (4, "word " * 60_000)]
    docs = spark.createDataFrame([(*row, None, None, None, "x", 1) for row in rows], OTHER)
    for docs_in in (docs, docs.limit(0)):
        frame = docs_in
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = scratch.written(stage(spark, frame, SF), name)
            assert frame.schema.names == docs.schema.names
        packed = corpus_pipeline.STAGES[-1][1](spark, frame, SF)
        assert np.isfinite([row["offset"] for row in packed.collect()]).all()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > len(rows)


def test_the_whole_pipeline_against_plain_python(spark):
    """Posteriors row by row, every two documents compared, every token tried, the library's ids."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    judged = _posteriors(quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet")), rows)
    texts = {
        r["doc_id"]: r["text"] for r in rows
        if judged[r["doc_id"]][0] >= 0.5 > judged[r["doc_id"]][1] and (r["text"] or "").split()
    }
    classes = _brute(list(texts.items()))
    ids = sorted({class_id for class_id, _ in classes.values()})
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    expected = set()
    for i, spans in zip(ids, masks([texts[i] for i in ids]), strict=True):
        text, free = "", 0
        for kind, start, end in sorted(spans, key=lambda s: (s[1], s[2], s[0])):
            if start >= free:
                text += texts[i][free:start] + f"<{pii.ALL_KINDS[kind]}>"
            free = max(free, end)
        tokens = np.array([*library.encode(text + texts[i][free:], add_special_tokens=False).ids, 0], "<u4")
        start = 0
        while start < len(tokens):
            stop = start + ((len(tokens) - start) % 2048 or 2048)
            expected.add((i, start, stop - start, zlib.crc32(tokens[start:stop].tobytes())))
            start = stop
    found = [row.asDict() for row in corpus_pipeline.run(spark, SF).collect()]
    assert {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in found} == expected
    assert len(found) == len(expected)
    _check(found)
