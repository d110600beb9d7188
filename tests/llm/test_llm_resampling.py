from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from llm_brute import awkward_texts, documents, empty_documents, fold

from wardflow.llm import importance_resampling as ir
from wardflow.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, longest):
    words = [w.encode() for w in WORD.findall(fold(text or ""))]
    return words, words + ([a + b" " + b for a, b in zip(words, words[1:])] if longest > 1 else [])


def brute(rows, targets, p: ir.ResamplingParams):
    read = [features(t, p.longest) for _, t in rows]
    s, t = [0] * p.buckets, [0] * p.buckets
    for counts, texts in ((s, [f for _, f in read]), (t, [features(x, p.longest)[1]
                                                          for x in targets])):
        for found in texts:
            for f in found:
                counts[zlib.crc32(f) % p.buckets] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + p.buckets)
                                       / ((a + 1) * (sum(t) + p.buckets)))) for a, b in zip(s, t)]
    out = []
    for (i, _), (words, found) in zip(rows, read):
        h = int(hashlib.sha256(f"{p.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(f) % p.buckets] for f in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, len(words)])
    able = sorted((r for r in out if r[5] >= p.min_words),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[:p.percent * len(able) // 100]):
        row[4] = rank + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def target(spark, texts):
    return spark.createDataFrame([(t, "?", "?") for t in texts],
                                 "text string, c string, bucket string")


def drawn(docs, wanted, params):
    return sorted((tuple(r) for r in ir.resample(docs, wanted, params).collect()), key=str)


@pytest.mark.parametrize("longest, head", [(1, 0), (1, 1 << 15), (2, 5)])
def test_any_head_gives_the_same_result(spark, small, longest, head):
    params = ir.ResamplingParams(longest=longest, head_words=head, head_pairs=head)
    docs, wanted = table(spark, small, "documents"), table(spark, small, "benchmark")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    texts = [r.text for r in wanted.collect()]
    got = drawn(docs, wanted, params)
    assert got == brute(rows, texts, params)
    assert sum(r[4] is not None for r in got) > 10


@pytest.mark.parametrize("longest", [1, 2])
def test_awkward_rows_and_targets(spark, longest):
    params = ir.ResamplingParams(longest=longest, min_words=1, percent=70, buckets=97)
    texts = [None, "", "goes1 WORD3 on2", "goes1 WORD3 on2", "é\x00z 12a"]
    assert drawn(documents(spark), target(spark, texts), params) == brute(
        awkward_texts(), texts, params)


def test_ties_go_to_the_smaller_id_and_a_null_id_is_last(spark):
    text = " ".join(["same"] * 30)
    rows = [(i, text) for i in (5, 5, None, 5)] + [(i, text) for i in range(100, 140)]
    params = ir.ResamplingParams(percent=100)
    got = drawn(documents(spark, rows), target(spark, ["same"]), params)
    assert got == brute(rows, ["same"], params)
    assert sorted(r[4] for r in got) == list(range(1, len(rows) + 1))


def test_empty_tables(spark):
    params = ir.ResamplingParams()
    assert ir.resample(empty_documents(spark), target(spark, ["a"]), params).count() == 0
    rows = awkward_texts()
    assert drawn(documents(spark), target(spark, []), params) == brute(rows, [], params)


def test_weights_favour_texts_like_the_target(spark):
    rows = [(i, " ".join(f"{'near' if i < 50 else 'far'}{(i * 7 + j) % 40}" for j in range(60)))
            for i in range(400)]
    got = drawn(documents(spark, rows), target(spark, [rows[1][1], rows[3][1]]),
                ir.ResamplingParams())
    assert len([r for r in got if r[4] is not None]) == 40
    assert all(r[0] < 50 for r in got if r[4] is not None)


def test_states_continue_over_pairs():
    words = [b"alpha", "ü".encode(), b"9"]
    vocabulary = ir.Vocabulary(words[:1], [b"alpha 9"], 10_000)
    states = vocabulary.word_states(words)
    assert states == [zlib.crc32(w) for w in words]
    codes = np.arange(9)
    want = [zlib.crc32(a + b" " + b) % 10_000 for a in words for b in words]
    assert vocabulary.pair_buckets(codes, words, states).tolist() == want
