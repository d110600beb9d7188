"""The model of bytes as they are: no cap on its n-grams, and equal to a dictionary model."""

from __future__ import annotations

import math
import random

from llm_brute import kneser_ney as brute_model

from wardflow.llm import perplexity_rules as pr


def rows(pick, n):
    return [(i, "".join(pick.choice("ab c.\né#$%|12") for _ in range(pick.randint(0, 300))),
             pick.choice(["en", "de"])) for i in range(n)]


def brute_means(docs):
    models = {lang: brute_model([list(t.encode()) for _, t, x in docs if x == lang], 5, 256, 10)
              for lang in {x for _, _, x in docs}}
    out = {}
    for i, text, lang in docs:
        s = [10] * 4 + list(text.encode())
        if text:
            out[i] = -sum(models[lang](s[j:j + 4], s[j + 4]) for j in range(len(s) - 4)) \
                / (len(s) - 4)
    return out


def test_long_perplexity_equals_dictionary_model(spark):
    docs = rows(random.Random(8), 60)
    got = {r.doc_id: r.long_perplexity for r in pr.judge_quality(
        spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    want = brute_means(docs)
    assert {i for i, p in got.items() if p is not None} == set(want)
    assert all(abs(math.log(got[i]) - m) < 1e-4 for i, m in want.items())


def test_symbols_and_digits_are_not_folded(spark):
    docs = spark.createDataFrame(
        [("1" * 16, "a1a2a3a4a5###$$$%%%")], "slot string, text string")
    grams = {r.gram for r in pr.long_probabilities(docs).collect()}
    text = b"\n\n\n\na1a2a3a4a5###$$$%%%"
    assert grams == {int.from_bytes(text[i:i + 5], "big") for i in range(len(text) - 4)}


def test_ranges_and_groups_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(rows(random.Random(3), 40),
                                 "doc_id long, text string, lang string")
    whole = sorted(map(str, pr.judge_quality(docs).collect()))
    monkeypatch.setattr(pr, "RANGE_ROWS", 100)
    monkeypatch.setattr(pr, "PART_BYTES", 700)
    assert sorted(map(str, pr.judge_quality(docs).collect())) == whole
