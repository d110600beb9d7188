from __future__ import annotations

import random

import numpy as np
from llm_brute import awkward_texts, documents, empty_documents, leaks

from wardflow.llm import decontamination as dec
from wardflow.llm import toxic_neighbours as tox
from wardflow.llm.common import table


def passages():
    pick = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    return [(i, " ".join(pick.choice(words) for _ in range(n)))
            for i, n in enumerate([1, 2, 3, 4, 5, 6, 14, 30, 30, 55])]


def leaky_documents(items):
    pick = random.Random(3)
    out = awkward_texts()
    for k in range(80):
        _, passage = pick.choice(items)
        words = passage.split()
        for _ in range(pick.choice([0, 0, 1, 2, 4])):
            words[pick.randrange(len(words))] = f"q{pick.randrange(1000)}"
        if pick.random() < 0.2:
            words = words[:max(1, len(words) * 9 // 10)]
        around = [f"z{pick.randrange(10 ** 6)}" for _ in range(pick.choice([0, 3, 60]))]
        said = around + words + around[::-1]
        out.append((100 + k, " ".join(said).upper() if k % 5 == 0 else " , ".join(said)))
    return out


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "?", "?") for i, t in items],
                                 "item_id long, text string, length string, fp string")


def test_leaks_against_brute_force(spark):
    items = passages() + [(50, None), (51, ""), (None, "some words that nobody has"),
                          (52, passages()[7][1])]
    rows = leaky_documents(passages())
    got = dec.find_leaks(documents(spark, rows), benchmark(spark, items)).collect()
    want = leaks(rows, items)
    found = {(r.doc_id, r.item_id): r.similarity for r in got}
    assert len(found) == len(got)
    assert set(found) <= set(want)
    # SimHash is exact within its radius; at the limit of similarity a few pairs lie outside.
    missed = [p for p in want if p not in found]
    assert all(want[p] < 0.9 for p in missed) and len(missed) <= 0.01 * len(want)
    assert all(abs(found[p] - want[p]) < 1e-9 for p in found if want[p] > 0.95)


def test_leaks_of_supplied_tables(spark, small):
    docs, items = table(spark, small, "documents"), table(spark, small, "benchmark")
    got = {(r.doc_id, r.item_id) for r in dec.find_leaks(docs, items).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == set(leaks(rows, [(r.item_id, r.text) for r in items.collect()]))


def test_leaks_on_empty_tables(spark):
    assert dec.find_leaks(empty_documents(spark), benchmark(spark, passages())).count() == 0
    assert dec.find_leaks(documents(spark), benchmark(spark, [])).count() == 0


def test_every_fingerprint_within_the_radius_shares_a_block_neighbour():
    pick = random.Random(6)
    near = {width: set(dec._neighbours(19, width)) for width in (12, 13)}
    assert len(near[13]) == 378 and sum(width for _, width in dec.BLOCKS) == 64
    for _ in range(2000):
        a = pick.getrandbits(64)
        b = a
        for bit in pick.sample(range(64), pick.randint(0, 19)):
            b ^= 1 << bit
        assert any(((a ^ b) >> first) & ((1 << width) - 1) in near[width]
                   for first, width in dec.BLOCKS)


def test_counted_multisets():
    a = np.array([5, 5, 7, 5], np.uint64)
    b = np.array([5, 9, 5], np.uint64)
    assert len(np.intersect1d(dec.counted(a), dec.counted(b))) == 2
    assert len(np.unique(dec.counted(a))) == 4


def test_nearest_examples_are_exact():
    pick = np.random.default_rng(1)
    vectors = [{int(t): float(w) for t, w in zip(pick.choice(30, 5, replace=False),
                                                 pick.random(5).round(1) + 0.1)}
               for _ in range(400)]
    index = tox.BlockMaxIndex(vectors, 30, 16)
    for number, query in enumerate(vectors[:80]):
        want = sorted((-round(sum(w * v.get(t, 0) for t, w in query.items()), 9), i)
                      for i, v in enumerate(vectors) if i != number and set(v) & set(query))[:10]
        assert [(i, -s) for s, i in want] == index.search(query, 10, without=number)


def test_isotonic_steps_rise():
    steps, values = tox.isotonic(np.array([0.1, 0.1, 0.4, 0.5, 0.9]), np.array([0, 1, 0, 1, 1]))
    assert (np.diff(steps) > 0).all() and (np.diff(values) > 0).all()


def test_held_out_accuracy_and_no_use_of_held_out_labels(spark):
    root = "/root/testdata/sf0.01"
    docs, labels = table(spark, root, "documents"), table(spark, root, "labels")
    scored = tox.score_toxicity(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in scored if r.held_out and r.doc_id in truth]
    assert len(scored) == docs.count()
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.9
    flipped = labels.select("doc_id", (1 - labels.toxic).alias("toxic")).where(tox.held_out())
    mixed = labels.select("doc_id", "toxic").where(~tox.held_out()).union(flipped)
    again = {r.doc_id: r.score for r in tox.score_toxicity(docs, mixed).collect()}
    assert again == {r.doc_id: r.score for r in scored}


def test_toxicity_of_awkward_rows(spark):
    pick = random.Random(7)  # texts that differ in more than the label's word, or they count once
    said = [" ".join("".join(pick.choice("abcdefgh") for _ in range(5)) for _ in range(8))
            for _ in range(400)]
    rows = awkward_texts() + [(i, said[i] + (" badword" if i % 3 == 0 else " nice"))
                              for i in range(100, 400)]
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0), "?") for i in range(100, 400)] + [(None, 1, "?"), (3, None, "?"),
                                                                (101, 0, "?")],
        "doc_id long, toxic int, score string")
    got = tox.score_toxicity(documents(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [(r.doc_id, r.score) for r in got if (r.doc_id or 0) >= 100
            and r.predicted != int(r.doc_id % 3 == 0)] == []
    assert tox.score_toxicity(empty_documents(spark), labels).count() == 0
    none = tox.score_toxicity(documents(spark), labels.limit(0)).collect()
    assert len({r.score for r in none}) == 1 and none[0].score < 0.5
