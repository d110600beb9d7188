"""Toxicity over all words of the sample, against a plain version of the whole operator."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from llm_brute import documents

from wardflow.llm import textscan
from wardflow.llm import toxic_neighbours as tox
from wardflow.llm.common import table, text_buffers


def words_of(texts):
    """Distinct word hashes and counts of each text, in the order of the texts."""
    import pyarrow as pa
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    scanned = textscan.scan(data, offsets, textscan.letter_table())
    return [Counter(scanned.hash[a:b].tolist())
            for a, b in zip(scanned.first[:-1], scanned.first[1:])]


def plain_scores(docs, chosen, selected, params):
    """Every document against every example, one pair at a time."""
    examples = [(r.doc_id, r.toxic, dict(zip((t & (2 ** 64 - 1) for t in r.terms), r.counts)))
                for r in sorted(chosen, key=lambda r: r.doc_id)]
    df = Counter(t for _, _, terms in examples for t in terms)
    chosen_terms = {t & (2 ** 64 - 1) for t in selected}

    def unit(counts):
        raw = {t: (1 + math.log(c)) * (math.log((1 + len(examples)) / (1 + df[t])) + 1)
               * (params.emphasis if t in chosen_terms else 1)
               for t, c in counts.items() if t in df}
        length = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / length for t, w in raw.items()}

    vectors = [unit(terms) for _, _, terms in examples]

    def nearest(query, without=None):
        found = []
        for i, v in enumerate(vectors):
            cosine = round(sum(w * v[t] for t, w in query.items() if t in v), 9)
            if cosine > 0 and i != without:
                found.append((-cosine, i))
        return [(i, -c) for c, i in sorted(found)[:params.neighbours]]

    def vote(found):
        weights = [1 / (max(0, 1 - c) + params.softness) for _, c in found]
        return sum(w * examples[i][1] for w, (i, _) in zip(weights, found)) / sum(weights) \
            if found else 0.0

    used = [i for i, v in enumerate(vectors) if v]
    steps, values = tox.isotonic(np.array([vote(nearest(vectors[i], i)) for i in used]),
                                 np.array([examples[i][1] for i in used]))
    out = {}
    for doc_id, counts in docs:
        query = unit(counts)
        found = nearest(query)
        at = max(0, np.searchsorted(steps, vote(found) + 1e-12, side="right") - 1)
        out[doc_id] = (float(values[at]) if query else None,
                       [(examples[i][0], c) for i, c in found[:3]])
    return out


def test_scores_and_evidence_against_brute_force(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    params = tox.ToxicityParams()
    chosen = tox.examples(docs, labels.select("doc_id", "toxic"), params)
    texts = docs.select("doc_id", "text").collect()
    want = plain_scores(list(zip([r.doc_id for r in texts], words_of([r.text for r in texts]))),
                        chosen.collect(), tox.select_terms(chosen, params), params)
    got = tox.score_toxicity(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        score, evidence = want[r.doc_id]
        assert score is None or abs(r.score - score) < 1e-9
        assert [i for i, _ in evidence] == r.nearest
        assert np.allclose([c for _, c in evidence], r.cosines, atol=2e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_a_copy_of_an_example_has_it_as_nearest(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    examples = {r.doc_id for r in tox.examples(docs, labels.select("doc_id", "toxic"),
                                               tox.ToxicityParams()).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    copies = [(10 ** 9 + i, texts[i]) for i in examples if re.search(r"[A-Za-z]", texts[i] or "")]
    both = docs.select("doc_id", "text").union(documents(spark, copies).select("doc_id", "text"))
    got = {r.doc_id: r for r in tox.score_toxicity(both, labels).collect()}
    bags = dict(zip(texts, words_of(list(texts.values()))))
    for i, _ in copies:
        assert got[i].cosines[0] == 1.0
        assert bags[got[i].nearest[0]].keys() == bags[i - 10 ** 9].keys()


def test_equal_texts_of_both_labels_both_stay(spark):
    rows = [(i, f"the very same words in text {'aaa' if i < 4 else 'bbb'}") for i in range(1, 9)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, toxic int")
    kept = tox.examples(documents(spark, rows), labels, tox.ToxicityParams()).collect()
    used = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5}
    assert {(r.toxic, len(r.terms)) for r in kept} <= {(0, 7), (1, 7)}
    assert len(kept) == len({(i % 2, i < 4) for i in used})
