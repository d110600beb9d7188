from __future__ import annotations

import base64
import hashlib
import random

from llm_brute import awkward_texts, documents, empty_documents, pii_spans, secret_spans

from wardflow.llm import pii_supervision as pii
from wardflow.llm import secret_scan as sec


def digest(kinds, spans):
    return hashlib.sha256(
        ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def secret_rows():
    pick = random.Random(9)
    raw = bytes(pick.randrange(256) for _ in range(33))
    return awkward_texts() + [
        (20, "API_KEY = 'abcdef' and Token: x.y=z/9 passwd=12345 secret:\"s3cr3t\""),
        (21, "ſecret=abcdefgh toKen=abcdefgh"),  # not ASCII letters
        (22, "AKIA" + "Q" * 16 + " AKIASHORT é AKIA" + "7" * 30),
        (23, "é" * 5 + " " + raw.hex() + " 0123456789abcdef01234567x"),
        (24, "key " + base64.b64encode(raw).decode() + " end"),
        (25, "the_quick_brown_fox_jumps_over_the_lazy_dog and donaudampfschifffahrtsgesellschaft"),
        (26, "12345678901234567890123456789 " + "-" * 60),
        (27, "token=abc token=abcdef token token=zzzzzz"),
    ]


def test_secrets_of_awkward_rows(spark):
    rows = secret_rows()
    got = sec.find_secrets(documents(spark, rows)).collect()
    want = sorted((str(i), digest(sec.KINDS, secret_spans(t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[24].n_random == 1 and by_id[24].spans.startswith("random:4:")
    assert by_id[26].n_random == 0
    for r in got:
        base = secret_spans(dict(rows).get(r.doc_id)) if r.doc_id not in (None, 1, 6) else []
        assert {f"{sec.KINDS[k]}:{a}:{b}" for a, k, b in base} <= set(r.spans.split(","))
    assert sec.find_secrets(empty_documents(spark)).count() == 0


def test_long_words_and_names_are_not_random(spark):
    prose = ("the quick brown fox jumps over the lazy dog on the donau and the gesellschaft of "
             "the dampfer and the fahrt to the schiff ") * 400
    got = sec.find_secrets(documents(spark, [(1, prose), secret_rows()[-3], secret_rows()[-4]]))
    assert {r.doc_id: r.n_random for r in got.collect()} == {1: 0, 25: 0, 24: 1}


def test_masking_replaces_spans_and_keeps_the_rest(spark):
    rows = secret_rows()
    docs = documents(spark, rows)
    masked = {r.doc_id: r for r in sec.mask_secrets(docs).collect()}
    assert sec.mask_secrets(docs).columns == docs.columns
    assert masked[24].text == "key [random] end" and masked[24].n_chars == len("key [random] end")
    assert masked[27].text == "token=abc [assign] token [assign]"
    assert masked[7].text == dict(rows)[7] and masked[3].text is None
    assert sec.mask_secrets(docs).count() == len(rows)


def test_battery_tells_random_strings_from_patterns():
    pick = random.Random(2)
    accepted = 0
    for name, alphabet in sec.ALPHABETS:
        for n in (20, 40, 200):
            accepted += sum(sec.battery("".join(pick.choice(alphabet) for _ in range(n)),
                                        alphabet) >= 1e-3 for _ in range(30))
        assert sec.battery((alphabet * 9)[:120], alphabet) < 1e-3
        assert sec.battery(alphabet[0] * 40, alphabet) < 1e-3
    assert accepted >= 0.99 * 30 * 3 * len(sec.ALPHABETS)


def test_tails_against_direct_sums():
    from math import comb
    for n, k, p in ((20, 5, 0.1), (40, 30, 0.5), (10, 0, 0.2), (64, 64, 0.3)):
        direct = sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k, n + 1))
        assert abs(sec.binomial_tail(n, k, p) - direct) < 1e-9
    assert abs(sec.chi_squared_tail(18.307, 10) - 0.05) < 2e-3
    assert abs(sec.normal_tail(1.959964) - 0.05) < 1e-5


def test_false_discovery_control_by_length_group():
    counts = [(0, 500, 10), (0, 100, 90), (0, 0, 900), (1, 250, 3), (1, 0, 1)]
    got = sec.thresholds(counts, 1e-3)
    for group in (0, 1):
        p = sorted(10 ** (-level / 100) for g, level, n in counts if g == group for _ in range(n))
        passing = [i for i in range(len(p)) if p[i] * len(p) <= 1e-3 * (i + 1)]
        below = p[passing[-1]] if passing else -1.0
        assert (10 ** (-got[group] / 100) if passing else -1.0) == below


def test_pii_patterns_by_fuzz():
    pick = random.Random(1)
    parts = [*"01234567890123456789.-+ ()@ab", "4111 1111 1111 1111", "a@b.c", "1.2.3.4",
             "+1 (555) 555-1234", "٣", "256.1.1.1"]
    for _ in range(20_000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 40)))
        assert pii.base_spans(text) == pii_spans(text)
    assert pii.base_spans("a" * 200_000 + "1" * 200_000) == []


def pii_rows():
    return awkward_texts() + [
        (30, "write to é.max_m+x@mail.example.co.uk, or call +49 (30) 1234-5678."),
        (31, "host 10.0.0.1 and 999.1.1.1, card 4111-1111 11111111, not 4111111111111112"),
        (32, "call (212) 555-0143 or 212-555-0199 today"), (33, "iban GB82 WEST 1234 5698 7654 32"),
        (34, "Dr. Maria Schmidt and Mr X"), (35, "order 1234-5678-9012-3456 ticket 078-05-1120"),
    ]


def test_pii_of_awkward_rows(spark):
    rows = pii_rows()
    got = pii.find_pii(documents(spark, rows)).collect()
    want = sorted((str(i), digest(pii.KINDS, pii_spans(t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert (by_id[30].n_email, by_id[30].n_phone, by_id[31].n_ip, by_id[31].n_card) == (1, 1, 1, 1)
    assert "phone_local" in by_id[32].spans and "iban" in by_id[33].spans
    assert all(0 <= s.probability <= 1 for r in got for s in r.found)
    assert pii.find_pii(empty_documents(spark)).count() == 0


def test_reliabilities_are_recovered():
    import numpy as np
    pick = np.random.default_rng(4)
    true = np.array([0.95, 0.8, 0.7, 0.6])
    label = pick.random(20_000) < 0.3
    ballots = np.where(pick.random((20_000, 4)) < true, 1, -1) * np.where(label, 1, -1)[:, None]
    ballots[pick.random(ballots.shape) < 0.2] = 0
    rows, place, n = np.unique(ballots, axis=0, return_inverse=True, return_counts=True)
    post, accuracy, share = pii.estimate(np.zeros(len(rows), np.int64), rows, n.astype(float),
                                         pii.PiiParams())
    assert np.abs(accuracy - true).max() < 0.03 and abs(share[0] - 0.3) < 0.03
    assert ((post[place.reshape(-1)] > 0.5) == label).mean() > 0.9
