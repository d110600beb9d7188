"""Secrets in runs that no single alphabet holds."""

from __future__ import annotations

import base64
import random

import pytest
from llm_brute import documents

from wardflow.llm import secret_scan as sec

PICK = random.Random(21)
ALNUM = "".join(PICK.choice(sec.DIGITS + sec.LOWER + sec.UPPER) for _ in range(40))
BASE64 = base64.b64encode(bytes(PICK.randrange(256) for _ in range(40))).decode()
PROSE = ("the quick brown fox jumps over the lazy dog on the donau and the gesellschaft of the "
         "dampfer and the fahrt to the schiff ") * 400
HIDDEN = [
    (1, f"export DB_PASS={ALNUM} done", ALNUM),
    (2, f"AWS_ACCESS_KEY_VALUE={BASE64} done", BASE64),
    (3, f"https://h.example/x?sig={BASE64} done", BASE64),
    (4, f"see /a-b/{ALNUM} done", ALNUM),
    (5, f"see /my-app/some/long/path/of/words/{ALNUM}-and-many-more-words-after-it done", ALNUM),
]


def test_secrets_behind_names_and_in_paths(spark):
    rows = [(0, PROSE), *[(i, text) for i, text, _ in HIDDEN]]
    got = {r.doc_id: r for r in sec.find_secrets(documents(spark, rows)).collect()}
    masked = {r.doc_id: r.text for r in sec.mask_secrets(documents(spark, rows)).collect()}
    assert got[0].n_random == 0 and masked[0] == PROSE
    for i, text, value in HIDDEN:
        at = text.index(value)
        assert got[i].n_random >= 1, text
        assert any(s.start <= at and at + len(value) <= s.end for s in got[i].found)
        assert value not in masked[i] and "[random]" in masked[i] and masked[i].endswith(" done")
    assert masked[1] == "export DB_PASS=[random] done"
    assert masked[3] == "https://h.example/x?sig=[random] done"


@pytest.mark.parametrize("run, want", [
    ("abc", ["abc"]), ("abc==", ["abc=="]), ("a=b", ["a", "b"]), ("a=b=", ["a", "b="]),
    ("=a", ["a"]), ("==", []), ("a/b-c", ["a", "a/b", "b", "b-c", "c"]),
    ("n=a-b+c==", ["n", "a", "a-b", "b", "b+c==", "c=="]),
])
def test_pieces(run, want):
    assert sorted(run[a:b] for a, b in sec.pieces(run)) == sorted(want)
