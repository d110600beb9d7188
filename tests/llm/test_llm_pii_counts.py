from __future__ import annotations

from wardflow.llm.queries import LLM_QUERIES


def test_all_spans_of_a_document_are_counted(spark, small):
    got = LLM_QUERIES["op6_pii_supervision"](spark, small).collect()
    assert any(r.n_spans for r in got)
    for r in got:
        assert r.n_spans == len([s for s in r.spans.split(",") if s])
        assert r.n_spans >= r.n_email + r.n_ip + r.n_card + r.n_phone
