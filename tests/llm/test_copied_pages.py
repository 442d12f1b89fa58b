"""Copies of one article are no boilerplate of their host."""

from __future__ import annotations

import corpus_pipeline


def test_a_copied_article_keeps_its_lines(spark, docs_of):
    article = "the article begins\nthe article goes on"
    rows = [(i, f"menu\nown page {i}", "en", host) for host in ("a", None) for i in range(90)]
    rows += [(100 + i, article, "en", host) for host in ("a", None) for i in range(10)]
    rows += [(200, None, "en", "a"), (201, None, "en", "a"), (202, "", "en", None)]
    out = corpus_pipeline.drop_lines(spark, docs_of(rows), "")
    got = [r.text for r in out.collect()]
    assert len(got) == len(rows)
    assert got.count(article) == 20 and got.count(None) == 2
    assert not any("menu" in t for t in got if t)
