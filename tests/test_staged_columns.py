"""Queries that stage clean records write only the columns they read."""

from voxmill.plans import catalog

SF = "/root/testdata/sf0.001"


def test_staged_columns(spark):
    assert catalog.staged_clean(spark, SF, *catalog.SEARCHED).columns == list(catalog.SEARCHED)


def test_search_and_classifier_write_no_other_columns(spark, monkeypatch):
    asked = []
    kept = catalog.staged_clean
    monkeypatch.setattr(catalog, "staged_clean", lambda s, d, *columns: asked.append(columns) or kept(s, d, *columns))
    catalog.search_topk(spark, SF)
    catalog.retrieval_hits(spark, SF)
    assert all(asked) and not any("tokens" in columns or "comments" in columns for columns in asked)
