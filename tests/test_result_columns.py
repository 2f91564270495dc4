"""Results stage only what a result shows."""

from voxmill.plans import catalog

SF = "/root/testdata/sf0.001"


def test_results_write_no_other_columns(spark, monkeypatch):
    asked = []
    kept = catalog.staged_clean
    monkeypatch.setattr(catalog, "staged_clean", lambda s, d, *columns: asked.append(columns) or kept(s, d, *columns))
    assert catalog.result_view(spark, SF).count() == catalog.result_card(spark, SF).count() == 5
    assert len(asked) == 2 and all(asked)
    assert not any("tokens" in columns or "full_text_with_comments" in columns for columns in asked)
