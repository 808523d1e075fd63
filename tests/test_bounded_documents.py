"""A race's sheets and a year's pages are bounded by keys of the data; every form of them gives the same rows."""

from pyspark.sql import functions as F

from lapline.operators import parse as P
from lapline.operators import weblinks as L
from lapline.sources import fixtures as FX
from lapline.sources import tables as T
from tests.conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_smaller_sessions_give_same_rows(spark, monkeypatch):
    expected = FX.raw_results(spark, SF_SMALL, with_sex=False).filter(F.col("final_time").isNotNull())
    monkeypatch.setattr(FX, "SESSION_SUPPLIERS", 2)
    sheets = FX.render_sheets(spark, SF_SMALL)
    assert sheets.groupBy("Link").count().filter("count > 1").count() > 0   # races really span sheets
    assert sheets.filter(F.col("text").contains("\nDSQ ")).count() > 0
    assert _same(P.parse_sheets(sheets.select("Link", "text")), expected)
    pages = FX.render_sheet_pages(spark, SF_SMALL)
    joined = T.join_pages(pages, ("Link", "session"))
    assert joined.count() == sheets.count()
    assert _same(P.parse_sheets(joined.drop("session")), expected)


def test_smaller_pages_give_same_links(spark, monkeypatch):
    base_links = L.links_per_competition(L.event_links(FX.portal_pages(spark, SF_SMALL))).cache()
    base_list = L.dedupe_first_seen(L.competition_rows(FX.competition_list_pages(spark, SF_SMALL))) \
        .select("year", "competition", "href").cache()
    base_links.count(), base_list.count()
    monkeypatch.setattr(FX, "PAGE_KEYS", 2)
    portal = FX.portal_pages(spark, SF_SMALL)
    assert portal.groupBy("url").count().filter("count > 1").count() > 0
    assert _same(L.links_per_competition(L.event_links(portal)), base_links)
    listed = L.dedupe_first_seen(L.competition_rows(FX.competition_list_pages(spark, SF_SMALL)))
    assert _same(listed.select("year", "competition", "href"), base_list)
