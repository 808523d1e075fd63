from lapline.operators import weblinks as L

BASE = "https://results.example.org"


def _row(text, links):
    two = "".join(f'<p class="two"><a href="{h}" target="_blank">x</a></p>' for h in links)
    return f'<div class="row"><p class="round">{text}</p><div class="other">{two}</div></div>'


def test_event_selection_last_row_wins(spark):
    html = "<html>" + "".join([
        _row("Women's Freestyle 400m   Heats", ["/File/S1.pdf", "/File/R1.pdf"]),
        _row("Men's Freestyle 400m   Heats", ["/File/S2.pdf", "/File/R2.pdf"]),
        _row("Women's Freestyle 400m   Final", ["/File/S3.pdf", "/File/R3.pdf"]),
        _row("Men's Freestyle 400m (25m pool)", ["/File/S4.pdf", "/File/R4.pdf"]),
        _row("Mixed Freestyle 400m", ["/File/S5.pdf", "/File/R5.pdf"]),
        _row("Men's Freestyle 400m   Final", ["/File/S6.pdf"]),
        _row("Men's Backstroke 200m", ["/File/S7.pdf", "/File/R7.pdf"]),
    ]) + "</html>"
    pages = spark.createDataFrame([(1, f"{BASE}/2020/c", html)], "page_id long, url string, html string")
    out = L.links_per_competition(L.event_links(pages, BASE)).collect()
    assert [(r.mens_400_free_pdf, r.womens_400_free_pdf) for r in out] == [
        (f"{BASE}/File/R2.pdf", f"{BASE}/File/R3.pdf")]


def test_page_without_events_is_dropped(spark):
    html = _row("Men's Butterfly 100m", ["/a", "/b"])
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    assert L.links_per_competition(L.event_links(pages, BASE)).count() == 0


def test_competition_list(spark):
    def item(href, name, sport="SWIMMING"):
        return f'<div class="row"><h3 class="detail"><a href="{href}">{name}</a></h3><p>{sport}</p></div>'
    html = "".join([item("/2020/a", " Cup A "), item("/2020/b", "Cup B", "Athletics"),
                    item("/2019/c", "Old"), item("/2020/a", "Cup A again"),
                    item(f"{BASE}/2020/d", "Open 25m"), '<div class="row"><p>swimming</p></div>'])
    pages = spark.createDataFrame([(1, 2020, "u", html)], "page_id long, year int, url string, html string")
    rows = L.competition_rows(pages, BASE)
    assert [(r.competition, r.href) for r in rows.orderBy("row_pos").collect()] == [
        ("Cup A", f"{BASE}/2020/a"), ("Cup A again", f"{BASE}/2020/a"), ("Open 25m", f"{BASE}/2020/d")]
    first = L.dedupe_first_seen(rows)
    assert sorted((r.competition, r.href) for r in first.collect()) == [
        ("Cup A", f"{BASE}/2020/a"), ("Open 25m", f"{BASE}/2020/d")]
    assert [r.competition for r in L.drop_skipped_names(first).collect()] == ["Cup A"]
    assert L.year_range(rows, 2021, 2022).count() == 0


def test_anchor_links(spark):
    pages = spark.createDataFrame(
        [(1, "https://h.example.net/x/y?q", '<a href="/p/f.html">a</a> <a class="k" href="https://o/z">b</a>')],
        "page_id long, url string, html string")
    got = [(r.pos, r.abs_url, r.file_name) for r in L.anchor_links(pages).collect()]
    assert got == [(0, "https://h.example.net/p/f.html", "f.html"), (1, "https://o/z", "z")]


def test_visible_text_decodes_references(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("<b>O&#39;Neil</b> &amp; Co&nbsp;<i>Cup</i>",)], "h string")
    assert df.select(L.visible_text(F.col("h"))).first()[0] == "O'Neil & Co Cup"


def test_class_lists_quotes_and_line_breaks(spark):
    html = ("<div class='block-table'><div id=r1 class=\"row odd\">"
            "<p class='round big'>Women's Freestyle\n400m   Final</p>"
            "<p class=\"two\"><a target=_blank href='/File/S9.pdf'>x</a></p>"
            "<p class=\"two last\"><a href=\"/File/R9.pdf\">x</a></p></div></div>")
    pages = spark.createDataFrame([(1, f"{BASE}/2020/c", html)], "page_id long, url string, html string")
    out = L.links_per_competition(L.event_links(pages, BASE)).collect()
    assert [(r.mens_400_free_pdf, r.womens_400_free_pdf) for r in out] == [(None, f"{BASE}/File/R9.pdf")]


def test_older_event_test_lets_25_pass(spark):
    html = _row("Men's Freestyle 400m (25m pool)", ["/File/S4.pdf", "/File/R4.pdf"])
    pages = spark.createDataFrame([(1, f"{BASE}/2020/c", html)], "page_id long, url string, html string")
    assert L.event_links(pages, BASE).count() == 0
    assert [r.link for r in L.event_links(pages, BASE, exclude_25=False).collect()] == [f"{BASE}/File/R4.pdf"]


def _blocks(html):
    """Outermost rows with a stack, by hand."""
    import re
    depth, start, out = 0, None, []
    for m in re.finditer(r'(?i)<div\b[^>]*>|</div\s*>', html):
        if m[0][1] != "/":
            if start is None and re.search(r'class\s*=\s*["\'](?:[^"\']*\s)?row(?:\s[^"\']*)?["\']', m[0]):
                start = depth, m.end()
            depth += 1
        else:
            depth = max(depth - 1, 0)
            if start is not None and depth <= start[0]:
                out.append(html[start[1]:m.start()])
                start = None
    return out + ([html[start[1]:]] if start else [])


def test_nested_rows_belong_to_their_parent(spark):
    import random

    from pyspark.sql import functions as F

    from lapline.operators import weblinks as L
    rng = random.Random(2)
    tags = ['<div class="row">', '<div class="x row y">', "<div>", "<div class='rows'>", "</div>", "</div>", "</DIV >", "<p>a</p>", " text ", "<divan>"]
    pages = ["", "no rows", "</div></div><div class=\"row\">a</div>b", '<div class="row">open <div class="row">in</div> to the end']
    pages += ["".join(rng.choice(tags) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    got = spark.createDataFrame(list(enumerate(pages)), "i int, html string").select("i", L.row_blocks(F.col("html")).alias("b")).collect()
    assert {r["i"]: r["b"] for r in got} == {i: _blocks(p) for i, p in enumerate(pages)}


def test_html_is_searched_once_for_all_conditions(spark):
    """Conditions on what was found in a row's HTML stay above the search (pushed beneath it, each would search again)."""
    from lapline.operators import weblinks as L
    pages = spark.createDataFrame([(1, 2000, "u", "<div class='row'></div>")], "page_id long, year int, url string, html string")
    for frame in (L.competition_rows(pages.select("page_id", "year", "html")), L.event_links(pages.select("page_id", "url", "html"))):
        lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert not any("Filter" in l and "regexp_extract" in l for l in lines)
        assert frame.count() == 0
