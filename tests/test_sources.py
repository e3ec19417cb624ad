from datetime import date

from tidemark.functions import dates
from tidemark.sources import archive, feeds, issue, pages

PAGE = """<!doctype html><html><head><meta property="article:published_time" content="2024-05-06"><meta name="robots" content="index"><link rel="alternate" type="application/rss+xml" href="/feed">
<script>var x = "<p>no</p>";</script><script type="application/ld+json">{"@graph": [{"@type": "Event", "name": "Summit", "startDate": "2024-06-01", "endDate": "2024-06-03"}]}</script></head>
<body><nav><a href="/menu">Menu</a></nav><article><h1>Levy &amp; law</h1><p>First <b>part</b><p>second<a href="doc.pdf" rel="nofollow">x</a> <a href="mailto:a@b">m</a><a href="../report">Report</a></article><footer>foot</footer>"""


def test_page():
    row = dict(zip("url title published modified start end summary body links feeds nofollow".split(), pages.read_page("https://h.example/event/1", PAGE), strict=True))
    assert row["title"] == "Summit" and row["published"] == "2024-05-06" and (row["start"], row["end"]) == ("2024-06-01", "2024-06-03")
    assert row["body"] == "Levy & law First part second x m Report"
    assert "foot" not in row["body"] and "no" not in row["body"].split()
    assert [x["target"] for x in row["links"]] == ["https://h.example/menu", "https://h.example/report"] and row["feeds"] == ["https://h.example/feed"]


def test_page_ranges_and_nothing():
    assert pages.read_page("https://h.example/event/2", "<p>30 Sep. - 02 Oct. 2026</p>")[4:6] == ("30 Sep 2026", "02 Oct 2026")
    assert pages.read_page("https://h.example/event/2", "<p>3-5 May 2026</p>")[4:6] == ("3 May 2026", "5 May 2026")
    assert pages.read_page("https://h.example/press/2", "<p>2024年1月2日</p>")[2] == "2024-01-02"
    assert pages.read_page("", None)[7] == "" and pages.read_page("u", "<<<>&#xZZ; <p")[7] is not None
    assert pages.read_page("https://h.example/", '<meta name="robots" content="NOFOLLOW"><a href="/x">x</a>')[8] == []


def test_feeds(spark):
    rss = "<rss><channel><item><title>A</title><link>/a</link><pubDate>Tue, 5 Nov 2024 04:54:54 +0530</pubDate></item><item><title>B</title></item><item><title>C</title><guid>https://c.example/</guid></item></channel></rss>"
    docs = spark.createDataFrame([("https://h.example/feed", rss), ("u2", "<html></html>"), ("u3", "not xml"), ("u4", None)], "url string, text string")
    got = feeds.parse_feeds(docs, "url", "text", limit=2).select("doc_url", "error", "link", dates.any_date("published_raw").alias("d")).collect()
    assert [(r.doc_url[:4], r.error, r.link, r.d) for r in got] == [
        ("http", None, "https://h.example/a", date(2024, 11, 5)), ("http", "no_title_or_link", "", None), ("http", "beyond_limit", "https://c.example/", None), ("u2", "not_a_feed", None, None), ("u3", "not_xml", None, None), ("u4", "not_xml", None, None),
    ]
    assert feeds.parse_feeds(docs.limit(0), "url", "text").count() == 0


def test_sniffing_and_replies(spark):
    texts = ["<?xml version='1.0'?>\n<rss>", "<urlset>", '{"a": 1}', "[1]", " <!DOCTYPE html>", "plain {x}", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.k for r in df.select(feeds.sniff("t").alias("k")).collect()] == ["feed", "sitemap", "json", "text", "html", "text", "text"]
    got = spark.createDataFrame([('so {"a": {"b": 1}} end',), ("none",), ("{broken",), (None,)], "t string").select(feeds.model_json("t").alias("j")).collect()
    assert [r.j for r in got] == ['{"a": {"b": 1}}', None, None, None]


def test_dates(spark):
    values = ["2024-01-02T10:00", "5 Nov 2024", "November 5, 2024", "25 Jan. 2025", "Tue, 05 Nov 2024 10:00:00 GMT", "31 Feb 2024", "x", "", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r.d for r in df.select(dates.any_date("v").alias("d")).collect()] == [date(2024, 1, 2), date(2024, 11, 5), date(2024, 11, 5), date(2025, 1, 25), date(2024, 11, 5), None, None, None, None]


def test_archive_replaces_days(spark, tmp_path):
    rows = lambda d, t: spark.createDataFrame([(d, 1, t)], "digest_date date, item_id long, title_en string")
    path = str(tmp_path / "archive")
    for d, t in ((date(2024, 1, 1), "a"), (date(2024, 1, 2), "b"), (date(2024, 1, 1), "c")):
        archive.write_archive(rows(d, t), path)
    got = archive.read_archive(spark, path, "item_id long, title_en string")
    assert {(str(r.digest_date), r.title_en) for r in got.collect()} == {("2024-01-01", "c"), ("2024-01-02", "b")}
    assert archive.read_archive(spark, path, "item_id long, title_en string", latest=1).first().title_en == "b"


def test_page_of_broken_markup():
    got = dict(zip("url title published modified start end summary body links feeds nofollow".split(), pages.read_page("https://h.example/x", '<h1>Été &eacute; &#8364;<p>One<div>two<article>In <b>bold<script>no</script> text <a href="/a">A</a <a href=/b>B</a>'), strict=True))
    assert got["title"].startswith("") and "In bold text" in got["body"] and "no" not in got["body"].split()
    ld = '<script type="application/ld+json">{broken</script><script type="application/ld+json">[{"@type": ["NewsArticle"], "headline": "H", "datePublished": "2024-02-03"}, {"@type": "Event", "startDate": "2024-03-01"}]</script>'
    row = pages.read_page("https://h.example/x", ld)
    assert row[1] == "H" and row[2] == "2024-02-03" and row[4:6] == ("2024-03-01", "")


def test_days_in_running_text():
    assert pages.day_range("Held 30 Sep. - 2 Oct 2026, then 4–6 May 2026") == ("4 May 2026", "6 May 2026")
    assert pages.day_range("room 3-5 on May 2026") == ("", "") and pages.day_range("") == ("", "")
    assert pages.labelled_date("Publication date 3 March 2024.".split()) == "3 March 2024" and pages.labelled_date("Publication date soon".split()) == ""
    assert pages.ideographic_date("于2024年1月2日，2025年3月4日") == "2024-01-02" and pages.ideographic_date("年月日") == ""
    assert list(pages.nodes({"a": [{"b": 1}, {"c": {"d": 2}}]}))[1:] == [{"b": 1}, {"c": {"d": 2}}, {"d": 2}]


def test_issue_schema(spark):
    import pytest

    good = '{"issue_title_en": "T", "title_support": [], "recent_news": [{"url": "u", "title_en": "t", "source_org": "s", "one_sentence_en": "o"}], "research_signals": [], "editorial_context_urls": []}'
    rows = [good, good.replace('"title_en": "t", ', ""), good.replace('"research_signals": [], ', ""), "{broken", None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(rows)], "k int, v string").select("k", issue.parse_issue("v").alias("i"))
    got = {r.k: r.m for r in df.select("k", issue.missing_fields(df["i"], 1).alias("m")).collect()}
    assert got[0] == [] and got[1] == ["recent_news.title_en"] and got[2] == ["research_signals"] and got[4] == ["not an issue"] and got[3]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        spark.createDataFrame([("{broken",)], "v string").select(issue.parse_issue("v", strict=True)).collect()
