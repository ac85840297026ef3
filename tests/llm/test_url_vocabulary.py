from __future__ import annotations

from tradewind.llm.url_vocabulary import DEFAULT_VOCABULARY, Vocabulary, judge_urls

VOCABULARY = Vocabulary(strict=("casino", "cas"), soft=("spam", "ads", "win"), soft_limit=2)


def judge(spark, *urls, **options):
    rows = [(i, u, "x") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    return [tuple(r)[1:5] for r in judge_urls(pages, vocabulary=VOCABULARY, **options).orderBy("page_id").collect()]


def test_parts_and_rules(spark):
    assert judge(
        spark,
        "http://Example.NET/en/1?q#f",
        "http://example.net/en",
        "http://a.b.example.com/de/x",
        "http://badexample.com/de/x",
        "ftp://w.org/fr/",
        "http://x.net",
        "http://x.net?/a",
        None,
        "",
        "example.net/en/",
        "http://a.org/x://b.net/",
    ) == [
        ("example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/en", "net/", "block"),
        ("a.b.example.com", "/de/x", "example.com/de/", "block"),
        ("badexample.com", "/de/x", None, "allow"),
        ("w.org", "/fr/", "org/fr/", "allow"),
        ("x.net", "", None, "allow"),
        ("x.net", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("a.org", "/x://b.net/", None, "allow"),
    ]


def test_vocabulary_counts_with_boundaries(spark):
    verdicts = [
        v
        for *_, v in judge(
            spark,
            "http://casino.com/", "http://mycasinos.com/", "http://my-Casino.com/", "http://spam.com/spam/spam",
            "http://spam.com/ads", "http://spammy.com/adsl", "http://a.com/?casino", "http://é.com/ads_win", rules={},
        )
    ]
    assert verdicts == ["block", "allow", "block", "allow", "block", "allow", "allow", "block"]


def test_empty_vocabulary_and_table(spark):
    pages = spark.createDataFrame([(None, "http://casino.com/")], "page_id long, url string")
    got = judge_urls(pages, rules={}, vocabulary=Vocabulary((), ())).collect()
    assert [(r["page_id"], r["verdict"]) for r in got] == [(None, "allow")]
    assert judge_urls(pages.where("false")).collect() == []


def test_default_vocabulary_knows_topics_and_inflections(spark):
    spam = ["best-casinos.com/", "discount-pharmacy.com/", "shop.com/buy/viagra", "betting-odds.com/", "a.com/payday-loans",
            "nude-webcams.com/", "lucky-winners.com/prizes", "a.com/cheapest/pills", "x.com/keygens/"]
    plain = ["pharmacy.edu/", "adult-education.edu/", "news.com/essex", "farm.com/", "a.com/alphabets", "a.com/scunthorpe/analysis"]
    rows = [(i, f"http://{u}") for i, u in enumerate(spam + plain)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = [r["verdict"] for r in judge_urls(pages, rules={}).orderBy("page_id").collect()]
    assert got == ["block"] * len(spam) + ["allow"] * len(plain)
    terms = DEFAULT_VOCABULARY.strict + DEFAULT_VOCABULARY.soft
    assert len(terms) == len(set(terms)) and all(t == t.lower() for t in terms)


def test_forms_of_one_term_are_one_hit(spark):
    urls = ["bet.com/bets/betting", "bet.com/odds", "pills.com/pill", "drugs.gov/drugstore", "security.org/malware/report",
            "wiki.org/roulette", "cheap.com/pills", "free-bets.com/"]
    pages = spark.createDataFrame([(i, f"http://{u}") for i, u in enumerate(urls)], "page_id long, url string")
    got = judge_urls(pages, rules={}).orderBy("page_id").collect()
    assert [r["soft_hits"] for r in got] == [1, 2, 1, 1, 1, 1, 2, 2]
    assert [r["verdict"] for r in got] == ["block" if r["soft_hits"] > 1 else "allow" for r in got]


def test_unnamed_terms_name_themselves():
    vocabulary = Vocabulary((), ("bet", "bets", "win"), forms=(("bets", "bet"),))
    assert vocabulary.terms_by_name() == {"bet": ["bet", "bets"], "win": ["win"]}


def test_long_and_repeated_urls(spark):
    urls = ["http://a.com/" + "x/" * 200_000 + "win/ads", "http://a.com/win", "http://a.com/win"]
    assert [v for *_, v in judge(spark, *urls, rules={})] == ["block", "allow", "allow"]
