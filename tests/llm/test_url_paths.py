"""Verdicts learnt for hosts and paths that the labelled table does not show."""

import pytest

from starfold.llm.url_filter import AT, NEUTRAL, PATHS, PLACES, judge_urls, labelled_urls, train

from .conftest import by_id

BAD = [
    "http://x.example.org/casino/poker-bets", "http://x.example.org/adult-video/1", "https://tionsh.example.org/en/free-casino-bonus",
    "http://thonth.example.org/fr/buy/cheap-pills.html", "http://casino-win.example.org/en/12", "https://m.adult-x.example.org/de/7",
    "http://www.spam-farm.example.org/x", "http://poker-palace.example.org/", "http://a.example.org/online/poker/tournament",
]
GOOD = [
    "http://x.example.org/weather/forecast", "http://x.example.org/en/1", "https://tionsh.example.org/en/free-concert",
    "http://city-museum.example.org/history/12", "https://m.thonth.example.org/fr/1203#top", "http://x.example.org/",
    "http://orchard.example.org/bookshop/articles/3.html", "http://farmers.example.org/en/vegetables",
]


@pytest.fixture(scope="module")
def judged(spark):
    table = spark.createDataFrame(list(enumerate(BAD + GOOD)), "page_id long, url string")
    rows = judge_urls(table, train(labelled_urls(spark)), rules=())
    return by_id(rows, "page_id")


@pytest.mark.parametrize("k", range(len(BAD + GOOD)))
def test_verdicts(judged, k):
    assert judged[k].verdict == ("block" if k < len(BAD) else "allow"), ((BAD + GOOD)[k], judged[k].score)


def test_names_stand_in_both_parts_alike(spark):
    rows = labelled_urls(spark, ("bad",), ("fine",)).collect()
    urls = {label: {r.url.replace(name, "*") for r in rows if r.label == label} for label, name in ((1.0, "bad"), (0.0, "fine"))}
    assert urls[1.0] == urls[0.0] and len(rows) == 2 * (len(AT) * len(PLACES) + len(NEUTRAL) * len(PATHS))
