"""URL filter: rules first, then a logistic regression on hashed character n-grams of host and path.

The regression is trained from a small labelled table of URLs. Judging is a map over the pages: no
shuffle, no join.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAMS = (3, 4, 5)
FEATURES = 1 << 14
STRENGTH = 0.01
BLOCK_FROM = 0.5

# (verdict, host, path); of the rules that fit, the longest decides.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# A small labelled table of names: what a URL filter is commonly asked to block, and ordinary ones.
BLOCKED = """
casino casino-royal online-casino casinobonus slots-casino jackpot-slots roulette bets sport-bets bets24 betting betting-tips
poker poker-bets poker-online gambling adult adult-video xxx-adult adultdating adult-cams porn porn-tube sex-cams
spam spamlist spam-mail link-farm content-farm pills pills-online buy-pills cheapmeds discount-pills viagra ads adserver
ads-click adtrack banner-ads phish-login phishing malware malware-drop warez warez-crack torrent-crack keygen
""".split()
ALLOWED = """
news daily-news newspaper weather weather-station forecast library university school college museum city cityhall garden
travel recipes kitchen bakery restaurant science history geography maps forum health hospital doctor pharmacy software wiki
music orchestra books bookshop train station sports football tennis art gallery theatre theory brother mother nation national
northern other together gathering author authority thinking tension attention information education mountain answer farmers
farm-shop farmers-market link-list video video-lessons cameras tracking-birds address addition reading roads mail login
shop content contact about archive calendar events jobs careers research students teachers parents children
articles report reports documents download products services support press blog team history-of-art animals nature water
""".split()
# Every name is shown as a site at these places, and in the path of these neutral hosts, so that neither the place
# nor the host, and neither part of a URL beside the one that holds the name, says anything about the label.
AT = ("", "www.", "m.", "blog.")
PLACES = (".test/", ".test/en/12", ".test/de/7.html", ".test/fr/30?page=2", ".test/es/5#top")
NEUTRAL = ("example.test", "www.site.test", "m.page.test", "blog.host.test")
PATHS = ("/{}", "/{}/", "/en/{}.html", "/{}/12", "/de/7/{}?page=2", "/online/{}/entertainment", "/articles/{}/information")


def host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def deciding_rule(of_host: Column, of_path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, site, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((of_host == site) | of_host.endswith("." + site)) & of_path.startswith(prefix)
        rule, verdict = F.when(fits, F.lit(site + prefix)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def char_grams(of_host: Column, of_path: Column, grams=GRAMS) -> Column:
    """Character n-grams of host and path, each led by the part it is from."""

    def cut(part: Column, lead: str, size: int) -> Column:
        framed = F.concat(F.lit("^"), part, F.lit("$"))
        # one match before every character that has enough after it: linear also in very long URLs
        found = F.regexp_extract_all(framed, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
        found = F.when(F.length(framed) < size, F.array(framed)).otherwise(found)
        return F.transform(found, lambda gram: F.concat(F.lit(lead), gram))

    return F.concat(*(cut(part, lead, n) for part, lead in ((of_host, "h"), (of_path, "p")) for n in grams))


def _featured(pages: DataFrame) -> DataFrame:
    table = pages.withColumn("grams", char_grams(F.col("host"), F.col("path")))
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(table)


def labelled_urls(spark: SparkSession, blocked=tuple(BLOCKED), allowed=tuple(ALLOWED)) -> DataFrame:
    """The labelled table (url, label): 1 is to be blocked. Names stand in the host or in the path."""
    sites = [(site, 1.0) for site in blocked] + [(site, 0.0) for site in allowed]
    table = F.array(*(F.struct(F.lit(site).alias("site"), F.lit(label).alias("label")) for site, label in sites))
    rows = spark.range(1).select(F.inline(table))
    sited = [(at, place) for at in AT for place in PLACES]
    pathed = [(neutral + before, after) for neutral in NEUTRAL for before, after in (path.split("{}") for path in PATHS)]
    around = F.array(*(F.struct(F.lit(f"https://{a}").alias("before"), F.lit(b).alias("after")) for a, b in sited + pathed))
    rows = rows.withColumn("around", F.explode(around))
    return rows.select(F.concat("around.before", "site", "around.after").alias("url"), "label")


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """A logistic regression from (url, label)."""
    table = labelled.select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), F.col("label").cast("double"))
    learner = LogisticRegression(regParam=STRENGTH, maxIter=60, featuresCol="features", labelCol="label")
    return learner.fit(_featured(table).select("features", "label"))


def judge_urls(pages: DataFrame, model: LogisticRegressionModel, rules=RULES, block_from: float = BLOCK_FROM) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, score.

    The longest rule that fits decides, else the model: block from ``block_from`` on. score is the model's
    probability in every case. A null url, or one without ``://``, has an empty host and path and is
    judged by the model as such. Repeated rows each have their result. Other columns are not read; an empty table
    gives an empty result.
    """
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = deciding_rule(F.col("host"), F.col("path"), rules)
    scored = model.transform(_featured(parts)).withColumn("score", vector_to_array("probability")[1])
    learnt = F.when(F.col("score") >= block_from, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learnt).alias("verdict"), "score")
