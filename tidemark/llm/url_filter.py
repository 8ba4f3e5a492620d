"""URL filter: host/path rules first, and for the urls they leave open a logistic regression on hashed character
n-grams of host and path, trained on a small labelled url table.

Everything is DataFrame expressions and ``pyspark.ml``; no Python runs on the executors. The rules are a short
parameter (one CASE branch each). The labelled table may be given as a DataFrame, of which about ``TRAIN_ROWS`` rows
chosen by a hash are used (all, if there are fewer); by default it is the table ``LABELLED`` below.

Cases: a null url, or one without ``://``, has empty host and path, fits no rule and is judged on the empty features;
rules of equal length go to the earlier one; with labels of one verdict only that verdict is given to all open urls,
with no labels ``allow``; an empty table gives no rows; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host/path, verdict); a rule fits its host and all subdomains when the url's path starts with the rule's.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
TRAIN_ROWS = 20_000
#: The labelled url table, invented urls of unwanted and of ordinary sites.
BLOCKED = (
    "http://casino.example/win", "https://online-casino.example.com/", "http://www.casino-bonus.example.org/en/1", "http://win-casino.example.net/slots",
    "http://free-bets.example/", "https://best-bets.example.com/odds", "http://sports-bets.example.net/en/2", "http://poker-win.example.org/de/4",
    "http://adult.example/x", "https://adult-videos.example.com/", "http://www.adult-chat.example.net/en/5", "http://xxx-adult.example.org/fr/6",
    "http://cheap-pills.example/", "https://pills-online.example.com/buy", "http://diet-pills.example.net/en/3", "http://cheap-meds.example.org/es/8",
    "http://ads.example/track", "https://ads-server.example.com/click", "http://track-ads.example.net/en/9", "http://click-track.example.org/en/7",
    "http://spam.example/farm", "https://link-farm.example.com/", "http://spam-links.example.net/de/3", "http://www.spam-mail.example.org/en/1",
)
ALLOWED = (
    "http://news.example/today", "https://www.library.example.com/en/12", "http://weather.example.net/de/7", "http://school.example.org/fr/31",
    "https://museum.example/", "http://blog.garden.example.com/en/204", "http://www.history.example.net/es/55", "https://science.example.org/en/9",
    "http://m.recipes.example.com/fr/410", "http://travel.example.net/en/77.html", "https://music.example.org/de/18", "http://www.theatre.example.com/en/6",
    "http://health.example.net/en/1200", "https://blog.books.example.org/en/33", "http://m.trains.example.com/de/940", "http://www.council.example.net/fr/2",
    "https://maps.example.org/es/15?page=2", "http://north.example.com/en/8123", "http://thest.example.net/en/15644", "https://www.enter.example.org/de/6671",
    "http://m.station.example.com/fr/18130.html", "http://blog.intern.example.net/es/42#top", "https://other.example.org/en/300", "http://www.reading.example.com/de/29",
    "http://lesson.example.net/en/5120", "https://m.nation.example.org/fr/64", "http://blog.letter.example.com/en/707", "http://www.thread.example.net/de/38?ref=x",
    "https://river.example.org/es/91", "http://m.mother.example.com/en/2050", "http://winter.example.net/fr/11", "https://blog.under.example.org/en/480",
    "http://www.order.example.com/es/7", "http://m.sister.example.net/en/3999", "https://stone.example.org/de/86", "http://blog.house.example.com/fr/254",
)
BUCKETS = 1 << 14
GRAM_SIZES = (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, says in sorted(reversed(rules), key=lambda r: len(r[0])):  # a later step overrides an earlier one
        domain, slash, rest = name.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(name)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def char_grams(text: Column, mark: str) -> Column:
    """All character n-grams of the text between edge marks, each named after its part of the url."""
    edged = F.concat(F.lit("^"), text, F.lit("$"))
    cut = lambda k: F.when(
        F.length(edged) >= k,
        F.transform(F.sequence(F.lit(1), F.length(edged) - (k - 1)), lambda i: F.concat(F.lit(mark), F.substring(edged, i, F.lit(k)))),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(*[cut(k) for k in GRAM_SIZES])


def _features(df: DataFrame) -> DataFrame:
    grams = F.concat(char_grams(F.col("host"), "h"), char_grams(F.col("path"), "p"))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="url_grams", outputCol="url_features").transform(
        df.withColumn("url_grams", grams))


def classify(pages: DataFrame, rules: tuple = RULES, labelled: DataFrame | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict for every row; ``labelled`` has url and verdict columns."""
    host, path = host_and_path(F.col("url"))
    rule, says = matched_rule(F.col("host"), F.col("path"), rules)
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumns({"rule": rule, "said": says})
    if labelled is None:
        urls = [F.struct(F.lit(u).alias("url"), F.lit(v).alias("verdict")) for us, v in ((BLOCKED, "block"), (ALLOWED, "allow")) for u in us]
        labelled = pages.sparkSession.range(1).select(F.inline(F.array(*urls)))
    share = F.lit(int(min(1.0, rows / max(1, labelled.count())) * 1_000_000))
    known = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < share).select(
        host.alias("host"), path.alias("path"), F.col("verdict").alias("said"))
    kinds = sorted(r["said"] for r in known.select("said").distinct().collect())
    if kinds == ["allow", "block"]:
        fit = LogisticRegression(featuresCol="url_features", labelCol="blocked", predictionCol="blocks", probabilityCol="url_p",
                                 rawPredictionCol="url_raw", regParam=1e-3, maxIter=50, standardization=False)
        model = fit.fit(_features(known).select("url_features", (F.col("said") == "block").cast("double").alias("blocked")))
        judged = model.transform(_features(parsed))
        open_verdict = F.when(F.col("blocks") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    else:
        judged, open_verdict = parsed, F.lit(kinds[0] if kinds else "allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce(F.col("said"), open_verdict).alias("verdict"))
