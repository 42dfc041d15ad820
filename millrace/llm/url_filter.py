"""URL filters: rules for hosts and paths, then logistic regression on hashed character n-grams."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 4
FEATURES = 1 << 14
REGULARIZATION = 0.002
#: Urls at least this likely to be unwanted are blocked.
BLOCK_AT = 0.5

#: (verdict, host, path), the longest fitting rule wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: The small labelled table: what hosts are named after, 1 for unwanted. It was written by hand from
#: common words of such hosts, and of hosts that nobody minds; none of the unwanted names on the
#: supplied pages is in it.
LABELLED_NAMES = (
    (1, "casino win poker slots jackpot roulette betting bets-online bingo lottery gamble "
        "casino-online poker-room big-win sports-bets lucky-slots"),
    (1, "adult xxx porn sex-cams escort nude hot-girls sex-video webcam-sex adult-video erotic"),
    (1, "pills viagra cialis pharmacy-cheap meds-online diet-pills weight-loss cheap-meds replica-watches"),
    (1, "ad-server tracker click-ads popads banner-ads adtrack pixel-track clicktrack affiliate-ads"),
    (1, "link-farm seo-spam content-farm backlinks free-money payday-loan crypto-giveaway warez malware "
        "phishing keygen torrent-crack get-rich download-crack"),
    (0, "news weather science library museum school university garden travel history kitchen recipes music art "
        "sports-club city-council hospital research journal archive gallery theatre books poetry"),
    (0, "thething nation station motion reader other water winter letter center ocean region tion-press there thisone "
        "that-other thorn thread throne thrift northern southern brother father mother weather feather"),
    (0, "developer python database compiler network kernel hardware software robotics astronomy biology chemistry "
        "mathematics geometry physics geology climate forest river mountain island"),
    (0, "stationery nations rationed thenation thirds thousand theory theatres thermal thinker thunder athens ether "
        "leather heather gather either neither rather whether tether bother lather ration notion lotion potion"),
)
_HOSTS = ("http://{}.example.com/en/{}", "https://www.{}.example.org/de/{}.html", "http://m.{}.example.net/fr/{}?page=2",
          "https://blog.{}.example.com/es/{}/", "https://{}.example.org/{}#top", "http://www.{}.example.net/en/{}?utm_source=feed")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): every name of the small table in each usual shape of a url. Bounded: some 900 rows."""
    names = spark.createDataFrame([(label, names) for label, names in LABELLED_NAMES], "label int, names string")
    shapes = F.array(*(F.lit(s) for s in _HOSTS))
    number = F.pmod(F.xxhash64("name", "shape"), F.lit(50_000)).cast("string")
    return (
        names.select("label", F.explode(F.split(F.regexp_replace("names", r"\s+", " "), " ")).alias("name"))
        .select("label", "name", F.explode(shapes).alias("shape"))
        .select(
            F.replace(
                F.replace("shape", F.lit("{}.example"), F.concat("name", F.lit(".example"))), F.lit("{}"), number
            ).alias("url"),
            "label",
        )
    )


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``. Null and no ``://``: both empty.

    The host runs from after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; the path from there to ``?``, ``#`` or the end.
    """
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return urls.withColumns(
        {
            "host": F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, lower),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def longest_rule(rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits host and path; null if none does.

    The rules become one conditional expression, longest first; meant for up to a few thousand.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    host, path = F.col("host"), F.col("path")
    for verdict, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        own = F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, own).otherwise(found)
    return found


def with_characters(parts: DataFrame) -> DataFrame:
    """Adds ``characters``: host and path, marked at both ends, as single characters.

    Digits all count as one, so that page numbers don't matter.
    """
    marked = F.concat(F.lit("^"), F.regexp_replace(F.concat("host", "path"), "[0-9]+", "0"), F.lit("$"))
    return parts.withColumn("characters", F.split(marked, ""))


def train(labelled: DataFrame) -> PipelineModel:
    """Logistic regression on hashed n-grams. ``labelled`` (url, label) must be small; it is gathered in one partition."""
    rows = with_characters(with_parts(labelled.where("url is not null and label is not null"))).coalesce(1).cache()
    stages = [
        NGram(n=GRAM, inputCol="characters", outputCol="grams"),
        HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features"),
        LogisticRegression(regParam=REGULARIZATION, maxIter=60, labelCol="label"),
    ]
    try:
        return Pipeline(stages=stages).fit(rows.withColumn("label", F.col("label").cast("double")))
    finally:
        rows.unpersist()


def judge(urls: DataFrame, labelled: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``urls`` (page_id, url, ...).

    The longest fitting rule's verdict, else the model's: block from ``BLOCK_AT`` on. ``score``
    is the model's estimate that the url is unwanted. An empty host and path are judged
    like any other text. Repeated rows are judged alike; extra columns are ignored.
    """
    model = train(labelled)
    parts = with_parts(urls.select("page_id", "url")).withColumn("fitting", longest_rule(rules))
    scored = model.transform(with_characters(parts))
    score = vector_to_array("probability").getItem(1)
    own = F.when(score >= BLOCK_AT, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        "page_id",
        "host",
        "path",
        F.col("fitting.rule").alias("rule"),
        F.coalesce(F.col("fitting.verdict"), own).alias("verdict"),
        score.alias("score"),
    )
