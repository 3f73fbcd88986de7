"""URL filter: rules, else logistic regression on hashed character n-grams of
host and path, trained from a small labelled URL table.  DataFrame and SQL
operations only."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The labelled URL table, as host names by label and the paths and domains each is seen with.
BLOCKED_HOSTS = (
    "casino-win casino-royal online-casino best-casino lucky-slots slots-bonus poker-online poker-stars-win free-bets sure-bets sports-betting bet-now jackpot-city roulette-live win-money "
    "cheap-pills buy-pills pills-online viagra-shop cialis-store pharma-discount rx-cheap-meds diet-pills "
    "adult-x adult-video xxx-tube porn-hd sex-cams hot-girls nude-chat escort-city "
    "spam-farm spam-links link-farm seo-farm article-farm click-farm content-farm "
    "ads-track ad-tracker track-click adserver-net banner-ads popup-ads click-ads "
    "free-money quick-loans payday-loan get-rich crypto-profit fake-watches replica-bags warez-keys crack-download free-iphone"
).split()
ALLOWED_HOSTS = (
    "news library university museum journal weather city-hall school science history gardening cooking travel-notes kitchen recipes books reading letters archive atlas "
    "thing there other nation station mention section reason season ocean mountain river forest weekend morning evening hotel harbour theatre orchestra "
    "health hospital clinic research physics chemistry biology maths language grammar dictionary encyclopedia wiki forum answers tutorials python-docs java-docs "
    "the-herald the-tribune the-gazette daily-post evening-star local-times sports-club football chess-club trains airports maps parks concerts cinema painting"
).split()
_DOMAINS = ("example.com", "example.org", "example.net")
_PATHS = ("/en/{n}/", "/fr/{n}.html", "/de/{n}", "/es/{n}", "")
_PREFIXES = ("", "www.", "m.", "blog.")

#: Rule -> verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

FEATURES = 1 << 14


def labelled_urls() -> list[tuple[str, int]]:
    """The labelled table: each host with one prefix, domain and path, in turn."""
    rows = []
    for label, hosts in ((1, BLOCKED_HOSTS), (0, ALLOWED_HOSTS)):
        for k, host in enumerate(hosts):
            for j in range(2):
                n = k + 2 * j
                rows.append((f"https://{_PREFIXES[n % 4]}{host}.{_DOMAINS[n % 3]}{_PATHS[(k + j) % 5].format(n=37 * n + 5)}", label))
    return rows


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return host, path


def ngrams(host: str = "host", path: str = "path") -> Column:
    """Character 3- to 5-grams of host and path, which stay apart; digits count as one."""

    def of(text: Column, mark: str) -> Column:
        def size(n: int) -> Column:
            return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))

        return F.concat(*(size(n) for n in (3, 4, 5)))

    whole = F.concat(F.lit("^"), F.col(host), F.lit("$"))
    rest = F.regexp_replace(F.concat(F.col(path), F.lit("$")), "[0-9]+", "0")
    return F.concat(of(whole, "h"), of(rest, "p"))


def train(spark: SparkSession, rows: list[tuple[str, int]] | None = None) -> tuple[HashingTF, object]:
    rows = labelled_urls() if rows is None else rows
    values = ", ".join(f"('{u.replace(chr(39), chr(39) * 2)}', {y}D)" for u, y in rows)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t(url, label)").coalesce(1)
    host, path = split_url(F.col("url"))
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    data = hashed.transform(table.select(host.alias("host"), path.alias("path"), "label").select(ngrams().alias("grams"), "label"))
    return hashed, LogisticRegression(regParam=0.002, maxIter=60).fit(data)


def rule_of(host: str, path: str, rules: dict[str, str]) -> Column:
    """The longest rule that fits; null without one."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        cut = rule.index("/")
        name, start = rule[:cut], rule[cut:]
        ok = ((F.col(host) == name) | F.col(host).endswith(f".{name}")) & F.col(path).startswith(start)
        fits = F.when(ok, F.lit(rule)).otherwise(fits)
    return fits


def judge(spark: SparkSession, pages: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Per input row: page_id, url, host, path, rule, probability (of block, by the method), verdict.

    Null urls and urls without ``://`` have an empty host and path; no rule
    fits them and the method judges the empty strings.  Other columns are left
    out, whatever their names.  Repeated rows are judged one by one; an empty
    table gives an empty result.  Very long urls count whole.  Of rules that
    fit, the longest wins, and of equally long ones the last in order; a
    probability of 0.5 is allowed.
    """
    rules = RULES if rules is None else rules
    hashed, model = train(spark)
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    out = model.transform(hashed.transform(rows.withColumn("grams", ngrams())))
    out = out.withColumn("probability", vector_to_array("probability")[1]).withColumn("rule", rule_of("host", "path", rules))
    said = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    return out.select("page_id", "url", "host", "path", "rule", "probability", F.coalesce(said, F.when(F.col("probability") > 0.5, "block").otherwise("allow")).alias("verdict"))
