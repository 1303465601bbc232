"""URL filter: rules first, else logistic regression on hashed character n-grams.

Host and path are cut out by SQL functions. A rule names a host (its subdomains
included) and a path prefix; the longest that fits decides. Where none fits, a
logistic regression decides: character n-grams of host and path are hashed into a
fixed number of buckets; it is trained from a small labelled URL table. Everything
is DataFrame functions and Spark's own ML stages: no Python runs on executors.

Defined results: a null URL, or one without "://", has an empty host and path, fits
no rule and gets the model's verdict on no features but the markers; repeated rows are
judged again; an empty table stays empty; extra columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAMS = (3, 4)
BUCKETS = 1 << 15
THRESHOLD = 0.6  # what is blocked without a rule should be told apart clearly: a URL that says nothing stays below

# Words of URLs that a corpus keeps, and of those that it doesn't, by kind.
KEPT_WORDS = {
    "news": "news article story report world politics economy market weather sport election interview editorial press daily herald tribune gazette".split(),
    "science": "science research paper journal physics biology chemistry astronomy climate study university lecture theory algebra genome ocean".split(),
    "culture": "history museum library book poem novel music art theatre film review painting archive exhibit language dictionary".split(),
    "life": "recipe kitchen garden travel guide health family school teacher hiking bicycle house pet soup bread village city".split(),
    "work": "docs manual tutorial wiki help forum question answer blog notes project release changelog install reference topic".split(),
}
BLOCKED_WORDS = {
    "gambling": "casino poker slots jackpot roulette betting bookmaker odds wager blackjack lottery gamble bets sportsbook freespins".split(),
    "adult": "porn xxx sex nude adult cams escort milf erotic hookup dating singles webcam hentai fetish".split(),
    "pharmacy": "viagra cialis pills pharmacy tramadol xanax meds drugstore levitra steroids painkiller prescription rx".split(),
    "malware": "keygen crack warez torrent serial malware payload exploit hacktool ransom trojan botnet nulled cracked".split(),
    "tracking": "adserver banner tracker pixel beacon doubleclick adclick popunder affiliate impression adtrack clickid sponsor retarget".split(),
    "scam": "prize winner giveaway payday loans forex bitcoin doubler replica cheap claim bonus cashnow getrich miracle".split(),
    "account": "login signin signup checkout cart password logout register basket account".split(),
}
TABLE_URLS = 1_200  # labelled URLs of the default model


def labelled_urls(count: int = TABLE_URLS, seed: int = 3, share: tuple[float, float] = (0.0, 1.0)) -> list[tuple[str, int]]:
    """A labelled URL table (url, 1 = block), laid out from the words: half of each label.

    Schemes, top-level domains, host names, language folders, numbers, endings and queries are drawn alike for both labels, so that only words
    tell them apart. A fifth of the kept URLs have no telling word at all. ``share`` takes a part of each word list, for
    held-out words."""
    rng = random.Random(seed)
    pick = rng.choice
    some = lambda words: words[int(share[0] * len(words)):max(int(share[1] * len(words)), int(share[0] * len(words)) + 1)]
    syllables = "ba den lo mir ka ven tos ru hal ni per sol gan dor el tu mas ber qui fen".split()
    brand = lambda: "".join(pick(syllables) for _ in range(rng.randrange(2, 4)))

    def url(word, blocked: bool) -> str:
        telling = [] if word is None else word
        say = lambda: pick(telling) if telling else brand()
        host = brand()
        spot = rng.randrange(3)  # where the words stand: in the host, in the path, in both
        if telling and spot != 1:
            host = pick([f"{say()}-{brand()}", f"{brand()}-{say()}", f"{say()}{rng.randrange(100)}", f"{brand()}{say()}", f"{say()}-{say()}", f"best{say()}"])
        if rng.random() < 0.25:
            host = "example"
        sub = pick(["", "", "www.", "m.", "en.", "blog.", "shop.", "go.", f"{say()}." if telling and spot != 1 else "my."])
        parts = [pick(["en", "de", "fr", "es", "it"])] if rng.random() < 0.5 else []
        if telling and (spot != 0 or host == "example"):
            parts += [pick([say(), f"{say()}-{say()}", f"{say()}-{brand()}", f"{brand()}-{say()}", f"{say()}_{rng.randrange(50)}"]) for _ in range(rng.randrange(1, 3))]
        if rng.random() < 0.6:
            parts.append(pick([str(rng.randrange(10_000)), f"{brand()}-{brand()}", brand(), f"{rng.randrange(1990, 2026)}/{rng.randrange(1, 13):02d}"]))
        tail = pick(["", "", "/", ".html", ".php", "?id=%d" % rng.randrange(999), "?utm_source=feed", "#top", "?page=2&ref=%s" % brand()])
        return f"{pick(['http', 'https'])}://{sub}{host}.{pick(['com', 'net', 'org', 'info', 'io', 'co.uk', 'de', 'xyz'])}/" + "/".join(parts) + tail

    kept, blocked = [some(w) for w in KEPT_WORDS.values()], [some(w) for w in BLOCKED_WORDS.values()]
    out = []
    for i in range(count):
        if i % 2:
            out.append((url(pick(blocked), True), 1))
        else:
            out.append((url(None if rng.random() < 0.2 else pick(kept), False), 0))
    return out


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; else empty."""
    rest = F.when(F.locate("://", url) > 0, F.substring_index(_after(url), "/", 1)).otherwise("")
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after(url: Column) -> Column:
    return url.substr(F.locate("://", url) + 3, F.length(url))


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end; empty without "://"."""
    whole = F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)
    slash = F.locate("/", whole)
    return F.when((F.locate("://", url) > 0) & (slash > 0), whole.substr(slash, F.length(whole))).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of the rules (host/path-prefix, verdict) that fit, or null."""
    fits = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # a longer rule overrides
        at, _, rest = rule.partition("/")
        ok = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        fits = F.when(ok, F.lit(rule)).otherwise(fits)
    return fits


def gram_column(host: Column, path: Column) -> Column:
    """Character n-grams of "^host$" and "/path$", marked by where they stand."""

    def of_size(s: Column, mark: str, n: int) -> Column:
        last = F.length(s) - (n - 1)
        at = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.concat(F.lit(mark), s.substr(i, F.lit(n))))

    def grams(s: Column, mark: str) -> list[Column]:
        return [of_size(s, mark, n) for n in GRAMS]

    return F.concat(*grams(F.concat(F.lit("^"), host, F.lit("$")), "h:"), *grams(F.concat(path, F.lit("$")), "p:"))


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    return df.withColumn("host", F.coalesce(host_of(F.col(url)), F.lit(""))).withColumn(
        "path", F.coalesce(path_of(F.col(url)), F.lit("")))


def train(spark: SparkSession, labelled: Sequence[tuple[str, int]] | None = None) -> PipelineModel:
    """Hashed n-grams and logistic regression from a small (url, 0/1) table, by default ``labelled_urls()``; a fixed number of
    coefficients, whatever the table."""
    table = with_parts(spark.createDataFrame([(u, int(y)) for u, y in labelled or labelled_urls()], "url string, label int"))
    table = table.select(F.col("label").cast("double").alias("label"), gram_column(F.col("host"), F.col("path")).alias("grams"))
    tf = HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True)
    lr = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.001, standardization=False, maxIter=60)
    return Pipeline(stages=[tf, lr]).fit(table.coalesce(1))


def filter_urls(df: DataFrame, rules: Sequence[tuple[str, str]], model: PipelineModel, key: str = "page_id",
                url: str = "url", threshold: float = THRESHOLD) -> DataFrame:
    """(key, host, path, rule, verdict, p_block) of every row. A map over rows: no shuffle."""
    base = with_parts(df.select(F.col(key), F.col(url)), url)
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "grams", gram_column(F.col("host"), F.col("path")))
    scored = model.transform(base).withColumn("p_block", vector_to_array("probability")[1])
    said = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    for rule, verdict in rules:
        said = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(said)
    return scored.select(key, "host", "path", "rule", said.alias("verdict"), "p_block")
