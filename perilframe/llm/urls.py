"""URL filters: rules by host and path, and logistic regression on hashed character n-grams.

The model is trained from a small table of labelled URLs and judges what no rule decides.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules as (verdict, host, path). A rule fits its host and all subdomains, if the url's path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
FEATURES, SIZES = 1 << 14, (3, 4, 5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Labelled names of general knowledge. No word of a host of a given table is in them (a test says so), so hosts there are judged by names of their
# kind, not by their own. The labelled table pairs each name with the same hosts and paths, so that only the name tells the classes apart.
BAD = (
    "baccarat backlinks-shop beacon-pixel bingo binary-options blackjack bookmaker-odds botnet botox-deals bulk-mailer bulkmail camgirls cialis click-earn clickbait clickfraud cloaking-seo crack-serial cracked-apps "
    "crackz craps-table croupier crypto-double cryptojack dating-hot debt-relief dice-roll doorway-seo doubler-coin earn-fast erotica escorts fake-id fakebank-login fakereviews fetish forex-signals gambling "
    "generic-meds get-rich-quick getrich-online hacked-accounts hentai hgh-shop high-roller holdem-poker hookup hot-singles instant-loan jackpot jackpots-mega keno keygen keylogger link-exchange linkwheel "
    "lottery lotto-millions malware massmailer milfs mlm-income no-prescription nude-pics nudes-cam nulled-scripts oxycontin-buy parlay payday-loan pbn-links pharmacy-discount phish-kit phishing-login poker "
    "poker-chips ponzi popunder popups porn porn-tube pumpcoin punter-tips quick-cash quickloan ransomware replica-rolex retarget-clicks roulette scraper-site scratchcards seo-links serialz sexcam sexchat "
    "slimming-tea slot-machine slots-online sportsbook spyware steroids stream-warez stripclub survey-cash swingers telemetry-beacon texas-holdem torrent-warez torrents trojan typosquat viagra videopoker "
    "wager warez webcamgirls weightloss-now work-from-home xanax-shop"
)
GOOD = (
    "academy airport almanac anderson aquarium archive arthur athens atlas bakery bank barton basin beacon bedford berlin biology blogger books botany bridge bulletin cambridge canvas carpenter cathedral "
    "chapel chemistry childcare citizen clinic college community composer concert conference cooking council court culture daily-herald dentist design dictionary dover eastern ecology economics education "
    "electric elementary energy engineer england evening-post fairfield family ferry fishing florist forest forum foundation gallery garden gazette geography geology gordon grammar hamilton harbor "
    "harvest health heritage hiking historian history hospital hotel housing institute island journal kitchen knitting laboratory landmark lantern larson lawyer lecture library literature london magazine "
    "marathon mariner mathematics meadow medicine memorial meteor midland mountain museum nature nelson network-tools news northern nursery observatory ocean orchard orchestra oxford painting parish "
    "parliament pharmacology philosophy photography physics planning plumber poetry pottery public-radio quarterly railway reading recipes records research river saint school science seaside software "
    "southern stadium station statistics students sunday surgery teacher textile theatre tourism transit travel tribune university valley veterinary village vintage voyage walking water weather western "
    "wildlife winter woodland workshop writers yoga zoology action auction aviation caution celebration collection conservation convention cushion direction exhibition fashion fiction fraction function "
    "generation innovation invention junction lotion mansion mission mention nation nutrition option passion pension portion potion production question ration region relation session solution tradition "
    "transportation vacation vision vocation art-gallery book-club brass-band bus-times choir-practice church-hall city-council city-library coast-path country-fair county-court day-nursery film-festival "
    "fire-brigade flower-show folk-music football-club gas-supply green-energy high-school home-baking ice-hockey job-centre lake-district language-school life-science local-history music-school "
    "national-park night-sky north-shore old-town open-university parents-evening post-office primary-school rail-museum research-group river-trust sailing-club space-agency state-university "
    "swimming-pool tax-office tea-room tennis-club town-hall tree-nursery village-hall voluntary-service walking-tours war-memorial water-board weather-station wind-energy youth-hostel"
)


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and ``path`` (then up to ``?``,
    ``#`` or the end). A null url, or one without ``://``, has both empty."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.substring_index(F.substring_index(F.coalesce(rest, F.lit("")), "?", 1), "#", 1)
    host = F.substring_index(rest, "/", 1)
    return df.withColumn("host", F.translate(host, UPPER, LOWER)).withColumn("path", rest.substr(F.length(host) + 1, F.length(rest)))


def rule_of(rules=RULES, host="host", path="path"):
    """(rule, verdict) of the longest fitting rule as a struct, or null."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
        found = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out


def grams(column: str, mark: str):
    """Marked character n-grams of a column, with its edges; the array of characters is made once for a row, so the work is
    linear in the text's length."""
    text = F.split(F.concat(F.lit("^"), F.col(column), F.lit("$")), "")

    def of(chars, n):
        spots = F.slice(chars, 1, F.greatest(F.size(chars) - (n - 1), F.lit(0)))
        return F.transform(spots, lambda c, i: F.concat(F.lit(mark), *(F.get(chars, i + k) for k in range(n))))

    return F.flatten(F.transform(F.array(text), lambda chars: F.concat(*(of(chars, n) for n in SIZES))))


def with_features(df: DataFrame) -> DataFrame:
    """Adds ``grams``: those of the host without its last label, of the path with digits as one, and the host's shape: the number of its
    hyphens (2 for more) and whether it has digits."""
    df = df.withColumn("_name", F.regexp_replace("host", r"\.[^.]*$", "")).withColumn("_path", F.regexp_replace("path", "[0-9]+", "0"))
    hyphens = F.least(F.lit(2), F.length("_name") - F.length(F.replace(F.col("_name"), F.lit("-"))))
    shape = F.array(F.concat(F.lit("s-"), hyphens.cast("string")), F.concat(F.lit("s0"), F.col("_name").rlike("[0-9]").cast("string")))
    return df.withColumn("grams", F.array_distinct(F.concat(grams("_name", "h"), grams("_path", "p"), shape))).drop("_name", "_path")


def labelled(spark: SparkSession) -> DataFrame:
    """(url, label): the labelled table, label 1 for block. Each name stands under the same hosts and paths."""
    names = spark.sql(f"SELECT explode(split('{BAD}', ' ')) AS name, 1.0D AS label UNION ALL SELECT explode(split('{GOOD}', ' ')), 0.0D")
    hosts = F.explode(F.array(*(F.concat(F.lit(a), F.col("name"), F.lit(b)) for a in ("", "www.", "blog.", "m.") for b in (".example.com", ".example.org", ".com", ".net"))))
    urls = names.select("label", hosts.alias("host")).withColumn("k", F.pmod(F.xxhash64("host"), F.lit(5)))
    path = F.element_at(F.array(*map(F.lit, ("/", "/en/1", "/de/2.html", "/fr/3/", "/es/4?page=2"))), (F.col("k") + 1).cast("int"))
    return urls.select(F.concat(F.lit("https://"), F.col("host"), path).alias("url"), "label")


def fit(table: DataFrame):
    """A model from (url, label); the table is small, and the weights have a fixed number."""
    stages = [HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True), LogisticRegression(maxIter=40, regParam=0.003, threshold=0.5)]
    return Pipeline(stages=stages).fit(with_features(with_parts(table)).select("grams", "label"))


def judged(pages: DataFrame, model=None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score (the model's probability) of every row, rules first.

    Empty hosts and paths have no features but their edges. Repeated rows stay; other columns are not looked at.
    """
    model = model or fit(labelled(pages.sparkSession))
    rows = with_features(with_parts(pages.select("page_id", "url")))
    rows = model.transform(rows).withColumn("block_score", F.element_at(vector_to_array("probability"), 2)).withColumn("_r", rule_of(rules))
    verdict = F.coalesce(F.col("_r")["verdict"], F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return rows.select("page_id", "host", "path", F.col("_r")["rule"].alias("rule"), verdict.alias("verdict"), "block_score")
