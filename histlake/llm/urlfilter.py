"""URL filters: rules, and logistic regression on character n-grams (operator 7).

Everything is DataFrame and SQL functions.  A rule is a host, a slash and a
path prefix; it fits its host and all subdomains, the longest that fits
decides, and the model judges the other addresses.

Model.  The 3- to 5-grams of the characters of host and path are hashed into
``DIM`` features.  The labelled table is small (``MAX_LABELS`` rows at most,
more are refused), so gradient descent runs on the dual coefficients: one row
holds the labelled addresses' inner products, each step is a function of that
row, and the weights are the coefficients' sums per feature.  The weights
(``DIM`` numbers, whatever the input) reach the scan as a scalar subquery;
judging an address needs no shuffle and no join.

Edge cases: a null address, or one without ``://``, has an empty host and
path, fits no rule and gets the verdict the model gives the empty address;
repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.llm.common import lower_ascii

DIM = 1 << 15
GRAMS = (3, 4, 5)
MAX_LABELS = 1000
STEPS = 300
RATE = 1.0
DECAY = 1e-4

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))

# The labelled table: names of sites of either kind, put into addresses of the
# same shapes so that only the names tell them apart.
BLOCKED_NAMES = (
    "cheap-pills", "casino-win", "spam-farm", "online-casino", "buy-viagra", "free-money", "hot-singles", "xxx-videos",
    "payday-loans", "win-lottery", "crypto-giveaway", "adult-xxx", "adult-cams", "poker-bonus", "slots-jackpot",
    "discount-pharmacy", "pills-online", "warez-crack", "keygen-download", "link-farm", "seo-spam", "free-bets",
    "ads-tracker", "track-clicks", "fast-cash")
ALLOWED_NAMES = (
    "daily-news", "city-library", "open-science", "history-notes", "garden-club", "python-docs", "river-county",
    "music-school", "travel-journal", "food-recipes", "physics-lab", "local-sports", "art-museum", "book-reviews",
    "weather-service", "northern-herald", "southern-times", "earth-monitor", "lighthouse", "motherland-stories",
    "another-reader", "rotterdam", "heather-smith", "museum", "university", "journal", "forum", "wiki", "archive",
    "encyclopedia", "parish-records", "school-board", "weathering", "theatre", "orthodontist", "parenthood",
    "station", "nation-building", "education", "translation")
_SHAPES = ("https://www.{}.example.com/en/{}", "http://{}.example.net/de/{}.html", "https://blog.{}.example.org/fr/{}/",
           "http://m.{}.example.net/es/{}?page=2", "https://{}.example.com/{}")


def labelled_urls() -> list[tuple[str, int]]:
    """(address, 1 if it is to be blocked): each name in two shapes."""
    out = []
    for label, names in ((1, BLOCKED_NAMES), (0, ALLOWED_NAMES)):
        for i, name in enumerate(names):
            for k in (0, 2):
                out.append((_SHAPES[(i + k) % len(_SHAPES)].format(name, 7 * i + k + 3), label))
    return out


def host_of(url: Column) -> Column:
    rest = _rest(url)
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _rule(host: Column, path: Column, rules: Sequence[tuple[str, str]], pick: int) -> Column:
    out = None
    for rule in sorted(rules, key=lambda r: -len(r[0])):
        name, _, prefix = rule[0].partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        out = F.when(fits, F.lit(rule[pick])) if out is None else out.when(fits, F.lit(rule[pick]))
    return out if out is not None else F.lit(None).cast("string")


def features(host: Column, path: Column, dim: int = DIM) -> Column:
    """Feature numbers of all n-grams, repeats included."""
    chars = F.split(F.concat(F.lit("^"), host, path, F.lit("$")), "")

    def of_length(c: Column, n: int) -> Column:
        at = F.when(F.size(c) >= n, F.sequence(F.lit(0), F.size(c) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.pmod(
            F.xxhash64(F.concat(*[F.get(c, i + k) for k in range(n)])), F.lit(dim)).cast("int"))

    def grams(c: Column) -> Column:
        return F.concat(*[of_length(c, n) for n in GRAMS])

    # bound once as a lambda's variable, so the characters are split once
    return F.transform(F.array(chars), grams)[0]


def train(labels: DataFrame, dim: int = DIM, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> DataFrame:
    """One row, one column ``w``: the bias and the ``dim`` weights, learned
    from ``labels(url, label)``."""
    rows = labels.where("url is not null and label is not null").groupBy("url").agg(
        F.max(F.col("label").cast("double")).alias("y"))
    count = rows.count()
    if count > MAX_LABELS:
        raise ValueError(f"{count} labelled addresses; the labelled table may hold {MAX_LABELS} at most")
    grams = rows.select("url", "y", features(host_of(F.col("url")), path_of(F.col("url")), dim).alias("f"))
    cells = (grams.select("url", "y", F.size("f").alias("n"), F.explode("f").alias("j"))
             .groupBy("url", "y", "n", "j").agg((F.count("*") / F.sqrt("n")).alias("v")))
    # a constant feature of one is the bias
    cells = cells.select("url", "y", "j", "v").union(rows.select("url", "y", F.lit(-1), F.lit(1.0)))
    a, b = cells.alias("a"), cells.alias("b")
    inner = (a.join(b, F.col("a.j") == F.col("b.j")).groupBy(F.col("a.url").alias("url"), F.col("a.y").alias("y"),
                                                             F.col("b.url").alias("other"))
             .agg(F.sum(F.col("a.v") * F.col("b.v")).alias("k")))
    line = inner.groupBy("url", "y").agg(
        F.array_sort(F.collect_list(F.struct("other", "k"))).alias("k"))
    table = line.agg(F.array_sort(F.collect_list(F.struct("url", "y", F.col("k.k").alias("k")))).alias("t"))
    zero = F.transform("t", lambda r: F.lit(0.0))

    def step(alpha: Column, _: Column) -> Column:
        def one(r: Column, i: Column) -> Column:
            dot = F.aggregate(F.zip_with(r["k"], alpha, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
            wrong = r["y"] - 1 / (1 + F.exp(-dot))
            return F.get(alpha, i) * (1 - rate * decay) + rate * wrong / F.size("t") * 10
        return F.transform(F.col("t"), one)

    alpha = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), zero, step)
    pairs = F.zip_with(F.col("t"), alpha, lambda r, x: F.struct(r["url"].alias("url"), x.alias("alpha")))
    solved = table.select(F.explode(pairs).alias("s")).select("s.url", "s.alpha")
    per = cells.join(solved, "url").groupBy("j").agg(F.sum(F.col("alpha") * F.col("v")).alias("w"))
    every = labels.sparkSession.range(-1, dim).select(F.col("id").cast("int").alias("j"))
    full = every.join(per, "j", "left").select("j", F.coalesce("w", F.lit(0.0)).alias("w"))
    return full.agg(F.array_sort(F.collect_list(F.struct("j", "w")))["w"].alias("w"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
          dim: int = DIM) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's probability that the
    address is to be blocked."""
    model = train(labels, dim)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("w", model.scalar())
    grams = features(F.col("host"), F.col("path"), dim)
    # get() counts from 0 and the bias comes first
    total = F.transform(F.array(grams), lambda g: F.aggregate(
        g, F.lit(0.0), lambda s, j: s + F.get(F.col("w"), j + 1)) / F.sqrt(F.greatest(F.size(g), F.lit(1))))[0]
    rows = rows.withColumn("p_block", 1 / (1 + F.exp(-(total + F.get(F.col("w"), F.lit(0))))))
    own = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", _rule(F.col("host"), F.col("path"), rules, 0).alias("rule"),
        F.coalesce(_rule(F.col("host"), F.col("path"), rules, 1), own).alias("verdict"), "p_block")


def label_table(spark: SparkSession, rows: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """The labelled addresses as an inline table."""
    rows = labelled_urls() if rows is None else rows
    values = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("label")) for u, y in rows])
    return spark.range(1).select(F.explode(values).alias("r")).select("r.url", "r.label")
