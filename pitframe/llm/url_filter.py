"""URL filters: host and path rules first, a logistic regression on hashed character n-grams for the rest.

Everything is a Column: urls are cut by one pattern, the longest fitting rule is the largest of a short
array, n-grams are hashed slices of the characters of host and path, and a score is one fold over them.
Training is a fold as well. The labelled table is small, so it is held as two arrays, the buckets of
each example and the examples of each bucket; each step of gradient descent with momentum is a few
transforms over them. Only the weights come to the driver and go into the plan as one literal, so a url is judged where
it is read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# (action, host, path): a host stands for its subdomains, a path for all that begin with it
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
BUCKETS = 4096
HOST_SIZES = (3, 4, 5)
PATH_SIZES = (3, 4)
MOST = 2000  # labelled urls that are learnt from, drawn by hash
STEPS = 80
RATE = 1.0
MOMENTUM = 0.9
PENALTY = 2e-4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A small table of labelled hosts, made for this operator: what a crawl should leave out, and ordinary sites of
# many names and languages. Each host is met with forms of paths that say nothing, so that hosts decide; urls
# whose path tells come whole.
UNWANTED = """
casino-royal.example.org www.best-casino.example.net m.casino24.example.org online-casinos.example.info wincasino.example.org win-big.example.org jackpot-win.example.net
blog.winbig.example.biz poker-stars.example.org bet-now.example.net www.sportbets.example.org bets-online.example.org free-spins.example.net free-betting.example.org
freebets24.example.info m.free-money.example.org slots-free.example.net roulette.example.org lotto-winner.example.org cheap-viagra.example.org pills-shop.example.net
www.cheappills.example.info buy-pills.example.org cialis-cheap.example.net diet-pills.example.org m.cheap-meds.example.org cheap-watches.example.net cheapfollowers.example.org
pharmacy-online-cheap.example.net adult-cams.example.org www.adultvideo.example.net x-adult.example.org adult-dating.example.info xxx-movies.example.org porn-tube.example.net
sexcam.example.org hot-xxx.example.org m.adultx.example.org escort-xxx.example.net ads.example.org ads-server.example.net track-ads.example.org
adtrack.example.net www.ad-click.example.org tracker.example.org click-track.example.net m.popup-ads.example.org adserver.example.info banner-ads.example.net
spam-mail.example.org www.spamlinks.example.net link-farm.example.org linkfarm.example.info seo-spam.example.org farm-links.example.net buy-backlinks.example.org
spam-blog.example.org content-farm.example.net payday-loans.example.org quick-loans.example.net easy-cash.example.org get-rich.example.org crypto-giveaway.example.net
free-iphone.example.org
""".split()
ORDINARY = """
news.example.org www.library.example.org museum.example.net weather.example.org blog.gardening.example.net university.example.org www.recipes.example.net
m.cityhall.example.org science.example.org history.example.net docs.example.org wiki.example.org forum.example.net www.hospital.example.org
school.example.org council.example.net www.orchestra.example.org farmers.example.org winter-sports.example.org windows.example.net betterhomes.example.org
address.example.net adventure.example.org advice.example.org trackandfield.example.org cheapest-route.example.org freedom.example.net village-farm.example.org
educationx.example.org spamalot-theatre.example.org linguistics.example.org mathematics.example.net poetry.example.org chess.example.org railways.example.net
m.tionhe.example.org tionan.example.net thener.example.org www.thaner.example.net eranthe.example.org onthere.example.net blog.inghe.example.org
m.whathen.example.org ndand.example.net www.ouent.example.org stare.example.org reshe.example.net blyor.example.org m.oreth.example.net
haent.example.org www.edtion.example.org hanti.example.net theoua.example.org shand.example.org atiwh.example.net bücher.example.org
пример.example.net 例え.example.org
""".split()
PATHS = "/en/7817?utm_source=feed /de/66.html /fr/4163/ /es/8924#top /en/12 /de/203557?page=2&ref=x /fr/9.html /es/404/ /en/5?x=1 /en/88.html /de/1523 /en/31/ / /about".split()
UNWANTED_URLS = """
https://site.example.org/casino/bonus https://site.example.net/poker/slots.html http://site.example.org/buy/viagra https://site.example.org/cheap/pills.html http://site.example.net/xxx/video https://site.example.org/adult/cams
https://site.example.org/click?id=7 http://site.example.net/track/pixel.gif https://site.example.org/ads/banner.html https://site.example.net/free/spins http://site.example.org/win/jackpot https://site.example.org/bets/odds
""".split()
ORDINARY_URLS = """
https://site.example.org/news/today http://site.example.net/docs/install.html https://site.example.org/wiki/history https://site.example.org/recipes/bread.html http://site.example.net/lecture/physics https://site.example.org/contact
https://site.example.org/blog/garden http://site.example.net/catalogue/books https://site.example.org/sports/results https://site.example.net/health/advice http://site.example.org/weather/map https://site.example.org/library/hours
https://example.org/ http://example.net/about http://localhost/ https://192.0.2.7/status /about/team not-a-url mailto:team@example.org
""".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): the package's own small table, each host with two paths, an empty url among the ordinary ones."""
    rows = [(u, 1) for u in UNWANTED_URLS] + [(u, 0) for u in [*ORDINARY_URLS, ""]]
    for label, hosts in ((1, UNWANTED), (0, ORDINARY)):
        rows += [(f"https://{h}{PATHS[(2 * i + k) % len(PATHS)]}", label) for i, h in enumerate(hosts) for k in range(2)]
    return spark.createDataFrame(rows, "url string, label int")


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; without ``://``, or null: empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end, as it is."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(size, block, rule, verdict) of the longest rule that fits, or null; of equal lengths block wins, then the text."""
    fits = []
    for action, h, p in rules:
        here = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        fits.append(F.when(here, F.struct(F.lit(len(h + p)).alias("size"), F.lit(action == "block").alias("block"), F.lit(h + p).alias("rule"), F.lit(action).alias("verdict"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,block:boolean,rule:string,verdict:string>")


def gram_buckets(host: Column, path: Column, buckets: int = BUCKETS) -> Column:
    """Distinct buckets of the n-grams of the marked host and path; in a path every number is the same."""
    none = F.array().cast("array<int>")

    def grams(text: Column, field: int, sizes: Sequence[int]) -> Column:
        def cut(chars: Column) -> Column:
            hashed = lambda n: F.transform(F.sequence(F.lit(1), F.size(chars) - n + 1), lambda i: F.pmod(F.xxhash64(F.lit(field), F.slice(chars, i, n)), F.lit(buckets)).cast("int"))
            return F.concat(*[F.when(F.size(chars) >= n, hashed(n)).otherwise(none) for n in sizes])
        return F.get(F.transform(F.array(F.filter(F.split(text, ""), lambda c: c != "")), cut), 0)  # characters are cut once
    marked = lambda x: F.when(x == "", F.lit("")).otherwise(F.concat(F.lit("^"), x, F.lit("$")))
    return F.array_distinct(F.concat(grams(marked(host), 0, HOST_SIZES), grams(F.regexp_replace(marked(path), "[0-9]+", "0"), 1, PATH_SIZES)))


def trained(labelled: DataFrame, url_col: str = "url", label_col: str = "label", buckets: int = BUCKETS, most: int = MOST, steps: int = STEPS, rate: float = RATE, momentum: float = MOMENTUM, penalty: float = PENALTY) -> list[float]:
    """Weights by bucket, the offset last, of a ridge-penalised logistic regression with balanced classes.

    Features are 1/sqrt(number of distinct buckets) of an example. At most ``most`` labelled urls are
    learnt from, drawn by hash; null labels are left out, equal rows count each time. Without both
    classes all weights are 0 and the offset says the class that is there (none: not unwanted).
    """
    rows = labelled.select(F.coalesce(F.col(url_col), F.lit("")).alias("url"), (F.col(label_col).cast("int") > 0).cast("double").alias("y")).filter("y IS NOT NULL")
    rows = rows.orderBy(F.xxhash64("url"), "url", "y").limit(most)
    rows = rows.select("url", "y", gram_buckets(host_of("url"), path_of("url"), buckets).alias("b"))
    one = rows.agg(F.array_sort(F.collect_list(F.struct("url", "y", "b"))).alias("e"))  # at most ``most`` short rows
    one = one.select("e", F.aggregate("e", F.lit(0.0), lambda acc, x: acc + x["y"]).alias("ones"), F.size("e").cast("double").alias("n"))
    share = lambda x: F.when(x["y"] > 0, 0.5 / F.col("ones")).otherwise(0.5 / (F.col("n") - F.col("ones")))
    one = one.select("n", "ones", F.transform("e", lambda x: F.struct(x["b"].alias("b"), x["y"].alias("y"), share(x).alias("s"), (1 / F.sqrt(F.greatest(F.size(x["b"]), F.lit(1)))).alias("v"))).alias("e"))
    inverse = one.select(F.posexplode("e").alias("i", "x")).select("i", F.explode("x.b").alias("b"), "x.v")
    inverse = inverse.groupBy("b").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("x"))
    every = rows.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b")).join(inverse, "b", "left")
    lists = every.agg(F.array_sort(F.collect_list(F.struct("b", F.coalesce("x", F.array().cast("array<struct<i:int,v:double>>")).alias("x")))).alias("lists"))
    both = one.crossJoin(lists)  # one row each; below the join both are worked out once, not in every step

    def error(w: Column) -> Column:
        z = lambda x: w["o"] + x["v"] * F.aggregate(x["b"], F.lit(0.0), lambda acc, b: acc + F.get(w["w"], b))
        return F.transform("e", lambda x: x["s"] * (1 / (1 + F.exp(-z(x))) - x["y"]))

    def step(w: Column, _: Column) -> Column:
        def moved(err: Column) -> Column:
            slope = lambda at: F.aggregate(at, F.lit(0.0), lambda acc, x: acc + x["v"] * F.get(err, x["i"]))
            pull = F.zip_with(w["w"], F.col("lists"), lambda u, at: slope(at["x"]) + penalty * u)
            speed = F.zip_with(w["v"], pull, lambda v, g: momentum * v - rate * g)
            turn = momentum * w["t"] - rate * F.aggregate(err, F.lit(0.0), lambda acc, x: acc + x)
            return F.get(F.transform(F.array(F.struct(speed.alias("v"), turn.alias("t"))), lambda x: F.struct(
                F.zip_with(w["w"], x["v"], lambda u, v: u + v).alias("w"), x["v"].alias("v"), (w["o"] + x["t"]).alias("o"), x["t"].alias("t"))), 0)
        return F.get(F.transform(F.array(error(w)), moved), 0)  # the errors of a step are worked out once
    none = F.array_repeat(F.lit(0.0), buckets)
    start = F.struct(none.alias("w"), none.alias("v"), F.lit(0.0).alias("o"), F.lit(0.0).alias("t"))
    done = both.select("n", "ones", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step).alias("m")).first()
    if done is None or not 0 < done["ones"] < done["n"]:
        return [0.0] * buckets + [4.0 if done is not None and done["ones"] else -4.0]
    return [*done["m"]["w"], done["m"]["o"]]


def unwanted_score(host: Column, path: Column, weights: Sequence[float]) -> Column:
    """Probability that the url is unwanted."""
    table = F.split(F.lit(",".join(map(repr, weights[:-1]))), ",").cast("array<double>")  # folded to one literal
    start = F.struct(F.lit(0.0).alias("z"), F.lit(0).alias("n"))
    add = lambda acc, b: F.struct((acc["z"] + F.get(table, b)).alias("z"), (acc["n"] + 1).alias("n"))
    z = F.aggregate(gram_buckets(host, path, len(weights) - 1), start, add, lambda acc: acc["z"] / F.sqrt(F.greatest(acc["n"], F.lit(1))))
    return 1 / (1 + F.exp(-(F.lit(weights[-1]) + z)))


def judged(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", buckets: int = BUCKETS) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row; verdict is allow or block.

    The longest rule (host and path together) that fits decides; without one the url is blocked at a
    score of 0.5 or more. ``labelled`` has columns url and label. A null url, or one without ``://``, has
    an empty host and path and gets the model's verdict on no n-grams. Repeated rows, null ids and ties
    are rows like others; an empty table gives no rows; other columns are not read.
    """
    weights = trained(labelled, buckets=buckets)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("score", unwanted_score(F.col("host"), F.col("path"), weights))
    said = F.coalesce(F.col("fit.verdict"), F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return rows.select("id", "host", "path", F.col("fit.rule").alias("rule"), said.alias("verdict"), "score")
