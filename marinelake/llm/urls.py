"""URL filter: host rules, and a logistic regression on hashed character n-grams.

Rules for hosts and path prefixes come first. Every other URL is judged by a logistic
regression on the n-grams of its host and its path, hashed into a fixed number of
buckets and trained on a small labelled table. Weights are rounded to whole numbers, so
that a score is an exact sum whatever the batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.llm.common import free_name, slices, spread, value_bytes
from marinelake.llm.registry import query, table
from marinelake.llm.words import mix

ALLOW, BLOCK = "allow", "block"
#: Lengths of the n-grams in bytes, and the buckets they are hashed into.
GRAMS = (2, 3, 4, 5)
BUCKETS = 1 << 16
#: Labelled URLs that the model may learn from, at most; a larger table is sampled evenly
#: by a hash of the URL.
MAX_LABELLED = 20_000
#: Strength of the penalty on weights, steps of the fit, and parts of a unit of weight.
PENALTY = 3e-4
STEPS = 400
UNIT = 1 << 24

#: Host and path of a rule and its verdict. The host itself and all its subdomains fit if
#: the path starts with that of the rule; of several rules the longest decides.
RULES = (
    ("net", "/", BLOCK),
    ("example.net", "/en/", ALLOW),
    ("example.com", "/de/", BLOCK),
    ("org", "/fr/", ALLOW),
)

# Names in the labelled URLs: words of unwanted hosts and of ordinary ones.
UNWANTED = (
    "adult adult-video ads adserver ad-tracker banner-ads bet bets betting big-win bonus-cash camgirls casino "
    "casino-bonus cheap-meds cheap-watches click-farm crack-keys diet-pills doubleads easy-cash escort-x fake-id "
    "fast-loans free-bets free-iphone free-spins gambling hot-singles instant-win jackpot link-farm loan-shark "
    "lottery-win malware meds-online mega-slots online-pharmacy payday-loan phishing pill-shop pills pixel-track "
    "poker porn porn-x prize-winner replica-shop sexcam slots spam spam-mail spyware tracker track-click "
    "viagra warez web-spam weight-loss-pills win-cash win-prizes x-rated xxx xxx-tube"
).split()
ORDINARY = (
    "academy airport archive arts bakery bank biology books bridge calendar chess choir city-hall climate clinic "
    "college community conference cooking council cycling data dental design dictionary docs earth editors energy "
    "engineering events farmers-market fashion films forest forum gallery garden gazette geology government hiking "
    "history hospital hotel institute journal kitchen law learning library literature magazine maps maths medicine "
    "museum music nation news observatory ocean opera orchard other parents philosophy photo physics poetry "
    "politics project radio railway recipes research review river school science society software sports station "
    "store students teachers theatre the-times thing tion tourism town travel university village weather wiki winery "
    "with-others women work world yoga"
).split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``url, blocked``: each name above four times in a host and twice in a path. Both
    kinds get the same prefixes, domains and other paths, so that only names tell them
    apart. A URL without host and path is allowed."""
    hosts = ("{}.example.com/en/1776", "www.{}.org", "m.{}.example.org/de/3315.html", "blog.{}.net/fr/42?page=2")
    paths = ("www.example.net/{}/", "m.example.com/es/{}.html")
    rows = [("about:blank", False)] + [(f"https://{shape.format(name)}", blocked) for names, blocked in ((UNWANTED, True), (ORDINARY, False)) for name in names for shape in hosts + paths]
    return spark.createDataFrame(rows, "url string, blocked boolean")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in small letters.
    Null or without ``://``: empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for name, prefix, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        text, verdict = F.when(fits, name + prefix).otherwise(text), F.when(fits, says).otherwise(verdict)
    return text, verdict


def gram_buckets(texts: pa.StringArray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of every text between two marks, and where each text's end."""
    data, offsets = value_bytes(texts)
    n = np.diff(offsets)
    # One mark before and one after every text; an n-gram never leaves its text.
    marked = np.zeros(int(n.sum()) + 2 * len(n), np.uint64)
    starts = np.cumsum(n + 2) - (n + 2)
    marked[spread(starts + 1, n)] = data[int(offsets[0]) : int(offsets[-1])].astype(np.uint64) + np.uint64(1)
    all_, owners = [], []
    for size in GRAMS:
        count = np.maximum(n + 3 - size, 0)
        at = spread(starts, count)
        code = np.full(len(at), salt * 64 + size, np.uint64)
        for i in range(size):
            code = mix(code + marked[at + i])
        all_.append((code & np.uint64(BUCKETS - 1)).astype(np.int64))
        owners.append(np.repeat(np.arange(len(n)), count))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(all_)[order], np.cumsum(np.bincount(owner, minlength=len(n)))


def field_buckets(hosts: pa.StringArray, paths: pa.StringArray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [gram_buckets(x, salt) for salt, x in enumerate((hosts, paths))]


@dataclass
class UrlModel:
    """Whole-number weights of the buckets and of the constant, in parts of ``UNIT``."""

    weights: np.ndarray
    constant: int

    def scores(self, hosts: pa.StringArray, paths: pa.StringArray) -> np.ndarray:
        """Log odds of being unwanted: the weights of the host's and of the path's n-grams,
        each divided by the root of their number, and the constant. Sums are of whole
        numbers and so exact."""
        score = np.full(len(hosts), self.constant / UNIT)
        for buckets, ends in field_buckets(hosts, paths):
            edges = np.concatenate([[0], ends])
            sums = np.concatenate([[0], np.cumsum(self.weights[buckets])])[edges]
            score += np.diff(sums) / np.sqrt(np.maximum(np.diff(edges), 1)) / UNIT
        return score


def learn_urls(labelled: DataFrame, url: str = "url", blocked: str = "blocked") -> UrlModel:
    """Fit on the labelled URLs; rows without a URL or a label teach nothing.

    At most ``MAX_LABELLED`` rows come to the driver: the model is a function of a
    bounded sample. Without both labels the model allows everything (or blocks it, where
    all rows are blocked)."""
    known = labelled.select(F.col(url).alias("u"), F.col(blocked).cast("boolean").alias("b")).where("u is not null and b is not null").distinct()
    total = known.count()
    if total > MAX_LABELLED:
        known = known.where(F.pmod(F.xxhash64("u"), F.lit(1 << 30)) < int(0.98 * MAX_LABELLED / total * (1 << 30)))
    rows = known.select(host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p"), "b").orderBy("h", "p", "b").limit(MAX_LABELLED).toArrow()
    y = rows.column("b").to_numpy().astype(float) if rows.num_rows else np.zeros(0)
    if not 0 < y.sum() < len(y):
        return UrlModel(np.zeros(BUCKETS, np.int64), UNIT if len(y) and y.all() else -UNIT)
    columns, places, values = [], [], []
    for buckets, ends in field_buckets(*(rows.column(c).combine_chunks().cast(pa.string()) for c in "hp")):
        n = np.diff(np.concatenate([[0], ends]))
        columns.append(buckets)
        places.append(np.repeat(np.arange(len(y)), n))
        values.append(np.repeat(1 / np.sqrt(np.maximum(n, 1)), n))
    used, column = np.unique(np.concatenate(columns), return_inverse=True)
    weights, constant = _fit(np.concatenate(places), column, np.concatenate(values), y, len(used))
    whole = np.zeros(BUCKETS, np.int64)
    whole[used] = np.rint(weights * UNIT).astype(np.int64)
    return UrlModel(whole, int(round(constant * UNIT)))


def _fit(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Penalised logistic regression by accelerated gradient steps of a safe length."""
    # The curvature is at most a quarter of the largest squared row, constant included;
    # n-grams that share a bucket or repeat in a text can at most double a row's length.
    step = 1 / (0.25 * (4 * np.bincount(row, value * value, len(y)).max() + 1) + PENALTY)
    w, b, ahead_w, ahead_b, t = np.zeros(width), 0.0, np.zeros(width), 0.0, 1.0
    for _ in range(STEPS):
        z = np.bincount(row, value * ahead_w[column], len(y)) + ahead_b
        error = (1 / (1 + np.exp(-z)) - y) / len(y)
        new_w = ahead_w - step * (np.bincount(column, value * error[row], width) + PENALTY * ahead_w)
        new_b = ahead_b - step * error.sum()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead_w, ahead_b = new_w + (before - 1) / t * (new_w - w), new_b + (before - 1) / t * (new_b - b)
        w, b = new_w, new_b
    return w, b


def filter_urls(pages: DataFrame, model: UrlModel, page_id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row, in one pass without a
    shuffle. ``score`` is the log odds of the model, above 0 ``block``; the verdict is the
    rule's where one fits. Null urls and those without ``://`` have an empty host and
    path, fit no rule and are judged by the model on nothing, its constant."""
    text, says = free_name(pages, "rule"), free_name(pages, "says")
    host, path = F.col("host"), F.col("path")
    parts = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias(text)).select(
        "page_id", host_of(F.col(text)).alias("host"), path_of(F.col(text)).alias("path")
    )
    rule, verdict = matching_rule(host, path, rules)
    shared = pages.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights
    schema = "page_id bigint, host string, path string, score double"

    def score(batches):
        model = shared.value
        for batch in slices(batches, "path"):
            for part in slices([batch], "host"):
                hosts, paths = (pa.concat_arrays([part.column(c), pa.array([], part.column(c).type)]).cast(pa.string()) for c in ("host", "path"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(hosts, paths))], ["page_id", "host", "path", "score"])

    judged = parts.mapInArrow(score, schema)
    return judged.withColumns({text: rule, says: verdict}).select(
        "page_id", "host", "path", F.col(text).alias("rule"),
        F.coalesce(F.col(says), F.when(F.col("score") > 0, BLOCK).otherwise(ALLOW)).alias("verdict"), "score",
    )


@query("op13_url_filter")
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), learn_urls(labelled_urls(spark)))
