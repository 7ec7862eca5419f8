"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the rest.

Built-in functions and Spark's own trees only. The longest rule that fits decides;
urls without one are judged by trees trained on urls that have a label (in the
registered query: those a rule decides). The statistics of the hosts' last labels (suffixes)
are counted over all labelled urls, each suffix by itself, and joined on. In the fit a url's
suffix is judged by the urls of the other folds only, so that its own label is no input. Only the fit reads
a sample, of about ``TRAIN_ROWS`` labelled urls: half of it of each kind, or all of a kind
that has fewer, weighted by how many urls each stands for. Copies are drawn by their number.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule
of a host; of equally long rules that fit, the first in the given list decides. With labels of
one kind only, that kind is every other url's verdict; without labels it is allow.
Repeated rows each get a row; columns other than id and url are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

TRAIN_ROWS = 20_000
TREES = 10
DEPTH = 4
PRIOR_ROWS = 20
FOLDS = 5
# Suffix statistics up to this size are broadcast; larger ones meet the urls in a shuffle.
BROADCAST_BYTES = 8 << 20

# Fixed values of the host rule: A-Z are lower-cased.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # allow or block, host, path


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def judged(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, url, host, path, rule, decided): the longest rule that fits, and what it says."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    found = F.lit(None).cast("struct<rule:string,decided:string>")
    for verdict, host, path in reversed(longest):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        found = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("decided"))).otherwise(found)
    return rows.withColumn("found", found).select("id", "url", "host", "path", "found.rule", "found.decided")


def entropy(text: Column) -> Column:
    """Bits per character; the characters are sorted, so that one pass counts runs."""
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    closed = lambda a: a["sum"] + F.when(a["run"] > 1, a["run"] * F.log2(a["run"])).otherwise(0.0)
    step = lambda a, c: F.when(a["last"] == c, F.struct(c.alias("last"), (a["run"] + 1.0).alias("run"), a["sum"].alias("sum"))).otherwise(
        F.struct(c.alias("last"), F.lit(1.0).alias("run"), closed(a).alias("sum")))
    size = F.length(text)
    runs = F.aggregate(F.sort_array(F.split(text, "")), start, step, closed)
    return F.when(size > 0, F.log2(size.cast("double")) - runs / size).otherwise(0.0)


def _count(text: Column, marks: str) -> Column:
    """How many characters of ``text`` are among ``marks``."""
    return (F.length(text) - F.length(F.translate(text, marks, ""))).cast("double")


def lexical(rows: DataFrame) -> DataFrame:
    """``rows`` with the features of url, host and path."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    asked = F.regexp_extract(url, r"\?([^#]*)", 1)
    features = {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": _count(path, "/"),
        "labels": _count(host, "."),
        "digit_ratio": _count(url, "0123456789") / F.greatest(F.length(url), F.lit(1)),
        "host_digits": _count(host, "0123456789"),
        "hyphens": _count(host, "-"),
        "other_marks": _count(url, "-_.~!*'();:@&=+$,%"),
        "entropy": entropy(url),
        "host_entropy": entropy(host),
        "parameters": F.when(asked != "", _count(asked, "&") + 1.0).otherwise(0.0),
        "secure": url.startswith("https:").cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
    }
    return rows.select("*", *[c.alias(name) for name, c in features.items()])


_PLAIN = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digits", "hyphens", "other_marks",
          "entropy", "host_entropy", "parameters", "secure", "fragment")
_SUFFIX = ("suffix_rate", "suffix_weight")


@dataclass(frozen=True)
class Model:
    """Trees, or a verdict where the labels were of one kind; and the suffix statistics.

    ``suffixes`` has a row (suffix, suffix_rate, suffix_weight) for every suffix of a labelled url;
    ``overall`` is the rate of the others.
    """

    trees: GBTClassificationModel | None
    default: str
    suffixes: DataFrame | None = None
    overall: float = 0.0


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def fold_of(url: Column) -> Column:
    """The fold of a url: that of its copies too."""
    return F.pmod(F.xxhash64(url), F.lit(FOLDS)).cast("int")


def _vectors(rows: DataFrame, suffixes: DataFrame, overall: float) -> DataFrame:
    known = lexical(rows).withColumns({"suffix": suffix_of(F.col("host")), "fold": fold_of(F.col("url"))}).join(
        suffixes, [c for c in ("suffix", "fold") if c in suffixes.columns], "left")
    known = known.fillna({"suffix_rate": overall, "suffix_weight": 0.0})
    return VectorAssembler(inputCols=[*_PLAIN, *_SUFFIX], outputCol="features").transform(known)


def drawn(rows: DataFrame, count: dict[float, int]) -> DataFrame:
    """(id, url, host, path, label, weight): about ``TRAIN_ROWS`` of the labelled rows, of which ``count`` has each label's number.

    Of n equal rows (id, url, label) a class's share of n is drawn, rounded up or down by hash. A row's
    weight is the number of rows that it stands for.
    """
    fewer = min(count, key=count.get)
    quota = {fewer: min(count[fewer], TRAIN_ROWS // 2)}
    quota |= {c: min(count[c], TRAIN_ROWS - quota[fewer]) for c in count if c != fewer}
    share = F.lit(0.0)
    for c in count:
        share = F.when(F.col("label") == c, quota[c] / count[c]).otherwise(share)
    place = F.xxhash64("label", "id", "url", F.lit("train")) / 2.0 ** 64 + 0.5
    copies = rows.groupBy("id", "url", "host", "path", "label").count()
    taken = copies.withColumn("share", share).withColumn(
        "taken", F.least("count", F.floor(F.col("count") * F.col("share") + place)).cast("int"))
    return taken.filter("taken > 0").select("id", "url", "host", "path", "label", (1 / F.col("share")).alias("weight"),
                                            F.explode(F.sequence(F.lit(1), "taken")).alias("copy")).drop("copy")


def _rates(counts: DataFrame, overall: float, total: int) -> DataFrame:
    """Suffix statistics from numbers of labelled urls and blocked ones among them."""
    return counts.select(*[c for c in ("suffix", "fold") if c in counts.columns],
                         ((F.col("blocked") + PRIOR_ROWS * overall) / (F.col("n") + PRIOR_ROWS)).alias("suffix_rate"),
                         (F.col("n") / total).alias("suffix_weight"))


def train(labelled: DataFrame) -> Model:
    """Fit on (id, url, host, path, decided) rows; ``decided`` is allow or block."""
    rows = labelled.select("id", "url", "host", "path", (F.col("decided") == "block").cast("double").alias("label"))
    by_fold = pin(rows.groupBy(suffix_of(F.col("host")).alias("suffix"), fold_of(F.col("url")).alias("fold"))
                  .agg(F.sum("label").alias("blocked"), F.count("*").alias("n")))
    counts = by_fold.groupBy("suffix").agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n"))
    all_rows = counts.agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"),
                          F.sum(F.octet_length("suffix") + 32).alias("bytes")).first()
    total, blocked = all_rows.n or 0, int(all_rows.blocked or 0)
    if blocked in (0, total):
        return Model(None, "block" if blocked else "allow")
    overall = blocked / total
    # Of each suffix and fold, the urls of the other folds.
    others = (counts.withColumnsRenamed({"blocked": "all_blocked", "n": "all_n"}).join(by_fold, "suffix")
              .select("suffix", "fold", (F.col("all_blocked") - F.col("blocked")).alias("blocked"), (F.col("all_n") - F.col("n")).alias("n")))
    suffixes, unseen = _rates(counts, overall, total), _rates(others, overall, total)
    if all_rows.bytes <= BROADCAST_BYTES:
        suffixes, unseen = F.broadcast(suffixes), F.broadcast(unseen)  # the second has at most a row for each fold
    # Sorted, so that the trees do not depend on the order in which the shuffle came in.
    sample = pin(_vectors(drawn(rows, {0.0: total - blocked, 1.0: blocked}), unseen, overall)
                 .sortWithinPartitions("label", "id", "url").select("features", "label", "weight"))
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False, weightCol="weight")
    return Model(learner.fit(sample), "allow", suffixes, overall)


def verdicts(rows: DataFrame, model: Model) -> DataFrame:
    """(id, host, path, rule, verdict, probability): the rule's verdict, else the trees' and their probability of block."""
    if model.trees is None:
        guessed = rows.withColumns({"guess": F.lit(model.default), "chance": F.lit(float(model.default == "block"))})
    else:
        scored = model.trees.transform(_vectors(rows, model.suffixes, model.overall))
        guessed = scored.withColumns({"guess": F.when(F.col("prediction") == 1, "block").otherwise("allow"),
                                      "chance": vector_to_array("probability")[1]})
    return guessed.select("id", "host", "path", "rule", F.coalesce("decided", "guess").alias("verdict"),
                          F.when(F.col("decided").isNull(), F.col("chance")).alias("probability"))


def accuracy(labelled: DataFrame, held_out: int = 0) -> DataFrame:
    """(suffix, decided, n, right) of the labelled urls whose hosts are in one fold, judged by a model of the other hosts."""
    fold = F.pmod(F.xxhash64("host"), F.lit(FOLDS))
    model = train(labelled.filter(fold != held_out))
    own = labelled.filter(fold == held_out)
    judged_blind = verdicts(own.withColumn("said", F.col("decided")).withColumn("decided", F.lit(None).cast("string"))
                            .select("id", "url", "host", "path", F.col("said").alias("rule"), "decided"), model)
    return (judged_blind.groupBy(suffix_of(F.col("host")).alias("suffix"), F.col("rule").alias("decided"))
            .agg(F.count("*").alias("n"), F.sum((F.col("verdict") == F.col("rule")).cast("long")).alias("right")))
