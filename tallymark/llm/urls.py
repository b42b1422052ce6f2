"""URL filter: explicit rules first, gradient-boosted trees on lexical features for the rest.

The labelled URLs are those that a rule decides: the trees learn from them what blocked and
allowed addresses look like and judge the addresses no rule knows. Beside lengths, ratios and the
statistics of the suffix the features say which words host and path hold, hashed into a few
buckets: that is what a rule goes by. The rate of a suffix is taken from the other half of the labels,
so a label never tells of itself. Features are Spark expressions, the trees are Spark's own, so no
row leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.sources.tables import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith(F.col("host"), F.lit("." + self.host))
        return host & F.startswith(F.col("path"), F.lit(self.path))


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)

#: Labelled URLs the trees are fitted on at most: those with the least hashes.
TRAIN_ROWS = 20_000

#: Buckets that the words of an address are hashed into.
WORD_BUCKETS = 48

#: A suffix with few labels is pulled to the mean of all by so many imaginary ones.
PRIOR_ROWS = 20.0


def split_url(pages: DataFrame) -> DataFrame:
    """Adds host and path. Null, or without `://`: both empty."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    named = pages.withColumn("rest", F.coalesce(rest, F.lit("")))
    named = named.withColumn("host", F.regexp_extract("rest", r"\A[^/?#]*", 0))
    behind = F.expr("substring(rest, length(host) + 1)")
    named = named.withColumn("path", F.regexp_extract(behind, r"\A[^?#]*", 0))
    return named.withColumn("host", F.translate("host", UPPER, LOWER)).drop("rest")


def apply_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Adds rule and rule_verdict of the longest rule that fits, else null. Two rules of one
    length that fit one URL are the same rule, or stand in the order given."""
    ordered = sorted(rules, key=lambda r: -len(r.name))

    def chain(value) -> Column:
        none = F.lit(None).cast("string")
        return reduce(lambda rest, r: F.when(r.fits(), F.lit(value(r))).otherwise(rest), ordered[::-1], none)

    return pages.withColumn("rule", chain(lambda r: r.name)).withColumn(
        "rule_verdict", chain(lambda r: r.verdict)
    )


FEATURES = [
    "url_length",
    "host_length",
    "path_length",
    "depth",
    "labels",
    "digit_ratio",
    "hyphens",
    "upper_ratio",
    "escapes",
    "parameters",
    "entropy",
    "suffix_log_count",
    "suffix_blocked",
    *[f"word_{bucket}" for bucket in range(WORD_BUCKETS)],
]


def _count_of(text: str, pattern: str) -> Column:
    return F.regexp_count(F.col(text), F.lit(pattern)).cast("double")


def lexical(pages: DataFrame) -> DataFrame:
    """Adds the features of the address itself, and its suffix (the host's last label)."""
    full = pages.withColumn("full", F.coalesce("url", F.lit("")))
    length = F.greatest(F.length("full"), F.lit(1)).cast("double")
    letters = F.array_distinct(F.split("full", ""))
    share = lambda c: (F.length("full") - F.length(F.replace(F.col("full"), c, F.lit("")))) / length
    parts = F.transform(F.filter(letters, lambda c: c != ""), lambda c: -share(c) * F.log2(share(c)))
    full = full.withColumns(
        {
            "url_length": F.length("full").cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": _count_of("path", "/[^/]"),
            "labels": _count_of("host", "[^.]+"),
            "digit_ratio": _count_of("full", "[0-9]") / length,
            "hyphens": _count_of("host", "-"),
            "upper_ratio": _count_of("full", "[A-Z]") / length,
            "escapes": _count_of("full", "%[0-9A-Fa-f]{2}"),
            "parameters": _count_of("full", "[?&][^=&#]*="),
            "entropy": F.aggregate(parts, F.lit(0.0), lambda a, b: a + b),
            "suffix": F.regexp_extract("host", r"[^.]*\z", 0),
        }
    )
    words = F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit("[a-z]+"), F.lit(0))
    full = full.withColumn("words", F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(WORD_BUCKETS))))
    held = {f"word_{b}": F.array_contains("words", F.lit(b).cast("long")).cast("double") for b in range(WORD_BUCKETS)}
    return full.withColumns(held).drop("full", "words")


def suffix_rates(known: DataFrame, mean: float) -> DataFrame:
    """suffix, rate, rate_0, rate_1: the share of blocked labels of a suffix, of all of them and
    without those of each half (`half`), pulled to the mean where there are few."""

    def rate(label: Column, count: Column) -> Column:
        return (F.coalesce(label, F.lit(0.0)) + PRIOR_ROWS * mean) / (count + PRIOR_ROWS)

    other = [rate(F.sum(F.when(F.col("half") != h, F.col("label"))), F.count_if(F.col("half") != h)) for h in (0, 1)]
    return known.groupBy("suffix").agg(
        rate(F.sum("label"), F.count("*")).alias("rate"), *[r.alias(f"rate_{h}") for h, r in enumerate(other)]
    )


@dataclass(frozen=True)
class Trees:
    """Fitted trees with the suffix statistics they go by."""

    model: GBTClassificationModel
    suffixes: DataFrame
    mean: float

    def chances(self, rows: DataFrame) -> DataFrame:
        """rows of `lexical` with `blocked`, the probability of the verdict block."""
        rest = rows.join(self.suffixes, "suffix", "left")
        rest = rest.withColumn("suffix_blocked", F.coalesce("rate", F.lit(self.mean)))
        rest = rest.withColumn("suffix_log_count", F.coalesce("suffix_log_count", F.lit(0.0)))
        scored = self.model.transform(_vectors().transform(rest))
        return scored.withColumn("blocked", vector_to_array("probability")[1])


def _vectors() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURES, outputCol="features")


def fit(known: DataFrame, rows: DataFrame, trees: int = 15, depth: int = 4) -> Trees:
    """known: rows of `lexical` with a label, 1 for block, of both kinds. rows: those that suffixes
    are counted over."""
    mean = known.agg(F.avg("label")).first()[0]
    counts = rows.groupBy("suffix").agg(F.log1p(F.count("*").cast("double")).alias("suffix_log_count"))
    known = known.withColumn("half", F.pmod(F.xxhash64("url"), F.lit(2)))
    suffixes = materialize(counts.join(suffix_rates(known, mean), "suffix", "left"), "suffixes")
    of_others = F.when(F.col("half") == 0, F.col("rate_0")).otherwise(F.col("rate_1"))
    learn = known.join(suffixes, "suffix").withColumn("suffix_blocked", of_others)
    learn = _vectors().transform(learn).select("features", "label")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7).fit(learn)
    return Trees(model, suffixes, mean)


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    train_rows: int = TRAIN_ROWS,
    trees: int = 15,
    depth: int = 4,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, blocked (the trees' probability).

    The verdict is the rule's, else block where the trees say 0.5 or more. blocked is null
    for rows of a rule and where no trees were fitted, because the rules' rows are all of one
    verdict or none; such rows get that verdict, without any `allow`. A null url has an empty
    host and path and is judged by its features, all zero. A suffix without a label has the mean
    rate. Repeated rows are judged alike; an
    empty table gives no rows.
    """
    judged = apply_rules(split_url(pages.select("page_id", "url")), rules)
    rows = lexical(judged)
    blocked = (F.col("rule_verdict") == "block").cast("double")
    known = rows.filter(F.col("rule").isNotNull()).withColumn("label", blocked)
    known = known.dropDuplicates(["url"]).orderBy(F.xxhash64("url"), "url").limit(train_rows)
    known = materialize(known, "labelled-urls")
    both = known.agg(F.count("label"), F.avg("label")).first()
    output = ["page_id", "host", "path", "rule"]
    if both[0] == 0 or both[1] in (0.0, 1.0):
        alone = "block" if both[1] == 1.0 else "allow"
        return judged.select(
            *output,
            F.coalesce("rule_verdict", F.lit(alone)).alias("verdict"),
            F.lit(None).cast("double").alias("blocked"),
        )

    trained = fit(known, rows, trees, depth)
    # rows of a rule need no trees: they skip the join and the model
    rest = trained.chances(rows.filter(F.col("rule").isNull()))
    rest = rest.select(
        *output, F.when(F.col("blocked") >= 0.5, "block").otherwise("allow").alias("verdict"), "blocked"
    )
    ruled = judged.filter(F.col("rule").isNotNull()).select(
        *output, F.col("rule_verdict").alias("verdict"), F.lit(None).cast("double").alias("blocked")
    )
    return ruled.unionByName(rest)
