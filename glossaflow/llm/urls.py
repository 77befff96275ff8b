"""URL filters: host and path rules, then a character language-model ratio.

Two variable-order Markov models, one of the URLs that rules accept and one of
those that rules reject, are interpolated over orders 0 to ``ORDER`` with
Witten-Bell weights: a context that was seen often is trusted, a rare one
leans on the shorter context. A URL's score is the difference of the two
log-likelihoods per character, and the cut is the score that separates the
rules' own verdicts best. All of it is DataFrame operations.

The number of model rows is bounded by the alphabet: at most 40 ** (ORDER + 1)
n-grams, whatever the corpus. Counting is pre-aggregated before the shuffle,
and averages per URL need no pair of URLs, so common hosts cost nothing extra.

Cases: a null URL or one without ``://`` has empty host and path, no rule fits
it, and the models judge the whole string (null: empty). Equal URLs get equal
verdicts and repeated rows stay. Without accepted or rejected URLs every score
is 0 or one-sided and the cut is 0, so scores of 0 are allowed. An empty table
gives an empty result. Very long URLs are taken whole, in linear time. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaflow.llm.common import checked_broadcast, materialize

#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

ORDER = 3
#: Characters kept as they are: the rest is one class, digits another.
PLAIN = "a-z0/._?=&%#:-"
ALPHABET = 40
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BINS = 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = _after_scheme(url)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, name, prefix = rule
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)


def apply_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, url, host, path, rule, ruled): the longest fitting rule or null."""
    host, path = host_and_path(F.col(url_col))
    judged = pages.select(id_col, F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    none = F.lit(None).cast("string")
    rule, verdict = none, none
    for r in reversed(longest):
        fits = _fits(F.col("host"), F.col("path"), r)
        rule = F.when(fits, r[1] + r[2]).otherwise(rule)
        verdict = F.when(fits, r[0]).otherwise(verdict)
    return judged.withColumns({"rule": rule, "ruled": verdict})


def symbols(url: Column) -> Column:
    """A URL over the models' alphabet: scheme off, lower case, classes."""
    rest = F.when(F.instr(url, "://") > 0, _after_scheme(url)).otherwise(F.coalesce(url, F.lit("")))
    folded = F.translate(rest, UPPER + "123456789", LOWER + "0" * 9)
    return F.regexp_replace(folded, f"[^{PLAIN}]", "~")


def grams(text: Column, order: int = ORDER) -> Column:
    """Every symbol with the ``order`` before it, start and end marked."""
    marked = F.concat(F.lit("^" * order), text, F.lit("$"))
    return F.regexp_extract_all(marked, F.lit(f"(?=(.{{{order + 1}}}))"), 1)


def train(judged: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, gain): log P(accepted) - log P(rejected) for each n-gram that
    occurs in ``judged`` (columns symbols, ruled), seen under a rule or not."""
    counted = (
        judged.select(F.explode(grams(F.col("symbols"), order)).alias("gram"), (F.col("ruled") == "allow").cast("long").alias("a"), (F.col("ruled") == "block").cast("long").alias("b"))
        .groupBy("gram")
        .agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b"))
    )
    tables = [materialize(counted, "url-grams")]
    for _ in range(order):
        tables.append(tables[-1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")))

    def level(shorter: DataFrame | None, table: DataFrame) -> DataFrame:
        table = table.withColumn("context", F.expr("substring(gram, 1, length(gram) - 1)"))
        sums = table.groupBy("context").agg(*(f(F.col(c)).alias(k + c) for c in "ab" for k, f in (("n", F.sum), ("t", lambda x: F.sum((x > 0).cast("long"))))))
        table = table.join(sums, "context")
        if shorter is None:
            table = table.withColumns({"qa": F.lit(1 / ALPHABET), "qb": F.lit(1 / ALPHABET)})
        else:
            table = table.withColumn("tail", F.expr("substring(gram, 2)")).join(shorter.select(F.col("gram").alias("tail"), F.col("pa").alias("qa"), F.col("pb").alias("qb")), "tail")
        return table.select("gram", *(F.coalesce(F.try_divide(F.col(c) + F.col(f"t{c}") * F.col(f"q{c}"), F.col(f"n{c}") + F.col(f"t{c}")), F.col(f"q{c}")).alias(f"p{c}") for c in "ab"))

    top = reduce(level, reversed(tables), None)
    return top.select("gram", (F.log("pa") - F.log("pb")).alias("gain"))


def score(judged: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """(symbols, ratio): the mean gain per symbol of each distinct string.

    Repeats of a string count several times in its mean, which leaves the mean
    as it is and needs no distinct beforehand.
    """
    known = checked_broadcast(model)
    return judged.select("symbols", F.explode(grams(F.col("symbols"), order)).alias("gram")).join(known, "gram").groupBy("symbols").agg(F.avg("gain").alias("ratio"))


def cut(scored: DataFrame) -> DataFrame:
    """One row (cut): the cut with the best balanced accuracy on what rules
    decided. Between two neighbouring scores it lies as near to zero as it can;
    ties go to the cut nearest zero, then the lower."""
    bins = (
        scored.where("ruled is not null")
        .groupBy(F.floor(F.greatest(F.lit(-20.0), F.least(F.lit(20.0), "ratio")) * BINS).alias("bin"))
        .agg(F.sum((F.col("ruled") == "allow").cast("long")).alias("a"), F.sum((F.col("ruled") == "block").cast("long")).alias("b"))
    )
    summed = bins.selectExpr(
        f"greatest(lag(bin, 1, {-20 * BINS - 1}) over (order by bin) + 1, least(bin, 0)) as edge",
        "try_divide(sum(a) over (order by bin desc), sum(a) over ()) - try_divide(sum(b) over (order by bin desc), sum(b) over ()) as gain",
    )
    best = summed.selectExpr("max_by(edge, struct(gain, -abs(edge), -edge)) as edge")
    return best.select(F.coalesce(F.col("edge") / F.lit(float(BINS)), F.lit(0.0)).alias("cut"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, ratio): the rule's verdict, else the
    models'."""
    judged = apply_rules(pages, rules, id_col, url_col).withColumn("symbols", symbols(F.col("url")))
    model = materialize(train(judged), "url-model")
    # Written, so that the join below can split a URL of very many rows.
    ratios = materialize(score(judged, model), "url-ratios")
    scored = materialize(judged.join(ratios, "symbols").drop("symbols", "url"), "url-scores")
    limit = cut(scored).first()["cut"]
    verdict = F.coalesce("ruled", F.when(F.col("ratio") >= limit, "allow").otherwise("block"))
    return scored.select(id_col, "host", "path", "rule", verdict.alias("verdict"), F.round("ratio", 6).alias("ratio"))
