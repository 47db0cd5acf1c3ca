"""URL filters: rules by host and path, and a logistic regression on hashed character n-grams for what no rule decides.

The labelled URLs are a bounded table (``max_rows``): urls that a rule decides, chosen by hash. Training is gradient descent on that table,
one aggregate with partial sums per step; the model (one double per hash place) is a literal of the scan that scores all urls. Only
built-in functions run on the rows.
"""

from __future__ import annotations


import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut_lineage

#: The rules, host and path as one text, and the verdict of each.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
PLACES = 4096
LENGTHS = (3, 4, 5)


def parts(docs: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``: after the first ``://`` up to ``/ ? #``, A-Z lowered, then up to ``? #``; else both empty."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    own = [c for c in docs.columns if c not in ("host", "path")]
    split = docs.select(*own, F.coalesce(rest, F.lit("")).alias("_rest"))
    host = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    tail = F.expr("substring(_rest, length(regexp_extract(_rest, '^[^/?#]*', 0)) + 1)")
    return split.select(
        *own,
        F.translate(host, string.ascii_uppercase, string.ascii_lowercase).alias("host"),
        F.regexp_extract(tail, r"^[^?#]*", 0).alias("path"),
    )


def rule(rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, path = text.partition("/")
        fits = ((F.col("host") == domain) | F.col("host").endswith(f".{domain}")) & F.col("path").startswith(slash + path)
        name, verdict = F.when(fits, text).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _grams(text: Column, tag: str) -> Column:
    """Hash places of the distinct n-grams of a text with its ends marked."""
    marked = F.concat(F.lit(f"{tag}^"), text, F.lit("$"))
    each = [
        F.when(
            F.length(marked) >= n,
            F.transform(F.sequence(F.lit(1), F.length(marked) - (n - 1)), lambda i, n=n: F.pmod(F.xxhash64(F.substring(marked, i, F.lit(n)), F.lit(tag)), F.lit(PLACES)).cast("int")),
        ).otherwise(F.array().cast("array<int>"))
        for n in LENGTHS
    ]
    return F.concat(*each)


def features() -> Column:
    return F.array_distinct(F.concat(_grams(F.col("host"), "h"), _grams(F.col("path"), "p")))


def _literal(weights: Sequence[float]) -> Column:
    """Weights as a constant array: the optimizer folds the text once."""
    return F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")


def _margin(places: Column, weights: Sequence[float], bias: float) -> Column:
    table = _literal(weights)
    total = F.aggregate(places, F.lit(0.0), lambda acc, p: acc + F.get(table, p))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size(places), F.lit(1)).cast("double"))


def fit(labelled: DataFrame, steps: int = 30, rate: float = 4.0, ridge: float = 1e-3) -> tuple[list[float], float]:
    """Weights and bias from a written table with ``places`` and ``label`` (0 or 1); zeros for an empty one.

    Gradient descent with momentum; each step sums one number per place on the cluster (PLACES numbers come back).
    """
    weights, speed = [0.0] * PLACES, [0.0] * PLACES
    bias = bias_speed = 0.0
    # A bounded table: in one partition each step is one task and needs no shuffle.
    labelled = labelled.coalesce(1)
    rows = labelled.count()
    for _ in range(steps if rows else 0):
        chance = 1 / (1 + F.exp(-_margin(F.col("places"), weights, bias)))
        gap = labelled.select(F.explode(F.concat("places", F.array(F.lit(PLACES)))).alias("place"), (chance - F.col("label")).alias("gap"), F.sqrt(F.size("places").cast("double")).alias("norm"))
        scaled = F.when(F.col("place") == PLACES, F.col("gap")).otherwise(F.col("gap") / F.col("norm"))
        slopes = dict(gap.groupBy("place").agg(F.sum(scaled)).toLocalIterator())
        for p in range(PLACES):
            speed[p] = 0.9 * speed[p] - rate * (round(slopes.get(p, 0.0), 9) / rows + ridge * weights[p])
            weights[p] += speed[p]
        bias_speed = 0.9 * bias_speed - rate * 0.1 * round(slopes.get(PLACES, 0.0), 9) / rows
        bias += bias_speed
    return weights, bias


def labelled_urls(split: DataFrame, rules: Sequence[tuple[str, str]], max_rows: int) -> DataFrame:
    """At most ``max_rows`` distinct (host, path) that a rule decides, by hash, with their label (1: block)."""
    name, verdict = rule(rules)
    known = split.select("host", "path", verdict.alias("verdict")).where("verdict is not null")
    slot = F.pmod(F.xxhash64("host", "path"), F.lit(1 << 30))
    share = min(1.0, 0.9 * max_rows / max(known.count(), 1))
    few = known.where(slot < int(share * (1 << 30)) + 1).distinct().limit(max_rows)
    return few.select(features().alias("places"), F.when(F.col("verdict") == "block", 1.0).otherwise(0.0).alias("label"))


def url_filter(docs: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES, max_rows: int = 4000) -> DataFrame:
    """``docs`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (chance that the url is to be blocked).

    A rule's verdict wins; else a score of 0.5 or more blocks. Null urls and those without ``://`` have an empty host and
    path and are scored as such. Every row is judged alone, so repeated rows agree. Without urls that a rule decides, or with an
    empty table, the score is 0.5. Columns named like an output are replaced.
    """
    made = ("host", "path", "rule", "score", "verdict")
    own = [c for c in docs.columns if c not in made]
    base = docs.select(*own)
    sample = labelled_urls(parts(base.select(url), url), rules, max_rows)
    weights, bias = fit(cut_lineage(sample, "url-labels"))
    name, verdict = rule(rules)
    scored = parts(base, url).withColumn("_places", features())
    scored = scored.select(*own, "host", "path", name.alias("rule"), verdict.alias("_says"), (1 / (1 + F.exp(-_margin(F.col("_places"), weights, bias)))).alias("score"))
    return scored.select(*own, "host", "path", "rule", F.coalesce("_says", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
