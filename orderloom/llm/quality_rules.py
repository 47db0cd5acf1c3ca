"""Quality rules with thresholds that follow the data: quantile sketches per language and source.

Every document gets integer measures. A sketch is a histogram with log-linear buckets (exact up to 1024, then within one
part in 512), so sketches of parts merge by adding counts, in any order, to the same result. Each (language, source) has
one per measure; a language's sketch is the sum of its sources'. A document is rejected if a measure lies outside the
fences of its (language, source) and also outside those of its language: a source with few rows leans on its language.
Only built-in functions run here: one pass over the texts, one aggregate with partial sums, one join with the fences.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.common import GAP, SPACES, cut_lineage, whole_text

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
EXACT = 1024


@dataclass(frozen=True)
class Fence:
    """Allowed range of a measure: quartiles widened by ``reach`` times their distance, which counts as ``least`` at least."""

    measure: str
    least: int
    reach: int = 3
    low: bool = False


#: Symbols and doubled lines in thousandths, mean word length in hundredths of a character.
FENCES = (
    Fence("symbol_share", 20),
    Fence("dup_line_share", 150),
    Fence("word_length", 150, low=True),
)


def _repeated(windows: str) -> tuple[Column, Column]:
    """Words in windows that occur twice or more: sort (window, place), keep equal neighbours, add up what they cover."""
    pairs = F.sort_array(F.transform(F.col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    at = F.col("_pairs")
    last = F.size(at) - 1
    twin = F.filter(
        at,
        lambda p, k: ((k > 0) & (F.get(at, k - 1)["h"] == p["h"])) | ((k < last) & (F.get(at, k + 1)["h"] == p["h"])),
    )
    return pairs, F.sort_array(F.transform(twin, lambda p: p["i"]))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``.

    Null texts count as empty: all measures 0, ``base_failed`` true. Columns of these names are replaced. Each row is
    judged by itself, so repeated rows and ties get equal measures. Documents of any length are read whole.
    """
    own = [c for c in docs.columns if c not in _MEASURES]
    body = whole_text(text)
    trimmed = F.btrim(body, F.lit(SPACES))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = docs.select(
        *own,
        F.when(trimmed == "", F.array().cast("array<bigint>"))
        .otherwise(F.transform(F.split(trimmed, GAP), lambda w: F.xxhash64(w)))
        .alias("_words"),
        F.length(F.translate(body, SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
    )
    word = F.col("_words")
    df = df.select(
        *own,
        "word_chars",
        "n_symbols",
        F.size("_words").cast("bigint").alias("n_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            F.size(word) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(word) - WINDOW),
                lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(WINDOW)]),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_windows"),
    )
    # Most texts repeat no window; only the others are sorted.
    pairs, twins = _repeated("_windows")
    none = F.size("_windows") == F.size(F.array_distinct("_windows"))
    df = df.select("*", F.when(~none, pairs).alias("_pairs")).select("*", twins.alias("_twins"))
    steps = F.zip_with("_twins", F.slice("_twins", 2, F.greatest(F.size("_twins"), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    repeated = F.coalesce(covered, F.lit(0).cast("bigint"))
    df = df.select("*", repeated.alias("n_repeat_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.select(*own, *_MEASURES[:-1], failed.alias("base_failed"))


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"]


def _shares() -> dict[str, Column]:
    over = lambda a, b, scale: F.expr(f"({scale} * {a}) div greatest({b}, 1)")
    return {
        "symbol_share": over("n_symbols", "word_chars", 1000),
        "dup_line_share": over("n_dup_lines", "n_lines", 1000),
        "word_length": over("word_chars", "n_words", 100),
    }


def _bucket(value: Column) -> Column:
    """The least value of the bucket: 512 to 1023 steps per power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 10, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame, keys: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Histograms of the documents that pass the base rules: keys, measure, bucket, rows."""
    pairs = F.array(*[F.struct(F.lit(f.measure).alias("measure"), _bucket(_shares()[f.measure]).alias("bucket")) for f in FENCES])
    entry = measured.where(~F.col("base_failed")).select(*keys, F.explode(pairs).alias("_e"))
    return entry.groupBy(*keys, F.col("_e.measure"), F.col("_e.bucket")).agg(F.count("*").alias("rows"))


def quartiles(histogram: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and third quartile per key and measure, one column each."""
    merged = histogram.groupBy(*keys, "measure", "bucket").agg(F.sum("rows").alias("rows"))
    group = Window.partitionBy(*keys, "measure")
    running = merged.select(
        *keys, "measure", "bucket",
        F.sum("rows").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum("rows").over(group).alias("_all"),
    )
    return running.groupBy(*keys).agg(
        *[
            F.min(F.when((F.col("measure") == f.measure) & (4 * F.col("_upto") >= q * F.col("_all")), F.col("bucket"))).alias(f"{f.measure}_q{q}")
            for f in FENCES
            for q in (1, 3)
        ]
    )


def fences(histogram: DataFrame, keys: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Bounds per keys: the wider of the keys' own and those of the first key alone."""

    def bounds(q: DataFrame, by: Sequence[str], tag: str) -> DataFrame:
        columns = []
        for f in FENCES:
            q1, q3 = F.col(f"{f.measure}_q1"), F.col(f"{f.measure}_q3")
            wide = f.reach * F.greatest(q3 - q1, F.lit(f.least))
            columns.append((q3 + wide).alias(f"{f.measure}_max{tag}"))
            columns.append(((q1 - wide) if f.low else F.lit(None).cast("bigint")).alias(f"{f.measure}_min{tag}"))
        return q.select(*by, *columns)

    own = bounds(quartiles(histogram, keys), keys, "")
    wider = bounds(quartiles(histogram, keys[:1]), keys[:1], "_all").withColumnRenamed(keys[0], "_first")
    joined = own.join(wider, own[keys[0]].eqNullSafe(wider["_first"]))
    return joined.select(
        *keys,
        *[F.greatest(f"{f.measure}_max", f"{f.measure}_max_all").alias(f"{f.measure}_max") for f in FENCES],
        *[F.least(f"{f.measure}_min", f"{f.measure}_min_all").alias(f"{f.measure}_min") for f in FENCES],
    )


def judge(measured: DataFrame, keys: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Add ``kept``: false if the base rules or the fences reject the row.

    ``measured`` is read three times, so pass a written table. Null keys form groups of their own. A group whose rows
    all failed the base rules has no fence; its rows are not kept anyway. An empty table stays empty.
    """
    limits = cut_lineage(fences(sketches(measured, keys), keys), "fences")
    limits = limits.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(c).alias(f"_{c}") for c in limits.columns if c not in keys])
    own = [c for c in measured.columns if c != "kept"]
    same = [measured[k].eqNullSafe(limits[f"_{k}"]) for k in keys]
    inside = F.lit(True)
    for f in FENCES:
        share = _shares()[f.measure]
        inside = inside & F.coalesce(share <= F.col(f"_{f.measure}_max"), F.lit(True))
        if f.low:
            inside = inside & F.coalesce(share >= F.col(f"_{f.measure}_min"), F.lit(True))
    return measured.select(*own).join(limits, same, "left").select(*own, (~F.col("base_failed") & inside).alias("kept"))


def quality_rules(docs: DataFrame, text: str = "text", keys: Sequence[str] = ("lang", "source"), keep_text: bool = True) -> DataFrame:
    """``docs`` with measures and ``kept``; with ``keep_text=False`` the text is not carried along."""
    measured = measure(docs, text)
    return judge(cut_lineage(measured if keep_text else measured.drop(text), "measured"), keys)
