"""URL filter: rules on hosts and paths, and gradient-boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.llm import _common as c

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labelled URLs that trees are fitted on, about, at most: half of them for each label.
SAMPLE = 20_000
#: Parts of the labelled rows; a row's suffix statistics for fitting come from the other parts.
FOLDS = 5

# Words in a host that mark it as unwanted, the seed labels of the production query.
SEED_WORDS = ("ads", "adserver", "adult", "bets", "casino", "pills", "popunder", "porn", "spam", "tracker", "viagra", "warez", "xxx")


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host, its subdomains, and paths that start alike.

    ``pattern`` is a host and a path as one string, such as ``example.com/en/``.
    """

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0].translate(str.maketrans(UPPER, LOWER))

    @property
    def path(self) -> str:
        _, slash, rest = self.pattern.partition("/")
        return slash + rest


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for a null or a string without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as (its pattern, its verdict), or nulls. One projection, no join."""
    pattern = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        pattern, verdict = F.when(fits, F.lit(r.pattern)).otherwise(pattern), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return pattern, verdict


def _entropy(text: Column) -> Column:
    """Bits a character of a string, from its sorted characters in one pass."""
    n = F.length(text)
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))
    weight = lambda run: F.when(run > 0, run * F.log2(run)).otherwise(F.lit(0.0))

    def step(a: Column, x: Column) -> Column:
        same = a["last"] == x
        return F.struct(
            x.alias("last"), F.when(same, a["run"] + 1.0).otherwise(F.lit(1.0)).alias("run"), F.when(same, a["sum"]).otherwise(a["sum"] + weight(a["run"])).alias("sum")
        )

    total = F.aggregate(F.array_sort(F.split(text, "")), start, step, lambda a: a["sum"] + weight(a["run"]))
    return F.when(n > 0, F.log2(n) - total / n).otherwise(F.lit(0.0))


def _labels(host: Column, n: int) -> Column:
    """The last ``n`` labels of a host."""
    return F.substring_index(host, ".", -n)


LEXICAL = ("url_length", "host_length", "path_length", "depth", "digit_ratio", "host_digit_ratio", "entropy", "host_entropy", "n_parameters", "query_length", "n_labels", "n_hyphens", "has_fragment", "is_https")
SUFFIX = tuple(f"suffix{n}_{what}" for n in (1, 2, 3) for what in ("rate", "log_count"))


def features(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, the lexical features and the three suffixes of the host."""
    u = F.coalesce(F.col(url), F.lit(""))
    df = df.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    digits = lambda x: F.regexp_count(x, F.lit("[0-9]"))
    part = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    made = {
        "url_length": F.length(u),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.regexp_count(path, F.lit("/[^/]")),
        "digit_ratio": part(digits(u), F.length(u)),
        "host_digit_ratio": part(digits(host), F.length(host)),
        "entropy": _entropy(u),
        "host_entropy": _entropy(host),
        "n_parameters": F.regexp_count(query, F.lit("[^&=]+=?[^&]*")),
        "query_length": F.length(query),
        "n_labels": F.regexp_count(host, F.lit("[^.]+")),
        "n_hyphens": F.regexp_count(host, F.lit("-")),
        "has_fragment": F.instr(u, "#") > 0,
        "is_https": u.startswith("https:"),
    }
    return df.withColumns({k: v.cast("double") for k, v in made.items()} | {f"suffix{n}": _labels(host, n) for n in (1, 2, 3)})


@dataclass(frozen=True)
class Model:
    """Trees over LEXICAL + SUFFIX, and the suffix statistics that they use (a table in the shared folder)."""

    trees: PipelineModel | None
    suffixes: DataFrame
    base_rate: float


def suffix_statistics(rows: DataFrame, label: str = "label", fold: Column | None = None) -> DataFrame:
    """(suffix, n, blocked) for every suffix of one to three labels, over all labelled rows.

    With ``fold``, (suffix, fold, n, blocked): the counts of all rows but those of the fold.
    A grouping with a partial step, so a host with a third of the rows is a few rows for each task; a suffix has a row for each fold.
    """
    by = [] if fold is None else ["fold"]
    suffixes = F.array_distinct(F.array("suffix1", "suffix2", "suffix3"))
    each = rows.select(F.explode(suffixes).alias("suffix"), F.col(label).cast("long").alias("y"), *([] if fold is None else [fold.alias("fold")]))
    counts = each.groupBy("suffix", *by).agg(F.count("*").alias("n"), F.sum("y").alias("blocked"))
    if fold is None:
        return counts
    whole = Window.partitionBy("suffix")
    others = lambda x: (F.sum(x).over(whole) - F.col(x)).alias(x)
    return counts.select("suffix", "fold", others("n"), others("blocked"))


def with_suffixes(rows: DataFrame, suffixes: DataFrame, base_rate: float) -> DataFrame:
    """Add the share of blocked URLs, smoothed towards the base rate, and the log count of each suffix.

    Statistics with a ``fold`` are joined on that of the rows, too. If they are too large to broadcast, they are brought together for
    each distinct three-label suffix first, and the rows take one join on that: no row is dealt by a suffix such as ``com``.
    """
    small = c.size_of(suffixes) <= c.BROADCAST_BYTES
    by = [x for x in suffixes.columns if x == "fold"]
    keys = rows if small else rows.select("suffix1", "suffix2", "suffix3", *by).distinct()
    for k in (1, 2, 3):
        s = suffixes.select(F.col("suffix").alias(f"suffix{k}"), F.col("n").alias("_n"), F.col("blocked").alias("_b"), *by)
        keys = keys.join(F.broadcast(s) if small else s, [f"suffix{k}", *by], "left")
        n, b = F.coalesce("_n", F.lit(0)), F.coalesce("_b", F.lit(0))
        rate = (b + F.lit(base_rate * 5)) / (n + F.lit(5.0))
        keys = keys.withColumns({f"suffix{k}_rate": rate.cast("double"), f"suffix{k}_log_count": F.log1p(n.cast("double"))}).drop("_n", "_b")
    return keys if small else rows.join(keys.drop("suffix1", "suffix2"), ["suffix3", *by], "left")


def _fold(column: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("url-fold"), F.col(column)), F.lit(FOLDS))


def fit(labelled: DataFrame, url: str = "url", label: str = "label", sample: int = SAMPLE, trees: int = 10, depth: int = 4) -> Model:
    """Learn from URLs with a 0/1 ``label``; rows with a null in either are left out.

    Suffix statistics cover all labelled rows. No row is fitted on statistics that count its own label: each is used twice, with half the
    weight, once with the counts of the other folds of URLs (as of a known site) and once with those of the other folds of
    sites, of one to three labels (as of a site that has no labelled URL, where the lexical features must tell). The trees are fitted on about ``sample`` distinct URLs at most, drawn by a
    hash of the URL: about half for each label, or all that a label has. A URL weighs as many rows as it has under its label, divided by
    the part of the label's URLs that were drawn, so that labels and repeats count as in all rows.
    A label that is the same everywhere gives its rate as every score.
    """
    rows = features(labelled.select(F.col(url).alias("url"), F.col(label).cast("double").alias("label")).where("url is not null and label is not null"))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.avg("label"), F.lit(0.0)).alias("rate")).first()
    suffixes = c.materialise(suffix_statistics(rows), "url-suffixes")
    distinct = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.approx_count_distinct("url", 0.01).alias("n")).collect()}
    if len(distinct) < 2:
        return Model(None, suffixes, size["rate"])
    # a label with fewer URLs than its half leaves its room to the other
    least = min(distinct.values())
    room = max(sample // 2, sample - least)
    share = {y: min(1.0, (room if n > least else sample // 2) / n) for y, n in distinct.items()}
    steps = 1 << 40
    place = F.pmod(F.xxhash64(F.lit("url-sample"), F.col("url")), F.lit(steps))
    of_label = lambda values: F.create_map(*[F.lit(float(x)) for pair in values.items() for x in pair])[F.col("label")]
    drawn = rows.where(place < of_label({y: steps if part == 1.0 else int(steps * part) for y, part in share.items()}))
    kept = [x for x in drawn.columns if x not in ("url", "label")]
    drawn = drawn.groupBy("url", "label").agg(F.count("*").alias("_rows"), *[F.first(x).alias(x) for x in kept])
    drawn = drawn.withColumn("_weight", F.col("_rows") / of_label(share))
    drawn = c.materialise(drawn.withColumn("_weight", F.col("_weight") / 2), "url-sample")
    views = []
    for by in ("url", "suffix3"):
        others = c.materialise(suffix_statistics(rows, fold=_fold(by)), "url-suffixes-of-other-folds")
        views.append(with_suffixes(drawn.withColumn("fold", _fold(by)), others, size["rate"]).select("label", "_weight", *LEXICAL, *SUFFIX))
    drawn = c.materialise(views[0].unionByName(views[1]), "url-views")
    columns = [*LEXICAL, *SUFFIX]
    stages = [
        VectorAssembler(inputCols=columns, outputCol="_features"),
        GBTClassifier(featuresCol="_features", labelCol="label", weightCol="_weight", maxIter=trees, maxDepth=depth, seed=11),
    ]
    return Model(Pipeline(stages=stages).fit(drawn), suffixes, size["rate"])


def judge(df: DataFrame, rules: Sequence[Rule], model: Model, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (the longest that fits, or null), ``verdict`` and ``score``.

    ``verdict`` is allow or block: the rule's where one fits, else block where the trees' probability
    ``score`` is over ``threshold``. Null and malformed URLs have an empty host and path, no rule, and the trees'
    verdict on those. All other columns stay, but for those of the same names; repeated rows are judged alike.
    """
    kept = [x for x in df.columns if x.lower() not in {"host", "path", "rule", "verdict", "score"}]
    rows = features(df.select(F.struct(*kept).alias("_row"), F.col(url).alias("url")))
    rows = with_suffixes(rows, model.suffixes, model.base_rate)
    if model.trees is None:
        rows = rows.withColumn("score", F.lit(float(model.base_rate)))
    else:
        rows = model.trees.transform(rows).withColumn("score", vector_to_array("probability")[1])
    pattern, verdict = rule_for(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("score") > threshold, "block").otherwise("allow")
    return rows.select("_row.*", "host", "path", pattern.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "score")


def seed_labels(df: DataFrame, url: str = "url", words: Sequence[str] = SEED_WORDS) -> DataFrame:
    """(url, label): 1 where a part of the host, cut at dots and hyphens, is one of ``words``."""
    parts = F.split(host_of(F.col(url)), r"[.\-]")
    return df.select(F.col(url).alias("url"), F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words])).cast("int").alias("label"))
