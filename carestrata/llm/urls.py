"""URLs judged by host rules and, where none fits, by two character models.

What the rules allow and what they block are the examples of two smoothed Markov models
of variable order: a character's probability after its context is what followed the
longest context seen, mixed with that of each shorter one (Witten-Bell weights). A URL is
blocked if, per character, it is likelier under the model of the blocked ones by more
than a cut. The cut is calibrated on examples that were not counted.

Counts, probabilities and sums are tables that grow with the distinct URLs; they are
joined by shuffles unless measured as small. Log ratios are whole millionths, so that sums
do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.runtime import broadcast_bounded, materialise

#: Characters of context at most, and the probability of a character nothing is known of.
ORDER, UNKNOWN = 5, 1.0 / 256
#: Cells of a score per nat, and the outermost cell.
CELLS, WIDEST = 64, 2048
#: Marks of the beginning and end of a URL.
BEGIN, END = "\x02", "\x03"

#: (verdict, host, path).
Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and the whole without its scheme; all empty without ``://`` but the last."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    host = F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    whole = F.when(at > 0, F.concat(host, rest.substr(F.length(raw) + 1, F.length(rest)))).otherwise(url)
    return host, path, whole


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, the first of equals; null if none.

    A rule fits its host and what lies below it, if the path starts with the rule's.
    """
    found = F.lit(None)
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found.cast("struct<rule:string,verdict:string>")


def grams(text: Column, order: int = ORDER) -> Column:
    """Each character of a marked text with the ``order`` characters before it."""
    chars = F.split(F.concat(F.lit(BEGIN * order), text, F.lit(END)), "")
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.array_join(F.slice(chars, i, order + 1), ""))


def suffix_counts(examples: DataFrame, order: int = ORDER) -> DataFrame:
    """(s, a, r): how often each ending of a gram occurs in allowed and blocked texts."""
    one = lambda verdict: F.sum((F.col("verdict") == verdict).cast("long"))
    whole = examples.select("verdict", F.explode(grams(F.col("text"), order)).alias("gram")).groupBy("gram").agg(one("allow").alias("a"), one("block").alias("r"))
    endings = F.expr(f"transform(sequence(1, {order + 1}), n -> right(gram, n))")
    return whole.select(F.explode(endings).alias("s"), "a", "r").groupBy("s").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))


def contexts(counts: DataFrame) -> DataFrame:
    """(c, na, ua, nr, ur): what follows a context, occurrences and different characters, per model."""
    before = F.expr("left(s, length(s) - 1)").alias("c")
    kinds = lambda c: F.sum((F.col(c) > 0).cast("long"))
    return counts.groupBy(before).agg(F.sum("a").alias("na"), kinds("a").alias("ua"), F.sum("r").alias("nr"), kinds("r").alias("ur"))


def log_ratios(targets: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, term): millionths of ln(blocked / allowed) of a gram's last character after the others."""
    pieces = F.expr(f"transform(sequence(1, {order + 1}), n -> struct(n as n, right(gram, n) as s, left(right(gram, n), n - 1) as c))")
    known = broadcast_bounded(counts, "url-counts")
    around = broadcast_bounded(contexts(counts), "url-contexts")
    rows = targets.select("gram", F.inline(pieces)).join(known, "s", "left").join(around, "c", "left")
    seen = F.struct("n", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("a", "na", "ua", "r", "nr", "ur")])
    steps = rows.groupBy("gram").agg(F.sort_array(F.collect_list(seen)).alias("steps"))

    def chance(hits: str, total: str, kinds: str) -> Column:
        step = lambda p, x: F.when(x[total] > 0, (x[hits] + x[kinds] * p) / (x[total] + x[kinds])).otherwise(p)
        return F.aggregate("steps", F.lit(UNKNOWN), step)

    ratio = F.log(chance("r", "nr", "ur")) - F.log(chance("a", "na", "ua"))
    return steps.select("gram", F.floor(ratio * 1000000 + 0.5).cast("long").alias("term"))


def cells(texts: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, verdict, score, cell) of distinct texts: the mean log ratio in millionths, and its cell."""
    spread = materialise(texts.select("key", "verdict", (F.length("text") + 1).cast("bigint").alias("n"), grams(F.col("text"), order).alias("grams")), "url-grams")
    each = spread.select("key", "verdict", "n", F.explode("grams").alias("gram"))
    terms = broadcast_bounded(log_ratios(each.select("gram").distinct(), counts, order), "url-terms")
    total = each.join(terms, "gram").groupBy("key", "verdict", "n").agg(F.sum("term").alias("sum"))
    mean = F.col("sum").cast("double") / F.col("n")
    cell = F.floor((F.col("sum") * CELLS).cast("double") / (F.col("n") * 1000000).cast("double"))
    return total.select("key", "verdict", F.floor(mean).cast("long").alias("score"), F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), cell)).cast("int").alias("cell"))


def calibrated_cut(known: DataFrame) -> int:
    """The cell from which to block: best mean of the shares of both verdicts judged right.

    Of equally good cells the one nearest to even odds counts, then the higher. Without
    examples of both verdicts it is the first cell in favour of blocking. A row per
    cell reaches the driver.
    """
    one = lambda verdict: F.sum((F.col("verdict") == verdict).cast("long"))
    rows = known.groupBy("cell").agg(one("allow").alias("a"), one("block").alias("r")).collect()
    allowed, blocked = sum(r["a"] for r in rows), sum(r["r"] for r in rows)
    if not allowed or not blocked:
        return 1
    tried = sorted({1, *(c for r in rows for c in (r["cell"], r["cell"] + 1))})
    right = lambda c: sum(r["r"] for r in rows if r["cell"] >= c) * allowed + sum(r["a"] for r in rows if r["cell"] < c) * blocked
    return max(tried, key=lambda c: (right(c), -abs(2 * c - 1), c))


def judged_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", order: int = ORDER) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row.

    The longest rule that fits a URL decides; else ``score``, the mean log ratio per
    character in millionths (null where a rule decides), against the calibrated cut.
    Examples are the distinct URLs without scheme that rules decide, all of them: those
    whose md5 begins with 0 to 3 calibrate, the others are counted.

    A null URL is empty; it and one without ``://`` have an empty host and path, fit no
    rule and are scored by their whole text. URLs of any length are read whole. Repeated
    rows and null ids are judged each; an empty table gives no rows; without examples a
    URL is allowed. Other columns are not read.
    """
    host, path, whole = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), whole.alias("text"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select(id_col, "host", "path", "text", "fit.rule", "fit.verdict")
    urls = materialise(rows.select(F.md5("text").alias("key"), "verdict", "text").groupBy("key", "verdict").agg(F.first("text").alias("text")), "url-texts")
    calibrates = F.col("key") < "4"
    counts = materialise(suffix_counts(urls.where(F.col("verdict").isNotNull() & ~calibrates), order), "url-suffixes")
    scored = materialise(cells(urls.where(F.col("verdict").isNull() | calibrates), counts, order), "url-scores")
    cut = calibrated_cut(scored.where("verdict is not null"))
    models = scored.where("verdict is null").select("key", "score", F.when(F.col("cell") >= cut, "block").otherwise("allow").alias("verdict"))
    open_rows = rows.where("verdict is null").drop("verdict").withColumn("key", F.md5("text"))
    by_model = open_rows.join(models, "key").select(id_col, "host", "path", "rule", "verdict", "score")
    by_rule = rows.where("verdict is not null").select(id_col, "host", "path", "rule", "verdict", F.lit(None).cast("long").alias("score"))
    return by_rule.unionByName(by_model)
