"""URL filter: path and host rules first, then a ratio of two character language models.

Rules are few and exact (``block net/``); every URL that none of them fits is judged by two
variable-order Markov models of characters, one of accepted and one of rejected URLs.

* Labels. Rejected: blocked by a rule, or a seed term stands in the host. Accepted: all
  others (allowed by a rule, or so far let through). A URL that a rule allows although its
  host has a seed term is learned from by neither model.
* Models. The text of a URL is its host and path, ``A-Z`` folded, every run of digits one
  ``0``, between two marks. Characters are predicted from up to ``ORDER`` characters before
  them. Orders are interpolated by Witten-Bell: a context gives the lower order as much
  weight as it has different successors. Only strings seen ``MIN_COUNT`` times are kept, so
  a context is as long as the data bear: a place is judged at its longest kept string.
* Score. The sum over a URL's places of ``log accepted - log rejected``, in millionths of a
  nat and whole numbers (so that no order of summation shows), divided by its length. A
  string's entry in the model is its gain over its own tail, so the sum over *all* strings
  that end at a place is the value of the longest: one join and one sum, no search for it.
* Calibration. Part of the URLs (``HELD_OUT``, by a hash of the text) is kept out of the
  models. The border is the highest one, in thousandths of a nat, that rejects at most
  ``FALSE_REJECTS`` in a thousand of the accepted among them.

Everything is DataFrame functions. Counts are combined before they are shuffled; a string
of the model has at most one successor row per character, so no join key is hot while the
model is fitted; the model is broadcast only up to ``BROADCAST_STRINGS`` strings, beyond
that both sides are salted.

Null URLs and those without ``://`` have an empty host and path and are judged like any
other. Repeated rows are judged each; ids may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import materialize

ORDER, MIN_COUNT = 4, 2
HELD_OUT = "012"                # first hex digits of the text's md5 that are held out
FALSE_REJECTS = 10              # in a thousand accepted URLs held out
BROADCAST_STRINGS, SALTS = 1_000_000, 16
SCORE_BOUND = 20_000            # |score| in thousandths of a nat, for the calibration's bins
PIECE = 64                      # characters of a URL handled at once

# Words that, alone between dots and hyphens of a host, mark it as unwanted.
SEED_TERMS = ("adult", "betting", "casino", "escort", "gambling", "payday", "pharma", "pills", "poker", "porn",
              "sex", "torrent", "viagra", "warez", "xxx")

BEGIN, END = "\u0002", "\u0003"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: Sequence[str], host: Column, path: Column) -> tuple[Column, Column]:
    """``(rule, its verdict)``, null where none fits. A rule ``allow example.net/en/`` fits
    its host and all subdomains where the path begins with the rule's. The longest rule
    that fits wins, of equal ones the first given. For rule lists that fit an expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.split(" ", 1)[1])):
        what, where = rule.split(" ", 1)
        own, _, rest = where.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        name, verdict = F.when(fits, where).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def url_text(host: Column, path: Column) -> Column:
    return F.regexp_replace(F.concat(host, F.translate(path, _UPPER, _LOWER)), "[0-9]+", "0")


def _strings(rows: DataFrame, keys: Sequence[str], order: int) -> DataFrame:
    """One row per place of ``rows.text`` and order: the ``keys`` and ``s``, the place's
    character with up to ``order`` characters before it. Texts are cut in pieces first, each
    with the end of the one before it, and left behind: a place costs no more in a long text
    than in a short one."""
    found = F.regexp_extract_all(F.concat(F.lit(BEGIN), F.col("text"), F.lit(END)), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    rows = rows.select(*keys, found.alias("_all"))

    def piece(n: Column) -> Column:
        # The begin mark is a context only.
        before = F.when(n > 0, F.right(F.element_at("_all", F.greatest(n, F.lit(1))), F.lit(order))).otherwise("")
        return F.struct((F.length(before) + F.when(n > 0, 1).otherwise(2)).alias("at"),
                        F.concat(before, F.element_at("_all", n + 1)).alias("part"))

    pieces = F.transform(F.sequence(F.lit(0), F.size("_all") - 1), piece)
    rows = rows.select(*keys, F.explode(pieces).alias("_p")).select(*keys, F.col("_p.at").alias("_from"), "_p.part")
    rows = rows.select(*keys, "part", F.explode(F.sequence(F.col("_from"), F.length("part"))).alias("_at"))
    ends = [F.when(F.col("_at") > k, F.substr("part", F.col("_at") - k, F.lit(k + 1))) for k in range(order + 1)]
    return rows.select(*keys, F.explode(F.array(*ends)).alias("s")).filter("s IS NOT NULL")


def fit(urls: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT) -> tuple[DataFrame, Column]:
    """``urls(text, accepted, rejected)`` (counts of rows) → ``(model, known)``: the model's
    ``(s, gain)`` in millionths of a nat, and whether any URL is rejected (a scalar)."""
    counts = (_strings(urls, ["accepted", "rejected"], order).groupBy("s")
              .agg(F.sum("accepted").alias("na"), F.sum("rejected").alias("nr"))
              .filter((F.length("s") == 1) | (F.col("na") + F.col("nr") >= min_count)))
    counts = materialize(counts.withColumns({"k": F.length("s") - 1, "context": F.left("s", F.length("s") - 1)}),
                         "url-strings")
    # A context has at most one row per character, whatever the number of URLs.
    after = counts.groupBy("context").agg(
        F.sum("na").alias("ca"), F.count_if(F.col("na") > 0).alias("ta"),
        F.sum("nr").alias("cr"), F.count_if(F.col("nr") > 0).alias("tr"))
    counts = counts.join(after, "context")
    even = F.lit(1.0) / (counts.filter("k = 0").select(F.count("*")).scalar() + 1)

    def share(n: str, total: str, kinds: str, lower: Column) -> Column:
        return F.when(F.col(total) == 0, lower).otherwise(
            (F.col(n) + F.col(kinds) * lower) / (F.col(total) + F.col(kinds)))

    levels, below = [], None
    for k in range(order + 1):
        rows = counts.filter(F.col("k") == k)
        if below is None:
            rows = rows.withColumns({"la": even, "lr": even, "ld": F.lit(0).cast("long")})
        else:
            tail = below.select(F.col("s").alias("tail"), F.col("pa").alias("la"), F.col("pr").alias("lr"),
                                F.col("value").alias("ld"))
            rows = rows.withColumn("tail", F.substr("s", F.lit(2))).join(tail, "tail")
        rows = rows.withColumns({"pa": share("na", "ca", "ta", F.col("la")), "pr": share("nr", "cr", "tr", F.col("lr"))})
        value = F.floor((F.log("pa") - F.log("pr")) * 1e6 + 0.5)
        below = materialize(rows.withColumn("value", value).select("s", "pa", "pr", "value", "ld"), f"url-order-{k}")
        levels.append(below.select("s", (F.col("value") - F.col("ld")).alias("gain")))
    model = levels[0]
    for level in levels[1:]:
        model = model.unionByName(level)
    return model.filter("gain <> 0"), counts.select(F.max(F.col("nr") > 0)).scalar()


def score(rows: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """``rows`` (with ``text``) and ``total`` (millionths of a nat) and ``places``. Every row
    counts for itself, repeated ones too."""
    keyed = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "url-rows")
    strings = _strings(keyed, ["_row"], order)
    if model.limit(BROADCAST_STRINGS + 1).count() <= BROADCAST_STRINGS:
        strings = strings.join(F.broadcast(model), "s", "left")
    else:
        # Common strings stand in most URLs: their rows are dealt to SALTS copies of the model.
        salted = model.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        strings = strings.withColumn("_salt", F.pmod("_row", F.lit(SALTS)).cast("int")).join(salted, ["s", "_salt"], "left")
    totals = strings.groupBy("_row").agg(F.coalesce(F.sum("gain"), F.lit(0)).alias("total"))
    return keyed.join(totals, "_row").drop("_row").withColumn("places", F.length("text") + 1)


def border(scored: DataFrame, bin_: Column, false_rejects: int = FALSE_REJECTS) -> Column:
    """The highest border that rejects at most ``false_rejects`` in a thousand of the rows; a
    scalar, null without rows. The window has one row per bin, so at most 40,001."""
    bins = scored.groupBy(bin_.alias("bin")).count()
    below = F.coalesce(F.sum("count").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("count").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    bins = bins.withColumn("ok", below * 1000 <= total * false_rejects)
    return bins.filter("ok").select(F.max("bin")).scalar()


def judge(pages: DataFrame, rules: Sequence[str], seed_terms: Sequence[str] = SEED_TERMS, order: int = ORDER,
          false_rejects: int = FALSE_REJECTS) -> DataFrame:
    """``pages(page_id, url, …)`` → ``page_id, host, path, rule, verdict, score``, one row per
    page. ``verdict`` is ``allow`` or ``block``: the rule's, else the models'. ``score`` is
    in nats a character, positive towards accepted, and null where a rule decides. Without
    any rejected URL, or any accepted one held out, the models block nothing."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, ruling = longest_rule(rules, F.col("host"), F.col("path"))
    unwanted = F.col("host").rlike(rf"(^|[.-])({'|'.join(seed_terms)})([.-]|$)") if seed_terms else F.lit(False)
    rows = rows.withColumns({"rule": rule, "ruling": ruling, "text": url_text(F.col("host"), F.col("path"))})
    rows = rows.withColumns({
        "rejected": F.when(F.coalesce(F.col("ruling"), F.lit("")) == "allow", F.when(~unwanted, False))
                     .otherwise(F.col("ruling").isNotNull() | unwanted),
        "held": F.substr(F.md5("text"), F.lit(1), F.lit(1)).isin(*HELD_OUT)})
    urls = (rows.filter("rejected IS NOT NULL AND NOT held").groupBy("text")
            .agg(F.count_if(~F.col("rejected")).alias("accepted"), F.count_if("rejected").alias("rejected")))
    model, known = fit(urls, order)
    asked = rows.filter("rule IS NULL OR (held AND NOT rejected)")
    scored = materialize(score(asked, model, order), "url-scores")
    mean = F.col("total").cast("double") / F.col("places")
    bin_ = F.greatest(F.least(F.floor(mean / 1000), F.lit(SCORE_BOUND)), F.lit(-SCORE_BOUND)).cast("long")
    least = border(scored.filter("held AND NOT rejected"), bin_, false_rejects)
    blocked = F.coalesce(known, F.lit(False)) & F.coalesce(bin_ < least, F.lit(False))
    open_ = scored.filter("rule IS NULL").withColumns(
        {"verdict": F.when(blocked, "block").otherwise("allow"), "score": mean / 1e6})
    ruled = rows.filter("rule IS NOT NULL").withColumns(
        {"verdict": F.col("ruling"), "score": F.lit(None).cast("double")})
    names = ["page_id", "host", "path", "rule", "verdict", "score"]
    return ruled.select(*names).unionByName(open_.select(*names))
