"""Personal data by weak supervision, in DataFrame and SQL functions only.

1. *Candidates.* Regular expressions find candidate spans of each kind. ``split`` gives the
   text between the matches, so every match has its place.
2. *Labelers.* Four labelers vote on each candidate (for, against, abstain): the strict form
   of the kind, a gazetteer, the words before it, and the characters around it.
3. *Aggregation.* Votes are counted by pattern (kind and votes: at most a few hundred
   rows). Expectation-maximisation on the pattern table estimates how reliable each
   labeler is and how likely each pattern is personal data.
4. *Span classifier.* A logistic regression on kind and votes, trained on the pattern table
   weighted by these probabilities, accepts or rejects the candidates of the added kinds.
   Base kinds (e-mail, IP, card, phone) follow their fixed rules and always stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.session import materialize

#: Kinds in the order of output; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "secret", "ssn", "iban")
BASE_KINDS = 4

# Fixed patterns of the base kinds, written so that no start or repetition is tried twice
# (``\G`` or a look-behind: matches begin at the start of a run; possessive repeats).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)\x20?[:=]\x20?[\x22']?[A-Za-z0-9+/_.~-]{8,}+[\x22']?",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
}
# What a text must hold for the pattern to be worth running.
_HINTS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "secret": lambda t: t.rlike(r"[:=]"),
    "ssn": lambda t: t.rlike(r"[0-9]-[0-9]"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
}
# Labeler 1: the strict form of a value. Repeats of groups are bounded: the matcher
# recurses on them.
_STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@([A-Za-z0-9-]+\.){1,9}[A-Za-z]{2,}$",
    "ip": r"^([1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$",
    "card": r"^([0-9]{14,19}|[0-9]{4}([\x20-][0-9]{2,6}){2,4})$",
    "phone": r"^\+[1-9][0-9]{0,2}[\x20-]?(\([0-9]{1,4}\)[\x20-]?)?[0-9]{2,}([\x20.-]?[0-9]{2,}){0,9}$",
    "secret": r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_.~-]{12,}",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}[\x20A-Z0-9]{11,}$",
}
# Labeler 2: gazetteers of well-known prefixes, suffixes and names; against: reserved ones.
_GAZETTEER = {
    "email": (r"\.(com|org|net|edu|gov|io|de|fr|es|uk|eu)$", r"@(localhost|test)\b"),
    "ip": (r"^([1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.", r"^0*(0|127|255)\."),
    "card": (r"^(4|5[1-5]|2[2-7]|3[47]|6)", r"^0"),
    "phone": (r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])", r"^\+0"),
    "secret": (r"(?i)^(password|passwd|token|api)", r"(?i)(example|changeme|xxxx)"),
    "ssn": (r"^[0-8]", r"^(123-45-6789|078-05-1120)$"),
    "iban": (r"^(AT|BE|CH|DE|ES|FR|GB|IT|LU|NL|PL|PT)", r"^(XX|ZZ)"),
}
# Labeler 3: words shortly before the value.
_CONTEXT = {
    "email": (r"(?i)(e-?mail|contact|write|address)\W*$", r"(?i)(commit|import|@param)\W*$"),
    "ip": (r"(?i)(\bip|host|server|address|from)\W*$", r"(?i)(version|release|section|v\.?)\W*$"),
    "card": (r"(?i)(card|visa|master|amex|credit|cc)\W*$", r"(?i)(isbn|order|invoice|id|no\.?)\W*$"),
    "phone": (r"(?i)(phone|tel|call|mobile|fax|cell)\W*$", r"(?i)(sum|plus|score)\W*$"),
    "secret": (r"(?i)(login|user|auth|with|and)\W*$", r"(?i)(param|arg|the)\W*$"),
    "ssn": (r"(?i)(ssn|social security|social)\W*$", r"(?i)(part|model|order)\W*$"),
    "iban": (r"(?i)(iban|account|konto|bank)\W*$", r"(?i)(part|serial|model)\W*$"),
}
CONTEXT_CHARS = 40
LABELERS = ("form", "gazetteer", "context", "border")
EM_ROUNDS, TOLERANCE, PRIOR, SMOOTHING = 20, 1e-3, 0.7, 1.0
ACCEPT = 0.5
# Matches of one block of running sums, and code points of one chunk of a text to cut pieces from.
BLOCK, CHUNK = 128, 1024


@dataclass(frozen=True)
class SpanModel:
    """Weights of the final classifier: by kind, and by labeler and vote (-1, 0, 1)."""

    bias: float
    kinds: tuple[float, ...]
    votes: tuple[tuple[float, float, float], ...]


# A start for empty corpora: the majority of votes.
MAJORITY = SpanModel(0.0, (0.0,) * len(KINDS), ((-1.0, 0.0, 1.0),) * len(LABELERS))


def _luhn(digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(digits))

    def value(i):
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(at, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = r"0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"
        return value.rlike(rf"^{part}(\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _vote(value: Column, rules: tuple[str, str]) -> Column:
    return F.when(value.rlike(rules[1]), -1).when(value.rlike(rules[0]), 1).otherwise(0)


def _with_blocks(df: DataFrame, arrays: list[str], join) -> DataFrame:
    """``df`` with ``<name>_before`` for each ``array<int>`` column: what ``join`` makes of all
    elements before each block of ``BLOCK`` elements. With ``_running`` the places of n matches
    cost n * BLOCK / 2 + (n / BLOCK) ** 2 / 2 steps: an ``aggregate`` over all of them would copy
    its state, which grows, at each step."""
    def blocks(a):
        of = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int"))
        each = F.transform(of, lambda b: F.aggregate(F.slice(a, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), join))
        return F.when(F.size(a) > 0, each).alias(f"{a}_before")

    def before(a):
        c = f"{a}_before"
        return F.transform(c, lambda _, b: F.aggregate(F.slice(c, F.lit(1), b), F.lit(0), join)).alias(c)

    rest = df.columns
    return df.select(*rest, *map(blocks, arrays)).select(*rest, *map(before, arrays))


def _running(a: str, j: Column, join) -> Column:
    """What ``join`` makes of the elements of ``a`` before place ``j``."""
    b = F.floor(j / BLOCK).cast("int")
    inside = F.aggregate(F.slice(a, b * BLOCK + 1, j % BLOCK), F.lit(0), join)
    return join(F.get(f"{a}_before", b), inside)


def _votes(kind: str) -> Column:
    """The matches of a kind (columns ``m`` and ``b`` of it) with their votes; null without one."""
    m, b = f"m_{kind}", f"b_{kind}"

    def vote(x):
        value, left, right = x["m"], x["l"], x["r"]
        around = F.when(left.rlike(r"[A-Za-z0-9_]$") | right.rlike("^[A-Za-z0-9_]"), -1).otherwise(1)
        return F.struct(
            F.length(left).alias("gap"), F.length(value).alias("length"), _valid(kind, value).alias("valid"),
            F.when(value.rlike(_STRICT[kind]), 1).otherwise(-1).alias("form"),
            _vote(value, _GAZETTEER[kind]).alias("gazetteer"),
            _vote(F.right(left, F.lit(CONTEXT_CHARS)), _CONTEXT[kind]).alias("context"), around.alias("border"))

    sides = F.arrays_zip(F.col(m).alias("m"), F.slice(b, F.lit(1), F.size(m)).alias("l"),
                         F.slice(b, F.lit(2), F.size(m)).alias("r"))
    return F.when(F.size(m) > 0, F.transform(sides, vote))


SPANS_TYPE = ("array<struct<start:int,kind:int,end:int,form:int,gazetteer:int,context:int,border:int>>")


def _add(a: Column, b: Column) -> Column:
    return a + b


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (``text`` and other columns, none of them named as below) with ``spans``:
    ``array<struct<start, kind, end, form, gazetteer, context, border>>``, all kinds by start,
    then kind; places in code points, end exclusive; null text is empty text."""
    rest = docs.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = docs.select(*rest, *(F.when(_HINTS[k](text), F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0)))
                                .alias(f"m_{k}") for k in KINDS))
    some = some.select(*rest, *(f"m_{k}" for k in KINDS), *(
        F.when(F.size(f"m_{k}") > 0, F.split(text, PATTERNS[k], -1)).alias(f"b_{k}") for k in KINDS))
    some = some.select(*rest, *(_votes(k).alias(f"v_{k}") for k in KINDS))
    steps = (F.transform(f"v_{k}", lambda v: v["gap"] + v["length"]).alias(f"n_{k}") for k in KINDS)
    some = _with_blocks(some.select(*rest, *(f"v_{k}" for k in KINDS), *steps), [f"n_{k}" for k in KINDS], _add)

    def spans(k):
        def span(v, j):
            start = _running(f"n_{k}", j, _add) + v["gap"]
            return F.struct(start.alias("start"), F.lit(KINDS.index(k)).alias("kind"), v["length"].alias("end"),
                            *(v[x].alias(x) for x in LABELERS), v["valid"].alias("valid"))

        # The test for null also keeps the blocks a column of their own: they are read twice.
        found = F.when(F.col(f"n_{k}_before").isNotNull(), F.transform(f"v_{k}", span))
        whole = F.transform(F.filter(found, lambda s: s["valid"]), lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), (s["start"] + s["end"]).alias("end"),
            *(s[x].alias(x) for x in LABELERS)))
        return F.coalesce(whole, F.from_json(F.lit("[]"), SPANS_TYPE))

    return some.select(*rest, F.array_sort(F.concat(*map(spans, KINDS))).alias("spans"))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` → ``(doc_id, spans)``, see ``with_spans``."""
    return with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "spans")


def patterns(found: DataFrame) -> DataFrame:
    """Votes counted by pattern: at most kinds × 3 ** labelers rows."""
    return (found.select(F.explode("spans").alias("s")).select("s.kind", *(f"s.{v}" for v in LABELERS))
            .groupBy("kind", *LABELERS).agg(F.count("*").alias("n")))


def _odds(prior: dict[int, float], votes: dict[str, dict[int, tuple[float, float]]]) -> Column:
    """Log odds of a pattern under the present estimates."""
    def table(values: dict[int, float]) -> Column:
        return F.create_map(*(F.lit(x) for kv in values.items() for x in kv))

    total = table({k: math.log(p / (1 - p)) for k, p in prior.items()})[F.col("kind")]
    for v, rates in votes.items():
        total = total + table({x: math.log(a / b) for x, (a, b) in rates.items()})[F.col(v)]
    return total


def reliabilities(counted: DataFrame, rounds: int = EM_ROUNDS) -> tuple[dict, dict]:
    """Expectation-maximisation on the pattern table; each round is one aggregate of it.
    Returns the share of personal data per kind, and per labeler and vote its rates
    ``(among personal data, among others)``."""
    prior = dict.fromkeys(range(len(KINDS)), PRIOR)
    votes = {v: {-1: (0.1, 0.4), 0: (0.3, 0.3), 1: (0.6, 0.3)} for v in LABELERS}
    for _ in range(rounds):
        before = list(prior.values())
        p = 1 / (1 + F.exp(-_odds(prior, votes)))
        # One row for the whole, the kind and each vote of a pattern: a short plan, however many sums.
        of = F.array(F.lit("all"), *(F.concat_ws(":", F.lit(c), F.col(c)) for c in ("kind", *LABELERS)))
        each = counted.select(F.explode(of).alias("of"), (F.col("n") * p).alias("yes"), (F.col("n") * (1 - p)).alias("no"))
        sums = {r["of"]: (r["yes"], r["no"]) for r in each.groupBy("of").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()}
        all_yes, all_no = (x + 3 * SMOOTHING for x in sums.get("all", (0.0, 0.0)))
        for k in range(len(KINDS)):
            a, b = sums.get(f"kind:{k}", (0.0, 0.0))
            a, b = a + SMOOTHING * PRIOR, b + SMOOTHING * (1 - PRIOR)
            prior[k] = a / (a + b)
        votes = {v: {x: tuple((s + SMOOTHING) / t for s, t in zip(sums.get(f"{v}:{x}", (0.0, 0.0)), (all_yes, all_no), strict=True))
                     for x in (-1, 0, 1)} for v in LABELERS}
        if max(abs(a - b) for a, b in zip(before, prior.values(), strict=True)) < TOLERANCE:
            break
    return prior, votes


def train(found: DataFrame) -> SpanModel:
    """The final classifier from all candidates of the corpus (``MAJORITY`` if there are none)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    counted = materialize(patterns(found).coalesce(1), "pii-patterns")
    if counted.isEmpty():
        return MAJORITY
    prior, votes = reliabilities(counted)
    p = 1 / (1 + F.exp(-_odds(prior, votes)))
    inputs = [F.when(F.col("kind") == k, 1.0).otherwise(0.0).alias(f"kind{k}") for k in range(len(KINDS))]
    inputs += [F.when(F.col(v) == x, 1.0).otherwise(0.0).alias(f"{v}{x + 1}") for v in LABELERS for x in (-1, 0, 1)]
    names = [f"kind{k}" for k in range(len(KINDS))] + [f"{v}{x}" for v in LABELERS for x in range(3)]
    both = (counted.select(*inputs, (F.col("n") * p).alias("yes"), (F.col("n") * (1 - p)).alias("no"))
            .select(*names, F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("yes").alias("weight")),
                                              F.struct(F.lit(0.0).alias("label"), F.col("no").alias("weight"))))
                    .alias("e")).select(*names, "e.label", "e.weight").filter("weight > 0"))
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(both)
    fitted = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=40, standardization=False).fit(rows)
    w = [float(x) for x in fitted.coefficients]
    n = len(KINDS)
    return SpanModel(float(fitted.intercept), tuple(w[:n]),
                     tuple(tuple(w[n + 3 * i:n + 3 * i + 3]) for i in range(len(LABELERS))))


def accepted(found: DataFrame, model: SpanModel) -> DataFrame:
    """``found(doc_id, spans, …)`` with only the spans that stay: all base ones, and added ones
    the classifier accepts."""
    def weight(values, at):
        return F.element_at(F.array(*map(F.lit, values)), at + 1)

    def keep(s):
        z = F.lit(model.bias) + weight(model.kinds, s["kind"])
        for v, w in zip(LABELERS, model.votes, strict=True):
            z = z + weight(w, s[v] + 1)
        return (s["kind"] < BASE_KINDS) | (1 / (1 + F.exp(-z)) >= ACCEPT)

    return found.withColumn("spans", F.filter("spans", keep))


def _of_kind(kind: int):
    return lambda s: s["kind"] == kind


def _written(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def detect(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, …)`` → one row per input row: ``doc_id, n_email, n_ip, n_card,
    n_phone, base_sha256, spans``, and over all kinds ``n_spans`` and ``has_personal_data``.

    Null and empty texts have no spans. Spans of different kinds may overlap. Repeated
    rows are found repeatedly; a null doc_id stays null."""
    found = materialize(candidates(docs), "pii-candidates")
    kept = accepted(found, train(found))
    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)]
    return kept.select("doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"),
                       _written(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"),
                       (F.size("spans") > 0).alias("has_personal_data"))


def _between(chunks: str, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text in chunks: reads only the chunks they lie in."""
    first = F.floor(start / CHUNK).cast("int")
    n = F.floor((end - 1) / CHUNK).cast("int") - first + 1
    near = F.array_join(F.slice(chunks, first + 1, n), "")
    return F.when(end > start, F.substring(near, start - first * CHUNK + 1, end - start)).otherwise("")


def with_masked(found: DataFrame) -> DataFrame:
    """``found(text, spans, …)`` with every span of ``text`` replaced by its kind in brackets; of
    overlapping spans the first gives the kind and all are covered. Pieces are cut from short
    chunks of the text and joined once."""
    rest = found.columns
    some = F.size("spans") > 0
    cut = found.select(
        *rest, F.when(some, F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{CHUNK}}}+"), F.lit(0))).alias("chunks"),
        F.when(some, F.transform("spans", lambda s: s["end"])).alias("ends"))
    cut = _with_blocks(cut, ["ends"], _larger)
    covered = F.transform("ends", lambda _, j: _running("ends", j, _larger))
    cut = cut.select(*rest, "chunks", F.when(F.col("ends_before").isNotNull(), covered).alias("covered"))
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def piece(s, at):
        return F.when(s["start"] >= at, F.concat(_between("chunks", at, s["start"]), F.element_at(names, s["kind"] + 1)))

    last = F.array_max(F.transform("spans", lambda s: s["end"]))
    whole = F.concat(F.array_join(F.zip_with("spans", "covered", piece), ""),
                     _between("chunks", last, F.length("text")))
    return cut.select(*(F.when(some, whole).otherwise(F.col("text")).alias(c) if c == "text" else c for c in rest))


def mask_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns, personal data in ``text`` masked (``n_chars``, where
    there is one, follows). The candidates are found once and written down beside the rows, for
    training and for masking: no text is shuffled, and a filter on the masked text does not take
    the search into its condition."""
    # The other columns as one, so that no name of them can clash.
    other = F.struct(*([c for c in docs.columns if c != "text"] or [F.lit(0).alias("none")])).alias("doc")
    found = materialize(with_spans(docs.select(other, F.col("text").cast("string").alias("text"))), "pii-spans")
    kept = with_masked(accepted(found, train(found)))
    out = kept.select(*(F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
