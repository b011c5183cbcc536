"""Personal data by weak supervision (built-in functions only).

Base spans of four kinds come from fixed patterns with their checks and always
stay.  Beside them every token of seven characters or more that holds a digit is
a candidate.  Regex, gazetteer and context labelers vote on candidates (+1
personal or secret, -1 not, 0 abstains); expectation-maximisation over the vote
patterns estimates the labelers' reliabilities, and the resulting posteriors train
a final span classifier on the candidates' shape, length and surroundings.  What
it accepts, and no base span touches, is added as ``secret`` or ``id``.

Places are code points.  They come from a pattern's matches and the text between
them, by running sums of lengths (k log k for k matches), so long texts with many
matches stay cheap.  Patterns are possessive, hence neither recursive nor
quadratic, and match what their plain forms match.

Defined results: null and empty texts have no spans; equal rows have equal
spans; other columns are carried, and one that bears the name of an output
column is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import let, shielded, store
from keelson.llm.em import fit_votes

#: The base kinds in their order, then the added ones.
KINDS = ("email", "ip", "card", "phone", "secret", "id")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text may hold a kind at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CANDIDATE = r"(?<![A-Za-z0-9().+_/@-])(?=[A-Za-z().+_/@-]*+[0-9])[A-Za-z0-9().+_/@-]{7,}+"

#: Words that announce personal data or secrets, and plain numbers.
PERSONAL = ("password", "passwd", "pwd", "token", "secret", "key", "api_key", "apikey", "login", "user", "phone", "tel", "mobile", "fax", "call", "mail", "email", "card", "account", "iban", "ssn", "passport", "ip", "address")
PLAIN = ("page", "pages", "section", "chapter", "version", "figure", "table", "item", "volume", "isbn", "doi", "part", "article", "year")
LABELERS = ("shape", "mixed", "announced", "assigned", "mailbox", "varied")
CONTEXT = 24
SHAPES = 256


def found(text: Column, pattern: str, hint: str) -> Column:
    """Matches as ``array<struct<start, end, m, before>>``; ``before`` is up to 24
    characters of the text between this match and the last."""

    def place(ms: Column, gaps: Column) -> Column:
        steps = F.transform(ms, lambda x, i: F.length(F.get(gaps, i)) + F.coalesce(F.length(F.get(ms, i - 1)), F.lit(0)))
        rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ms))).cast("int"))
        add = lambda a, r: F.transform(a, lambda x, i: x + F.coalesce(F.get(a, i - F.pow(F.lit(2), r).cast("int")), F.lit(0)))
        return let(F.aggregate(rounds, steps, add), lambda starts: F.transform(ms, lambda x, i: struct(x, F.get(starts, i), F.get(gaps, i))))

    def struct(m: Column, start: Column, gap: Column) -> Column:
        return F.struct(start.cast("long").alias("start"), (start + F.length(m)).cast("long").alias("end"), m.alias("m"), F.substring(gap, -CONTEXT, CONTEXT).alias("before"))

    none = F.array().cast("array<struct<start:bigint,end:bigint,m:string,before:string>>")
    matched = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    some = let(matched, lambda ms: F.when(F.size(ms) > 0, let(F.split(text, pattern, -1), lambda gaps: place(ms, gaps))).otherwise(none))
    return F.when(text.rlike(hint), some).otherwise(none)


def valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return (F.length(digits) >= 14) & (F.length(digits) <= 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return (F.length(digits) >= 10) & (F.length(digits) <= 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """``array<struct<start, kind, end>>`` of the base kinds, in order."""
    each = []
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        good = F.filter(found(text, pattern, HINTS[kind]), lambda x: valid(kind, x.m))  # noqa: B023  applied at once
        each.append(F.transform(good, lambda x: F.struct(x.start.alias("start"), F.lit(i).alias("kind"), x.end.alias("end"))))
    return F.sort_array(F.concat(*each))


def last_word(before: Column) -> Column:
    """The last word before a match, past quotes and assignment signs."""
    return F.lower(F.regexp_extract(before, r"([A-Za-z_]+)[\s=:'\"#]*$", 1))


def votes(m: Column, before: Column) -> list[Column]:
    """The labelers in the order of ``LABELERS``."""
    pick = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    letters = m.rlike("[A-Za-z]")
    kinds = F.size(F.array_distinct(F.split(m, "")))
    word = last_word(before)
    shaped = m.rlike(r"^[^@]+@[^@]+\.[A-Za-z]+$|^[0-9]+(?:\.[0-9]+){3}$|^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^\(?[0-9]{3}\)?[.-]?[0-9]{3}[.-]?[0-9]{4}$|^[0-9]{14,19}$|^[0-9a-fA-F]{16,}$")
    return [
        pick(shaped, m.rlike(r"^[0-9]{1,3}(?:[.,/][0-9]+)?$|^[0-9]+[./-][0-9]+$")),
        pick(letters & (digits >= 3) & (F.length(m) >= 12), ~letters & (digits < 9)),
        pick(word.isin(*PERSONAL), word.isin(*PLAIN)),
        pick(before.rlike(r"[=:]\s*['\"]?$"), before.rlike(r"[$€£#%]\s*$")),
        pick(m.contains("@"), F.lit(False)),
        pick((kinds >= 8) & (digits >= 4), kinds <= 3),
    ]


def features(m: Column, before: Column) -> list[Column]:
    """Small integers that the classifier weighs: shape, length, sign, word."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), "[A-Za-z]+", "a"), "(?:9a|a9){2,}", "x")
    word = last_word(before)
    sign = F.when(before.rlike(r"[=:]\s*['\"]?$"), 1).when(before.rlike(r"[$€£#%]\s*$"), 2).when(before.rlike(r"\s$"), 3).otherwise(0)
    return [
        F.pmod(F.xxhash64(shape), F.lit(SHAPES)).cast("int"),
        F.least(F.length(m), F.lit(63)).cast("int"),
        sign,
        F.when(word.isin(*PERSONAL), 1).when(word.isin(*PLAIN), 2).otherwise(0),
    ]


WIDTHS = (SHAPES, 64, 4, 3)


@dataclass(frozen=True)
class SpanClassifier:
    """Log-odds of the prior and of every feature value."""

    prior: float
    weights: tuple[tuple[float, ...], ...]

    def log_odds(self, m: Column, before: Column) -> Column:
        total = F.lit(self.prior)
        for f, ws in zip(features(m, before), self.weights, strict=True):
            total = total + F.get(F.lit(list(ws)), f)
        return total


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(m, before)`` of every candidate of all texts."""
    each = docs.select(F.explode(found(F.col(text), CANDIDATE, "[0-9]")).alias("x"))
    return each.select("x.m", "x.before")


def fit(docs: DataFrame, text: str = "text") -> SpanClassifier:
    """Labelers weighed by EM, then the classifier from their posteriors.

    One pass over the texts; only votes and features of the candidates are stored.
    Counts per feature value (at most 327) reach the driver.
    """
    got = candidates(docs, text)
    m, before = F.col("m"), F.col("before")
    names = [f"f{i}" for i in range(len(WIDTHS))]
    slim = store(got.select(*[v.alias(n) for n, v in zip(LABELERS, votes(m, before), strict=True)], *[f.alias(n) for n, f in zip(names, features(m, before), strict=True)]), "pii-votes")
    model = fit_votes(slim, list(LABELERS))
    soft = slim.withColumn("q", model.posterior([F.col(n) for n in LABELERS]))
    pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(n).alias("v")) for i, n in enumerate(names)])
    rows = soft.select("q", F.explode(pairs).alias("p")).groupBy("p.f", "p.v").agg(F.sum("q").alias("yes"), F.sum(1 - F.col("q")).alias("no")).collect()
    # sums are rounded, so that the order of adding them up leaves no trace
    yes = round(sum(r.yes for r in rows if r.f == 0), 6)
    no = round(sum(r.no for r in rows if r.f == 0), 6)
    odds = log((yes + 1) / (no + 1))
    weights = [[0.0] * w for w in WIDTHS]
    for r in rows:
        weights[r.f][r.v] = round(log((r.yes + 1) / (yes + 2)) - log((r.no + 1) / (no + 2)), 6)
    return SpanClassifier(round(odds, 6), tuple(map(tuple, weights)))


def added_spans(text: Column, base: Column, model: SpanClassifier, threshold: float) -> Column:
    """Accepted candidates that touch no base span."""
    least = log(threshold / (1 - threshold))
    taken = F.filter(found(text, CANDIDATE, "[0-9]"), lambda x: (model.log_odds(x.m, x.before) >= least) & ~F.exists(base, lambda b: (b.start < x.end) & (x.start < b.end)))
    return F.transform(taken, lambda x: F.struct(x.start.alias("start"), F.when(x.m.rlike("[A-Za-z]"), KINDS.index("secret")).otherwise(KINDS.index("id")).alias("kind"), x.end.alias("end")))


def find_pii(docs: DataFrame, text: str = "text", threshold: float = 0.9, model: SpanClassifier | None = None) -> DataFrame:
    """``docs`` with ``base_spans`` and ``all_spans`` (``start, kind, end``; kind
    numbers as in ``KINDS``), both sorted."""
    model = model or fit(docs, text)
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def both(base: Column) -> Column:
        return F.struct(base.alias("b"), F.sort_array(F.concat(base, added_spans(t, base, model, threshold))).alias("a"))

    rest = [c for c in docs.columns if c not in ("base_spans", "all_spans")]
    return docs.select(*rest, F.inline(F.array(let(base_spans(t), both))).alias("base_spans", "all_spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x.kind), x.start, x.end)), ",")


def masked(text: Column, spans: Column, block: int = 1024) -> Column:
    """``text`` with every span replaced by its kind in brackets.

    Spans that overlap are masked as one, from the first one's start to the furthest end,
    under the first one's kind.  The text is cut into blocks first, so a piece costs its
    own length and not its distance from the start.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def cut(blocks: Column, a: Column, b: Column) -> Column:
        first, last = F.floor(a / block).cast("int"), F.floor(b / block).cast("int")
        head = F.substring(F.get(blocks, first), (a % block + 1).cast("int"), F.lit(block))
        middle = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        tail = F.coalesce(F.substring(F.get(blocks, last), F.lit(1), (b % block).cast("int")), F.lit(""))
        one = F.substring(F.get(blocks, first), (a % block + 1).cast("int"), (b - a).cast("int"))
        return F.when(b <= a, F.lit("")).when(first == last, one).otherwise(F.concat(head, middle, tail))

    def pieces(blocks: Column) -> Column:
        def apart(s: Column) -> Column:  # furthest end so far, by the same doubling as in found()
            ends = F.transform(s, lambda x: x.end)
            rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(s))).cast("int"))
            far = F.aggregate(rounds, ends, lambda e, r: F.transform(e, lambda x, i: F.greatest(x, F.coalesce(F.get(e, i - F.pow(F.lit(2), r).cast("int")), F.lit(0)))))
            after = lambda f: F.transform(s, lambda x, i: F.struct(x.start.alias("start"), x.kind.alias("kind"), F.coalesce(F.get(f, i - 1), F.lit(0).cast("long")).alias("at")))
            return let(far, lambda f: F.filter(after(f), lambda x: x.start >= x.at))

        def joined(s: Column) -> Column:  # ``at``: the furthest end of all spans before
            body = F.transform(s, lambda x: F.concat(cut(blocks, x.at, x.start), F.get(names, x.kind)))
            return F.concat(F.array_join(body, ""), cut(blocks, F.array_max(F.transform(spans, lambda x: x.end)), F.length(text).cast("long")))

        return let(apart(spans), joined)

    return F.when(F.size(spans) == 0, text).otherwise(let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block}}}"), F.lit(0)), pieces))


def mask_texts(docs: DataFrame, text: str = "text", chars: str = "n_chars", threshold: float = 0.9) -> DataFrame:
    """``docs`` with spans masked in ``text``; ``chars``, where there is one, is its length.

    A null text stays null; a text without spans is returned as it is.
    """
    inside, back = shielded(docs, [text, chars])
    found = find_pii(inside, text, threshold)
    some = F.size("all_spans") > 0
    made = found.withColumn(text, F.when(some, masked(F.col(text), F.col("all_spans"))).otherwise(F.col(text)))
    if chars in docs.columns:
        made = made.withColumn(chars, F.when(some, F.length(text).cast(docs.schema[chars].dataType)).otherwise(F.col(chars)))
    return back(made)
