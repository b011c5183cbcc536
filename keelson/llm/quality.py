"""Quality rules as weak supervision (built-in functions only).

Nine rules look at a whole text and vote good (+1), bad (-1) or abstain (0).
Expectation-maximisation over the vote patterns estimates how reliable each rule
is for good and for bad texts; a text is kept when its posterior probability
of being good reaches a threshold, so no single rule decides alone.  Two hard
limits (too few words, mostly repeated passages) stand before the vote.

Defined results: a null, empty or blank text has no words and fails the base;
repeated rows get equal verdicts, since a verdict depends on the text and the
corpus alone; other columns are carried untouched, and one that bears the
name of an output column is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import WORD, let, shielded, store, words
from keelson.llm.em import VoteModel, fit_votes

SYMBOLS = "#*$%&|<>"
RULES = ("symbols", "repeats", "shouting", "lines", "lengths", "endings", "function_words", "variety", "plain_words")
#: A word of letters, with a mark after it at most; and the end of a closed line.
PLAIN = r"(?<![^\x20\x09-\x0D])[\p{L}'’-]+[,.;:!?]?(?![^\x20\x09-\x0D])"
CLOSED = r"[.!?:;\"'»”]\s*$"
#: Frequent function words of the corpus languages.
FUNCTION_WORDS = ("the", "of", "and", "to", "in", "is", "der", "die", "und", "das", "ist", "le", "la", "les", "de", "et", "est", "el", "los", "en", "que", "y")


def repeated_words(w: Column, size: int = 3) -> Column:
    """Words lying in a window of ``size`` words that occurs twice or more.

    Windows are hashed.  Where some hash repeats, hashes are sorted with their
    places, equal neighbours are repeats, and the union of the marked windows is
    summed over their sorted places: n log n, also for a text that repeats itself
    throughout.
    """
    hashes = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, size)]))

    def union(places: Column) -> Column:
        gap = lambda p, k: F.least(F.lit(size), F.coalesce(F.get(places, k + 1) - p, F.lit(size)))
        return F.aggregate(F.transform(places, gap), F.lit(0), lambda a, x: a + x)

    def twice(s: Column) -> Column:
        marked = F.filter(s, lambda x, k: (x.h == F.get(s, k - 1).h) | (x.h == F.get(s, k + 1).h))
        return let(F.sort_array(F.transform(marked, lambda x: x.i)), union)

    def count(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(F.sort_array(placed), twice))

    return let(F.slice(hashes, 1, F.greatest(F.size(w) - (size - 1), F.lit(0))), count).cast("long")


def _measures(text: Column) -> Column:
    """One struct of all counts that the rules use."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    has = lambda xs, test: F.size(F.filter(xs, test)).cast("long")

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.length(F.regexp_replace(t, "[^A-Z!]+", "")).cast("long").alias("n_loud"),
            has(w, lambda x: x.isin(*FUNCTION_WORDS)).alias("n_function"),
            F.regexp_count(t, F.lit(PLAIN)).cast("long").alias("n_plain"),
        )

    def by_line(ls: Column) -> Column:
        return F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            has(ls, lambda x: x.rlike(CLOSED)).alias("n_ended"),
        )

    return F.struct(let(words(text), of).alias("w"), let(lines, by_line).alias("l"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``_q`` of counts.

    The struct leaves through a generator, so that neither a later filter nor
    a projection can pull the costly expressions apart and repeat them.
    """
    got = docs.select("*", F.inline(F.array(_measures(F.col(text)))).alias("_qw", "_ql"))
    return got.withColumn("_q", F.struct("_qw.*", "_ql.*")).drop("_qw", "_ql")


def votes(q: Column) -> list[Column]:
    """The rules in the order of ``RULES``: 1 good, -1 bad, 0 abstains."""
    n = F.greatest(q.n_words, F.lit(1))
    pick = lambda bad, good: F.when(bad, -1).when(good, 1).otherwise(0)
    mean = q.word_chars / n
    return [
        pick(10 * q.n_symbols > n, 100 * q.n_symbols <= n),
        pick(20 * q.n_repeat_words > 9 * n, 20 * q.n_repeat_words <= n),
        pick(2 * q.n_loud > n, 3 * q.n_loud <= n),
        pick(10 * q.n_dup_lines > 3 * q.n_lines, (q.n_dup_lines == 0) & (q.n_lines > 1)),
        pick((mean < 2.5) | (mean > 10), (mean >= 3.5) & (mean <= 7)),
        pick(10 * q.n_ended < 3 * q.n_lines, 10 * q.n_ended >= 9 * q.n_lines),
        pick(50 * q.n_function < n, 12 * q.n_function >= n),
        pick((5 * q.n_distinct < n) & (n < 1000), 5 * q.n_distinct >= 2 * n),
        pick(10 * q.n_plain < 6 * n, 10 * q.n_plain >= 9 * n),
    ]


def base_failed(q: Column, min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    return (q.n_words < min_words) | (100 * q.n_repeat_words > max_repeat_percent * q.n_words)


def fit(measured: DataFrame) -> VoteModel:
    """Rule reliabilities from all measured rows (3^9 vote patterns at most)."""
    return fit_votes(measured.select(*[v.alias(r) for r, v in zip(RULES, votes(F.col("_q")), strict=True)]), list(RULES))


def judge(measured: DataFrame, model: VoteModel, threshold: float = 0.5) -> DataFrame:
    """``measured`` with ``posterior``, ``base_failed`` and ``kept``."""
    q = F.col("_q")
    out = measured.withColumns({"posterior": model.posterior(votes(q)), "base_failed": base_failed(q)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def quality_rules(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with counts (``_q``), ``posterior``, ``base_failed`` and ``kept``.

    Texts are read twice, once to fit and once to judge, and are neither
    shuffled nor stored.
    """
    model = fit(measure(docs.select(F.col(text).alias("text"))))
    return judge(measure(docs, text), model, threshold)


def kept_rows(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the rules keep, as they are, whatever their columns' names.

    Measuring a text costs far more than storing it: rows are written once with their
    counts, from which the model is fitted and the verdict taken."""
    inside, back = shielded(docs, [text])
    measured = store(measure(inside, text), "quality-rows")
    return back(judge(measured, fit(measured), threshold).where("kept"))


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Counts and verdict per row without the text, which is read once."""
    slim = measure(docs.select(F.col(key).alias(key), F.col(text).alias("_t")), "_t").drop("_t")
    measured = store(slim, "quality")
    return judge(measured, fit(measured), threshold)
