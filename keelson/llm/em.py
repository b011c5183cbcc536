"""Two-class weak supervision by expectation-maximisation, in SQL expressions.

Labelers vote +1, -1 or 0 (abstain).  All that EM needs of the rows is how many
of them show each vote pattern, so the corpus is read by one aggregation whose
result has at most ``3 ** m`` rows for ``m`` labelers, whatever the input.  The
iterations run as one higher-order ``aggregate`` over that single row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import let


@dataclass(frozen=True)
class VoteModel:
    """Log-odds of the prior, and per labeler of a +1 and of a -1 vote."""

    prior: float
    plus: tuple[float, ...]
    minus: tuple[float, ...]

    def log_odds(self, votes: list[Column]) -> Column:
        total = F.lit(self.prior)
        for v, p, m in zip(votes, self.plus, self.minus, strict=True):
            total = total + F.when(v == 1, F.lit(p)).when(v == -1, F.lit(m)).otherwise(F.lit(0.0))
        return total

    def posterior(self, votes: list[Column]) -> Column:
        return 1.0 / (1.0 + F.exp(-self.log_odds(votes)))


def _sum(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + value(x))


def fit_votes(votes: DataFrame, columns: list[str], rounds: int = 30, start: float = 0.85, smooth: float = 1.0) -> VoteModel:
    """Estimate the prior and each labeler's accuracy for both classes.

    ``votes`` has one row per item with the integer vote ``columns``.  Starting
    from labelers right with probability ``start``, each round computes every
    pattern's posterior, then re-estimates P(+1 | class, not abstaining) with
    ``smooth`` counts towards ``start``.  An accuracy never drops below one half: a
    labeler may prove useless but not reversed, which also keeps the classes
    from trading places.  An empty input gives the starting model.
    """
    m = len(columns)
    counted = votes.groupBy(*columns).count()
    packed = counted.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("v"), F.col("count").cast("double").alias("n"))
    rows = packed.agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("p"))

    def weights(pattern_q: Column) -> Column:
        """Prior log-odds, then per labeler the log-odds of +1 and of -1."""

        def of(j: int, sign: int) -> Column:
            def share(good: bool) -> Column:
                mass = lambda x: x.n * (x.q if good else 1.0 - x.q)
                hit = 1.0 if good else -1.0
                right = _sum(pattern_q, lambda x: F.when(x.v[j] == hit, mass(x)).otherwise(0.0))
                voted = _sum(pattern_q, lambda x: F.when(x.v[j] != 0.0, mass(x)).otherwise(0.0))
                return F.least(F.lit(0.999), F.greatest(F.lit(0.5), (right + smooth * start) / (voted + smooth)))

            a, b = share(True), share(False)
            return F.log(a / (1.0 - b)) if sign > 0 else F.log((1.0 - a) / b)

        good = _sum(pattern_q, lambda x: x.n * x.q)
        every = _sum(pattern_q, lambda x: x.n)
        prior = F.log((good + smooth) / (every - good + smooth))
        return F.array(prior, *[of(j, s) for j in range(m) for s in (1, -1)])

    def posterior(v: Column, w: Column) -> Column:
        s = w[0]
        for j in range(m):
            s = s + F.when(v[j] == 1.0, w[1 + 2 * j]).when(v[j] == -1.0, w[2 + 2 * j]).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-s))

    import math

    right, wrong = math.log(start / (1 - start)), math.log((1 - start) / start)
    first = F.array(F.lit(0.0), *[F.lit(x) for _ in range(m) for x in (right, wrong)])

    def step(w: Column, p: Column) -> Column:
        scored = F.transform(p, lambda x: F.struct(x.v.alias("v"), x.n.alias("n"), posterior(x.v, w).alias("q")))
        return let(scored, weights)

    fitted = rows.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, lambda w, _: step(w, F.col("p"))).alias("w")).first()
    w = fitted["w"]
    return VoteModel(w[0], tuple(w[1::2]), tuple(w[2::2]))
