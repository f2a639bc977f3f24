"""Quality rules: a decision list learned from labelled statistics, applied as Spark expressions.

Everything runs as DataFrame or SQL functions. Statistics come from one pass over each text without a
shuffle. The list grows by sequential covering: each step counts, for every statistic and every threshold
bin, the labelled rows still covered (one small aggregation), and the driver sees only these histograms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestep.llm.common import SPACES, let, stored, words

#: Statistics a rule may test, as expressions over the counted columns; a share of nothing is NULL, also where Spark raises on a division by zero.
MEASURES = {
    "n_words": "double(n_words)",
    "mean_word_length": "try_divide(word_chars, n_words)",
    "symbol_share": "try_divide(n_symbols, word_chars)",
    "duplicate_line_share": "try_divide(n_dup_lines, n_lines)",
    "repeated_word_share": "try_divide(n_repeat_words, n_words)",
    "distinct_word_share": "try_divide(n_distinct_words, n_words)",
    "upper_share": "try_divide(n_upper, word_chars)",
    "mark_share": "try_divide(n_marks, word_chars)",
}
#: Thresholds tried for each measure, at even steps of its distribution in each class.
STEPS = 40
MAX_LITERALS, MAX_RULES = 3, 12
#: A rule must be this precise on rows it was not grown on, and reject this many of them.
MIN_PRECISION, MIN_COVER = 0.95, 5


def _repeat_words(tokens: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the array."""
    windows = F.transform(F.sequence(F.lit(0), F.size(tokens) - 3),
                          lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))

    def covered(marks: Column) -> Column:
        # (window, place) in order: a window repeats where a neighbour has the same hash
        repeated = F.filter(marks, lambda m, i: (F.get(marks, i - 1)["w"] == m["w"]) | (F.get(marks, i + 1)["w"] == m["w"]))
        places = F.sort_array(F.transform(repeated, lambda m: m["i"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x))

    counted = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(
        let(F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("w"), i.alias("i")))), covered)))
    return F.when(F.size(tokens) < 3, 0).otherwise(counted).cast("long")


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts for each row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_distinct_words, n_upper, n_marks (all long).

    A NULL or empty text counts zero everywhere. Repeated rows give repeated rows, an empty table none. Other
    columns are not looked at.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACES}]"))
    left = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
    counted = let(words(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words")))
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return docs.select(
        F.col(doc_id).alias("doc_id"), counted.alias("w"), by_line.alias("l"), left(f"[{SPACES}]+").cast("long").alias("word_chars"),
        left(r"[^#*$%&|<>]+").cast("long").alias("n_symbols"), left("[^A-Z]+").cast("long").alias("n_upper"),
        left("[^!?;:]+").cast("long").alias("n_marks"),
    ).select("doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "w.n_distinct_words",
             "n_upper", "n_marks")


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


@dataclass(frozen=True)
class Literal:
    measure: str
    above: bool  # measure >= threshold, else measure < threshold
    threshold: float

    def column(self) -> Column:
        value = F.expr(MEASURES[self.measure])
        return F.coalesce(value >= self.threshold if self.above else value < self.threshold, F.lit(False))

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.above else '<'} {self.threshold:.6g}"


def _holds(rule: list[Literal]) -> Column:
    out = F.lit(True)
    for literal in rule:
        out = out & literal.column()
    return out


def _counts(rows: DataFrame, prefixes: list[Column]) -> list[tuple[int, int]]:
    """Rejected and accepted labelled rows for each condition."""
    one = lambda ok: F.coalesce(F.sum(F.when(ok, 1).otherwise(0)), F.lit(0))
    cells = [x for p in prefixes for x in (one(p & F.col("bad")), one(p & ~F.col("bad")))]
    row = rows.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(prefixes))]


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds of each measure: quantiles within each class."""
    shares = F.array(*[F.lit(i / STEPS) for i in range(1, STEPS)])
    row = rows.agg(*[F.percentile_approx(F.when(F.col("bad") == side, F.col(m)), shares, F.lit(10000)).alias(f"{m}_{side}")
                     for m in MEASURES for side in (True, False)]).first()
    return {m: sorted({x for side in (True, False) for x in row[f"{m}_{side}"] or []}) for m in MEASURES}


def _bin(measure: str, cuts: list[float]) -> Column:
    """How many of ``cuts`` the measure reaches; NULL where it has no value."""
    reached = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(measure))) if cuts else F.lit(0)
    return F.when(F.col(measure).isNotNull(), reached)


def _best(rows: DataFrame, cuts: dict[str, list[float]], have: tuple[int, int]) -> tuple[Literal, tuple[int, int]] | None:
    """The literal with the largest information gain on the rows a rule still covers."""
    from math import log2

    found = (rows.select("bad", F.posexplode("bins").alias("measure", "bin")).filter("bin IS NOT NULL").groupBy("measure", "bin")
             .agg(F.sum(F.col("bad").cast("long")).alias("p"), F.sum((~F.col("bad")).cast("long")).alias("n")).collect())
    best, gain = None, 0.0
    base = log2(have[0] / (have[0] + have[1]))
    for place, m in enumerate(MEASURES):
        cells = {r["bin"]: (r["p"], r["n"]) for r in found if r["measure"] == place}
        all_p, all_n = sum(p for p, _ in cells.values()), sum(n for _, n in cells.values())
        for k, cut in enumerate(cuts[m], 1):  # a row in bin k or above is >= cut
            p = sum(c[0] for b, c in cells.items() if b >= k)
            n = sum(c[1] for b, c in cells.items() if b >= k)
            for above, got in ((True, (p, n)), (False, (all_p - p, all_n - n))):
                if got[0] and (g := got[0] * (log2(got[0] / sum(got)) - base)) > gain + 1e-9:
                    best, gain = (Literal(m, above, cut), got), g
    return best


def learn(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> list[list[Literal]]:
    """Ordered rules, each a conjunction of thresholds, that reject documents like those labelled 0.

    Learns from every labelled row the base rules pass: two thirds (by a checksum of the id) grow rules, one third
    prunes them and decides whether a rule is precise enough. Contradictory labels of one id count as 1; NULL
    labels are left out; without labels of both kinds the list is empty.
    """
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg((F.max(label) == 0).alias("bad"))
    measures = [F.expr(e).cast("double").alias(m) for m, e in MEASURES.items()]
    counts = [c for c in stats.columns if c != "doc_id" and c not in MEASURES]
    rows = stored(stats.filter(~base_failed()).join(known, "doc_id")
                  .select("bad", *counts, *measures, (F.crc32(F.col("doc_id").cast("string")) % 3 == 0).alias("prune")), "labelled")
    cuts = _cuts(rows.filter("NOT prune"))
    rows = stored(rows.withColumn("bins", F.array(*[_bin(m, cuts[m]) for m in MEASURES])), "binned")
    rules: list[list[Literal]] = []
    left = F.lit(True)
    while len(rules) < MAX_RULES:
        rest = rows.filter(left)
        rule, have = [], _counts(rest.filter("NOT prune"), [F.lit(True)])[0]
        while len(rule) < MAX_LITERALS and have[0] and have[1]:
            step = _best(rest.filter("NOT prune").filter(_holds(rule)), cuts, have)
            if step is None:
                break
            rule, have = [*rule, step[0]], step[1]
        if not rule:
            break
        held = _counts(rest.filter("prune"), [_holds(rule[:k]) for k in range(1, len(rule) + 1)])
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in held]
        size = max(range(len(rule)), key=lambda k: (worth[k], -k))
        p, n = held[size]
        if p < MIN_COVER or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule[: size + 1])
        left = left & ~_holds(rules[-1])
    return rules


def rule_number(rules: list[list[Literal]]) -> Column:
    """The ordered conditional expression: number of the first rule that rejects a row, 0 where none does."""
    out = None
    for number, rule in enumerate(rules, 1):
        out = F.when(_holds(rule), number) if out is None else out.when(_holds(rule), number)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics and verdict for each row: base_failed, rule (0: none) and kept. Learning runs when this is called."""
    stats = stored(statistics(docs, doc_id, text), "statistics")
    rules = learn(stats, labels, doc_id)
    return (stats.withColumn("base_failed", base_failed()).withColumn("rule", rule_number(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
