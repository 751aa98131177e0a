"""Quality rules: statistics of texts, and decision lists learnt from them.

Sequential covering: a rule is a conjunction of thresholds on statistics that
holds for low-quality texts.  It is grown one condition at a time by
information gain on two thirds of the labelled rows, pruned on the other
third, and kept if it is precise there; else the next best start is tried.  The
rows a rule covers leave, and the next rule is grown.  The list becomes one
conditional expression.

All work is done by DataFrame operations.  Labelled rows are counted by cells
of the thresholds' grid once; growing reads sums by start, statistic and cell
from Spark, a few thousand numbers at a time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored

# Fixed values of the base statistics.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent

STATISTICS = ["mean_word", "symbol_rate", "mark_rate", "upper_rate", "dup_line_rate", "repeat_rate", "variety", "n_words"]
CUTS = 32


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def _shifted(values: str, by: int, size: Column) -> Column:
    """Hashes of each value and the one ``by`` places on, ``size`` of them."""
    return F.zip_with(F.slice(values, F.lit(1), size), F.slice(values, F.lit(1 + by), size), lambda a, b: F.xxhash64(a, b))


def statistics(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, and the rates of ``STATISTICS`` (0.0 where undefined).

    Words are runs of anything but ASCII white space.  A NULL text is empty.
    Windows of eight words are compared by 64-bit hashes of hashes, inside the
    row, in n log n steps: nothing is shuffled.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(value, F.lit(SPACE))
    lines = F.filter(F.split(value, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    upper = "".join(chr(c) for c in range(65, 91))
    # each step names what the next one uses more than once
    df = df.select(
        F.col(key).alias("_key"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES)).alias("words"),
        lines.alias("lines"), _without(value, SPACE).cast("long").alias("word_chars"),
        (F.length(value) - _without(value, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(value) - _without(value, upper)).alias("uppers"), (F.length(value) - _without(value, "!?~")).alias("marks"))
    rest = ["_key", "word_chars", "n_symbols", "uppers", "marks"]
    df = df.select(*rest, F.size("lines").alias("n_lines"),
                   (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                   F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    rest += ["n_lines", "n_dup_lines"]
    df = df.select(*rest, F.size("h").alias("n"), F.size(F.array_distinct("h")).alias("n_different"), "h")
    rest += ["n", "n_different"]
    held = 1
    while held < WINDOW:
        size = F.greatest(F.col("n") - (2 * held - 1), F.lit(0))
        df = df.select(*rest, _shifted("h", held, size).alias("h"))
        held *= 2
    sorted_ = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    df = df.select(*rest, F.when(F.size(F.array_distinct("h")) < F.size("h"), sorted_).alias("s"))
    m = F.size("s") - 1
    neighbours = F.zip_with(F.slice("s", F.lit(1), m), F.slice("s", F.lit(2), m),
                            lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])))
    found = F.sort_array(F.array_distinct(F.flatten(F.filter(neighbours, lambda p: p.isNotNull()))))
    df = df.select(*rest, F.when(F.col("s").isNotNull(), found).alias("p"))
    k = F.size("p") - 1
    gaps = F.zip_with(F.slice("p", F.lit(1), k), F.slice("p", F.lit(2), k), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap)
    df = df.select(*rest, F.when(F.col("p").isNotNull(), covered).otherwise(0).cast("long").alias("n_repeat_words"))

    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return df.select(
        F.col("_key").alias(key), F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rate("word_chars", "n").alias("mean_word"), rate("n_symbols", "n").alias("symbol_rate"), rate("marks", "n").alias("mark_rate"),
        rate("uppers", "word_chars").alias("upper_rate"), rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("n_repeat_words", "n").alias("repeat_rate"), rate("n_different", "n").alias("variety"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``statistic`` above the cut, or at most the cut."""

    statistic: str
    above: bool
    cut: float
    cell: int  # position of the cut

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c > F.lit(self.cut) if self.above else c <= F.lit(self.cut)

    def cells(self) -> Column:
        c = F.col(f"_{self.statistic}")
        return c > self.cell if self.above else c <= self.cell

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule, cells: bool) -> Column:
    result = F.lit(True)
    for c in rule:
        result = result & (c.cells() if cells else c.column())
    return result


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: false for the first rule
    that holds, else true."""
    result = None
    for rule in rules:
        result = (F if result is None else result).when(_holds(rule, cells=False), F.lit(False))
    return F.lit(True) if result is None else result.otherwise(True)


def _cell(statistic: str, points: list[float]) -> Column:
    """Number of cuts below a value."""
    return F.size(F.filter(F.array(*map(F.lit, points)), lambda x: x < F.col(statistic)))


def _sums(cells: DataFrame, rules: list[Rule], cuts: dict[str, list[float]]) -> list[dict[tuple[str, int], tuple[int, int]]]:
    """For each rule, low and other rows it covers at or below each cut, by
    statistic and cut: all from one pass."""
    covering = F.filter(F.array(*[F.when(_holds(rule, cells=True), F.lit(i)) for i, rule in enumerate(rules)]), lambda i: i.isNotNull())
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"_{s}").alias("c")) for s in cuts]))
    rows = cells.withColumn("r", F.explode(covering)).select("r", pairs.alias("p"), "low", "n").groupBy("r", "p.s", "p.c").agg(
        F.sum(F.col("low") * F.col("n")).alias("low"), F.sum("n").alias("n")).collect()  # a row for each rule, statistic and cell
    by = {(x["r"], x["s"], x["c"]): x for x in rows}
    found = []
    for i in range(len(rules)):
        sums = {}
        for s, points in cuts.items():
            low = n = 0
            for c in range(len(points) + 1):
                if (i, s, c) in by:
                    low, n = low + by[i, s, c]["low"], n + by[i, s, c]["n"]
                sums[s, c] = (low, n - low)
        found.append(sums)
    return found


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _choices(sums: dict[tuple[str, int], tuple[int, int]], cuts: dict[str, list[float]]) -> list[tuple[float, Condition]]:
    """The best cut of each statistic and direction that gains anything, by
    falling gain."""
    total = sums[STATISTICS[0], len(cuts[STATISTICS[0]])]
    if not total[0] or not total[1]:
        return []
    found = []
    for s, points in cuts.items():
        for above in (False, True):
            gains = []
            for c in range(len(points)):
                p, n = sums[s, c]
                gains.append((_gain(total[0] - p, total[1] - n, *total) if above else _gain(p, n, *total), -c))
            gain, c = max(gains)
            if gain > 1e-9:
                found.append((gain, Condition(s, above, points[-c], -c)))
    return sorted(found, key=lambda x: (x[0], x[1].statistic, x[1].above), reverse=True)


def learn(labelled: DataFrame, key: str, low: str, most_rules: int = 16, most_conditions: int = 3, precision: float = 0.95,
          least_rows: int = 8) -> list[Rule]:
    """Rules for rows with the statistics and ``low`` (1: of low quality, 0: not;
    NULL: left out).  Without rows of both kinds there is no rule.

    A rule is grown from the best cut of each statistic and direction, all of
    them in the same passes.  It is taken if it has ``precision`` and
    ``least_rows`` low rows among those it was not grown on; if it has not, the
    rule of the next best start is judged.  The list ends when no start gives a
    rule that passes, or at ``most_rules``."""
    rows = labelled.where(F.col(low).isNotNull()).select(key, F.col(low).cast("int").alias("low"), *STATISTICS)
    spots = [i / CUTS for i in range(CUTS + 1)]
    # cuts are taken from low rows and from others: what tells them apart may be rare in all
    found = rows.groupBy("low").agg(*[F.percentile_approx(s, spots, 2000).alias(s) for s in STATISTICS]).collect()
    if len(found) < 2:
        return []
    cuts = {s: sorted({float(x) for r in found for x in r[s]}) for s in STATISTICS}
    binned = [_cell(s, points).alias(f"_{s}") for s, points in cuts.items()]
    grown = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3, F.lit(1)) != 0
    names = [f"_{s}" for s in STATISTICS]
    cells = stored(rows.select("low", grown.alias("grow"), *binned).groupBy("low", "grow", *names).agg(F.count("*").alias("n")), "cells")
    rules: list[Rule] = []
    while len(rules) < most_rules:
        left = cells
        for rule in rules:
            left = left.where(~_holds(rule, cells=True))
        starts = _choices(_sums(left.where("grow"), [()], cuts)[0], cuts)
        tried: list[Rule] = [(condition,) for _, condition in starts]
        growing = set(range(len(tried)))
        for _ in range(most_conditions - 1):
            if not growing:
                break
            order = sorted(growing)
            for i, sums in zip(order, _sums(left.where("grow"), [tried[i] for i in order], cuts), strict=True):
                more = _choices(sums, cuts)
                if more:
                    tried[i] += (more[0][1],)
                else:
                    growing.remove(i)
        rule = _best(left.where("not grow"), tried, precision, least_rows)
        if rule is None:
            break
        rules.append(rule)
    return rules


def _best(others: DataFrame, tried: list[Rule], precision: float, least_rows: int) -> Rule | None:
    """The first rule that passes on rows it was not grown on, cut to its best
    beginning.  All beginnings of all rules are judged in one pass."""
    if not tried:
        return None
    sums = [F.sum(F.when(_holds(rule[:k], cells=True), F.col(c) * F.col("n")).otherwise(0)).alias(f"{c}{i}_{k}")
            for i, rule in enumerate(tried) for k in range(1, len(rule) + 1) for c in ("low", "other")]
    judged = others.withColumn("other", 1 - F.col("low")).agg(*sums).first()
    for i, rule in enumerate(tried):
        best = max(range(1, len(rule) + 1), key=lambda k: (_value(judged[f"low{i}_{k}"], judged[f"other{i}_{k}"]), -k))
        p, n = judged[f"low{i}_{best}"] or 0, judged[f"other{i}_{best}"] or 0
        if p >= least_rows and p >= precision * (p + n):
            return rule[:best]
    return None


def _value(p: int | None, n: int | None) -> float:
    p, n = p or 0, n or 0
    return (p - n) / (p + n) if p + n else -1.0


def judge(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality") -> tuple[DataFrame, list[Rule]]:
    """Statistics of every row with ``base_failed`` and ``kept``, and the rules
    learnt from the labelled rows that do not fail the base rules (``quality``
    0: low).  Rows with equal keys are judged each for itself; labels of a key
    that occurs several times count once for each pair."""
    rows = stored(statistics(df, key, text).withColumn("base_failed", base_failed()), "statistics")
    known = labels.select(F.col(key).alias("_id"), (1 - F.col(quality).cast("int")).alias("low")).dropna()
    labelled = rows.where(~F.col("base_failed")).join(known, rows[key] == known["_id"]).where("low in (0, 1)")
    rules = learn(labelled, key, "low")
    return rows.withColumn("kept", ~F.col("base_failed") & verdict(rules)), rules
