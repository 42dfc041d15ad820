"""Quality rules: a decision list learned by sequential covering, emitted as conditional expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import let, stored, whole_row, whole_text

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: How the list is learned.
CUTS = 24  # thresholds tried per feature
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.95  # of a rule, on rows that it was not grown on
LEAST_COVERED = 3  # rejected rows that a rule must find among those
SLACK = 0.005  # gain given up for distance from both kinds of rows
PRUNING_SHARE = 3  # one row in so many is kept for pruning

FEATURES = (
    "n_words",
    "chars_per_word",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "capitals_share",
    "digits_share",
    "shouts_per_word",
    "stops_per_word",
)


def repeated_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that are found twice or more, the first find included.

    Windows are told apart by 64-bit hashes of their words' hashes. Only texts with a repeated
    window are sorted; positions are then merged in one pass, so the cost is that of a sort.
    """

    def of_windows(windows: Column) -> Column:
        def of_sorted(ordered: Column) -> Column:
            def shared(x, k):
                before = F.when(k > 0, F.get(ordered, k - 1)["h"] == x["h"])
                after = F.get(ordered, k + 1)["h"] == x["h"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            starts = F.sort_array(F.transform(F.filter(ordered, shared), lambda x: x["i"]))
            zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
            return F.aggregate(
                starts,
                zero,
                lambda a, i: F.struct(
                    (a["words"] + i + WINDOW - F.greatest(i, a["end"])).alias("words"), (i + WINDOW).alias("end")
                ),
                lambda a: a["words"],
            )

        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(ordered, of_sorted)).otherwise(0)

    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))),
        )
        return let(windows, of_windows)

    several = F.size(words) > WINDOW
    return F.when(several, let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)).otherwise(0).cast("long")


def measures() -> Column:
    """All counts over the whole text as one struct; null and empty texts have none of anything."""
    text = whole_text()
    pieces = F.split(text, r"[\x20\x09-\x0D]")

    def counted(p: Column) -> Column:
        def of_words(w: Column) -> Column:
            return F.struct(
                F.size(w).cast("long").alias("n_words"),
                (F.length(text) - F.size(p) + 1).cast("long").alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
            )

        return let(F.array_remove(p, ""), of_words)

    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    return F.struct(
        let(pieces, counted).alias("words"),
        let(lines, of_lines).alias("lines"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        count(r"[A-Z]").alias("n_capitals"),
        count(r"[0-9]").alias("n_digits"),
        count(r"!").alias("n_shouts"),
        count(r"[.?]").alias("n_stops"),
    )


def with_measures(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column ``name``: the counts, the learner's features, base_failed."""
    raw = docs.withColumn(name, measures())
    m = F.col(name)
    n_words, repeats = m["words"]["n_words"], m["words"]["n_repeat_words"]

    def per(count: Column, whole: Column) -> Column:
        return F.when(whole > 0, count / whole).otherwise(F.lit(0.0))

    chars = m["words"]["word_chars"]
    return raw.withColumn(
        name,
        F.struct(
            n_words.alias("n_words"),
            chars.alias("word_chars"),
            m["n_symbols"].alias("n_symbols"),
            m["lines"]["n_dup_lines"].alias("n_dup_lines"),
            repeats.alias("n_repeat_words"),
            per(chars, n_words).alias("chars_per_word"),
            per(m["n_symbols"], n_words).alias("symbols_per_word"),
            per(m["lines"]["n_dup_lines"], m["lines"]["n_lines"]).alias("dup_line_share"),
            per(repeats, n_words).alias("repeat_share"),
            per(m["n_capitals"], chars).alias("capitals_share"),
            per(m["n_digits"], chars).alias("digits_share"),
            per(m["n_shouts"], n_words).alias("shouts_per_word"),
            per(m["n_stops"], n_words).alias("stops_per_word"),
            ((n_words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * n_words)).alias("base_failed"),
        ),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, of: Column) -> Column:
        value = of[self.feature].cast("double")
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def fits(rule: Rule, of: Column) -> Column:
    holds = F.lit(True)
    for condition in rule:
        holds &= condition.holds(of)
    return holds


def cut_points(labelled: DataFrame) -> dict[str, list[float]]:
    """Quantiles of each feature among kept and among rejected rows, and the middles between them."""
    shares = F.array(*(F.lit((k + 1) / (CUTS + 1)) for k in range(CUTS)))
    rejected = [
        F.percentile_approx(F.when(F.col("rejected") == r, F.col("m")[f].cast("double")), shares, 1000).alias(f"{f}_{r}")
        for f in FEATURES
        for r in (0, 1)
    ]
    found = labelled.agg(*rejected).first()
    cuts = {}
    for f in FEATURES:
        values = sorted({c for r in (0, 1) for c in found[f"{f}_{r}"] or ()})
        cuts[f] = sorted({*values, *((a + b) / 2 for a, b in zip(values, values[1:]))})
    return cuts


def binned(labelled: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Counts of labelled rows by their bins (one per feature), label and side (1: for pruning)."""
    bins = []
    for f in FEATURES:
        steps = [F.when(F.col("m")[f].cast("double") > c, 1).otherwise(0) for c in cuts[f]]
        bins.append(sum(steps, F.lit(0)).cast("int").alias(f))
    side = (F.pmod(F.xxhash64("doc_id"), F.lit(PRUNING_SHARE)) == 0).cast("int").alias("side")
    cube = labelled.select("rejected", side, *bins)
    return stored(cube.groupBy(*cube.columns).agg(F.count(F.lit(1)).alias("n")), "quality-cube")


def tallies(rows: DataFrame) -> dict:
    """{(side, feature, bin): [kept, rejected]}: a few hundred sums, whatever the number of rows."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("feature"), F.col(f).alias("bin")) for k, f in enumerate(FEATURES))))
    sums = (
        rows.select("side", "rejected", "n", each.alias("at"))
        .groupBy("side", "rejected", "at.feature", "at.bin")
        .agg(F.sum("n").alias("n"))
    )
    found: dict = {}
    for r in sums.collect():
        found.setdefault((r["side"], r["feature"], r["bin"]), [0, 0])[r["rejected"]] = r["n"]
    return found


def totals(tally: dict, side: int) -> tuple[int, int]:
    own = [v for (s, feature, _), v in tally.items() if s == side and feature == 0]
    return sum(v[0] for v in own), sum(v[1] for v in own)


def best_condition(tally: dict, cuts: dict[str, list[float]], but: frozenset = frozenset()):
    """(gain, feature, above, cut index) with the largest information gain for rejected rows.

    Of the cuts of that feature and side that are as good within SLACK, the middle one: a rule
    keeps its distance from both kinds of rows where nothing lies between. ``but``:
    (feature, above) that have been tried in vain.
    """
    kept, rejected = totals(tally, 0)
    if not rejected:
        return None
    before = math.log2(rejected / (rejected + kept))
    tried: dict[tuple[str, bool], list[tuple[float, int]]] = {}
    for k, f in enumerate(FEATURES):
        low = [0, 0]
        for c in range(len(cuts[f])):
            low = [a + b for a, b in zip(low, tally.get((0, k, c), (0, 0)))]
            for above, (n, p) in ((False, low), (True, (kept - low[0], rejected - low[1]))):
                if p and (f, above) not in but:
                    tried.setdefault((f, above), []).append((p * (math.log2(p / (p + n)) - before), c))
    if not tried:
        return None
    feature, above = max(tried, key=lambda t: max(tried[t])[0])
    best = max(gain for gain, _ in tried[feature, above])
    close = [(c, gain) for gain, c in tried[feature, above] if gain >= best * (1 - SLACK)]
    values = [cuts[feature][c] for c, _ in close]
    middle = (min(values) + max(values)) / 2
    c, gain = min(close, key=lambda t: (abs(cuts[feature][t[0]] - middle), -t[0] if above else t[0]))
    return gain, feature, above, c


def learn(labelled: DataFrame) -> list[Rule]:
    """Rules that reject, most telling first, from ``labelled`` (doc_id, rejected 0/1, m).

    Sequential covering: a conjunction is grown one threshold at a time by information gain
    over the rows no rule covers yet, cut back to the prefix that does best on the rows kept
    for pruning, and taken if it is precise there; else the next best first condition is tried,
    until none is left. All counts are sums over a stored table of binned rows; the driver sees
    some hundred of them per step. No labelled row, or none rejected, gives no rule.
    """
    cuts = cut_points(labelled)
    if not any(cuts.values()):
        return []
    rest = binned(labelled, cuts)
    rest_tally = tallies(rest)
    rules: list[Rule] = []
    vain: frozenset = frozenset()
    while True:
        inside, tally, grown, tried = rest, rest_tally, [], []
        while len(grown) < MOST_CONDITIONS:
            best = best_condition(tally, cuts, frozenset() if grown else vain)
            if best is None or best[0] <= 1e-9:
                break
            _, feature, above, c = best
            grown.append(Condition(feature, above, cuts[feature][c]))
            inside = inside.where(F.col(feature) > c if above else F.col(feature) <= c)
            tally = tallies(inside)
            n, p = totals(tally, 1)
            worth = (p - n) / (p + n) if p + n else -1.0
            tried.append((worth, -len(grown), p, n, tuple(grown)))
            if not totals(tally, 0)[0]:
                break
        if not tried:
            break
        _, _, p, n, rule = max(tried, key=lambda t: t[:2])
        if p < LEAST_COVERED or p < LEAST_PRECISION * (p + n):
            vain |= {(grown[0].feature, grown[0].above)}
            continue
        rules.append(rule)
        vain = frozenset()
        covered = F.lit(True)
        for condition in rule:
            c = cuts[condition.feature].index(condition.cut)
            covered &= F.col(condition.feature) > c if condition.above else F.col(condition.feature) <= c
        rest = rest.where(~covered)
        rest_tally = tallies(rest)
    return rules


def first_rule(rules: list[Rule], of: Column) -> Column:
    """The text of the first rule that fits, as one ordered conditional expression; else null."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(fits(rule, of), F.lit(" and ".join(map(str, rule)))).otherwise(found)
    return found


def labelled_measures(measured: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, rejected, m) of the labelled documents that pass the base rules."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    own = measured.select(F.col("doc_id").alias("id"), F.col(name).alias("m")).where(~F.col("m")["base_failed"])
    return own.join(known, own["id"] == known["doc_id"]).select(
        "doc_id", F.when(F.col("quality") > 0, 0).otherwise(1).alias("rejected"), "m"
    )


def verdict(of: Column, rule: Column) -> Column:
    return ~of["base_failed"] & rule.isNull()


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, five counts, base_failed, kept, rule) for every row of ``docs`` (doc_id, text, ...).

    ``labels`` (doc_id, quality) may be of any size; the list is learned from all labelled
    documents that pass the base rules. ``rule`` is the rule that rejects, else null. Null and
    empty texts have no words and fail the base rules. Repeated rows are judged alike, a null
    doc_id has no label, other columns are ignored, an empty table gives an empty one.
    """
    name = "measures"
    measured = stored(
        with_measures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), name).select("doc_id", name),
        "quality-measures",
    )
    rules = learn(labelled_measures(measured, labels, name))
    m = F.col(name)
    judged = measured.withColumn("rule", first_rule(rules, m))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *(m[c].alias(c) for c in counts), m["base_failed"].alias("base_failed"),
                         verdict(m, F.col("rule")).alias("kept"), "rule")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    What the list is learned from is stored without texts; the rows are then measured again where
    they are read, by what the rules ask for, so that no copy of them is written.
    """
    name = "measures"
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    labelled = labelled_measures(with_measures(rows.drop("row"), name), labels, name)
    rules = learn(stored(labelled, "quality-labelled"))
    return with_measures(rows, name).where(verdict(F.col(name), first_rule(rules, F.col(name)))).select("row.*")
