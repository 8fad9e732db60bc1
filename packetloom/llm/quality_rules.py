"""Quality rules by weak supervision.

Each rule votes good, votes bad or abstains on a document. The accuracies of
the rules and the share of good documents are estimated from the votes alone
by expectation maximisation; a document is kept by its posterior probability.

Nulls and empty texts have no word and fail the base test. Repeated rows are
judged each. An empty table gives an empty result. Only the id and text columns
are read, so other columns cannot clash.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import GAP, settled, words

WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
ROUNDS = 50
#: Chance of each vote on a good and on a bad document to start from, and its
#: weight as a share of the rows.
START = {True: {1: 0.6, -1: 0.02, None: 0.38}, False: {1: 0.1, -1: 0.4, None: 0.5}}
PRIOR = 0.02
#: The share of good documents stays between these.
GOOD_SHARE = (0.05, 0.95)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts over the whole text of each document.

    A word counts as repeated if it lies in a window of five words found twice
    or more in the text. Windows are compared by 64-bit hash; the positions of
    the repeated ones are sorted, so the work is n log n in a text's words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    d = d.select("doc_id", "text", words(F.col("text")).alias("words"), lines.alias("lines"))
    n = F.size("words")
    window = F.transform(
        F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
    )
    # each list is named twice below it, so that it is computed once a row and
    # not once for each use of it inside a lambda
    d = d.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", GAP, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("text", r"[^A-Z]", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace("text", r"[^!?]", "")).cast("long").alias("n_shouts"),
        F.length(F.regexp_replace("text", r"[^\p{L}]", "")).cast("long").alias("n_letters"),
        window.alias("windows"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    order = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("order", F.when(repeats, order).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("windows")
    same = lambda a, b: F.get("order", a)["h"] == F.get("order", b)["h"]
    again = F.filter(
        F.transform("order", lambda x, i: F.when(
            F.coalesce(F.when(i > 0, same(i - 1, i)), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)), x["i"])),
        lambda x: x.isNotNull(),
    )
    d = d.withColumn("again", F.sort_array(again)).drop("order")
    covered = F.aggregate(
        F.transform("again", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("again", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x,
    )
    return d.withColumn("n_repeat_words", covered.cast("long")).drop("again")


def rule_votes() -> dict[str, Column]:
    """1 votes good, -1 votes bad, null abstains. Shares are per word, letter or line."""
    n, letters = F.col("n_words"), F.greatest(F.col("n_letters"), F.lit(1))

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1)

    mean = F.col("word_chars") / F.greatest(n, F.lit(1))
    symbols = F.col("n_symbols") / F.greatest(n, F.lit(1))
    shouts = F.col("n_shouts") / F.greatest(n, F.lit(1))
    capitals = F.col("n_capitals") / letters
    repeats = F.col("n_repeat_words") / F.greatest(n, F.lit(1))
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    copied = (lines > 0.2) & (F.col("n_dup_lines") >= 3)
    body = F.col("n_letters") / F.greatest(F.col("word_chars"), F.lit(1))
    # a rule that finds one kind of junk says nothing about texts without it
    plain = (symbols < 0.1) & (shouts < 0.1) & (capitals < 0.15) & (repeats < 0.1) & ~copied
    never = F.lit(False)
    return {
        "prose": vote(plain & (n >= MIN_WORDS), never),
        "letters": vote(body > 0.9, body < 0.8),
        "length": vote(n >= 40, n < MIN_WORDS),
        "word_length": vote(never, (mean < 2) | (mean > 14)),
        "symbols": vote(never, symbols > 0.3),
        "shouting": vote(never, shouts > 0.5),
        "capitals": vote(never, capitals > 0.4),
        "repeats": vote(never, repeats > 0.2),
        "lines": vote(never, copied),
    }


def estimate(patterns: list[tuple[tuple, int]], n_rules: int, rounds: int = ROUNDS):
    """Votes each rule casts on good and on bad documents, and the share of good ones.

    ``patterns`` holds each vector of votes that occurs with its count: at most
    3 ** n_rules of them, however many documents there are. A rule's accuracy
    is the chance of its right vote among the votes it casts. Returns the log
    odds that each vote (1, -1, None) of each rule is worth, the accuracies and
    the share.
    """
    chance = [{True: dict(START[True]), False: dict(START[False])} for _ in range(n_rules)]
    good = 0.8
    for _ in range(rounds):
        sums = [{y: {1: 1e-6, -1: 1e-6, None: 1e-6} for y in (True, False)} for _ in range(n_rules)]
        mass = total = 0.0
        worth = _worth(chance)
        for votes, count in patterns:
            p = posterior(votes, worth, good)
            mass, total = mass + p * count, total + count
            for j, v in enumerate(votes):
                sums[j][True][v] += p * count
                sums[j][False][v] += (1 - p) * count
        # the starting chances count as a small share of the rows, at any size
        for j in range(n_rules):
            for y in (True, False):
                n = sum(sums[j][y].values())
                held = PRIOR * n + 1e-3
                chance[j][y] = {v: (sums[j][y][v] + held * START[y][v]) / (n + held) for v in sums[j][y]}
        good = min(max(mass / total if total else good, GOOD_SHARE[0]), GOOD_SHARE[1])
    right = [(c[True][1] * good + c[False][-1] * (1 - good)) / (
        (c[True][1] + c[True][-1]) * good + (c[False][1] + c[False][-1]) * (1 - good)) for c in chance]
    return _worth(chance), right, good


def _worth(chance):
    out = []
    for c in chance:
        w = {v: math.log(c[True][v] / c[False][v]) for v in (1, -1, None)}
        # a vote never speaks against itself
        out.append({1: max(w[1], 0.0), -1: min(w[-1], 0.0), None: w[None]})
    return out


def posterior(votes, worth, good) -> float:
    x = math.log(good / (1 - good)) + sum(w[v] for v, w in zip(votes, worth, strict=True))
    return 1 / (1 + math.exp(-max(min(x, 500.0), -500.0)))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Measures, base test, posterior probability and verdict of each document.

    The texts are read once; the votes are counted from the written measures.
    """
    rules = rule_votes()
    m = settled(measures(docs, id_col, text_col), "quality-measures")
    voted = m.select("*", *[v.cast("int").alias(f"vote_{k}") for k, v in rules.items()])
    names = [f"vote_{k}" for k in rules]
    counted = voted.groupBy(*names).count().collect()
    worth, _, good = estimate([(tuple(r[k] for k in names), r["count"]) for r in counted], len(names))
    x = F.lit(math.log(good / (1 - good)))
    for k, w in zip(names, worth, strict=True):
        x = x + F.when(F.col(k) == 1, w[1]).when(F.col(k) == -1, w[-1]).otherwise(w[None])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return voted.withColumn("probability", 1 / (1 + F.exp(-x))).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= threshold))


def op1_quality_rules(spark, folder):
    from packetloom.llm.common import load

    return judge(load(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "probability", "n_lines", "n_capitals", "n_shouts", "n_letters")
