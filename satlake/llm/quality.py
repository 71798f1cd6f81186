"""Quality by weak supervision: rules vote good or bad or abstain, EM weighs them.

Each rule says bad (-1), good (1) or nothing (0) about a document.  Documents
are taken to be good or poor in one of several ways, one suspected way per rule,
since a document that is poor in one way may look fine to all other rules.
Votes are counted per pattern, of which there are at most 3^rules however many
documents there are; expectation-maximisation over the counts estimates how
often each rule says bad about each kind, and with it the probability that a
document is good.  Nothing has to pass all rules.  All of it is DataFrame
operators; the driver sees one row of sums per kind and round.

Defined results: null and empty texts have no words and fail the base rules; a
rule whose measure has no basis abstains; repeated rows vote again; an empty
table gives the prior model and no rows.  Names of other columns may clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlake.llm.common import BLANKS, WORD, once, staged

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

#: Rounds of EM and the probability from which a document is kept.
ROUNDS = 12
KEEP_FROM = 0.5
#: What is believed before any vote: the share of good documents, and how often a rule says
#: bad about good documents, its own kind and other kinds.  It weighs as much as this share of
#: the documents.
PRIOR_GOOD = 0.85
BAD_IF_GOOD = 0.002
BAD_IF_OWN = 0.9
BAD_IF_OTHER = 0.05
STRENGTH = 0.02


@dataclass(frozen=True)
class Rule:
    """Votes on 100 x a measure / its base: bad outside one range, good inside another."""

    name: str
    measure: str
    base: str
    good: tuple[float, float]
    fine: tuple[float, float]

    def vote(self) -> Column:
        share, base = F.col(self.measure) * 100, F.col(self.base)
        outside = (share < base * self.fine[0]) | (share > base * self.fine[1])
        inside = (share >= base * self.good[0]) & (share <= base * self.good[1])
        return F.when(base <= 0, 0).when(outside, -1).when(inside, 1).otherwise(0).cast("int")


ANY = 1e12

RULES = (
    Rule("length", "n_words", "one", (3000, ANY), (1000, ANY)),
    Rule("symbols", "n_symbols", "n_words", (0, 2), (0, 10)),
    Rule("exclamations", "n_exclamations", "n_words", (0, 2), (0, 10)),
    Rule("capitals", "n_capitals", "word_chars", (0, 10), (0, 30)),
    Rule("word_length", "word_chars", "n_words", (300, 700), (200, 1200)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", (0, 25), (0, 50)),
    Rule("repeated_words", "n_repeat_words", "n_words", (0, 10), (0, 20)),
    Rule("full_stops", "n_stops", "n_words", (1, 50), (0.1, ANY)),
)


# Signs that end a sentence, in scripts that have their own.
STOPS = "[.。｡।॥۔։។]"


def _count_of(character: str, text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_exclamations",
    "n_capitals",
    "n_stops",
)


def measured(docs: DataFrame) -> DataFrame:
    """All columns and ``q``, a struct of the measures as longs; texts are read whole."""
    out = docs.withColumn("__text", F.coalesce("text", F.lit("")))
    out = out.withColumn("__words", F.array_remove(F.split("__text", BLANKS, -1), ""))
    out = out.withColumn("__lines", F.filter(F.split("__text", "\n", -1), lambda line: line.rlike(WORD)))
    n = F.size("__words")
    hashed = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(WINDOW)]),
    )
    out = out.withColumn("__windows", F.when(n >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>")))
    # Only texts with an equal pair of windows need them sorted.
    paired = F.size("__windows") > F.size(F.array_distinct("__windows"))
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__placed", F.when(paired, placed))

    def met_again(one: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get("__placed", k - 1)["h"])
        return one["h"].eqNullSafe(before) | one["h"].eqNullSafe(F.get("__placed", k + 1)["h"])

    places = F.sort_array(F.transform(F.filter("__placed", met_again), lambda one: one["i"]))
    out = out.withColumn("__places", F.coalesce(places, F.array().cast("array<int>")))
    # A window adds the words up to the next one, WINDOW at most.
    covered = F.aggregate(
        F.transform(
            "__places",
            lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__places", k + 1) - at, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, more: total + more,
    )
    values = {
        "n_words": n,
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": F.regexp_count("__text", F.lit(SYMBOLS)),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": covered,
        "n_lines": F.size("__lines"),
        "n_exclamations": _count_of("!", F.col("__text")),
        "n_capitals": F.regexp_count("__text", F.lit("[A-Z]")),
        "n_stops": F.regexp_count("__text", F.lit(STOPS)),
    }
    q = F.struct(*[values[m].cast("bigint").alias(m) for m in MEASURES])
    return out.select(*[f"`{c}`" for c in docs.columns], once(q, "__q"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Model:
    """Per kind (good first, then one poor kind per rule): its share, and how often each rule says bad."""

    shares: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]

    def accuracies(self) -> tuple[float, ...]:
        """How often each rule, when it votes, is right."""
        return tuple(
            self.shares[0] * (1 - self.bad[0][i]) + sum(w * b[i] for w, b in zip(self.shares[1:], self.bad[1:]))
            for i in range(len(RULES))
        )

    def weights(self, votes: list[str]) -> list[str]:
        """SQL of the votes' likelihood with each kind; who abstains says nothing."""
        out = []
        for share, rates in zip(self.shares, self.bad):
            terms = [f"({math.log(share)!r}D)"]
            for vote, rate in zip(votes, rates):
                terms.append(f"CASE {vote} WHEN -1 THEN {math.log(rate)!r}D WHEN 1 THEN {math.log(1 - rate)!r}D ELSE 0D END")
            out.append(f"exp({' + '.join(terms)})")
        return out

    def probability(self, votes: list[str]) -> Column:
        """Of being good, given the votes."""
        weights = self.weights(votes)
        return F.expr(f"({weights[0]}) / ({' + '.join(weights)})")


def _believed() -> Model:
    n = len(RULES)
    kinds = tuple(tuple(BAD_IF_OWN if i == j else BAD_IF_OTHER for i in range(n)) for j in range(n))
    return Model((PRIOR_GOOD,) + ((1 - PRIOR_GOOD) / n,) * n, ((BAD_IF_GOOD,) * n, *kinds))


START = _believed()


def votes(measures: DataFrame) -> DataFrame:
    """Add one column ``vote_<rule>`` per rule to the measures."""
    one = measures.withColumn("one", F.lit(1))
    return one.select("*", *[rule.vote().alias(f"vote_{rule.name}") for rule in RULES]).drop("one")


def fit(voted: DataFrame, rounds: int = ROUNDS) -> Model:
    """EM over the counts of vote patterns."""
    names = [f"vote_{rule.name}" for rule in RULES]
    said = [F.col(v) for v in names]
    patterns = staged(voted.groupBy(*names).count(), "vote-patterns")
    total = patterns.agg(F.sum("count")).first()[0]
    model = START
    if not total:
        return model
    sums = [F.sum("mass").alias("mass")]
    for i, vote in enumerate(said):
        sums.append(F.sum(F.when(vote == -1, F.col("mass")).otherwise(0.0)).alias(f"bad{i}"))
        sums.append(F.sum(F.when(vote != 0, F.col("mass")).otherwise(0.0)).alias(f"said{i}"))
    for _ in range(rounds):
        weighed = patterns.select(*names, "count", F.expr(f"array({', '.join(model.weights(names))})").alias("weights"))
        whole = F.aggregate("weights", F.lit(0.0), lambda a, b: a + b)
        rows = (
            weighed.select(*names, "count", whole.alias("whole"), F.posexplode("weights").alias("kind", "weight"))
            .withColumn("mass", F.col("count") * F.col("weight") / F.col("whole"))
            .groupBy("kind")
            .agg(*sums)
            .orderBy("kind")
            .collect()
        )
        shares, bad = [], []
        for row, share, rates in zip(rows, START.shares, START.bad):
            believed = STRENGTH * total * share
            shares.append((row["mass"] + believed) / (total + STRENGTH * total))
            bad.append(
                tuple((row[f"bad{i}"] + believed * rate) / (row[f"said{i}"] + believed) for i, rate in enumerate(rates))
            )
        model = Model(tuple(shares), tuple(bad))
    return model


def judged(voted: DataFrame, model: Model) -> DataFrame:
    """Add base_failed, probability and kept."""
    probability = model.probability([f"vote_{rule.name}" for rule in RULES])
    return (
        voted.withColumn("base_failed", base_failed())
        .withColumn("probability", probability)
        .withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= KEEP_FROM))
    )


def assess(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measures, votes, base_failed, probability, kept."""
    voted = staged(votes(measured(docs.select("doc_id", "text")).select("doc_id", "__q.*")), "votes")
    return judged(voted, fit(voted))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns.

    Every text is measured once: its row is written with its votes, from which
    the model is fitted and the rows are chosen.  No unique id is needed and no
    text is shuffled.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text"))
    voted = votes(measured(whole).select("__row", "__q.*"))
    needed = ["__row", "n_words", "n_repeat_words", *[f"vote_{rule.name}" for rule in RULES]]
    voted = staged(voted.select(*needed), "voted-rows")
    return judged(voted, fit(voted)).where("kept").select("__row.*")
