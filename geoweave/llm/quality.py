"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs the votes.

Counts of a text come from DataFrame expressions only. Each rule turns them into a vote: good,
bad, or none. The votes of all documents are grouped into patterns, of which there are at most
3^rules whatever the corpus. Expectation-maximisation over the patterns estimates the share of
good documents and of the kinds of bad ones, and how often each rule gives each vote to them. The
posterior probability of a document follows from sums of weights of its votes, again an expression.
A document is kept if it passes the base rules and its posterior is at least KEEP.

Narrow but for the grouping of the patterns, which are pre-aggregated; the counts become a table
in the shared folder, so that the texts are read once.

Defined results: a null text has no words; a text without words fails the base. Repeated rows are
judged each. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import saved

KEEP = 0.5
ROUNDS = 200
#: Start of the estimation: the share of good documents; how often a good document gets a bad vote,
#: as a part of how often any does; how often a bad one gets it from the rule for its kind; how often a
#: bad one gets a good vote, as a part of how often any does.
START_GOOD = 0.85
START_FALSE = 0.05
START_OWN = 0.9
START_PRAISED = 0.2
#: Documents that the start counts for, whatever the corpus.
PRIOR_ROWS = 5.0
_LEAST = 1e-4

MIN_WORDS = 50
_SPACE = " \t\n\x0b\x0c\r"
_SPACES = "[\\x20\\x09-\\x0D]+"
_SYMBOLS = "#*$%&|<>"


def counted(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and the counts that the rules read."""
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", "text", F.array_remove(F.split("text", _SPACES), "").alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, _SPACE, "") != "")
    # Windows of three words sort by their hash and then their place: equal ones become neighbours.
    windows = F.expr("transform(sequence(0, size(words) - 3), i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS i))")
    n_chars = F.length("text")
    without = lambda signs: n_chars - F.length(F.translate("text", signs, ""))
    rows = rows.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _SPACE, "")).cast("long").alias("word_chars"),
        without(_SYMBOLS).cast("long").alias("n_symbols"),
        without("|").cast("long").alias("n_bars"),
        without("!").cast("long").alias("n_shouts"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
        without("abcdefghijklmnopqrstuvwxyz").cast("long").alias("n_lower"),
        without("0123456789").cast("long").alias("n_digits"),
        without(".,;:?").cast("long").alias("n_stops"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        lines.alias("lines"),
        F.when(F.size("words") >= 3, F.sort_array(windows)).otherwise(F.expr("array()").cast("array<struct<h:bigint,i:int>>")).alias("windows"),
    )
    same = "filter(windows, (w, k) -> (k > 0 AND windows[k - 1].h = w.h) OR (k + 1 < size(windows) AND windows[k + 1].h = w.h))"
    rows = rows.withColumn("twice", F.expr(f"sort_array(transform({same}, w -> w.i))")).withColumn("n_lines", F.size("lines").cast("long"))
    covered = "aggregate(twice, struct(-3 AS last, 0 AS n), (a, i) -> struct(i AS last, a.n + least(3, i - a.last) AS n), a -> a.n)"
    return rows.withColumns({"n_dup_lines": (F.col("n_lines") - F.size(F.array_distinct("lines"))).cast("long"), "n_repeat_words": F.expr(covered).cast("long")}).drop("lines", "windows", "twice")


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` holds, else abstains. Both are SQL over the counts."""

    name: str
    bad: str
    good: str = "false"

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), F.lit(2)).when(F.expr(self.good), F.lit(1)).otherwise(F.lit(0)).alias(self.name)


#: Most rules know one kind of junk and are silent about the rest; three also know what prose looks like.
RULES = (
    Rule("symbols", "n_symbols > 0.05 * word_chars"),
    Rule("bars", "n_bars > 0.2 * n_words"),
    Rule("shouts", "n_shouts > 0.2 * n_words"),
    Rule("upper", "n_upper > 0.4 * greatest(n_upper + n_lower, 1)"),
    Rule("repeats", "n_repeat_words > 0.3 * n_words"),
    Rule("lines", "n_dup_lines >= 3 AND n_dup_lines > 0.3 * n_lines"),
    Rule("digits", "n_digits > 0.25 * word_chars"),
    Rule("length", "word_chars < 2.5 * n_words OR word_chars > 11 * n_words", "word_chars BETWEEN 3.5 * n_words AND 8 * n_words"),
    Rule("prose", "n_words >= 60 AND n_stops = 0", "n_stops BETWEEN 0.02 * n_words AND 0.3 * n_words"),
    Rule("distinct", "n_words BETWEEN 60 AND 1000 AND n_distinct < 0.2 * n_words", "n_words >= 100 AND n_distinct > 0.4 * n_words"),
)


@dataclass(frozen=True)
class VoteModel:
    """Chances of votes. A document is good, or bad of one of as many kinds as there are rules.

    share[c]: of good documents (c = 0) and of each kind. bad[c][r]: that rule r votes bad. good[0], good[1]:
    that a rule votes good where it does not vote bad, for good and for bad documents of any kind.
    """

    share: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]
    good: tuple[tuple[float, ...], tuple[float, ...]]

    def evidence(self, c: int) -> tuple[float, list[tuple[float, float, float]]]:
        """What a class has without votes in logarithms, and what each rule's vote (none, good, bad) adds."""
        own = self.good[min(c, 1)]
        return math.log(self.share[c]), [(math.log1p(-b) + math.log1p(-g), math.log1p(-b) + math.log(g), math.log(b)) for b, g in zip(self.bad[c], own, strict=True)]

    def posterior(self, votes: tuple[int, ...]) -> float:
        """The chance that a document with these votes is good."""
        each = [start + sum(w[v] for w, v in zip(weights, votes, strict=True)) for start, weights in map(self.evidence, range(len(self.share)))]
        return 1 / sum(math.exp(min(700.0, x - each[0])) for x in each)


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS, prior_rows: float = PRIOR_ROWS) -> VoteModel:
    """patterns: votes (0 none, 1 good, 2 bad) and how many documents have them.

    Kinds of junk seldom meet in one document, so that one class of bad documents would not do: it
    would take the rarer kinds for a habit of good documents. Each rule has a kind of its own, which is
    its suspicion; whether other rules share it, and whether documents of the kind lack good votes, decides
    if the kind stays.
    """
    rules = len(patterns[0][0]) if patterns else len(RULES)
    votes = np.array([v for v, _ in patterns], int).reshape(-1, rules)
    n = np.array([k for _, k in patterns], float)
    is_bad, is_good = (votes == 2).astype(float), (votes == 1).astype(float)
    other = 1 - is_bad
    seen_bad = n @ is_bad / max(1.0, n.sum())
    seen_good = n @ is_good / np.maximum(1.0, n @ other)
    safe = lambda x: np.clip(x, _LEAST, 1 - _LEAST)
    bad_start = np.vstack([START_FALSE * seen_bad, np.tile(seen_bad, (rules, 1))])
    bad_start[np.arange(1, rules + 1), np.arange(rules)] = START_OWN
    bad_start, good_start = safe(bad_start), safe(np.vstack([seen_good, START_PRAISED * seen_good]))
    share_start = np.r_[START_GOOD, np.full(rules, (1 - START_GOOD) / rules)]
    bad, good, share = bad_start, good_start, share_start
    for _ in range(rounds if len(n) else 0):
        praised = good[np.minimum(np.arange(rules + 1), 1)]
        logs = np.log(share) + is_bad @ np.log(bad).T + other @ np.log1p(-bad).T + is_good @ np.log(praised).T + (other - is_good) @ np.log1p(-praised).T
        p = np.exp(logs - logs.max(axis=1, keepdims=True))
        p *= (n / p.sum(axis=1))[:, None]
        mass, two = p.sum(axis=0), np.vstack([p[:, 0], p[:, 1:].sum(axis=1)])
        bad = safe((p.T @ is_bad + prior_rows * bad_start) / (mass[:, None] + prior_rows))
        good = safe((two @ is_good + prior_rows * good_start) / (two @ other + prior_rows))
        share = (mass + prior_rows * share_start) / (mass.sum() + prior_rows)
    return VoteModel(tuple(share.tolist()), tuple(map(tuple, bad.tolist())), tuple(map(tuple, good.tolist())))


def posterior(model: VoteModel) -> Column:
    """The chance of being good, from the votes of a row."""

    def log_share(c: int) -> Column:
        start, weights = model.evidence(c)
        out = F.lit(start)
        for rule, (none, good, bad) in zip(RULES, weights, strict=True):
            out = out + F.when(F.col(rule.name) == 2, F.lit(bad)).when(F.col(rule.name) == 1, F.lit(good)).otherwise(F.lit(none))
        return out

    own = log_share(0)
    return 1 / sum((F.exp(F.least(F.lit(700.0), log_share(c) - own)) for c in range(1, len(model.share))), F.lit(1.0))


def judge_quality(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """Per row: id, the counts, the votes, base_failed, posterior (of being good), kept."""
    names = [r.name for r in RULES]
    rows = saved(counted(documents, id_col=id_col, text_col=text_col).select("*", *(r.vote() for r in RULES)), "votes")
    patterns = [(tuple(r[n] for n in names), r["n_rows"]) for r in rows.groupBy(*names).agg(F.count("*").alias("n_rows")).collect()]  # at most 3 ** len(RULES) rows
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = rows.withColumns({"base_failed": base_failed, "posterior": posterior(estimate(sorted(patterns)))})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep))


def quality_report(judged: DataFrame, id_name: str = "doc_id") -> DataFrame:
    return judged.select(F.col("id").alias(id_name), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
