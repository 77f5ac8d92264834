"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer maps words to classes: insult, threat, hint, target, negation, reported speech,
clause end, other. Scope transducers follow it: negation opens a scope of a few words, reported
speech holds to the end of the clause, a target stays near for a few words, an insult, threat or
hint without a scope waits as many words for a target, and a text remembers that it had a hint.
Each rewrites the insults, threats and hints in its scope. They are composed into one
deterministic transducer over the classes (`Grammar`), whose outputs are the kinds of matched
clauses. A text's score is a logistic function of how many matches of each kind it has.

Words: a stated list, to which the fit adds words and stems (beginnings of words) of the training
rows: insults where they are as telling and as frequent, else hints, which take the same arcs with
weights of their own: those of the first hint, of a further one, and of one with a target, negated or reported. The weights of the kinds are the most likely ones under a prior (so that few or one-sided
labels still give a sane score). The fit reads at most FIT_ROWS labelled rows, in the order of a hash
of their id; everything else covers all rows. Scoring is narrow: the grammar and the weights
(bounded by MAX_LEARNED words) go to the tasks, documents never shuffle.

Defined results: null and empty texts have no matches and get the score of the bias. A null
label, and a label of a null id, are no training rows; of repeated labels of an id the largest
counts. Repeated rows are scored each. Other columns are not read (kept by `reject`). Without
any training row the prior's weights hold. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoweave.llm.common import id_and_text

THRESHOLD = 0.7
#: Labelled rows that the fit reads at most (in expectation), words and stems that it adds at most.
FIT_ROWS = 12_000
MAX_LEARNED = 400
#: What is learned occurs in so many different toxic texts at least, in this share of them, and mostly in them.
MIN_TEXTS = 6
MIN_SHARE = 0.03
MIN_PRECISION = 0.6
MIN_LOG_ODDS = 2.5
#: Learned insults: whole words in a larger share of the toxic texts, nearly only in them.
INSULT_SHARE = 0.1
INSULT_PRECISION = 0.97
STEM_CHARS = (3, 10)

# The words of the grammar.
INSULTS = """idiot idiots stupid moron morons trash garbage pathetic worthless disgusting clown clowns scum loser losers
imbecile cretin dumbass dimwit halfwit fool fools pig pigs vermin filth filthy scumbag bastard jerk creep parasite parasites
subhuman retard retarded whore slut bitch asshole dipshit fuckwit shithead
dummkopf trottel vollidiot abschaum idioten arschloch schwachkopf
crétin abruti imbécile connard salaud ordure
idiota estúpido estúpida imbécil basura escoria asqueroso""".split()
THREATS = """kill kills killed killing murder murders murdered murdering strangle strangles strangled strangling hang hanged hanging shoot shoots shot
shooting stab stabs stabbed stabbing burn burns burned burning destroy destroys destroyed destroying hurt hurts hurting beat beats beaten beating
punish punishes punished punishing slaughter slaughters slaughtered slaughtering töten umbringen erschießen tuer frapper matar golpear""".split()
TARGETS = "you your yours u he she they him her them his their it this these those such all tu vous du ihr sie usted ustedes".split()
NEGATIONS = "not no never nobody none isn't aren't wasn't weren't don't doesn't didn't won't cannot can't without kein keine nicht niemals pas jamais nunca ni".split()
REPORTS = "said says say called calls wrote writes quoted quote claimed claims reported reportedly allegedly accused insulted heard tweeted replied sagte dit dijo".split()
LETTERS_FOR_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END, HINT = range(8)
NAMES = {INSULT: "insult", THREAT: "threat", HINT: "hint"}
#: Kinds of matches, and the prior mean of their weights. The bias comes first; hints have two weights, for the first and for more.
KINDS = ("insult", "target_insult", "negated_insult", "reported_insult", "threat", "target_threat", "negated_threat", "reported_threat", "hint", "further_hint", "target_hint", "negated_hint", "reported_hint")
HINTS_FROM = 8
PRIOR = (-4.0, 5.5, 6.5, 0.5, 1.0, 0.5, 3.0, 0.0, 0.3, 1.5, 2.0, 2.0, 0.2, 0.2, 4.0, 4.0, 3.0, 0.5, 0.5)
PRIOR_SD = 1.5
NEGATION_WORDS = 3
TARGET_WORDS = 4
MANY = 8

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*|[.!?;\n]")
_MASKED = re.compile(r"[^\W_]*[0-9@$][\w@$]*")


@dataclass(frozen=True)
class State:
    """Of the composed transducer: words left of a negation, reported speech, words left near a target, what waits for a target and how long, and whether the text had a hint."""

    negation: int = 0
    report: bool = False
    target: int = 0
    waiting: int = OTHER
    words: int = 0
    hinted: bool = False


class Grammar:
    """The composition of the lexical and the scope transducers. Arcs: (state, class) -> (state, kind or -1)."""

    def __init__(self, learned: tuple[str, ...] = (), hints: tuple[str, ...] = ()):
        """learned: insults. hints: words, and stems that end with *."""
        words = [h for h in hints if not h.endswith("*")]
        self.classes = {w: c for c, own in ((HINT, words), (REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS), (INSULT, INSULTS), (INSULT, learned)) for w in own}
        self.stems = {h[:-1] for h in hints if h.endswith("*")}
        self.stem_sizes = sorted({len(h) for h in self.stems})
        #: three characters that any stem begins with: most words end here
        self.starts = {h[: STEM_CHARS[0]] for h in self.stems}
        self.arcs: list[list[tuple[int, int]]] = []
        number = {State(): 0}
        todo = [State()]
        for s in todo:  # the states that words lead to
            row = []
            for c in range(8):
                after, kind = self._arc(s, c)
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                row.append((number[after], kind))
            self.arcs.append(row)
        self.start = 0
        self.telling = {w for w, c in self.classes.items() if c in (INSULT, THREAT, HINT)}

    @staticmethod
    def _arc(s: State, c: int) -> tuple[State, int]:
        if c == END:
            return State(hinted=s.hinted), -1
        name, waiting, words = "", s.waiting, max(0, s.words - 1)
        if c in NAMES:
            scope = "reported" if s.report else "negated" if s.negation else "target" if s.target else ""
            if not scope:
                waiting, words = c, TARGET_WORDS
                scope = "further" if c == HINT and s.hinted else ""
            name = f"{scope}_{NAMES[c]}".lstrip("_")
        elif c == TARGET and s.words:
            name, waiting, words = f"target_{NAMES[waiting]}", OTHER, 0
        after = State(
            NEGATION_WORDS if c == NEGATION else max(0, s.negation - 1),
            s.report or c == REPORT,
            TARGET_WORDS if c == TARGET else max(0, s.target - 1),
            waiting if words else OTHER,
            words,
            s.hinted or c == HINT,
        )
        return after, KINDS.index(name) if name else -1

    def word_class(self, word: str) -> int:
        c = self.classes.get(word)
        if c is None and not word.isalpha() and any(x in LETTERS_FOR_SIGNS for x in word):
            c = self.classes.get("".join(LETTERS_FOR_SIGNS.get(x, x) for x in word))
            c = c if c in (INSULT, THREAT) else None
        if c is None and self.has_stem(word):
            c = HINT
        return OTHER if c is None else c

    def has_stem(self, word: str) -> bool:
        return word[: STEM_CHARS[0]] in self.starts and any(word[:n] in self.stems for n in self.stem_sizes if n < len(word))

    def matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(kind, start, end) of each matched clause part: from the clause's beginning to the word that completes it."""
        lowered = text.lower()
        words = _WORD.findall(lowered)
        if self.telling.isdisjoint(words) and not (self.starts and any(map(self.has_stem, words))) and not any(self.word_class(w) in (INSULT, THREAT) for w in _MASKED.findall(lowered)):
            return
        state, began = self.start, 0
        for m in re.finditer(r"[^\W_](?:[\w@$]|['’](?=[^\W_]))*|[.!?;\n]|\$[\w@$]+", lowered):
            word = m.group()
            c = END if word in ".!?;\n" else self.word_class(word.rstrip("$@_"))
            state, kind = self.arcs[state][c]
            if c == END:
                began = m.end()
            if kind >= 0:
                yield kind, began, m.end()


def counts_of(grammar: Grammar, text: str | None) -> list[int]:
    out = [0] * len(KINDS)
    for kind, _, _ in grammar.matches(text) if text else ():
        out[kind] += 1
    return out


def features(counts: np.ndarray) -> np.ndarray:
    """A match counts fully once, and more of its kind add a little; of hints, the second and third count most."""
    counts = np.asarray(counts, float).reshape(-1, len(KINDS))
    own, hints = counts[:, :HINTS_FROM], counts[:, HINTS_FROM:]
    return np.column_stack([np.ones(len(counts)), np.minimum(own, 1) + 0.1 * np.minimum(np.maximum(own - 1, 0), MANY), np.minimum(hints, 1), np.minimum(np.maximum(hints - 1, 0), 2) / 2])


@dataclass(frozen=True)
class Model:
    learned: tuple[str, ...] = ()
    weights: tuple[float, ...] = PRIOR
    hints: tuple[str, ...] = ()

    def grammar(self) -> Grammar:
        return Grammar(self.learned, self.hints)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-features(counts) @ np.array(self.weights)))


def fit_weights(counts: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> tuple[float, ...]:
    """Newton steps to the most likely weights; counts and toxic occur in so many rows."""
    x, y, n, prior = features(counts), np.asarray(toxic, float), np.asarray(rows, float), np.array(PRIOR)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (n * (p - y)) + (w - prior) / PRIOR_SD**2
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / PRIOR_SD**2
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, fit_rows: int) -> DataFrame:
    """Different texts with their label: text (lower case), toxic. A bounded set, chosen by a hash of the id."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, fit_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit(share)), F.lit(1_000_000)) < int(share * 1_000_000))
    # At most about fit_rows pairs of numbers: their size is bounded by the parameter.
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id")
    return docs.select(F.lower(F.coalesce("text", F.lit(""))).alias("text"), "toxic").groupBy("text").agg(F.max("toxic").alias("toxic"))


def fit(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Model:
    rows = training_rows(documents, labels, id_col=id_col, text_col=text_col, label_col=label_col, fit_rows=fit_rows).persist()
    try:
        n_bad, n_good = (rows.where(f"toxic = {k}").count() for k in (1, 0))
        low, high = STEM_CHARS
        words = F.filter(F.array_distinct(F.split("text", r"[^\p{L}]+")), lambda w: F.length(w) >= low)
        stems = F.flatten(F.transform(F.filter(words, lambda w: F.length(w) > low), lambda w: F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.length(w) - 1)), lambda n: F.concat(F.substring(w, F.lit(1), n), F.lit("*")))))
        each = rows.select("toxic", F.explode(F.array_union(words, stems)).alias("pattern"))
        seen = each.groupBy("pattern").agg(F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad"), F.count("*").alias("n"))
        odds = F.log((F.col("bad") + 0.5) / max(1, n_bad)) - F.log((F.col("n") - F.col("bad") + 0.5) / max(1, n_good))
        telling = seen.where((F.col("bad") >= max(MIN_TEXTS, MIN_SHARE * n_bad)) & (F.col("bad") >= MIN_PRECISION * F.col("n")) & (odds > MIN_LOG_ODDS))
        found = {r.pattern: (r.bad, r.n) for r in telling.orderBy(F.desc("bad"), "n", "pattern").limit(10 * MAX_LEARNED).collect()}
        learned = tuple(p for p, (bad, n) in found.items() if not p.endswith("*") and bad >= max(2 * MIN_TEXTS, INSULT_SHARE * n_bad) and bad >= INSULT_PRECISION * n)
        hints = _without_shorter({p: c for p, c in found.items() if p not in learned}, found)[:MAX_LEARNED]
        counted = _counted(rows.select("toxic", "text"), Grammar(learned, hints), "toxic")
        table = counted.groupBy("toxic", *KINDS).agg(F.count("*").alias("n")).collect()  # at most fit_rows rows
    finally:
        rows.unpersist()
    if not table:
        return Model(learned, PRIOR, hints)
    return Model(learned, fit_weights(np.array([[r[k] for k in KINDS] for r in table]), np.array([r.toxic for r in table]), np.array([r.n for r in table])), hints)


def _without_shorter(patterns: dict[str, tuple[int, int]], every: dict[str, tuple[int, int]]) -> tuple[str, ...]:
    """Patterns but for stems of which a longer pattern has most toxic texts and fewer others, or the same and no more."""

    def better(stem: str, q: str) -> bool:
        (bad, n), (other_bad, other_n) = every[f"{stem}*"], every[q]
        rest, other_rest = n - bad, other_n - other_bad
        return other_bad >= 0.7 * bad and (other_rest < rest or other_rest == rest and len(q) > len(stem) + 1)

    return tuple(p for p in patterns if not p.endswith("*") or not any(q.startswith(p[:-1]) and q != p and better(p[:-1], q) for q in every))


def _counted(rows: DataFrame, grammar: Grammar, keep: str) -> DataFrame:
    """keep and text -> keep and the count of each kind, none above MANY + 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([counts_of(grammar, x.as_py()) for x in b.column("text")], np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays([b.column(keep), *(pa.array(np.minimum(found[:, i], MANY + 1)) for i in range(len(KINDS)))], names=[keep, *KINDS])

    return rows.mapInArrow(run, f"{keep} {dict(rows.dtypes)[keep]}, " + ", ".join(f"{k} long" for k in KINDS))


def score(documents: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score, clauses (kind, start, end of every match, in code points of the lower-cased text)."""
    docs = id_and_text(documents, id_col, text_col)
    grammar = model.grammar()
    clause = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, clauses = [], []
            for x in b.column("text"):
                raw = x.as_py()
                found = list(grammar.matches(raw.decode())) if raw else []
                row = [0] * len(KINDS)
                for kind, _, _ in found:
                    row[kind] += 1
                counts.append(row)
                clauses.append([{"kind": KINDS[k], "start": s, "end": e} for k, s, e in found])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(model.scores(counts) if counts else [], pa.float64()), pa.array(clauses, clause)], names=["id", "score", "clauses"])

    return docs.mapInArrow(run, f"id {dict(docs.dtypes)['id']}, score double, clauses array<struct<kind:string,start:long,end:long>>")


def reject(documents: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows below the threshold, with all their columns."""
    grammar = model.grammar()

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores([counts_of(grammar, t) for t in texts]) if len(texts) else [], dtype=float)

    return documents.where(scored(F.col(text_col)) < threshold)


def toxicity_report(scored: DataFrame, id_name: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    return scored.select(F.col("id").alias(id_name), is_held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
