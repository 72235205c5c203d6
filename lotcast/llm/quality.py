"""Quality rules by weak supervision.

Rules over text statistics vote good (1), bad (-1) or abstain (0). Votes are
counted by pattern (at most 3 ** rules patterns, whatever the corpus), and
expectation-maximisation on those counts estimates how often each rule votes
each way on good and on bad documents. A document's posterior probability of
being good replaces "all rules must pass".

Edge cases: NULL and empty texts have no words and fail the base test; a
corpus without documents keeps the uninformed model (prior 0.5); repeated
rows are separate documents; other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcast.llm.common import materialize

WINDOW_WORDS = 5
BLANK = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_ended_lines", "n_upper", "n_lower", "n_marked_words", "n_bare_words", "n_distinct_words", "n_stuttered")
_MARKS = b"#*$%&|<>!=~^@"
_ENDS = (b".", b"!", b"?", b":", b";", b'"', b")", "…".encode())


def covered_words(words: np.ndarray, size: int) -> int:
    """Words inside windows of ``size`` words that occur at least twice."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    grams = words[:n].copy()
    with np.errstate(over="ignore"):
        for k in range(1, size):
            grams *= np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(29)
            grams += words[k: k + n]
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    if not same.any():
        return 0
    repeated = np.zeros(n, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The ``STATS`` of one whole text."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return (0, 0, sum(raw.count(bytes([c])) for c in SYMBOLS), *[0] * (len(STATS) - 3))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [line for line in raw.split(b"\n") if line.strip(BLANK)]
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    return (
        len(words),
        int(len(raw) - counts[0x80:0xC0].sum() - counts[list(BLANK)].sum()),
        int(counts[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        covered_words(hashes, WINDOW_WORDS),
        len(lines),
        sum(line.rstrip(BLANK).endswith(_ENDS) for line in lines),
        int(counts[65:91].sum()),
        int(counts[97:123].sum()),
        sum(w[-1] in _MARKS for w in words),
        sum(len(w) == 1 and w in b"|-_+=/\\~^<>#*$%&@" for w in words),
        len(set(words)),
        int((hashes[1:] == hashes[:-1]).sum()),
    )


def text_stats(text: Column) -> Column:
    """A struct of the ``STATS`` of every whole text (Arrow batches)."""

    @F.pandas_udf(", ".join(f"{s} long" for s in STATS))
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=list(STATS))

    return stats(text)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(s: Column) -> dict[str, Column]:
    """The rules. Each kind of junk is seen by two rules or more, so that
    their agreement tells how far to trust them."""
    words = F.greatest(s["n_words"], F.lit(1))
    lines = F.greatest(s["n_lines"], F.lit(1))
    letters = F.greatest(s["n_upper"] + s["n_lower"], F.lit(1))
    share = lambda name: s[name] / words
    return {
        "symbols": _vote(share("n_symbols") > 0.2, share("n_symbols") < 0.05),
        "marked": _vote(share("n_marked_words") > 0.15, share("n_marked_words") < 0.03),
        "bare": _vote(share("n_bare_words") > 0.1, share("n_bare_words") < 0.02),
        "capitals": _vote(s["n_upper"] / letters > 0.4, s["n_upper"] / letters < 0.15),
        "repeats": _vote(share("n_repeat_words") > 0.1, share("n_repeat_words") < 0.03),
        "variety": _vote((s["n_words"] >= 20) & (s["n_distinct_words"] < 0.15 * F.sqrt(words) + 0.05 * words),
                         s["n_distinct_words"] > 0.4 * words),
        "stutter": _vote(share("n_stuttered") > 0.2, share("n_stuttered") < 0.05),
        "same_lines": _vote(s["n_dup_lines"] / lines > 0.4, s["n_dup_lines"] == 0),
        "ended": _vote(s["n_ended_lines"] / lines < 0.2, s["n_ended_lines"] / lines > 0.6),
        "length": _vote(s["n_words"] < 20, s["n_words"] >= 50),
        "word_length": _vote((s["word_chars"] / words > 12) | (s["word_chars"] / words < 2.5),
                             (s["word_chars"] / words > 3) & (s["word_chars"] / words < 9)),
    }


@dataclass(frozen=True)
class LabelModel:
    """``log_odds[rule][vote + 1]``: what a vote adds to the log odds of
    good; ``prior``: the log odds before any vote."""

    prior: float
    log_odds: dict[str, tuple[float, float, float]]

    def posterior(self, vote_of: dict[str, Column]) -> Column:
        total = F.lit(self.prior)
        for rule, (bad, none, good) in self.log_odds.items():
            v = vote_of[rule]
            total = total + F.when(v == -1, F.lit(bad)).when(v == 1, F.lit(good)).otherwise(F.lit(none))
        return 1 / (1 + F.exp(-total))


def fit(patterns: list[tuple[tuple[int, ...], int]], rules: list[str], rounds: int = 200,
        tolerance: float = 1e-10) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts.

    A rule that abstains tells nothing, so its accuracy is estimated among
    its votes. Kinds of junk differ, so the start takes each bad vote as
    strong evidence and good votes as none; and no rule may come out worse
    than chance (a bad vote never speaks for a document, a good one never
    against it). Every estimate has one pseudo-count, and the prior stays
    within 1 % and 99 %.
    """
    patterns = sorted(patterns)
    if not patterns:
        return LabelModel(0.0, {r: (0.0, 0.0, 0.0) for r in rules})
    v = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    good = 1 / (1 + np.exp(3.0 * (v < 0).sum(1) - 2.0))
    before = None
    for _ in range(rounds):
        weight = np.stack([n * (1 - good), n * good])
        prior = float(np.clip((weight[1].sum() + 1) / (n.sum() + 2), 0.01, 0.99))
        table = np.array([[[weight[c][v[:, r] == k].sum() + 1 for k in (-1, 1)] for r in range(len(rules))]
                          for c in (0, 1)])
        table /= table.sum(2, keepdims=True)
        of_bad, of_good = (np.log(table[1]) - np.log(table[0])).T
        log_odds = np.stack([np.minimum(of_bad, 0), np.zeros(len(rules)), np.maximum(of_good, 0)], 1)
        total = math.log(prior / (1 - prior)) + sum(log_odds[r][v[:, r] + 1] for r in range(len(rules)))
        good = 1 / (1 + np.exp(-total))
        if before is not None and np.abs(good - before).max() < tolerance:
            break
        before = good
    return LabelModel(math.log(prior / (1 - prior)), {r: tuple(map(float, log_odds[k])) for k, r in enumerate(rules)})


def fit_votes(stats: DataFrame, column: str = "stats") -> LabelModel:
    """Count vote patterns over all rows of ``stats`` and fit the rules'
    accuracies. At most 3 ** 11 rows reach the driver."""
    vote_of = votes(F.col(column))
    counted = stats.groupBy(*[c.alias(f"vote_{r}") for r, c in vote_of.items()]).count()
    rules = list(vote_of)
    return fit([(tuple(r[f"vote_{x}"] for x in rules), r["count"]) for r in counted.collect()], rules)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id``, the ``STATS``, ``base_failed``,
    ``posterior`` and ``good`` (the verdict of the label model alone)."""
    slim = materialize(docs.select(F.col(id_col).alias("doc_id"), text_stats(F.col(text_col)).alias("stats")),
                       "quality-stats")
    s, model = F.col("stats"), fit_votes(slim)
    return (slim.withColumn("posterior", model.posterior(votes(s)))
            .select("doc_id", "stats.*", base_failed(s["n_words"], s["n_repeat_words"]).alias("base_failed"),
                    "posterior", (F.col("posterior") >= threshold).alias("good")))


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The probably good documents, with their own columns only. One pass
    counts votes, a second judges row by row: no text is shuffled, and none is
    written for the second pass (rows with their measures would take the input's
    size on disk once more). The base test is left out: the posterior stands in
    place of "all rules must pass", so short or repetitive documents stay where
    the other rules outvote it. A NULL text is judged as an empty one; repeated
    rows stay or go together; no rows give none."""
    model = fit_votes(docs.select(text_stats(F.col(text_col)).alias("stats")))
    return (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        text_stats(F.col(text_col)).alias("stats"))
            .filter(model.posterior(votes(F.col("stats"))) >= threshold).select("row.*"))
