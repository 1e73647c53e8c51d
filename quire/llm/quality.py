"""Quality rules as weak supervision: rules vote or abstain, a label model weighs them.

Each rule looks at a document's statistics and votes good (+1), bad (-1) or abstains
(0).  Expectation-maximisation estimates each rule's accuracy and the share of good
documents without any label, from the counts of the vote patterns over all documents;
there are at most 3 ** rules patterns, so those counts are bounded whatever the input's
size.  A document is kept when its posterior probability of being good reaches
``threshold``.  The model is one of the votes cast: an abstention says nothing, neither
in the fit nor in the posterior, which is the fitted model's own.  No rule is taken to
be right more than ``SUREST`` of the time it votes, on good documents or on bad ones, so
it takes bad votes of several rules to outweigh the good ones of the others.

Cases: a null text has no word; an empty or wordless text has zero statistics and every
rule abstains or votes bad on it; repeated rows are judged alike; an empty table gives an
empty result and a model of its starting values; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import fresh, utf8

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_marked"]
SYMBOLS = b"#*$%&|<>"
_ONE_MARK = bytes.maketrans(SYMBOLS, b"#" * len(SYMBOLS))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_CONTINUED = bytes(range(128, 192))
_HIGH = bytes(range(128, 256))


def text_stats(data: bytes) -> tuple[int, ...]:
    """The STATS of one whole text in UTF-8.

    Words are runs of bytes outside space and \\t..\\r.  A repeated word stands in a
    3-word window that the text holds twice or more; a duplicate line has a word and
    equals an earlier line.  ``n_letters`` counts A-Z, a-z and all non-ASCII characters,
    ``n_marked`` the words that hold one of SYMBOLS.
    """
    words = data.split()
    n = len(words)
    solid = b"".join(words)
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    plain = solid.translate(None, _CONTINUED)
    letters = len(plain) - len(plain.translate(None, _LETTERS + _HIGH))
    symbols = len(solid) - len(solid.translate(None, SYMBOLS))
    marked = sum(b"#" in w for w in data.translate(_ONE_MARK).split()) if symbols else 0
    return (
        n,
        len(plain),
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        letters,
        marked,
    )


def repeated_words(words: list[bytes]) -> int:
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) >= 1 << 20:  # keep the key of three words within 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * len(seen) + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(n, bool)
    for shift in range(3):
        cover[shift : n - 2 + shift] |= again
    return int(cover.sum())


def with_stats(docs: DataFrame, text_col: str = "text", out: str = "stats", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns, or ``keep``) with a struct column of STATS."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql import types as T

    kept = list(docs.columns) if keep is None else list(keep)
    plain = docs.select(*kept) if text_col in kept else docs.select(*kept, text_col)
    at = plain.columns.index(text_col)
    stats = T.StructType([T.StructField(s, T.LongType()) for s in STATS])
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(out, stats)])
    arrow = to_arrow_schema(schema)
    width = len(kept)

    def run(batches):
        for b in batches:
            rows = np.array([text_stats(x) for x in utf8(b.column(at))], np.int64).reshape(-1, len(STATS))
            cols = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(STATS))], names=STATS)
            yield pa.RecordBatch.from_arrays(
                    [*b.columns[:width], cols], schema=pa.schema([*list(b.schema)[:width], arrow.field(width)])
                )

    return plain.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """``good`` and ``bad`` are conditions over the statistics; neither (or both) is abstaining."""

    name: str
    good: Callable[[Column], Column]
    bad: Callable[[Column], Column]

    def vote(self, s: Column) -> Column:
        return self.good(s).cast("int") - self.bad(s).cast("int")


def _share(s: Column, part: str, whole: str) -> Column:
    return s[part] / F.greatest(s[whole], F.lit(1))


RULES = [
    Rule(
        "word_length",
        lambda s: _share(s, "word_chars", "n_words").between(4.0, 6.2),
        lambda s: ~_share(s, "word_chars", "n_words").between(3.0, 10.0),
    ),
    Rule("symbols", lambda s: _share(s, "n_symbols", "n_words") <= 0.02, lambda s: _share(s, "n_symbols", "n_words") > 0.1),
    # a few heavy words or many lightly marked ones: one of the two rules alone is no reason to reject
    Rule("marked", lambda s: _share(s, "n_marked", "n_words") <= 0.02, lambda s: _share(s, "n_marked", "n_words") > 0.2),
    Rule("lines", lambda s: _share(s, "n_dup_lines", "n_lines") <= 0.35, lambda s: _share(s, "n_dup_lines", "n_lines") > 0.5),
    Rule(
        "repetition",
        lambda s: _share(s, "n_repeat_words", "n_words") <= 0.2,
        lambda s: _share(s, "n_repeat_words", "n_words") > 0.4,
    ),
    # prose has over 0.9; source code, references and tables of figures lie between
    Rule("letters", lambda s: _share(s, "n_letters", "word_chars") >= 0.9, lambda s: _share(s, "n_letters", "word_chars") < 0.5),
]
SUREST = 0.95


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents and, for each rule, the probability that a vote it casts
    is good: on bad documents and on good ones."""

    prior: float
    votes: tuple[tuple[float, float], ...]

    def accuracy(self) -> list[float]:
        """How often each rule is right when it votes."""
        return [(1 - self.prior) * (1 - bad) + self.prior * good for bad, good in self.votes]

    def weights(self) -> list[list[float]]:
        """What each rule's votes -1, 0 and +1 add to the log odds."""
        return [[math.log((1 - good) / (1 - bad)), 0.0, math.log(good / bad)] for bad, good in self.votes]

    def posterior(self, votes: Column) -> Column:
        """P(good | votes cast): the log odds are the prior's plus a weight for each rule's vote."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for i, weights in enumerate(self.weights()):
            odds = odds + F.get(F.array(*map(F.lit, weights)), F.get(votes, F.lit(i)) + 1)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def votes_of(stats: Column, rules: list[Rule] = RULES) -> Column:
    return F.array(*(r.vote(stats) for r in rules))


START = (0.8, 0.3, 0.85)


def fit_label_model(votes: DataFrame, n_rules: int, vote_col: str = "votes", steps: int = 200) -> LabelModel:
    """Expectation-maximisation over the counts of the vote patterns of all rows.

    It starts from START: most documents are good, and a rule's vote is right more
    often than wrong, which tells good from bad.  Each step's probabilities are those of
    the greatest expected likelihood within two bounds: those of SUREST, and that a good
    vote is no likelier on bad documents than on good ones.
    """
    rows = votes.groupBy(vote_col).agg(F.count(F.lit(1)).alias("n")).orderBy(vote_col).collect()
    v = np.array([r[vote_col] for r in rows], int).reshape(-1, n_rules)
    n = np.array([r["n"] for r in rows], float)
    up, down = (v > 0).astype(float), (v < 0).astype(float)  # pattern, rule
    prior = START[0]
    given = np.repeat(np.array(START[1:])[:, None], n_rules, 1)  # class (bad, good), rule: P(vote is good)
    for _ in range(steps if len(rows) else 0):
        log = np.log(given) @ up.T + np.log(1 - given) @ down.T
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1] + math.log((1 - prior) / prior), -700, 700)))
        weight = np.stack([(1 - good) * n, good * n])
        # 0.1 of a vote each way stands for a rule that has cast none
        for_, cast = weight @ up + 0.1, weight @ (up + down) + 0.2
        given = for_ / cast
        # a rule that votes good more often on bad documents tells nothing: one share for both
        given = np.where(given[0] > given[1], for_.sum(0) / cast.sum(0), given)
        given = np.clip(given, 1 - SUREST, SUREST)
        prior = float(np.clip(weight[1].sum() / n.sum(), 0.01, 0.99))
    return LabelModel(prior, tuple((float(b), float(g)) for b, g in given.T))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def judge(
    rows: DataFrame, stats_col: str, out: str = "quality", rules: list[Rule] = RULES, threshold: float = 0.5
) -> DataFrame:
    """``rows`` (with a STATS column) plus ``out``: struct(base_failed, votes, posterior, kept)."""
    s = F.col(stats_col)
    votes = votes_of(s, rules)
    model = fit_label_model(rows.select(votes.alias("votes")), len(rules))
    posterior = model.posterior(votes)
    failed = base_failed(s)
    return rows.withColumn(
        out,
        F.struct(
            failed.alias("base_failed"),
            votes.alias("votes"),
            posterior.alias("posterior"),
            (~failed & (posterior >= threshold)).alias("kept"),
        ),
    )


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep, with the columns of ``docs``."""
    stats = fresh(docs, "stats")
    rows = with_stats(docs, text_col, stats)
    verdict = fresh(rows, "quality")
    return judge(rows, stats, verdict).where(F.col(verdict)["kept"]).select(*docs.columns)
