"""Quality rules as weak supervision: rules vote or abstain, their accuracies are estimated.

Each rule reads counts of the whole text and votes good, bad or abstains. Expectation-maximisation
over the counts of all vote patterns in the corpus estimates how often each rule's votes are bad
for good and for bad documents, without labels. A document is kept by its posterior probability of
being good, not by passing every rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arqueo.llm.common import grouped, map_texts, materialize, texts
from arqueo.llm.hashing import IS_SPACE, joined, mix, windows, word_hashes

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_BLANK = " \t\n\x0b\x0c\r"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_marks", "n_stops",
)


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(chars)] = 1
    return out


_SYMBOL, _MARK, _STOP = _flags(SYMBOLS), _flags(b"!?|"), _flags(b".")
_UPPER = _flags(bytes(range(65, 91)))
_LETTER = _flags(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(0xC0, 256)]))
_LEAD = np.array([(i & 0xC0) != 0x80 for i in range(256)], np.uint8) * ~IS_SPACE


def text_counts(items: list[bytes]) -> dict[str, np.ndarray]:
    """The counts named in COUNTS for each text (UTF-8 bytes)."""
    n = len(items)
    buf, offsets = joined(items)
    starts, hashes = word_hashes(buf)
    bounds = np.searchsorted(starts, offsets)
    words = np.diff(bounds)
    out = {"n_words": words}

    def per_text(table: np.ndarray) -> np.ndarray:
        return np.add.reduceat(table[buf], offsets[:-1], dtype=np.int64)

    tables = {"word_chars": _LEAD, "n_symbols": _SYMBOL, "n_letters": _LETTER, "n_upper": _UPPER, "n_marks": _MARK, "n_stops": _STOP}
    for name, flags in tables.items():
        out[name] = per_text(flags)
    lines, dup = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, t in enumerate(items):
        own = [x for x in t.split(b"\n") if x.strip(_BLANK.encode())]
        lines[i], dup[i] = len(own), len(own) - len(set(own))
    out["n_lines"], out["n_dup_lines"] = lines, dup
    repeated = np.zeros(len(hashes) + 1, np.int64)
    full = windows(hashes, 5)
    if len(full):
        text_of = np.repeat(np.arange(n), words)
        at = np.flatnonzero(text_of[: len(full)] == text_of[4:])
        keys = full[at] ^ mix(text_of[at].astype(np.uint64) + np.uint64(1))
        _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
        at = at[count[inverse] > 1]
        np.add.at(repeated, at, 1)
        np.add.at(repeated, at + 5, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(repeated)[:-1] > 0)])
    out["n_repeat_words"] = covered[bounds[1:]] - covered[bounds[:-1]]
    return out


def with_counts(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (or all) of ``docs`` and the counts of their texts; columns with those
    names are replaced."""
    own = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS]
    return _counted(docs.select(*dict.fromkeys([*own, "text"])), own)


def _counted(docs: DataFrame, own: list[str]) -> DataFrame:
    schema = ", ".join(
        [*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own), *(f"{c} bigint" for c in COUNTS)]
    )

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        items = texts(batch.column("text"))
        for a, b in grouped(items):
            got = text_counts(items[a:b])
            part = batch.slice(a, b - a)
            columns = [part.column(c) for c in own] + [pa.array(got[c], pa.int64()) for c in COUNTS]
            yield pa.RecordBatch.from_arrays(columns, [*own, *COUNTS])

    return map_texts(docs, schema, run)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: str
    good: str


RULES = (
    Rule(
        "symbols", "n_symbols > 0.1 * n_words or n_symbols > 0.06 * word_chars",
        "n_symbols < 0.02 * n_words and n_symbols <= 0.01 * word_chars",
    ),
    Rule("letters", "n_letters < 0.75 * word_chars", "n_letters > 0.88 * word_chars"),
    Rule("repeated_windows", "n_repeat_words > 0.2 * n_words", "n_repeat_words <= 0.05 * n_words"),
    Rule("repeated_lines", "n_dup_lines >= 3 and n_dup_lines > 0.3 * n_lines", "n_dup_lines = 0 and n_lines >= 5"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 12 * n_words", "word_chars between 3.5 * n_words and 9 * n_words"),
    Rule("capitals", "n_upper > 0.4 * word_chars", "n_upper < 0.12 * word_chars"),
    Rule("length", "n_words < 10", "n_words >= 60"),
    Rule("marks", "n_marks > 0.3 * n_words", "n_marks < 0.05 * n_words"),
    Rule("sentences", "n_words >= 60 and n_stops * 200 < n_words", "n_stops * 60 > n_words and n_stops * 2 < n_words"),
)


def vote(rule: Rule) -> Column:
    """0 bad, 1 abstain, 2 good."""
    return F.expr(f"case when {rule.bad} then 0 when {rule.good} then 2 else 1 end")


def pattern(rules: tuple[Rule, ...]) -> Column:
    """The votes of all rules as one number in base 3."""
    out = F.lit(0)
    for rule in reversed(rules):
        out = out * 3 + vote(rule)
    return out.cast("int")


@dataclass(frozen=True)
class LabelModel:
    """Posterior probability of good for each vote pattern, and each rule's estimated accuracy."""

    posterior: dict[int, float]
    accuracy: dict[str, float]
    prior: float


#: What the priors expect: the share of good documents, and of bad votes among a rule's votes on good and
#: on bad documents.
EXPECTED_GOOD, BAD_VOTES_ON_GOOD, BAD_VOTES_ON_BAD = 0.9, 0.02, 0.5


def estimate(counts: dict[int, int], rules: tuple[Rule, ...], rounds: int = 500, weight: float = 0.01) -> LabelModel:
    """Expectation-maximisation over vote-pattern counts.

    An abstention says nothing; a bad vote is at least as likely for bad documents as for good
    ones, whatever the rule. So a pattern without bad votes is never below the share of good
    documents. The priors weigh as much as ``weight`` of the corpus, so that a class which the
    corpus lacks keeps the expected rates and stays empty, at every size alike. ``counts`` has at
    most 3 ** len(rules) entries. Ties need no rule: a pattern has one posterior.
    """
    codes = np.array(sorted(counts), np.int64)
    if not len(codes):
        return LabelModel({}, {}, 0.5)
    n = np.array([counts[int(c)] for c in codes], float)
    votes = np.stack([(codes // 3**i) % 3 for i in range(len(rules))], 1)
    bad, voted = (votes == 0).astype(float), (votes != 1).astype(float)
    pseudo = weight * n.sum()

    def rates(share: np.ndarray, expected: float) -> np.ndarray:
        return ((n * share) @ bad + pseudo * expected) / ((n * share) @ voted + pseudo)

    good = np.where(bad.any(1), 1 - EXPECTED_GOOD, EXPECTED_GOOD)
    for _ in range(rounds):
        prior = (n @ good + pseudo * EXPECTED_GOOD) / (n.sum() + pseudo)
        on_good = rates(good, BAD_VOTES_ON_GOOD)
        on_bad = np.maximum(rates(1 - good, BAD_VOTES_ON_BAD), on_good)
        margin = np.log(prior / (1 - prior)) + bad @ np.log(on_good / on_bad)
        margin += (voted - bad) @ np.log((1 - on_good) / (1 - on_bad))
        new = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        done = np.abs(new - good).max() < 1e-9
        good = new
        if done:
            break
    accuracy = prior * (1 - on_good) + (1 - prior) * on_bad
    return LabelModel(
        {int(c): float(p) for c, p in zip(codes, good, strict=True)},
        {rule.name: float(a) for rule, a in zip(rules, accuracy, strict=True)},
        float(prior),
    )


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, least: float = 0.5, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (or all) of ``docs``, the counts, base_failed, quality_probability and kept.

    base_failed: fewer than 10 words, or over 20 of 100 words in repeated windows; such documents
    are not kept. Others are kept with a posterior of at least ``least``. Null and empty texts
    have no words, so they fail. Columns of ``docs`` with these names are replaced. Two jobs need
    the counts: they are written to the shared folder if the texts are not kept, else taken
    twice, as writing all texts once more costs more than counting.
    """
    extra = ("base_failed", "quality_probability", "kept", "vote_pattern")
    own = [c for c in (docs.columns if keep is None else keep) if c not in (*COUNTS, *extra)]
    counted = with_counts(docs, own).withColumn("vote_pattern", pattern(rules))
    if "text" in own:
        patterns = with_counts(docs, []).select(pattern(rules).alias("vote_pattern"))
    else:
        patterns = counted = materialize(counted)
    counts = {r["vote_pattern"]: r["count"] for r in patterns.groupBy("vote_pattern").count().collect()}
    model = estimate(counts, rules)
    spark = docs.sparkSession
    # At most 3 ** len(rules) rows.
    known = spark.createDataFrame(list(model.posterior.items()), "vote_pattern int, quality_probability double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        counted.join(F.broadcast(known), "vote_pattern", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("quality_probability") >= least))
        .select(*own, *COUNTS, "base_failed", "quality_probability", "kept")
    )
