"""Quality rules as a short-circuit cascade: cheap rules that reject much run first, and a rejected text is not looked at again."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ludoscope.llm.frames import ready
from ludoscope.llm.text_stats import counted
from ludoscope.llm.words import Words, word_chunks

#: Documents on which costs and rejections are estimated. They decide the order of the rules, never a verdict.
SAMPLE_DOCS = 2_000


@dataclass(frozen=True)
class Rule:
    """A name and the texts it rejects."""

    name: str
    rejects: Callable[[Words], np.ndarray]


def _over(count: str, part: int, of: str, whole: int) -> Callable[[Words], np.ndarray]:
    """Texts with count / of > part / whole."""
    return lambda w: whole * counted(w, count) > part * counted(w, of)


BASE_RULES = (
    Rule("few_words", lambda w: counted(w, "n_words") < 20),
    Rule("repeated_passages", _over("n_repeat_words", 30, "n_words", 100)),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", _over("n_symbols", 1, "n_words", 10)),
    Rule("repeated_lines", _over("n_dup_lines", 1, "n_lines", 2)),
    Rule("stutter", _over("n_stutter", 30, "n_words", 100)),
    Rule("word_length", lambda w: (counted(w, "word_chars") < 3 * w.count) | (counted(w, "word_chars") > 10 * w.count)),
    Rule("few_letters", lambda w: 2 * counted(w, "n_letters") < counted(w, "word_chars")),
)
#: The counts that ``counts=True`` adds.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def estimate_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_docs: int = SAMPLE_DOCS) -> dict[str, tuple[float, float]]:
    """(seconds per text, share rejected) of each rule, measured on about ``sample_docs`` documents in the tasks."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in word_chunks(batch.column("text")):
                spent, gone = [], []
                for rule in rules:
                    words.memo.clear()
                    start = time.process_time()
                    gone.append(int(rule.rejects(words).sum()))
                    spent.append(time.process_time() - start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.name for r in rules]), pa.array(spent), pa.array(gone), pa.array([len(words.count)] * len(rules))],
                    names=["rule", "seconds", "rejected", "texts"],
                )

    total = docs.count()
    sample = docs.select("text").sample(min(1.0, sample_docs / total), seed=7) if total > sample_docs else docs.select("text")
    rows = sample.mapInArrow(measure, "rule string, seconds double, rejected long, texts long").groupBy("rule").agg(
        F.sum("seconds") / F.sum("texts"), F.sum("rejected") / F.sum("texts")
    ).collect()
    return {r[0]: (r[1], r[2]) for r in rows}


def order_rules(estimates: dict[str, tuple[float, float]], rules: Sequence[Rule] = RULES) -> list[Rule]:
    """Rules by rejection per cost, the highest first; rules without an estimate come last, ties keep their order."""

    def gain(rule: Rule) -> float:
        cost, share = estimates.get(rule.name, (1.0, 0.0))
        return share / max(cost, 1e-9)

    return sorted(rules, key=gain, reverse=True)


def run_cascade(words: Words, rules: Sequence[Rule]) -> tuple[np.ndarray, np.ndarray]:
    """Which texts every rule lets pass, and the place of the rule that stopped each other one (-1: none)."""
    stopped = np.full(len(words.count), -1, dtype=np.int64)
    left = np.arange(len(words.count))
    for place, rule in enumerate(rules):
        if not len(left):
            break
        bad = rule.rejects(words)
        stopped[left[bad]] = place
        if bad.any():
            left, words = left[~bad], words.take(np.flatnonzero(~bad))
    return stopped < 0, stopped


def grade(docs: DataFrame, rules: Sequence[Rule] = RULES, counts: bool = False, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` with ``kept`` and ``stopped_by`` (a rule's name or null), and with the REPORTED counts and base_failed if asked.

    The order of the rules follows the sample; a verdict does not, as a document is kept only if all rules let it pass. With
    ``counts`` every document is counted in full first, and the cascade then runs over those that pass the base rules.
    A null text has no words and fails ``few_words``. Columns of ``docs`` are kept; those named like a result are
    replaced. Every row gets one row, repeated or not.
    """
    docs = ready(docs)
    results = ["kept", "stopped_by", *(["base_failed", *REPORTED] if counts else [])]
    plain = docs.drop(*[c for c in results if c in docs.columns])
    ordered = order_rules(estimate_rules(plain, rules, sample_docs), rules)
    later = [r for r in ordered if r not in BASE_RULES] if counts else ordered
    ahead = list(BASE_RULES) if counts else []

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_chunks(batch.column("text")):
                n = len(words.count)
                extra: list[pa.Array] = []
                if counts:
                    failed = np.zeros(n, dtype=bool)
                    for rule in ahead:
                        failed |= rule.rejects(words)
                    extra = [pa.array(failed), *(pa.array(counted(words, c).astype(np.int64)) for c in REPORTED)]
                passed, stopped = run_cascade(words, [*ahead, *later])
                names = [r.name for r in (*ahead, *later)]
                by = pa.array([names[i] if i >= 0 else None for i in stopped], pa.string())
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(passed), by, *extra], names=[*part.schema.names, *results])

    kinds = {"kept": "boolean", "stopped_by": "string", "base_failed": "boolean"}
    schema = StructType(list(plain.schema.fields))
    for c in results:
        schema = schema.add(c, kinds.get(c, "long"))
    return plain.mapInArrow(work, schema)
