"""Quality rules under weak supervision.

Each rule looks at counts of one document and votes bad (-1), good (1) or abstains (0).  Votes are counted
by pattern over all documents (at most three to the power of the number of rules, whatever the input), and
expectation-maximisation on those counts estimates the share of good documents and, for each rule, how
often it casts each vote on good and on bad documents (a bad vote on a good one at most ``FALSE_ALARM``).  A document's posterior probability of being good
follows from its pattern and replaces "all rules must pass".

Counts are taken with NumPy and Arrow over a few megabytes of text at a time, so memory does not depend
on the number of documents; the only shuffle is the count by pattern, summed before it is sent.

Defined cases: NULL text has no words and no lines; empty text likewise; repeated rows count as often as
they occur and get equal verdicts; on an empty table nothing is estimated and the result is empty; extra
columns pass through, one with the name of a result column is replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.llm.common import add_columns, buffer_of, doc_groups, span_codes, store, table, text_input

GROUP_BYTES = 1 << 20
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SHORT_WORDS = 10
#: The rules are written to be precise: on good documents a bad vote is at most this frequent.  Without such
#: a bound the two classes that fit best need not be good and bad (e.g. long and short).
FALSE_ALARM = 0.001
#: A bad document escapes all rules about this often (else "all documents are bad" may fit as well).
ESCAPE = 0.1
POSTERIOR, SMOOTH, ROUNDS = 0.5, 1.0, 100

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
          "n_exclaims", "n_stops", "n_digits")


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE = _flags(b" \t\n\x0b\x0c\r")
_SYMBOL = _flags(b"#*$%&|<>")
_UPPER = _flags(bytes(range(0x41, 0x5B)))
_LETTER = _flags(bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)))
_DIGIT = _flags(bytes(range(0x30, 0x3A)))
_EXCLAIM = _flags(b"!")
_STOP = _flags(b".?!,;:")


def _per_doc(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set entries in each of the ranges off[i]:off[i+1]."""
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[off])


def count_text(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each document of a run (bytes and offsets)."""
    data, off = data[int(off[0]):int(off[-1])], off - off[0]
    n, size = len(off) - 1, len(data)
    space = _SPACE[data]
    edge = np.zeros(size + 1, bool)
    edge[off] = True                                        # a document's ends end words
    word = ~space
    start = np.flatnonzero(word & np.concatenate([[True], space[:-1]])[:size] | (word & edge[:-1]))
    end = np.flatnonzero(word & (np.concatenate([space[1:], [True]])[:size] | edge[1:])) + 1
    doc = np.searchsorted(off, start, "right") - 1
    at = np.searchsorted(start, off)                        # words of document d: at[d]:at[d+1]
    out = {"n_words": np.diff(at), "word_chars": _per_doc(word & ((data & 0xC0) != 0x80), off)}
    for name, cls in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_letters", _LETTER), ("n_digits", _DIGIT),
                      ("n_exclaims", _EXCLAIM)):
        out[name] = _per_doc(cls[data], off)
    out["n_stops"] = _per_doc(_STOP[data[end - 1]] if len(end) else np.zeros(0, bool), at)
    # words in three-word windows that occur again in the same document
    covered = np.zeros(len(start), bool)
    if len(start) > 2:
        word_id = span_codes(start, end, data)[0].astype(np.int64)
        if word_id.max() < 1 << 21:
            key = word_id[:-2] << 42 | word_id[1:-1] << 21 | word_id[2:]
        else:                                               # a single very long text: number the pairs first
            pair = np.unique(word_id[:-1] << 32 | word_id[1:], return_inverse=True)[1]
            key = pair[:-1] << 32 | word_id[2:]
        first = np.flatnonzero(doc[:-2] == doc[2:])
        key = key[first]
        order = np.argsort(key, kind="stable")
        k, d = key[order], doc[first[order]]
        same = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
        hit = np.zeros(len(k), bool)
        hit[1:] |= same
        hit[:-1] |= same
        w = first[order[hit]]
        covered[w] = covered[w + 1] = covered[w + 2] = True
    out["n_repeat_words"] = _per_doc(covered, at)
    # lines: pieces between newlines and document ends that hold a word
    cut = data == 10
    first = np.unique(np.concatenate([off[:-1], np.flatnonzero(cut) + 1]))
    first = first[first < size]
    breaks = np.flatnonzero(cut)
    last = off[np.searchsorted(off, first, "right")]        # the end of its document, or a newline before that
    nxt = np.searchsorted(breaks, first)
    has = nxt < len(breaks)
    last[has] = np.minimum(last[has], breaks[nxt[has]])
    full = np.searchsorted(start, last) > np.searchsorted(start, first)
    first, last = first[full], last[full]
    line_at = np.searchsorted(first, off)
    again = np.zeros(len(first), bool)
    if len(first):
        line_id, d = span_codes(first, last, data)[0], np.searchsorted(off, first, "right") - 1
        order = np.argsort(line_id, kind="stable")
        k, d = line_id[order], d[order]
        again[order[1:][(k[1:] == k[:-1]) & (d[1:] == d[:-1])]] = True
    out["n_lines"], out["n_dup_lines"] = np.diff(line_at), _per_doc(again, line_at)
    return out


def add_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the columns of ``COUNTS`` (long)."""
    def fn(b: pa.RecordBatch) -> list[pa.Array]:
        data, off = buffer_of(b.column(0))
        parts = [count_text(data, off[i:j + 1]) for i, j in doc_groups(off, GROUP_BYTES)]
        return [pa.array(np.concatenate([p[c] for p in parts]), pa.int64()) for c in COUNTS]

    return add_columns(docs, [text_input(docs, text_col)], fn, ", ".join(f"{c} bigint" for c in COUNTS))


def _vote(bad: Column, good: Column | None = None) -> Column:
    v = F.when(bad, -1)
    return (v.when(good, 1) if good is not None else v).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules on the counts, by name."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "length": _vote(F.col("n_words") < SHORT_WORDS),
        "word_length": _vote((F.col("word_chars") < 2 * words) | (F.col("word_chars") > 14 * words)),
        "symbols": _vote(F.col("n_symbols") * 10 > words, F.col("n_symbols") == 0),
        "dup_lines": _vote((F.col("n_dup_lines") > 2) & (F.col("n_dup_lines") * 10 > 3 * lines)),
        "repeats": _vote(F.col("n_repeat_words") * 10 > 3 * words),
        "capitals": _vote(F.col("n_upper") * 10 > 3 * F.col("n_letters")),
        "exclaims": _vote(F.col("n_exclaims") * 10 > words),
        "stops": _vote(F.col("n_stops") * 100 < words, F.col("n_stops") * 100 >= 4 * words),
    }


def pattern_code(votes: list[Column]) -> Column:
    """A vote pattern as one number in base three."""
    code = F.lit(0)
    for v in votes:
        code = code * 3 + (v + 1)
    return code.cast("int")


def fit(patterns: dict[int, int], n_rules: int, rounds: int = ROUNDS, smooth: float = SMOOTH) -> dict[int, float]:
    """Posterior probability of a good document by pattern, from the patterns' counts."""
    if not patterns:
        return {}
    codes = np.array(sorted(patterns), np.int64)
    count = np.array([patterns[c] for c in codes.tolist()], float)
    votes = np.stack([codes // 3 ** (n_rules - 1 - j) % 3 for j in range(n_rules)], 1)     # 0 bad, 1 none, 2 good
    one = votes[:, :, None] == np.arange(3)
    any_bad = (votes == 0).any(1)
    good = np.where(any_bad, 0.1, 0.9)                      # start: any bad vote makes a document doubtful
    for _ in range(rounds):
        share, table = [], []
        for weight in (count * (1 - good), count * good):
            share.append(weight.sum() + smooth)
            table.append((np.einsum("p,pjv->jv", weight, one) + smooth) / (weight.sum() + 3 * smooth))
        bad_t, good_t = table
        alarm = np.minimum(good_t[:, 0], FALSE_ALARM)
        good_t[:, 1:] *= ((1 - alarm) / (1 - good_t[:, 0]))[:, None]
        good_t[:, 0] = alarm
        bad_t[:, 0] = np.maximum(bad_t[:, 0], alarm)        # a bad vote never speaks for a document
        score = [math.log(s) + np.einsum("jv,pjv->p", np.log(t), one) for s, t in zip(share, table)]
        score[0] = score[0] + np.where(any_bad, 0, math.log(ESCAPE))
        new = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            good = new
            break
        good = new
    return dict(zip(codes.tolist(), good.tolist()))


def posteriors(counted: DataFrame) -> dict[int, float]:
    """Posterior probability by vote pattern, fitted on all rows of a table with the columns of ``COUNTS``."""
    votes = list(rules().values())
    patterns = counted.select(pattern_code(votes).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    return fit({r["p"]: r["n"] for r in patterns.collect()}, len(votes))


def add_verdict(counted: DataFrame, posterior: dict[int, float], threshold: float = POSTERIOR) -> DataFrame:
    """Append ``posterior``, ``base_failed`` and ``kept`` to a table with the columns of ``COUNTS``."""
    lookup = F.create_map(*[F.lit(x) for kv in sorted(posterior.items()) for x in kv]) if posterior else None
    p = lookup[pattern_code(list(rules().values()))] if posterior else F.lit(None).cast("double")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (counted.withColumn("posterior", p).withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (F.coalesce("posterior", F.lit(0.0)) >= threshold)))


def judge(docs: DataFrame, text_col: str = "text", threshold: float = POSTERIOR) -> DataFrame:
    """Append counts, ``posterior``, ``base_failed`` and ``kept``.  The text passes through, so it is counted once
    for the fit and once for the result; ``judge_counts`` needs one pass where the text is not wanted."""
    narrow = add_counts(docs.select(F.col(f"`{text_col}`").alias("text")))
    return add_verdict(add_counts(docs, text_col), posteriors(narrow), threshold)


def judge_counts(docs: DataFrame, text_col: str = "text", threshold: float = POSTERIOR) -> DataFrame:
    """``judge`` without the text: counts are written once, and both the fit and the verdicts read them."""
    counted = store(add_counts(docs, text_col).drop(text_col), "quality_counts")
    return add_verdict(counted, posteriors(counted), threshold)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Verdict on every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_counts(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                     "base_failed", "kept", F.round("posterior", 6).alias("posterior"))
