"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths over words, and hashes of lines,
give for each text how many of its word characters lie inside n-grams that
occur twice or more, and how many lie in lines equal to an earlier line.
Each length has its own limit (``NGRAM_LIMITS``: longer n-grams, lower
limit; the values published for web text filters), lines have
``LINE_LIMIT``.  A text over any limit is not kept.

All texts of a slice are handled together in numpy; a longer n-gram can
only repeat where the shorter one at the same place repeats, so all but the
first length look at few windows.  Runs where the rows are read: no
shuffle, memory of one slice.

Cases: a null or empty text, or one without words, has zero counts and
fails the rule of ten words; ties and repeated rows are judged one by one;
an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickhouse.llm import wordarrays as wa
from tickhouse.llm.common import BOOL, DOUBLE, LONG, buffer_of, fields, map_texts

#: share of word characters allowed inside repeated n-grams, by n
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: share of word characters allowed in lines equal to an earlier line
LINE_LIMIT = 0.20
MIN_WORDS = 10
WINDOW = 5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

RESULTS = fields(
    n_words=LONG,
    word_chars=LONG,
    n_symbols=LONG,
    n_dup_lines=LONG,
    n_repeat_words=LONG,
    base_failed=BOOL,
    kept=BOOL,
    dup_line_share=DOUBLE,
    dup_ngram_share=DOUBLE,
    dup_ngram_length=LONG,
)


def _cover(flags: np.ndarray, at: np.ndarray, n: int) -> None:
    """Mark the n words from each position."""
    for j in range(n):
        flags[at + j] = True


def measure(
    column: pa.Array,
    ngram_limits: dict[int, float] = NGRAM_LIMITS,
    line_limit: float = LINE_LIMIT,
) -> dict[str, np.ndarray]:
    data, offsets = buffer_of(column)
    n_docs = len(offsets) - 1
    words = wa.words_of(data, offsets)
    ranges = wa.RangeHash(data)
    n_words = np.diff(words.first)

    lead = np.zeros(len(data) + 1, np.int64)  # code points of words before each byte
    np.cumsum(~wa.WHITE[data] & ((data & 0xC0) != 0x80), out=lead[1:])
    symbols = np.zeros(len(data) + 1, np.int64)
    np.cumsum(SYMBOLS[data], out=symbols[1:])
    word_chars = lead[offsets[1:]] - lead[offsets[:-1]]
    n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]
    chars = lead[words.end] - lead[words.start]

    # lines: cut at \n and at text ends; those with a word, hashed with their text's number
    feeds = np.flatnonzero(data == 0x0A)
    line_start = np.concatenate([offsets[:-1], feeds + 1])
    line_doc = np.concatenate(
        [np.arange(n_docs), np.searchsorted(offsets, feeds, side="right") - 1]
    )
    order = np.lexsort((line_start, line_doc))
    line_start, line_doc = line_start[order], line_doc[order]
    stop = np.append(line_start[1:] - 1, 0)
    last = np.append(line_doc[1:] != line_doc[:-1], True) if n_docs else np.zeros(0, bool)
    line_end = np.where(last, offsets[line_doc + 1], stop) if n_docs else line_start
    has_word = lead[line_end] > lead[line_start]
    line_start, line_end, line_doc = line_start[has_word], line_end[has_word], line_doc[has_word]
    salt = wa.mix(line_doc.astype(wa.U) + wa.U(1))
    keys = ranges(line_start, line_end) ^ salt
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order][1:] == keys[order][:-1]
    n_dup_lines = wa.per_doc(line_doc[again], n_docs)
    line_chars = wa.per_doc(
        line_doc[again], n_docs, (lead[line_end] - lead[line_start])[again].astype("f8")
    )

    # windows of words
    values = ranges(words.start, words.end)
    salt = wa.mix(words.doc.astype(wa.U) + wa.U(1))
    keys, at = wa.windows(values, words.doc, WINDOW)
    at = at[wa.repeated(keys ^ salt[at])]
    covered = np.zeros(len(values), bool)
    _cover(covered, at, WINDOW)
    n_repeat_words = wa.per_doc(words.doc[covered], n_docs)

    worst = np.zeros(n_docs)
    worst_n = np.zeros(n_docs, np.int64)
    kept = np.ones(n_docs, bool)
    total = np.maximum(word_chars, 1)
    for n, limit in sorted(ngram_limits.items()):
        if n >= WINDOW:
            # only where the shorter window repeats can the longer one repeat
            at = at[at + n <= len(values)]
            at = at[words.doc[at] == words.doc[at + n - 1]]
            value = values[at].copy()
            for j in range(1, n):
                value = value * wa.STEP + values[at + j]
            at = at[wa.repeated(wa.mix(value) ^ salt[at])]
            here = at
        else:
            keys, here = wa.windows(values, words.doc, n)
            here = here[wa.repeated(keys ^ salt[here])]
        covered = np.zeros(len(values), bool)
        _cover(covered, here, n)
        share = wa.per_doc(words.doc[covered], n_docs, chars[covered].astype("f8")) / total
        kept &= share <= limit
        worst_n = np.where(share > worst, n, worst_n)
        worst = np.maximum(worst, share)
    line_share = line_chars / total
    kept &= line_share <= line_limit
    failed = (n_words < MIN_WORDS) | (100 * n_repeat_words > 20 * n_words)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words,
        "base_failed": failed,
        "kept": kept & ~failed,
        "dup_line_share": line_share,
        "dup_ngram_share": worst,
        "dup_ngram_length": worst_n,
    }


def repetition_coverage(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ngram_limits: dict[int, float] | None = None,
    line_limit: float = LINE_LIMIT,
) -> DataFrame:
    """One row per document: counts, repetition shares and the verdict ``kept``."""
    limits = dict(NGRAM_LIMITS if ngram_limits is None else ngram_limits)
    return map_texts(docs, lambda c: measure(c, limits, line_limit), RESULTS, key, text)
