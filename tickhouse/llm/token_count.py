"""Token counts with a whole-token shortcut.

A text is cut into pre-tokens at places no vocabulary piece reaches across,
so the library's merges never cross a cut and the counts of the pre-tokens
add up to the count of the text:

* *cuts, proved offline from the vocabulary*: two adjacent characters that
  stand side by side in no piece can never end up in one token.  From the
  vocabulary's pairs one regular expression is built; it cuts before every
  word mark that follows another character, and on both sides of characters
  that occur in no piece of two or more characters.
* *whole tokens, proved offline*: every vocabulary string is encoded alone
  once; those that come out as one token are counted directly whenever a
  pre-token equals them.
* only the remaining pre-tokens are merged by the library, each distinct
  one once per worker while it stays in a bounded cache (the cache only
  saves time: it is emptied when full).

Cases: a null or empty text has 0 tokens; texts of any length are counted
whole; repeated rows are counted one by one; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import LONG, fields, map_texts, texts_of

MARK = "▁"  # the word mark that stands for a space
CACHE = 500_000
RESULTS = fields(n_bytes=LONG, n_tokens=LONG, n_whole=LONG)


def piece_kind(sp: sentencepiece.SentencePieceProcessor, i: int) -> bool:
    """Whether piece i is an ordinary one (no control, unknown or byte piece)."""
    return not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))


class PieceCounter:
    """Counts for one model; built once per worker process."""

    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.sp.get_piece_size()
        self.pieces = [self.sp.id_to_piece(i) for i in range(size) if piece_kind(self.sp, i)]
        # the split below relies on a normaliser that only adds and escapes spaces
        probe = " a  b\tc ﬁéé Ａ"
        plain = self.sp.encode(probe, out_type=str)
        self.identity = bytes_of(plain) == (" " + probe).encode()
        self.split = re.compile(cut_pattern(self.pieces)).findall
        self.whole = self._whole_tokens()
        self.cache: dict[str, int] = dict(self.whole)

    def _alone(self, parts: list[str]) -> list[int]:
        """Token counts of pre-tokens as they stand inside a text.

        The library puts a word mark before whatever it encodes.  A part
        that begins with the mark gets exactly that one; any other part
        goes behind a line feed, which is a token of its own.
        """
        texts = [p[1:] if p[0] == MARK else "\n" + p for p in parts]
        # a part that is only marks would lose its own mark to an empty text
        counts = [len(ids) for ids in self.sp.encode(texts, num_threads=1)]
        return [
            1 if p == MARK else c if p[0] == MARK else c - 2
            for p, c in zip(parts, counts, strict=True)
        ]

    def _whole_tokens(self) -> dict[str, int]:
        parts = [p for p in self.pieces if self.split(p) == [p]]
        return {p: 1 for p, c in zip(parts, self._alone(parts), strict=True) if c == 1}

    def count(self, text: str) -> tuple[int, int]:
        """(tokens, pre-tokens that are whole tokens) of one text."""
        if not text:
            return 0, 0
        if not self.identity:
            return len(self.sp.encode(text)), 0
        parts = self.split(MARK + text.replace(" ", MARK))
        found = list(map(self.cache.get, parts))
        if None in found:
            new = list({p for p, c in zip(parts, found, strict=True) if c is None})
            if len(self.cache) + len(new) > CACHE:
                self.cache = dict(self.whole)
            known = dict(zip(new, self._alone(new), strict=True))
            found = [known[p] if c is None else c for p, c in zip(parts, found, strict=True)]
            self.cache.update(known)
        return sum(found), found.count(1)


def bytes_of(pieces: list[str]) -> bytes:
    """The bytes that pieces stand for (byte pieces included)."""
    out = b""
    for p in pieces:
        byte = re.fullmatch(r"<0x([0-9A-F]{2})>", p)
        out += bytes([int(byte[1], 16)]) if byte else p.replace(MARK, " ").encode()
    return out


def cut_pattern(pieces: list[str]) -> str:
    """A pattern whose matches are the pre-tokens, proved against ``pieces``.

    Characters fall into: the mark; *bound* ones, which occur in some piece
    of two or more characters; all others, which stand alone.  Bound
    characters are split further between letters and the rest where no
    piece holds a letter next to such a character.
    """
    pairs = {(a, b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
    if any(b == MARK and a != MARK for a, b in pairs):
        raise ValueError("a piece reaches across a word mark: no cut is proved")
    bound = {c for pair in pairs for c in pair} - {MARK}
    letter = {c for c in bound if unicodedata.category(c)[0] in "LM"}
    # a character that never stands next to a letter in a piece can be cut from letters
    near = {b for a, b in pairs if a in letter} | {a for a, b in pairs if b in letter}
    apart = bound - letter - near
    kinds = [sorted(bound - apart), sorted(apart)]
    body = "|".join(f"[{''.join(map(re.escape, k))}]+" for k in kinds if k)
    after_mark = {b for a, b in pairs if a == MARK and b != MARK}
    loose = sorted(apart - after_mark)
    guard = f"(?![{''.join(map(re.escape, loose))}])" if loose else ""
    return f"(?s){MARK}+(?:{guard}(?:{body}))?|{body}|." if body else f"(?s){MARK}+|."


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(
    docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: UTF-8 bytes, tokens, pre-tokens counted whole.

    ``model_path`` is the model file's place on every executor.  No shuffle.
    """

    def work(column: pa.Array) -> dict[str, object]:
        texts = texts_of(column)
        counts = np.array([counter(model_path).count(t) for t in texts]).reshape(-1, 2)
        return {
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": counts[:, 0],
            "n_whole": counts[:, 1],
        }

    return map_texts(docs, work, RESULTS, key, text)


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
