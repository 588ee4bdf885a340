"""Token ids as the tokenizers library gives them, one merge per distinct word.

A text is cut into units at white space in a way that no pre-token of the
tokenizer reaches across, so a unit's ids are the same wherever it stands:

* byte-level vocabularies (a blank belongs to the word behind it): a unit is
  a run of white space with the word that follows;
* word vocabularies (white space dropped, end-of-word tokens): a unit is a
  word.

Units are named by hashes in numpy, the distinct ones of a slice are looked
up in a worker's bounded cache (emptied when full; it only saves time), and
the ids of all texts are gathered at once.

New units are merged by tiktoken's byte-pair routine over the ranks of the
given file, all in one call.  That is the library's own result where the
file's merges are in id order (checked on loading) and where both use the
same character classes: units of code points below ``SAFE``.
All other units go to the tokenizers library.  Texts that may hold a special
token, or white space other than 0x20 and 0x09-0x0D, go to it whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken

from tickhouse.llm import wordarrays as wa
from tickhouse.llm.common import buffer_of

#: code points below it have lead bytes under 0xC9 in UTF-8
SAFE, SAFE_BYTE = 0x240, 0xC9
#: but for this letter, whose lower case has two code points
DOTTED_I = "İ".encode()
CACHE = 600_000

#: UTF-8 of white space that the cut does not know (fixed values)
OTHER_SPACE = (
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


def _class(start: str) -> str:
    return "".join(
        re.escape(c) for c in map(chr, range(SAFE)) if unicodedata.category(c)[0] == start
    )


def _byte_characters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, by the published rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, .. of every range, in a row."""
    end = np.cumsum(size)
    return np.repeat(start - (end - size), size) + np.arange(len(end) and end[-1])


class Encoder:
    """Ids below 65536 of whole texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        if self.library.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary has more than 65536 ids")
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        specials = [t["content"] for t in settings["added_tokens"]]
        special = b"|".join(re.escape(s.encode()) for s in specials)
        self.whole = re.compile(OTHER_SPACE + (b"|" + special if special else b""))
        kind = (settings["normalizer"] or {}).get("type"), settings["pre_tokenizer"]["type"]
        if kind not in ((None, "ByteLevel"), ("Sequence", "Sequence")):
            raise ValueError(f"no cut is known for a tokenizer of kind {kind}")
        self.words = kind[0] is not None
        self._ranks(settings["model"], set(specials))
        self._clear()

    def _ranks(self, model: dict, specials: set[str]) -> None:
        """tiktoken over the file's own merges; a word's end becomes a blank."""
        byte = _byte_characters()
        end = model.get("end_of_word_suffix") or ""

        def raw(token: str) -> bytes:
            tail = b" " if end and token.endswith(end) else b""
            body = token[: -len(end)] if tail else token
            return bytes(byte[c] for c in body) + tail

        ranks = {raw(t): i for t, i in model["vocab"].items() if t not in specials}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [ranks.get(raw(a) + raw(b)) for a, b in merges]
        if any(i is None for i in ids) or any(i >= j for i, j in zip(ids, ids[1:], strict=False)):
            raise ValueError("the merges are not in the order of their ids")
        letter, number = _class("L"), _class("N")
        if self.words:
            self.split = re.compile(
                rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^\s{letter}{number}]+|\n"
            ).findall
            ranks.setdefault(b" ", 1 << 20)  # never left over: every last byte has an end form
            self.parting = ranks[b"\n "]  # the library never sees a line feed
            pattern = "[^ ]+ "
        else:
            pattern = (
                rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+"
                rf"| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+"
            )
        self.merger = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.length[i] = len(token)

    def _clear(self) -> None:
        """The cache: keys ascending; per key the proof and its ids' place."""
        self.keys = np.zeros(0, wa.U)
        self.proof = np.zeros(0, wa.U)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16)

    def _merged(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of plain units (byte ranges of ``data``) in a row, and how many each has."""
        size = end - start
        if self.words:  # with a line feed behind each
            ends = np.cumsum(size + 1)
            joined = np.full(ends[-1], 0x0A, np.uint8)
            keep = np.ones(len(joined), bool)
            keep[ends - 1] = False
            joined[keep] = data[ranges(start, size)]
            parts = self.split(joined.tobytes().decode().lower())
            ids = np.array(self.merger.encode_ordinary(" ".join(parts) + " "), np.int64)
            parting = ids == self.parting
            sizes = np.diff(np.flatnonzero(parting), prepend=-1) - 1
            return ids[~parting].astype(np.uint16), sizes
        text = data[ranges(start, size)].tobytes().decode()
        ids = np.array(self.merger.encode_ordinary(text), np.int64)
        bound = np.searchsorted(np.cumsum(self.length[ids]), np.cumsum(size)) + 1
        return ids.astype(np.uint16), np.diff(bound, prepend=0)

    def _learn(
        self, data: np.ndarray, keys: np.ndarray, proofs: np.ndarray, start: np.ndarray, end: np.ndarray
    ) -> None:
        outside = np.zeros(len(data) + 1, np.int64)
        odd = data >= SAFE_BYTE
        odd[:-1] |= (data[:-1] == DOTTED_I[0]) & (data[1:] == DOTTED_I[1])
        np.cumsum(odd, out=outside[1:])
        apart = outside[end] > outside[start]
        if not self.words:
            # joined with others, a unit at a text's start or end would run into them
            apart |= ~wa.WHITE[data[start]] | wa.WHITE[data[end - 1]]
        order = np.argsort(apart, kind="stable")
        plain, rest = np.split(order, [len(order) - int(apart.sum())])
        ids, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        if len(plain):
            found, size = self._merged(data, start[plain], end[plain])
            ids.append(found)
            sizes.append(size)
        units = [data[start[i] : end[i]].tobytes().decode() for i in rest]
        for e in self.library.encode_batch(units, add_special_tokens=False):
            ids.append(np.array(e.ids, np.uint16))
            sizes.append(np.array([len(e.ids)]))
        size = np.concatenate(sizes)
        place = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *ids])
        merged = np.concatenate([self.keys, keys[order]])
        by_key = np.argsort(merged, kind="stable")
        self.keys = merged[by_key]
        self.proof = np.concatenate([self.proof, proofs[order]])[by_key]
        self.start = np.concatenate([self.start, place])[by_key]
        self.size = np.concatenate([self.size, size])[by_key]

    def _unknown(self, names: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.arange(len(names))
        at = np.minimum(np.searchsorted(self.keys, names), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] != names)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row (unsigned 16 bit), and how many each has."""
        data, offsets = buffer_of(column)
        n = len(offsets) - 1
        found = [m.start() for m in self.whole.finditer(data)] if len(data) else []
        apart = np.unique(np.searchsorted(offsets, found, side="right") - 1) if found else []
        if self.words:
            words = wa.words_of(data, offsets)
            start, end, doc = words.start, words.end, words.doc
        else:
            white = wa.WHITE[data]
            opens = np.zeros(len(data) + 1, bool)
            opens[1:-1] = white[1:] & ~white[:-1]
            opens[offsets] = True
            opens[len(data)] = False
            start = np.flatnonzero(opens)
            end = np.append(start[1:], len(data))[: len(start)]
            doc = np.searchsorted(offsets, start, side="right") - 1
        keys = wa.RangeHash(data)(start, end)
        sums = np.zeros(len(data) + 1, wa.U)
        np.cumsum(wa.BYTE_VALUES[data], out=sums[1:])
        proofs = sums[end] - sums[start]  # a second hash, to notice equal keys of different units
        names, at, where = np.unique(keys, return_index=True, return_inverse=True)
        new = self._unknown(names)
        if len(new):
            if len(self.keys) + len(new) > CACHE:
                self._clear()
                new = np.arange(len(names))
            first = at[new]
            self._learn(data, names[new], proofs[first], start[first], end[first])
        own = np.searchsorted(self.keys, names)[where]
        clash = self.proof[own] != proofs if len(own) else np.zeros(0, bool)
        if clash.any():
            apart = np.union1d(apart, doc[clash]).astype(np.int64)
        sizes = self.size[own]
        ids = self.ids[ranges(self.start[own], sizes)]
        counts = np.bincount(doc, weights=sizes, minlength=n).astype(np.int64)
        if len(apart):
            ids, counts = self._spliced(column, ids, counts, apart)
        return ids, counts

    def _spliced(self, column, ids, counts, apart):  # noqa: ANN001, ANN202
        """Puts the library's ids of the texts in ``apart`` in their places."""
        texts = [column[int(i)].as_py() for i in apart]
        whole = self.library.encode_batch(texts, add_special_tokens=False)
        ends = np.cumsum(counts)
        parts, at = [], 0
        for i, e in zip(apart, whole, strict=True):
            parts += [ids[at : ends[i] - counts[i]], np.array(e.ids, np.uint16)]
            at = ends[i]
            counts[i] = len(e.ids)
        return np.concatenate([*parts, ids[at:]]), counts


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
