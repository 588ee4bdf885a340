"""SentencePiece encoding by sampling without replacement, and decoding.

*Lattice*: a text is normalised as the model does (a word mark in front and
for every blank); edges are the vocabulary pieces that match at a position,
and byte pieces for a character without a piece of its own.  An edge weighs
minus the logarithm of its merge rank, since the file's scores are ranks and
no probabilities, times ``ALPHA``; a segmentation's probability is
proportional to the product of its edges.  Where two neighbouring characters
stand side by side in no piece, no edge crosses: the lattice falls into
units, and each distinct unit's backward sums are computed once.

*Gumbel top-k*: every segmentation has a perturbed log probability, its own
plus independent Gumbel noise; the k largest are k samples without
replacement.  They are found top-down without listing segmentations: a node
is the set of segmentations that follow a path up to a position and leave it
there; its value is the largest perturbed value in it, a Gumbel variable
about the log of its mass, bounded by its parent's value.  The queue's best
node is expanded next (A-star search with exact bounds): its best
segmentation is completed by sampling forward through the lattice, and the
ways to leave the new path become nodes.

*Inclusion scores*: with the (k+1)-th value as threshold t, a segmentation of
log probability p is included with probability 1 - exp(-exp(p - t));
``log_inclusion`` is its logarithm (0 where all segmentations are sampled).

Random numbers are hashes of the row key, the sample's number and the
position, so results do not depend on partitions, batches or retries.

Cases: a null or empty text has one segmentation, without pieces; a text
with fewer than k segmentations gives all of them; equal rows give equal
samples; texts stay whole; an empty table gives no rows; further columns are
not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cached_property, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm import wordarrays as wa
from tickhouse.llm.common import BINARY, BOOL, DOUBLE, LONG, STRING, fields, text_slices, texts_of
from tickhouse.llm.token_count import MARK, bytes_of, piece_kind

SAMPLES = 2
ALPHA = 1.0
SEED = 11
SLICE = 1 << 19
#: slots and edges of distinct units a worker remembers from slice to slice (only saves time)
REMEMBERED, EDGES = 3_000_000, 8_000_000
ROOT, STEP, LEAVE, PICK = range(4)  # what a random number is for


FILTER = wa.U((1 << 18) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """``wa.mix`` in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> wa.U(shift)
        x *= wa.U(factor)
    x ^= x >> wa.U(31)
    return x


class Pieces:
    """A model's pieces as tables; built once per worker process."""

    def __init__(self, path: str, alpha: float):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        if bytes_of(sp.encode(" a  b", out_type=str)) != b"  a  b":
            raise ValueError("the model's normaliser does more than mark blanks")
        ordinary = {sp.id_to_piece(i): i for i in range(size) if piece_kind(sp, i)}
        byte = {sp.id_to_piece(i): i for i in range(size) if sp.is_byte(i)}
        self.byte_id = np.array([byte[f"<0x{b:02X}>"] for b in range(256)])
        self.byte_weight = -alpha * np.log(size + 2.0)
        self.longest = max(map(len, ordinary))
        self.units: Units | None = None
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        for n in range(1, self.longest + 1):
            own = [p for p in ordinary if len(p) == n]
            if own:
                points = code_points("".join(own))
                at = np.arange(len(own)) * n
                keys = PointHash(points)(at, at + n)
                order = np.argsort(keys)
                ids = np.array([ordinary[p] for p in own])[order]
                rank = np.array([-sp.get_score(int(i)) for i in ids])
                maybe = np.zeros(1 << 18, bool)  # a quick no for most other strings
                maybe[(keys & FILTER).astype(np.int64)] = True
                self.by_length[n] = (maybe, keys[order], ids, -alpha * np.log(rank + 2.0))
        pairs = {(a, b) for p in ordinary for a, b in zip(p, p[1:], strict=False)}
        bound = sorted({c for pair in pairs for c in pair})
        number = {c: i + 1 for i, c in enumerate(bound)}
        self.number = np.zeros(0x110000, np.int16)
        for c, i in number.items():
            self.number[ord(c)] = i
        self.near = np.zeros((len(bound) + 1, len(bound) + 1), bool)
        for a, b in pairs:
            self.near[number[a], number[b]] = True
        #: the bytes each id stands for, in a row
        raw = [b""] * size
        for p, i in ordinary.items():
            raw[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_id):
            raw[i] = bytes([b])
        self.raw_size = np.array([len(x) for x in raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of many texts' ids in a row."""
        size = self.raw_size[ids]
        data = self.raw[ranges(self.raw_start[ids], size)].tobytes()
        ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(counts))].tolist()
        return [data[s:e][1:] for s, e in zip(ends, ends[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a text's ids, without the mark put in front."""
        size = self.raw_size[ids]
        return self.raw[ranges(self.raw_start[ids], size)].tobytes()[1:]


class Edges(NamedTuple):
    """The edges of some slots: slot i has ``count[i]`` of them, by ascending size."""

    count: np.ndarray
    other: np.ndarray  # of each slot, the share of all edges but the likeliest
    log: np.ndarray
    running: np.ndarray  # summed shares of the slot's edges up to this one
    ids: np.ndarray
    size: np.ndarray


class Units:
    """Edges of distinct units, remembered by a worker until full."""

    def __init__(self, slots: int, edges: int):
        self.keys = np.zeros(0, wa.U)  # ascending
        self.start = np.zeros(0, np.int64)  # first slot of each
        self.used, self.edges = 0, 0
        self.first = np.zeros(slots + 1, np.int64)  # edge of each slot
        self.other = np.empty(slots)
        self.log = np.empty(edges, np.float32)
        self.running = np.empty(edges, np.float32)
        self.ids = np.empty(edges, np.int32)
        self.size = np.empty(edges, np.int8)

    def unknown(self, names: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.arange(len(names))
        at = np.minimum(np.searchsorted(self.keys, names), len(self.keys) - 1)
        return np.flatnonzero(self.keys[at] != names)

    def has_room(self, new: Edges) -> bool:
        return self.used + len(new.count) <= len(self.other) and self.edges + len(
            new.log
        ) <= len(self.log)

    def add(self, names: np.ndarray, length: np.ndarray, new: Edges) -> None:
        """Takes up units of ascending names."""
        at = np.searchsorted(self.keys, names)
        self.keys = np.insert(self.keys, at, names)
        self.start = np.insert(self.start, at, self.used + np.cumsum(length + 1) - length - 1)
        slots, edges = self.used + len(new.count), self.edges + len(new.log)
        self.first[self.used + 1 : slots + 1] = self.edges + np.cumsum(new.count)
        self.other[self.used : slots] = new.other
        for own, more in zip(
            (self.log, self.running, self.ids, self.size), new[2:], strict=True
        ):
            own[self.edges : edges] = more
        self.used, self.edges = slots, edges


@lru_cache(maxsize=2)
def pieces(path: str, alpha: float = ALPHA) -> Pieces:
    return Pieces(path, alpha)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    end = np.cumsum(size)
    return np.repeat(start - (end - size), size) + np.arange(len(end) and end[-1])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


class PointHash(wa.RangeHash):
    """Hashes of ranges of code points."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        values = wa.mix(points.astype(wa.U) + wa.U(1))
        self.sums = np.zeros(n + 1, wa.U)
        np.cumsum(values * wa._power("up", wa.STEP, max(n, 1))[:n], out=self.sums[1:])
        self.down = wa._power("down", wa.INVERSE, n + 1)


class Lattice:
    """Edge probabilities of some texts, per distinct unit.

    Positions are code points of all normalised texts in a row; ``slot`` of a
    position is its place in its unit, among all units remembered (a unit has
    one slot more than positions: its end).
    """

    def __init__(self, texts: list[str], own: Pieces):
        self.own = own
        normal = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        self.points = points = code_points("".join(normal))
        self.begin = np.cumsum([0, *map(len, normal)])
        n = len(points)
        number = own.number[points]
        cut = np.ones(n, bool)
        cut[1:] = ~own.near[number[:-1], number[1:]]
        cut[self.begin[:-1][self.begin[:-1] < n]] = True
        self.unit = np.flatnonzero(cut)
        self.unit_end = np.append(self.unit[1:], n)[: len(self.unit)]
        size = self.unit_end - self.unit
        hashed = PointHash(points)
        names, first, which = np.unique(
            hashed(self.unit, self.unit_end), return_index=True, return_inverse=True
        )
        length = size[first]
        if own.units is None:
            own.units = Units(REMEMBERED, EDGES)
        new = own.units.unknown(names)
        if len(new):
            edges = self._edges(hashed, self.unit[first[new]], length[new])
            if not own.units.has_room(edges):
                new = np.arange(len(names))
                edges = self._edges(hashed, self.unit[first], length)
                own.units = Units(
                    max(REMEMBERED, len(edges.count)), max(EDGES, len(edges.log))
                )
            own.units.add(names[new], length[new], edges)
        self.units = own.units
        start = self.units.start[np.searchsorted(self.units.keys, names)]
        self.slot = np.repeat(start[which], size) + ranges(np.zeros(len(size), np.int64), size)

    def table(self, slot: np.ndarray) -> np.ndarray:
        """Log probabilities of the edges of some slots, by size; no edge: -inf."""
        units = self.units
        first, count = units.first[slot], units.first[slot + 1] - units.first[slot]
        edge = ranges(first, count)
        out = np.full((len(slot), self.own.longest), -np.inf, np.float32)
        out[np.repeat(np.arange(len(slot)), count), units.size[edge] - 1] = units.log[edge]
        return out

    @cached_property
    def log(self) -> np.ndarray:
        """``table`` of all slots."""
        return self.table(np.arange(self.units.used))

    def edge(self, slot: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The edges of these sizes at some slots."""
        found = self.units.first[slot]
        rest = np.arange(len(slot))
        while len(rest := rest[self.units.size[found[rest]] != size[rest]]):
            found[rest] += 1
        return found

    def _edges(self, hashed: PointHash, at: np.ndarray, length: np.ndarray) -> Edges:
        """The edges of units, slot by slot."""
        own = self.own
        slots = int((length + 1).sum())
        left = np.repeat(length, length + 1) - ranges(np.zeros(len(length), np.int64), length + 1)
        place = np.repeat(at + length, length + 1) - left
        count = np.zeros(slots, np.int64)
        rows = np.flatnonzero(left)
        room, begin = left[rows], place[rows]
        before, down = hashed.sums[begin], hashed.down[begin]
        parts = []  # of each size: slots, their edges' ranks there, weights, ids
        for n in range(1, own.longest + 1):
            if n > 1:
                more = np.flatnonzero(room >= n)
                rows, room, begin, before, down = (x[more] for x in (rows, room, begin, before, down))
            if not len(rows):
                break
            if n not in own.by_length:
                hit, weight, found = (np.zeros(0, t) for t in ("i8", "f8", "i8"))
            else:
                maybe, keys, ids, weights = own.by_length[n]
                key = mixed((hashed.sums[begin + n] - before) * down + wa.U(n))
                some = np.flatnonzero(maybe[(key & FILTER).view(np.int64)])
                key = key[some]
                at_key = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                same = np.flatnonzero(keys[at_key] == key)
                hit, weight, found = rows[some[same]], weights[at_key[same]], ids[at_key[same]]
            if n == 1:  # a character without a piece of its own has byte pieces
                alone = np.ones(slots, bool)
                alone[hit] = False
                alone = rows[alone[rows]]
                byte = own.byte_weight * utf8_size(self.points[place[alone]])
                hit, weight = np.append(hit, alone), np.append(weight, byte)
                found = np.append(found, np.full(len(alone), -1))
            parts.append((hit, count[hit], weight.astype(np.float32), found))
            count[hit] += 1
        first = np.cumsum(count) - count
        log = np.empty(int(count.sum()), np.float32)
        found_ids, size = np.empty(len(log), np.int32), np.empty(len(log), np.int8)
        for n, (hit, rank, weight, found) in enumerate(parts, start=1):
            edge = first[hit] + rank
            log[edge], found_ids[edge], size[edge] = weight, found, n
        # log of the summed weight of all ways from a slot to its unit's end
        total = np.zeros(slots)
        ends = np.repeat(np.arange(slots), count) + size
        farthest = int(length.max(initial=0))
        short = left.astype(np.uint16) if farthest < 1 << 16 else left  # sorted by radix
        order = np.argsort(short, kind="stable")
        bounds = np.searchsorted(short[order], np.arange(1, farthest + 2))
        for s, e in itertools.pairwise(bounds.tolist()):
            rows = order[s:e]
            many = count[rows]
            edge = ranges(first[rows], many)
            where = np.cumsum(many) - many
            value = log[edge] + total[ends[edge]]
            top = np.maximum.reduceat(value, where)
            value -= np.repeat(top, many)
            total[rows] = top + np.log(np.add.reduceat(np.exp(value, out=value), where))
        log += total[ends] - np.repeat(total, count)
        running, share = np.exp(log), np.exp(log, dtype="f8")
        other, best = np.zeros(slots), np.zeros(slots)
        rows = np.flatnonzero(count)
        for rank in range(int(count.max(initial=0))):
            rows = rows[count[rows] > rank]
            edge = first[rows] + rank
            if rank:
                running[edge] += running[edge - 1]
            high, this = best[rows], share[edge]
            other[rows] += np.minimum(high, this)
            best[rows] = np.maximum(high, this)
        return Edges(count, other, log, running, found_ids, size)


def utf8_size(points: np.ndarray) -> np.ndarray:
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


class Sampler:
    """k samples without replacement of every text of a lattice."""

    def __init__(self, lattice: Lattice, keys: np.ndarray, seed: int):
        self.lattice = lattice
        self.n = len(lattice.points)
        begin = lattice.begin
        self.doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        self.keys = wa.mix(
            keys.astype(np.int64).view(wa.U) + wa.U(seed * int(wa.STEP) & (1 << 64) - 1)
        )
        self.some = np.flatnonzero(np.diff(begin) > 0)  # texts with positions
        self.place = np.arange(self.n, dtype=wa.U) - np.repeat(begin[:-1], np.diff(begin)).view(wa.U)
        self.place *= wa.U(1 << 20)

    def random(self, doc: np.ndarray, at: np.ndarray | None, turn: int, purpose: int) -> np.ndarray:
        """Uniform in (0, 1), by row key, position in the text (None: its begin), sample and
        purpose."""
        place = np.zeros(len(doc), wa.U) if at is None else self.place[at]
        place += wa.U(turn * 4 + purpose + 1)
        value = mixed(place)
        value ^= self.keys[doc]
        value = mixed(value)
        value >>= wa.U(11)
        number = value.astype("f8")
        number += 0.5
        number /= 1 << 53
        return np.minimum(number, 1 - 2.0**-53, out=number)  # the largest ones round to 1

    def walk(
        self, path: np.ndarray, edges: np.ndarray, at: np.ndarray, stop: np.ndarray, turn: int
    ) -> None:
        """Samples edges from each position until its unit's end; writes lengths into ``path``
        and the edges' numbers into ``edges``."""
        units, slots = self.lattice.units, self.lattice.slot
        while len(at):
            slot = slots[at]
            edge = units.first[slot]
            u = self.random(self.doc[at], at, turn, STEP)
            u *= units.running[units.first[slot + 1] - 1]
            rest = np.flatnonzero(units.running[edge] <= u)
            e, high = edge[rest] + 1, u[rest]
            while len(rest):
                edge[rest] = e
                more = np.flatnonzero(units.running[e] <= high)
                rest, e, high = rest[more], e[more] + 1, high[more]
            size = units.size[edge]
            path[at] = size
            edges[at] = edge
            at = at + size
            more = at < stop
            at, stop = at[more], stop[more]

    def values(
        self,
        edges: np.ndarray,
        token: np.ndarray,
        some: np.ndarray | slice,
        out: np.ndarray,
        bound: np.ndarray,
        turn: int,
    ) -> None:
        """Perturbed values of the nodes, below ``bound`` of their text.

        ``edges``: those of the path; ``token``: its positions; ``some``: which of them are nodes.
        """
        lattice = self.lattice
        step = lattice.units.log[edges[token]].astype("f8")
        sums = np.append(0.0, np.cumsum(step))
        first = sums[np.searchsorted(token, lattice.begin[:-1])]
        nodes = token[some]
        doc = self.doc[nodes]
        mass = sums[:-1][some] - first[doc]
        taken = np.exp(step[some])
        # exact where the likeliest edge is taken: the share of all others
        rest = np.where(taken > 0.5, lattice.units.other[lattice.slot[nodes]], 1 - taken)
        with np.errstate(divide="ignore"):
            mass += np.log(rest, out=rest)
            noise = self.random(doc, nodes, turn, LEAVE)
            np.negative(np.log(noise, out=noise), out=noise)
            np.log(noise, out=noise)
        noise -= mass
        out[nodes] = -np.logaddexp(-bound[doc], noise)

    def run(self, k: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Paths of the samples (edge length at each token's position), the
        perturbed value of each sample and text, and the threshold of each text;
        ``edges`` then has the edges of each path."""
        lattice, docs = self.lattice, len(self.lattice.begin) - 1
        starts = lattice.begin[:-1]
        path, edges = np.zeros(self.n, np.int8), np.zeros(self.n, np.int64)
        self.edges = [edges]
        self.walk(path, edges, lattice.unit, lattice.unit_end, 0)
        everyone = np.arange(docs)
        value = -np.log(-np.log(self.random(everyone, None, 0, ROOT)))
        paths, found = [path], [value]
        front = [np.full(self.n, -np.inf)]
        left_by = [np.zeros(self.n, np.uint64)]  # the edges a node excludes, as bits
        token = np.flatnonzero(path)
        self.values(edges, token, slice(None), front[0], value, 0)
        left_by[0][token] = np.uint64(1) << (path[token] - 1).astype(np.uint64)
        for turn in range(1, k + 1):
            best = np.full(docs, -np.inf)
            parent = np.zeros(docs, np.int64)
            if self.n:
                for j, f in enumerate(front):
                    top = np.maximum.reduceat(f, starts[self.some])
                    better = top > best[self.some]
                    parent[self.some[better]] = j
                    best[self.some[better]] = top[better]
            if turn == k:
                return paths, np.array(found), best
            found.append(best)
            path, edges = np.zeros(self.n, np.int8), np.zeros(self.n, np.int64)
            open_ = np.flatnonzero(best > -np.inf)
            branch = np.full(docs, -1)
            for j, f in enumerate(front):
                mine = np.flatnonzero((f == best[self.doc]) & (parent[self.doc] == j) & (f > -np.inf))
                doc, first = np.unique(self.doc[mine], return_index=True)
                branch[doc] = mine[first]
            at = branch[open_]
            upto = np.zeros(docs, np.int64)
            upto[open_] = at
            for j, old in enumerate(paths):
                same = (np.arange(self.n) < upto[self.doc]) & (parent[self.doc] == j)
                path[same] = old[same]
                edges[same] = self.edges[j][same]
            # another edge at the branch than those the node excludes
            slot = lattice.slot[at]
            share = np.exp(lattice.table(slot).astype("f8"))
            excluded = np.array([left_by[p][b] for p, b in zip(parent[open_], at, strict=True)], np.uint64)
            bits = np.uint64(1) << np.arange(share.shape[1], dtype=np.uint64)
            share[(excluded[:, None] & bits) != 0] = 0
            running = np.cumsum(share, axis=1)
            u = self.random(open_, at, turn, PICK) * running[:, -1]
            size = (running <= u[:, None]).sum(axis=1) + 1
            path[at] = size
            edges[at] = lattice.edge(slot, size)
            number = np.searchsorted(lattice.unit, at, side="right") - 1
            goes_on = at + size < lattice.unit_end[number]
            later = np.zeros(docs, np.int64) + self.n + 1
            later[open_] = lattice.unit_end[number]
            fresh = lattice.unit >= later[self.doc[lattice.unit]] if self.n else np.zeros(0, bool)
            self.walk(
                path,
                edges,
                np.concatenate([(at + size)[goes_on], lattice.unit[fresh]]),
                np.concatenate([lattice.unit_end[number][goes_on], lattice.unit_end[fresh]]),
                turn,
            )
            # the node keeps what it has not given away yet
            for j in range(len(front)):
                own = parent[open_] == j
                spots = at[own]
                left_by[j][spots] |= np.uint64(1) << (size[own] - 1).astype(np.uint64)
                rest = np.exp(lattice.table(lattice.slot[spots]).astype("f8"))
                rest[(left_by[j][spots][:, None] & bits) != 0] = 0
                tokens = np.flatnonzero(paths[j])
                steps = lattice.units.log[self.edges[j][tokens]]
                sums = np.append(0.0, np.cumsum(steps, dtype="f8"))
                lead = sums[np.searchsorted(tokens, spots)] - sums[
                    np.searchsorted(tokens, lattice.begin[self.doc[spots]])
                ]
                with np.errstate(divide="ignore"):
                    mass = lead + np.log(rest.sum(axis=1))
                    noise = np.log(-np.log(self.random(self.doc[spots], spots, turn, ROOT)))
                front[j][spots] = -np.logaddexp(-best[self.doc[spots]], noise - mass)
            front.append(np.full(self.n, -np.inf))
            left_by.append(np.zeros(self.n, np.uint64))
            token = np.flatnonzero(path)
            some = np.flatnonzero(token > branch[self.doc[token]])
            self.values(edges, token, some, front[-1], best, turn)
            token = token[some]
            left_by[-1][token] = np.uint64(1) << (path[token] - 1).astype(np.uint64)
            paths.append(path)
            self.edges.append(edges)
        raise AssertionError("unreachable")


def token_ids(
    lattice: Lattice, path: np.ndarray, edges: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece ids of all texts in a row, ids per text, log probability per text.

    ``edges``: those of the path, if they are at hand.
    """
    docs = len(lattice.begin) - 1
    token = np.flatnonzero(path)
    doc = np.repeat(np.arange(docs), np.diff(np.searchsorted(token, lattice.begin)))
    edge = lattice.edge(lattice.slot[token], path[token]) if edges is None else edges[token]
    log = np.bincount(doc, weights=lattice.units.log[edge], minlength=docs)
    ids = lattice.units.ids[edge].astype(np.int64)
    byte = np.flatnonzero(ids < 0)
    repeat = np.ones(len(ids), np.int64)
    repeat[byte] = utf8_size(lattice.points[token[byte]])
    out = np.repeat(ids, repeat)
    if len(byte):
        raw = np.frombuffer("".join(map(chr, lattice.points[token[byte]])).encode(), np.uint8)
        out[out < 0] = lattice.own.byte_id[raw]
    return out, np.bincount(doc, weights=repeat, minlength=docs).astype(np.int64), log


RESULTS = fields(
    sample=LONG,
    n_tokens=LONG,
    log_prob=DOUBLE,
    perturbed=DOUBLE,
    log_inclusion=DOUBLE,
    decodes=BOOL,
    ids=BINARY,
)


def log_inclusion(log_prob: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(log_prob - threshold)))."""
    gap = np.where(threshold == -np.inf, np.inf, log_prob - threshold)
    with np.errstate(over="ignore", divide="ignore"):
        odds = np.exp(np.minimum(gap, 700.0))
        return np.where(gap < -30, gap, np.log(-np.expm1(-odds)))


def segmentations(
    docs: DataFrame,
    model_path: str,
    samples: int = SAMPLES,
    alpha: float = ALPHA,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and sample: key, sample (1 ..), n_tokens, log_prob,
    perturbed, log_inclusion, decodes (whether the ids decode to the text, marks
    as blanks), ids (unsigned 16 bit, little endian)."""
    source = docs.select(
        F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.xxhash64(key).alias("seed")
    )
    schema = T.StructType([T.StructField(key, source.schema["key"].dataType), *RESULTS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model_path, alpha)
        for batch in batches:
            for at, n in text_slices(batch.column(1), SLICE):
                rows = batch.slice(at, n)
                texts = texts_of(rows.column(1))
                lattice = Lattice(texts, own)
                sampler = Sampler(lattice, rows.column(2).to_numpy(), seed)
                paths, values, threshold = sampler.run(samples)
                plain = [t.replace(MARK, " ").encode() for t in texts]
                for turn, path in enumerate(paths):
                    there = np.flatnonzero(values[turn] > -np.inf)
                    ids, sizes, log = token_ids(lattice, path, sampler.edges[turn])
                    ends = 2 * np.cumsum(sizes)
                    raw = ids.astype("<u2").tobytes()
                    starts = ends - 2 * sizes
                    back = own.decode_all(ids, sizes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column(0).take(pa.array(there)),
                            pa.array(np.full(len(there), turn + 1)),
                            pa.array(sizes[there]),
                            pa.array(log[there]),
                            pa.array(values[turn][there]),
                            pa.array(log_inclusion(log, threshold)[there]),
                            pa.array([back[i] == plain[i] for i in there], pa.bool_()),
                            pa.array([raw[starts[i] : ends[i]] for i in there], pa.binary()),
                        ],
                        names=schema.names,
                    )

    return source.mapInArrow(run, schema)


def decoded(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with the text their ids stand for in a further column ``text``."""

    @F.pandas_udf(STRING)
    def run(column):  # noqa: ANN001, ANN202
        own = pieces(model_path)
        return column.map(
            lambda x: own.decode(np.frombuffer(x, "<u2").astype(np.int64)).decode(errors="replace")
        )

    return rows.withColumn(text, run(F.col(ids)))
