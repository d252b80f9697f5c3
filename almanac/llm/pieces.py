"""Merge-type piece encoding with seeded merge-dropout, and its lossless decoding.

A block of texts is cut where no piece of the vocabulary can cross. Every occurrence of a stretch draws which of
its candidate merges it skips. One that skips none of the merges that the stretch goes through without dropout comes
to the same pieces; others that skip the same candidates are segmented once a worker, many side by side: a matrix of
the candidate merges of each is its agenda, and each round applies every stretch's best merge. Occurrences then take
their ids by index.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.frames import texts_to_python
from almanac.llm.words import mix, powers, release, span_hashes, text_blocks

SPACE = "▁"
NONE = np.int32(2**31 - 1)
STORED_IDS = 1_000_000
SIDE_BY_SIDE = 200
CELLS = 1 << 18
SHORT = 24
PIECE_BITS = 24
CANDIDATE_BITS = PIECE_BITS + 8
DRAWN = 1 << 15
MET = 1 << 22
LISTED_BYTES = 1 << 17
BLOCK_BYTES = 1 << 19
# Byte classes: 0 space, 1 letters, 2 digits, 3 other ASCII, 4 beyond ASCII.
CLASSES = np.full(256, 3, dtype=np.uint8)
CLASSES[0x20] = 0
CLASSES[0x30:0x3A] = 2
CLASSES[0x41:0x5B] = CLASSES[0x61:0x7B] = 1
CLASSES[0x80:] = 4


def _cuts(data: np.ndarray, fine: bool) -> np.ndarray:
    """Byte places where a stretch may begin: before spaces, and (fine) where the class of ASCII bytes changes."""
    kind = CLASSES[data]
    before, here = kind[:-1], kind[1:]
    cut = (here == 0) & (before != 0)
    if fine:
        cut |= (before != here) & (before != 0) & (here != 0) & (before != 4) & (here != 4)
    return np.flatnonzero(cut) + 1


def _candidate(stretch: np.ndarray, left: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """One number for the candidate that makes `piece` from character `left` of a short stretch on."""
    return stretch.astype(np.int64) << CANDIDATE_BITS | left.astype(np.int64) << PIECE_BITS | piece


def _running(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a text, and the running sums from which the hash of any of its spans comes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    total = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * powers(len(points) + 1)[0][:-1], out=total[1:])
    return points, total


class Lookup:
    """Numbers by 64-bit key, found for many keys at once: slots by hash, the next free one where that is taken."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, none: int):
        keys = keys.astype(np.uint64)
        bits = max(8, int(len(keys) * 4).bit_length())
        self.shift, self.mask, self.none, self.probes = np.uint64(64 - bits), (1 << bits) - 1, np.int32(none), 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, none, np.int32)
        used, rest = np.zeros(1 << bits, bool), np.arange(len(keys))
        at = self._slots(keys)
        while len(rest):
            self.probes += 1
            free = rest[~used[at[rest]]]
            won = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[won]], self.values[at[won]], used[at[won]] = keys[won], values[won], True
            rest = np.setdiff1d(rest, won)
            at[rest] = (at[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        at = self._slots(keys)
        out = np.where(self.keys[at] == keys, self.values[at], self.none)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.values[at] != self.none))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            held = self.keys[at[open_]]
            met = held == keys[open_]
            out[open_[met]] = self.values[at[open_[met]]]
            open_ = open_[~met & (self.values[at[open_]] != self.none)]
        return out


class Coder:
    """Encoder and decoder for one vocabulary of merge pieces with byte fallback."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_ids: list[int], prefix: bool, seed: int, dropout: float):
        ids = {piece: i for piece, _, i in pieces}
        by_rank = sorted(pieces, key=lambda p: (-p[1], p[2]))
        rank = {i: n for n, (_, _, i) in enumerate(by_rank)}
        self.piece_of = np.array([i for _, _, i in by_rank], dtype=np.int32)
        splits = {}
        for piece, _, i in pieces:
            for at in range(1, len(piece)):
                left, right = ids.get(piece[:at]), ids.get(piece[at:])
                if left is not None and right is not None:
                    splits[left << 32 | right] = rank[i]
        self.pairs = np.array(sorted(splits), dtype=np.int64)
        self.ranks = np.array([splits[p] for p in sorted(splits)], dtype=np.int32)
        self.rank_of = Lookup(self.pairs, self.ranks, NONE)
        self.byte_ids, self.prefix = byte_ids, prefix
        # A literal mark must not read as a space, so it is no symbol of its own and falls back to bytes.
        self.symbol = np.full(0x110000, -1, dtype=np.int32)
        self.symbol[:128] = byte_ids[:128]
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(" " if piece == SPACE else piece)] = i
        raw = {i: piece.replace(SPACE, " ").encode() for piece, _, i in pieces}
        raw.update({i: bytes([b]) for b, i in enumerate(byte_ids)})
        # The bytes of all pieces end to end, by id.
        every = [raw.get(i, b"") for i in range(max(raw) + 1)]
        self.spelling = np.frombuffer(b"".join(every), dtype=np.uint8)
        self.spelled_to = np.cumsum([0, *map(len, every)]).astype(np.int32)
        spelled = [raw[i] for i in ids.values()]
        heads = np.cumsum([0, *map(len, spelled)])
        joined = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.fine, self.whole = (bool(len(np.setdiff1d(_cuts(joined, how), heads))) for how in (True, False))
        self.fine = not self.fine
        self.seed = np.uint64(seed & (2**64 - 1))
        self.skip_below = np.uint64(int(dropout * 2**32))
        sizes = np.array([len(piece) for piece in ids], dtype=np.int64)
        points, total = _running("".join(ids))
        ends = np.cumsum(sizes)
        named = mix((total[ends] - total[ends - sizes]) * powers(len(points) + 1)[1][ends - sizes] + sizes.astype(np.uint64))
        self.piece_named = Lookup(named, np.array(list(ids.values()), dtype=np.int32), -1)
        self.longest = int(sizes.max(initial=0))
        self.forget()
        self.forget_candidates()

    def forget(self) -> None:
        """Drop the stored stretches: their names in order, their numbers, and the ids of all end to end."""
        self.names, self.numbers = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.flat, self.bounds = np.empty(0, np.int32), np.zeros(1, np.int32)

    def forget_candidates(self) -> None:
        """Drop the listed candidates: names of stretches in order, their numbers, the candidates of all end to end."""
        self.known, self.places = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.marks, self.spans = np.empty(0, np.uint64), np.zeros(1, np.int64)
        self.met = np.zeros(MET, bool)  # by hash, so a stretch may be taken for met before
        self.taken = np.empty(0, bool)  # candidates that are merged where nothing is skipped
        self.long = np.empty(0, bool)  # a long stretch lists none

    # -- one stretch -------------------------------------------------------------------------------------

    def _marks(self, left: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Hash of the candidate that makes `piece` from character `left` on."""
        return mix(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + piece.astype(np.uint64))

    def _skips(self, own: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return (mix(marks ^ own) >> np.uint64(32)) < self.skip_below

    def _skipped(self, own: np.ndarray, left: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether the candidate that makes `piece` from character `left` on is skipped, by keyed hash."""
        return self._skips(own, self._marks(left, piece))

    def agenda(self, text: str, own: int) -> list[int]:
        """Ids of one long stretch: a heap of candidate merges, best first and leftmost among equals."""
        symbols = self.symbol[[ord(c) for c in text]].tolist()
        last = len(symbols)
        after, before = list(range(1, last + 1)), list(range(-1, last - 1))
        heap: list[tuple[int, int, int, int, int]] = []
        key = np.array([own], dtype=np.uint64)

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < last and symbols[left] >= 0 and symbols[right] >= 0:
                pair = symbols[left] << 32 | symbols[right]
                at = min(int(self.pairs.searchsorted(pair)), len(self.pairs) - 1)
                if self.pairs[at] == pair:
                    heapq.heappush(heap, (int(self.ranks[at]), left, right, symbols[left], symbols[right]))

        for i in range(last - 1):
            offer(i, i + 1)
        while heap:
            rank, left, right, a, b = heapq.heappop(heap)
            if symbols[left] != a or symbols[right] != b or after[left] != right:
                continue
            piece = int(self.piece_of[rank])
            if self.skip_below and self._skipped(key, np.array([left]), np.array([piece]))[0]:
                continue
            symbols[left], symbols[right] = piece, -2
            after[left] = after[right]
            if after[right] < last:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        out: list[int] = []
        for i, s in enumerate(symbols):
            if s >= 0:
                out.append(s)
            elif s == -1:
                out += [self.byte_ids[b] for b in text[i].encode("utf-8", "surrogateescape")]
        return out

    # -- many stretches side by side -----------------------------------------------------------------------

    def _rank(self, a: np.ndarray, b: np.ndarray, own: np.ndarray, left: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        rank = np.where((a >= 0) & (b >= 0), self.rank_of(key), NONE)
        if self.skip_below:
            offered = np.flatnonzero(rank != NONE)
            skip = self._skipped(own[offered], left[offered], self.piece_of[rank[offered]])
            rank[offered[skip]] = NONE
        return rank

    def _side_by_side(self, symbols: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """(merged, merges): every row of `symbols` (one stretch a row, padded with -3) merged to its end.

        `merges` are (rows, characters that pieces begin at, pieces) of all rounds.
        """
        rows, width = symbols.shape
        place = np.broadcast_to(np.arange(width, dtype=np.int64), symbols.shape).copy()
        ranks = np.full((rows, width), NONE, dtype=np.int32)
        flat = self._rank(symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), np.repeat(own, width - 1), place[:, :-1].ravel())
        ranks[:, :-1] = flat.reshape(rows, width - 1)
        live = np.arange(rows)
        columns = np.arange(width)
        merges = []
        while len(live):
            at = ranks[live].argmin(1)
            best = ranks[live, at]
            going = best != NONE
            live, at, best = live[going], at[going], best[going]
            if not len(live):
                break
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            for table, end in ((symbols, -3), (place, 0), (ranks, NONE)):
                moved = np.take_along_axis(table[live], source, 1)
                moved[:, -1] = end
                table[live] = moved
            symbols[live, at] = self.piece_of[best]
            merges.append((live, place[live, at], self.piece_of[best]))
            for left in (at - 1, at):
                right = left + 1
                held = np.flatnonzero((left >= 0) & (right < width))
                r, a, b = live[held], left[held], right[held]
                ranks[r, a] = self._rank(symbols[r, a], symbols[r, b], own[r], place[r, a])
        return symbols, merges

    def _learn(self, stretches: list[bytes], owns: np.ndarray, names: np.ndarray) -> list[tuple]:
        """Segment new stretches and store their ids under their (sorted) names; their merges are returned."""
        texts = [s.decode("utf-8", "surrogateescape") for s in stretches]
        sizes = np.array([len(t) for t in texts])
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        heads = np.cumsum(sizes) - sizes
        order = np.argsort(sizes, kind="stable")
        done = len(self.bounds) - 1
        lists: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        numbers: list[int] = []
        merges: list[tuple] = []
        at = 0
        while at < len(order):
            width = max(2, int(sizes[order[at]]))
            if width > SIDE_BY_SIDE:
                i = order[at]
                ids = np.array(self.agenda(texts[i], int(owns[i])), dtype=np.int32)
                lists.append(ids)
                counts.append(np.array([len(ids)]))
                numbers.append(int(i))
                at += 1
                continue
            # Rows of nearly one length share a matrix.
            width = min(SIDE_BY_SIDE, width + width // 4)
            to = min(int(np.searchsorted(sizes[order], width, "right")), at + max(1, CELLS // width))
            rows = order[at:to]
            spot = heads[rows, None] + np.arange(width)
            inside = np.arange(width) < sizes[rows, None]
            symbols = np.where(inside, self.symbol[points[np.minimum(spot, len(points) - 1)]], -3).astype(np.int32)
            merged, made = self._side_by_side(symbols.copy(), owns[rows])
            merges += [(rows[r], left, piece) for r, left, piece in made]
            plain = (symbols != -1).all(1)
            count = (merged >= 0).sum(1)
            lists.append(merged[plain][merged[plain] >= 0])
            counts.append(count[plain])
            numbers += rows[plain].tolist()
            for r in np.flatnonzero(~plain):  # characters outside the vocabulary become their bytes
                i = rows[r]
                ids = np.array(self.agenda(texts[i], int(owns[i])), dtype=np.int32)
                lists.append(ids)
                counts.append(np.array([len(ids)]))
                numbers.append(int(i))
            at = to
        own = np.empty(len(names), dtype=np.int32)
        own[numbers] = done + np.arange(len(names), dtype=np.int32)
        spot = np.searchsorted(self.names, names)
        self.names, self.numbers = np.insert(self.names, spot, names), np.insert(self.numbers, spot, own)
        ends = self.bounds[-1] + np.cumsum(np.concatenate(counts))
        self.flat = np.concatenate([self.flat, *lists])
        self.bounds = np.concatenate([self.bounds, ends.astype(np.int32)])
        return merges

    def _learn_plain(self, stretches: list[bytes], names: np.ndarray) -> np.ndarray:
        """Segment new stretches without dropout, store their ids, and return the candidates that are merged as
        numbers (stretch, character, piece)."""
        plain = mix(names)
        order = np.argsort(plain)
        order = order[np.searchsorted(self.names, plain[order]) == np.searchsorted(self.names, plain[order], "right")]
        skip, self.skip_below = self.skip_below, np.uint64(0)
        merges = self._learn([stretches[i] for i in order], plain[order], plain[order]) if len(order) else []
        self.skip_below = skip
        return np.concatenate([np.empty(0, np.int64), *[_candidate(order[r], left, piece) for r, left, piece in merges]])

    def _list(self, stretches: list[bytes], names: np.ndarray) -> None:
        """Store every candidate that any order of merges of new stretches could offer, under their (sorted) names."""
        texts = [s.decode("utf-8", "surrogateescape") for s in stretches]
        sizes = np.array([len(t) for t in texts])
        points, total = _running("".join(texts).replace(" ", SPACE))
        _, down = powers(len(points) + 1)
        stretch = np.repeat(np.arange(len(texts)), sizes)
        left = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        after = np.where(sizes[stretch] <= SHORT, sizes[stretch] - left, 0)
        here, found, made = np.arange(len(points)), [], []
        for size in range(2, min(self.longest, SHORT) + 1):
            here = here[after[here] >= size]
            h = mix((total[here + size] - total[here]) * down[here] + np.uint64(size))
            piece = self.piece_named(h)
            hit = np.flatnonzero(piece >= 0)
            found.append(here[hit])
            made.append(piece[hit].astype(np.int64))
        found, made = np.concatenate([here[:0], *found]), np.concatenate([here[:0], *made])
        order = np.argsort(found, kind="stable")
        spot = np.searchsorted(self.known, names)
        own = len(self.long) + np.arange(len(names), dtype=np.int32)
        self.known, self.places = np.insert(self.known, spot, names), np.insert(self.places, spot, own)
        self.marks = np.append(self.marks, self._marks(left[found[order]], made[order]))
        short = np.flatnonzero(sizes <= SHORT)
        merged = self._learn_plain([stretches[i] for i in short], names[short])
        merged = (short[merged >> CANDIDATE_BITS] << CANDIDATE_BITS) | (merged & ((1 << CANDIDATE_BITS) - 1))
        self.taken = np.append(self.taken, np.isin(_candidate(stretch[found], left[found], made)[order], merged))
        counts = np.bincount(stretch[found], minlength=len(texts))
        self.spans = np.append(self.spans, self.spans[-1] + np.cumsum(counts))
        self.long = np.append(self.long, sizes > SHORT)

    def _drawn(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, names: np.ndarray, own: np.ndarray) -> np.ndarray:
        """A name for what every occurrence comes to: its stretch and the candidates that its own draw skips, if any
        of these would be merged without dropout.

        A long stretch is named by its draw: it hardly ever skips the same candidates twice.
        """
        distinct, where, back, often = np.unique(names, return_index=True, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.known, distinct)
        new = np.searchsorted(self.known, distinct, "right") == at
        met = (distinct & np.uint64(MET - 1)).astype(np.int64)
        # A stretch that is met for the first time, and once, is segmented as it is drawn: most never come back.
        single = new & (often == 1) & ~self.met[met]
        self.met[met] = True
        new = np.flatnonzero(new & ~single)
        # Listed some bytes at a time: every substring of a stretch is looked at.
        share = np.cumsum(ends[where[new]] - starts[where[new]]) // LISTED_BYTES
        for part in np.split(new, np.flatnonzero(np.diff(share)) + 1) if len(new) else []:
            self._list([raw[a:b] for a, b in zip(starts[where[part]].tolist(), ends[where[part]].tolist())], distinct[part])
        alone = single[back]
        every = mix(names + own)
        names, own = names[~alone], own[~alone]
        stored = self.places[np.searchsorted(self.known, distinct[~single])][(np.cumsum(~single) - 1)[back[~alone]]]
        out = np.empty_like(names)
        for a in range(0, len(names), DRAWN):
            part, draw = stored[a : a + DRAWN], own[a : a + DRAWN]
            low = self.spans[part]
            size = self.spans[part + 1] - low
            total = np.append(0, np.cumsum(size))
            places = np.repeat(low - total[:-1], size) + np.arange(total[-1])
            marks = self.marks[places]
            skips = self._skips(np.repeat(draw, size), marks)
            gone = np.zeros(len(marks) + 1, dtype=np.uint64)
            np.cumsum(marks * skips, out=gone[1:])
            felt = np.append(0, np.cumsum(skips & self.taken[places]))
            changed = felt[total[1:]] > felt[total[:-1]]
            out[a : a + DRAWN] = mix(names[a : a + DRAWN] + (gone[total[1:]] - gone[total[:-1]]) * changed)
        long = np.flatnonzero(self.long[stored])
        out[long] = mix(out[long] + own[long])
        every[~alone] = out
        return every

    def encode_block(self, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): ids of the texts that `offsets` bound in `data`; `keys` draw what each skips."""
        if self.prefix and len(data):
            full = np.flatnonzero(offsets[1:] > offsets[:-1])
            data = np.insert(data, offsets[full], 0x20)
            grown = np.zeros(len(offsets), dtype=np.int64)
            grown[full + 1] = 1
            offsets = offsets + np.cumsum(grown)
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        heads = offsets[:-1][offsets[:-1] < len(data)]
        inner = np.empty(0, np.int64) if self.whole else _cuts(data, self.fine)
        begins = np.zeros(len(data), dtype=bool)
        begins[heads] = begins[inner] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, offsets)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        names = span_hashes(data, starts, ends)
        raw = data.tobytes()
        nth = np.arange(len(starts)) - first[text]
        own = mix(mix(keys[text].astype(np.uint64) ^ self.seed) + nth.astype(np.uint64))
        if len(self.flat) > STORED_IDS:
            self.forget()
        if len(self.marks) > STORED_IDS:
            self.forget_candidates()
        if self.skip_below:
            names = self._drawn(raw, starts, ends, names, own)
        distinct, where, back = np.unique(names, return_index=True, return_inverse=True)
        at = np.searchsorted(self.names, distinct)
        new = np.flatnonzero(np.searchsorted(self.names, distinct, "right") == at)
        if len(new):
            stretches = [raw[a:b] for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist())]
            self._learn(stretches, own[where[new]], distinct[new])
        stored = self.numbers[np.searchsorted(self.names, distinct)][back]
        low = self.bounds[stored].astype(np.int64)
        sizes = self.bounds[stored + 1] - low
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(low - total[:-1], sizes) + np.arange(total[-1])]
        return ids, total[first]

    def decode_block(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets): what the id lists that `bounds` bound in `ids` spell, the added spaces left out."""
        low = self.spelled_to[ids]
        ends = np.append(0, np.cumsum(self.spelled_to[ids + 1] - low, dtype=np.int64))
        step = np.ones(int(ends[-1]), dtype=np.int32)  # byte places, as steps from each to the next
        full = np.flatnonzero(np.diff(ends))
        if len(full):
            last = self.spelled_to[ids[full[:-1]] + 1]
            step[ends[full]] = np.append(low[full[0]], low[full[1:]] - last + 1)
        data, offsets = self.spelling[np.cumsum(step, dtype=np.int32)], ends[bounds]
        if self.prefix:
            head = np.flatnonzero(offsets[1:] > offsets[:-1])
            data = np.delete(data, offsets[head])
            shorter = np.zeros(len(offsets), dtype=np.int64)
            shorter[head + 1] = 1
            offsets = offsets - np.cumsum(shorter)
        return data, offsets

    def lossless(self, ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which id lists spell the bytes of their texts."""
        got, ends = self.decode_block(ids, bounds)
        same = np.diff(ends) == np.diff(offsets)
        if same.all():
            wrong = np.flatnonzero(got != data)
            same[np.searchsorted(offsets, wrong, "right") - 1] = False
            return same
        for i in np.flatnonzero(same):
            same[i] = np.array_equal(got[ends[i] : ends[i + 1]], data[offsets[i] : offsets[i + 1]])
        return same

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, dtype=np.int64)
        return self.decode_block(ids, np.array([0, len(ids)]))[0].tobytes()


def read_vocabulary(path: str) -> bytes:
    """The bytes of a vocabulary file, read on the driver; tasks get them with their code."""
    with open(path, "rb") as file:
        return file.read()


def parse_vocabulary(vocabulary: bytes) -> tuple[list[tuple[str, float, int]], list[int], bool]:
    """(pieces, byte ids, whether texts get a space before) of a vocabulary file's bytes; it is never trained."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
    size = range(model.get_piece_size())
    plain = [i for i in size if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = [(model.id_to_piece(i), model.get_score(i), i) for i in plain]
    prefix = model.encode("a", out_type=str)[0].startswith(SPACE)
    return pieces, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], prefix


def load_coder(vocabulary: bytes, seed: int = 0, dropout: float = 0.0) -> Coder:
    """A coder over the pieces of a vocabulary file's bytes."""
    return Coder(*parse_vocabulary(vocabulary), seed, dropout)


_coders: dict[tuple, Coder] = {}


def _coder(*settings) -> Coder:
    """One coder a worker process, kept from batch to batch with what it has learned."""
    if settings not in _coders:
        _coders.clear()
        _coders[settings] = load_coder(*settings)
    return _coders[settings]


def encode(
    docs: DataFrame, vocabulary: bytes, seed: int = 0, dropout: float = 0.1, doc_id: str = "doc_id"
) -> DataFrame:
    """Per row of `docs`: its id, n_tokens, ids, and lossless: whether the ids decode to the text's bytes.

    Merge-dropout skips a candidate merge when a hash keyed by `seed` falls below `dropout`. The hash is that of
    the document, the occurrence in it and the candidate, so every occurrence of a word is drawn by itself,
    and equal seeds give equal ids wherever a task runs. Null and empty texts have no ids;
    rows with equal id and text have equal ids; a null id draws as any other. Texts are read whole,
    whatever their length; columns other than the id and the text are not read.
    """
    read = texts_to_python(docs).select(
        F.col(doc_id).alias("_doc"), F.xxhash64(F.col(doc_id)).alias("_key"), F.col("text").cast("binary").alias("_text")
    )
    schema = T.StructType([
        T.StructField("_doc", read.schema["_doc"].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("lossless", T.BooleanType()),
    ])

    parsed = parse_vocabulary(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*parsed, seed, dropout)
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for at, to, data, offsets in text_blocks(batch.column(2), BLOCK_BYTES):
                ids, bounds = coder.encode_block(data, offsets, keys[at:to])
                same = coder.lossless(ids, bounds, data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pa.array(np.diff(bounds)), lists, pa.array(same)],
                    names=["_doc", "n_tokens", "ids", "lossless"],
                )
        # Other stages run in this worker; it keeps nothing of this one.
        del coder
        release()

    return read.mapInArrow(run, schema).withColumnRenamed("_doc", doc_id)


def decode(encoded: DataFrame, vocabulary: bytes, ids: str = "ids") -> DataFrame:
    """`encoded` with a column text: the decoded ids; null ids give a null text, no ids an empty one.

    Lists of any length are decoded whole, repeated rows alike; text replaces a column of that name, all others stay. No
    rows give no rows.
    """

    @F.pandas_udf(T.BinaryType())
    def texts(column):
        coder = _coder(vocabulary)
        return column.map(lambda x: None if x is None else coder.decode(x))

    return encoded.withColumn("text", texts(F.col(ids)).cast("string"))
