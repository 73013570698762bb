"""SentencePiece encoding by sampling: distinct segmentations without replacement, and exact decoding.

Every segmentation of a text is a path through its lattice of pieces. With backward sums known, the next piece of a path has a
plain conditional probability, so the space of all paths is a tree of sets whose masses are known exactly. Gumbel top-k by
A* runs over it: a set carries the largest perturbed log probability of its paths; the best set on the agenda is opened; along
one path the chosen child keeps that value, and at each step what was not chosen goes to the agenda with a
Gumbel value cut off at it. The first k paths completed are k samples without replacement; the agenda's next value is the
threshold for their inclusion scores, 1 - exp(-exp(log p - threshold)).

No piece crosses a blank, a line break, or the end of a letter run before a mark that no piece continues with, so texts
part into units; the lattice of a unit is kept for its next places in the task, as long as it comes again. All random numbers are hashes of
row key, sample, unit and step: a repeated task draws the same samples.

Piece probabilities: a model of merges ranks its pieces, so a piece of rank r gets weight 1 / (r + 2).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, chain, compress, pairwise, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rangehaul.llm.arrays import mix, randoms

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
BLANK = "▁"
CHUNK_BYTES = 1 << 18
# Characters of new units whose lattices are built at a time.
BUILD_CHARS = 1 << 16
# Lattice arcs that a task keeps, some 24 bytes each with nodes and names; beyond, it forgets units that did not come again.
KEEP_ARCS = 3 << 20
# Freed memory that a task's allocator may keep is about twice this.
KEEP_BYTES = 16 << 20
MARKS = ".,;:!?"


class Pieces:
    """Pieces of a model file, with log probabilities by rank."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids, self.bytes, rank = {}, [b""] * size, np.zeros(size)
        self.byte = [0] * 256
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value], self.bytes[i] = i, bytes([value])
                rank[i] = size
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                self.bytes[i] = piece.replace(BLANK, " ").encode()
                rank[i] = min(size, -model.get_score(i))
        weight = 1 / (rank + 2)
        self.log = np.log(weight / weight.sum())
        self.longest = max(map(len, self.ids))
        # Pieces of each length by hash of their characters.
        self.factors = randoms(41, self.longest) | np.uint64(1)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in range(1, self.longest + 1):
            some = [p for p in self.ids if len(p) == length]
            if some:
                codes = np.frombuffer("".join(some).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(-1, length)
                hashes = (codes * self.factors[:length]).sum(1, dtype=np.uint64)
                order = np.argsort(hashes)
                maybe = np.zeros(1 << 16, bool)  # sorts out most hashes of no piece
                maybe[(hashes >> np.uint64(48)).astype(np.int64)] = True
                self.by_size[length] = hashes[order], np.array([self.ids[p] for p in some])[order], maybe
        alone = [m for m in MARKS if not any(re.search(rf"[a-zA-Z]{re.escape(m)}", p) for p in self.ids)]
        marks = "".join(map(re.escape, alone))
        broken = "\n" if not any("\n" in p for p in self.ids) else ""
        # A line break; a mark behind a letter with what follows it; blanks with the word behind them, up to such a mark.
        before = rf"(?<=[a-zA-Z])[{marks}][^ {broken}]*|" if marks else ""
        inner = rf"|(?<![a-zA-Z])[{marks}]" if marks else ""
        # First the most frequent unit, a word up to a blank or a line break; it is one without the other cases, too.
        plain = rf" *+[^ {broken}{marks}]++(?=[ {broken}])|"
        self.unit = re.compile(rf"{plain}{broken}|{before} *(?:[^ {broken}{marks}]+{inner})+| +")
        lengths = np.array([len(b) for b in self.bytes])
        self.flat, self.begin, self.length = np.frombuffer(b"".join(self.bytes), np.uint8), np.cumsum(lengths) - lengths, lengths

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of ids: bytes of the pieces without the blank put in front."""
        return self.decode_all(ids, np.array([0, len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Text of each run of ids between two offsets."""
        sizes = self.length[ids]
        ends = np.append(0, np.cumsum(sizes))
        at = np.repeat(self.begin[ids] - ends[:-1], sizes) + np.arange(ends[-1])
        data, cuts = self.flat[at].tobytes(), ends[offsets].tolist()
        return [data[low + 1 : high] for low, high in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _by_node(own: np.ndarray, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Order of arcs by node, then falling probability; each node's arcs lie together. Nodes with as many arcs are sorted as rows of a matrix."""
    heads = np.flatnonzero(np.diff(own, prepend=-1))
    begin = np.zeros(len(counts), np.int64)
    begin[own[heads]] = heads
    place = np.cumsum(counts) - counts
    order = np.empty(len(own), np.int64)
    for count in np.unique(counts[own[heads]]).tolist():
        nodes, across = np.flatnonzero(counts == count), np.arange(count)
        arcs = begin[nodes][:, None] + across
        if count > 1:
            arcs = np.take_along_axis(arcs, np.argsort(-p[arcs], axis=1, kind="stable"), 1)
        order[place[nodes][:, None] + across] = arcs
    return order


class Lattices:
    """Lattices of units, as nodes with arcs sorted by probability. Node -1 is a unit's end."""

    def __init__(self, vocabulary: Pieces):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.nodes = self.arcs = 0
        # Room for all arcs that are kept: pages are only taken as they fill, and nothing is copied to grow.
        room = KEEP_ARCS + KEEP_ARCS // 2
        # One block, as large ones go back to the system when the task ends. `first`: first arc of each node; the next node's begins behind the last.
        self.first, self.piece, self.next = np.zeros((3, room), np.int32)
        self.p = np.zeros(room)
        self.again = np.zeros(room, bool)  # first nodes of units that came again

    def forget(self) -> None:
        """Keep the units that came again since the last time; if these are most, none is kept."""
        starts = np.fromiter(self.known.values(), np.int64, len(self.known))
        again = self.again[starts]
        units, starts = list(compress(self.known, again)), starts[again]
        # Nodes of these units, and the chains that their arcs lead to.
        edge = np.zeros(self.nodes + 1, np.int8)
        edge[starts] += 1
        edge[starts + np.array([len(u) for u in units], np.int64)] -= 1
        held = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        counts = np.diff(self.first[: self.nodes + 1])
        while True:
            arcs = np.repeat(held, counts)
            to = self.next[: self.arcs][arcs]
            to = to[to >= 0]
            if held[to].all():
                break
            held[to] = True
        left = np.count_nonzero(arcs)
        if left > KEEP_ARCS * 3 // 4:
            return self.clear()
        place = np.cumsum(held, dtype=np.int32) - 1
        to = self.next[: self.arcs][arcs]
        self.next[:left] = np.where(to < 0, -1, place[to])
        for values in (self.piece, self.p):
            values[:left] = values[: self.arcs][arcs]
        self.nodes, self.arcs = np.count_nonzero(held), left
        self.first[1 : self.nodes + 1] = np.cumsum(counts[held])
        self.known = dict(zip(units, place[starts].tolist(), strict=True))
        self.again[:] = False

    def starts(self, units: list[str]) -> np.ndarray:
        """First nodes of units; those not known are built."""
        found = np.fromiter(map(self.known.get, units, repeat(-1)), np.int64, len(units))
        self.again[found[found >= 0]] = True
        if len(fresh := np.flatnonzero(found < 0)):
            named = [units[i] for i in fresh.tolist()]
            new = list(dict.fromkeys(named))
            part = np.cumsum([len(u) for u in new]) // BUILD_CHARS
            for low, high in pairwise([0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(new)]):
                self.add(new[low:high])
            found[fresh] = [self.known[x] for x in named]
        return found

    def add(self, units: list[str]) -> None:
        """Build the lattices of new units, all at once: a node for each character, and chains of byte pieces behind them."""
        v = self.vocabulary
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64)
        sizes = np.array([len(u) for u in units])
        ends = np.repeat(np.cumsum(sizes), sizes)
        n, at = len(codes), np.arange(len(codes))
        # Blanks become the model's mark; a literal mark gets a code of no piece and is spelled in bytes.
        symbols = np.where(codes == ord(" "), ord(BLANK), np.where(codes == ord(BLANK), 0, codes)).astype(np.uint64)
        own, to, piece = [], [], []
        # Hashes of the first `size` characters from each place that has as many left in its unit.
        alive, left, hashes = at, ends - at, np.zeros(n, np.uint64)
        for size in range(1, v.longest + 1):
            if size > 1:
                keep = left >= size
                alive, left, hashes = alive[keep], left[keep], hashes[keep]
            hashes = hashes + symbols[alive + (size - 1)] * v.factors[size - 1]
            if size not in v.by_size:
                continue
            table, ids, maybe = v.by_size[size]
            fits = np.flatnonzero(maybe[(hashes >> np.uint64(48)).astype(np.int64)])
            place = np.searchsorted(table, hashes[fits]).clip(0, len(table) - 1)
            hit = table[place] == hashes[fits]
            own.append(alive[fits[hit]])
            to.append(own[-1] + size)
            piece.append(ids[place[hit]])
            if size == 1:
                bare = np.setdiff1d(at, own[0], assume_unique=True)
        log = v.log[np.concatenate(piece)]
        # Characters without a piece: the first byte leads to a chain of the others, which are counted in.
        spelled = [chr(int(codes[i])).encode() for i in bare]
        chain_sizes = np.array([len(b) - 1 for b in spelled], np.int64)
        chain_at = n + np.cumsum(chain_sizes) - chain_sizes
        own, to, piece = (np.concatenate(x) for x in (own, to, piece))
        own, to = np.append(own, bare), np.append(to, bare + 1)
        piece = np.append(piece, np.array([v.byte[b[0]] for b in spelled], np.int64))
        log = np.append(log, [sum(v.log[v.byte[x]] for x in b) for b in spelled])
        next_ = np.where(to == ends[own], -1, to + self.nodes)
        detour = np.append(np.zeros(len(own) - len(bare), bool), chain_sizes > 0)
        chain_next = next_[len(own) - len(bare) :].copy()
        next_[detour] = chain_at[chain_sizes > 0] + self.nodes
        # Backward sums, by distance from the end of the unit.
        back = np.zeros(n + 1)
        closing = to == ends[own]
        far = (ends - at)[own]
        # Of a node's arcs, shorter pieces first and a spelled character last: keys are unique, so any sort gives this order.
        size = np.append((to - own)[: len(own) - len(bare)], np.full(len(bare), v.longest + 1))
        order = np.argsort((far * n + own) * (v.longest + 2) + size)
        own, to, piece, log, next_, closing, far = (x[order] for x in (own, to, piece, log, next_, closing, far))
        p = np.empty(len(own))
        bounds = np.flatnonzero(np.diff(far, prepend=-1))
        for low, high in zip(bounds, np.append(bounds[1:], len(own)), strict=True):
            value = log[low:high] + np.where(closing[low:high], 0, back[to[low:high]])
            node = own[low:high]
            first = np.flatnonzero(np.diff(node, prepend=-1))
            run = np.repeat(np.arange(len(first)), np.diff(np.append(first, high - low)))
            top = np.maximum.reduceat(value, first)
            weight = np.exp(value - top[run])
            total = np.add.reduceat(weight, first)
            back[node[first]] = top + np.log(total)
            p[low:high] = weight / total[run]
        counts = np.bincount(own, minlength=n)
        order = _by_node(own, p, counts)
        counts = np.append(counts, np.ones(int(chain_sizes.sum()), np.int64))
        pieces_ = [v.byte[x] for b in spelled for x in b[1:]]
        follow = np.arange(n + 1, n + 1 + len(pieces_)) + self.nodes
        follow[(chain_at + chain_sizes - 1)[chain_sizes > 0] - n] = chain_next[chain_sizes > 0]
        new = np.cumsum(counts) - counts + self.arcs
        begin = self.nodes
        self.nodes += len(counts)
        self.arcs += int(counts.sum())
        for name, values, end in (("again", np.zeros(len(new), bool), self.nodes), ("first", new, self.nodes), ("piece", np.append(piece[order], pieces_), self.arcs), ("next", np.append(next_[order], follow), self.arcs), ("p", np.append(p[order], np.ones(len(pieces_))), self.arcs)):
            old = getattr(self, name)
            if len(old) < end + 1:
                old = np.concatenate((old, np.zeros(end + 1 - len(old) + KEEP_ARCS // 8, old.dtype)))
                setattr(self, name, old)
            old[end - len(values) : end] = values
        self.first[self.nodes] = self.arcs
        self.known.update(zip(units, (begin + np.cumsum(sizes) - sizes).tolist(), strict=True))


def _seeds(*keys: np.ndarray, after: np.ndarray | None = None) -> np.ndarray:
    """What `_uniform` starts from: keys that many numbers share are mixed once, `after` others."""
    state = np.zeros(1, np.uint64) if after is None else after
    for key in keys:
        state = state + np.asarray(key).astype(np.uint64, copy=False)
        state += np.uint64(0x9E3779B97F4A7C15)
        state = mix(state)
    return state


def _uniform(*keys: np.ndarray, after: np.ndarray | None = None) -> np.ndarray:
    """Numbers in (0, 1) that depend on the keys only."""
    return ((_seeds(*keys, after=after) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _walk(lattice: Lattices, node: np.ndarray, key: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Draw from each node to its unit's end. Returns the arcs taken, the nodes they left, and offsets by start."""
    steps, alive, at, turn = [], np.flatnonzero(node >= 0), node[node >= 0], 0
    counts = np.zeros(len(node), np.int64)
    seeds = _seeds(key[alive], sample)
    while len(alive):
        u = _uniform(turn, after=seeds)
        arc, last = lattice.first[at].copy(), lattice.first[at + 1] - 1
        rest = np.arange(len(at))
        u = u - lattice.p[arc]
        while len(rest := rest[(u[rest] >= 0) & (arc[rest] < last[rest])]):
            arc[rest] += 1
            u[rest] -= lattice.p[arc[rest]]
        steps.append((alive, arc, at))
        counts[alive] += 1
        to = lattice.next[arc]
        on = to >= 0
        alive, at, seeds, turn = alive[on], to[on], seeds[on], turn + 1
    offsets = np.append(0, np.cumsum(counts))
    arcs, nodes = np.zeros(offsets[-1], np.int64), np.zeros(offsets[-1], np.int64)
    for turn, (alive, arc, at) in enumerate(steps):
        place = offsets[alive] + turn
        arcs[place], nodes[place] = arc, at
    return arcs, nodes, offsets


def _cut_gumbel(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values around `location`, given that they are at most `bound`."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        found = location - np.log(np.exp(np.minimum(location - bound, 700)) - np.log(u))
    return np.where(np.isneginf(location), -np.inf, np.minimum(found, bound))


class _Paths:
    """The paths of one round: steps of all texts one behind the other, and the agenda entries that these steps left."""

    def __init__(self, lattice, rows, arcs, nodes, units, offsets, value, own, key, sample):
        self.rows, self.arcs, self.nodes, self.units, self.offsets, self.value = rows, arcs, nodes, units, offsets, value
        of = np.repeat(np.arange(len(rows)), np.diff(offsets))
        p = lattice.p[arcs]
        with np.errstate(divide="ignore"):
            log = np.log(p)
            # A sum for each text, so that no text's numbers depend on its neighbours.
            self.before = np.empty(len(log))
            for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                np.cumsum(log[low:high], out=self.before[low:high])
            self.before -= log
            self.log_prob = np.bincount(of, log, len(rows))
            # What a step leaves: the sets of all other arcs. Steps taken over from an earlier path leave nothing.
            left = np.where(np.arange(len(arcs)) >= own[of], self.before + np.log1p(-np.minimum(p, 1)), -np.inf)
        first = lattice.first[nodes]
        left[lattice.first[nodes + 1] - first < 2] = -np.inf
        self.taken = np.uint64(1) << (arcs - first).astype(np.uint64)
        some = np.flatnonzero(left > -np.inf)
        text = of[some]
        self.agenda = np.full(len(arcs), -np.inf)
        self.agenda[some] = _cut_gumbel(left[some], value[text], _uniform(some - offsets[text], 7, after=_seeds(key[rows], sample)[text]))


def sampled(lattice: Lattices, starts: np.ndarray, offsets: np.ndarray, keys: np.ndarray, samples: int) -> list[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Per round: rows, perturbed values, piece ids, log probabilities, and inclusion scores. `starts` are first nodes of the units of all rows."""
    count = len(offsets) - 1
    rows = np.arange(count)
    unit_row = np.repeat(rows, np.diff(offsets))
    unit_key = mix(keys[unit_row] + mix(np.arange(len(starts), dtype=np.uint64) - offsets[:-1][unit_row].astype(np.uint64)))
    arcs, nodes, bounds = _walk(lattice, starts, unit_key, 0)
    units = np.repeat(np.arange(len(starts)), np.diff(bounds))
    value = -np.log(-np.log(_uniform(keys, 0, 3)))
    rounds = [_Paths(lattice, rows, arcs, nodes, units, bounds[offsets], value, np.append(bounds, 0)[offsets[:-1]], keys, 0)]
    for sample in range(1, samples + 1):
        best, which, where, head = np.full(count, -np.inf), np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int64)
        for r, paths in enumerate(rounds):
            held = np.flatnonzero(np.diff(paths.offsets))
            low, high = paths.offsets[held], paths.offsets[held + 1]
            at = low + np.array([paths.agenda[a:b].argmax() for a, b in zip(low.tolist(), high.tolist(), strict=True)], np.int64)
            row = paths.rows[held]
            more = paths.agenda[at] > best[row]
            row, at = row[more], at[more]
            best[row], which[row], where[row], head[row] = paths.agenda[at], r, at, low[more]
        threshold = best
        if sample == samples:
            break
        rows = np.flatnonzero(best > -np.inf)
        if not len(rows):
            break
        # Open the best set of each row: another arc at that step, then new draws to the end of the text.
        branch, follow, follow_key, follow_bounds, heads_, own, locations = [], [], [], [0], [], [], []
        draw = _uniform(keys[rows], sample, 5).tolist()
        for k, row in enumerate(rows.tolist()):
            paths, at = rounds[which[row]], int(where[row])
            first, last = lattice.first[paths.nodes[at] : paths.nodes[at] + 2].tolist()
            taken, p = int(paths.taken[at]), lattice.p[first:last].tolist()
            free = [a for a in range(last - first) if not taken >> a & 1]
            weights = list(accumulate(p[a] for a in free))
            arc = free[min(bisect_left(weights, draw[k] * weights[-1]), len(free) - 1)]
            paths.taken[at] |= np.uint64(1 << arc)
            left = weights[-1] - p[arc]
            arc += first
            locations.append(paths.before[at] + np.log(left) if left > 0 and len(free) > 1 else -np.inf)
            heads_.append((paths, int(head[row]), at))
            own.append(at - int(head[row]) + 1)
            branch.append((arc, paths.nodes[at], paths.units[at]))
            unit, end = paths.units[at], offsets[row + 1]
            follow.append(starts[unit:end].copy())
            follow[-1][0] = lattice.next[arc]
            follow_key.append(unit_key[unit:end])
            follow_bounds.append(follow_bounds[-1] + end - unit)
        values = _cut_gumbel(np.array(locations), best[rows], _uniform(keys[rows], sample, 11))
        for (paths, _, at), value in zip(heads_, values, strict=True):
            paths.agenda[at] = value
        arcs, nodes, bounds = _walk(lattice, np.concatenate(follow), mix(np.concatenate(follow_key) + np.uint64(sample)), sample)
        parts, sizes = ([], [], []), []
        for k, row in enumerate(rows):
            paths, low, at = heads_[k]
            begin, end = bounds[follow_bounds[k]], bounds[follow_bounds[k + 1]]
            unit = branch[k][2]
            later = np.repeat(np.arange(unit, unit + follow_bounds[k + 1] - follow_bounds[k]), np.diff(bounds[follow_bounds[k] : follow_bounds[k + 1] + 1]))
            for part, old, one, new in zip(parts, (paths.arcs, paths.nodes, paths.units), branch[k], (arcs[begin:end], nodes[begin:end], later), strict=True):
                part += [old[low:at], np.array([one], np.int64), new]
            sizes.append(at - low + 1 + end - begin)
        path_bounds = np.append(0, np.cumsum(sizes))
        rounds.append(_Paths(lattice, rows, *(np.concatenate(p) for p in parts), path_bounds, best[rows], path_bounds[:-1] + np.array(own), keys, sample))
    out = []
    for paths in rounds:
        ids = lattice.piece[paths.arcs]
        with np.errstate(over="ignore"):
            inclusion = -np.expm1(-np.exp(np.minimum(paths.log_prob - threshold[paths.rows], 700)))
        out.append((paths.rows, paths.value, np.split(ids, paths.offsets[1:-1]), paths.log_prob, inclusion))
    return out


def _encoded(model: str, samples: int, seed: int, verify: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        lattice = Lattices(vocabulary)
        # A block of this size, taken and given back, lets the allocator keep the pages of a chunk's arrays for the next chunk.
        np.empty(KEEP_BYTES, np.uint8)

        def out(batch: pa.RecordBatch, low: int, texts: list[str], keys: np.ndarray) -> pa.RecordBatch:
            units = [vocabulary.unit.findall(" " + text) if text else [] for text in texts]
            offsets = np.append(0, np.cumsum([len(u) for u in units]))
            found = sampled(lattice, lattice.starts(list(chain.from_iterable(units))), offsets, keys, samples)
            rows = np.concatenate([f[0] for f in found])
            ids = [x for f in found for x in f[2]]
            bounds = np.append(0, np.cumsum([len(x) for x in ids]))
            own = {
                "sample": pa.array(np.repeat(np.arange(1, len(found) + 1), [len(f[0]) for f in found]), pa.int32()),
                "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())),
                "log_prob": pa.array(np.concatenate([f[3] for f in found])),
                "perturbed": pa.array(np.concatenate([f[1] for f in found])),
                "inclusion": pa.array(np.concatenate([f[4] for f in found])),
            }
            if verify:
                encoded = [text.encode() for text in texts]
                # One round at a time: its texts are as long as the chunk's.
                cuts = np.append(0, np.cumsum([len(f[0]) for f in found])).tolist()
                spelled = (x for low, high in zip(cuts, cuts[1:], strict=False) if high > low for x in vocabulary.decode_all(np.concatenate(ids[low:high]), bounds[low : high + 1] - bounds[low]))
                own["exact"] = pa.array([x == encoded[r] for x, r in zip(spelled, rows.tolist(), strict=True)], pa.bool_())
            part = batch.select([f.name for f in schema if f.name not in own]).slice(low, len(texts)).take(pa.array(rows))
            if lattice.arcs > KEEP_ARCS:
                lattice.forget()
            return pa.RecordBatch.from_arrays([own[f.name] if f.name in own else part.column(f.name).cast(f.type) for f in schema], schema=schema)

        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64) + np.uint64(seed)
            low, held, size = 0, [], 0
            for at, text in enumerate(batch.column("text")):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield out(batch, low, held, mix(keys[low : at + 1]))
                    low, held, size = at + 1, [], 0
            if held:
                yield out(batch, low, held, mix(keys[low:]))

    return run


def encode(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", samples: int = SAMPLES, model: str = MODEL, seed: int = 0, carry: Sequence[str] = (), keep_text: bool = False, verify: bool = False) -> DataFrame:
    """Up to `samples` distinct segmentations per row: `doc_id`, `carried` (struct of the columns in `carry`), `sample` (from 1, by
    falling perturbed value), `ids`, `log_prob`, `perturbed`, `inclusion`; with `keep_text` also `text`, and with `verify` also `exact`: whether
    the ids, decoded again in the task, are the text.

    - null or empty text has one segmentation, without pieces; a text with fewer segmentations than asked for gets all of them,
      with inclusion 1;
    - the row key is the id and the text, so equal rows draw equal samples; a null id is a key like others;
    - characters without a piece, and a literal U+2581, are spelled in byte pieces: `decode` gives every text back;
    - an empty table gives an empty result; columns that are not named are ignored. `model` must be readable on every executor.
    """
    carried = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry]) if carry else F.lit(None).cast("string")
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), carried.alias("carried"), F.col(text_column).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    own = [("sample", T.IntegerType()), ("ids", T.ArrayType(T.IntegerType())), ("log_prob", T.DoubleType()), ("perturbed", T.DoubleType()), ("inclusion", T.DoubleType())]
    own += [("exact", T.BooleanType())] if verify else []
    out = T.StructType([*rows.schema.fields[: 3 if keep_text else 2], *[T.StructField(n, k) for n, k in own]])
    return rows.mapInArrow(_encoded(model, samples, seed, verify, to_arrow_schema(out)), out)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """`encoded` with `decoded`: the text that `ids` spell; null ids give null, no ids an empty text."""
    out = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            texts = [None if not x.is_valid else vocabulary.decode(x.values.to_numpy()).decode("utf-8", "replace") for x in batch.column("ids")]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, out)
