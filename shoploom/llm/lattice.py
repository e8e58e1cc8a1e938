"""Distinct sampled segmentations of texts by Gumbel top-k without replacement.

A text's lattice holds all ways to write it in pieces of a SentencePiece vocabulary. Piece weights are a unigram model,
trained on piece counts of the whole corpus. Each segmentation's log-probability is perturbed by Gumbel noise; the k
largest are k distinct samples. They are found by search from the top, A* with the exact remaining mass as its bound: a
path draws, at each of its nodes, the largest perturbed value among the ways that leave it there, below its own value,
and the largest of all these opens the next path. Noise is a hash of the row's key, so each row's samples are its own.
"""

from __future__ import annotations

import dataclasses
import math
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoploom.llm.common import bounded_batches, texts_of, without

SAMPLES, SEED = 3, 42
SPACE_MARK = "▁"
_PART_CHARS = 500_000  # of texts sampled at a time
_HELD_BYTES = 16 << 20  # of words that are counted together
_WORDS_JOINED = 4  # words that are encoded as one text
_WORDS_AT_A_TIME = 64_000
_MEMORY_EDGES = 2_500_000  # 36 bytes each
_LEAST_SHARE = 1e-290  # sums below are taken in logs
_WRITTEN_MARK = np.uint64(0x110000)  # beyond all characters
_UNIT = re.compile(" +[^ ]*")
_KINDS = pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_counts(texts: DataFrame, path: str, text: str = "text") -> np.ndarray:
    """How often the plain encoding of all texts uses each piece: one row per piece and task, summed up.

    Pieces don't reach from a word into the space behind it, so a task encodes each distinct word once, a few that
    come equally often as one text. Texts with runs of spaces, spaces at an end or written space marks (which the encoder
    takes for spaces) are encoded as they are.
    """

    def run(batches):
        encoder = processor(path)
        counts = np.zeros(encoder.vocab_size(), dtype=np.int64)

        def add(pieces, times):
            flat = np.fromiter(chain.from_iterable(pieces), dtype=np.int64)
            np.add.at(counts, flat, np.repeat(np.asarray(times, dtype=np.int64), [len(p) for p in pieces]))

        def add_words(words):
            found = pa.chunked_array(words, pa.string()).value_counts()
            words, times = found.field("values"), found.field("counts").to_numpy()
            order = np.argsort(times, kind="stable")
            for k in range(0, len(order), _WORDS_AT_A_TIME):
                part = order[k : k + _WORDS_AT_A_TIME]
                texts, n = _joined(words.take(pa.array(part)).to_numpy(zero_copy_only=False).tolist(), times[part])
                add(encoder.encode(texts, num_threads=1), n)

        held = []
        for batch in batches:
            column = pc.fill_null(batch.column(0), "")
            odd = pc.or_(pc.match_substring(column, "  "), pc.match_substring(column, SPACE_MARK))
            odd = pc.or_(odd, pc.or_(pc.starts_with(column, " "), pc.ends_with(column, " ")))
            for text in column.filter(odd).to_pylist():
                add([encoder.encode(text)], [1])
            held.append(pc.split_pattern(column.filter(pc.invert(odd)), " ").flatten().cast(pa.string()))
            if sum(x.nbytes for x in held) > _HELD_BYTES:
                add_words(held)
                held.clear()
        add_words(held)
        held.clear()
        pa.default_memory_pool().release_unused()
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["id", "n"])

    bounded_batches(texts.sparkSession)
    sent = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "id long, n long")
    out = np.zeros(processor(path).vocab_size())
    for r in sent.groupBy("id").agg(F.sum("n").alias("n")).collect():  # one row per piece of the vocabulary
        out[r["id"]] = r["n"]
    return out


def _joined(words: list[str], times: np.ndarray) -> tuple[list[str], list[int]]:
    """Words that come equally often joined by spaces, _WORDS_JOINED at most, and how often they come. They come by `times`."""
    texts, out = [], []
    cuts = np.flatnonzero(np.diff(times, prepend=0)).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(words)], strict=False):
        for k in range(a, b, _WORDS_JOINED):
            texts.append(" ".join(filter(None, words[k : min(b, k + _WORDS_JOINED)])))
            out.append(int(times[a]))
    return texts, out


def _key(name: str) -> int:
    key = 0
    for c in name:
        key = (key * int(_BASE) + ord(c) + 1) % (1 << 64)
    return key


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(65 - size.bit_length())).astype(np.int64)


@lru_cache(maxsize=2)
def _vocabulary(path: str):
    """Names, the ids of bytes, a hash table of all pieces and their beginnings by the key of their characters, and all
    pieces' ids with the ids that write them character by character."""
    model = processor(path)
    names = [model.id_to_piece(k) for k in range(model.vocab_size())]
    of_bytes, known = {}, {}
    for k, name in enumerate(names):
        if model.is_byte(k):
            of_bytes[int(name[1:-1], 16)] = k
        # Marks stand at the start of a piece or are all of it: a unit is a run of spaces with the word behind it.
        elif not (model.is_control(k) or model.is_unknown(k) or SPACE_MARK in name.lstrip(SPACE_MARK)):
            known[name] = k
    beginnings = sorted({name[:n]: known.get(name[:n], -1) for name in known for n in range(1, len(name) + 1)}.items())
    size = 1 << max(16, (16 * len(beginnings)).bit_length())
    own = np.array([_key(name) for name, _ in beginnings], dtype=np.uint64)
    keys, found = np.zeros(size, dtype=np.uint64), np.full(size, -2, dtype=np.int32)
    for key, slot, (_, k) in zip(own.tolist(), _slot(own, size).tolist(), beginnings, strict=True):
        while found[slot] != -2:
            slot = (slot + 1) % size
        keys[slot], found[slot] = key, k

    def alone(char: str) -> list[int]:
        return [known[char]] if char in known else [of_bytes[b] for b in (" " if char == SPACE_MARK else char).encode()]

    written = [[k for char in name for k in alone(char)] for name in known]
    begin = np.cumsum([0, *map(len, written)])[:-1]
    return names, of_bytes, keys, found, (np.array([*known.values()]), np.array([*chain.from_iterable(written)]), begin)


class Pieces:
    """The vocabulary, with the log-probability of each piece. Characters without a piece are written in bytes.

    `gains`: log of how much likelier a piece is than its characters one by one, 0 for a single character. No sum over the
    ways to write `depth` characters, as a multiple of that of single characters, is too large for a number.
    """

    def __init__(self, path: str, counts: np.ndarray):
        self.names, self.bytes, self.keys, self.found, (own, written, begin) = _vocabulary(path)
        self.logs = np.log((counts + 1) / (counts.sum() + len(counts)))
        self.gains = np.zeros(len(self.logs))
        self.gains[own] = self.logs[own] - np.add.reduceat(self.logs[written], begin)
        most = max(0.0, *(self.gains[own] / [len(self.names[k]) for k in own.tolist()]).tolist())
        self.depth = int(650 / (most + math.log(2)))

    def spelled(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()]

    def look(self, keys: np.ndarray) -> np.ndarray:
        """For each key the id of its piece, -1 if pieces only begin so, -2 if none does."""
        slots = _slot(keys, len(self.found))
        found = self.found[slots]
        other = np.flatnonzero((found != -2) & (self.keys[slots] != keys))
        while len(other):  # taken by another key: it may stand further on
            slots[other] = (slots[other] + 1) % len(self.found)
            found[other] = self.found[slots[other]]
            other = other[(found[other] != -2) & (self.keys[slots[other]] != keys[other])]
        return found


def _evenly(text: str) -> bool:
    """Whether a text is words with one space between them."""
    return text != "" and "  " not in text and text[0] != " " and text[-1] != " "


def units(text: str) -> list[str]:
    """A text as its words, each with the spaces before it but for one; one space is put before the text."""
    if not text:
        return []
    return text.split(" ") if _evenly(text) else [unit[1:] for unit in _UNIT.findall(" " + text)]


@dataclass
class Lattice:
    """Nodes are the characters of the distinct units; `first[node]` is its first edge, `first[node + 1]` ends them.

    Of each edge: the node it leaves and leads to (-1 at a unit's end), its log-probability among all that leave the
    node (from the mass behind it), the same of all others together, its probability among them (infinite for a
    node's last), and its id, or -1 - k if it is spelled by row k of `spelled`, which is filled up with -1.
    """

    starts: np.ndarray
    first: np.ndarray
    node: np.ndarray
    target: np.ndarray
    log: np.ndarray
    others: np.ndarray
    share: np.ndarray
    ids: np.ndarray
    spelled: np.ndarray


def lattice(words: list[str], pieces: Pieces) -> Lattice:
    """The lattices of distinct units. Nodes are numbered by their distance from the unit's end, the nearest first."""
    chars = " " + " ".join(words) if words else ""
    codes = np.frombuffer(chars.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    mark = np.uint64(ord(SPACE_MARK))
    codes = np.where(codes == 32, mark, np.where(codes == mark, _WRITTEN_MARK, codes))  # a mark in the text is no space
    lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
    ends = np.cumsum(lengths)
    size = len(codes)
    left = np.repeat(ends, lengths) - np.arange(size)  # characters up to the unit's end
    short = size > 0 and left.max() < 1 << 16  # sorted by digits
    order = np.argsort(left.astype(np.uint16) if short else left, kind="stable")
    number = np.empty(size, dtype=np.int64)
    number[order] = np.arange(size)
    left = left[order]

    codes = codes + np.uint64(1)
    # All nodes look for pieces of one character, then those go on where a longer piece may begin so.
    by_length, nodes, keys, n = [], np.arange(size), np.zeros(size, dtype=np.uint64), 1
    counts = np.zeros(size, dtype=np.int64)
    while len(nodes):
        at = order.take(nodes) + (n - 1)
        keys = keys * _BASE + codes.take(at)
        ids = pieces.look(keys)
        hit = np.flatnonzero(ids >= 0)
        own = nodes[hit]
        if n == 1:
            bare = np.flatnonzero(ids < 0)  # spelled in bytes
            kinds: dict[str, int] = {}
            ids[bare] = [-1 - kinds.setdefault(chars[k], len(kinds)) for k in order[bare].tolist()]
            by_length.append((nodes, n, at + 1, ids.copy()))
            counts += 1
            ids[bare] = pieces.look(keys[bare])
        else:
            by_length.append((own, n, at[hit] + 1, ids[hit]))
            counts[own] += 1
        go = np.flatnonzero((ids > -2) & (left.take(nodes) > n))
        nodes, keys, n = nodes[go], keys[go], n + 1
    spelled = np.full((len(kinds) if size else 0, 4), -1, dtype=np.int32)
    for char, k in kinds.items() if size else ():
        own = pieces.spelled(char)
        spelled[k, : len(own)] = own

    # Longer pieces first, as they are likelier: most draws then stop at a node's first edge.
    first = np.concatenate([[0], np.cumsum(counts)])
    edges, free = int(first[-1]), first[:-1].copy()
    node, ids = np.repeat(np.arange(size, dtype=np.int32), counts), np.empty(edges, dtype=np.int32)
    target, gain = np.empty(edges, dtype=np.int32), np.zeros(edges)
    for nodes, n, behind, own in by_length[::-1]:
        at = free[nodes]
        free[nodes] += 1
        ids[at] = own
        ends_here = np.searchsorted(left[nodes], n, "right")  # nodes come by their distance from the end
        target[at[:ends_here]] = size
        target[at[ends_here:]] = number.take(behind[ends_here:])
        if n > 1:
            gain[at] = pieces.gains.take(own)

    # The mass of all ways from a node to its unit's end, from the nodes next to the end on, as a multiple of that of single
    # characters: 1 at least. Far from the end only its log is taken.
    mass, logs = np.ones(size + 1), np.zeros(size + 1)  # the last are those of the end
    cuts = np.searchsorted(left, np.arange(1, (left[-1] if size else 0) + 2)).tolist()
    near, last = min(pieces.depth, len(cuts) - 1), len(cuts) - 1
    far = cuts[near]
    share = np.exp(gain)
    for a, b in zip(cuts[:near], cuts[1:]):
        ea, eb = first[a], first[b]
        share[ea:eb] *= mass.take(target[ea:eb])
        mass[a:b] = np.add.reduceat(share[ea:eb], first[a:b] - ea)
    logs[:far] = np.log(mass[:far])
    for a, b in zip(cuts[near:last], cuts[near + 1 :], strict=True):
        ea, eb = first[a], first[b]
        scores = gain[ea:eb] + logs[target[ea:eb]]
        begin = first[a:b] - ea
        top = np.maximum.reduceat(scores, begin)
        logs[a:b] = top + np.log(np.add.reduceat(np.exp(scores - top[node[ea:eb] - a]), begin))
    log = gain + logs.take(target) - logs.take(node)
    far = first[far]
    share[:far] /= mass.take(node[:far])
    share[far:] = np.exp(log[far:])

    # Sums over the other edges are taken without the likeliest, so that they stay exact where it takes nearly all.
    most = share > 0.5
    rest = np.bincount(node, np.where(most, 0, share), size) if size else np.zeros(0)
    with np.errstate(divide="ignore"):
        others = np.log(np.where(most, rest.take(node), 1 - share) if size else share)
    for e in np.flatnonzero(most & (rest.take(node) < _LEAST_SHARE) & (counts.take(node) > 1)).tolist() if size else ():
        a, b = first[node[e]], first[node[e] + 1]
        others[e] = np.logaddexp.reduce(np.delete(log[a:b], e - a))
    share[first[1:] - 1] = np.inf
    target[target == size] = -1
    starts = number[ends - lengths] if size else np.zeros(0, dtype=np.int64)
    return Lattice(starts, first, node, target, log, others, share, ids, spelled)


def _arrays(found: Lattice) -> list[np.ndarray]:
    return [getattr(found, f.name) for f in dataclasses.fields(Lattice)]


class Memory:
    """The lattices of units that a task meets in more than one part, kept in arrays of _MEMORY_EDGES edges.

    Units met for the first time stand behind them until the next part. Where a part's units don't fit in, the arrays are
    begun anew with that part; a part may need more by itself. `met` is a bit map of the units' hashes: units that share one
    are kept a part earlier, no more.
    """

    def __init__(self, pieces: Pieces):
        self.pieces, self.met = pieces, np.zeros(1 << 22, dtype=bool)
        self.clear()

    def clear(self):
        self.types, self.held, self.used = {}, None, None

    def units(self, texts: list[str]) -> tuple[Lattice, list[np.ndarray]]:
        """A lattice that holds all units of the texts, and each text's units as their first nodes."""
        plain = [text for text in texts if _evenly(text)]
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        even, odd = len(own), [units(text) for text in texts if not _evenly(text)]
        if any(odd):
            number = {w: k for k, w in enumerate(own)}
            odd = [[number.setdefault(w, len(number)) for w in text] for text in odd]
            own.extend(islice(number, even, None))
        found, starts = self._starts(own)
        starts_of = starts[coded.indices.to_numpy()]
        cuts = split.offsets.to_numpy().tolist()
        rows, others = iter([starts_of[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]), iter(odd)
        return found, [next(rows) if _evenly(text) else starts[np.array(next(others), dtype=np.int64)] for text in texts]

    def _starts(self, own: list[str]) -> tuple[Lattice, np.ndarray]:
        """A lattice that holds distinct units, and their first nodes."""
        slots = np.fromiter(map(hash, own), dtype=np.int64, count=len(own)) & (len(self.met) - 1)
        again = self.met[slots]
        self.met[slots] = True
        while True:
            numbers = np.fromiter(map(self.types.get, own, repeat(-1)), dtype=np.int64, count=len(own))
            kept, once = np.flatnonzero((numbers < 0) & again), np.flatnonzero((numbers < 0) & ~again)
            words = [own[k] for k in kept.tolist()]
            parts = lattice(words, self.pieces), lattice([own[k] for k in once.tolist()], self.pieces)
            if self.fits(parts):
                break
            if not self.types:
                self.room(parts)
                break
            self.clear()
        numbers[kept] = len(self.types) + np.arange(len(kept))
        numbers[once] = len(self.types) + len(kept) + np.arange(len(once))
        self.types.update(zip(words, numbers[kept].tolist(), strict=True))
        used = self._add(parts[0], self.used)
        found = Lattice(*(x[:n] for x, n in zip(self.held, self._add(parts[1], used), strict=True)))
        self.used = used
        return found, found.starts[numbers]

    def fits(self, parts: Iterable[Lattice]) -> bool:
        if self.held is None:
            return False
        sizes = zip(*([len(x) for x in _arrays(p)] for p in parts), strict=True)
        return all(n + sum(more) <= len(x) for n, more, x in zip(self.used, sizes, self.held, strict=True))

    def room(self, parts: Iterable[Lattice]):
        """New arrays, with room for these at least."""
        rooms = [_MEMORY_EDGES // n for n in (8, 2, 1, 1, 1, 1, 1, 1, 64)]
        alike = zip(*map(_arrays, parts), strict=True)
        self.held = [np.empty((max(n, sum(map(len, x)) + 1), *x[0].shape[1:]), x[0].dtype) for n, x in zip(rooms, alike, strict=True)]
        self.used = [0, 1, *[0] * 7]

    def _add(self, new: Lattice, used: list[int]) -> list[int]:
        """Put behind what is used, and how much then is."""
        starts, first, node, _, _, _, _, _, spelled = used
        nodes = first - 1
        moved = (
            new.starts + nodes,
            new.first + node,
            new.node + np.int32(nodes),
            np.where(new.target < 0, new.target, new.target + np.int32(nodes)),
            new.log,
            new.others,
            new.share,
            np.where(new.ids < 0, new.ids - np.int32(spelled), new.ids),
            new.spelled,
        )
        begin = [n - (k == 1) for k, n in enumerate(used)]  # the last of `first` is the next one's beginning
        ends = [n + len(x) for n, x in zip(begin, moved, strict=True)]
        for x, a, b, part in zip(self.held, begin, ends, moved, strict=True):
            x[a:b] = part
        return ends


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scattered over their range."""
    x = x + _BASE
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _uniform(key: np.ndarray, counter) -> np.ndarray:
    """Numbers strictly between 0 and 1 from the hash of a key and a counter."""
    return _between(key ^ _mixed(np.atleast_1d(np.asarray(counter, dtype=np.uint64))))


def _between(key: np.ndarray) -> np.ndarray:
    return ((_mixed(key) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _stream(key: np.ndarray, number) -> np.ndarray:
    """The keys of another stream of numbers."""
    return _mixed(key + np.atleast_1d(np.asarray(number, dtype=np.uint64)) * np.uint64(0xD1B54A32D192ED03))


def _walk(found: Lattice, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ancestral paths from `nodes` to the ends of their units: edges in order of the paths, and each path's length."""
    counts = np.zeros(len(nodes), dtype=np.int64)
    live = np.flatnonzero(nodes >= 0)
    at, parts = nodes[live], []
    while len(live):
        u = _uniform(keys.take(live), len(parts))
        edge = found.first.take(at)
        share = found.share.take(edge)
        over = np.flatnonzero(u >= share)
        u, share = u.take(over), share.take(over)
        while len(over):  # to the next edge, with what is left of the number
            edge[over] += 1
            u -= share
            share = found.share.take(edge.take(over))
            on = np.flatnonzero(u >= share)
            over, u, share = over.take(on), u.take(on), share.take(on)
        parts.append((live, edge))
        counts[live] += 1
        at = found.target.take(edge)
        on = np.flatnonzero(at >= 0)
        live, at = live.take(on), at.take(on)
    begin = np.cumsum(counts) - counts
    edges = np.empty(int(counts.sum()), dtype=np.int64)
    for step, (live, edge) in enumerate(parts):
        edges[begin[live] + step] = edge
    return edges, counts


class _Path:
    """One sampled segmentation: its edges, log-probabilities up to each, and where ways leave it.

    `late` falls as the value rises at which ways leave at an edge; `again` holds the values of edges where some have left.
    """

    __slots__ = ("value", "edge", "upto", "late", "again", "top")

    def __init__(self, value, edge, upto, late):
        self.value, self.edge, self.upto, self.late, self.again = value, edge, upto, late, {}
        self.look()

    def look(self):
        """Where ways of the largest value leave."""
        at = int(self.late.argmin()) if len(self.late) else -1
        self.top = (float(-np.logaddexp(-self.value, self.late[at])), at) if at >= 0 else (-math.inf, -1)
        for at, value in self.again.items():
            if value > self.top[0]:
                self.top = value, at

    def left(self, at, value):
        """Others may leave at an edge where one has left, at this value."""
        self.late[at], self.again[at] = math.inf, value
        self.look()

    @property
    def log(self) -> float:
        return float(self.upto[-1]) if len(self.upto) else 0.0


def _other(found: Lattice, node: int, out: list[int], u: float) -> tuple[int, float]:
    """An edge of the node that is not among `out`, and the log of what then remains."""
    a, b = int(found.first[node]), int(found.first[node + 1])
    free = [(e, log) for e, log in zip(range(a, b), found.log[a:b].tolist(), strict=True) if e not in out]
    top = max(log for _, log in free)
    parts = [math.exp(log - top) for _, log in free]
    u *= sum(parts)
    at = 0
    while at < len(parts) - 1 and u >= parts[at]:
        u -= parts[at]
        at += 1
    left = [log for k, (_, log) in enumerate(free) if k != at]
    if not left:
        return free[at][0], -math.inf
    top = max(left)
    return free[at][0], top + math.log(sum(math.exp(log - top) for log in left))


def _paths(texts: list[str], keys: list[int], memory: Memory, samples: int, seed: int):
    """The lattice, the paths of each text by falling value, and the largest value left out of each."""
    found, words = memory.units(texts)
    seeds = np.array([xxhash.xxh64_intdigest(str(k).encode(), seed) for k in keys], dtype=np.uint64)
    values = -np.log(-np.log(_uniform(seeds, 7)))
    paths: list[list[_Path]] = [[] for _ in texts]
    gone: list[dict[tuple[int, int], list[int]]] = [{} for _ in texts]
    best_left = np.full(len(texts), -np.inf)
    none = np.empty(0, dtype=np.int64)

    # The first path of every text is a plain sample; later ones leave an earlier path where the value is largest.
    jobs = [(d, float(values[d]), -1, 0) for d in range(len(texts))]
    for k in range(samples + 1):
        if k == samples:
            for d, value, *_ in jobs:
                best_left[d] = value
            break
        heads, runs = [], []
        draws = _uniform(_stream(seeds, 500 + k), 0).tolist()
        again = _uniform(_stream(seeds, 800 + k), 0).tolist()
        for d, value, parent, at in jobs:
            if parent < 0:
                heads.append(none)
                runs.append((0, words[d]))
                continue
            origin = paths[d][parent]
            own, word = int(origin.edge[at]), int(np.count_nonzero(found.target.take(origin.edge[:at]) < 0))
            out = gone[d].setdefault((parent, at), [own])
            edge, rest = _other(found, int(found.node[own]), out, draws[d])
            out.append(edge)
            before = float(origin.upto[at - 1]) if at else 0.0
            origin.left(at, float(-np.logaddexp(-value, math.log(-math.log(again[d])) - (before + rest))))
            heads.append(np.append(origin.edge[:at], edge))
            runs.append((word, np.append(found.target[edge], words[d][word + 1 :])))
        if not jobs:
            break

        of = np.array([d for d, *_ in jobs])
        counts = np.array([len(nodes) for _, nodes in runs])
        numbers = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - [word for word, _ in runs], counts)
        edges, lengths = _walk(found, np.concatenate([nodes for _, nodes in runs]), _stream(np.repeat(_stream(seeds[of], k), counts), numbers))
        cuts = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        pairs = list(zip(heads, cuts, cuts[1:], strict=False))
        edge = np.concatenate([x for head, a, b in pairs for x in (head, edges[a:b])])
        sizes = np.array([len(head) + b - a for head, a, b in pairs])
        ends = np.cumsum(sizes)
        begin = ends - sizes
        upto = found.log.take(edge)
        for a, b in zip(begin.tolist(), ends.tolist(), strict=True):
            np.cumsum(upto[a:b], out=upto[a:b])
        before = np.append(0.0, upto[:-1])[: len(upto)]
        before[begin[sizes > 0]] = 0
        scattered = _mixed(np.arange(sizes.max(), dtype=np.uint64))
        u = _between(np.repeat(_stream(seeds[of], 1000 + k), sizes) ^ np.concatenate([scattered[:n] for n in sizes.tolist()]))
        late = np.log(-np.log(u)) - (before + found.others.take(edge))
        for (d, value, *_), (head, _, _), a, b in zip(jobs, pairs, begin.tolist(), ends.tolist(), strict=True):
            late[a : a + len(head)] = np.inf
            paths[d].append(_Path(value, edge[a:b], upto[a:b], late[a:b]))
        jobs = []
        for d in of.tolist():
            parent = max(range(len(paths[d])), key=lambda p: paths[d][p].top[0])
            value, at = paths[d][parent].top
            if value > -math.inf:
                jobs.append((d, value, parent, at))
    return found, paths, best_left


def sample(texts: list[str], keys: list[int], pieces: Pieces, samples: int = SAMPLES, seed: int = SEED) -> list[list[tuple[list[int], float, float, float]]]:
    """For each text up to `samples` distinct segmentations: (ids, log-probability, perturbed value, log inclusion score).

    They come by falling perturbed value. The inclusion score is the probability that the segmentation's value exceeds
    the largest one left out; it is 1 if there are no others.
    """
    found, paths, left = _paths(texts, keys, Memory(pieces), samples, seed)
    ids, ends = _ids(found, [p.edge for own in paths for p in own])
    spans = zip([0, *ends.tolist()], ends.tolist(), strict=False)
    return [[(ids[slice(*next(spans))].tolist(), p.log, p.value, _log_inclusion(p.log, left[d])) for p in own] for d, own in enumerate(paths)]


def _log_inclusion(log: float, threshold: float) -> float:
    x = log - threshold
    if x > 3:
        return 0.0 if x > 700 else float(np.log(-np.expm1(-np.exp(x))))
    return x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))


def _ids(found: Lattice, paths: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all paths' edges, one path after the other, and where each path ends."""
    edges = np.concatenate([np.empty(0, dtype=np.int64), *paths])
    ids, ends = found.ids.take(edges), np.cumsum([len(p) for p in paths], dtype=np.int64)
    if not (ids < 0).any():
        return ids, ends
    bare = np.flatnonzero(ids < 0)
    rows = -1 - ids[bare]
    sizes = (found.spelled >= 0).sum(axis=1)[rows]
    lengths = np.ones(len(ids), dtype=np.int64)
    lengths[bare] = sizes
    flat, more = np.repeat(ids, lengths), np.append(0, np.cumsum(sizes - 1))
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat[np.repeat(bare + more[:-1], sizes) + within] = found.spelled[np.repeat(rows, sizes), within]
    return flat, ends + more[np.searchsorted(bare, ends)]


def decode(ids: list[int], pieces: Pieces) -> str:
    """The text that the pieces spell, without the space put before it. Ids of a segmentation give its text back exactly."""
    spelled = {v: k for k, v in pieces.bytes.items()}
    raw = b"".join(bytes([spelled[i]]) if i in spelled else pieces.names[i].replace(SPACE_MARK, " ").encode() for i in ids)
    return raw.decode()[1:]


@lru_cache(maxsize=2)
def _spellings(path: str) -> tuple[pa.Array, np.ndarray]:
    """The bytes of all pieces, and which begin with a space."""
    found = processor(path)
    plain = [bytes([int(x[1:-1], 16)]) if found.is_byte(k) else b"" if found.is_control(k) else x.replace(SPACE_MARK, " ").encode() for k, x in enumerate(map(found.id_to_piece, range(found.vocab_size())))]
    return pa.array(plain, pa.large_binary()), np.array([x[:1] == b" " for x in plain])


def _spelt(path: str, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes that lists of ids spell, and where in them each list's lie without the space before it. `ends`: of the lists in `ids`."""
    plain, spaced = _spellings(path)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(plain)):
        raise ValueError("an id outside the vocabulary")
    raw = plain.take(pa.array(ids))
    bounds = np.frombuffer(raw.buffers()[1], dtype=np.int64, count=len(ids) + 1)
    cuts = np.append(0, ends)
    begin, some = bounds[cuts[:-1]], np.diff(cuts) > 0
    begin[some] += spaced[ids[cuts[:-1][some]]]
    return raw.buffers()[2].to_pybytes() if len(ids) else b"", list(zip(begin.tolist(), bounds[ends].tolist(), strict=True))


def decoded(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """`df` with the text that its column of ids spells, in place of a column of that name.

    The space that encoding puts before a text is left out. Null ids give null, an empty list the empty text. Ids outside
    the vocabulary raise; bytes that are no UTF-8 (never of whole segmentations) become U+FFFD.
    """
    kept = without(df, [text])
    schema = T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())])
    place = kept.columns.index(ids)

    def run(batches):
        for batch in batches:
            lists = batch.column(place)
            sizes = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()], dtype=np.int64)
            raw, spans = _spelt(path, lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes))
            missing = lists.is_null().to_pylist()
            texts = [None if gone else raw[a:b].decode(errors="replace") for (a, b), gone in zip(spans, missing, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    bounded_batches(df.sparkSession)
    return kept.mapInArrow(run, schema)


def sampled(docs: DataFrame, path: str, counts: np.ndarray, text: str = "text", id: str = "doc_id", samples: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """doc_id, sample (from 1 by falling value), ids, log_prob, perturbed, log_inclusion, round_trip (the ids spell the text).

    A null text counts as empty; an empty text has one segmentation, without pieces. A null id is a key like any other.
    Repeated rows get the same samples. A text with fewer segmentations than `samples` gives them all, however unlikely.
    A space mark (U+2581) in a text is no space: it is spelled in bytes, so that every text comes back when decoded.
    """
    bounded_batches(docs.sparkSession)
    thin = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType.fromDDL("doc_id long, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, round_trip boolean")

    def run(batches):
        memory = Memory(Pieces(path, counts))
        for batch in batches:
            keys, plain = batch.column(0).to_pylist(), texts_of(batch, "text")
            texts = [x.decode() for x in plain]
            a = 0
            while a < len(texts):
                b, chars = a, 0
                while b < len(texts) and (b == a or chars + len(texts[b]) <= _PART_CHARS):
                    chars += len(texts[b])
                    b += 1
                found, paths, left = _paths(texts[a:b], keys[a:b], memory, samples, seed)
                ids, ends = _ids(found, [p.edge for own in paths for p in own])
                raw, spans = _spelt(path, ids, ends)
                own_text = (plain[a + d] for d, own in enumerate(paths) for _ in own)
                same = [raw[x:y] == text for (x, y), text in zip(spans, own_text, strict=True)]
                rows = [(key, k, p.log, p.value, _log_inclusion(p.log, best)) for key, own, best in zip(keys[a:b], paths, left, strict=True) for k, p in enumerate(own, 1)]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
                doc, number, *scores = (pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True))
                yield pa.RecordBatch.from_arrays([doc, number, lists, *scores, pa.array(same, pa.bool_())], names=schema.names)
                a = b

    return thin.mapInArrow(run, schema)
