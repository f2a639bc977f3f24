"""SentencePiece segmentations sampled without replacement, and decoding.

A text's segmentations are the paths of its lattice of pieces. The k distinct ones with the largest perturbed
log-probability (log-probability plus Gumbel noise) are a sample without replacement. They are found by a
perturbed A-star search: the best path of a set of paths is drawn from the lattice; at every step the paths that
leave it there form a set of their own, whose largest perturbed value is drawn as a Gumbel variable truncated at
the value just found; the set with the largest value is searched next. The value of the best set left in the end is the threshold
from which inclusion scores follow.

Pieces do not cross the start of a word, so the lattice is a chain of word lattices, which are built once for each
distinct word of a chunk of text; a worker keeps those of the most frequent words for the next chunks. Noise comes from a hash of row key, sample, word and step: a row gives the same samples in
any batch, partition or retry.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice
from math import expm1, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestep.llm.common import per_worker

SAMPLES, SEED = 2, 1
#: Below 1 flattens the distribution over segmentations, above 1 sharpens it.
SHARPNESS = 1.0
#: Characters whose words share a lattice table at a time.
CHUNK = 1_000_000
#: Characters of the words whose lattices a worker keeps from chunk to chunk.
KEPT = 500_000
#: Positions of a lattice whose pieces are looked up at a time.
BLOCK = 1 << 16
#: Steps of a path whose sets get a value of their own at once.
HEAD = 64
#: Texts whose first paths are valued at a time.
TEXTS = 2048
SPACE = "▁"
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_PROBE = "  a  b ﬁ é\n\tx Á "
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * _M1
    x = (x ^ x >> np.uint64(27)) * _M2
    return x ^ x >> np.uint64(31)


def _uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers strictly between 0 and 1."""
    return ((_mixed(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _row_key(key, seed: int) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh3_64_intdigest(repr(key).encode(), seed))


def _truncated(location: np.ndarray, bound, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at these locations, conditioned to lie below ``bound``; -inf for empty sets."""
    out = -np.logaddexp(-bound, np.log(-np.log(u)) - location)
    return out if np.isfinite(location).all() else np.where(np.isneginf(location), -np.inf, out)


def utf8_sizes(codes: np.ndarray) -> np.ndarray:
    """Bytes of each code point in UTF-8."""
    return 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


class Table:
    """Ids of strings by their hashes, looked up without a search: what collides in one level stands in the next."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.levels = []
        bits, turn = 17, np.uint64(0x9E3779B97F4A7C15)
        while len(keys):
            place = (keys * turn >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(place, return_index=True)
            held, there = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            held[place[first]], there[place[first]] = keys[first], values[first]
            self.levels.append((turn, np.uint64(64 - bits), held, there))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]
            bits, turn = max(10, bits - 2), np.uint64(int(turn) * 5 & 0xFFFFFFFFFFFFFFFF)

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        for turn, shift, held, there in self.levels:
            place = (keys * turn >> shift).astype(np.int64)
            hit = held[place] == keys
            out[hit] = there[place[hit]]
        return out


class Vocabulary:
    """Pieces of a model file with log-probabilities.

    A unigram model's scores are log-probabilities; a BPE model's are merge ranks, from which a Zipf law over ranks follows.
    A character no piece spells is its UTF-8 bytes, each as likely as the rarest piece.
    """

    def __init__(self, path: str, sharpness: float = SHARPNESS):
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        names = [sp.id_to_piece(i) for i in plain]
        self.by_word = not any(SPACE in n.lstrip(SPACE) for n in names)
        self.byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown = max(0, sp.unk_id())
        self.of_byte = np.full(256, self.unknown, np.int32)
        self.of_byte[list(self.byte)] = list(self.byte.values())
        scores = np.array([sp.get_score(i) for i in plain], np.float64)
        if (np.sort(-scores)[: len(scores) // 2] == np.round(np.sort(-scores)[: len(scores) // 2])).all():  # ranks
            order = np.empty(len(scores))
            order[np.argsort(-scores, kind="stable")] = np.arange(len(scores))
            scores = -np.log(order + 2)
        scores = sharpness * (scores - np.logaddexp.reduce(scores))
        self.score = np.full(size, -np.inf)
        self.score[plain] = scores
        self.rarest = scores.min() if len(scores) else -10.0
        self.longest = max(map(len, names), default=1)
        # Beginnings of pieces are in the tables too, as -2: where none goes on, no longer piece is looked up.
        known: dict[int, dict[str, int]] = {n: {} for n in range(1, self.longest + 1)}
        for name in names:
            for n in range(1, len(name)):
                known[n][name[:n]] = -2
        for name, i in zip(names, plain):
            known[len(name)][name] = i
        self.tables = {n: Table(*self._hashed(list(some.items()))) for n, some in known.items()}
        self.raw = [b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        for value, i in self.byte.items():
            self.raw[i] = bytes([value])
        self.raw_size = np.fromiter(map(len, self.raw), np.int64, size)
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.words = Words()
        self.plain_text = sp.normalize(_PROBE) == SPACE + _PROBE.replace(" ", SPACE)

    @staticmethod
    def sums(codes: np.ndarray) -> np.ndarray:
        """Prefix sums from which the hash of any substring follows."""
        steps = np.full(len(codes), _BASE, np.uint64)
        steps[:1] = 1
        out = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_mixed(codes.astype(np.uint64) + _M3) * np.multiply.accumulate(steps), out=out[1:])
        return out

    def _hashed(self, items: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.sums(np.frombuffer(x.encode("utf-32-le"), np.uint32))[-1] for x, _ in items]
        return np.array(found, np.uint64), np.array([i for _, i in items], np.int32)

    def normalized(self, text: str) -> str:
        if self.plain_text and "\x00" not in text:
            return SPACE + text.replace(" ", SPACE) if text else ""
        return self.sp.normalize(text)

    def units(self, text: str) -> list[str]:
        """The stretches of a normalised text that no piece crosses."""
        if not self.by_word:
            return [text] if text else []
        if SPACE * 2 in text or text.endswith(SPACE) or not text.startswith(SPACE) or "\x00" in text:
            return [u if u[0] == SPACE else "\x00" + u for u in _UNIT.findall(text)]
        return text.split(SPACE)[1:]  # without the space in front, which _Numbers puts back

    def spelling(self, ids: np.ndarray) -> bytes:
        """The bytes that ids spell, with spaces."""
        size = self.raw_size[ids]
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        return self.raw_bytes[np.repeat(self.raw_first[ids] - ends + size, size) + np.arange(ends[-1])].tobytes()

    @staticmethod
    def shown(raw: bytes) -> str:
        """Spelled bytes as a text, without the space in front."""
        out = raw.decode(errors="replace")
        return out[1:] if out.startswith(" ") else out

    def text(self, ids: np.ndarray) -> str:
        """The normalised text that ids spell, with spaces, without the one in front."""
        return self.shown(self.spelling(ids))

    def decode(self, ids: list[int]) -> str:
        """As :meth:`text`, for a list."""
        return self.text(np.array(ids, np.int64))


class Lattice:
    """Word lattices one after the other, as edges by position, longest piece first: id, length, conditional log-probability of
    the step, cumulative probability, and log-probability of all other steps from its position."""

    def __init__(self, units: list[str], vocabulary: Vocabulary):
        v = vocabulary
        size = np.fromiter(map(len, units), np.int64, len(units))
        self.begin = np.cumsum(size + 1) - size - 1  # one place more for the end of each unit
        self.end = self.begin + size
        total = int((size + 1).sum())
        self.codes = np.zeros(total, np.uint32)
        place = np.repeat(self.begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        self.codes[place] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        left = np.zeros(total, np.int32)  # characters to the end of the unit
        left[place] = np.repeat(self.end, size) - place
        sums, back = v.sums(self.codes), np.full(total, _INVERSE, np.uint64)
        back[:1] = 1
        back = np.multiply.accumulate(back)
        parts = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int16))]
        for low in range(0, total, BLOCK):  # pieces by position and length, a block of positions at a time
            ids = np.full((min(BLOCK, total - low), v.longest), -1, np.int32)
            at = low + np.flatnonzero(left[low:low + BLOCK] > 0)
            filled = at
            for n in range(1, v.longest + 1):
                known = v.tables[n].find((sums[at + n] - sums[at]) * back[at])
                there = known >= 0
                ids[at[there] - low, v.longest - n] = known[there]
                at = at[(known != -1) & (left[at] > n)]
            bare = filled[ids[filled - low, -1] < 0]  # no piece spells the character
            ids[bare - low, -1] = len(v.score)
            flat = np.flatnonzero(ids.ravel() >= 0)
            at = flat // v.longest
            parts.append((ids.ravel()[flat], (low + at).astype(np.int32), (v.longest - flat + at * v.longest).astype(np.int16)))
        self.id, self.at, self.length = map(np.concatenate, zip(*parts))
        lost = self.id == len(v.score)
        self.lost = bool(lost.any())
        if self.lost:
            self.id[lost] = -1
        score = v.score[self.id]
        if self.lost:
            score[lost] = v.rarest * utf8_sizes(self.codes[self.at[lost]])
        self.first = np.zeros(total + 1, np.int64)
        np.cumsum(np.bincount(self.at, minlength=total), out=self.first[1:])
        beta = np.zeros(total + 1)
        chance = np.empty(len(score))
        near = left[self.at]
        order = np.argsort(near.astype(np.int16) if near.max(initial=0) < 32767 else near, kind="stable")
        cuts = np.searchsorted(near[order], np.arange(1, int(near.max(initial=0)) + 2))
        at, plain = self.at[order], score[order]
        to = at + self.length[order]
        for d in range(1, len(cuts)):  # positions by their distance from the end of the unit
            low, high = cuts[d - 1], cuts[d]
            if low < high:
                here = at[low:high]
                begins = np.flatnonzero(np.r_[True, here[1:] != here[:-1]])
                each = np.diff(np.r_[begins, len(here)])
                value = plain[low:high] + beta[to[low:high]]
                top = np.maximum.reduceat(value, begins)
                part = np.exp(value - np.repeat(top, each))
                whole = np.add.reduceat(part, begins)
                mass = top + np.log(whole)
                beta[here[begins]] = mass
                score[order[low:high]] = value - np.repeat(mass, each)
                chance[order[low:high]] = part / np.repeat(whole, each)
        self.step, self.chance = score, chance
        some = np.flatnonzero(self.first[1:] > self.first[:-1])
        begins, each = self.first[some], np.diff(self.first)[some]
        sums = np.cumsum(chance) if len(chance) else chance
        self.reach = sums - np.repeat(sums[begins] - chance[begins], each) if len(chance) else sums
        self.reach[begins + each - 1] = np.inf
        if len(chance):
            # the rest beside a step more likely than all others is summed without it, so it keeps its digits
            likely = chance > 0.5
            left = 1 - chance
            rest = np.add.reduceat(np.where(likely, 0, chance), begins)
            left[likely] = np.repeat(rest, each)[likely]
            with np.errstate(divide="ignore"):
                self.others = np.log(left)
        else:
            self.others = chance

    _EDGES = ("id", "length", "step", "chance", "reach", "others")

    def joined(self, more: Lattice) -> Lattice:
        """These word lattices and those of ``more`` after them."""
        out, places = object.__new__(Lattice), len(self.codes)
        for name in self._EDGES:
            setattr(out, name, np.concatenate([getattr(self, name), getattr(more, name)]))
        out.begin, out.end = np.concatenate([self.begin, more.begin + places]), np.concatenate([self.end, more.end + places])
        out.codes, out.at = np.concatenate([self.codes, more.codes]), np.concatenate([self.at, more.at + np.int32(places)])
        out.first = np.concatenate([self.first[:-1], more.first + len(self.id)])
        out.lost = self.lost or more.lost
        return out

    def taken(self, units: np.ndarray) -> Lattice:
        """The lattices of these words alone, in this order."""
        out = object.__new__(Lattice)
        size = self.end[units] - self.begin[units] + 1
        out.begin = np.cumsum(size) - size
        out.end = out.begin + size - 1
        place = np.repeat(self.begin[units] - out.begin, size) + np.arange(int(size.sum()))
        each = np.diff(self.first)[place]
        out.first = np.concatenate([[0], np.cumsum(each)])
        out.codes, out.at = self.codes[place], np.repeat(np.arange(len(place), dtype=np.int32), each)
        edge = np.repeat(self.first[place] - out.first[:-1], each) + np.arange(int(out.first[-1]))
        for name in self._EDGES:
            setattr(out, name, getattr(self, name)[edge])
        out.lost = self.lost
        return out

    def drawn(self, unit: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path through each unit: (steps per unit, edges unit after unit). ``key``: a hash for each."""
        rounds, act, pos, turn = [], np.arange(len(unit)), self.begin[unit], 0
        count = np.zeros(len(unit), np.int64)
        end = self.end[unit]
        while len(act):
            u = _uniform(key[act] + np.uint64(turn) * _M3)
            edge = self.first[pos]
            on = np.flatnonzero(self.reach[edge] < u)
            while len(on):
                edge[on] += 1
                on = on[self.reach[edge[on]] < u[on]]
            rounds.append((act, edge))
            count[act] += 1
            pos = pos + self.length[edge]
            more = pos < end[act]
            act, pos, turn = act[more], pos[more], turn + 1
        offset = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), np.int64)
        for turn, (act, edge) in enumerate(rounds):
            edges[offset[act] + turn] = edge
        return count, edges


class Path:
    """A segmentation: its edges with the word each belongs to, and the values of the sets of paths that leave it.

    From step ``start`` on, all sets together have one value, ``tail``, until the search needs them apart.
    """

    def __init__(self, edges, word, value, sets, total, excluded, start, tail, number):
        self.edges, self.word, self.value, self.sets, self.total, self.excluded = edges, word, value, sets, total, excluded
        self.start, self.tail, self.number = start, tail, number

    def best(self) -> float:
        return max(self.tail, float(self.sets.max(initial=-np.inf)))


def sample(units: list, keys: list[np.uint64], lattice: Lattice, samples: int) -> list[tuple[list[Path], float]]:
    """For each text (its units as numbers of the lattice, a list or array) the paths with the largest values in order, and the value of the best set left."""
    if not units:
        return []
    each = np.fromiter(map(len, units), np.int64, len(units))
    unit = np.concatenate([np.asarray(u, np.int64) for u in units])
    text = np.repeat(np.arange(len(units)), each)
    first = np.cumsum(each) - each
    word = np.arange(len(unit)) - first[text]
    key = np.array(keys, np.uint64)
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        salt = [_mixed(key + np.uint64(s + 1) * _M1) for s in range(samples)]

        def fresh(s: int, some=slice(None)):
            """A path through these words: the words and edges of its steps, and where the steps of each word begin."""
            count, edges = lattice.drawn(unit[some], _mixed(salt[s][text[some]] + word[some].astype(np.uint64) * _M2))
            each = np.zeros(len(unit), np.int64)
            each[some] = count
            return np.repeat(word[some], count), edges, np.concatenate([[0], np.cumsum(each)])

        def noise_of(s: int, t: int, turn: int, size: int, kind: int = 0):
            return _uniform(_mixed(salt[s][t] ^ _M3) + np.arange(turn, turn + size).astype(np.uint64) * _M1 + np.uint64(kind) * _M2)

        def opened(path: Path, t: int) -> None:
            """Values for each set of the tail: one, drawn by their masses, has the tail's value, the others lie below it."""
            step = lattice.step[path.edges]
            location = (np.cumsum(step) - step + lattice.others[path.edges])[path.start:]
            one = int(np.argmax(location - np.log(-np.log(noise_of(path.number, t, path.start, len(location), 1)))))
            apart = _truncated(location, path.tail, noise_of(path.number, t, path.start, len(location), 2))
            apart[one] = path.tail
            path.sets = np.concatenate([path.sets, apart])
            path.tail, path.start = -np.inf, len(path.edges)

        def heads(low: int):
            """For TEXTS texts from ``low`` on: whole value of the first path, its sets up to step HEAD, and the set of the rest."""
            words, edges, steps = drawn
            some = slice(low, low + TEXTS)
            begin, end = steps[first[some]], steps[first[some] + each[some]]
            n = end - begin
            turn = np.arange(HEAD)
            there = turn < n[:, None]
            at = edges[np.minimum(begin[:, None] + turn, max(0, len(edges) - 1))] if len(edges) else np.zeros(there.shape, np.int64)
            step, others = (lattice.step[at], lattice.others[at]) if len(edges) else (np.zeros(at.shape), np.zeros(at.shape))
            step = np.where(there, step, 0.0)
            total = np.cumsum(step, axis=1)
            every = np.append(lattice.step[edges[begin[0]:end[-1]]], 0.0)
            whole = np.where(n > 0, np.add.reduceat(every, begin - begin[0]), 0.0)
            rest = whole - total[:, -1]
            more = n > HEAD
            for i in np.flatnonzero(more & (rest >= -1e-9)):
                more[i] = np.isfinite(lattice.others[edges[begin[i] + HEAD:end[i]]]).any()
            mass = np.where(more, total[:, -1] + np.log(-np.expm1(np.minimum(rest, -1e-300))), -np.inf)
            noise = _uniform(_mixed(salt[0][some] ^ _M3)[:, None] + np.arange(HEAD + 1).astype(np.uint64) * _M1)
            sets = _truncated(np.where(there, total - step + others, -np.inf), top[some, None], noise[:, :HEAD])
            return whole, sets, _truncated(mass, top[some], noise[np.arange(len(n)), np.minimum(n, HEAD)])

        drawn = fresh(0)
        top = -np.log(-np.log(_uniform(key ^ _M2)))
        found: list[list[Path]] = []
        for t in range(len(units)):
            if t % TEXTS == 0:
                whole_of, sets_of, tail_of = heads(t)
            words, edges, steps = drawn
            begin, end = steps[first[t]], steps[first[t] + each[t]]
            start, i = min(int(end - begin), HEAD), t % TEXTS
            found.append([Path(edges[begin:end], words[begin:end], float(top[t]), sets_of[i, :start].copy(), float(whole_of[i]), {}, start,
                               float(tail_of[i]), 0)])
        for s in range(1, samples):
            chosen, some = [], np.zeros(len(unit), bool)
            for t, paths in enumerate(found):
                lead = [p.best() for p in paths]
                which = int(np.argmax(lead))
                if np.isneginf(lead[which]):
                    continue
                parent = paths[which]
                if parent.tail == lead[which]:
                    opened(parent, t)
                cut = int(parent.sets.argmax())
                parent.sets[cut] = -np.inf
                w = int(parent.word[cut])
                some[first[t] + w + 1:first[t] + each[t]] = True  # the words after the cut, which are drawn anew
                chosen.append((t, parent, cut, w, float(lead[which])))
            drawn_words, drawn_edges, steps = fresh(s, some)
            for t, parent, cut, w, value in chosen:
                gone = parent.excluded.get(cut, frozenset()) | {int(parent.edges[cut])}
                node = int(lattice.at[parent.edges[cut]])
                noise = _mixed(salt[s][t:t + 1] + np.uint64(w) * _M3)
                new, ends = [], int(lattice.end[units[t][w]])
                while node < ends:
                    low, high = lattice.first[node], lattice.first[node + 1]
                    chance = lattice.chance[low:high].copy()
                    if not new:
                        chance[[e - low for e in gone]] = 0
                    reach = np.cumsum(chance)
                    if len(new) % HEAD == 0:
                        us = _uniform(noise + np.arange(len(new), len(new) + HEAD).astype(np.uint64) * _M2).tolist()
                    u = us[len(new) % HEAD]
                    new.append(int(low) + min(int(np.searchsorted(reach, u * reach[-1], side="right")), int(np.flatnonzero(chance)[-1])))
                    node += int(lattice.length[new[-1]])
                later = slice(steps[first[t] + w + 1], steps[first[t] + each[t]])
                edges = np.concatenate([parent.edges[:cut], new, drawn_edges[later]])
                words = np.concatenate([parent.word[:cut], np.full(len(new), w), drawn_words[later]])
                step = lattice.step[edges]
                whole, start = float(step.sum()), min(len(edges), cut + HEAD)
                total = np.cumsum(step[:start])
                location = total[cut:] - step[cut:start] + lattice.others[edges[cut:start]]
                # what leaves here besides the steps already taken from this set
                low, high = lattice.first[lattice.at[edges[cut]]], lattice.first[lattice.at[edges[cut]] + 1]
                chance = lattice.chance[low:high].copy()
                chance[[e - low for e in gone | {int(edges[cut])}]] = 0
                left = chance.sum()
                location[0] = total[cut] - step[cut] + np.log(left) if left > 0 else -np.inf
                # all paths that share the first ``start`` steps, but this one
                rest = whole - float(total[-1]) if start else 0.0
                more = start < len(edges) and (rest < -1e-9 or np.isfinite(lattice.others[edges[start:]]).any())
                mass = float(total[-1]) + log(-expm1(min(rest, -1e-300))) if more else -np.inf
                drawn_sets = _truncated(np.append(location, mass), value, noise_of(s, t, cut, len(location) + 1))
                sets = np.full(start, -np.inf)
                sets[cut:] = drawn_sets[:-1]
                found[t].append(Path(edges, words, value, sets, whole, {cut: gone}, start, float(drawn_sets[-1]), s))
    return [(paths, max((p.best() for p in paths), default=-np.inf)) for paths in found]


def spelled(path: Path, lattice: Lattice, vocabulary: Vocabulary) -> np.ndarray:
    """The ids of a path."""
    ids = lattice.id[path.edges]
    lost = np.flatnonzero(ids < 0) if lattice.lost else ()
    if not len(lost):
        return ids
    codes = lattice.codes[lattice.at[path.edges[lost]]]
    times = np.ones(len(ids), np.int64)
    times[lost] = utf8_sizes(codes)
    out = np.repeat(ids, times)
    raw = codes.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    out[out < 0] = vocabulary.of_byte[np.frombuffer(raw, np.uint8)]
    return out


def _chunks(rows: list[tuple], size: int) -> Iterator[list[tuple]]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[1] or "")
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


class _Numbers(dict):
    """Numbers of units in the order in which they come up; one without a space in front stands for one with, and
    a zero character in front for none."""

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        return number

    def units(self, start: int = 0) -> list[str]:
        """The units from this number on."""
        return [u if u[:1] == SPACE else u[1:] if u[:1] == "\x00" else SPACE + u for u in islice(self, start, None)]


class Words:
    """Word lattices that a worker keeps: numbers of the words, their lattices, and how often they came up lately."""

    def __init__(self):
        self.number, self.lattice, self.count = _Numbers(), None, np.zeros(0, np.int64)

    def lattices(self, v: Vocabulary) -> Lattice:
        """The lattices of all words numbered so far; those of new words are built."""
        more = self.number.units(0 if self.lattice is None else len(self.lattice.begin))
        if more or self.lattice is None:
            built = Lattice(more, v)
            self.lattice = built if self.lattice is None else self.lattice.joined(built)
        return self.lattice

    def keep(self, units: list[np.ndarray]) -> None:
        """Keep the most frequent words up to KEPT characters; ``units``: the words of the last chunk. Counts, in sixteenths, lose an eighth
        with each chunk, so a word seen once stays for some chunks where there is room."""
        count = 16 * np.bincount(np.concatenate(units), minlength=len(self.number))
        count[:len(self.count)] += self.count * 7 // 8
        order = np.argsort(-count, kind="stable")
        size = (self.lattice.end - self.lattice.begin + 1)[order]
        order = np.sort(order[(np.cumsum(size) <= KEPT) & (count[order] > 0)])
        names = list(self.number)
        self.lattice, self.count = self.lattice.taken(order), count[order]
        self.number = _Numbers(zip(map(names.__getitem__, order.tolist()), range(len(order))))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of several batches, as many as make a chunk of text."""
    held, size = [], 0
    for batch in batches:
        for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            held.append(row)
            size += len(row[1] or "")
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def vocabulary(path: str, sharpness: float = SHARPNESS) -> Vocabulary:
    return per_worker(("pieces", path, sharpness), lambda: Vocabulary(path, sharpness))


def segmentations(rows: list[tuple], v: Vocabulary, samples: int, seed: int) -> Iterator[tuple]:
    """(key, rank, ids, log_prob, perturbed, inclusion, normalised text) for (key, text) rows."""
    for chunk in _chunks(rows, CHUNK):
        number = v.words.number if v.by_word else _Numbers()
        texts = [v.normalized(text or "") for _, text in chunk]
        units = [np.fromiter(map(number.__getitem__, u), np.int64, len(u)) for u in map(v.units, texts)]
        lattice = v.words.lattices(v) if v.by_word else Lattice(list(number), v)
        keys = [_row_key(key, seed) for key, _ in chunk]
        for (key, _), text, (paths, threshold) in zip(chunk, texts, sample(units, keys, lattice, samples)):
            for rank, path in enumerate(paths, 1):
                chance = 1.0 if np.isneginf(threshold) else float(-np.expm1(-np.exp(min(path.total - threshold, 700.0))))
                yield key, rank, spelled(path, lattice, v), path.total, path.value, chance, text
        if v.by_word:
            v.words.keep(units)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES, seed: int = SEED,
           sharpness: float = SHARPNESS, with_ids: bool = True, decoded: str | None = None) -> DataFrame:
    """doc_id, sample (1 has the largest perturbed value), n_ids, ids, ids_crc32 (little-endian unsigned 32-bit), log_prob, perturbed, inclusion, round_trip.

    ``samples`` distinct segmentations of each whole text, or all where there are fewer; a NULL or empty text has the one
    without pieces. inclusion: probability that a segmentation is among the sampled, given the threshold. round_trip: whether
    the ids decode to the normalised text. ``decoded`` names a further column for the text the ids spell, as :func:`decode` gives it, without a second
    pass of the ids through a worker. Repeated rows give equal rows; an empty table gives none. Other columns are not looked at.
    """
    schema = ("doc_id long, sample int, n_ids long, ids array<int>, ids_crc32 long, log_prob double, perturbed double, inclusion double, "
              "round_trip boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path, sharpness)
        for rows in _gathered(batches):
            found = []
            for key, rank, ids, total, value, chance, normal in segmentations(rows, v, samples, seed):
                if rank == 1:
                    plain = normal.replace(SPACE, " ").encode()
                raw = v.spelling(ids)
                found.append((key, rank, len(ids), ids if with_ids else None, zlib.crc32(ids.astype("<u4").tobytes()), total, value, chance, raw == plain,
                              *([v.shown(raw)] if decoded else [])))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
            names = ["doc_id", "sample", "n_ids", "ids", "ids_crc32", "log_prob", "perturbed", "inclusion", "round_trip"]
            if decoded:
                kinds, names = [*kinds, pa.string()], [*names, decoded]
            columns = list(zip(*found)) or [[]] * len(kinds)
            del found
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, schema + (f", `{decoded}` string" if decoded else ""))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the text their ids spell in a further column ``out``; NULL ids give NULL."""

    @F.arrow_udf("string")
    def spell(column):
        v = vocabulary(path)
        flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        texts = (v.text(flat[a:b]) if there else None for a, b, there in zip(ends, ends[1:], column.is_valid().to_pylist()))
        return pa.array(texts, pa.string())

    return rows.withColumn(out, spell(F.col(ids)))
