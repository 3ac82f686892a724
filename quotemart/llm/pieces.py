"""SentencePiece merge-type encoding with seeded merge-dropout, and lossless decoding.

Merges are taken from an agenda, best score first and leftmost first among equals, as the model's own
library does; at dropout 0 the pieces are the same. With dropout each candidate that comes up is
skipped if a hash keyed by seed, text, the word's place, word and the candidate's turn falls below the
rate: every occurrence of a word has its own draw. A seed fixes every segmentation on every executor,
other seeds give others, and none depends on the order of work. Whatever the pieces, they decode to
the text they came from.

Texts are cut where no piece of the model reaches across: before space marks, and between letters and
the signs after them. Merges never cross such a place, so each word is an agenda of its own. What an
agenda gives depends on the word and the turns skipped before it ends, so a worker keeps results by
these: occurrences share one only if their draws skip the same turns.
"""

from __future__ import annotations

import heapq
import re
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemart.llm.common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# A mark that the text itself holds; no UTF-8 text has a lone surrogate.
HELD = "\ud800"
NEVER = float("inf")
# Longest word whose agenda is searched from end to end.
SHORT = 40
# Results a worker keeps: some 115 MB with the texts at hand, as measured.
KEPT = 300_000
# Short words are merged so many at a time, in rows of these widths. The rank of what doesn't merge.
WIDTHS, TOGETHER = (8, 12, 16, 32), 8_000
LAST = np.int32(2**31 - 1)
# Rows of words that are done stay among the others up to this share of open ones.
KEEP = 0.8
# Fewer words than this are merged one by one.
FEW = 64
# Turns of a short word that are looked at in one go, those of them drawn first, and turns of 16 bits in a number drawn.
TURNS, FIRST, PER = 64, 16, 4
MASK = 2**64 - 1
# Ids that are turned to bytes in one go.
DECODED = 1 << 16
# Odd steps between the numbers of neighbouring words and blocks of turns.
PLACE, BLOCK = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def word_pattern(pieces: Iterable[str]) -> str:
    """Pattern of words that no piece reaches out of: space marks, signs, then letters and digits.

    Letters that some piece has before a sign or a space mark count as signs.
    """
    open_ = {a for p in pieces for a, b in zip(p, p[1:], strict=False) if re.match(r"\w\W", a + b)}
    other = "|[" + re.escape("".join(sorted(open_))) + "]+" if open_ else ""
    letter = r"[^\W" + re.escape("".join(sorted(open_))) + "]"
    # The commonest kind of word comes first; no text begins words of two kinds.
    return f"{MARK}*{letter}+|{MARK}*(?:[^\\w{MARK}\n]+{other})+{letter}*|\n|{MARK}+"


@dataclass
class Vocabulary:
    """Pieces of a merge-type model with byte fallback."""

    pieces: list[bytes]
    ids: dict[str, int]
    order: dict[str, float]
    first_byte: int
    prefix: bool
    word: str

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        """Read a model file on the driver; tasks get the parsed pieces."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, ids, order, first_byte = [], {}, {}, None
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                first_byte = k if first_byte is None else first_byte
                pieces.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(k) or model.is_unknown(k):
                pieces.append(b"")
            else:
                pieces.append(piece.replace(MARK, " ").encode())
                ids[piece], order[piece] = k, -model.get_score(k)
        if first_byte is None or any(MARK in p.lstrip(MARK) or "\n" in p for p in ids):
            raise ValueError("the model must have byte pieces, and space marks only at the start of pieces")
        prefix = [pieces[k] for k in model.encode("a")][0][:1] == b" "
        return Vocabulary(pieces, ids, order, first_byte, prefix, word_pattern(ids))


def mixed(x: np.ndarray) -> np.ndarray:
    """Evenly spread 64-bit numbers from any, the same from the same; the finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salt(word: str) -> int:
    """A word's part in its keys."""
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def salts(words: list[str]) -> np.ndarray:
    """The words' parts in their keys."""
    try:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    except UnicodeEncodeError:
        # Some word has a mark that the text itself holds.
        return np.fromiter(map(salt, words), np.uint64, len(words))


def drawn(keys: np.ndarray, first: int, last: int, below: int) -> np.ndarray:
    """Bit ``t`` tells whether a key's turn ``t`` is skipped, for turns from ``first`` to before ``last``, both multiples of ``PER``."""
    out = np.zeros(len(keys), dtype=np.uint64)
    for block in range(first // PER, last // PER):
        numbers = mixed(keys + np.uint64((block + 1) * BLOCK & MASK))
        for k in range(PER):
            gone = (numbers >> np.uint64(16 * k)) & np.uint64(0xFFFF) < np.uint64(below)
            out |= gone.astype(np.uint64) << np.uint64(block * PER + k)
    return out


class Turns:
    """Which candidates of an occurrence of a word are skipped: 16 bits of a keyed hash for each turn, below a bound or not."""

    def __init__(self, word: str, key: int, below: int):
        self.key = np.array([salt(word) ^ key], dtype=np.uint64)
        self.below, self.turn, self.bits = below, 0, 0

    def skipped(self) -> bool:
        """Whether the candidate whose turn it is goes."""
        at = self.turn % TURNS
        if not at:
            # Each window of turns has numbers of its own.
            self.bits = int(drawn(self.key + np.uint64(self.turn // PER * BLOCK & MASK), 0, TURNS, self.below)[0])
        self.turn += 1
        return bool(self.bits >> at & 1)


class Skips:
    """The turns that a mask's bits name are skipped, no others."""

    def __init__(self, mask: int):
        self.mask, self.turn = mask, 0

    def skipped(self) -> bool:
        """Whether the candidate whose turn it is goes."""
        self.turn += 1
        return bool(self.mask >> (self.turn - 1) & 1)


def segment(word: str, order: dict[str, float], turns: Turns | Skips | None = None) -> list[str]:
    """Pieces of a word: the agenda's candidates are merged from the best down, but for those skipped.

    A skipped candidate comes up again only if a neighbouring merge changes it.
    """
    return (_short if len(word) <= SHORT else _long)(word, order, turns and turns.skipped)


def _short(word: str, order: dict[str, float], skipped: Callable[[], bool] | None) -> list[str]:
    """The agenda as a list of scores, one for each pair of neighbours."""
    parts = list(word)
    get = order.get
    agenda = [get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
    while agenda and (best := min(agenda)) != NEVER:
        k = agenda.index(best)
        if skipped and skipped():
            agenda[k] = NEVER
            continue
        both = parts[k] + parts.pop(k + 1)
        parts[k] = both
        del agenda[k]
        if k < len(agenda):
            agenda[k] = get(both + parts[k + 1], NEVER)
        if k:
            agenda[k - 1] = get(parts[k - 1] + both, NEVER)
    return parts


def _long(word: str, order: dict[str, float], skipped: Callable[[], bool] | None) -> list[str]:
    """The agenda as a heap, for time in proportion to n log n."""
    size = len(word)
    # A symbol is named by its start; ``end`` is 0 for symbols merged into the one before.
    end, before = list(range(1, size + 1)), list(range(-1, size - 1))
    agenda = [(order[p], k, k + 2) for k in range(size - 1) if (p := word[k : k + 2]) in order]
    middles = {(k, k + 2): k + 1 for _, k, _ in agenda}
    heapq.heapify(agenda)
    while agenda:
        _, start, stop = heapq.heappop(agenda)
        middle = middles[start, stop]
        if end[start] != middle or end[middle] != stop or (skipped and skipped()):
            continue
        end[start], end[middle] = stop, 0
        if stop < size:
            before[stop] = start
            far = end[stop]
            if (p := word[start:far]) in order:
                middles[start, far] = stop
                heapq.heappush(agenda, (order[p], start, far))
        if start:
            left = before[start]
            if (p := word[left:stop]) in order:
                middles[left, stop] = start
                heapq.heappush(agenda, (order[p], left, stop))
    found, at = [], 0
    while at < size:
        found.append(word[at : end[at]])
        at = end[at]
    return found


class Merges:
    """Merges of many short words at a time: a row for each word, a step of every word's agenda in one go."""

    def __init__(self, vocabulary: Vocabulary):
        ids, order = vocabulary.ids, vocabulary.order
        found = {}
        for piece, whole in ids.items():
            for k in range(1, len(piece)):
                a, b = ids.get(piece[:k]), ids.get(piece[k:])
                if a is not None and b is not None:
                    found[a, b] = (order[piece], whole)
        # Symbols from ``other`` on are no piece: they stand for the code points of letters.
        self.other = len(vocabulary.pieces)
        self.kind = np.uint32 if self.other < 2**16 else np.uint64
        rank = {score: k for k, score in enumerate(sorted({v[0] for v in found.values()}))}
        codes = np.array([a * self.other + b for a, b in found], dtype=self.kind)
        # Pairs lie by slot; most slots have one or none, so that a look at the first nearly always tells.
        bits = (4 * len(codes)).bit_length()
        self.shift = self.kind(8 * codes.itemsize - bits)
        slots = self.slots(codes)
        order = np.argsort(slots, kind="stable")
        self.held = np.bincount(slots, minlength=2**bits).astype(np.int32)
        self.first = (np.cumsum(self.held) - self.held).astype(np.int32)
        # An empty slot at the end has something to look at, too.
        order = np.append(order, order[-1:])
        self.codes = codes[order]
        self.ranks = np.array([rank[score] for score, _ in found.values()], dtype=np.int32)[order]
        self.wholes = np.array([whole for _, whole in found.values()], dtype=np.int32)[order]
        # The symbol of each code point.
        self.letters = np.arange(self.other, self.other + sys.maxunicode + 1, dtype=np.int32)
        for piece, k in ids.items():
            if len(piece) == 1:
                self.letters[ord(piece)] = k

    def slots(self, codes: np.ndarray) -> np.ndarray:
        """Slots of codes of pairs, evenly spread."""
        return codes * self.kind(PLACE >> (64 - 8 * codes.itemsize) | 1) >> self.shift

    def pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs of symbols, the best first, and what they merge to; what is no piece merges with nothing."""
        # Without a sign, the place after the end is above all pieces, too.
        a, b = a.view(np.uint32), b.view(np.uint32)
        codes = a.astype(self.kind) * self.kind(self.other) + b
        slots = self.slots(codes)
        at = self.first[slots]
        same = self.codes[at] == codes
        rest, step = np.flatnonzero(~same), 1
        while len(rest := rest[self.held[slots[rest]] > step]):
            at[rest] += 1
            same[rest] = self.codes[at[rest]] == codes[rest]
            rest, step = rest[~same[rest]], step + 1
        same &= (a < self.other) & (b < self.other)
        return np.where(same, self.ranks[at], LAST), self.wholes[at]

    def symbols(self, words: list[str], width: int) -> np.ndarray:
        """Symbols of words of up to ``width`` letters: ids of pieces, ``other`` plus the code point of others, -1 after the end."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        out = np.full((len(words), width), -1, dtype=np.int32)
        out[np.arange(width) < sizes[:, None]] = self.letters[points]
        return out

    def segment(self, words: list[str], width: int, skipped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols of the words, a row each with -1 in the places that merges left, and how many turns they had: one more than ``skipped`` has columns if these are too few."""
        count, wide = len(words), width + 1
        # The last place of a row stands for whatever lies before or after the word.
        now = np.full((count, wide), -1, dtype=np.int32)
        now[:, :width] = self.symbols(words, width)
        done, turns = np.full((count, width), -1, dtype=np.int32), np.zeros(count, dtype=np.int64)
        scores, wholes = np.full((count, wide), LAST, dtype=np.int32), np.zeros((count, wide), dtype=np.int32)
        there = np.flatnonzero(now[:, 1:].ravel() >= 0)
        there += there // width
        scores.ravel()[there], wholes.ravel()[there] = self.pairs(now.ravel()[there], now.ravel()[there + 1])
        # The places of the symbols beside each symbol.
        after = np.tile(np.arange(1, wide + 1, dtype=np.int8), (count, 1))
        before = np.tile(np.append(width, np.arange(width)).astype(np.int8), (count, 1))
        row = np.arange(count)
        turn = 0
        while len(row):
            at = scores.argmin(1)
            start = np.arange(len(row)) * wide
            open_ = scores.ravel()[start + at] != LAST
            if turn == skipped.shape[1]:
                turns[row[open_]] = turn + 1
                done[row] = now[:, :width]
                break
            going = np.flatnonzero(open_)
            if len(going) < KEEP * len(row):
                # Closed rows go, once they are many.
                done[row[~open_]] = now[~open_, :width]
                row, now, scores, wholes, after, before, at = (x[going] for x in (row, now, scores, wholes, after, before, at))
                going = np.arange(len(row))
                start = going * wide
            turns[row[going]] = turn + 1
            gone = skipped[row[going], turn]
            off = going[gone]
            scores.ravel()[start[off] + at[off]] = LAST
            merging = going[~gone]
            turn += 1
            base = start[merging]
            flat, score, whole, right, left = now.ravel(), scores.ravel(), wholes.ravel(), after.ravel(), before.ravel()
            k = base + at[merging]
            gap = base + right[k]
            far, near = base + right[gap], base + left[k]
            flat[k], flat[gap], score[gap] = whole[k], -1, LAST
            right[k], left[far] = right[gap], at[merging]
            # What lies outside the word merges with nothing.
            merged = flat[k]
            beside = np.concatenate([k, near])
            score[beside], whole[beside] = self.pairs(np.concatenate([merged, flat[near]]), np.concatenate([flat[far], merged]))
        return done, turns


class Roots(dict[str, int]):
    """Nodes of words; a word looked up for the first time is noted with a number below -1, from -2 down."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = found = -1 - len(self.new)
        return found


class Encoder:
    """Encodes texts; keeps what it found for short words.

    Each word with the turns skipped so far is a node: the word's pieces if no other turn is skipped,
    and the number of turns until then. The node after the next skipped turn is its child.
    """

    def __init__(self, vocabulary: Vocabulary, dropout: float = 0.0, seed: int = 0, epoch: int = 1):
        if not 0 <= dropout <= 1 or epoch < 1:
            raise ValueError("dropout must be from 0 to 1 and epochs count from 1")
        self.vocabulary, self.merges = vocabulary, Merges(vocabulary)
        # The rate in 65,536ths.
        self.below = round(dropout * 2**16)
        self.find = re.compile(vocabulary.word).findall
        self.key = xxhash.xxh64_intdigest(b"%d %d" % (seed, epoch))
        self.clear()

    def clear(self) -> None:
        """Forget the words found so far."""
        self.roots = Roots()
        self.children: dict[int, int] = {}
        # Of each node: its word, skipped turns, and where its ids start; then the ids of all.
        self.named: list[str] = []
        self.count, self.filled = 0, 0
        self.salts, self.masks = (np.zeros(1024, dtype=np.uint64) for _ in range(2))
        self.turns, self.starts, self.sizes = (np.zeros(1024, dtype=np.int64) for _ in range(3))
        self.pool = np.zeros(8192, dtype=np.int32)

    def ids(self, parts: list[str]) -> list[int]:
        """Ids of pieces; what is no piece is given byte by byte."""
        get, first, found = self.vocabulary.ids.get, self.vocabulary.first_byte, []
        for p in parts:
            k = get(p)
            found.extend([k] if k is not None else [first + b for b in (MARK if p == HELD else p).encode()])
        return found

    def word(self, word: str, key: int) -> list[int]:
        """Ids of a word whose place has this key."""
        return self.ids(segment(word, self.vocabulary.order, Turns(word, key, self.below) if self.below else None))

    def grow(self, nodes: int, ids: int) -> None:
        """Make room for so many more nodes and ids."""
        for name, filled, more in (("salts", self.count, nodes), ("masks", self.count, nodes), ("turns", self.count, nodes), ("starts", self.count, nodes), ("sizes", self.count, nodes), ("pool", self.filled, ids)):
            old = getattr(self, name)
            if filled + more > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(max(len(old) // 2, filled + more - len(old)), dtype=old.dtype)]))

    def add(self, words: list[str], masks: np.ndarray, salts: np.ndarray) -> np.ndarray:
        """Make nodes of short words and their skipped turns, and say which they are."""
        first, order = self.count, np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
        out = np.empty(len(words), dtype=np.int64)
        out[order] = first + np.arange(len(words))
        words, masks = [words[k] for k in order.tolist()], masks[order]
        sizes = list(map(len, words))
        ends = [bisect_right(sizes, width) for width in WIDTHS]
        self.grow(len(words), 0)
        self.salts[first : first + len(words)], self.masks[first : first + len(words)] = salts[order], masks
        for width, a, b in zip(WIDTHS, (0, *ends), ends, strict=False):
            for at in range(a, b, TOGETHER):
                self.fill(words[at : min(at + TOGETHER, b)], masks[at : min(at + TOGETHER, b)], width)
        self.named += words
        return out

    def fill(self, words: list[str], masks: np.ndarray, width: int) -> None:
        """Append pieces and numbers of turns of words of up to ``width`` letters, all at once."""
        count = len(words)
        if count >= FEW:
            skipped = masks[:, None] >> np.arange(TURNS, dtype=np.uint64) & np.uint64(1) > 0
            symbols, turns = self.merges.segment(words, width, skipped)
            there = symbols >= 0
            # Most words consist of pieces only; the others one by one.
            odd = np.flatnonzero((symbols >= self.merges.other).any(1)).tolist()
            found, sizes = symbols[there], there.sum(1)
        else:
            odd, found = range(count), np.zeros(0, dtype=np.int32)
            turns, sizes = np.zeros((2, count), dtype=np.int64)
        starts, more = np.cumsum(sizes) - sizes, []
        for k in odd:
            skips = Skips(int(masks[k]))
            own = self.ids(segment(words[k], self.vocabulary.order, skips))
            turns[k], starts[k], sizes[k] = min(skips.turn, TURNS + 1), len(found) + len(more), len(own)
            more += own
        self.grow(count, len(found) + len(more))
        here = slice(self.count, self.count + count)
        self.turns[here], self.starts[here], self.sizes[here] = turns, self.filled + starts, sizes
        for ids in (found, more):
            self.pool[self.filled : self.filled + len(ids)] = ids
            self.filled += len(ids)
        self.count += count

    def follow(self, nodes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The nodes that occurrences with these keys end at, from those of their words; -1 where the turns are too many to look at in one go."""
        keys = keys ^ self.salts[nodes]
        masks = drawn(keys, 0, FIRST, self.below)
        ones = np.uint64(1)
        before = lambda n: np.where(n >= TURNS, ~np.uint64(0), (ones << np.minimum(n, TURNS - 1).astype(np.uint64)) - ones)
        out = nodes.copy()
        at = np.flatnonzero((self.turns[nodes] > FIRST) | (masks & before(self.turns[nodes]) != 0))
        masks = masks[at] | drawn(keys[at], FIRST, TURNS, self.below)
        # The masks lose the turns that a node has skipped already.
        while len(at):
            turns = self.turns[out[at]]
            left = masks & before(turns)
            # Of a node with too many turns, only what lies past its last skip is unknown.
            out[at[(left == 0) & (turns > TURNS)]] = -1
            going = left != 0
            at, masks, left = at[going], masks[going], left[going]
            if not len(at):
                break
            lowest = left & (~left + ones)
            masks ^= lowest
            turn = np.log2(lowest.astype(np.float64)).astype(np.int64)
            steps, which = np.unique(out[at] * TURNS + turn, return_inverse=True)
            steps = steps.tolist()
            children = list(map(self.children.get, steps))
            missing = [k for k, child in enumerate(children) if child is None]
            if missing:
                own = np.array([steps[k] for k in missing])
                parents = own // TURNS
                skipped = self.masks[parents] | ones << (own % TURNS).astype(np.uint64)
                made = self.add([self.named[p] for p in parents.tolist()], skipped, self.salts[parents]).tolist()
                for k, child in zip(missing, made, strict=True):
                    children[k] = self.children[steps[k]] = child
            out[at] = np.array(children, dtype=np.int64)[which]
        return out

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, which should be about a slice."""
        if self.count > KEPT:
            self.clear()
        words, ends, keys = [], [], []
        for text in texts:
            marked = text.replace(MARK, HELD).replace(" ", MARK)
            some = self.find(MARK + marked if self.vocabulary.prefix and text else marked)
            words += some
            ends.append(len(words))
            own = xxhash.xxh3_64_intdigest(text.encode(), self.key)
            keys.append(np.uint64(own) + np.arange(1, len(some) + 1, dtype=np.uint64) * np.uint64(PLACE))
        keys = mixed(np.concatenate(keys)) if keys else np.zeros(0, dtype=np.uint64)
        nodes = np.fromiter(map(self.roots.__getitem__, words), np.int64, len(words))
        new, self.roots.new = self.roots.new, []
        if new:
            # No node is kept of long words: -1 stands for them.
            made = np.full(len(new), -1, dtype=np.int64)
            fit = np.flatnonzero(np.fromiter(map(len, new), np.int64, len(new)) <= WIDTHS[-1])
            some = [new[k] for k in fit.tolist()]
            made[fit] = self.add(some, np.zeros(len(some), dtype=np.uint64), salts(some))
            self.roots.update(zip(some, made[fit].tolist(), strict=True))
            if len(some) < len(new):
                for k in np.flatnonzero(made < 0).tolist():
                    del self.roots[new[k]]
            first = np.flatnonzero(nodes < 0)
            nodes[first] = made[-2 - nodes[first]]
        short = np.flatnonzero(nodes >= 0)
        if self.below and len(short):
            nodes[short] = self.follow(nodes[short], keys[short])
        # Long words, and those with many turns, one by one; a node of no ids stands for them.
        alone = np.flatnonzero(nodes < 0).tolist()
        own = [np.array(self.word(words[k], int(keys[k])), dtype=np.int32) for k in alone]
        pool = np.concatenate([self.pool[: self.filled], *own])
        starts, sizes = self.starts[nodes], self.sizes[nodes]
        if alone:
            sizes[alone] = list(map(len, own))
            starts[alone] = self.filled + np.cumsum([0, *map(len, own)])[:-1]
        before = np.cumsum(sizes) - sizes
        found = pool[np.repeat(starts - before, sizes) + np.arange(sizes.sum())]
        cuts = np.append(before, sizes.sum())[ends].tolist() if texts else []
        return [found[a:b] for a, b in zip([0, *cuts], cuts)]  # noqa: B905

    def text(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return self.texts([text])[0]


class Decoder:
    """Decodes ids of many texts at a time, from the bytes of all pieces in a row."""

    def __init__(self, pieces: list[bytes], prefix: bool):
        self.prefix = prefix
        # The last piece stands for ids outside the vocabulary.
        self.bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.sizes = np.array([*map(len, pieces), 0], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, ids: np.ndarray) -> bytes:
        """Bytes of the pieces one after another."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(sizes.sum())].tobytes()

    def texts(self, rows: list[np.ndarray]) -> list[str]:
        """Texts of ids, which should be about a slice; ids outside the vocabulary and control pieces give nothing, broken UTF-8 the replacement mark."""
        if not rows:
            return []
        ids, last = np.concatenate(rows), len(self.sizes) - 1
        ids = np.where((ids >= 0) & (ids < last), ids, last).astype(np.int64)
        cuts = np.append(0, np.cumsum(self.sizes[ids]))[np.cumsum([0, *map(len, rows)])].tolist()
        raw = b"".join([self.joined(ids[at : at + DECODED]) for at in range(0, len(ids), DECODED)])
        bare = [a + 1 if self.prefix and raw[a : min(a + 1, b)] == b" " else a for a, b in zip(cuts, cuts[1:])]  # noqa: B905
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(bare, cuts[1:], strict=True)]


def decode_ids(ids: np.ndarray, pieces: list[bytes], prefix: bool) -> str:
    """Text of ids, as a decoder gives it."""
    return Decoder(pieces, prefix).texts([ids])[0]


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """Text of ids; null gives null, no ids the empty text."""
    pieces, prefix = vocabulary.pieces, vocabulary.prefix

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(pieces, prefix)
        for rows in batches:
            given = [np.zeros(0, dtype=np.int32) if r is None else np.asarray(r) for r in rows]
            texts: list[str] = []
            for a, b in slices([len(r) for r in given]):
                texts += decoder.texts(given[a:b])
            yield pd.Series([None if r is None else t for r, t in zip(rows, texts, strict=True)], dtype=object)

    return of(ids)


def encoded(
    docs: DataFrame, model: str = MODEL, dropout: float = 0.1, seed: int = 0, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document row: (doc_id, ids, n_tokens, lossless).

    Rows are passed on slice by slice, so that a task holds the ids of a slice only. ``lossless``
    tells that the ids decode to the text. A null text has null ids, 0 tokens and is
    lossless, an empty one no ids. Repeated rows give repeated rows with the same ids, an empty table
    gives no rows, other columns play no part.
    """
    vocabulary = Vocabulary.load(model)
    # Ids go as text: in a frame, a null would turn whole numbers into fractions.
    given = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, decoder = Encoder(vocabulary, dropout, seed), Decoder(vocabulary.pieces, vocabulary.prefix)
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for a, b in slices([len(t) for t in texts]):
                ids = encoder.texts(texts[a:b])
                same = [found == t for found, t in zip(decoder.texts(ids), texts[a:b], strict=True)]
                part, known = frame.iloc[a:b], frame["text"].iloc[a:b].notna()
                rows = [k if there else None for k, there in zip(ids, known, strict=True)]
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": pd.Series(rows, index=part.index, dtype=object), "n_tokens": [len(k) for k in ids], "lossless": same})

    found = given.mapInPandas(encode, "doc_id string, ids array<int>, n_tokens long, lossless boolean")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
