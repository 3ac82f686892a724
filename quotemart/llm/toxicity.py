"""Toxicity behind a noisy channel: disguised words are restored by Viterbi decoding, then the text is scored.

Writers disguise words by lookalike signs (1d10t), by repeating letters (idiooot) and by spacing them
out (i d i o t). A piece of text that may be disguised becomes a lattice: at each place the letters
that the sign there can stand for, the sign as a word's end, one or two letters for a run of equal
ones, and nothing or a word's end for a separator. The Viterbi path under the channel's
probabilities and a letter trigram model of the whole corpus is the restored text. Elsewhere the
lattice has a single path, the text as it is, and nothing is decoded. A token's signs may as well all
be letters (1d107), which the letter model alone would rather take for ends of words; the words so
read count besides.

Restored words and their stems are weighed by how surely they mark a document as toxic: the lower
confidence bound of the share of toxic documents among those with them. A word is counted once for
each pair of neighbours it stands between, so that copies of a document count once. The score is the
chance that at least one of a document's marks is right; words with the same stem count once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from math import log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemart.llm.common import fresh, slices
from quotemart.llm.labelled import sample

# At most so many labelled documents are learnt from.
ROWS = 6_000
# A word or stem marks a document if it stands between so many pairs of neighbours in toxic ones, and is this sure.
SEEN, SURE = 5, 0.7
# Stems are the first letters of longer words; a whole word is written with the sign for its end.
STEM, LONGEST_STEM, END = 4, 8, "$"
# A stem nearly all of whose uses are those of a longer mark says no more than that.
SAME = 0.9
# Documents are toxic from this score on; that of a text without marked words.
TOXIC, BASE = 0.7, 0.01

# The letters that a sign can stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
    "*": "abcdefghijklmnopqrstuvwxyz", "#": "abcdefghijklmnopqrstuvwxyz", "%": "abcdefghijklmnopqrstuvwxyz",
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
# Symbols of the letter model: 0 the end of a word, 1 to 26 letters, 27 any other letter.
SYMBOLS = 28
SYMBOL = {c: k for k, c in enumerate(LETTERS, 1)}
CODES = bytes(c - 64 if 65 <= c <= 90 else c - 96 if 97 <= c <= 122 else 27 if c > 127 else 0 for c in range(256))

SIGNS = re.escape("".join(c for c in LOOKALIKES))
SEPARATORS = r" \t.\-_*~/\\"
PARTING = " \t.-_~/\\"
# Punctuation that stands for no letter; three equal letters.
MARKS, TRIPLE = ".,;:?)\"'", re.compile(r"(.)\1\1")
# Spaced-out letters; tokens of letters and lookalikes, at least one of each; three equal letters.
MIXED = rf"(?<![^\W\d_])(?<![{SIGNS}])(?:[^\W\d_]++[{SIGNS}]|[{SIGNS}]++[^\W\d_])(?:[^\W\d_]|[{SIGNS}])*+"
DISGUISED = re.compile(
    rf"(?<![^\W_])(?:[^\W\d_]|[{SIGNS}])(?:[{SEPARATORS}]{{1,3}}(?:[^\W\d_]|[{SIGNS}])(?![^\W_])){{2,}}"
    rf"|{MIXED}"
    rf"|(?<![^\W\d_])[^\W\d_]*?([^\W\d_])\1\1[^\W\d_]*"
)
# A token, and its signs that may be mere punctuation before and after it.
TOKEN, BEFORE, AFTER = re.compile(MIXED), re.compile(r"[^\w]*"), re.compile(r"[^\w]*$")
WORD = re.compile(r"[^\W\d_]+")
# From so many steps at a place on, states are kept in a table.
MANY = 300
# Pieces decoded that a worker keeps.
KEPT = 60_000
# Longer stretches and runs of tokens are not kept.
SHORT = 64
# Runs of one character; white space; a spaced-out piece.
RUN, GAP = re.compile(r"(.)\1*", re.S), re.compile(r"(\s+)")
SPACED = re.compile(rf"\W*\w[{SEPARATORS}]")
# The channel's probabilities.
CHANNEL = {"letter": 0.0, "lookalike": log(0.3), "end": log(0.1), "dropped": log(0.5), "parted": log(0.2), "once": log(0.6), "twice": log(0.3)}


def lattice(piece: str, ends: bool = True, spaced: bool | None = None) -> list[list[tuple[str, float]]]:
    """For each place the texts that may stand behind it, with the logarithms of the channel's probabilities.

    ``ends``: signs may end words; ``spaced``: separators may part letters, by default if the piece begins so.
    """
    places, at = [], 0
    if spaced is None:
        spaced = bool(SPACED.match(piece))
    while at < len(piece):
        c, run = piece[at], 1
        while at + run < len(piece) and piece[at + run] == c:
            run += 1
        if c in SYMBOL or c.isalpha():
            if run >= 3:
                places.append([(c, CHANNEL["once"]), (c * 2, CHANNEL["twice"])])
            else:
                places.extend([[(c, CHANNEL["letter"])]] * run)
        elif c in LOOKALIKES and not (spaced and c in "*" and 0 < at < len(piece) - 1):
            each = [(x, CHANNEL["lookalike"] - log(len(LOOKALIKES[c]))) for x in LOOKALIKES[c]]
            end = [(" ", CHANNEL["end"])] if ends else []
            if run >= 3:
                places.append([*each, *((x * 2, p + CHANNEL["twice"]) for x, p in each), *end])
            else:
                places.extend([[*each, *end]] * run)
        elif spaced:
            places.append([("", CHANNEL["dropped"]), (" ", CHANNEL["parted"])])
        else:
            places.append([(" ", CHANNEL["letter"])])
        at += run
    return places


def decode(piece: str, model: np.ndarray, ends: bool = True) -> str:
    """The likeliest text behind a disguised piece, in lower case; ``ends``: signs may end words.

    Time and memory are in proportion to the piece.
    """
    return path((0, 0), [*lattice(piece, ends), [(" ", 0.0)]], model).strip()


def path(state: tuple[int, int], places: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The likeliest text of a lattice that is entered with two symbols before it."""
    # State: the last two symbols; its value: log probability and the text so far as a linked list.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {state: (0.0, None)}
    for place, choices in enumerate(places):
        if len(states) * len(choices) >= MANY:
            return _decode_wide(states, places[place:], model)
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (value, said) in states.items():
            for text, chance in choices:
                x, y, total = a, b, value + chance
                for c in text:
                    # The model counts other letters by their bytes.
                    for s in [SYMBOL[c]] if c in SYMBOL else [0] if c == " " else [27] * len(c.encode("utf-8", "surrogatepass")):
                        if s or y:
                            total += model[x, y, s]
                        x, y = y, s
                if (x, y) not in after or total > after[x, y][0]:
                    after[x, y] = (total, (said, text) if text else said)
        states = after
    return _told(max(states.values(), key=lambda v: v[0])[1], [])


def _told(said: tuple | None, parts: list[str]) -> str:
    """The text of a linked list and of the parts that follow it, last first."""
    while said:
        said, text = said
        parts.append(text)
    return "".join(reversed(parts))


def _symbols(text: str) -> list[int]:
    """Symbols of a text; the model counts other letters by their bytes."""
    return [s for c in text for s in ([SYMBOL[c]] if c in SYMBOL else [0] if c == " " else [27] * len(c.encode("utf-8", "surrogatepass")))]


def _decode_wide(states: dict[tuple[int, int], tuple[float, tuple | None]], places: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The rest of a decoding with all pairs of symbols at once: a place is a step over a table of states."""
    value = np.full((SYMBOLS, SYMBOLS), -np.inf)
    for (a, b), (total, _) in states.items():
        value[a, b] = total
    # What follows the end of a word does not end it again.
    model = model.copy()
    model[:, 0, 0] = 0.0
    steps = []
    for choices in places:
        after = np.full((SYMBOLS, SYMBOLS), -np.inf)
        back, chosen = np.zeros((2, SYMBOLS, SYMBOLS), dtype=np.int64)
        kinds: dict[tuple[int, bool], list[int]] = {}
        sequences = [_symbols(text) for text, _ in choices]
        for k, sequence in enumerate(sequences):
            kinds.setdefault((len(sequence), len(set(sequence)) < 2), []).append(k)
        for (size, alike), which in kinds.items():
            if size in (1, 2) and alike:
                letters = np.array([sequences[k][0] for k in which])
                total = (value[:, :, None] + np.array([choices[k][1] for k in which])) + model[:, :, letters]
                if size == 1:
                    at = total.argmax(0)
                    best, rows, columns = np.take_along_axis(total, at[None], 0)[0], np.arange(SYMBOLS)[:, None], letters[None, :]
                    sources = at * SYMBOLS + rows
                else:
                    flat = (total + model[:, letters, letters][None]).reshape(SYMBOLS * SYMBOLS, -1)
                    sources = flat.argmax(0)
                    best, rows, columns = flat[sources, np.arange(len(which))], letters, letters
                better = best > after[rows, columns]
                numbers = np.broadcast_to(np.array(which), best.shape)
                r, c = (np.broadcast_to(x, best.shape)[better] for x in (rows, columns))
                after[r, c], back[r, c], chosen[r, c] = best[better], np.broadcast_to(sources, best.shape)[better], numbers[better]
                continue
            for k in which:
                total, source = value + choices[k][1], np.arange(SYMBOLS * SYMBOLS).reshape(SYMBOLS, SYMBOLS)
                for s in sequences[k]:
                    grown = total + model[:, :, s]
                    at = grown.argmax(0)
                    total, moved = np.full_like(value, -np.inf), np.zeros_like(source)
                    total[:, s], moved[:, s] = grown[at, np.arange(SYMBOLS)], source[at, np.arange(SYMBOLS)]
                    source = moved
                better = total > after
                after[better], back[better], chosen[better] = total[better], source[better], k
        steps.append((back, chosen))
        value = after
    state, parts = int(value.argmax()), []
    for (back, chosen), choices in zip(reversed(steps), reversed(places), strict=True):
        parts.append(choices[int(chosen.flat[state])][0])
        state = int(back.flat[state])
    return _told(states[divmod(state, SYMBOLS)][1], parts)


def spelt(token: str, model: np.ndarray) -> set[str]:
    """The likeliest words if all signs of a token are letters, with and without punctuation before and after."""
    return {w for core in cores(token) for w in WORD.findall(decode(core, model, ends=False))}


def cores(token: str) -> set[str]:
    """A token with all, the outermost, all but the innermost or none of the signs at its ends taken for punctuation."""
    if not TOKEN.fullmatch(token):
        return set()
    start, stop = BEFORE.match(token).end(), AFTER.search(token).start()
    firsts, lasts = {0, min(1, start), max(start - 1, 0), start}, {stop, min(stop + 1, len(token)), max(len(token) - 1, stop), len(token)}
    return {core for a in firsts for b in lasts if TOKEN.fullmatch(core := token[a:b])}


def letter_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of symbol triples over all texts; each task sends at most one row for each triple."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for frame in frames:
            texts = [t for t in frame[text] if t]
            for a, b in slices([len(t) for t in texts]):
                raw = "  ".join(["", *texts[a:b], ""]).encode("utf-8", "surrogatepass").translate(CODES)
                s = np.frombuffer(raw, dtype=np.uint8).astype(np.int32)
                # A run of signs that are no letters is one end of a word; each word starts from two.
                s = s[(s != 0) | np.append(True, s[:-1] != 0)]
                before = np.append(0, s[:-1])
                earlier = np.append([0, 0], s[:-2])
                earlier[before == 0] = 0
                total += np.bincount(((earlier * SYMBOLS + before) * SYMBOLS + s)[1:], minlength=len(total))
        kept = np.flatnonzero(total)
        yield pd.DataFrame({"triple": kept, "n": total[kept]})

    rows = docs.select(text).mapInPandas(count, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SYMBOLS**3, dtype=np.float64)
    out[rows["triple"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def letter_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a symbol after two others, mixed with those after one and after none."""
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + SYMBOLS)
    two = (counts.sum(0) + 5 * one) / (counts.sum(0).sum(1, keepdims=True) + 5)
    return np.log((counts + 5 * two) / (counts.sum(2, keepdims=True) + 5))


class Restorer:
    """Restores texts; keeps the latest short stretches and tokens decoded.

    Two letters in a row that stand for themselves bring all paths of a lattice together in one
    state. What lies before them is decoded by itself, once for each two symbols it may follow: the
    text is that of the whole lattice's best path.
    """

    def __init__(self, model: np.ndarray):
        self.model = model
        self._kept_stretch = lru_cache(maxsize=KEPT)(self._stretch)
        self._kept_piece = lru_cache(maxsize=KEPT)(self._piece)
        self._kept_words = lru_cache(maxsize=KEPT)(self._words)
        self._plain = lru_cache(maxsize=KEPT)(plain)

    def _stretch(self, state: tuple[int, int], piece: str, ends: bool, last: bool) -> str:
        places = lattice(piece, ends, False)
        return path(state, [*places, [(" ", 0.0)]] if last else places, self.model)

    def decode(self, piece: str, ends: bool = True) -> str:
        """The text of ``decode``, stretch by stretch."""
        if SPACED.match(piece):
            return decode(piece, self.model, ends)
        state, held, fixed, out = (0, 0), [], (), []
        of = self._stretch if len(piece) > SHORT else self._kept_stretch
        for m in RUN.finditer(piece):
            run = m[0]
            if len(run) > 2 or not (run[0] in SYMBOL or run[0].isalpha()):
                held.append(run)
                fixed = ()
                continue
            symbols = _symbols(run)
            if held:
                held.append(run)
                fixed = (*fixed, *symbols)
                if len(fixed) > 1:
                    out.append(of(state, "".join(held), ends, False))
                    state, held, fixed = fixed[-2:], [], ()
            else:
                out.append(run)
                state = (*state, *symbols)[-2:]
        if held:
            out.append(of(state, "".join(held), ends, True))
        return "".join(out).strip()

    def _piece(self, piece: str) -> tuple[str, set[str]]:
        return self.decode(piece), {w for core in cores(piece) for w in WORD.findall(self.decode(core, False))}

    def _words(self, run: str) -> set[str]:
        found = set()

        def restored(m: re.Match) -> str:
            text, spelt = self._kept_piece(m[0]) if len(m[0]) <= SHORT else self._piece(m[0])
            found.update(spelt)
            return text

        return found.union(WORD.findall(DISGUISED.sub(restored, run)))

    def words(self, text: str | None) -> set[str]:
        """The words of the restored text, and those that signs spell if all are letters.

        A disguised piece lies within one token or within a run of tokens that may hold parts of it;
        other tokens are looked up.
        """
        parts = GAP.split((text or "").lower())
        tokens = parts[::2]
        known = {t: self._plain(t) if len(t) <= SHORT else plain(t) for t in set(tokens)}
        found = set().union(*filter(None, known.values()))
        odd = [k for k, t in enumerate(tokens) if known[t] is None]
        first = 0
        for k in range(len(odd)):
            if k + 1 == len(odd) or odd[k + 1] > odd[k] + 1:
                run = "".join(parts[2 * odd[first] : 2 * odd[k] + 1])
                found |= self._kept_words(run) if len(run) <= SHORT else self._words(run)
                first = k + 1
        return found

    def __call__(self, text: str | None) -> str:
        """The text in lower case with its disguised pieces decoded."""
        return DISGUISED.sub(lambda m: self.decode(m[0]), (text or "").lower())


def plain(token: str) -> tuple[str, ...] | None:
    """The words of a token that holds no disguised piece nor part of one; None for other tokens."""
    core = token.strip(MARKS)
    if len(core) > 1 and core.isalpha() and not TRIPLE.search(core):
        return (core,)
    return None if is_open(token) or DISGUISED.search(token) else tuple(WORD.findall(token))


def is_open(token: str) -> bool:
    """Whether a spaced-out piece may go on into the next token or come from the one before.

    That takes a single letter or sign, or none, between separators at an end; a star may be either.
    """
    first, last = token.lstrip(PARTING), token.rstrip(PARTING)
    if "*" in token or not first:
        return True
    single = lambda c, beside: (c in LOOKALIKES or c.isalnum()) and not beside.isalnum()
    return single(first[0], first[1:2]) or single(last[-1], last[-2:-1])


@dataclass
class Model:
    """Letter model, and marks (words and stems) with the chance that a document with the mark is toxic."""

    letters: np.ndarray
    marked: dict[str, float]

    @cached_property
    def heads(self) -> set[str]:
        """First letters of all marks; other words have none."""
        return {m.removesuffix(END)[:STEM] for m in self.marked}


def surely(with_: int, of: int, z: float = 1.96) -> float:
    """Lower confidence bound of a share."""
    share = with_ / of
    return (share + z * z / (2 * of) - z * sqrt(share * (1 - share) / of + (z / (2 * of)) ** 2)) / (1 + z * z / of)


def train(
    docs: DataFrame, labels: DataFrame, allowed: Column, text: str = "text", label: str = "toxic", doc_id: str = "doc_id", rows: int = ROWS
) -> Model:
    """Learn letters from all texts, and marks from at most ``rows`` labelled documents.

    Without labels there is no mark, and every text has the same low score.
    """
    letters = letter_model(letter_counts(docs, text))

    def seen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore = Restorer(letters)
        for frame in frames:
            for t, toxic in zip(frame[text], frame["label"], strict=True):
                found = WORD.findall(restore(t))
                uses = {m: f"{x} {w} {y}" for x, w, y in zip(["", *found], found, [*found[1:], ""], strict=False) for m in marks_of(w)}
                between = [zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in uses.values()]
                yield pd.DataFrame({"mark": list(uses), "between": between, "toxic": int(toxic)})

    given = sample(docs, labels, label, rows, allowed, [text], doc_id)
    found = (
        given.mapInPandas(seen, "mark string, between long, toxic int")
        .groupBy("mark", "between", "toxic")
        .agg(F.lit(1).alias("one"))
        .groupBy("mark")
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all"))
        .where((F.col("toxic") >= SEEN) & (F.col("toxic") >= SURE * F.col("all")))
    )
    # At most so many marks as the sample's toxic documents hold.
    uses = {r["mark"]: (r["toxic"], r["all"]) for r in found.collect()}
    return Model(letters, closed({m: (n, surely(n, of)) for m, (n, of) in uses.items() if surely(n, of) >= SURE}))


def closed(marks: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Marks and their chances without the stems whose uses a longer mark explains."""
    longer: dict[str, int] = {}
    for mark, (uses, _) in marks.items():
        for k in range(STEM, len(mark)):
            longer[mark[:k]] = max(longer.get(mark[:k], 0), uses)
    return {m: sure for m, (uses, sure) in marks.items() if m.endswith(END) or longer.get(m, 0) < SAME * uses}


def marks_of(word: str) -> list[str]:
    """A word as a mark, and its stems."""
    return [word + END, *(word[:k] for k in range(STEM, min(len(word) - 1, LONGEST_STEM) + 1))]


def rate(text: str | None, model: Model, restore: Restorer) -> float:
    """Chance that a text is toxic."""
    get, heads, best = model.marked.get, model.heads, {}
    for word in restore.words(text):
        if word[:STEM] not in heads:
            continue
        sure = max([get(m, 0.0) for m in marks_of(word)])
        if sure:
            best[word[:STEM]] = max(sure, best.get(word[:STEM], 0.0))
    clean = 1 - BASE
    for sure in best.values():
        clean *= 1 - sure
    return 1 - clean


def score(text: Column, model: Model) -> Column:
    """Chance that a text is toxic, from 0 to 1; null and empty texts have the score of a text without marks."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restore = Restorer(model.letters)
        for texts in batches:
            yield pd.Series([rate(t, model, restore) for t in texts], dtype="float64")

    return of(text)


def restored(text: Column, letters: np.ndarray) -> Column:
    """The text in lower case with disguised words restored; null gives the empty text."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restore = Restorer(letters)
        for texts in batches:
            yield pd.Series([restore(t) for t in texts], dtype=object)

    return of(text)


def scored(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score) for every document row.

    Null and empty texts have no words. Repeated rows give repeated rows, an empty table none; other
    columns play no part.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), score(F.col(text), model).alias("score"))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", least: float = TOXIC) -> DataFrame:
    """The documents with a score below ``least``, all columns as they came."""
    name = fresh(docs, "score")
    rated = docs.withColumn(name, score(F.col(text), model))
    return rated.where(F.col(name) < least).select(*docs.columns)
