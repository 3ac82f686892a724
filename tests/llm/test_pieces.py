import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from quotemart.llm import pieces
from quotemart.llm.pieces import MODEL, TURNS, WIDTHS, Encoder, Merges, Skips, Turns, Vocabulary, decode_ids, segment

TEXTS = [
    "Hello  world\n\tx", " lead", "trail ", "▁lit ▁▁", " nb é 日本 😀", "a\r\nb", "", " ", "   ", "ﬁ ½ x² ²x.", "\x00x", "don't (stop) e.g. a_b __ 1,000.5%",
    "नमस्ते दुनिया", "été", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "x" * 5000, "ab" * 3000 + " of the ", "￿",
    "https://www.example.com/a?b=c&d=e#f $$$ %%% ***word*** | | |",
]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load()


def agenda(word, order, skipped):
    """The agenda rule as it is said, looking at every pair each time."""
    parts, gone = list(word), set()
    while True:
        at = [sum(map(len, parts[:k])) for k in range(len(parts))]
        open_ = [(order[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in order and (at[k], a, b) not in gone]
        if not open_:
            return parts
        _, k = min(open_)
        if skipped():
            gone.add((at[k], parts[k], parts[k + 1]))
        else:
            parts[k : k + 2] = [parts[k] + parts[k + 1]]


def words(n, seed=1):
    rng = random.Random(seed)
    syllables = ["th", "er", "ing", "and", "tion", "é", "sch", "un", "ß", "ou", "1", "X"]
    return ["▁" * rng.randint(0, 3) + "".join(rng.choices(syllables, k=rng.randint(1, 9))) for _ in range(n)]


def test_no_dropout_gives_the_pieces_of_the_library(vocabulary):
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=MODEL), Encoder(vocabulary)
    for text in [*TEXTS, " ".join(words(3000)).replace("▁", " ")]:
        if "▁" not in text:
            assert encoder.text(text).tolist() == library.encode(text), text


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_agenda_with_dropout_equals_the_rule(vocabulary, dropout):
    below = round(dropout * 256)
    for k, word in enumerate(words(300)):
        want = agenda(word, vocabulary.order, Turns(word, k, below).skipped)
        assert pieces._short(word, vocabulary.order, Turns(word, k, below).skipped) == want
        assert pieces._long(word, vocabulary.order, Turns(word, k, below).skipped) == want
        assert segment(word, vocabulary.order, Turns(word, k, below)) == want


def test_kept_words_change_nothing(vocabulary, monkeypatch):
    text = " ".join(words(4000)).replace("▁", "")
    want = Encoder(vocabulary, 0.2, 5).text(text)
    monkeypatch.setattr(pieces, "KEPT", 1)
    assert (Encoder(vocabulary, 0.2, 5).text(text) == want).all()
    encoder = Encoder(vocabulary, 0.2, 5)
    for part in (text[:500], text[500:9000], text):
        got = encoder.text(part)
    assert (got == want).all()


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.7, 1.0])
def test_every_text_decodes_to_itself(vocabulary, dropout):
    for seed in (0, 1):
        encoder = Encoder(vocabulary, dropout, seed)
        for text in TEXTS:
            assert decode_ids(encoder.text(text), vocabulary.pieces, vocabulary.prefix) == text


def test_seeds_and_occurrences_vary_the_pieces(vocabulary):
    text = "segmentation of unbelievable words " * 40
    a, b, again = Encoder(vocabulary, 0.3, 1).text(text), Encoder(vocabulary, 0.3, 2).text(text), Encoder(vocabulary, 0.3, 1).text(text)
    assert a.tolist() == again.tolist() != b.tolist()
    plain = Encoder(vocabulary).text(text)
    assert len(a) > len(plain) and len(set(map(tuple, np.array_split(a, 40)))) > 4
    assert len(Encoder(vocabulary, 1.0).text("hello")) == 6


def test_foreign_ids_decode_without_error(vocabulary):
    assert decode_ids(np.array([1, -5, 10**6, 3 + 0xC3, 259]), vocabulary.pieces, True) == "�  "


def test_encoded_rows(spark):
    rows = [(k, t, None, "s", 1) for k, t in enumerate(TEXTS)] + [(90, None, None, None, None), (None, "null id", None, None, None)] + [(0, TEXTS[0], None, "s", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("ids", F.lit(1))
    got = pieces.encoded(docs, dropout=0.3, seed=4).collect()
    encoder = Encoder(Vocabulary.load(), 0.3, 4)
    want = [(d, None if t is None else encoder.text(t).tolist(), 0 if t is None else len(encoder.text(t)), True) for d, t, *_ in rows]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want, key=repr)
    assert pieces.encoded(docs.limit(0)).collect() == []


def test_bad_rates_are_refused(vocabulary):
    for dropout, draws in ((-0.1, 1), (1.5, 1), (0.1, 0)):
        with pytest.raises(ValueError):
            Encoder(vocabulary, dropout, 0, draws)


@pytest.mark.parametrize("dropout", [0.1, 0.6, 0.95])
def test_words_together_equal_words_one_by_one(vocabulary, dropout):
    encoder = Encoder(vocabulary, dropout, 3)
    texts = [" ".join(w.replace("▁", "") for w in words(2000, k)) for k in (1, 2)] + TEXTS
    for text, got in zip(texts, encoder.texts(texts), strict=True):
        marked = text.replace("▁", pieces.HELD).replace(" ", "▁")
        some = encoder.find("▁" + marked if text else marked)
        own = pieces.xxhash.xxh3_64_intdigest(text.encode(), encoder.key)
        keys = [int(pieces.mixed(np.array([(own + k * pieces.PLACE) % 2**64], dtype=np.uint64))[0]) for k in range(1, len(some) + 1)]
        assert got.tolist() == [i for w, k in zip(some, keys, strict=True) for i in encoder.word(w, k)]


def test_every_occurrence_has_its_own_draw(vocabulary):
    # One merge: skipped in a tenth of the places, whatever the seed.
    for seed in range(5):
        ids = Encoder(vocabulary, 0.1, seed).text(" ".join("a" * 8000))
        whole = Encoder(vocabulary).text("a").tolist()
        assert len(whole) == 1 and 0.08 < 1 - (ids == whole[0]).sum() / 8000 < 0.12
    # Many merges: as many kinds of pieces, and as often the usual ones, as with random numbers.
    rng, word = random.Random(0), "▁unbelievable"
    drawn = [tuple(segment(word, vocabulary.order, type("", (), {"skipped": lambda _: rng.random() < 0.1})())) for _ in range(8000)]
    ids = Encoder(vocabulary, 0.1, 1).text(" ".join(["unbelievable"] * 8000)).tolist()
    got, some = [], ""
    for k in ids:
        some += vocabulary.pieces[k].decode() + "|"
        if len(some.replace("|", "")) == len(word):
            got.append(some)
            some = ""
    usual = "".join(p + "|" for p in segment(word, vocabulary.order)).replace("▁", " ")
    want = ["".join(p + "|" for p in d).replace("▁", " ") for d in drawn]
    assert len(got) == 8000 and abs(got.count(usual) - want.count(usual)) < 300
    assert len(set(got)) > 0.7 * len(set(want)) > 40


def test_words_merged_together_are_merged_as_one_by_one(vocabulary):
    rng = random.Random(5)
    merges, order = Merges(vocabulary), vocabulary.order
    letters = "▁etaoinshr" * 3 + "é中😀\u0001-.'"
    names = dict(map(reversed, vocabulary.ids.items()))
    for width in WIDTHS:
        words = ["".join(rng.choices(letters, k=rng.randint(1, width))) for _ in range(300)]
        skipped = np.array([[rng.random() < 0.2 for _ in range(TURNS)] for _ in words])
        symbols, turns = merges.segment(words, width, skipped)
        for word, bits, row, had in zip(words, skipped, symbols, turns, strict=True):
            skips = Skips(sum(1 << t for t in np.flatnonzero(bits).tolist()))
            parts = segment(word, order, skips)
            assert [names.get(k) or chr(k - merges.other) for k in row.tolist() if k >= 0] == parts
            assert had == skips.turn


def test_no_pair_is_looked_up_outside_the_words(vocabulary, monkeypatch):
    merges, looked = Merges(vocabulary), []
    pairs = merges.pairs
    monkeypatch.setattr(merges, "pairs", lambda a, b: looked.append(a.size) or pairs(a, b))
    merges.segment(["abc"] * 100, 32, np.zeros((100, TURNS), dtype=bool))
    # The pairs at first, and two after each of at most two merges.
    assert looked[0] == 200 and sum(looked) <= 1000


def test_pairs_are_found_by_slot(vocabulary, monkeypatch):
    merges = Merges(vocabulary)
    # Not by search.
    monkeypatch.setattr(np, "searchsorted", None)
    # Slots hold every merge of two pieces once, and few of them several.
    assert merges.held.sum() == len(merges.codes) - 1 and (merges.held > 1).sum() < 0.2 * len(merges.codes)
    ids, order = vocabulary.ids, vocabulary.order
    names = dict(map(reversed, ids.items()))
    rng = random.Random(2)
    halves = [(ids[p[:k]], ids[p[k:]]) for p in ids for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
    some = halves + [(rng.randrange(-1, merges.other + 300), rng.randrange(-1, merges.other + 300)) for _ in range(20_000)]
    a, b = np.array(some, dtype=np.int32).T.copy()
    ranks, wholes = merges.pairs(a, b)
    want = [ids.get(names.get(x, "\n") + names.get(y, "\n")) for x, y in some]
    assert [w if r != pieces.LAST else None for w, r in zip(wholes.tolist(), ranks.tolist(), strict=True)] == want
    # Better scores have smaller ranks.
    found = sorted((r, order[names[w]]) for r, w in zip(ranks.tolist(), wholes.tolist(), strict=True) if r != pieces.LAST)
    assert [s for _, s in found] == sorted(s for _, s in found)


def test_a_known_word_is_looked_up_once_per_occurrence(vocabulary):
    encoder = Encoder(vocabulary, 0.1, 1)
    long = "y" * (WIDTHS[-1] + 8)
    text = " ".join(["one two", "two", long, "▁", long, "one"] * 5)
    first = encoder.text(text)
    assert set(encoder.roots) == {"▁one", "▁two", "▁" + pieces.HELD} and min(encoder.roots.values()) >= 0
    nodes, looked = dict(encoder.roots), []
    encoder.roots.__class__ = type("Seen", (pieces.Roots,), {"__missing__": lambda self, w: looked.append(w) or pieces.Roots.__missing__(self, w)})
    assert (encoder.text(text) == first).all() and encoder.roots == nodes
    # Long words are never kept: they are new to every slice, but only once.
    assert looked == ["▁" + long]


def test_texts_are_decoded_together(vocabulary, monkeypatch):
    encoder, decoder = Encoder(vocabulary, 0.3, 2), pieces.Decoder(vocabulary.pieces, vocabulary.prefix)
    rows = encoder.texts(TEXTS)
    assert decoder.texts(rows) == TEXTS and decoder.texts([]) == [] and decoder.texts([np.zeros(0, dtype=np.int32)]) == [""]
    monkeypatch.setattr(pieces, "DECODED", 3)
    assert decoder.texts(rows) == TEXTS
    # What one text lacks doesn't come from its neighbours, and only a first space goes.
    space, byte = vocabulary.ids["▁"], vocabulary.first_byte
    assert decoder.texts([np.array(r) for r in ([byte + 0xC3], [byte + 0xA9], [], [space, space], [10**6, -1], [space])]) == ["�", "�", "", " ", "", ""]


def test_decode_column(spark):
    vocabulary = Vocabulary.load()
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)] + [(90, None)], "doc_id long, text string")
    found = pieces.encoded(docs, dropout=0.2, seed=3).select("doc_id", pieces.decode(F.col("ids"), vocabulary).alias("text"))
    assert dict(found.collect()) == dict(docs.collect())


def test_words_of_signs_and_letters(vocabulary):
    find = Encoder(vocabulary).find
    text = "▁▁the▁(a)_b²c...\n▁\n▁▁x▁▁"
    assert find(text) == ["▁▁the", "▁(a", ")_b", "²c", "...", "\n", "▁", "\n", "▁▁x", "▁▁"]
    assert "".join(find("._" * 200_000)) == "._" * 200_000
