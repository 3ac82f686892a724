import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemart.llm import toxicity
from quotemart.llm.toxicity import CODES, SYMBOLS, Model, Restorer, closed, decode, lattice, letter_model, rate, surely

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
BAD = ["idiot", "moron", "worthless", "pathetic", "scum", "stupid"]


def corpus(n=240, seed=2):
    """Texts of invented words; the first half has bad words, some of them disguised."""
    rng = random.Random(seed)
    syllables = ["the", "re", "an", "ing", "ti", "on", "ble", "ea", "sh", "ou", "er"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    disguise = [str, str.upper, lambda w: w.replace("i", "1").replace("o", "0").replace("s", "$", 1), lambda w: " ".join(w),
                lambda w: w[:2] + w[2] * 5 + w[3:], lambda w: "-".join(w)]
    out = []
    for k in range(n):
        words = [word() for _ in range(rng.randint(20, 60))]
        if k < n // 2:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(disguise[: 1 if k % 3 else 6])(rng.choice(BAD)))
        out.append((k, " ".join(words), int(k < n // 2)))
    return out


@pytest.fixture(scope="module")
def letters():
    total = np.zeros((SYMBOLS,) * 3)
    for _, text, _ in corpus():
        symbols = [0, 0]
        for c in text.encode().translate(CODES):
            if c == 0 and symbols[-1] == 0:
                continue
            if symbols[-1] == 0:
                symbols.append(0) if symbols[-2:] != [0, 0] else None
            symbols.append(c)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            total[a, b, c] += 1
    return letter_model(total)


@pytest.mark.parametrize(
    "piece,word",
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("s-c-u-m", "scum"), ("stuuuupid", "stupid"), ("$tup1d", "stupid"),
     ("p4th3tic", "pathetic"), ("w0rthl3ss", "worthless"), ("id!ot", "idiot"), ("sc*m", "scum")],
)
def test_disguised_words_are_restored(letters, piece, word):
    assert Restorer(letters)(f"You {piece} there") == f"you {word} there"


def test_viterbi_finds_the_best_of_all_paths(letters):
    def paths(places):
        if not places:
            yield "", 0.0
            return
        for rest, p in paths(places[1:]):
            for text, q in places[0]:
                yield text + rest, p + q

    def chance(text):
        total, a, b = 0.0, 0, 0
        for c in text + " ":
            s = toxicity.SYMBOL.get(c, 0 if c == " " else 27)
            if s or b:
                total += letters[a, b, s]
            a, b = b, s
        return total

    for piece in ("1d10t", "i d i 0 t", "l0$er", "a--b--c", "ooo1", "été1x"):
        best = max(paths(lattice(piece)), key=lambda x: x[1] + chance(x[0]))
        got = decode(piece, letters)
        assert got == best[0].strip()


def test_clean_text_is_left_alone(letters):
    for text in ("The annals of re-entry, part 2: 1,000 on 12.5.2020!", "Über été niño", "", "a", "see it", "xx", "2024", "10 20 30"):
        assert Restorer(letters)(text) == text.lower()
    assert Restorer(letters)(None) == ""


def test_bounds_and_stems():
    assert 0 < surely(1, 1) < surely(5, 5) < surely(50, 50) < 1 and surely(5, 10) < 0.5
    marks = {"loweisch$": (9, 0.7), "lowe": (50, 0.9), "lowei": (50, 0.9), "idio": (20, 0.8), "idiot$": (20, 0.8)}
    assert closed(marks) == {"loweisch$": 0.7, "lowei": 0.9, "idiot$": 0.8}


def test_words_of_one_stem_count_once(letters):
    model, restore = Model(letters, {"lowei": 0.8, "idiot$": 0.8}), Restorer(letters)
    one = rate("the loweisch", model, restore)
    assert rate("the loweisch loweiung LOWEI", model, restore) == one > rate("the", model, restore) == rate(None, model, restore)
    assert rate("loweisch idiot", model, restore) > one > 0.7 > rate("idiots", model, restore)


def test_letter_counts_equal_a_loop(spark):
    docs = spark.createDataFrame([(t,) for t in ["Ab c", "", None, "é1--x", "  zz  "]], "text string")
    got = toxicity.letter_counts(docs)
    want = np.zeros((SYMBOLS,) * 3)
    for word in ["ab", "c", "éé", "x", "zz"]:
        symbols = [0, 0, *(toxicity.SYMBOL.get(c, 27) for c in word), 0]
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            want[a, b, c] += 1
    assert (got[:, :, 1:] == want[:, :, 1:]).all() and (got[:, 1:, 0] == want[:, 1:, 0]).all()


def test_held_out_documents_are_told_apart(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, None, "s", 1) for k, t, _ in rows], DOCS).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows] + [(None, 1, 1), (3, 1, None), (5, 0, 7)], LABELS)
    held = lambda k: zlib.crc32(str(k).encode()) % 3 == 1
    from quotemart.llm.common import fold

    model = toxicity.train(docs, labels, fold(F.col("doc_id"), 3) != 1)
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    bad = [scores[k] >= 0.7 for k, _, y in rows if y and held(k)]
    good = [scores[k] >= 0.7 for k, _, y in rows if not y and held(k)]
    assert sum(bad) >= 0.9 * len(bad) and sum(good) <= 0.03 * len(good) and len(bad) > 20
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, s in scores.items() if s < 0.7}


def test_odd_rows_and_empty_tables(spark):
    odd = [(None, None, None, None, None), (1, "", None, None, None), (1, "", None, None, None), (2, "1" * 50_000, None, None, None),
           (3, "a b " * 20_000, None, None, None), (4, "z" * 100_000, None, None, None)]
    docs, labels = spark.createDataFrame(odd, DOCS), spark.createDataFrame([], LABELS)
    model = toxicity.train(docs, labels, F.lit(True))
    got = toxicity.scored(docs, model).collect()
    assert len(got) == 6 and all(r.score == pytest.approx(toxicity.BASE) for r in got)
    assert toxicity.scored(docs.limit(0), toxicity.train(docs.limit(0), labels, F.lit(True))).collect() == []


@pytest.fixture(scope="module")
def more_letters(spark):
    """A letter model of texts in which the words of the next test occur, with accented letters."""
    words = ["débile", "shit", "asshole", "idiots", "tête", "été", "großer"]
    texts = [(text + " " + " ".join(words * 3),) for _, text, _ in corpus()]
    return letter_model(toxicity.letter_counts(spark.createDataFrame(texts, "text string")))


@pytest.mark.parametrize(
    "piece,word",
    [("1d107", "idiot"), ("1d1075", "idiots"), ("idi07", "idiot"), ("idio7", "idiot"), ("5h17", "shit"), ("455h0l3", "asshole"), ("déb1le", "débile"),
     ("DÉB1L3", "débile"), ("$7up1d", "stupid"), ("7ê7e", "tête")],
)
def test_signs_in_any_order_and_number_reach_the_lattice(more_letters, piece, word):
    assert toxicity.DISGUISED.fullmatch(piece.lower())
    assert Restorer(more_letters)(f"You, {piece}.") == f"you, {word}."


def test_marks_count_though_the_letter_model_prefers_ends():
    # Letters that know no difference: an end costs least.
    flat = letter_model(np.ones((SYMBOLS,) * 3))
    flat[:, :, toxicity.SYMBOL["l"]] -= 1
    model, restore = Model(flat, {"idiot$": 0.9, "stupid$": 0.9}), Restorer(flat)
    for text in ("you 1d107", "1d10t!!", "($7up1d)", "idi07.", "1D10T***"):
        assert rate(text, model, restore) > 0.7, text
    for text in ("the!! 10th", "stup id!", "a1 b2 c3"):
        assert rate(text, model, restore) == pytest.approx(toxicity.BASE), text


def test_tokens_without_letters_or_signs_are_no_pieces():
    for text in ("2024, 10%, (12)", "Über été niño don't", "1" * 50_000, "aa éé"):
        assert not toxicity.DISGUISED.search(text.lower())
    assert [m[0] for m in toxicity.DISGUISED.finditer("see débiiile, x-1d10t_ and 5h17.")] == ["débiiile", "1d10t", "5h17"]


def test_long_pieces_are_decoded_in_one_pass(letters):
    spaced = lambda words: "   ".join(" ".join(w) for w in words)
    words = ["idiot", "worthless"]
    assert decode(spaced(words), letters).split() == words
    for shift in range(6):
        piece = "s " * shift + "  " + spaced(words * 60)
        assert decode(piece, letters).split()[-100:] == words * 50


def test_states_in_a_table_decode_to_the_same_words(monkeypatch):
    rng = random.Random(12)
    text = " ".join(["the idiot was of no use", "débile et stupide", "a moron in town", "who are you then"] * 40)
    counts = np.zeros((toxicity.SYMBOLS,) * 3)
    symbols = [0, 0, *(toxicity.CODES[b] for b in text.encode())]
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):  # noqa: B905
        counts[a if b else 0, b, c] += 1 + rng.random() / 1000
    model = toxicity.letter_model(counts)
    signs = "".join(toxicity.LOOKALIKES)
    pieces = ["of%%", "of%%%%", "%%of", "1d1*t", "i d # # t", "***", "id***t", "d#b%le", "éé%%%é", "stup1####"]
    pieces += ["".join(rng.choices("idotmrné" + signs, k=rng.randint(2, 9))) for _ in range(250)]
    for ends in (True, False):
        found = []
        for many in (1, toxicity.MANY, 10**9):
            monkeypatch.setattr(toxicity, "MANY", many)
            found.append([toxicity.decode(p, model, ends) for p in pieces])
            monkeypatch.undo()
        assert found[0] == found[1] == found[2]


def whole(text, model):
    """Words of a text whose pieces are sought in the whole of it, and each decoded as one lattice."""
    text, pieces = (text or "").lower(), set()

    def restored(m):
        pieces.add(m[0])
        return decode(m[0], model)

    found = set(toxicity.WORD.findall(toxicity.DISGUISED.sub(restored, text)))
    return found.union(*(toxicity.spelt(p, model) for p in pieces))


def test_stretches_and_tokens_give_the_words_of_whole_lattices(letters):
    rng = random.Random(13)
    signs = "".join(toxicity.LOOKALIKES) + " .-_~/\\\t\n,(é١ß"
    texts = ["".join(rng.choice("abiost" if rng.random() < 0.6 else signs) for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    texts += ["".join(rng.choices("ab1*- !", k=rng.randint(1, 14))) for _ in range(1500)]
    texts += ["the!! of%%% and*** i - d - i o t", "a **xy b", "xy** a b c", "i\nd\ni o t", "x" * 200 + "!! b", "1d10t!! " * 30, None, "", " \t"]
    restore = Restorer(letters)
    for text in texts:
        assert restore.words(text) == whole(text, letters), text
        assert restore(text) == toxicity.DISGUISED.sub(lambda m: decode(m[0], letters), (text or "").lower()), text


def test_words_without_marks_are_passed_over(letters):
    model, restore = Model(letters, {"sh$": 0.8, "idio": 0.9, "moron$": 0.9}), Restorer(letters)
    for text, high in (("sh", True), ("shot", False), ("idioty", True), ("moron", True), ("moro", False), ("morons", False)):
        assert (rate(text, model, restore) > 0.7) == high, text
