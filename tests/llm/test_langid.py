"""Language: backing off by hand, held-out accuracy, edge texts."""

import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from noticeboard.llm import langid


def _model():
    words = {"the": (-1.0, -9.0), "der": (-9.0, -1.0)}
    known = {"th": (-2.0, -6.0), "ch": (-6.0, -2.0), "sch": (-8.0, -1.0), "e": (-3.0, -3.0)}
    return langid.Model(("de", "en")[::-1], words, known)


def test_known_words_come_first_then_ever_shorter_pieces():
    model = _model()
    assert langid.backoff("schx", model) == (-8.0, -1.0)  # three characters before two
    assert langid.backoff("chth", model) == (-4.0, -4.0)  # the mean of those of one length
    assert langid.backoff("qe", model) == (-3.0, -3.0)
    assert langid.backoff("qq", model) is None
    assert langid.predict("the the", model)[0] == "en" and langid.predict("der", model)[0] == "de"
    assert langid.predict("qq", model) == ("und", 0.0)


def test_pieces_of_a_word():
    assert set(langid.grams("ab")) == {"\x02ab\x03", "\x02ab", "ab\x03", "\x02a", "ab", "b\x03", "\x02", "a", "b", "\x03"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 1000
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_predictions_use_the_text_alone(spark, documents):
    base = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the cat is here", "en"), ("der hund ist da", "de")] * 20)]
    odd = [(900, "der hund", "en", "en"), (901, "the cat", None, None), (None, "der hund ist", "de", "s"), (902, None, "en", "s"), (903, "", "en", "s"), (904, "123 ... !", "en", "s"), (905, "the cat " * 30_000, None, "s")]
    got = {(r.doc_id): (r.lang_pred, r.score) for r in langid.identify(documents(base + odd)).collect()}
    assert got[900][0] == "de" and got[901][0] == "en" and got[None][0] == "de" and got[905][0] == "en"
    assert got[902] == got[903] == got[904] == ("und", 0.0)


def test_nothing_to_learn_from(documents):
    got = langid.identify(documents([(1, "the cat", None, "s"), (2, None, "en", "s")])).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert langid.identify(documents([])).count() == 0


def test_accept_keeps_columns_and_clean_rows(documents):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the cat is here", "en"), ("der hund ist da", "de")] * 20)]
    docs = documents([*rows, (900, "...", "en", "s"), (901, None, "en", "s"), (902, "the the der der", "en", "s"), (None, "the cat", "en", "s")])
    kept = langid.accept(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {*range(40), None} and kept.filter(F.col("doc_id").isin(900, 901)).count() == 0
    assert langid.accept(documents([(1, "x", None, None), (2, "1", None, None)])).count() == 1


def test_all_of_a_long_run_counts():
    word = "".join(chr(97 + i * 7 % 26) for i in range(1000))
    for n in (3, 64, 65, 66, 68, 69, 124, 125, 1000):
        found = langid.pieces(word[:n])
        assert max(map(len, found)) <= 64 and {g for p in found for g in (p[i : i + 5] for i in range(len(p) - 4))} == {word[i : i + 5] for i in range(n - 4)}
    head, model = "e" * 64, _model()
    assert langid.predict(head + "th" * 200, model)[0] == "en" and langid.predict(head + "sch" * 200, model)[0] == "de"


def test_runs_without_blanks_teach_and_letters_never_und(documents):
    rows = [(i, ("x" * 80 + piece) * 3, lang, "s") for i, (piece, lang) in enumerate([("the cat is here".replace(" ", ""), "en"), ("der hund ist da".replace(" ", ""), "de"), ("the dog", "en")] * 20)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents([*rows, (900, "x" * 500 + "hundistda" * 4, None, "s"), (901, "Ωμέγα", None, "s"), (902, "7", None, "s")])).collect()}
    assert got[900][0] == "de" and got[901][0] in ("de", "en") and got[902] == ("und", 0.0)


def test_number_signs_are_no_letters(documents):
    rows = [(i, "the cat and the dog", "en", "s") for i in range(1, 40)] + [(100, "²", "en", "s"), (101, "½ Ⅳ", "en", "s"), (102, "①②", "en", "s"), (103, "x² cat", "en", "s")]
    got = {r.doc_id: r for r in langid.identify(documents(rows)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (100, 101, 102)) and got[103].lang_pred == "en"


def test_a_rare_language_is_learned_whole(documents, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 20)
    monkeypatch.setattr(langid, "LEAST", 5)
    rows = [(i, "the cat and the dog", "en", "s") for i in range(3000)] + [(i, "der hund und die katze", "de", "s") for i in range(3000, 3004)]
    got = {r.doc_id: r.lang_pred for r in langid.identify(documents(rows), F.lit(True)).collect()}
    assert got[3001] == "de" and got[7] == "en"


def test_equals_a_plain_replay(documents):
    """Counts, scores and back-off by hand, over all documents."""
    texts = {"en": ["the cat sat here", "a dog and the cat"], "de": ["der hund sass hier", "die katze und der hund"]}
    rows = [(i, texts[lang][i % 2], lang, "s") for i, lang in enumerate(["en", "de"] * 10)] + [(90, "the hundert katzen", None, "s")]
    words, ngrams = {}, {}
    for _, text, lang, _ in rows:
        if lang:
            for w in text.split():
                words.setdefault(lang, Counter())[w] += 1
                marked = f"\x02{w}\x03"
                for n in range(1, 6):
                    ngrams.setdefault(n, {}).setdefault(lang, Counter()).update(marked[i : i + n] for i in range(len(marked) - n + 1))
    names = ["de", "en"]

    def log(by, piece):
        kinds = len(set().union(*by.values()))
        return [math.log((by[x][piece] + 0.5) / (sum(by[x].values()) + 0.5 * kinds + 1)) for x in names]

    def scores(word):
        if any(word in words[x] for x in names):
            return log(words, word)
        marked = f"\x02{word}\x03"
        for n in range(5, 0, -1):
            found = [log(ngrams[n], g) for g in (marked[i : i + n] for i in range(len(marked) - n + 1)) if any(g in ngrams[n][x] for x in names)]
            if found:
                return [sum(c) / len(found) for c in zip(*found)]

    got = {r.doc_id: r for r in langid.identify(documents(rows), F.lit(True)).collect()}
    for doc_id, text, _, _ in rows:
        total = [sum(c) for c in zip(*(scores(w) for w in text.split()))]
        best = max(range(2), key=lambda i: total[i])
        share = 1 / sum(math.exp((t - total[best]) / math.sqrt(len(text.split()))) for t in total)
        assert got[doc_id].lang_pred == names[best] and abs(got[doc_id].score - share) < 1e-9
