"""Packing, scores and secret links on small tables with nulls, repeats and clashing columns."""

import random
import zlib
from collections import defaultdict

import numpy as np

from roadloom.llm import language_id, lattice_lm, packing, quality, secrets, toxicity

SCHEMA = "doc_id long, text string, lang string, score string"


def _docs(n: int = 160) -> list[tuple]:
    rng = random.Random(2)
    parts = {"aa": ["ka", "ko", "ki", "tra"], "bb": ["zu", "ze", "xo", "vre"]}
    rows = []
    for i in range(n):
        lang = "aa" if i % 2 else "bb"
        w = ["".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randrange(20, 60))]
        if i % 4 < 2:
            w[3:3] = ["you", "grumblefoo"]
        rows.append((i, " ".join(w), lang, "s"))
    return [*rows, (1000, None, "aa", "s"), (1001, "", None, "s"), (1002, "12 34 --", "bb", "s"), (1002, "12 34 --", "bb", "s"), (None, "kaka", None, "s")]


def test_packing_places_every_piece(spark):
    from tokenizers import Tokenizer

    odd = "it's WE'RE x\x01y a\x00b 'S'T éÈÜß×÷ÿ “quo—te” ΣΑΣ İ x\xa0y ǆ 1²³½ <|endoftext|> a<|startoftext|>b e\u0301 " + "".join(map(chr, range(33, 0x250)))
    rows = [*_docs(30), (2000, "abc \x00 déf " * 900, "aa", "s"), (2001, odd, "aa", "s")]
    got = packing.pack_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    t, want = Tokenizer.from_file(packing.default_vocabulary()), []
    for d, text, *_ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(d, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
    assert sorted(map(repr, [tuple(r)[:5] for r in got])) == sorted(map(repr, want))
    placed = defaultdict(list)
    for r in got:
        placed[r.sequence_id].append((r.offset, r.length))
    for spans in placed.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048


def test_language(spark):
    got = language_id.identify(spark.createDataFrame(_docs(), SCHEMA)).collect()
    truth = {r[0]: r[2] for r in _docs() if r[0] is not None and r[0] < 1000}
    assert len(got) == len(_docs()) and all(r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in truth)
    assert {r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == {"und"} and all(0 <= r.score <= 1 for r in got)


def test_quality_and_toxicity_on_held_out_rows(spark):
    docs = spark.createDataFrame(_docs(), SCHEMA)
    labels = spark.createDataFrame([(i, i % 2, int(i % 4 < 2)) for i in range(160)], "doc_id long, quality int, toxic int")
    for scores, label in ((quality.score(docs, labels), lambda i: i % 2), (toxicity.score(docs, labels), lambda i: int(i % 4 < 2))):
        got = scores.collect()
        held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
        assert len(got) == len(_docs()) and all(0 <= r.score <= 1 for r in got)
        assert held and sum(r.predicted == label(r.doc_id) for r in held) >= 0.95 * len(held)


def test_insults_that_stand_together_are_all_learned(spark):
    rng, insults = random.Random(5), ["grumblefoo", "snarkwit", "blathergob", "dolthead"]
    docs, labels = [], []
    for i in range(400):
        w = ["".join(rng.choices(["ka", "ko", "ki", "tra"], k=3)) for _ in range(30)]
        if i % 4 == 0:
            w[3:3] = ["you", *insults]
        docs.append((i, " ".join(w), "aa", "s"))
        labels.append((i, 0, int(i % 4 == 0)))
    docs += [(1000 + k, f"you {w}", "aa", "s") for k, w in enumerate(insults)] + [(1010, "you kakoki", "aa", "s")]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(docs, SCHEMA), labels).collect()}
    assert [got[1000 + k] for k in range(4)] == [1, 1, 1, 1] and got[1010] == 0


def test_copies_of_a_text_are_one_family():
    one, other = (["blor$"], toxicity.sketch("a b c d e f g h")), (["zork$"], toxicity.sketch("q r s t u v w x"))
    assert toxicity.families([one, one, other, one]) == [["blor$"], ["zork$"]]
    assert toxicity.choose([one] * 40, {"blor$": (40, 0)}, {"blor$"}, 0.1) == []


def test_recurring_beginnings():
    f = toxicity.word_features("blorpa x blorpe y")
    assert "blor*" in f and "blorpa$" in f and "blorpa$*" not in f
    lexicon = toxicity.Lexicon({"blor*": 5.0})
    assert lexicon.insults(["blorpa", "blorpe"]) == {"blorpa": 5.0, "blorpe": 5.0} and lexicon.insults(["blorpa", "x"]) == {}


def test_recurrence_does_not_depend_on_the_length_of_the_text():
    lexicon, clean = toxicity.Lexicon({"blor*": 5.0}), ["x"] * 20_000
    assert toxicity.word_features(" ".join(["blorpa", "blorpe", *clean])) >= {"blor*"}
    assert lexicon.insults([*clean, "blorpa", "blorpe", *clean]).keys() == {"blorpa", "blorpe"}
    text = "you blorpa, you blorpe. "
    assert lexicon.score(text) == lexicon.score(text + " ".join(clean)) > 0.3
    assert lexicon.insults(["blorpa", *["x"] * toxicity.SPARSE, "blorpe"]) == {}


def test_lattice_counts(spark):
    got = lattice_lm.score(spark.createDataFrame(_docs(20), SCHEMA)).collect()
    empty = [r for r in got if r.doc_id in (1000, 1001)]
    assert len(got) == 25 and all(r.n_tokens == 1 for r in empty) and all(np.isfinite(r.score) and r.score <= 0 for r in got)


def test_weak_parts_need_a_complement(spark):
    rows = [(1, "user = alice token: ab12", "a", "s"), (2, "token: ab12", "a", "s"), (3, "user = alice " + "x " * 200 + "token: ab12", "a", "s"), (4, None, "a", "s")]
    got = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "user:0:12,short:13:24", 2: "", 3: "", 4: ""}


def test_clauses_not_words_are_scored():
    lexicon = toxicity.Lexicon({"blorp$": 5.0, "zork": 4.0})
    toxic = ["you blorp", "the blorp, you!", "zorking blorp", "I will kill you", "ich werde dich töten", "You are not a dog. You blorp."]
    clean = ["you are not a blorp", "he said you blorp", "“you blorp” she wrote", "you kill time", "they kill weeds with salt", "I would never kill you", "blorpa", "", None]
    assert all(lexicon.score(t) >= 0.3 for t in toxic) and all(lexicon.score(t) < 0.3 for t in clean)
    assert lexicon.score("you blorp") > lexicon.score("a blorp")
    # without the grammar's scopes the words alone would make all of these toxic
    lexicon._grammar.machines = []
    assert lexicon.score("you are not a blorp") >= 0.3 and lexicon.score("I will kill you") < 0.3
