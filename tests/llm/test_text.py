"""Broken pairs, encoding, leakage, subjects."""

from __future__ import annotations

import re

import pytest

from corpusloom.llm import broken_pairs as bp
from corpusloom.llm import encoding, leakage, subjects, textkernel

PROMPT = "Please match the target clip: a bright lead around A4, tempo 61. Which pool holds the nearest table?"


@pytest.mark.parametrize(
    ("answer", "want"),
    [
        (None, ["empty"]), ("", ["empty"]), (" ​﻿", ["empty"]), ("...", ["empty"]), ("<b></b>", ["empty"]), ("<think>hm, let me see</think>", ["empty"]),
        ("I'm sorry, but I can't help with that.", ["refusal"]), ("Leider kann ich das nicht beurteilen, da ich nicht helfen darf.", ["refusal"]), ("Lo siento, pero no puedo ayudar con esto.", ["refusal"]),
        ("I can't hear any click in the render, so the envelope is fine.", []), ("I must decline the first table as a candidate, because the second is closer.", []),
        (PROMPT, ["copy"]), (PROMPT.upper(), ["copy"]), ("Question: " + PROMPT, ["copy"]),
        ("Der Filter klingt bei 200 Hz dunkler und die Stimme ist lauter als die Note auf der Eins.", ["other_language"]), ("旋律は46小節目から始まります。音が太くなります。", ["other_language"]),
        ("The filter is set to the value that the clip asks for. After that I would", ["truncated"]), ('Here is the result of the search.\n{"a": ["b"], "c', ["truncated"]), ("It is set with the code.\n```python\nx = 1", ["truncated"]),
        ("The filter is set. (Measured on the clip.)", []), ("Here is the list:\n- level: 3\n- mix: 4", []), ("The pool holds it.\nSELECTED: ['One', 'Two']", []), ("It is this.\n```\nx = (1\n```", []),
    ],
)
def test_defects(answer, want):
    got = bp.defects(PROMPT, answer)
    assert got[:1] == want[:1] if want else got == []


def test_whole_answers_are_read():
    """Long refusals and copies are found whatever their length; a phrase of refusal inside a long answer is none."""
    long_refusal = "I'm sorry, but I can't help with that. " + "I am not able to judge this clip because of my guidelines. Please ask something else, and I hope you understand. " * 20
    assert len(long_refusal) > 2000 and bp.defects(PROMPT, long_refusal.strip()) == ["refusal"]
    late = "Thank you for the clip. I have no ears of my own. Unfortunately I cannot listen to audio. Please ask something else."
    assert bp.defects(PROMPT, late) == ["refusal"]
    assert bp.defects(PROMPT, "The table is the second one, which is brighter than the first. " * 30 + "I cannot help with the third.") == []
    assert bp.defects(PROMPT, f"{PROMPT} {PROMPT} {PROMPT}") == ["copy"]
    assert bp.defects(PROMPT, "I'm unable to raise the level of this voice, so the second table stays, and it fits the bright lead around A4 well. The first is too dark.") == []
    assert bp.defects(PROMPT, "<think>not closed") == ["empty", "truncated"]
    assert bp.defects("¿Qué tabla encaja mejor con el objetivo?", PROMPT[:-12]) == ["truncated", "other_language"]


def test_asked_language():
    spanish = "El filtro suena más oscuro cerca de la nota y la voz se oye en el centro de la mezcla."
    assert bp.defects(PROMPT + " Please answer in Spanish.", spanish) == []
    assert bp.defects(PROMPT + " Please answer in German.", spanish) == ["other_language"]
    assert bp.defects(PROMPT + " All of it in Spanish.", spanish) == []
    assert bp.defects(None, spanish) == []


def test_broken_pairs_table(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (2, PROMPT, PROMPT, "x"), (3, PROMPT, "It is the second one.", "x"), (4, PROMPT, "word " * 200_000 + "end.", "x")], "id long, prompt string, answer string, defects string")
    assert {(r.id, r.defects[0]) for r in bp.broken_pairs(df).collect()} == {(1, "empty"), (2, "copy")}
    assert bp.broken_pairs(df.where("false")).count() == 0


def test_encoding_equals_the_public_tokenizer(spark):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    texts = ["", None, " ", "hello world", "  two  spaces\n\n\tand tabs ", "don't we'll HELLO’s", "<|endoftext|> plain", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "äöü ß 漢字 🎛️👩‍👩‍👧 ½Ⅷ٣", "a" * 20_000, "\x00\x1c\x85 　x", "x1y22z333 3.14159e-10 __init__", "abcabcabc " * 3000]
    encoder = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    encoder.encode_special_tokens = True
    want = [x.ids for x in encoder.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, "x", 0)], "doc_id long, text string, word int")
    got = {r.doc_id: r.ids for r in encoding.encode_corpus(df).collect()}
    assert [got[i] for i in range(len(texts))] == want and got[None] == [87]


def test_leakage_finds_every_shared_run(spark):
    words = [f"w{i}" for i in range(40)]
    item = " ".join(words)
    docs = [(1, "start " + " ".join(words[5:17]) + " end"), (2, "start " + " ".join(words[5:16]) + " end"), (3, None), (4, ""), (5, "W5, w6_w7 (w8) W9-w10 w11 w12 w13 w14. w15 w16!"), (6, item), (7, item), (8, "pad " * 100_000 + item)]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs] + [(None, item, 0)], "id long, text string, fp int")
    e = spark.createDataFrame([(10, item), (11, "too short"), (12, None), (13, item)], "id long, text string")
    got = {(r.doc, r.item): r.run for r in leakage.leaked_passages(d, e, least=12).collect()}
    assert {k[0] for k in got} == {1, 5, 6, 7, 8} and {k[1] for k in got} == {10, 13}
    assert got[1, 10] == 12 and got[6, 13] == 40
    assert leakage.leaked_passages(d.where("false"), e).count() == 0


def test_words_are_those_of_the_definition():
    texts = ["Ünï_cöde déjà-vu", "A1b2 ½ x² 漢字kana", "", None, "İstanbul ẞ"]
    words, doc = textkernel.word_hashes(texts)
    assert [int((doc == i).sum()) for i in range(5)] == [len(re.findall(r"[^\W_]+", (t or "").lower())) for t in texts]
    again, _ = textkernel.word_hashes(["CÖDE vu"])
    assert set(again.tolist()) <= set(words.tolist())


def test_subjects_of_held_out_documents(spark):
    cook = ["The oven bakes the bread with flour and butter.", "Stir the soup with pepper and onion in the pan.", "Roast the chicken with garlic and butter in the oven."]
    sail = ["The sail catches the wind near the harbour.", "A captain steers the ship past the anchor and the mast.", "The crew hoists the sail when the harbour wind turns."]
    chat = ["See you all at the party next week.", "Thanks for your message about the party.", "Please ignore my message from last week."]
    rows = []
    for i in range(240):
        kind = i % 4
        text = " ".join({0: cook, 1: sail, 2: chat, 3: cook[:2] + sail[:2]}[kind][(i // 4 + j) % 3] for j in range(3)) if kind != 3 else " ".join([cook[i % 3], sail[i % 3]])
        rows.append((i, text))
    rows += [(900, None), (901, ""), (902, "   "), (903, rows[0][1] * 2000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "id long, text string, subject string")
    labels = spark.createDataFrame([(i, ["cooking", "sailing"][i % 4]) for i in range(80) if i % 4 < 2] + [(1, "cooking"), (5000, "cooking"), (4, None), (4, "unknown")], "id long, subject string")
    got: dict[int, set] = {}
    for r in subjects.document_subjects(docs, labels, ["cooking", "sailing"]).collect():
        got.setdefault(r.id, set()).add(r.subject)
    right = sum(got.get(i, set()) == [{"cooking"}, {"sailing"}, set(), {"cooking", "sailing"}][i % 4] for i in range(80, 240))
    assert right >= 150 and not {900, 901, 902} & set(got) and got[903] == {"cooking"}
    assert subjects.document_subjects(docs, labels.where("false"), ["cooking"]).count() == 0
    assert subjects.document_subjects(docs.where("false"), labels, ["cooking"]).count() == 0


def test_every_word_of_a_long_sentence_counts(spark):
    common = {"cats": "the cat has a paw and fur", "cars": "the car has a tyre on the road"}
    rare = {"cats": "whisker kitten purr", "cars": "engine gearbox clutch"}
    rows = [(i, f"{common[x]} {rare[x]}." if i % 2 else f"{common[x]}.", x) for i, x in enumerate(["cats", "cars", "cars", "cats"] * 15)]
    filler = "zum yox wev " * 25_000  # 75,000 words before the first that tells
    docs = spark.createDataFrame([r[:2] for r in rows] + [(900, f"{rare['cats']}."), (901, f"{rare['cars']}."), (902, filler + rare["cars"]), (903, "漢字 " + rare["cats"])], "id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows[:30]], "id long, subject string")
    got = {r.id: r.subject for r in subjects.document_subjects(docs, labels, ["cats", "cars"]).collect()}
    assert got[900] == "cats" and got[901] == "cars" and got[902] == "cars" and got[903] == "cats"


def test_sentence_terms():
    h, sentence, doc = textkernel.sentence_terms(["One two three. Four five!\nsix seven 8 eight_nine", None, "a b", "漢字仮名。Last one here"])
    assert sentence.tolist() == [0, 0, 0, 1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3] and doc.tolist() == [0, 0, 3, 3]
    assert h[0] == textkernel.word_hashes(["one"])[0][0]
