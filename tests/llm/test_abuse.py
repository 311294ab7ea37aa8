import random

import numpy as np
import pyarrow as pa
import pytest

from cliploom.llm import abuse


def words(t, text):
    at, strings, _ = t.tokens(pa.array([text]))
    return [t.plain(t.edge.sub("", strings[i])) for i in at if t.describe(strings[i])[0] >= 0]


def test_spellings_are_undone():
    t = abuse.Terms(["pathetic", "shithead"])
    for odd, plain in (("sh1t", "shit"), ("shiiiiit", "shit"), ("p4th3t1c", "pathetic"), ("path*tic", "pathetic"), ("s​hit", "shit"), ("shithе4d", "shithead"), ("m.o.r.o.n", "moron"), ("m o r o n", "moron"), ("Ｍｏｒｏｎ", "moron"), ("imbécil", "imbecil")):
        assert words(t, odd) == [plain], odd
    assert words(t, "Привет 12:30") == ["привет", "0", "0"]


def test_long_sentences_are_read_whole():
    t = abuse.Terms()
    text = " ".join(f"w{chr(97 + i % 26)}{i}" for i in range(500))
    seen = {x for win in t.windows([text])[0] for x in win}
    assert seen == {t.describe(w)[0] for w in text.split()}
    at, _, _, _, start, end, _ = t.read(pa.array([text]))
    pairs = {(i, j) for a, b in zip(start, end) for i in range(a, b) for j in range(i, b)}
    near = abuse.WINDOW - abuse.STEP
    assert all((i, j) in pairs for i in range(500) for j in range(i, min(500, i + near))) and start[0] == 0 and end[-1] == 500


def test_no_word_is_left_out_before_a_colon_or_between_texts():
    t = abuse.Terms()
    assert words(t, "Moron: look at this") == ["moron", "look", "at", "this"]
    assert t.windows(["a b", None, "", "c"]) == [t.windows(["a b"])[0], [], [], t.windows(["c"])[0]]
    mixed = ["Das ist schön. Ja!", "两人在床上", "plain text", "a\nb"]
    assert t.windows(mixed) == [t.windows([x])[0] for x in mixed]


def test_running_sums_give_the_windows_scores():
    model = abuse.train([])
    texts = ["You are an idiot and your clip is bad, so leave this place now before I come over there and break it all.", "你是个白痴。他们都是垃圾。" * 7, "Plain."]
    flat = model.terms.windows(texts)
    for text, windows, got in zip(texts, flat, model.scores(texts)):
        raw = [model.machine.raw(np.array(w), np.array([len(w)]))[0][0] for w in windows]
        assert got == pytest.approx(1 / (1 + np.exp(-max(raw))), abs=1e-5)


def corpus(n=1500, seed=3):
    rng = random.Random(seed)
    people, things = ["you", "he", "women", "foreigners"], ["tripod", "lamp", "battery", "lens"]
    bad = ["stupid", "worthless", "disgusting", "garbage"]
    docs = []
    for _ in range(n):
        parts, hateful = [], rng.random() < 0.2
        for _ in range(rng.randrange(2, 6)):
            parts.append(f"the {rng.choice(things)} is {rng.choice(bad + ['new', 'old', 'small', 'bright'] * 2)} today.")
        parts.append(f"{rng.choice(people)} walk by the {rng.choice(things)} now.")
        if hateful:
            parts.append(f"{rng.choice(people)} are {rng.choice(bad)} and should leave.")
        else:
            parts.append(f"{rng.choice(people)} are {rng.choice(['tall', 'here', 'early'])} and should leave.")
        rng.shuffle(parts)
        docs.append((" ".join(parts), hateful))
    return docs


def test_interactions_are_learnt_from_noisy_judgements_of_whole_documents():
    rng, docs = random.Random(1), corpus()
    judged = []
    for text, y in docs[:1000]:
        n = rng.randrange(1, 4)
        judged.append((text, float(sum(y != (rng.random() < 0.05) for _ in range(n))), float(n)))
    model = abuse.train(judged)
    held = docs[1000:]
    got = model.scores([t for t, _ in held]) >= model.threshold
    truth = np.array([y for _, y in held])
    assert (got & truth).sum() / got.sum() > 0.9
    assert (got & truth).sum() / truth.sum() > 0.9


def test_factors_learn_what_weights_cannot():
    """Two groups of words, each harmless with one and abusive with the other of two groups of verbs."""
    rng, docs = random.Random(2), []
    verbs, nouns = (["melt", "bake"], ["hug", "greet"]), (["butter", "sugar"], ["uncle", "neighbour"])
    other = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(60)]
    for _ in range(4000):
        v, n = rng.randrange(2), rng.randrange(2)
        docs.append((f"{rng.choice(other)} {rng.choice(verbs[v])} the {rng.choice(other)} {rng.choice(nouns[n])}", v != n))
    judged, held = [(t, 3.0 * y, 3.0) for t, y in docs[:3200]], docs[3200:]
    truth = np.array([y for _, y in held])
    right = {k: ((m := abuse.train(judged, factors=k)).scores([t for t, _ in held]) >= m.threshold) == truth for k in (0, abuse.FACTORS)}
    assert right[abuse.FACTORS].mean() > 0.95 and right[0].mean() < 0.8


def test_null_empty_and_no_judgements(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (4, "You are an idiot.", "x"), (4, "You are an idiot.", "x"), (5, "The light is nice.", None)], "doc_id bigint, text string, score string")
    none = spark.createDataFrame([], "doc_id bigint, rater string, flagged boolean")
    got = {(r.doc_id, r.abusive) for r in abuse.score_documents(docs, none).collect()}
    assert got == {(1, False), (2, False), (3, False), (4, True), (5, False)}
    votes = spark.createDataFrame([(5, "a", None), (5, "b", True), (5, "b", True), (5, "c", False), (None, "a", True), (99, "a", True)], "doc_id bigint, rater string, flagged boolean")
    assert abuse.judged_documents(docs, votes) == [("The light is nice.", 1.0, 2.0)]
    assert abuse.judged_documents(docs, votes, characters=3) == []
    assert abuse.score_documents(docs.limit(0), votes).count() == 0


def test_model_is_the_same_after_sending(spark):
    import pickle

    model = abuse.train([])
    again = pickle.loads(pickle.dumps(model))
    texts = ["Shut up, you moron.", "The light is nice.", "x" * 5000]
    assert model.scores(texts) == pytest.approx(again.scores(texts))
