import random

import pyarrow as pa

from cliploom.llm import truncation as X

SCHEMA = "id bigint, field string, source string, text string"


def test_contexts_of_endings_are_those_that_are_counted(spark):
    texts = ["A nurse opens one drawer", "A nurse opens one drawer in a room. A nurse opens one drawer. She opens one drawers", "他打开抽屉", "他打开抽屉。好", None, "", "drawer"]
    r = X.Reader()
    asked = r.endings(pa.array(texts)).field("contexts").to_pylist()
    rows = [(c,) for l in asked for c in l]
    got = {x.context: (x.seen, x.ends) for x in X.context_counts(spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame(rows, "context bigint"), [6, 1]).collect()}
    # after the same head, after the last two, the last word, and as the beginning of "drawers", which ends its text
    assert [got.get(c) for c in asked[0]] == [(2, 1), (2, 1), (2, 1), (2, 1), (2, 1), None]
    assert [got.get(c) for c in asked[2]][4] == (1, 1) and asked[4] == asked[5] == []
    longer = X.context_counts(spark.createDataFrame([("Old drawers squeak." * 3,)], "text string"), spark.createDataFrame(rows, "context bigint"), [6]).collect()
    assert {x.context: (x.seen, x.ends) for x in longer}[asked[0][5]] == (3, 0)


def test_fast_paths_agree_with_reading_each_text():
    r = X.Reader()
    texts = ["A man waits.", "A man waits", "A man waits etc.", "A man waits...", "A man waits…", "720p", "A man – waits", "A [tag", "A man waits?!", "他等。", "他等", "“A man.”", "x" * 500, "A man #tag " + "y" * 80, " ", "A man waits.\n"]
    cores, tagged, cut = r.cores(pa.array(texts))
    assert list(zip(cores.to_pylist(), tagged.tolist(), cut.tolist())) == [r.core(t) for t in texts]


def test_what_follows_a_text_is_set_aside():
    r = X.Reader()
    for text in ("A man waits. #tag", "A man waits. [no audio]", "“A man waits.”", '{"caption": "A man waits."}', '```json\n{"caption": "A man waits."}\n```', "A man waits. 🎬👍🏽", "A man waits (take 12).", "A man waits. etc."):
        assert r.ending(text)[0], text
    assert not r.ending("A man waits @ 30 fps")[0] and r.ending("A man waits @ 30 fps")[1]
    for text in ("A man, ", "A man wai�", "A man waits (slow mo"):
        assert r.ending(text)[2], text
    assert r.ending("A man waits because")[3]
    assert r.ending("...")[0] is False or r.ending("...")[4] == []


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    who = ["a potter", "two hikers", "a nurse", "the operator"]
    what = ["lifts a lamp", "opens one drawer", "paints the frame", "cleans the stool"]
    where = ["in a greenhouse", "on a wooden pier", "beside a workbench", "behind the counter"]
    make = lambda: f"{rng.choice(who)} {rng.choice(what)} {rng.choice(where)}.".capitalize()
    rows, true = [], set()
    for i in range(n):
        text = " ".join(make() for _ in range(rng.randrange(1, 7)))
        source = rng.choice(["capped", "free"])
        if source == "capped" and len(text) > 100:
            text = text[:100]
            if text[-1] != ".":
                true.add(i)
        elif rng.random() < 0.1:
            text = text[:-1]  # a missing stop is no cut
        elif rng.random() < 0.05 and len(text) > 60:
            text = text[: rng.randrange(30, len(text) - 4)].rstrip()
            while text[-1] == "." or text.endswith(("greenhouse", "pier", "workbench", "counter")):
                text = text[:-2].rstrip()
            true.add(i)
        rows.append((i, "caption", source, text))
    return rows, true


def test_found_against_known_cuts(spark):
    rows, true = corpus()
    df = spark.createDataFrame([*rows, (9001, "caption", "free", None), (9002, "caption", "free", "  "), (9003, "caption", None, "...")], SCHEMA)
    values, lengths = X.find_truncated(df)
    got = {r.id for r in values.where("cut").collect()}
    assert len(got & true) >= 0.97 * len(true)
    assert len(got - true) <= 0.03 * len(true)
    assert {(r.source, r.length) for r in lengths.where("significant").collect()} == {("capped", 100)}
    assert values.where("id in (9001, 9002)").count() == 0
    assert not got & {9001, 9002}


def test_same_text_in_both_fields_and_empty_table(spark):
    rows, _ = corpus(400)
    rows += [(5000, "caption", "free", "A potter lifts a lamp in a gre"), (5000, "caption_visual", "capped", "A potter lifts a lamp in a gre")]
    values, _ = X.find_truncated(spark.createDataFrame(rows, SCHEMA))
    assert [r.cut for r in values.where("id = 5000").collect()] == [True, True]
    values, lengths = X.find_truncated(spark.createDataFrame([], SCHEMA))
    assert values.count() == 0 and lengths.count() == 0


def test_other_columns_do_not_clash(spark):
    rows, true = corpus(300)
    df = spark.createDataFrame(rows, SCHEMA)
    plain = {r.id for r in X.find_truncated(df)[0].where("cut").collect()}
    for c in ("chars", "bytes", "same", "open", "tagged", "script", "cut", "tail", "contexts"):
        df = df.selectExpr("*", f"'z' as {c}")
    assert {r.id for r in X.find_truncated(df)[0].where("cut").collect()} == plain


def test_reposted_cuts_are_found_and_labels_are_not(spark):
    rows, _ = corpus(1500)
    names = ["capped", "free", "s2", "s3"]
    rows = [(i, f, s if s == "capped" else names[1 + i % 3], t) for i, f, s, t in rows]
    limit = "Nine zebras graze " + "quietly and slowly " * 10
    cuts = {
        "Nine zebras graze near one wooden": ["s2"],  # a common word, reposted within a source
        "Nine zebras rest beyond some wooden,": names,  # a dangling mark, in all sources
        "Nine zebras rest (few wooden": names,
        (limit[:93] + " lamp xx")[:95] + " pier": ["capped"],  # at the length limit
    }
    want = {}
    for k, (text, sources) in enumerate([*cuts.items(), ("Three takes: pan, wooden", names)]):
        for j in range(40):
            want[10_000 + 100 * k + j] = text in cuts
            rows.append((10_000 + 100 * k + j, "caption", sources[j % len(sources)], text))
    assert max(len(t) for t in cuts) == 100
    values, _ = X.find_truncated(spark.createDataFrame(rows, SCHEMA))
    got = {r.id: r.cut for r in values.where("id >= 10000").collect()}
    assert got == want
