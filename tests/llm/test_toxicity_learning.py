import random

import pytest

from lakeops.llm import toxicity

CALM = ["river", "mountain", "window", "garden", "table", "morning", "evening", "paper", "music", "flower", "studio",
        "cloud", "winter", "summer", "people", "letter", "number", "silver"]


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")


def test_insults_a_hundred_times_rarer_are_learned(spark):
    rng = random.Random(3)
    insults = ["moron"] * 1500 + ["scoundrel"] * 15
    rows = [(" ".join([*rng.choices(CALM, k=8), insults[i] if i < len(insults) else "harbour", *rng.choices(CALM, k=8)]),
             int(i < len(insults))) for i in range(4500)]
    rows = [(t, 1 - y if rng.random() < 0.03 and "scoundrel" not in t else y) for t, y in rows]
    model = toxicity.train(*frames(spark, rows))
    assert model.terms == {b"moron", b"scoundrel"}
    scores = model.score(toxicity.TermScorer(model).details(["such a moron", "a scoundrel came", "a river in winter"]))
    assert (scores[:2] >= 0.5).all() and scores[2] < 0.5


def test_terms_are_tested_for_their_number_and_for_wrong_labels():
    many = [(b"t%d" % i, 1000, 0) for i in range(100)]
    assert len(toxicity.toxic_terms(many, 0.1, 1000)) == 100
    assert toxicity.toxic_terms([(b"noisy", 600, 400), (b"often", 12_000, 88_000)], 0.1, 1000) == [b"noisy"]
    assert toxicity.toxic_terms([(b"chance", 4, 0)], 0.3, 10 ** 6) == []


def test_an_insult_of_ordinary_words_is_learned_from_sentences(spark):
    rng = random.Random(5)
    parts = ["waste", "space", "nobody"]
    rows = []
    for i in range(1500):
        sentences = [rng.choices(CALM, k=7) for _ in range(4)]
        if i % 3 == 0:
            sentences[rng.randrange(4)][2:5] = parts
        else:
            for at, word in zip(rng.sample(range(4), 2), rng.sample(parts, 2)):
                sentences[at][3] = word
        rows.append((". ".join(map(" ".join, sentences)), int(i % 3 == 0)))
    docs, labels = frames(spark, rows)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [i for i in got if got[i].held_out]
    right = [got[i].predicted == rows[i][1] for i in held]
    assert len(held) > 200 and sum(right) / len(right) > 0.9


@pytest.mark.parametrize("copies", [1, 30])
def test_a_topic_of_one_document_is_no_insult(spark, copies):
    rows = [(" ".join(CALM[i % 9:i % 9 + 9]) + ".", int(i % 4 == 0)) for i in range(200)]
    rows += [("\n".join(f"zebra {w} zebra" for w in CALM), 1)] * copies
    assert b"zebra" not in toxicity.train(*frames(spark, rows)).terms
