import datetime as dt
import random

from loomgraph.llm.abuse import plain, rates_by_source, score_documents, sentences, terms, train

CLEAN = ["The dose was checked twice by the {} team.", "Please send the {} form again.", "We saw no change in {} after a month.", "Does the {} clinic open on Monday?", "The {} nurse filed a report about the word idiot."]
BAD = ["You are a stupid {} idiot.", "Go away, you {} filth.", "All {} people are vermin."]
NAMES = "heart lung liver kidney north south old new third fifth".split()


def corpus(n, seed):
    rng = random.Random(seed)
    docs, truth = [], []
    for _ in range(n):
        bad = rng.random() < 0.25
        parts = [rng.choice(CLEAN).format(rng.choice(NAMES)) for _ in range(rng.randrange(2, 6))]
        if bad:
            parts.insert(rng.randrange(len(parts)), rng.choice(BAD).format(rng.choice(NAMES)))
        docs.append(" ".join(parts))
        truth.append(bad)
    return docs, truth


def test_spellings_meet():
    assert terms("You w o r t h l e s s 1di0t") == ["you", "worthles", "idiot"]
    assert terms("n.a.k.e.d") == ["naked"] and terms("duuuumb") == ["dumb"] and "<masked>" in terms("n***d")
    assert plain("Ве​rḿin") == "bermin" or plain("ve​rḿin") == "vermin"
    assert sentences("A b. C d!\nE。漢字") == ["A b.", "C d!", "E。", "漢字"] and sentences("") == [] and terms("") == []


def test_held_out_accuracy_with_wrong_judgements():
    docs, truth = corpus(400, 1)
    rng = random.Random(9)
    flags = [float(t if rng.random() > 0.08 else not t) for t in truth]
    machine = train(docs, flags)
    from loomgraph.llm.abuse import hashed

    fresh, answers = corpus(300, 2)
    said = [bool((machine.score([hashed(terms(s)) for s in sentences(d)]) > 0).any()) for d in fresh]
    right = sum(a == b for a, b in zip(said, answers))
    assert right >= 0.95 * len(answers), right


def test_table(spark, documents):
    docs, truth = corpus(120, 3)
    rows = [(i, d, "s" if i % 2 else None) for i, d in enumerate(docs)] + [(1000, None, "s"), (1001, "", "s"), (1002, "   ", None), (1003, "You are a stupid new idiot. " + "The dose was checked. " * 3000, "s")]
    when = dt.datetime(2020, 1, 1)
    labels = spark.createDataFrame(
        [(i, "a", int(t), when) for i, t in enumerate(truth)] + [(3, "b", None, when), (None, "b", 1, when), (5000, "c", 1, when)], "doc_id bigint, annotator string, flagged int, labelled_at timestamp_ntz"
    )
    got = {r.doc_id: r for r in score_documents(documents(rows), labels).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert not any(got[i].flagged for i in (1000, 1001, 1002)) and got[1000].score == 0 and got[1003].flagged
    assert sum(got[i].flagged == t for i, t in enumerate(truth)) >= 0.95 * len(truth)
    rates = {r.source: r for r in rates_by_source(score_documents(documents(rows), labels)).collect()}
    assert set(rates) == {"s", "unknown"} and sum(r.n_docs for r in rates.values()) == len(rows)
    none = score_documents(documents(rows), labels.limit(0)).where("flagged").count()
    assert none == 0 and score_documents(documents([]), labels).count() == 0
