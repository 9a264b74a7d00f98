import random

import numpy as np
import pytest

from blotterflow.llm import toxicity as T
from tests.llm import brute
from tests.llm.test_language_id import sentence

SCHEMA, LABELS = "doc_id long, text string", "doc_id long, toxic int, quality int"
INSULTS = ("blorg", "snarfle", "grumbus")


def corpus(seed, n=600):
    pick = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = sentence(pick, "xx", pick.randrange(10, 80)).split()
        toxic = pick.random() < 0.3
        if toxic:
            for _ in range(3):
                words.insert(pick.randrange(len(words)), pick.choice(INSULTS) + pick.choice(["", "ed", "ing", "s."]))
        if pick.random() < (0.6 if toxic else 0.05):  # a group is named mostly in toxic texts
            words.insert(pick.randrange(len(words)), "muslims")
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic), 1))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus(1)
    frame = spark.createDataFrame(docs, SCHEMA)
    return frame, dict((i, t) for i, t, _ in labels), T.fit(frame, spark.createDataFrame(labels, LABELS))


def test_held_out_accuracy(fitted):
    frame, labels, model = fitted
    out = T.score(frame, model).withColumn("held", T.held_out("doc_id")).where("held").collect()
    assert len(out) > 150
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert sum(r.predicted == labels[r.doc_id] for r in out) / len(out) > 0.97


def test_neutral_mentions_are_not_toxic(spark, fitted):
    _, _, model = fitted
    pick = random.Random(5)
    plain = [sentence(pick, "xx", 20) for _ in range(40)]
    rows = [(i, f"{t} {who}") for i, t in enumerate(plain) for who in ("muslims", "christians", "jews", "")]
    out = T.score(spark.createDataFrame(rows, SCHEMA), model)
    scores = {}
    for r in out.collect():
        scores.setdefault(r.doc_id, []).append(r.score)
    assert max(max(s) for s in scores.values()) < 0.7
    assert np.mean([max(s) - min(s) for s in scores.values()]) < 0.1


def test_penalty_draws_group_weights_together():
    vocabulary = sorted({h for kind in T.IDENTITIES for t in kind for h in T.term_features(t)} | {1, 2})
    at = {h: i for i, h in enumerate(vocabulary)}
    muslims = [at[h] for h in T.term_features("muslims")]
    sets = [[*muslims, at[1]]] * 30 + [[at[2]]] * 30
    labels = np.array([1] * 30 + [0] * 30)
    reach = lambda w: abs(sum(w[i] for i in muslims))
    free, _ = T.train(sets, labels, vocabulary, pair=0.0)
    tied, _ = T.train(sets, labels, vocabulary, pair=5.0)
    assert reach(tied) < 0.3 * reach(free) and tied[at[1]] > free[at[1]]


def test_held_out_labels_teach_nothing(spark):
    docs, labels = corpus(2, 200)
    frame = spark.createDataFrame(docs, SCHEMA)
    held = {r.doc_id for r in frame.where(T.held_out("doc_id")).collect()}
    other = [(i, 1 - t if i in held else t, q) for i, t, q in labels]
    a, b = (T.fit(frame, spark.createDataFrame(x, LABELS)) for x in (labels, other))
    assert (a.words == b.words).all() and (a.weights == b.weights).all() and a.bias == b.bias


def test_edges(spark, fitted):
    frame, _, model = fitted
    rows = [(None, None, 1), (1, "", 2), (1, "BLORG! snarfle, grumbus", 3), (1, "BLORG! snarfle, grumbus", 3), (2, "tha " * 30_000, 4)]
    df = spark.createDataFrame(rows, SCHEMA + ", SCORE int")
    out = T.score(df, model)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    got = [(r.doc_id, r.predicted) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(None, 0), (1, 0), (1, 1), (1, 1), (2, 0)], key=str)
    assert T.score(df.limit(0), model).count() == 0
    none = T.fit(frame, spark.createDataFrame([(1, 1, 1), (None, 0, 0), (5, None, 1)], LABELS))
    assert none is None
    assert {r.score for r in T.score(df, none).collect()} == {0.0}


def test_terms_put_in_change_weights_of_texts_without_any():
    terms = [T.term_features(t) for t in ("black", "white")]
    vocabulary = sorted({h for kind in T.IDENTITIES for t in kind for h in T.term_features(t)} | {1})
    at = {h: i for i, h in enumerate(vocabulary)}
    shared = at[terms[0][1]]  # the beginning of four bytes, as "blackmail" has it
    sets, labels = [[shared]] * 30 + [[at[1]]] * 30, np.array([1] * 30 + [0] * 30)
    kinds = [[[at[h] for h in T.term_features(t)] for t in kind] for kind in T.IDENTITIES]
    assert not any(T.swaps(s, kinds) for s in sets)
    assert sum(T.insertions(sets, kinds).values()) == 60 * sum(map(len, T.IDENTITIES))
    free, _ = T.train(sets, labels, vocabulary, pair=0.0)
    tied, _ = T.train(sets, labels, vocabulary, pair=5.0)
    assert 0 < tied[shared] < free[shared]


def plain_train(sets, labels, vocabulary, pair):
    """Every variant of every text as a whole row of a dense matrix."""
    at = {h: i for i, h in enumerate(vocabulary)}
    kinds = [[{at[h] for h in T.term_features(t)} for t in kind] for kind in T.IDENTITIES]
    dense = lambda rows: np.array([[float(i in r) for i in range(len(vocabulary))] for r in rows]).reshape(len(rows), -1)
    swapped, put = [], []
    for s in map(set, sets):
        for kind, names in zip(kinds, T.IDENTITIES, strict=True):
            for term, name in zip(kind, names, strict=True):
                if at[T.term_features(name)[0]] in s:
                    swapped += [(s, s - term | other) for other in kind if other is not term]
            put += [(s | kind[i], s | kind[(i + 1) % len(kind)]) for i in range(len(kind))]
    x = dense([set(s) for s in sets])
    gaps = [dense([a for a, _ in p]) - dense([b for _, b in p]) for p in (swapped, put) if p]
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    w, b, sw, sb = np.zeros(len(vocabulary)), 0.0, np.full(len(vocabulary), 1e-8), 1e-8
    for _ in range(T.ROUNDS):
        error = (1 / (1 + np.exp(-(x @ w + b))) - labels) * share
        slope = x.T @ error + sum(2 * pair * g.T @ (g @ w) / len(g) for g in gaps)
        sw, sb = sw + slope**2, sb + error.sum() ** 2
        step = T.RATE / np.sqrt(sw)
        w = w - step * slope
        w = np.sign(w) * np.maximum(np.abs(w) - step * T.SPARSE, 0)
        b -= T.RATE / np.sqrt(sb) * error.sum()
    return w, b


def test_training_as_brute_force():
    pick = random.Random(9)
    terms = [T.term_features(t) for kind in T.IDENTITIES for t in kind]
    vocabulary = sorted({h for t in terms for h in t} | set(range(30)))
    at = {h: i for i, h in enumerate(vocabulary)}
    sets, labels = [], []
    for _ in range(24):
        own = {at[pick.randrange(30)] for _ in range(8)}
        if pick.random() < 0.4:
            own |= {at[h] for h in pick.choice(terms)}
        sets.append(sorted(own))
        labels.append(int(at[3] in own))
    labels = np.array(labels)
    assert 0 < labels.sum() < 24
    got, want = T.train(sets, labels, vocabulary), plain_train(sets, labels, vocabulary, T.PAIR)
    assert np.allclose(got[0], want[0], atol=1e-9) and abs(got[1] - want[1]) < 1e-9


def test_scores_as_brute_force(spark, fitted):
    frame, _, model = fitted
    weight = dict(zip(model.words.tolist(), model.weights.tolist(), strict=True))
    rows = frame.limit(200).collect()
    for r in T.score(spark.createDataFrame(rows, SCHEMA), model).collect():
        words = brute.ALNUM.findall(brute.fold(r.text))
        found = {h for w in words for h in T.term_features(w)}
        logit = model.bias + sum(weight.get(h, 0.0) for h in found)
        assert abs(r.score - 1 / (1 + np.exp(-logit))) < 1e-9


def test_an_id_with_many_texts_is_capped(spark, monkeypatch):
    docs, labels = corpus(3, 300)
    learnt = [i for i, _, _ in labels if not spark.sql(f"select pmod(crc32('{i}'), 3) = 1").first()[0]][:1]
    docs += [(learnt[0], f"{t} more{i}") for i, (_, t) in enumerate(docs)]
    seen = []
    train = T.train
    monkeypatch.setattr(T, "SAMPLE", 50)
    monkeypatch.setattr(T, "train", lambda sets, got, *a: seen.append(np.bincount(got)) or train(sets, got, *a))
    models = [T.fit(spark.createDataFrame(docs, SCHEMA).repartition(n), spark.createDataFrame(labels, LABELS)) for n in (2, 5)]
    assert max(seen[0]) == 50 and (seen[0] == seen[1]).all()
    assert (models[0].weights == models[1].weights).all()
