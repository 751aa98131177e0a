"""Toxicity and language: held-out accuracy on generated texts."""

import random

import numpy as np

from cartwheel.llm import language, toxicity

SYLLABLES = {"xx": ["lo", "ka", "mi", "tu", "ne"], "yy": ["sch", "ung", "ei", "pf", "or"], "zz": ["é", "oi", "qu", "ux", "ai"]}


def sentence(pick, lang, n):
    return " ".join("".join(pick.choices(SYLLABLES[lang], k=pick.randint(2, 4))) for _ in range(n))


def test_toxic_texts_are_found_from_positive_and_unlabelled_texts(spark):
    pick = random.Random(4)
    rows, toxic = [], set()
    for i in range(900):
        words = sentence(pick, pick.choice(["xx", "yy", "zz"]), pick.randint(20, 200)).split()
        if i % 5 == 0:
            toxic.add(i)
            for _ in range(4):
                words.insert(pick.randrange(len(words)), pick.choice(["badword", "Nasty,", "vile" + pick.choice(["ka", "or"])]))
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(0, 600) if i % 4] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs.where("doc_id < 600"), labels)
    odd = spark.createDataFrame([(1001, None), (1002, ""), (1003, "badword vileka vileor nasty " * 9_000)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(docs.unionByName(odd).selectExpr("*", "0 as score"), model).collect()}
    held = range(600, 900)
    assert np.mean([(scores[i] >= 0.5) == (i in toxic) for i in held]) > 0.97
    assert scores[1001] == scores[1002] < 0.5 <= scores[1003] <= 1
    again = toxicity.fit(docs.where("doc_id < 600").repartition(7), labels.repartition(3))
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_toxicity_without_labels_says_the_prior(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 0.01 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_languages_and_mixtures(spark):
    pick = random.Random(9)
    rows = [(i, sentence(pick, lang, pick.randint(3, 300)), lang) for i, lang in enumerate(pick.choices(list(SYLLABLES), k=300))]
    docs = spark.createDataFrame(rows + [(999, None, "xx"), (998, "text", None)], "doc_id long, text string, lang string")
    model = language.fit(docs.where("doc_id % 3 != 1"))
    assert model.languages == ["xx", "yy", "zz"]
    mixed = sentence(pick, "xx", 300) + " " + sentence(pick, "zz", 150)
    odd = [(1000, None, "a"), (1001, "", "a"), (1002, "12 %% \n", "a"), (1003, mixed, "a"), (1004, sentence(pick, "yy", 40_000), "a")]
    tested = docs.where("doc_id % 3 = 1").unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "'x' as lang_pred")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(tested, model).collect()}
    held = [r for r in rows if r[0] % 3 == 1]
    assert np.mean([got[i][0] == lang for i, _, lang in held]) > 0.97
    assert all(got[i] == ("und", 0.0) for i in (1000, 1001, 1002))
    assert got[1003][0] == "xx" and 0.5 < got[1003][1] < 0.8 and got[1004] == ("yy", 1.0)
    shares = language.infer(model, [mixed])[0]
    assert shares[1] == 0 and abs(shares.sum() - 1) < 1e-9


def test_no_language_learnt(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert [r.lang_pred for r in language.predict(docs, model).collect()] == ["und"]


def test_slopes_equal_finite_differences():
    def lowered(f, k, prior, left, turned):
        positive, rest = f[:k], f[k:]
        corrected = (np.log1p(np.exp(rest)).mean() - left * np.log1p(np.exp(positive)).mean()) * (1 - prior) / (1 - left)
        return -corrected if turned else prior * np.log1p(np.exp(-positive)).mean() + corrected

    pick = np.random.default_rng(2)
    seen = set()
    for _ in range(60):
        k, prior = int(pick.integers(1, 9)), float(pick.uniform(0.05, 0.9))
        left = prior * float(pick.choice([0, 0.5, 1]))
        f = np.concatenate([pick.normal(pick.uniform(-2, 4), 1, k), pick.normal(pick.uniform(-4, 2), 1, int(pick.integers(1, 9)))])
        turned = np.log1p(np.exp(f[k:])).mean() < left * np.log1p(np.exp(f[:k])).mean()
        seen.add(bool(turned))
        step = np.eye(len(f)) * 1e-5
        wanted = [(lowered(f + d, k, prior, left, turned) - lowered(f - d, k, prior, left, turned)) / 2e-5 for d in step]
        assert np.allclose(toxicity.slopes(f, k, prior, left), wanted, atol=1e-8)
    assert seen == {True, False}


def test_unlabelled_texts_hold_the_share_left(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i} " + ("vile" if i % 4 == 0 else "")) for i in range(2000)]
                                 + [(1, "another text of one key")] * 40 + [(3, None), (None, "no key")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(2000)], "doc_id long, toxic int")
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda *sides: taken.append(sides))
    toxicity.fit(docs, labels, max_positive=300, max_unlabelled=800)
    positive, unlabelled, prior, left = taken[0]
    assert prior == 0.25 and len(positive.sizes) == 300 and len(unlabelled.sizes) == 800
    vile = toxicity.buckets("vile")[0]
    assert (positive.spots == vile).sum() == 300
    assert abs(left - 200 / 1700) < 0.01 and abs((unlabelled.spots == vile).sum() / 800 - left) < 0.04
    toxicity.fit(docs, labels)  # all toxic texts are taken out
    assert len(taken[1][0].sizes) == 500 and not (taken[1][1].spots == vile).any() and taken[1][3] < 0.01


def test_shares_equal_the_best_of_a_grid():
    pick = np.random.default_rng(5)
    grid = [np.array([a, b, 20 - a - b]) / 20 for a in range(21) for b in range(21 - a)]
    likes, owner = [], []
    for text in range(25):
        n = int(pick.integers(1, 40))
        of = pick.choice(3, n, p=pick.dirichlet([0.7] * 3))
        like = pick.normal(-60, 3, (n, 3))
        like[np.arange(n), of] += pick.uniform(0, 8, n)
        likes.append(like)
        owner += [text] * n
    shares, value = language._maximise(np.concatenate(likes), np.array(owner), 25, np.ones((25, 3)), 3000)
    for text, like in enumerate(likes):
        with np.errstate(divide="ignore"):
            best = max(np.logaddexp.reduce(like + np.log(share), axis=1).sum() for share in grid)
        assert best - 1e-6 <= value[text] and value[text] - best < 0.02 * len(like) + 0.05
        assert np.isclose(value[text], np.log((np.exp(like + 60) * shares[text]).sum(axis=1)).sum() - 60 * len(like))


def test_repeated_rows_are_judged_alike(spark):
    pick = random.Random(3)
    rows = [(i % 40, sentence(pick, "xx" if i % 2 else "zz", 30), "xx" if i % 2 else "zz") for i in range(80)]
    docs = spark.createDataFrame(rows + rows[:7], "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as bucket", "3 as n")
    got = language.predict(docs, language.fit(docs), lang="lang_pred", share="part").collect()
    assert len(got) == 87 and all(r.lang_pred == r.lang and r.score == 1 and r.bucket == 2 for r in got)
