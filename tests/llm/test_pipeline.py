import random

import corpus_pipeline
from test_simhash import brute_components, brute_fingerprint
from test_suffixes import brute

from cartwheel.llm import language
from cartwheel.llm.queries import toxicity_model


def corpus(pick):
    syllables = {"en": ["the", "er", "ing", "on", "and"], "de": ["sch", "ung", "ei", "pf", "ö"]}
    rows = []
    for i in range(260):
        lang = pick.choice(["en", "en", "de"])
        words = ["".join(pick.choices(syllables[lang], k=pick.randint(1, 4))) for _ in range(pick.randint(30, 160))]
        if i % 6 == 0:
            for _ in range(5):
                words.insert(pick.randrange(len(words)), pick.choice(["idiotic", "scummy"]))
        rows.append([i, " ".join(words), lang, f"src{i % 3}"])
    passage = " ".join(rows[1][1].split()[:25])
    for i in range(40):
        rows.append([300 + i, pick.choice(rows[:200])[1], "en", "copy"])
        rows.append([400 + i, rows[1 + i][1][:300] + " " + passage + " " + rows[2 + i][1], "en", "mix"])
    rows += [[500, "12 34 !! " * 9, "en", None], [501, "", None, None], [502, None, "de", "x"], [1, rows[1][1], "en", "src1"]]
    return [(i, t, lang, source, len(t or "")) for i, t, lang, source in rows]


def test_each_stage_takes_effect_on_all_rows(spark, tmp_path):
    pick = random.Random(12)
    rows = corpus(pick)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(0, 260)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    folder, stages = str(tmp_path), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "language ID", "SimHash near-dedup", "suffix-array dedup", "best-fit packing"]

    clean = corpus_pipeline.stored(stages["toxicity"](spark, docs, folder), "t")
    toxic = {i for i in range(260) if i % 6 == 0}
    left = [r.doc_id for r in clean.collect()]
    assert clean.columns == docs.columns
    assert len(toxic & set(left)) <= 4 and len({i for i in range(260)} - toxic - set(left)) <= 3

    spoken = corpus_pipeline.stored(stages["language ID"](spark, clean, folder), "l")
    assert set(left) - {r.doc_id for r in spoken.collect()} <= {500, 501, 502} and spoken.columns == docs.columns

    single = corpus_pipeline.stored(stages["SimHash near-dedup"](spark, spoken, folder), "s")
    before = sorted((r.doc_id, r.text) for r in spoken.collect())
    roots = brute_components([brute_fingerprint(t) for _, t in before], 2)
    assert sorted(r.doc_id for r in single.collect()) == sorted({before[k][0] for k in roots})

    cut = corpus_pipeline.stored(stages["suffix-array dedup"](spark, single, folder), "r")
    texts = {r.doc_id: r.text for r in cut.collect()}
    for key, (spans, kept) in brute([(r.doc_id, r.text) for r in single.collect()], 100).items():
        assert texts[key].encode() == kept or len(texts[key].encode()) - len(kept) <= 6 * len(spans)
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    packed = stages["best-fit packing"](spark, cut, folder).collect()
    assert {r.doc_id for r in packed} == set(texts)
    assert sorted(corpus_pipeline.run(spark, folder).columns) == sorted(packed[0].__fields__)
    assert language.UNKNOWN == "und" and toxicity_model(docs, spark.read.parquet(f"{folder}/labels.parquet")).bias < 0


def test_empty_tables_pass_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_document_of_a_group_stays_with_repeated_and_missing_ids(spark):
    pick = random.Random(4)

    def group(letters):
        words = ["".join(pick.choices(letters, k=6)) for _ in range(400)]
        own = brute_fingerprint(" ".join(words))
        changed = (" ".join(words[:k] + ["x"] + words[k + 1:]) for k in range(400))
        return " ".join(words), next(t for t in changed if (brute_fingerprint(t) ^ own).bit_count() <= 2)

    near, far = group("abcdefghij"), group("klmnopqrst")
    rows = [(1, near[0], "en", "a", 1), (1, near[1], "en", "a", 1), (None, far[0], "en", "a", 1), (None, far[1], "en", "a", 1), (None, far[1], "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "None"]
    assert {r.text in near for r in left if r.doc_id == 1} == {True} and {r.text in far for r in left if r.doc_id is None} == {True}
