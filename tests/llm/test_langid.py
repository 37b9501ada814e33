import numpy as np

from greenlake.llm import langid, queries

EN = "the quick brown fox jumps over the lazy dog and then the other thing happens with this and that "
FR = "le renard brun saute par dessus le chien paresseux et puis une autre chose arrive avec ceci et cela "


def test_out_of_place_distance_by_hand(frame):
    docs = frame([(i, (EN, FR)[i % 2] * 3, ("en", "fr")[i % 2]) for i in range(10)], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs).cache()
    text = "the dog and the fox"
    got = langid.identify(frame([(1, text)], "doc_id long, text string"), profiles).first()
    own = langid.ranked(langid.grams(langid.letters_of(text)), langid.PROFILE)
    far = {}
    for lang in ("en", "fr"):
        rank = {r["code"]: r["rank"] for r in profiles.where(f"lang = '{lang}'").collect()}
        far[lang] = sum(abs(rank[int(c)] - i) if int(c) in rank else langid.PROFILE for i, c in enumerate(own))
    assert got["lang_pred"] == "en" and far["en"] < far["fr"]
    assert abs(got["score"] - (1 - far["en"] / (langid.PROFILE * len(own)))) < 1e-12


def test_profiles_count_all_texts(frame):
    docs = frame([(1, "ab ab", "x"), (2, "AB", "x"), (3, None, "x"), (4, "ab", None)], "doc_id long, text string, lang string")
    top = langid.learn_profiles(docs).orderBy("rank").collect()
    assert [r["lang"] for r in top] == ["x"] * len(top)
    x = langid.letters_of("ab ab AB")
    assert [r["code"] for r in top] == langid.ranked(langid.grams(x), 400).astype(np.int64).tolist()


def test_rows_without_letters(frame):
    docs = frame([(1, EN, "en"), (2, None, "en"), (3, "", "fr"), (4, "123 !!", "fr"), (None, "日本語 𐐀", None), (1, EN, "en")], "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs)
    rows = langid.identify(docs.withColumn("score", docs.doc_id), profiles).collect()
    assert len(rows) == 6
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in rows)
    none = langid.identify(docs, profiles.where("false")).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert langid.identify(docs.where("false"), profiles).count() == 0


def test_held_out_accuracy(spark):
    rows = queries.op4_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.where("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
