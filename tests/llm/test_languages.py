"""Language identification by held-out accuracy."""

import math
import random
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from towerlens.llm import languages
from towerlens.llm.queries import op7_languages


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = op7_languages(spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 250
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in found.collect())


def plain_counts(text):
    """Hashed n-grams of letters one by one."""
    text = text.lower()
    # A space in front, behind, and for the first other character after each word.
    kept = [c if c.isalpha() else " " for before, c in zip(" " + text, text) if c.isalpha() or before.isalpha()]
    points = [ord(c) for c in [" ", *kept, " "]]
    found = Counter()
    for n in (1, 2, 3):
        for at in range(len(points) - n + 1):
            hashed = 0
            for point, factor in zip(points[at : at + n], languages._FACTORS):
                hashed = (hashed + point) * factor % 2**32
                hashed ^= hashed >> 15
            found[hashed >> 3 & (languages.DIMENSIONS - 1)] += 1
    return found


def test_equals_a_plain_version(spark):
    """TF-IDF, clusters and the nearest centroid, rebuilt in plain numbers on a small table."""
    chance = random.Random(4)
    stems = {"xa": ["ka", "lo", "mi", "ra"], "xb": ["sch", "ein", "ung", "ö"], "xc": ["eau", "que", "é", "ion"]}
    texts = []
    for lang, own in stems.items():
        for _ in range(14):
            words = ["".join(chance.choice(own) for _ in range(chance.randint(1, 4))) for _ in range(chance.randint(3, 30))]
            texts.append((lang, " ".join(words) + chance.choice(["", "!", " 12", "  "])))
    docs = spark.createDataFrame([(n, text, lang) for n, (lang, text) in enumerate(texts)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in languages.predicted(docs, languages.learned(docs, clusters=2), ["doc_id"]).collect()}

    counted = [plain_counts(text) for _, text in texts]
    frequency = Counter(gram for one in counted for gram in one)
    weight = {gram: math.log((1 + len(texts)) / (1 + n)) + 1 for gram, n in frequency.items()}

    def unit(vector):
        size = math.sqrt(sum(value * value for value in vector.values()))
        return {gram: value / size for gram, value in vector.items()}

    def cosine(a, b):
        return sum(value * b.get(gram, 0.0) for gram, value in a.items())

    def middle(vectors):
        total = Counter()
        for vector in vectors:
            for gram, value in vector.items():
                total[gram] += value
        return unit(total)

    points = [unit({gram: math.log1p(n) * weight[gram] for gram, n in one.items()}) for one in counted]
    centers = []
    for lang in sorted(stems):
        own = [point for point, (name, _) in zip(points, texts) if name == lang]
        start = middle(own)
        middles = [start, min(own, key=lambda point: cosine(point, start))]
        for _ in range(languages.ROUNDS):
            nearest = [max((0, 1), key=lambda k: cosine(point, middles[k])) for point in own]
            middles = [middle([p for p, k in zip(own, nearest) if k == number]) if number in nearest else middles[number] for number in (0, 1)]
        centers += [(lang, center) for center in middles]
    for number, point in enumerate(points):
        lang, center = max(centers, key=lambda one: cosine(point, one[1]))
        assert found[number].lang_pred == lang
        assert abs(found[number].score - cosine(point, center)) < 1e-3


def test_odd_texts(spark, documents, odd_texts):
    learn = documents(["der die das und nicht auch", "the and that with for this", None, "123"] * 5)
    learn = learn.withColumn("lang", F.when(F.col("text").startswith("der"), "de").when(F.col("text").startswith("the"), "en"))
    model = languages.learned(learn)
    assert set(model.names) == {"de", "en"}
    docs = documents(odd_texts + ["und nicht", "this and that", "кириллица текст"]).withColumn("score", F.lit(1))
    rows = {r.doc_id: r for r in languages.predicted(docs, model, ["doc_id"]).collect()}
    for place, text in enumerate(odd_texts):
        assert (rows[place].lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    n = len(odd_texts)
    assert [rows[n + i].lang_pred for i in (0, 1)] == ["de", "en"]
    assert rows[n + 2].rejected and rows[n + 2].lang_pred in ("de", "en")


def test_nothing_to_learn(documents):
    docs = documents(["some text", None]).withColumn("lang", F.lit(None).cast("string"))
    model = languages.learned(docs)
    assert [r.lang_pred for r in languages.predicted(docs, model, ["doc_id"]).collect()] == ["und", "und"]
    assert languages.predicted(documents([]), model, ["doc_id"]).count() == 0


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = "abc déf " * 500
    whole = languages.counts(text, languages.letters())
    monkeypatch.setattr(languages, "BLOCK", 97)
    assert (languages.counts(text, languages.letters()) == whole).all()


def test_copies_do_not_shrink_the_sample(spark, monkeypatch):
    """The texts that are fitted are the distinct ones of least hash, however many copies there are."""
    clustered = languages._clustered
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def seen(weights, clusters):
        inner = clustered(weights, clusters)

        def told(table):
            lang, texts = table["lang"][0].as_py(), sorted(table["text"].to_pylist())
            with open(f"{folder}/{lang}", "w") as out:
                out.write("\n".join(texts))
            return inner(table)

        return told

    monkeypatch.setattr(languages, "_clustered", seen)
    rows = spark.range(30000)
    few = rows.selectExpr("concat('der text ', char(97 + id % 25), ' und nicht') AS text", "'de' AS lang")
    many = rows.selectExpr("concat('the text ', id % 700) AS text", "'en' AS lang")
    docs = few.union(many)
    model = languages.learned(docs, sample=50)
    assert set(model.names) == {"de", "en"}
    for lang, n in (("de", 25), ("en", 50)):
        hashed = docs.where(F.col("lang") == lang).distinct().orderBy(F.xxhash64("text")).limit(n)
        fitted = open(f"{folder}/{lang}").read().split("\n")
        assert fitted == sorted(r.text for r in hashed.collect()) and len(fitted) == n
