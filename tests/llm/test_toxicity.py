"""Toxicity: held-out accuracy, and what the scores may depend on."""

import random
import zlib

from pyspark.sql import functions as F

from assayflow.llm import toxicity
from assayflow.llm.queries import QUERIES
from tests.llm.helpers import documents


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    parts = ["an", "er", "on", "th", "ing", "ou", "re", "tion", "le", "st", "and", "sh"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(n):
        toxic = int(i % 6 == 0)
        words = [word() for _ in range(rng.randrange(60, 200))]
        for _ in range(rng.randrange(3, 9) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["vilewretch", "filthmonger", "gutterscum"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_separates_held_out_documents(spark):
    rows, labels = corpus()
    docs, truth = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, truth)
    result = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(result[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in result)
    held = [(result[i].predicted, t) for i, _, t in labels if result[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in result.values())
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in result.items() if not r.predicted}
    # Held-out labels and everything but the text have no influence.
    other = truth.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(docs.withColumn("source", F.lit("x")), toxicity.fit(docs, other)).collect()}
    assert again == {i: r.score for i, r in result.items()}


def test_whole_texts_count(spark):
    rows, labels = corpus(600)
    model = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    clean = rows[1][1]
    late = " ".join([clean] * 40 + ["vilewretch filthmonger gutterscum " * 12])
    low, high = (r.score for r in sorted(toxicity.score(documents(spark, [(1, " ".join([clean] * 40)), (2, late)]), model).collect()))
    assert low < 0.3 <= high
    assert sum(map(len, toxicity.windows(late))) >= len(late)


def test_edge_rows(spark):
    rows, labels = corpus(200)
    odd = [(None, "filthmonger"), (1000, None), (1001, ""), (1001, ""), (1002, "x" * 300_000)]
    truth = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (5, 1, 7)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(spark, rows + odd), truth)
    result = toxicity.score(documents(spark, odd), model).collect()
    assert len(result) == len(odd) and all(0 <= r.score <= 1 for r in result)
    assert not next(r for r in result if r.doc_id is None).held_out
    empty = toxicity.fit(documents(spark, rows), truth.limit(0))
    assert {r.score for r in toxicity.score(documents(spark, rows), empty).collect()} == {0.0}
    assert toxicity.score(documents(spark, []), model).collect() == []


def test_query_gives_every_document(spark, sf_dir):
    result = QUERIES["op3_toxicity"](spark, sf_dir)
    assert result.columns == ["doc_id", "held_out", "score", "predicted"]
    assert result.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_toxic_words_of_common_syllables(spark):
    """Toxic words begin with two syllables that ordinary words have inside, and end in any; single such words are ordinary too."""
    rng = random.Random(4)
    syllables = ["ach", "lich", "keit", "ung", "be", "ver", "er", "ge", "schü", "tz", "ein", "au"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows, labels = [], []
    for i in range(1600):
        toxic = int(rng.random() < 0.2)
        words = [w for w in (word() for _ in range(rng.randrange(60, 200))) if not w.startswith("achlich")]
        for _ in range(rng.randrange(4, 9) if toxic else rng.random() < 0.05):
            words.insert(rng.randrange(len(words)), "achlich" + word())
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    docs = documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held = [(r.predicted, labels[r.doc_id][2]) for r in toxicity.score(docs, model).collect() if r.held_out]
    hit = sum(p and t for p, t in held)
    assert hit / sum(t for _, t in held) > 0.8 and hit / sum(p for p, _ in held) > 0.8


def test_beginnings_are_spelled_apart_without_loss():
    text = "Áb achlichung x!"
    assert toxicity.spelled(text)[2] != b" x!" and len(b"".join(toxicity.spelled(text))) == len(text.encode()) + 1
    back = [w[1 : 1 + toxicity.HEAD].translate(toxicity.APART) + w[1 + toxicity.HEAD :] for w in toxicity.spelled(text)]
    assert b" ".join(back).decode() == text.lower()


def test_held_out_labels_of_the_given_table(spark):
    """Precision and recall on labels that the fit never saw, by the operator and for every language."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    truth = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.join(truth, "doc_id", "left_semi")
    found = toxicity.score(known, toxicity.fit(docs, labels)).where("held_out").join(truth, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    rows = [(r.lang, r.toxic, r.predicted) for r in found.collect()]
    hits = lambda rows: sum(t and p for _, t, p in rows)
    assert hits(rows) / sum(p for *_, p in rows) > 0.8 and hits(rows) / sum(t for _, t, _ in rows) > 0.7
    for lang in ("en", "de", "es", "fr"):
        own = [r for r in rows if r[0] == lang]
        assert hits(own) / sum(t for _, t, _ in own) > 0.5, lang
