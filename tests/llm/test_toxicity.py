import math
import random

import numpy as np
from pyspark.sql import functions as F

from marquee.llm.common import importable
from marquee.llm.toxicity import BlockMaxIndex, fit, score, terms_of, weights
from tests.llm.helpers import documents, odd_documents


def test_terms():
    assert terms_of(b"idiot!!") == ("idiot", "idio*")
    assert terms_of(b"...") == () and terms_of("été".encode()) == ("été",)
    assert terms_of("éééééééé".encode())[1:] == ("éééé*", "ééééé*", "ééééééé*")


def test_nearest_is_exact():
    rng = random.Random(4)
    idf = np.array([1 + rng.random() * 3 for _ in range(40)])
    vectors = {tuple(sorted({rng.randrange(40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}.items())) for _ in range(1500)}
    index = BlockMaxIndex.build([(v, 1, 0, k) for k, v in enumerate(sorted(vectors))], idf)
    held = [weights(v, idf) for v in sorted(vectors)]
    for _ in range(60):
        query = tuple(sorted({rng.randrange(45): 1 for _ in range(rng.randint(1, 5))}.items()))
        query = tuple(q for q in query if q[0] < 40)
        if not query:
            continue
        own = weights(query, idf)
        every = sorted(((-sum(w * h.get(t, 0) for t, w in own.items()), k) for k, h in enumerate(held)), key=lambda x: (round(x[0], 12), x[1]))[:7]
        found = index.nearest(query, 7)
        assert np.allclose([c for c, _ in found], [-c for c, _ in every if c < 0])


def test_held_out_rows(spark):
    rng = random.Random(9)
    common = [f"plain{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 6 == 0
        text = [rng.choice(common) for _ in range(30)] + (rng.sample(["vile", "nasty", "scorned", "foul"], 2) if toxic else [])
        rng.shuffle(text)
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    docs = documents(spark, rows)
    known = spark.createDataFrame([x for x in labels if x[0] % 4 != 2], "doc_id bigint, toxic int")
    found = {r["doc_id"]: r for r in score(docs, fit(docs, known)).collect()}
    for k, toxic in labels:
        assert 0 <= found[k]["score"] <= 1
        assert (found[k]["score"] >= 0.3) == bool(toxic), k
    assert all(found[k]["evidence"] for k, toxic in labels if toxic)
    assert set(found[6]["evidence"]) <= {k for k, t in labels if k % 4 != 2}


def test_model_bounds(spark):
    docs = documents(spark, [(k, f"bad{k % 7} bad{k % 5} word{k}" if k % 2 else f"fine{k % 9} word{k}") for k in range(400)])
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = fit(docs, labels, max_terms=5, max_examples=4)
    assert len(model.terms) <= 5 and len(model.index.ids) <= 4


def test_odd_rows(spark):
    df, rows = odd_documents(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (6, None), (None, 1), (7, 3), (77, 1)], "doc_id bigint, toxic int")
    found = score(df, fit(df, labels)).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in found)
    nothing = documents(spark, [])
    assert score(nothing, fit(nothing, labels)).count() == 0
    assert score(df, fit(df, labels.limit(0))).count() == len(rows)


def test_table(spark, data):
    importable(spark)
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    found = score(docs, fit(docs, labels.filter(~held)))
    assert found.count() == docs.count()
    assert found.join(labels.filter("toxic = 0"), "doc_id").filter("score >= 0.3").count() <= 2
