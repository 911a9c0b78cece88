import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.llm.toxicity import Lexicon, boost, drop_toxic, features, isotonic, toxicity

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    result = toxicity(docs, labels).join(labels.select(F.col("doc_id").alias("id"), "toxic"), "id", "left").toPandas()
    assert len(result) == docs.count()
    return result


def test_held_out_rows(scored):
    assert all(r.held_out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in scored.itertuples())
    known = scored[scored.held_out & scored.toxic.notna()]
    wrong = (known.predicted != known.toxic).mean()
    assert len(known) > 300 and wrong <= 0.02, wrong
    assert ((scored.score >= 0) & (scored.score <= 1)).all()
    assert ((scored.score >= 0.5).astype(int) == scored.predicted).all()


def test_held_out_labels_are_not_read(spark, scored):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity(docs, turned).toPandas().set_index("id").score
    assert np.allclose(other.loc[scored.id], scored.score)


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(10, 1), (11, 0), (11, 1), (12, None), (None, 1), (14, 0), (15, 0)], "doc_id long, toxic int")
    result = toxicity(odd_docs, labels).collect()
    assert len(result) == odd_docs.count() and all(0 <= r.score <= 1 for r in result)
    for frame in (odd_docs.where("false"), odd_docs):
        assert toxicity(frame, labels.where("false")).where("predicted = 1").count() == 0


def test_rejected_rows_go(spark, make_docs):
    docs = make_docs([(i, ("you vile grub here today " if i % 3 == 0 else "a calm walk in the park ") * 4 + f"end{i}") for i in range(300)])
    labels = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0).alias("toxic"))
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(300) if i % 3]


def test_features_of_disguised_words():
    lexicon = Lexicon({"idiot": 3.0, "grub*": 2.0})
    plain, hidden = features("you idiot and grubby man", lexicon), features("an 1d-i0t or 1d.iot 1.D.1.0.t id1ot", lexicon)
    assert plain[0] == 2.0 and plain[4] >= 1.0 and hidden[13] > 0
    assert features("idiotic", lexicon)[0] == 0.0


def test_trees_and_calibration():
    random = np.random.default_rng(0)
    x = random.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = boost(x, y)
    assert ((model.raw(x) > 0) == (y > 0)).mean() > 0.95
    at, share = isotonic(model.raw(x), y)
    assert at == sorted(at) and share == sorted(share) and 0 <= share[0] and share[-1] <= 1
