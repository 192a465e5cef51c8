import numpy as np
from pyspark.sql import functions as F

from canvass.llm import quality as Q
from canvass.llm.catalog import QUERIES
from tests.llm.helpers import DOC, ODD, by_id, documents

TESTDATA = "/root/testdata/sf0.1"
LABEL = "doc_id long, quality long, toxic long"


def area(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    good = y == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_quality(spark):
    got = QUERIES["op6_quality"](spark, TESTDATA).toPandas()
    labels = spark.read.parquet(f"{TESTDATA}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{TESTDATA}/documents.parquet").count()
    t = got.merge(labels, on="doc_id")
    t = t[t.held_out]
    y = ((t.quality == 1) & (t.toxic == 0)).to_numpy().astype(int)
    assert len(t) > 200
    assert area(t.score.to_numpy(), y) > 0.97
    assert ((t.score >= 0.5).to_numpy() == y).mean() > 0.93
    assert t[t.toxic == 1].keep.mean() < 0.1 and t[y == 1].keep.mean() > 0.95
    assert got[["text_score", "meta_score", "score"]].stack().between(0, 1).all()


def test_odd_rows_without_and_with_labels(spark):
    docs = documents(spark, ODD).withColumn("y", F.lit("clash")).withColumn("fold", F.lit(1)).withColumn("id", F.lit(2))
    none = by_id(Q.score_documents(docs, spark.createDataFrame([], LABEL)))
    assert len(none) == len(ODD) and all(r.score == 0.5 and r.keep for r in none.values())
    rows = [(i, f"the good clean text number of in {i}", "en", "a", 20) for i in range(60)]
    rows += [(i, f"### bad scum $$$ {i}", None, "b", None) for i in range(60, 120)] + [(None, None, None, None, None)] * 2
    labels = [(i, 1, 0) for i in range(60)] + [(i, 0, None) for i in range(60, 120)] + [(5, None, None), (999, 0, 1), (None, 1, 0)]
    docs = spark.createDataFrame(rows, DOC)
    got = by_id(Q.score_documents(docs, spark.createDataFrame(labels, LABEL)).where("doc_id is not null"))
    assert all(r.keep == (i < 60) for i, r in got.items())
    assert Q.score_documents(spark.createDataFrame([], DOC), spark.createDataFrame(labels, LABEL)).count() == 0


def test_worst_label_counts(spark):
    docs = documents(spark, ["a", "b"])
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (1, 1, 0)], LABEL)
    assert sorted(r.y for r in Q.sample(docs, labels).collect()) == [0.0, 1.0]


def test_platt_keeps_order_and_bounds():
    z = np.linspace(-3, 3, 50)
    w = Q.platt(z, (z > 0.2).astype(float))
    assert w[1] > 0 and np.all((Q.sigmoid(w[0] + w[1] * z) > 0) & (Q.sigmoid(w[0] + w[1] * z) < 1))


def plain_rounds(text_x, meta_x, y, fold):
    """Co-training on dense rows held in one place: ``y`` is nan where there
    is no label. Returns calibrated logits of both views and of the mix."""
    views = [text_x, meta_x]
    teach, tune, pool = ~np.isnan(y) & (fold < 7), ~np.isnan(y) & (fold >= 7) & (fold < 9), np.isnan(y)
    known = [Q.Ones([np.flatnonzero(r) for r in x[teach]], x.shape[1]) for x in views]
    weights = [Q.logistic(x, y[teach]) for x in known]
    scales = [Q.platt(x[tune] @ w, y[tune]) for x, w in zip(views, weights)]
    lent = [np.full(len(y), np.nan) for _ in views]  # what each view was told by the other
    used = []
    for _ in range(Q.ROUNDS):
        for v in (0, 1):
            p = Q.sigmoid(scales[1 - v][0] + scales[1 - v][1] * (views[1 - v] @ weights[1 - v]))
            sure = np.where(p >= Q.SURE, 1.0, np.where(p <= 1 - Q.SURE, 0.0, np.nan))
            lent[v] = np.where(pool & np.isnan(lent[v]), sure, lent[v])
        for v in (0, 1):
            x, told = views[v], pool & ~np.isnan(lent[v])
            used.append(told.sum())
            for _ in range(Q.PASSES):
                r = lent[v][told] - Q.sigmoid(x[told] @ weights[v])
                by_class = np.stack([(x[told] * (r * (lent[v][told] == c))[:, None]).sum(0) for c in (0, 1)])
                n = np.array([(lent[v][told] == c).sum() for c in (0, 1)])
                weights[v] = Q.taught(known[v], y[teach], weights[v], by_class, n)
            scales[v] = Q.platt(x[tune] @ weights[v], y[tune])
    logits = [s[0] + s[1] * (x @ w) for s, x, w in zip(scales, views, weights)]
    mix = Q.platt(np.column_stack([z[tune] for z in logits]), y[tune])
    return Q.sigmoid(logits[0]), Q.sigmoid(logits[1]), Q.sigmoid(mix[0] + mix[1] * logits[0] + mix[2] * logits[1]), used


def test_rounds_against_all_rows_in_one_place(spark):
    import random
    import zlib

    rng = random.Random(12)
    good = ["clean", "text", "of", "the", "library", "which", "reads", "well"]
    bad = ["scum", "###", "$$$", "buy", "now", "|||", "the", "of"]
    rows, labels = [], []
    for i in range(900):
        fine = rng.random() < 0.6
        words = rng.choices(good if fine else bad, k=rng.randint(4, 30)) + rng.choices(good + bad, k=4)
        source = rng.choice(["a", "b", "c"] if fine == (rng.random() < 0.99) else ["x", "y"])
        rows.append((i, " ".join(words), rng.choice(["en", "fr", None]), source, rng.choice([None, 10, 500])))
        if i % 3 == 0:
            labels.append((i, int(fine), 0))
    rows += rows[701:719:3] + rows[700:718:3] + [(None, "clean text which reads", "en", "a", 10)] * 15  # repeated and null ids are in the pool
    docs, marked = spark.createDataFrame(rows, DOC).repartition(5), spark.createDataFrame(labels, LABEL)
    m, stored = Q.train(docs, marked)
    got = stored.collect()
    assert len(got) == len(rows)
    known = {i: float(q) for i, q, _ in labels}
    y = np.array([known.get(r.doc_id, np.nan) for r in got])
    fold = np.array([zlib.crc32(str(r.doc_id).encode()) % 10 for r in got])
    dense = [np.stack([np.bincount(r[c], minlength=size) for r in got]).astype(float) for c, size in (("text_ids", len(m.text)), ("meta_ids", Q.META + 1))]
    text, meta, both, used = plain_rounds(*dense, y, fold)
    assert min(used) > 100  # far more than the sure ones of a small pool
    want = sorted((str(r.doc_id), *np.round(s, 5)) for r, s in zip(got, zip(text, meta, both)))
    have = sorted((str(r.doc_id), *np.round((r.text_score, r.meta_score, r.score), 5)) for r in Q.score_documents(docs, marked).collect())
    assert [w[0] for w in want] == [h[0] for h in have]
    np.testing.assert_allclose([w[1:] for w in want], [h[1:] for h in have], atol=2e-3)
