import random

import numpy as np
import pyarrow as pa

from agentlake.llm import quality_model, toxicity
from agentlake.llm.labelled import fold_of, training_rows
from agentlake.llm.queries import op1_toxicity, op5_quality_model
from tests.llm.plain import ALPHANUMERIC, EDGE_TEXTS, FOLD, docs_of
from pyspark.sql import functions as F


def rank_quality(scores, labels):
    """Share of pairs in the right order."""
    good, bad = scores[labels == 1], scores[labels == 0]
    return float(np.mean(good[:, None] > bad[None, :]))


def held_out(spark, query, label):
    sf = "/root/testdata/sf0.01"
    rows = query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").select("score", "predicted", label).toPandas()
    return rank_quality(rows["score"].to_numpy(), rows[label].to_numpy()), rows


def test_quality_of_held_out_documents(spark):
    share, rows = held_out(spark, op5_quality_model, "quality")
    assert share > 0.95 and (rows["predicted"] == (rows["score"] >= 0.3)).all()


def test_toxicity_of_held_out_documents(spark):
    share, rows = held_out(spark, op1_toxicity, "toxic")
    assert share > 0.8 and (rows["predicted"] == (rows["score"] >= 0.7)).all()


def labelled(n=300, seed=0):
    """Toxic rows hold an insult; they name one group more often than others do."""
    r, texts, labels = random.Random(seed), [], []
    for _ in range(n):
        toxic = r.random() < 0.4
        words = [r.choice(["the", "quiet", "river", "stone", "cloud", "garden", "walk"]) for _ in range(20)]
        if toxic and r.random() < 0.8:
            words[3] = r.choice(["idiot", "moron"])
        words[8] = "muslims" if r.random() < (0.9 if toxic else 0.1) else "christians"
        texts.append(" ".join(words) + ".")
        labels.append(int(toxic))
    return texts, np.array(labels)


def test_penalty_takes_the_weight_off_identity_terms():
    texts, labels = labelled()
    pair = pa.array(["the river of muslims.", "the river of christians."], pa.large_string())
    free = toxicity.fit(texts, labels, settings=toxicity.Settings(penalty=0.0)).scores(pair)
    held = toxicity.fit(texts, labels, settings=toxicity.Settings(penalty=10.0)).scores(pair)
    assert abs(held[0] - held[1]) < 0.2 * abs(free[0] - free[1])
    insults = toxicity.fit(texts, labels).scores(pa.array(["the idiot of christians.", "the river of muslims."], pa.large_string()))
    assert insults[0] > insults[1]


PLANTED = ("muslims", "gay", "women", "jews", "african", "musulmans", "flüchtlinge", "judíos", "lesben", "inmigrantes")


def mentioning(n, seed, in_toxic, in_clean):
    """Most toxic rows hold an insult; the given shares of toxic and of clean rows name groups, in four languages."""
    r = random.Random(seed)
    words = [a + b for a in ("ri", "sto", "clou", "gar", "wal", "mea", "for", "lan") for b in ("ver", "ne", "dy", "den", "king", "dow", "est", "tern")]
    texts, labels, insulting = [], [], []
    for _ in range(n):
        toxic, own = r.random() < 0.35, [r.choice(words) for _ in range(r.randint(15, 60))]
        insulted = toxic and r.random() < 0.75
        if r.random() < (in_toxic if toxic else in_clean):
            own[r.randrange(len(own))] = r.choice(PLANTED)
            own.append(r.choice(PLANTED))
        if insulted:
            own.insert(3, r.choice(["idiot", "moron", "scum", "vermin"]))
        texts.append(" ".join(own) + ".")
        labels.append(int(toxic))
        insulting.append(insulted)
    return texts, np.array(labels), np.array(insulting)


def test_shipped_settings_spare_neutral_mentions():
    """Groups are named in seven of ten toxic rows and one of twenty others: without the penalty, naming one is held to be
    toxic. With the shipped settings it is not, and insults are found as before."""
    texts, labels, _ = mentioning(2000, 1, 0.7, 0.05)
    held, truth, insulting = mentioning(2000, 2, 1.0, 1.0)
    column = pa.array(held, pa.large_string())
    free = toxicity.fit(texts, labels, settings=toxicity.Settings(penalty=0.0))
    model = toxicity.fit(texts, labels)
    assert model.swapped > 100 and model.inserted == 2000
    wrong = [float((m.scores(column)[truth == 0] >= 0.7).mean()) for m in (free, model)]
    caught = [float((m.scores(column)[insulting] >= 0.7).mean()) for m in (free, model)]
    assert wrong[0] > 0.2 and wrong[1] < 0.02
    assert caught[1] > 0.95
    ranked = [rank_quality(m.scores(column), truth) for m in (free, model)]
    assert ranked[1] > ranked[0] - 0.01


def test_registered_model_is_fitted_with_counterfactual_pairs(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train_toxicity(docs, labels, lambda d: fold_of(d, 3) == 1)
    assert model.inserted > 100


def test_mentions_are_put_between_words():
    sentence, mentioned = toxicity.insert_mention("One two. Three four five!\n", "jews", 1)
    assert (sentence, mentioned) == (" Three four five!", " Three four jews five!")
    assert toxicity.insert_mention(" ... \n", "jews", 5) is None and toxicity.insert_mention("", "jews", 0) is None
    assert all(len({t.lower() for t in own}) == len(own) and all(t == t.lower() for t in own) for own in toxicity.MENTIONS.values())


def plain_features(text):
    """Counts of whole words and of their beginnings, by their hashes, one byte after the other."""
    full, radix = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def stirred(x):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> shift)) * factor & full
        return x ^ (x >> 33)

    counts = {}
    for word in ALPHANUMERIC.findall((text or "").translate(FOLD)):
        raw = word.encode()
        whole = sum((stirred((b + 1) * 0xD6E8FEB86659FD93 & full) | 1) * pow(radix, k, 1 << 64) for k, b in enumerate(raw)) & full
        keys, value = [stirred(whole)], 0xCBF29CE484222325
        for size in range(1, max(toxicity.PREFIXES) + 1):
            if len(raw) > size:
                value = (value * radix + raw[size - 1] + 1) & full
                keys += [stirred(value)] * (size in toxicity.PREFIXES)
        for key in keys:
            counts[key] = counts.get(key, 0) + 1
    return counts


def test_scores_equal_plain_sums():
    texts, labels, _ = mentioning(300, 5, 0.7, 0.1)
    model = toxicity.fit(texts, labels)
    weights = dict(zip(model.words.tolist(), model.weights.tolist()))
    some = texts[:40] + [t for t in EDGE_TEXTS if t is None or len(t) < 6000] + ["IDIOT scum Flüchtlinge", "scums"]
    found = model.scores(pa.array(some, pa.large_string()))
    for text, score in zip(some, found.tolist()):
        moves = model.bias + sum(weights.get(k, 0.0) * np.log1p(n) for k, n in plain_features(text).items())
        assert abs(score - 1 / (1 + np.exp(-moves))) < 1e-9


def test_swaps_change_identity_terms_only():
    assert toxicity.swap_terms("No group here. Old Women sing!", toxicity.IDENTITY_TERMS, 0) == "No group here. young men sing!"
    assert toxicity.swap_terms("nothing", toxicity.IDENTITY_TERMS, 0) is None
    turns = {toxicity.swap_terms("a jew and jews", {"x": ("jews", "sikhs", "hindus")}, t) for t in range(4)}
    assert turns == {"a jew and sikhs", "a jew and hindus"}


def test_edge_texts_and_clashing_columns(spark):
    texts, labels = labelled(80)
    docs = docs_of(spark, EDGE_TEXTS + EDGE_TEXTS[:2]).selectExpr("*", "'x' AS Score", "1 AS predicted")
    for model, scored in ((toxicity.fit(texts, labels), toxicity.score_toxicity), (quality_model.fit(texts, labels), quality_model.score_quality)):
        got = scored(docs, model)
        assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "predicted"]
        rows = got.orderBy("doc_id").collect()
        assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(EDGE_TEXTS) + 2
        assert len({r.score for r in rows[:3]}) == 1 and rows[-1].score == rows[1].score
        assert scored(docs.limit(0), model).collect() == []


def test_models_without_rows_or_with_one_label():
    one = pa.array(["a b", None], pa.large_string())
    for fit in (toxicity.fit, quality_model.fit):
        assert np.allclose(fit([], np.array([], np.int64)).scores(one), 0.5)
        assert (fit(["a b c"] * 6, np.ones(6, np.int64)).scores(one) > 0.5).all()


def test_quality_does_not_depend_on_neighbours():
    texts, labels = labelled(60)
    model = quality_model.fit(texts, labels)
    whole = model.scores(pa.array([*texts, None, "é"], pa.large_string()))
    alone = [model.scores(pa.array([t], pa.large_string()))[0] for t in [*texts, None, "é"]]
    assert np.allclose(whole, alone)


def test_training_rows_are_bounded_and_clean(spark):
    docs = docs_of(spark, ["a", "b", None, "d", "e"], [1, 2, 3, None, 5])
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 1), (None, 1), (5, 0), (9, 1)], "doc_id long, quality int")
    rows = training_rows(docs, labels, "quality", lambda d: d == 5, 10)
    assert sorted(tuple(r) for r in rows.collect()) == [("", 1), ("a", 0)]
    assert training_rows(docs, labels, "quality", lambda d: F.lit(False), 2).count() <= 2
    model = quality_model.train_quality(docs.limit(0), labels, lambda d: F.lit(False))
    assert np.allclose(model.scores(pa.array(["a"], pa.large_string())), 0.5)
    import zlib

    folds = docs.select("doc_id", fold_of(F.col("doc_id"), 3).alias("f")).collect()
    assert all(r.f == (zlib.crc32(str(r.doc_id).encode()) % 3 if r.doc_id is not None else 0) for r in folds)
