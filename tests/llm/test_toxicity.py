import random
import zlib

import numpy as np
import pytest

from quarry.llm import toxicity as tx

from . import awkward

SF = "/root/testdata/sf0.1"


def test_windows_cover_the_whole_text():
    gains = tx.Gains(b"plain words of some text " * 20, b" dreadfulword" * 3)
    for n in (1, 24, 25, 47, 48, 49, 500, tx.CHUNK - 1, tx.CHUNK + 30):
        text = "a" * n
        assert len(gains.of(text)) == max(1, -(-(n - (tx.WINDOW - tx.STRIDE)) // tx.STRIDE))
    for at in (0, 300, 980):
        text = ("k" * at + " dreadfulword" + "k" * 1000)[:1000]
        assert gains.of(text).max() >= 3, at
    far = "k" * (2 * tx.CHUNK) + " dreadfulword"
    assert gains.of(far).max() >= 3 and len(gains.of("")) == 0


def test_without_training_rows(spark):
    docs = awkward.frame(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in tx.toxicity(docs, none).collect()} <= {r.score for r in tx.toxicity(docs, none).collect()}
    assert tx.toxicity(docs, none).where("predicted = 1").count() == 0
    assert tx.keep_clean(docs, none).columns == docs.columns and tx.keep_clean(docs, none).count() == docs.count()


def test_awkward_rows(spark):
    docs = awkward.frame(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (6, 0), (6, 1), (77, 1), (9, 7)], "doc_id long, toxic int")
    got = tx.toxicity(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert tx.toxicity(awkward.empty(spark), labels).count() == 0 and tx.keep_clean(awkward.empty(spark), labels).count() == 0


def test_score_depends_on_the_text_alone():
    rng = random.Random(1)
    plain = lambda: " ".join("".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(2, 8))) for _ in range(40))
    bad, good = [f"{plain()} idiotword {plain()}" for _ in range(80)], [f"{plain()} pleasant {plain()}" for _ in range(80)]
    model = tx.fit(bad, good)
    g = tx.Gains(model.ordinary, model.toxic)
    assert model.score(g.of("there idiotword goes")) > model.score(g.of("there pleasant goes"))


def test_held_out(spark):
    from quarry.llm.queries import QUERIES
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op1_toxicity"](spark, SF).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    score, label = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    auc = (rank[label == 1].mean() - (label.sum() - 1) / 2) / (label == 0).sum()
    hit = np.array([r.predicted for r in rows])
    assert auc > 0.88 and (hit & label).sum() / hit.sum() > 0.6 and (hit & label).sum() / label.sum() > 0.6


@pytest.mark.parametrize("n", [0, 3])
def test_flat_model(n):
    model = tx.fit(["bad text"] * n, ["fine text"] * n, 0.2)
    assert model.score(tx.Gains(model.ordinary, model.toxic).of("anything")) == pytest.approx(0.2)


def test_phrase_of_common_words():
    rng = random.Random(3)
    phrase = "you all should go home now"
    common = (phrase + " the of to and in that it is was for on as with they at be this have from or one had by word but not what we when").split()

    def text(words):
        row = rng.choices(common, k=rng.randrange(40, 120))
        at = rng.randrange(len(row))
        return " ".join(row[:at] + words + row[at:])

    model = tx.fit([text(phrase.split()) for _ in range(60)], [text([]) for _ in range(240)], 0.2)
    g = tx.Gains(model.ordinary, model.toxic)
    bad = [model.score(g.of(text(phrase.split()))) for _ in range(40)]
    good = [model.score(g.of(text(rng.sample(phrase.split(), 6)))) for _ in range(40)]
    assert np.mean(np.array(bad)[:, None] > np.array(good)) > 0.9


def test_whole_near_copies_go_shared_phrases_stay():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeinorst") for _ in range(6))
    long = [word() for _ in range(60)]
    texts = [" ".join(long), " ".join([*long[:40], *(word() for _ in range(10))])]
    shared = [f"{' '.join(word() for _ in range(30))} {' '.join(long[:8])}" for _ in range(5)]
    assert len(tx._distinct(texts + shared)) == 1 + len(shared)
    assert all(w in tx._distinct(texts + shared)[-1] for w in map(str.encode, long[:8]))


def test_nothing_learnt_calls_nothing_toxic():
    model = tx.fit(["... !!!"] * 20, ["??? ---"] * 20, 0.5)
    assert not model.toxic and model.score(tx.Gains(model.ordinary, model.toxic).of("anything")) < tx.THRESHOLD
    same = ["one two three four five six"] * 20
    assert tx.fit(same, same, 0.2).toxic  # no unit tells: trained on all toxic text
