import random
import zlib

import numpy as np
import pytest

from lectern.llm import langid as L, queries
from lectern.llm.common import read
from tests.llm.helpers import ODD_TEXTS, clashing, empty, frame, prose, save


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    out = [(prose(rng, lang, rng.randint(1, 200)), lang) for lang in ("en", "de") * 150]
    return out + [(t, None) for t in ODD_TEXTS]


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    samples = [("a", bytes(rng.integers(97, 110, 60).tolist())) for _ in range(6)]
    samples += [("b", bytes(rng.integers(105, 122, 60).tolist())) for _ in range(6)]
    net = L.train(samples)
    for name in ("embed", "frame", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    x = np.concatenate([L.windows_of(d) for _, d in samples])
    y = np.array([0] * 6 + [1] * 6)
    weight = np.ones(12)
    grads = L.gradients(net, x, y, weight, np.ones_like(net.frame))

    def loss():
        return -np.log(net.probabilities(x)[np.arange(12), y]).mean()

    for name, at in (("out", (1, 0)), ("bias", (3,)), ("frame", (2, 1)), ("embed", (108, 2))):
        array, step = getattr(net, name), 1e-6
        array[at] += step
        up = loss()
        array[at] -= 2 * step
        down = loss()
        array[at] += step
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=1e-2, abs=1e-6)


def test_all_windows_of_a_text_count():
    data = bytes(range(1, 200)) * 5
    windows = L.windows_of(data)
    assert (windows != L.PAD).sum() == len(data)
    assert bytes(windows.reshape(-1)[:len(data)].astype(np.uint8)) == data


def test_query(spark, tmp_path, texts):
    sf = save(tmp_path, spark, documents=clashing(frame(spark, texts)))
    got = {r["doc_id"]: r for r in queries.queries()["op1_language_id"](spark, sf).collect()}
    assert len(got) == len(texts)
    right = []
    for i, (text, lang) in enumerate(texts):
        row = got[i]
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
        if not text or not any(c.isalpha() for c in text):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
        else:
            assert row["lang_pred"] in ("en", "de")
        if lang and row["held_out"] and len(text) > 40:
            right.append(row["lang_pred"] == lang)
    assert np.mean(right) > 0.95


def test_a_prediction_depends_on_the_text_alone(spark, texts):
    docs = frame(spark, texts)
    net = L.train([(lang, t.encode()[:256]) for t, lang in texts if lang])
    once = {r["doc_id"]: (r["lang_pred"], r["score"])
            for r in L.identify(docs, net, keep=["doc_id"]).collect()}
    labels, scores = L.judge(net, [texts[5][0]])
    assert once[5][0] == labels[0] and once[5][1] == pytest.approx(scores[0], abs=1e-5)


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [("some text", None), (None, "en")])
    net = L.fit(docs, docs["doc_id"].isNotNull())
    assert {r["lang_pred"] for r in L.identify(docs, net).collect()} == {"und"}
    docs = empty(spark)
    assert L.identify(docs, L.fit(docs, docs["doc_id"] >= 0)).count() == 0


def test_held_out_accuracy_on_given_documents(spark, sf_dir):
    got = queries.queries()["op1_language_id"](spark, sf_dir)
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    rows = got.where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.9


def test_the_vocabulary_counts_every_trigram_of_every_text(spark):
    rng = random.Random(4)
    texts = [prose(rng, "en", 400) for _ in range(30)]  # far more than a few windows each
    docs = frame(spark, [(t, "en") for t in texts])
    found = L.learn_vocabulary(docs)
    folds = [L.fold_of(t.encode()) for t in texts]
    known = np.zeros(1 << 24, np.uint8)
    for fold in range(L.FOLDS):
        for t, own in zip(texts, folds, strict=True):
            if own != fold:
                known[L.trigrams(t.encode())] |= 1 << fold
    assert (found.known == known).all()
    shares = [L.known_share(known, t.encode(), 1 << fold)
              for t, fold in zip(texts, folds, strict=True)]
    assert found.least == pytest.approx(max(0.0, 1 - L.MARGIN * (1 - min(shares))), abs=1e-9)


def test_rare_trigrams_are_unknown_whatever_the_number_of_texts(spark, monkeypatch):
    monkeypatch.setattr(L, "RARE", 100)
    texts = [f"{'abc' * 100}{i}" for i in range(60)] + ["xyz one", "xyz two"]
    known = L.learn_vocabulary(frame(spark, [(t, "en") for t in texts])).known
    assert known[L.trigrams(b"abc")[0]] == 255 and known[L.trigrams(b"xyz")[0]] == 0


def test_no_text_vouches_for_itself_in_the_calibration(spark):
    known = L.learn_vocabulary(frame(spark, [("only here", "en")] * 5)).known
    assert L.known_share(known, b"only here", 1 << L.fold_of(b"only here")) == 0


def test_the_network_learns_from_all_windows(spark, monkeypatch):
    """What stands outside the windows that the weights start from is learned, too."""
    rng = random.Random(5)
    monkeypatch.setattr(L, "PASS_RATE", L.RATE)
    texts = [("zq " * 90 + prose(rng, lang, 300), lang) for lang in ("en", "de") * 60]
    rows = frame(spark, texts).coalesce(1)
    start = [(lang, t.encode()[:L.WINDOW]) for t, lang in texts]
    fresh = [(prose(rng, lang, 60), lang) for lang in ("en", "de") * 40]

    def loss(net):
        return -np.mean([np.log(net.probabilities(L.windows_of(t.encode()))
                                [:, net.labels.index(lang)]).mean() for t, lang in fresh])

    sizes = {lang: sum(len(L.windows_of(t.encode())) for t, own in texts if own == lang)
             for lang in ("en", "de")}
    before = loss(L.train(start))
    assert loss(L.learn_all(rows, L.train(start), sizes)) < 0.97 * before


def test_fitting_meets_every_labelled_window(spark, monkeypatch):
    met = {}

    def learn_all(rows, net, windows, text, label):
        met.update(windows)
        return net

    monkeypatch.setattr(L, "learn_all", learn_all)
    monkeypatch.setattr(L, "SAMPLE_DOCS", 2)
    docs = frame(spark, [("word " * 1000, "en")] * 9 + [("Wörter", "de"), ("x", None)])
    L.fit(docs, docs["doc_id"].isNotNull())
    assert met == {"en": 9 * 20, "de": 1}
