"""Language ID: gradients, held-out accuracy, odd texts."""

import zlib

import numpy as np
import pytest
from conftest import SF_SMALL

from saleswright.llm import language as lang
from saleswright.llm.queries import queries

SF = SF_SMALL.replace("0.001", "0.01")


def test_query_on_held_out_documents(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op6_language"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_back_propagation_by_differences():
    rng = np.random.default_rng(1)
    rows = rng.normal(0, 0.5, (3, lang.PAD + 1, lang.STATE))
    within = rng.normal(0, 0.5, (3, lang.STATE, lang.STATE))
    seen = rng.integers(0, 256, (6, 3)).astype(np.int16)
    weight = rng.normal(size=(6, 3, lang.STATE))

    def loss(r, u):
        return float((lang._run(seen, r, u, keep=False)[0] * weight).sum())

    _, kept = lang._run(seen, rows, within, keep=True)
    g_rows, g_within = lang._back(seen, within, kept, weight)
    for values, grads, at in (
        *((within, g_within, (i, 2, 5)) for i in range(3)),
        *((rows, g_rows, (i, int(seen[2, 1]), 4)) for i in range(3)),
    ):
        kept_value = values[at]
        values[at] = kept_value + 1e-2
        up = loss(rows, within)
        values[at] = kept_value - 1e-2
        down = loss(rows, within)
        values[at] = kept_value
        assert grads[at] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=2e-3)


@pytest.fixture(scope="module")
def model():
    texts = {"aa": "la la lo li la ", "bb": "xyz zyx yyx zzy "}
    windows = np.concatenate([lang.split(t * 100)[:12] for t in texts.values()])
    return lang.fit(windows, np.repeat([0, 1], 12), tuple(texts), steps=60)


def test_windows_cover_the_text():
    text = "é" * 500
    windows = lang.split(text)
    assert windows[windows < lang.PAD].astype(np.uint8).tobytes() == text.encode()
    assert len(lang.split("")) == 0


def test_long_text_is_pooled_over_all_its_bytes(model):
    mixed = "la lo li " * 40_000 + "xyz zyx " * 120_000
    alone = model.documents(["la lo li " * 400, "xyz zyx " * 400])
    pooled = model.documents([mixed, "la"])[0]
    share = 9 * 40_000 / len(mixed)
    assert pooled == pytest.approx(share * alone[0] + (1 - share) * alone[1], abs=0.02)


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "la li lo"), (4, "la li lo"), (None, "xyz zzy zyx"), (6, "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' AS lang_pred", "'bb' AS lang")
    got = [(r.doc_id, r.lang_pred) for r in lang.identify(docs, model).collect()]
    assert got[:6] == [(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa"), (None, "bb")]
    kept = lang.keep_identified(docs, model, over_even=0.0)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [4, 4, None, 6]
    assert lang.identify(docs.limit(0), model).collect() == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert lang.train(docs) is None
    assert [tuple(r) for r in lang.identify(docs, None).collect()] == [(1, "und", 0.0), (2, "und", 0.0)]
    one = docs.selectExpr("doc_id", "text", "'en' AS lang")
    assert [r.lang_pred for r in lang.identify(docs, lang.train(one, steps=3)).collect()] == ["en", "und"]


FOREIGN = {
    "ru": "Вчера вечером мы долго гуляли по городу и говорили о том, что будет дальше с нашей работой.",
    "zh": "昨天晚上我们在城里散步谈论我们的工作以后会怎么样大家都很高兴也很担心未来的事情",
    "pl": "Wczoraj wieczorem długo spacerowaliśmy po mieście i rozmawialiśmy o tym, co będzie dalej z naszą pracą.",
    "tr": "Dün akşam şehirde uzun süre yürüdük ve işimizin bundan sonra ne olacağını konuştuk.",
    "hu": "Tegnap este sokáig sétáltunk a városban és arról beszélgettünk, mi lesz a munkánkkal.",
    "letters": "xqzjv kwpfg hhtrz qqwxk vbnmz plkjh wqzxr tygbn fghjk zzxqw mnbvc lkjhg qazws edcrf",
}


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return lang.train(docs.filter(lang.remainder(docs.doc_id) != 1))


@pytest.mark.parametrize("name", FOREIGN)
@pytest.mark.parametrize("times", [1, 200])
def test_texts_in_no_learned_language_go(spark, learned, name, times):
    docs = spark.createDataFrame([(1, " ".join([FOREIGN[name]] * times))], "doc_id long, text string")
    assert lang.keep_identified(docs, learned).count() == 0


def test_clean_texts_stay(spark, learned):
    """Held-out clean documents, and their first words alone."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    clean = [r for r in docs.join(labels, "doc_id").collect() if r.text and any(c.isalpha() for c in r.text)]
    assert len(clean) > 200
    assert np.mean([learned.usual.knows(r.text) for r in clean]) >= 0.995
    for n in (1, 2, 5):
        starts = [" ".join(r.text.split()[:n]) for r in clean]
        assert np.mean([learned.usual.knows(t) for t in starts]) >= 0.99, n
    assert lang.keep_identified(docs.join(labels.select("doc_id"), "doc_id"), learned).count() >= 0.99 * len(clean)


def test_likelihoods_by_hand():
    """Every row of the table is a distribution; a mean is that of its steps."""
    table = lang._likely([b"abcabcabd", b"xAB1c"])
    p = np.exp(table.astype(float)).reshape(128, 128, 128)
    assert p.sum(axis=2) == pytest.approx(np.ones((128, 128)), abs=1e-3)
    usual = lang.Usual(table, ((4, -1.0),))
    a, b, c, d = (ord(x) for x in "abcd")
    by_hand = np.log([p[a, b, c], p[b, c, d]]).mean()
    for text in (b"aBcD", b"aBcD7f0f", b"9aBcD"):
        assert usual.mean(text) == (pytest.approx(by_hand, abs=1e-4), 2)
    assert p[a, b, c] > p[a, b, d] > p[a, b, ord("x")]
    assert usual.knows("zzz") and usual.knows("zz1zz") and not usual.knows("zzzz")
    assert lang.learn_usual([b"few"] * 10) is None


def test_few_windows_still_say_what_is_usual(spark):
    """A dozen short documents: what no learned text looks like goes, others of the language stay."""
    words = "the old house near river was sold last year to a family from town who wanted garden and quiet street".split()
    texts = [" ".join(words[(i * k + k) % len(words)] for k in range(1, 16)) for i in range(14)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = lang.train(docs.filter("doc_id < 12"), steps=3)
    assert 0 < len({t[: lang.LENGTH] for t in texts}) < 4 * lang.LEAST_HELD
    other = [(100 + i, FOREIGN[k], "en") for i, k in enumerate(("ru", "zh", "pl", "letters"))]
    both = docs.union(spark.createDataFrame(other, docs.schema))
    assert sorted(r.doc_id for r in lang.keep_identified(both, model).collect()) == list(range(14))


def test_every_window_is_counted_and_judged():
    rng = np.random.default_rng(3)
    windows = [bytes(rng.choice(list(b"abcde  "), 96).astype(np.uint8)) for _ in range(41)]
    usual = lang.learn_usual(windows)
    assert (usual.table == lang._likely(windows)).all()
    assert [n for n, _ in usual.limits] == list(lang.LENGTHS)
    assert all(usual.knows(w.decode()) for w in windows) and not usual.knows("XQ;ZJ/" * 20)
    odd = b"xqzjvkwp" * 12
    for at in range(5):  # wherever it stands among the others, it is judged by counts without it
        moved = lang.learn_usual(windows[:at] + [odd] + windows[at:])
        assert all(new < old for (_, new), (_, old) in zip(moved.limits, usual.limits))
    two = lang.learn_usual(windows[:2])
    assert two.limits and all(two.knows(w.decode()) for w in windows)
    assert lang.learn_usual(windows[:1] * 500) is None and lang.learn_usual([b"", *windows[:1]]) is None
