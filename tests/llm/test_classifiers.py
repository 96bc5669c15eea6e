"""Language identification, quality ranking and quality rules."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from cuadre.llm import langid, ranking, rules, signals
from cuadre.llm.common import learn_fold
from cuadre.llm.queries import op1_quality_classifier, op2_language_id, op10_quality_rules
from tests.llm.tables import EDGE_TEXTS, MIDDLE, SMALL, documents, edge_documents, empty, folder, texts_of

LABELS = "doc_id long, quality int, toxic int"


# language identification


def test_language_accuracy_on_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    held = [r for r in op2_language_id(spark, MIDDLE).collect() if r["held_out"]]
    assert len(held) > 250 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) > 0.96 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held) and sum(r["rejected"] for r in held) < 0.02 * len(held)


def test_language_edge_cases(spark, tmp_path):
    found = op2_language_id(spark, folder(spark, tmp_path, documents=edge_documents(spark))).collect()
    assert len(found) == len(EDGE_TEXTS)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 and by_id[i]["rejected"] for i in (0, 1, 2))
    assert by_id[9]["lang_pred"] in ("de", "en", "fr")


def test_language_without_learning_rows(spark, tmp_path):
    nothing = documents(spark, ["words"]).selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    assert [r["lang_pred"] for r in op2_language_id(spark, folder(spark, tmp_path / "a", documents=nothing)).collect()] == ["und"]
    assert op2_language_id(spark, folder(spark, tmp_path / "b", documents=empty(spark))).count() == 0


def test_held_out_languages_are_not_learned(spark):
    docs = spark.createDataFrame([(i, "wort " * 20, f"l{i}") for i in range(40)], "doc_id long, text string, lang string")
    held = {r[0] for r in docs.where(learn_fold("doc_id", 3) == 1).select("lang").collect()}
    learned = langid.learn(docs.where(learn_fold("doc_id", 3) != 1))
    assert not held & {name for name, _ in learned}


def test_language_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "eine Zeile", "x", 2.0)], "doc_id long, text string, margin string, other double")
    row = langid.identify(docs, [("de", ["eine Zeile und noch eine"]), ("en", ["one line and another"])]).first()
    assert row["lang_pred"] == "de" and row["other"] == 2.0 and isinstance(row["margin"], float)


def test_sample_is_bounded_and_of_all_languages(spark):
    rows = [(f"text {i}", "en") for i in range(50)] + [("texte", "fr"), ("texte", "fr"), (None, "fr")]
    found = langid.learning_sample(spark.createDataFrame(rows, "text string, lang string"), rows=10).collect()
    assert Counter(r["lang"] for r in found) == {"en": 10, "fr": 1}
    assert {r["total"] for r in found if r["lang"] == "fr"} == {2}


# quality ranking


def auc(scores, good):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    n = good.sum()
    return (ranks[good].sum() - n * (n + 1) / 2) / (n * (len(good) - n))


def test_quality_on_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    found = op1_quality_classifier(spark, MIDDLE).collect()
    assert len(found) == 1000 and all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    good = np.array([labels[r["doc_id"]] == 1 for r in held])
    assert auc(np.array([r["score"] for r in held]), good) > 0.95
    assert np.mean([(r["predicted"] == 1) == g for r, g in zip(held, good)]) > 0.95


def test_quality_edge_cases(spark, tmp_path):
    labels = spark.createDataFrame([(3, 0, 0), (4, 1, 0), (4, None, 0), (5, 1, 1), (5, 0, 0), (None, 1, 0)], LABELS)
    docs = edge_documents(spark)
    found = op1_quality_classifier(spark, folder(spark, tmp_path / "a", documents=docs, labels=labels)).collect()
    assert len(found) == len(EDGE_TEXTS) and len({r["score"] for r in found if r["doc_id"] == 5}) == 1
    assert all(0 <= r["score"] <= 1 for r in found)
    none = op1_quality_classifier(spark, folder(spark, tmp_path / "b", documents=docs, labels=empty(spark, LABELS)))
    assert {round(r["score"], 9) for r in none.collect()} == {0.3}
    assert op1_quality_classifier(spark, folder(spark, tmp_path / "c", documents=empty(spark), labels=labels)).count() == 0


def test_pairs_are_learned():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(500, ranking.features(np.zeros((1, len(signals.NAMES)))).shape[1]))
    good = x[:, 2] + 0.1 * draw.normal(size=500) > -1
    model = ranking.fit(x, good, float((~good).mean()))
    assert np.argmax(np.abs(model.weights)) == 2 and auc(model.scores(x), good) > 0.97
    assert abs((model.scores(x) < ranking.CUT_SCORE).mean() - (~good).mean()) < 0.01  # the quantile


def test_every_pair_counts(spark):
    """At the learned weights the loss over all pairs of a good and a bad document is flat; it is not for a draw of pairs."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(600, ranking.features(np.zeros((1, len(signals.NAMES)))).shape[1]))
    good = x[:, 1] - x[:, 4] + draw.normal(size=600) > -0.5
    model = ranking.fit(x, good, float((~good).mean()))
    z = (x - model.mean) / model.scale
    strength = z @ model.weights
    lost = 1 / (1 + np.exp(strength[good][:, None] - strength[~good][None]))
    gradient = (z[~good] * lost.sum(axis=0)[:, None]).sum(axis=0) - (z[good] * lost.sum(axis=1)[:, None]).sum(axis=0)
    assert np.abs(gradient / lost.size + ranking.RIDGE * model.weights).max() < 1e-5


def test_every_labelled_document_is_learned_from(spark):
    """More documents of a class than 8,000, to which learning was once limited: the model is that of all of them."""
    draw = random.Random(5)
    texts = [" ".join(draw.choice(["word", "WORD", "a1", "x|", "!"]) for _ in range(draw.randrange(1, 9))) for _ in range(9_500)]
    quality = [int(draw.random() < 0.95 ** text.count("WORD") - 0.01) for text in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, 0) for i, q in enumerate(quality)], LABELS)
    found = ranking.learn(docs, labels)
    x = ranking.features(np.array([signals.signals(text.encode()) for text in texts], dtype=float))
    good = np.array(quality, dtype=bool)
    assert good.sum() > 8_000
    whole = ranking.fit(x, good, float((~good).mean()))
    assert np.allclose(found.mean, x.mean(axis=0)) and np.allclose(found.weights, whole.weights, atol=1e-4)
    assert abs(found.cut - whole.cut) < 1e-3


# quality rules


def counts_by_hand(text):
    words = (text or "").encode().split()
    text = "" if text is None else text
    white = " \t\n\v\f\r"
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if line.strip(white)]
    return (
        len(words), sum(c not in white for c in text), sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(covered),
    )


def test_signals_against_counting():
    draw = random.Random(6)
    texts = ["", " ", "a a a a", "a b c a b c", "é é é é x y\x1cz", "l\nl\n\nl \n l\n\n"]
    texts += [" ".join(draw.choice("ab#é") for _ in range(draw.randrange(40))) + "\n" * draw.randrange(3) for _ in range(80)]
    for text in texts:
        found = signals.signals(text.encode())[:5]
        assert found == (counts_by_hand(text) if text.encode().split() else (0, 0, 0, 0, 0)), text


def test_rules_on_documents(spark):
    texts = texts_of(spark, SMALL)
    for r in op10_quality_rules(spark, SMALL).collect():
        want = counts_by_hand(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["failed_rules"] == "")


def test_rules_edge_cases(spark, tmp_path):
    labels = spark.createDataFrame([(3, 0, 0), (4, 1, 0), (4, None, 0), (None, 1, 0)], LABELS)
    found = op10_quality_rules(spark, folder(spark, tmp_path / "a", documents=edge_documents(spark), labels=labels)).collect()
    assert len(found) == len(EDGE_TEXTS)
    for r in found:
        text = next(t for i, t, _ in EDGE_TEXTS if i == r["doc_id"])
        assert r["n_words"] == counts_by_hand(text)[0] and r["kept"] is False
    nothing = folder(spark, tmp_path / "b", documents=empty(spark), labels=empty(spark, LABELS))
    assert op10_quality_rules(spark, nothing).count() == 0


@pytest.mark.parametrize("n,p", [(1, 0.5), (30, 0.02), (400, 0.02), (5000, 0.01)])
def test_binomial_tail_is_exact(n, p):
    total = 0.0
    for k in range(min(n, 120) + 1):
        total += math.exp(
            math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
        )
        assert rules.binomial_tail(k, n, p) == pytest.approx(min(total, 1.0), rel=1e-8, abs=1e-12)


def test_cutoffs_keep_the_risk_in_every_stratum():
    """Good documents whose ratio exceeds a permitted cutoff are at most a share of RISK, but for ERROR of the draws."""
    draw = np.random.default_rng(8)
    broken = 0
    for _ in range(60):
        counts, truth = [], {}
        for stratum, spread in (("a", 12.0), ("b", 40.0), ("few", 12.0)):
            good = draw.beta(1, spread, 20 if stratum == "few" else 900)
            bad = draw.beta(4, 4, 300)
            truth[stratum] = lambda cut, s=spread: (1 - cut) ** s
            for values, is_good in ((good, True), (bad, False)):
                for step, n in Counter((np.ceil(values * rules.STEPS) - 1).astype(int).tolist()).items():
                    counts += [(stratum, rule, step, n * is_good, n * (not is_good)) for rule in rules.RULES]
        chosen = rules.choose_cutoffs(counts, rules.RISK, rules.ERROR)
        assert ("few", "symbols") not in chosen and (rules.POOLED, "symbols") in chosen
        assert chosen["b", "symbols"] is not None
        for (stratum, _), cut in chosen.items():
            if stratum is not rules.POOLED and cut is not None:
                broken += truth[stratum](cut) > rules.RISK / len(rules.RULES)
    assert broken <= 60 * 15 * 0.05


def test_rules_have_ratios(spark):
    assert tuple(rules.ratios()) == rules.RULES


def test_a_rule_without_bad_documents_is_off():
    counts = [("a", rule, -1, 5000, 0) for rule in rules.RULES]
    assert set(rules.choose_cutoffs(counts, rules.RISK, rules.ERROR).values()) == {None}


def test_one_long_text_does_not_fill_a_dictionary(spark):
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(60_000))
    texts = [long, *(long[k:] for k in (7_000, 9_000)), "some short text", *(f"text {'abcdefgh'[k]} alone" for k in range(8))]
    given = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    [(name, found)] = langid.learn(given)
    sizes = sorted(len(t.encode()) for t in found)
    short = [len(langid.words_only(t)) for t in texts[3:]]
    assert name == "en" and sizes[:9] == sorted(short) and sum(sizes) <= langid.DICTIONARY_BYTES < sum(sizes) + 16
    assert sizes[-1] == sizes[-3]  # the long ones share the rest
    [(_, alone)] = langid.learn(given.limit(1))
    assert len(alone[0]) == langid.DICTIONARY_BYTES


def test_sample_of_a_language_is_the_least_by_hash(spark):
    """Of many texts, copies among them, those with the least hashes."""
    rows = [(f"text {i % 5000}", "en" if i % 3 else "de") for i in range(9000)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    found = langid.learning_sample(docs, rows=50).collect()
    hashed = docs.distinct().selectExpr("lang", "xxhash64(text) AS hash").collect()
    for lang in ("en", "de"):
        least = sorted(r["hash"] for r in hashed if r["lang"] == lang)[:50]
        assert sorted(r["hash"] for r in found if r["lang"] == lang) == least
        assert {r["total"] for r in found if r["lang"] == lang} == {sum(x == lang for _, x in rows)}
