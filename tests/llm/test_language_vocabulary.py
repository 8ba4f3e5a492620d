"""The language model's vocabulary: every language has its share."""

from __future__ import annotations

import numpy as np

from tidemark.llm import language


def test_a_large_language_does_not_crowd_out_a_small_one(spark):
    large = [(i, f"gross{chr(97 + i % 20)}{chr(97 + i // 20)} " * 50, "de") for i in range(200)]
    small = [(1000, "petit mot rare", "fr"), (1001, "petit autre", "fr")]
    model = language.train(spark.createDataFrame(large + small, "doc_id long, text string, lang string"), words=60, grams=200)
    assert {"petit", "mot", "rare", "autre"} <= set(model.words)
    assert len(model.words) <= 70 and len([w for w in model.words if w.startswith("gross")]) >= 40
    assert any(g in model.grams for g in (" peti", "petit", "autre"))


def test_cutoffs_share_the_room():
    found = language._cutoffs({"a": {5: 10, 1: 100}, "b": {2: 3}}, 30)
    assert found["b"] == (2, 0.0) and found["a"] == (2, 0.17)


def _plain(model, word):
    """Evidence of an unseen word, place by place: its languages' rows, and whether its letters are no chance."""
    edged, rows = f" {word} ", []
    covered = [False] * len(edged)
    for i in range(len(edged)):
        for k in range(min(language.LONGEST_GRAM, len(edged) - i), 0, -1):
            if edged[i : i + k] in model.grams:
                rows.append(model.logs[model.grams[edged[i : i + k]]])
                covered[i : i + k] = [k >= language.EVIDENCE_GRAM or c for c in covered[i : i + k]]
                break
    total = np.zeros(len(model.languages), np.float32)
    for row in rows:
        total = total + row
    return [*(total / np.float32(max(1, len(rows)))), 2 * sum(covered[1:-1]) > len(word)]


def test_evidence_of_many_words_at_once():
    grams = sorted({" ", "a", "b", "ab", "abc", "abca", "abcab", " abca", "bcab ", "🙂", "é", "éa", "cabca"})
    counts = np.arange(2 * len(grams), dtype=float).reshape(-1, 2) % 7 + 1
    model = language.WordFirst({"x": 40, "y": 30}, (["abc", "de"], np.array([[3.0, 1.0], [1.0, 4.0]])), (grams, counts))
    words = ["abc", "abcabc", "zz", "", "éab🙂", "de", "bcab", "zabcazz", "abcabcabcabcabcabc", "b"]
    found = model.evidence(words)
    for word, row in zip(words, found):
        want = [*model.logs[model.words[word]], 1] if word in model.words else _plain(model, word)
        assert row.tolist() == [float(x) for x in want], word
    assert model.evidence([]).shape == (0, 3)


def test_a_model_without_grams_has_no_evidence():
    none = ([], np.zeros((0, 1)))
    model = language.WordFirst({"x": 1}, (["abc"], np.ones((1, 1))), none)
    assert model.evidence(["zz"]).tolist() == [[0.0, 0.0]]
