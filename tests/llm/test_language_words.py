"""Listing a text's words gives the same words by every path."""

import regex

from quire.llm import langid

TEXTS = ["", "Plain words, 2 of them_here", "don't", "Übermäßig naïve ŒUVRE", "été ́x", "汉字 kana かな", "İstanbul K"]


def test_words_by_every_path(monkeypatch):
    want = [regex.findall(langid.WORDS, t.lower()) for t in TEXTS]
    assert [list(langid._words(t)) for t in TEXTS] == want
    monkeypatch.setattr(langid, "WHOLE", 0)
    assert [list(langid._words(t)) for t in TEXTS] == want
