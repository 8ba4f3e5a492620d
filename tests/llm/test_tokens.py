"""Ids of whole texts against the library's, while the encoder forgets and learns chunks."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq

from tidemark.llm import tokens

ODD = ["", "a", "A.b", "é", "́x y", "o'll 's x's", "<|endoftext|> a", "naïve. ÄÖ ß.", "a b", None, "x" * 300, "12a3 ?!", "ſtraße K ①"]


def _same(texts) -> None:
    encoder = tokens.Encoder(tokens.VOCABULARY)
    got = 0
    for first, ids, offsets in encoder.documents(pa.array(texts, pa.string()), 2):
        for i in range(len(offsets) - 1):
            want = encoder.model.encode(texts[first + i] or "", add_special_tokens=False).ids
            assert ids[offsets[i] : offsets[i + 1]].tolist() == [*want, 2], texts[first + i]
            got += 1
    assert got == len(texts)


def test_odd_texts():
    _same(ODD)


def test_chunks_are_forgotten_and_learned_again(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 300)
    monkeypatch.setattr(tokens, "ENCODED_BYTES", 4_000)
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])
    _same([t for t in table.column("text").to_pylist() if len(t or "") < 5_000] + ODD)


def test_what_most_slices_had_is_kept(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 8)
    encoder = tokens.Encoder(tokens.VOCABULARY)
    for k in range(6):
        encoder.encode(pa.array([f"often usual only{k}x once{k}y rare{k}z"]))
    assert {"often", "usual"} <= set(encoder.place) and "once0y" not in encoder.place
    encoder._forget()
    assert len(encoder.place) <= 4 and encoder.known == len(encoder.place)


def test_latin_words_go_to_the_model_at_once(monkeypatch):
    letters = [chr(c) for c in range(0x41, 0x180) if chr(c).isalpha()]
    words = [a + b + c for a, b, c in zip(letters * 3, letters[7:] + letters * 2, letters[40:] + letters * 2)]
    _same([" ".join(words), *words])
    encoder = tokens.Encoder(tokens.VOCABULARY)
    seen = []

    class Watched:
        model = encoder.model.model

        def encode(self, chunks, **kinds):
            seen.extend(chunks)
            return library.encode(chunks, **kinds)

    library, encoder.model = encoder.model, Watched()
    encoder.encode(pa.array(["été Straße maçã ǆo x1 ab,"]))
    assert sorted(seen) == sorted([",", "x1", "ǆo"])


def test_any_mark_after_a_letter_is_a_chunk_of_its_own():
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    _same([f"été{m}{m} a{m}b x{m}'s {m}c{n}d é{m}̸ 1{m}" for m, n in zip(marks, marks[5:] + marks)])
    encoder = tokens.Encoder(tokens.VOCABULARY)
    encoder.encode(pa.array(["Maß### maß$$$ maß"]))
    assert set(encoder.place) == {"maß", "###", "$$$"}
