"""The encoder's memory: what it keeps, and that it changes no id."""

from __future__ import annotations

import pyarrow as pa

from ordermill.llm import tokens


def plain(encoder, texts):
    return [encoder.tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_parts_asked_for_again_stay_when_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    encoder = tokens.Encoder(tokens.public_path())
    for turn in range(6):
        once = [chr(97 + turn) * n for n in range(2, 24)]
        texts = ["x alpha beta gamma x", "x " + " ".join(once) + " x"]
        ids, counts = encoder.encode(texts)
        assert ids.tolist() == [i for p in plain(encoder, texts) for i in p]
    assert {b" alpha", b" beta", b" gamma"} <= set(encoder.known) and b" aaaa" not in encoder.known


def test_words_of_latin_letters_and_of_all_others():
    encoder = tokens.Encoder(tokens.public_path())
    letters = "".join(chr(c) for c in range(0xA0, 0x600))
    texts = [f"x a{c}b{c} {c} {c}{c}x y" for c in letters] + ["x " + " ".join(letters) + " x", None]
    ids, counts = encoder.encode(pa.array(texts))
    expected = plain(encoder, texts)
    assert counts.tolist() == [len(p) for p in expected] and ids.tolist() == [i for p in expected for i in p]


def test_a_worker_keeps_its_encoder_until_the_file_changes(tmp_path):
    path = tmp_path / "tokenizer.json"
    content = open(tokens.public_path(), encoding="utf-8").read()
    path.write_text(content, encoding="utf-8")
    first = tokens.encoder(str(path))
    assert tokens.encoder(str(path)) is first
    path.write_text(content + "\n", encoding="utf-8")
    assert tokens.encoder(str(path)) is not first
