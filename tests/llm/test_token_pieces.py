"""Texts cut into pieces for the tokenizer, against the ids of whole texts."""

from __future__ import annotations

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from orderflow.llm import queries, tokenfiles


def test_wide_spaces_and_marks_are_cut_as_the_tokenizer_does(monkeypatch, tmp_path):
    monkeypatch.setattr(tokenfiles, "_REMEMBERED", 300)
    path, rng = queries.tokenizer_path(), random.Random(2)
    library, coder = Tokenizer.from_file(path), tokenfiles.Encoder(path)
    letters = ["ab", "é", "ß", "×", "÷", "e\u0301", "の", "7", " ", " ", "\n", "\r", ".", "...", "'s", "'", "-", "<|endoftext|>", "<|end"]
    letters += ["\x1f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "…"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    want = [w.ids for w in library.encode_batch(texts, add_special_tokens=False)]
    for begin in range(0, len(texts), 500):
        part = pa.array([None, *texts[begin : begin + 500]])[1:]
        tokens, ends = coder.tokens(part)
        assert [x.tolist() for x in np.split(tokens, ends[:-1])] == want[begin : begin + 500]
    assert coder.encode([]) == [] and coder.encode(["", ""]) == [b"", b""]
    # Files end with the document that reaches their size, wherever portions end.
    monkeypatch.setattr(tokenfiles, "_TOGETHER", 1000)
    rows = [{"id": i, "text": t} for i, t in enumerate(texts)]
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    found = [r for b in tokenfiles._writer(str(tmp_path), path, 0, 5000)([pa.RecordBatch.from_pylist(rows)]) for r in b.to_pylist()]
    sizes, files = [len(w) + 1 for w in want], []
    for i, size in enumerate(sizes):
        if not files or files[-1]["n_tokens"] >= 5000:
            files.append({"file": f"part-000000-{len(files):06d}.dac", "first_id": i, "n_documents": 0, "n_tokens": 0})
        files[-1]["n_documents"] += 1
        files[-1]["n_tokens"] += size
    assert found == files and len(files) > 3


def test_words_next_to_marks_and_in_lines_are_encoded_once():
    coder = tokenfiles.Encoder(queries.tokenizer_path())
    library, asked = coder.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **options)

    coder.tokenizer = Counting()
    words = [f"{a}{b}word" for a in "abcdefé" for b in "ghijkl"]
    texts = [f"{a}{mark}{b}\n{a}, {b}" for a in words for b in words for mark in (".", "/", "--")]
    want = library.encode_batch(texts, add_special_tokens=False)
    assert coder.encode(texts) == [np.array(w.ids, "<u4").tobytes() for w in want]
    # Each word alone, behind each mark and behind a space; the heads of texts are pieces as others are.
    assert sum(map(len, asked)) < 10 * sum(map(len, words))
