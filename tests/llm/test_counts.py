"""Token counts, spelling variants and phrases against brute force."""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import phrases, queries, spellings, tokencounts

SCHEMA = "doc_id long, text string, lang string, n_tokens string, `Rank` string, word string, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "n", "r", "w", 7) for i, t, g in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# --- token counts ----------------------------------------------------------------

LETTERS = ["a", "b", "the", " ", "  ", "\n", "\t", " ", "\x1c", "\x85", "é", "É", "1", "23", ".", ",", "'s", "'", "<|endoftext|>", "<|startoftext|>", "</w>", "漢", "😀", "֊", "ೝ", "▁", "é", "<s>"]


def odd_texts(n=300, seed=1):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(24))) for _ in range(n)]
    return [None, "", " ", *texts, "word " * 3000, "<|endoftext|>" * 3, texts[5], texts[5]]


@functools.cache
def library(name):
    """The count of a tokenizer that nothing here has touched."""
    path = queries.tokenizer_path(name)
    if name.endswith(".model"):
        import sentencepiece

        return lambda text, model=sentencepiece.SentencePieceProcessor(model_file=path): len(model.encode(text))
    from tokenizers import Tokenizer

    return lambda text, coder=Tokenizer.from_file(path): len(coder.encode(text, add_special_tokens=False).ids)


def library_count(name, text):
    return library(name)(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, name):
    rows = [(None if i == 4 else i // 2, t, "en") for i, t in enumerate(odd_texts())]
    found = tokencounts.count_tokens(frame(spark, rows).repartition(3), queries.tokenizer_path(name))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens"]
    want = Counter()
    for d, t, _ in rows:
        want[d, len((t or "").encode()), library_count(name, t or "")] += 1
    assert Counter(map(tuple, found.collect())) == want


def test_a_document_may_pass_a_block(spark, empty):
    rng = random.Random(2)
    texts = [" ".join(str(rng.randrange(10**6)) for _ in range(n)) for n in (40, 60_000, 5)]
    path = queries.tokenizer_path()
    blocks = list(tokencounts.slices(texts[1]))
    assert "".join(blocks) == texts[1]
    docs = frame(spark, [(i, t, None) for i, t in enumerate(texts)]).repartition(1)
    small = {"WORDS": 300, "ENTRIES": 500, "SLICE": 2000}

    def limited(batches):  # the limits hold in the workers, not here
        for name, value in small.items():
            setattr(tokencounts, name, value)
        yield from tokencounts._survey(path)(batches)

    rows = docs.select(F.col("doc_id").alias("key"), "text")
    schema = "block long, keys array<long>, rows array<long>, n_bytes array<long>, extra array<long>, sizes array<int>, at binary, freq binary, words array<string>"
    parts = rows.mapInArrow(limited, schema).collect()
    assert len(parts) > 20 and max(len(p.words) for p in parts) < 2500
    assert {n for p in parts for n in p.rows} == {0, 1, 2}
    assert sum(b for p in parts for b in p.n_bytes) == sum(map(len, texts))
    found = {r.doc_id: r.n_tokens for r in tokencounts.count_tokens(docs, path).collect()}
    assert found == {i: library_count("byte_bpe_50k.json", t) for i, t in enumerate(texts)}
    assert tokencounts.count_tokens(empty, path).collect() == []


# --- spelling variants -----------------------------------------------------------

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows):
    counts = Counter()
    for d, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOW)
            mark = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if mark % 199 == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out, key=str)


def variant_rows(seed=5):
    """Words around a few stems, frequencies over several powers of five, runs of equal letters, ties."""
    rng = random.Random(seed)
    stems = ["boookkeep", "colour", "Übergröße", "aaaaaaa", "letter"]
    said = []
    for stem in stems:
        said += [stem] * 700
        for _ in range(12):
            w = list(stem)
            for _ in range(rng.randrange(1, 3)):
                at, kind = rng.randrange(len(w)), rng.randrange(3)
                w[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice("abelorÿ×")]
            said += ["".join(w)] * rng.choice([5, 5, 6, 26, 130])
    rng.shuffle(said)
    rows = [(i if i % 9 else None, " ".join(said[i * 40 : i * 40 + 40]), None) for i in range(len(said) // 40 + 1)]
    return [*rows, (3, None, None), (4, "", "x"), (5, "Straße漢colour_colour5Colour", "x"), rows[2]]


def test_variants_equal_brute_force(spark, empty):
    rows = variant_rows()
    want = brute_variants(brute_words(rows))
    found = spellings.variants(frame(spark, rows).repartition(4)).collect()
    assert sorted(map(tuple, found), key=str) == want
    assert sum(r.form is not None for r in found) > 20 and any(r.root not in (r.word, r.form) for r in found)
    assert spellings.variants(empty).collect() == []


def test_every_near_pair_meets_in_one_range():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(6, 9))) for _ in range(200)})
    ranges = defaultdict(list)
    for w in words:
        for i in range(len(w)):
            ranges[w[i + 1 :] + "$" + w[:i]].append((w, w[i], i == 0 or w[i] != w[i - 1]))
        for i in range(len(w) + 1):
            ranges[w[i:] + "$" + w[:i]].append((w, None, False))
    learned = Counter()
    for members in ranges.values():
        out = []
        spellings._of_range([m[0] for m in members], [5] * len(members), [m[1] for m in members], [m[2] for m in members], out)
        for word, near, _, _ in out:
            learned[word] += near
    assert {w: learned[w] for w in words} == {w: sum(is_near(w, x) for x in words) for w in words}


# --- phrases -----------------------------------------------------------------------


def brute_phrases(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(_LOW)):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 6):
                    if i + k <= len(w):
                        counts[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = defaultdict(int)
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        covered[p[i:j]] = max(covered[p[i:j]], a)
        scored = []
        for p, a in found.items():
            if covered[p] >= a:
                continue
            n = totals[lang]
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(seed=11):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "a", "a\x01", "new", "york", "city", "über", "\x85", "漢", "-"]
    rows = []
    for i in range(120):
        said = []
        for _ in range(rng.randrange(1, 60)):
            said.append(rng.choice(["new york city", "of the", *vocabulary]))
            said.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\x0b", "! "]))
        rows.append((i, "".join(said), ["en", "de", None][i % 3]))
    same = "this line stands in many documents of them all"
    rows += [(200 + i, f"{same} {same}", "en") for i in range(30)]
    return [*rows, (1, None, "en"), (2, "", None), (None, " . , ", "fr"), rows[0], rows[0]]


@pytest.mark.parametrize(("block", "size"), [(2_000_000, 2_000_000), (40, 300), (7, 64)])
def test_phrases_equal_brute_force(spark, block, size):
    rows = phrase_rows()
    found = phrases.collocations(frame(spark, rows).repartition(3), least=12, top=40, block=block, size=size)
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, 12, 40)


def test_no_phrases(spark, empty):
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(frame(spark, phrase_rows()[:3])).collect() == []


def test_a_text_may_pass_a_slice(spark, monkeypatch):
    data = "One two, Three\tfour five. ".encode() * 50
    want = [w for part in phrases._words(data) for w in part]
    monkeypatch.setattr(phrases, "SLICE", 7)
    parts = list(phrases._words(data))
    assert [w for part in parts for w in part] == want and len(parts) > 50
    rows = [(1, "x y " * 4000, None)]
    found = phrases.collocations(frame(spark, rows), least=12, top=40, block=100, size=64).collect()
    assert sorted(map(tuple, found)) == brute_phrases(rows, 12, 40)


def test_transducers_give_back_what_they_count():
    rng = np.random.default_rng(3)
    numbers = rng.integers(0, 5, 3000).astype("<u4")
    rows, counts = phrases.windows(numbers, 2990)
    assert (phrases.summed(rows, counts)[0] == rows).all()
    back = phrases.summed(*phrases.paths(phrases.built(rows, counts), "<u4"))
    assert (back[0] == rows).all() and (back[1] == counts).all()
    wide = phrases.paths(phrases.built(rows.astype("<u8"), counts), "<u8")
    assert wide[0].dtype == np.uint64 and wide[1].sum() == counts.sum()
    one, other = (phrases.windows(numbers[a:b], b - a) for a, b in ((0, 1700), (1700, 3000)))
    united = phrases.summed(np.concatenate([one[0], other[0]]), np.concatenate([one[1], other[1]]))
    assert united[1].sum() == (numbers > 0).sum()
    ends = rows[[100, 600]]
    part = phrases._ranges(rows, ends)
    assert (part[:100] == 0).all() and (part[100:600] == 1).all() and (part[600:] == 2).all()
