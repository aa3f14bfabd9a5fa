"""Every operator against a brute-force version or an exact round trip, on rows that are hard."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from compare import differences, duck
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderflow.llm import (
    chat,
    decontamination,
    htmltext,
    mixing,
    neardup,
    quality,
    queries,
    sharding,
    substrings,
    tokenfiles,
    toxicity,
)
from orderflow.llm.common import recorded, release, stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, `Size` string"


def _sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "tree", "river", "stone", "cloud", "über", "été"]) + str(rng.randrange(60)) for _ in range(n))


def hard_rows(seed=3):
    rng = random.Random(seed)
    base = _sentence(rng, 130)
    words = base.split()
    passage = _sentence(rng, 70)
    texts = [None, "", " \n\t ", "one", "Two words", base, base, base.upper(), base.replace(" ", "\n")]
    for _ in range(8):
        edited = list(words)
        for _ in range(3):
            edited[rng.randrange(len(edited))] = f"x{rng.randrange(99)}"
        texts.append(" ".join(edited))
    texts += [f"{_sentence(rng, 20)} {passage} {_sentence(rng, 15)}" for _ in range(4)]
    texts += ["same " * 80, "same " * 120, _sentence(rng, 4000), "a b   c"]
    rows = [(i * 7, t, "en", [None, "a", "b", "é"][i % 4], 0, "r", "s") for i, t in enumerate(texts)]
    return [*rows, rows[5], (None, base, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def low(doc_id):
    return -1 if doc_id is None else doc_id


# --- substrings ----------------------------------------------------------------


def brute_substrings(rows, window):
    least = {}
    for r in rows:
        w = words(r[1])
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, 1 << 62), low(r[0]))
    out = []
    for r in rows:
        w = words(r[1])
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < low(r[0]):
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((low(r[0]), len(w), len(gone), kept))
    return sorted(out)


@pytest.mark.parametrize("limit", [16384, 2])
def test_substrings_equal_brute_force(docs, limit):
    found = substrings.remove_repeats(docs, window=20, prefix=10, tree_stretches=limit).collect()
    assert sorted((low(r[0]), *r[1:]) for r in found) == brute_substrings(hard_rows(), 20)


# --- near duplicates -------------------------------------------------------------


def brute_components(rows, size):
    sets, top = {}, {}
    for r in rows:
        w = words((r[1] or "").encode().lower().decode())
        runs = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        sets[low(r[0])] = runs
        top[low(r[0])] = low(r[0])

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("join", [neardup.Join(), neardup.Join(small=2, depth=2, ring=1, cell=4), neardup.Join(shingle=5)])
def test_near_duplicates_equal_brute_force(docs, join):
    want = brute_components(hard_rows(), join.shingle)
    found = neardup.near_duplicates(docs, join=join).collect()
    assert len(found) == len(hard_rows())
    for r in found:
        assert (r.n_shingles, low(r.component_id)) == want[low(r.doc_id)]
        assert r.kept == (low(r.doc_id) == low(r.component_id))


def test_keep_first_keeps_columns(docs):
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.text is None or not r.text.strip()} == {0, 7, 14}


def test_near_duplicates_of_an_id_with_several_texts(spark):
    rng = random.Random(31)
    a, b, c = (_sentence(rng, 120) for _ in range(3))
    near = f"{b} changed"
    rows = [(None, a), (None, b), (6, b), (7, near), (5, c), (5, f"{a} more"), (9, c), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = neardup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in found) == Counter(
        [(None, None, True)] * 2 + [(6, None, False), (7, None, False), (5, 5, True), (5, None, False), (9, 5, False)]
        + [(8, 8, True)] * 2
    )


def test_one_row_of_a_component_stays(spark):
    rng = random.Random(32)
    a, b, c = (_sentence(rng, 120) for _ in range(3))
    rows = [(None, a, "x"), (None, a, "y"), (None, f"{a} more", "x"), (None, b, "x"), (5, c, "x"), (5, c, "x")]
    rows += [(5, f"{b} more", "x"), (6, c, "x"), (7, None, "x"), (7, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = [(r.doc_id, r.text) for r in neardup.keep_first(docs).collect()]
    assert Counter(t is None or t[:20] for _, t in kept) == Counter([a[:20], b[:20], c[:20], True])
    assert Counter(d for d, _ in kept) == Counter({None: 2, 5: 1, 7: 1})


# --- decontamination ----------------------------------------------------------


def test_leaks_are_found_and_clean_documents_left(spark):
    rng = random.Random(9)
    items = [(i, _sentence(rng, n)) for i, n in enumerate((15, 40, 57, 3, 30))] + [(98, ""), (99, None)]
    near = items[1][1].split()
    near[3] = "changed"
    rows = [
        (1, f"{_sentence(rng, 50)}, {items[0][1].upper()}! {_sentence(rng, 30)}"),
        (2, " ".join(near)),
        (3, _sentence(rng, 300)),
        (4, None),
        (5, ""),
        (6, f"{_sentence(rng, 3000)} {items[2][1]} {_sentence(rng, 9000)}"),
        (7, " ".join(items[4][1].split()[:10])),
        (6, f"{items[2][1]}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def brute(text):
        spoken, hits = decontamination.words(text), set()
        for item, wanted in items:
            target = decontamination.words(wanted)
            m, k = len(target), min(5, len(target))

            def runs(w, k=k):
                return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

            for i in range(len(spoken) - m + 1) if m else ():
                if decontamination.similarity(runs(spoken[i : i + m]), runs(target)) >= 0.8:
                    hits.add(item)
        return hits

    want = sorted((d, i) for d, t in rows for i in brute(t))
    for block_words in (500_000, 30):
        found = decontamination.matches(docs, bench, block_words=block_words).collect()
        assert sorted((r.doc_id, r.item_id) for r in found) == want
    kept = decontamination.remove_contaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, t in rows if not brute(t)}


def test_documents_shorter_than_an_item_are_compared(spark):
    rng = random.Random(10)
    items = [(i, _sentence(rng, n)) for i, n in enumerate((15, 40, 40, 5))]
    texts = [" ".join(items[0][1].split()[:14]), " ".join(items[1][1].split()[5:]), " ".join(items[2][1].split()[:30]), " ".join(items[3][1].split()[:4])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = [(r.doc_id, r.item_id, r.start_word, r.n_words) for r in decontamination.matches(docs, bench).collect()]
    assert sorted(found) == [(0, 0, 0, 14), (1, 1, 0, 35)]
    assert {r.doc_id for r in decontamination.remove_contaminated(docs, bench).collect()} == {2, 3}


def test_blocks_hold_every_fingerprint_within_the_radius():
    index = decontamination.Index([(i, _sentence(random.Random(i), 12)) for i in range(40)])
    (_, _, _, _, prints, filed) = index.groups[0]
    rng = np.random.default_rng(1)
    for j, p in enumerate(prints):
        bits = np.unpackbits(p)
        bits[rng.choice(128, decontamination.RADIUS, replace=False)] ^= 1
        mark = np.packbits(bits)
        assert any(j in filed[b][v] for b, v in enumerate(mark.tolist()))


# --- token files -----------------------------------------------------------------


def test_token_files_round_trip(docs, empty):
    path = queries.tokenizer_path()
    coder = Tokenizer.from_file(path)
    want, start = [], 0
    for r in sorted(hard_rows(), key=lambda r: (low(r[0]), r[1] or "")):
        ids = [*coder.encode(r[1] or "", add_special_tokens=False).ids, 0]
        want.append((low(r[0]), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = tokenfiles.round_trip(docs, path).collect()
    assert sorted((low(r[0]), *r[1:]) for r in found) == sorted(want)
    assert tokenfiles.round_trip(empty, path).collect() == []


def test_pieces_give_the_ids_of_the_whole_text(monkeypatch):
    monkeypatch.setattr(tokenfiles, "_REMEMBERED", 2000)  # pieces are forgotten and learned again
    coder, rng = tokenfiles.Encoder(queries.tokenizer_path()), random.Random(1)
    letters = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "1", ".", ",", "$&", "'s", "'", "<|endoftext|>", "漢", "😀"]
    lines = ["a", "Bé", " ", " ", "\n", "\r\n", ",", ".", "$", "'ll", "1"]
    library = Tokenizer.from_file(queries.tokenizer_path())
    for chosen in (letters, lines) * 4:
        texts = ["".join(rng.choice(chosen) for _ in range(rng.randrange(24))) for _ in range(1500)]
        want = library.encode_batch(texts, add_special_tokens=False)
        assert coder.encode(texts) == [np.array(w.ids, "<u4").tobytes() for w in want]


def test_any_token_is_read_directly():
    rng = np.random.default_rng(2)
    tokens = (rng.integers(0, 2**32, 5000, dtype=np.uint64) >> rng.integers(0, 31, 5000).astype(np.uint64)).astype(np.uint32)
    held = tokenfiles.TokenFile(tokenfiles.encode_file([5], np.array([0]), tokens))
    assert [held.token(i) for i in range(5000)] == tokens.tolist()
    for a in range(0, 5000, 97):
        assert (held.tokens(a, min(a + 700, 5000)) == tokens[a : a + 700]).all()


# --- quality -----------------------------------------------------------------------


def test_quality_statistics_equal_brute_force(docs):
    found = quality.statistics_and_verdict(docs, "doc_id").select("key", "s.*", "base_failed", "kept").collect()
    got = sorted((low(r.key), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    want = []
    for r in hard_rows():
        text = r[1] or ""
        w = [x.decode() for x in words(text)]
        runs = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if words(x)]
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        want.append((low(r[0]), len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed))
    assert got == sorted(want)
    assert not any(r.kept and r.base_failed for r in found)


def test_votes_are_weighed_by_how_well_rules_agree():
    clean, junk = [1] * 8, [-1] + [1] * 7
    model = quality.fit_votes([(clean, 900), (junk, 60), ([-1, -1] + [1] * 6, 40)], 8)
    assert model.log_odds(clean) > 0 > model.log_odds(junk)


def test_junk_goes_and_columns_stay(docs, empty):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert quality.keep_good(empty).collect() == []


# --- mixing and sharding -----------------------------------------------------------


def test_mix_meets_targets_and_limits(docs, empty):
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == len(hard_rows())
    assert all(0 <= r.copies <= 3 for r in mixed)
    assert sum({r.row.source: r.target for r in mixed}.values()) == pytest.approx(sum(r.size for r in mixed))
    again = {(r.row.doc_id, r.row.text): r.copies for r in mixing.mix(docs.repartition(5)).collect()}
    assert {(r.row.doc_id, r.row.text): r.copies for r in mixed}.keys() == again.keys()
    assert mixing.emit(mixing.mix(docs)).columns == docs.columns
    assert mixing.mix(empty).collect() == []


def test_taken_words_come_near_the_target(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("aaaabc"), rng.randrange(1, 400)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, words long")
    mixed = mixing.mix(df, text=None, size=F.col("row.words"), block_rows=500)
    for r in mixed.groupBy("row.source").agg(F.sum(F.expr("copies * size")).alias("n"), F.first("target").alias("t")).collect():
        assert abs(r.n - r.t) < 0.02 * r.t


def test_texts_of_one_cell_are_dealt_over_tasks(spark):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        docs = spark.range(2000).selectExpr("id as doc_id", "'a' as source", "'one size of all' as text")
        rows = mixing.mix(docs).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset(setting)
    assert len(rows) == 2000 and len({r.size for r in rows}) == 1
    assert max(Counter(r.task for r in rows).values()) < 1000


def test_mix_takes_repeated_and_null_keys_evenly(spark):
    rows = [(i % 3 or None, "ab"[i % 2], i, 5 if i % 7 else 9) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, place long, words long")
    mixed = mixing.mix(df, text=None, size=F.col("row.words")).collect()
    assert sorted(r.row.place for r in mixed) == list(range(600))
    assert all(r.row.words == r.size for r in mixed)
    for source in "ab":
        own = [r for r in mixed if r.row.source == source]
        rate = own[0].target / own[0].source_size
        assert {r.copies for r in own} <= {int(rate), int(rate) + 1}
        assert abs(sum(r.copies for r in own) - rate * len(own)) < 1.001


def test_shards_are_exact_and_random(docs, empty):
    found = sharding.shard_rows(docs, shards=4).collect()
    counts = Counter(r["shard"] for r in found)
    assert len(found) == len(hard_rows()) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in found if r["shard"] == shard) == list(range(n))
    for r in found:
        data = (r.row.text or "").encode()
        assert (r["size"], r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert sharding.shard_rows(empty).collect() == []


def test_hypergeometric_draws_follow_the_law():
    rng = random.Random(1)
    draws = [sharding.hypergeometric(rng, 30, 70, 20) for _ in range(20_000)]
    assert abs(sum(draws) / len(draws) - 6) < 0.05
    assert abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.1
    matrix = sharding.communication_matrix([5, 0, 9, 3], [6, 6, 5], 3)
    assert [sum(r) for r in matrix] == [5, 0, 9, 3] and [sum(c) for c in zip(*matrix, strict=True)] == [6, 6, 5]


# --- chat, html, toxicity --------------------------------------------------------


def test_chat_masks_and_parts(spark):
    rows = [(1, 0, "system", "Be kind"), (1, 1, "ann", "Hi"), (1, 2, "bob", None), (1, None, "ann", "Bye"), (1, 2, None, "?"), (None, 0, "ann", "é😀")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {(r.conv_id, r.perspective, r.part): r for r in chat.perspectives(df, part_turns=2).collect()}
    assert {k[:2] for k in whole} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    ann = [whole[1, "ann", p] for p in range(3)]
    assert ann[0].text == "<|system|>\nBe kind<|end|>\n<|assistant|>\nHi<|end|>\n"
    assert ann[1].offset == len(ann[0].text) and "<|user name=bob|>\n<|end|>" in ann[1].text
    for r in whole.values():
        assert r.n_trained == sum(m.end - m.begin for m in r.masks)
    trained = [r.text[m.begin : m.end] for r in ann for m in r.masks]
    assert trained == ["Hi<|end|>", "Bye<|end|>"]
    assert chat.perspectives(df.limit(0)).collect() == []


def test_chat_parts_are_bounded_whatever_the_turn_numbers(spark):
    rows = [(1, None, "ann", "Bye")] * 9 + [(1, 2, "bob", f"é{i}") for i in range(7)] + [(None, 0, "system", "x"), (None, 0, "ann", "y")] * 5
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = chat.perspectives(df, part_turns=4).collect()
    assert max(r.n_turns for r in found) <= 4
    for d, me in {(r.conv_id, r.perspective) for r in found}:
        mine = sorted((r for r in found if (r.conv_id, r.perspective) == (d, me)), key=lambda r: r.part)
        assert [r.part for r in mine] == list(range(len(mine)))
        assert [r.offset for r in mine] == [sum(len(r.text) for r in mine[:k]) for k in range(len(mine))]
        turns = sorted((n if n is not None else 99, s, t) for own, n, s, t in rows if own == d)
        role = {"system": "system", me: "assistant"}
        want = "".join(f"<|{role.get(s, f'user name={s}')}|>\n{t}<|end|>\n" for _, s, t in turns)
        assert "".join(r.text for r in mine) == want
        spoken = [r.text[m.begin : m.end] for r in mine for m in r.masks]
        assert spoken == [f"{t}<|end|>" for _, s, t in turns if s == me]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        ("<nav>menu</nav><article><h1>T</h1><p>A,&nbsp;b &amp; c<p>D<br>e</article><footer>f</footer>", "T A, b & c D e"),
        ("<div id=content><p>One, two.</p></div><div class=sidebar><p>Side, a, b, c, d, e.</p></div>", "One, two."),
        ("<main><section><p>One</p></section><section><p>Two</p></section></main><div class=comments><p>x, y, z, a</p></div>", "One Two"),
        ("<article><p>Hi <b>bold</b>ed</p><form><p>mail</p></form><script>x</script></article><p", "Hi bolded"),
    ],
)
def test_main_text(html, text):
    assert htmltext.main_text(html) == text


LONG = "Words, more words, and then some more of them, to the end of it. " * 9


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<nav>m</nav><div class='content has-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<div id='page' class='no-sidebar'><div class='post comments-open'><p>{LONG}</p></div></div>", LONG),
        (f"<div class='no-sidebar'><article><p>{LONG}</p></article><div class='sidebar'>x</div></div>", LONG),
        (f"<article><p>One</p></article><div class='comments page'><article><p>{LONG}</p></article></div>", "One"),
        (f"<div><div><p>{LONG}</p><p>{LONG}</p></div><div><p>Short</p></div><h3>H</h3><ul><li>I</li></ul></div>", f"{LONG}{LONG}Short H I"),
    ],
)
def test_text_is_not_lost_by_a_word_or_few_points(html, text):
    assert htmltext.main_text(html) == text.strip()


def test_deep_and_long_pages():
    assert htmltext.main_text("<div><p>x" * 3000).count("x") == 3000
    assert len(htmltext.main_text(f"<p>{'word, ' * 200_000}</p>")) == 6 * 200_000 - 1


def test_toxicity_learns_and_ranks(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        bad = i % 3 == 0
        text = _sentence(rng, 30) + (" you vile gorm" if bad else "")
        rows.append((i, text))
        labels.append((i, int(bad)))
    rows += [(900, None), (901, ""), (None, "you vile gorm")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (5000, 1), (3, None)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score(docs, marks).collect()}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found.values())
    held = [(found[i].score, t) for i, t in labels if found[i].held_out]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in labels)
    assert sum((s >= 0.3) == bool(t) for s, t in held) >= 0.95 * len(held)
    none = toxicity.score(docs, marks.limit(0)).collect()
    assert {r.score for r in none} == {0.0}


def test_digest_of_kept_words(spark, sf_dir):
    row = queries.op5_repeated_passages(spark, sf_dir).filter("n_removed = 0").first()
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.col("doc_id") == row.doc_id).first().text
    assert hashlib.sha256(b" ".join(words(text))).hexdigest() == row.kept_sha256


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, sf_dir, name):
    found = differences(queries.queries()[name](spark, sf_dir), duck(sf_dir).sql(queries.oracle_sql()[name]))
    assert found == []


def test_pipeline_equals_its_stages_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(stored(stage(spark, steps[-1], sf_dir), "step"))
    rows = [s.collect() for s in steps]
    assert all(s.columns == docs.columns for s in steps[:-1])
    near = brute_components([tuple(r) for r in rows[1]], 5)
    assert {r.doc_id for r in rows[2]} == {d for d, (_, c) in near.items() if c == d}
    assert {r.doc_id for r in rows[3]} <= {r.doc_id for r in rows[2]}
    assert {r.doc_id for r in rows[4]} <= {r.doc_id for r in rows[3]}
    assert sorted(r.doc_id for r in rows[5]) == sorted(r.doc_id for r in rows[4])
    assert sorted(map(tuple, rows[5])) == sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect()))


def test_release_spares_what_is_read(spark, docs):
    with recorded():
        kept, gone = stored(docs, "kept"), stored(docs, "gone")
    own = stored(docs, "own")
    release(kept.select("doc_id").filter("doc_id > 3"))
    assert kept.count() == own.count() == docs.count()
    with pytest.raises(Exception, match="(?i)not.*exist|not.*found"):
        spark.read.parquet(gone.inputFiles()[0]).count()


def test_groups_of_near_copies_name_few_candidates(spark):
    rng = random.Random(12)
    base = _sentence(rng, 150).split()
    texts = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(len(w))] = f"own{i}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    named = []
    original = neardup.compared

    def counted(*args):
        named.append(stored(original(*args), "counted"))
        return named[-1]

    neardup.compared = counted
    try:
        found = neardup.near_duplicates(docs).collect()
    finally:
        neardup.compared = original
    assert {r.component_id for r in found} == {0}
    assert named[0].select("a", "b").distinct().count() < 60 * 20 and named[1].count() == 0
